"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: every word leads one window of ``order`` columns,
the word itself and the words that follow it in its piece, padded where the piece ends. A
shorter phrase occurs once for every window that it begins, so its count is the sum over the
windows with that prefix: no n-gram of a lower order is ever taken from a text. The sums over
the longest prefixes are made where the windows are counted, and Spark's ROLLUP sums those of
all shorter ones, down to the number of words of a language.

Scale. Tasks sum equal windows before they are shuffled, so a frequent window is one row per
task and chunk. A window travels as its words, joined by spaces and without padding, which is
about a third of the bytes of as many columns. Windows are dealt by their prefix, so that
those under ``min_count``, which can be neither candidates nor parts of one, end there: one
row per prefix goes on, and the ROLLUP, partially summed in every task, moves words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
_CHUNK = 4 << 20  # bytes of text whose windows are counted at once
_PIECE_TABLE = bytes(10 if b in PIECE_ENDS else 32 if b == 9 else b for b in range(256))


def chunks(text: bytes, size: int = _CHUNK) -> Iterator[bytes]:
    """A text, A-Z in lower case and pieces ended by newlines, in parts of about ``size``
    bytes cut at piece ends."""
    text = text.lower().translate(_PIECE_TABLE)
    start = 0
    while len(text) - start > size:
        cut = text.rfind(b"\n", start, start + size) + 1
        if not cut:
            cut = text.find(b"\n", start + size) + 1 or len(text)
        yield text[start:cut]
        start = cut
    yield text[start:]


def encoded_words(chunk: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of a chunk's words, the words by code, and the piece of each word."""
    raw = np.frombuffer(chunk, np.uint8)
    inside = (raw != 32) & (raw != 10)
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(raw == 10), starts)
    return found.indices.to_numpy(), found.dictionary, piece


def _by_language(batches: Iterator[pa.RecordBatch], size: int = _CHUNK) -> Iterator[tuple[str, bytes]]:
    """Chunks of joined texts, each of one language; at most about twice ``size`` bytes are
    held, or one piece that is longer."""
    held: dict[str, list[bytes]] = {}
    n = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in chunks(text.as_buffer().to_pybytes(), size):
                held.setdefault(lang, []).append(part)
                n += len(part)
                if n > size:
                    yield from ((key, b"\n".join(parts)) for key, parts in held.items())
                    held, n = {}, 0
    yield from ((key, b"\n".join(parts)) for key, parts in held.items())


def windows(docs: DataFrame, order: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows (lang, phrase, c): windows of up to ``order`` words, joined by spaces, with a
    chunk's count of them. The same window may have several rows, their ``c`` add up."""
    names = [f"w{i}" for i in range(order)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _by_language(batches):
            codes, found, piece = encoded_words(chunk)
            n = len(codes)
            lead = [pa.array(codes)]
            for i in range(1, order):
                follows = np.zeros(n, bool)
                shifted = np.zeros(n, codes.dtype)
                if i < n:
                    follows[:n - i] = piece[i:] == piece[:n - i]
                    shifted[:n - i] = codes[i:]
                lead.append(pa.array(shifted, mask=~follows))
            summed = pa.table(lead, names).group_by(names, use_threads=False).aggregate(
                [([], "count_all")]).combine_chunks()
            for low in range(0, len(summed), 100_000):
                part = summed.slice(low, 100_000)
                parts = [found.take(part[w].combine_chunks()).cast(pa.binary()) for w in names]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()),
                                                     null_handling="skip")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), phrase.cast(pa.string()),
                     part["count_all"].combine_chunks()], ["lang", "phrase", "c"])

    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(count, "lang string, phrase string, c long")


def _first_words(phrase: str, n: int) -> Column:
    return F.substring_index(phrase, " ", n) if n else F.lit("")


def _word(phrase: str, i: int) -> Column:
    """The i-th word of a phrase, null where it has fewer."""
    return F.get(F.split(phrase, " "), F.lit(i)) if i else _first_words(phrase, 1)


def _n_words(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def phrase_counts(docs: DataFrame, order: int, min_count: int, **cols) -> DataFrame:
    """Rows (lang, phrase, n_words, f): the number of occurrences of every phrase of up to
    ``order`` words with at least ``min_count`` of them, and of all words (null phrase)."""
    dealt = F.xxhash64("lang", _first_words("phrase", order - 1))
    counted = (windows(docs, order, **cols).repartition(dealt).select("*", dealt.alias("deal"))
               .groupBy("deal", "lang", "phrase").agg(F.sum("c").alias("c"))
               .withColumn("prefix", _first_words("phrase", order - 1)))
    # The hash comes first, so that rows sort by one long; equal prefixes are then adjacent, in
    # any order, as it does not matter which of its windows carries the prefix's sum.
    same = Window.partitionBy("deal", "lang", "prefix").orderBy("deal")
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = (counted.withColumn("t", F.sum("c").over(every))
              .withColumn("head", F.row_number().over(same) == 1)
              .where(F.col("head") | (F.col("c") >= min_count)))
    full = F.col("c") >= min_count
    table = written(summed.select(
        "lang", F.when(full & (_n_words("phrase") == order), F.col("phrase")).alias("phrase"), "c",
        F.when(F.col("head") & (F.col("t") >= min_count) & (_n_words("prefix") == order - 1),
               F.col("prefix")).alias("prefix"),
        F.when(F.col("head"), F.col("t")).alias("t"),
        *[_word("prefix", i).alias(f"w{i}") for i in range(order - 2)]), "windows")
    longest = table.where("phrase IS NOT NULL").select("lang", "phrase", F.col("c").alias("f"))
    prefixes = table.where("prefix IS NOT NULL").select("lang", F.col("prefix").alias("phrase"),
                                                        F.col("t").alias("f"))
    words = [f"w{i}" for i in range(order - 2)]
    # summed before the ROLLUP, which takes every row once for each of its levels
    rolled = (table.where("t IS NOT NULL").groupBy("lang", *words).agg(F.sum("t").alias("t"))
              .rollup("lang", *words).agg(F.sum("t").alias("f"), F.grouping_id().alias("gid")))
    n_words = F.lit(order - 2) - F.bit_count("gid")
    whole = F.size(F.array_compact(F.array(*words))) == n_words if words else F.lit(True)
    shorter = (rolled.where((n_words == 0) | (n_words > 0) & whole & (F.col("f") >= min_count))
               .select("lang", F.when(n_words > 0, F.concat_ws(" ", *words)).alias("phrase"), "f"))
    return (longest.unionByName(prefixes).unionByName(shorter)
            .select("lang", "phrase", F.coalesce(_n_words("phrase"), F.lit(0)).alias("n_words"), "f"))


def scored(counts: DataFrame) -> DataFrame:
    """Candidates (phrases of two words or more) of :func:`phrase_counts` with their lowest
    scoring cut: rows (lang, phrase, a, l, r, n, score)."""
    n = counts.where("n_words = 0").select("lang", F.col("f").alias("n"))
    known = counts.where("n_words > 0").select("lang", "phrase", "f")
    cuts = (counts.where("n_words > 1")
            .select("lang", "phrase", F.col("f").alias("a"), "n_words",
                    F.explode(F.expr("sequence(1, n_words - 1)")).alias("k"))
            .select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("left"),
                    F.expr("substring_index(phrase, ' ', k - n_words)").alias("right")))
    both = (cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"])
            .join(known.toDF("lang", "right", "r"), ["lang", "right"]))
    # Products of counts pass 64 bits: decimals of scale 0 are exact up to 38 digits.
    score = F.expr("(1000000BD * (cast(a as decimal(15)) * cast(a as decimal(15))))"
                   " div (cast(l as decimal(15)) * cast(r as decimal(15)))")
    best = (both.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    return best.join(n, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def absorbed(counts: DataFrame, share: int) -> DataFrame:
    """(lang, phrase) of candidates contained in a longer candidate that has at least
    ``share`` percent of their occurrences."""
    longer = counts.where("n_words > 2").select("lang", F.split("phrase", " ").alias("words"), "n_words",
                                                F.col("f").alias("f_longer"))
    inner = (longer.select("*", F.explode(F.expr("sequence(2, n_words - 1)")).alias("m"))
             .select("*", F.explode(F.expr("sequence(1, n_words - m + 1)")).alias("at"))
             .groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("phrase"))
             .agg(F.max("f_longer").alias("f_longer")))
    own = counts.where("n_words > 1").select("lang", "phrase", "f")
    return (inner.join(own, ["lang", "phrase"])
            .where(100 * F.col("f_longer") >= F.lit(share) * F.col("f")).select("lang", "phrase"))


def collocations(docs: DataFrame, order: int = 3, min_count: int = 10, share: int = 50,
                 top: int | None = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of every language (None: all, without ``rank``): rows (lang,
    rank, phrase, a, l, r, n, score), ranked by score and count, both descending, and the
    phrase in byte order.

    A candidate is a phrase of 2 to ``order`` (at least 2) words within one piece with ``a >=
    min_count`` occurrences, overlaps included; ``l`` and ``r`` count the parts of its lowest
    scoring cut, ``n`` all words of the language. It is dropped where a longer candidate that
    contains it has ``share`` percent of its occurrences. Null texts are empty, a null
    language is ``und``; an empty text adds nothing; repeated rows count each time. Texts of
    any length are read whole, some megabytes of pieces at a time. An empty table, or one
    without a candidate, gives an empty result. Ties need no rule beyond the order above,
    which is total. Other columns are not read, so their names cannot clash.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    counts = written(phrase_counts(docs, order, min_count, text_col=text_col, lang_col=lang_col),
                     "phrases")
    rows = scored(counts).join(absorbed(counts, share), ["lang", "phrase"], "left_anti")
    if top is None:
        return rows
    # Ranked in two steps: no task sees all phrases of a language.
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    first = salted.withColumn("near", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*by))).where(F.col("near") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")
    return (first.withColumn("rank", rank).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
