"""Divergence of sources from each other and from their language, over the terms that
enough documents of the language have.

The kept terms are found by iceberg prefix refinement. A term's bytes, closed by a zero
byte, are extended level by level (4, 8, 16 .. bytes). A level counts the distinct
documents of every prefix whose shorter prefix survived the level before, and discards
those under the threshold: a term cannot be in more documents than any of its prefixes, so
nothing that is kept later is lost. Prefixes that reach their zero byte are complete terms
with their exact document count; levels go on until no incomplete prefix is left. The many
rare terms of a corpus fall with their prefixes and are never grouped one by one.

Scale. A document is one row with its distinct terms, so a level needs no distinct
aggregate, only sums that every task makes before it shuffles; a frequent prefix is one
row per task. Survivors are broadcast only within a measured bound, else joined. Sums over
all kept terms for every pair of sources are made in blocks of terms by tiles of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import fits, lookup_join, measure
from .common import written

#: Bytes that make up terms, in a text with A-Z in lower case.
_IN_TERM = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])
END = b"\0"  # no term has it
FIRST = 6  # bytes of the first level; every level has twice as many
_CHUNK = 2 << 20  # bytes of texts that are counted at once
BLOCK_ROWS = 50_000  # counts of a block of terms
TILE = 256  # sources a block compares with all others at once
_CELLS = 1 << 22  # cells of a block's dense matrix


def _levels(terms: list[bytes]) -> np.ndarray:
    """For each of the sorted ``terms`` the bytes of the first level at which its prefix is not
    that of the term before it."""
    fresh = np.full(len(terms), FIRST, np.int32)
    length, alike = FIRST, np.arange(1, len(terms))
    while len(alike):
        own, before = (np.array([terms[i] for i in at], f"S{length}") for at in (alike, alike - 1))
        alike = alike[own == before]
        length *= 2
        fresh[alike] = length
    return fresh


def _count_texts(texts: list[bytes]) -> list[pa.Array]:
    """Per text: its distinct terms closed by a zero byte, in byte order, how often it has
    each, and the first level at which a term's prefix is not that of the term before it."""
    raw = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    inside = _IN_TERM[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)),
        pa.py_buffer(raw[inside])]).dictionary_encode()
    order = pc.array_sort_indices(words.dictionary).to_numpy()
    spelt = [w + END for w in words.dictionary.take(pa.array(order)).to_pylist()]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    text = np.searchsorted(begins, starts, "right") - 1
    size = max(1, len(order))
    key, count = np.unique(text * size + rank[words.indices.to_numpy()], return_counts=True)
    text, term = key // size, key % size
    levels = _levels(spelt)
    fresh = np.full(len(key), FIRST, np.int32)
    follows = np.flatnonzero(text[1:] == text[:-1]) + 1
    for level in np.unique(levels)[::-1]:
        prefix = np.cumsum(levels <= level)  # the same number for terms of the same prefix
        fresh[follows[prefix[term[follows]] != prefix[term[follows - 1]]]] = level
    offsets = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
    return [pa.ListArray.from_arrays(offsets, x) for x in (
        pa.array(spelt, pa.binary()).take(pa.array(term)), pa.array(count, pa.int64()), pa.array(fresh))]


def document_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """One row per document: lang, source, its distinct terms closed by a zero byte, in byte
    order, how often it has each, and the level (in bytes) from which on a term's prefix is
    not that of the term before it. Nulls are empty strings."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
            low = 0
            while low < len(ends):  # some megabytes of texts at once, or one that is longer
                before = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, before + _CHUNK)))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("source"),
                     *_count_texts(part.column("text").to_pylist())],
                    ["lang", "source", "terms", "counts", "fresh"])
                low = high

    empty = F.lit("")
    return docs.select(
        F.coalesce(F.col(f"`{lang_col}`"), empty).alias("lang"),
        F.coalesce(F.col(f"`{source_col}`"), empty).alias("source"),
        F.coalesce(F.col(f"`{text_col}`"), empty).cast("binary").alias("text"),
    ).mapInArrow(count, "lang string, source string, terms array<binary>, counts array<long>,"
                        " fresh array<int>")


def kept_terms(terms: DataFrame, min_docs: int) -> DataFrame:
    """Rows (lang, term, docs) of :func:`document_terms`: the terms, closed by a zero byte,
    that at least ``min_docs`` documents of the language have."""
    each = terms.select("lang", F.inline(F.arrays_zip("terms", "fresh")).alias("term", "fresh"))
    done, survivors, before, length = [], None, 0, FIRST
    while True:
        # A document counts once for each prefix: equal ones are neighbours in its terms.
        rows = each.where((F.col("fresh") <= length) & (F.octet_length("term") > before))
        if survivors is not None:
            rows = lookup_join(rows.withColumn("start", F.substring("term", 1, before)),
                               survivors.select("lang", F.col("term").alias("start")),
                               ["lang", "start"], "left_semi", fits(measure(survivors)))
        level = written(
            rows.groupBy("lang", F.substring("term", 1, length).alias("term"))
            .agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs), "prefixes")
        complete = F.substring("term", -1, 1) == F.lit(END)
        done.append(level.where(complete))
        survivors = level.where(~complete)
        if survivors.isEmpty():
            break
        before, length = length, length * 2
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def share(count: str, total: str, size: str) -> Column:
    """``1 + floor(10^9 (count + 5) / (total + 5 size))`` in exact decimals, as a long."""
    return F.expr(f"1 + (1000000000BD * (cast({count} as decimal(18)) + 5BD))"
                  f" div (cast({total} as decimal(18)) + 5BD * cast({size} as decimal(18)))")


def _distances(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of |p - q| over a block of terms, of the sources of one tile with all others."""
    lang, tile = key[0].as_py(), key[2].as_py()
    n = len(groups)
    mine = np.arange(tile * TILE, min((tile + 1) * TILE, n))
    if not len(counts):
        mine = mine[:0]
    base = np.empty(n, np.int64)
    base[groups["i"].to_numpy()] = groups["p0"].to_numpy()
    total = np.zeros((len(mine), n), np.int64)
    code = np.unique(counts["t"].to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    code, who, p = code[order], counts["i"].to_numpy()[order], counts["p"].to_numpy()[order]
    step, terms = max(1, _CELLS // max(n, 1)), int(code[-1]) + 1 if len(code) else 0
    for low in range(0, terms, step):
        a, b = np.searchsorted(code, [low, low + step])
        dense = np.repeat(base[None, :], min(step, terms - low), axis=0)
        dense[code[a:b] - low, who[a:b]] = p[a:b]
        for row, g in enumerate(mine):
            total[row] += np.abs(dense - dense[:, g:g + 1]).sum(axis=0)
    return pa.table({"lang": pa.array([lang] * total.size, pa.string()),
                     "g": pa.array(np.repeat(mine, n), pa.int32()),
                     "h": pa.array(np.tile(np.arange(n), len(mine)), pa.int32()),
                     "value": pa.array(total.ravel(), pa.int64())})


def divergence(docs: DataFrame, min_docs: int = 30, top_terms: int = 50, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every source of a language.

    A source, or language, gives a kept term ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``,
    ``N`` its occurrences of kept terms, ``V`` their number. Part ``pair``: each other source
    of the language with the sum of |p - q| over all kept terms (0 if there is none). Part
    ``term``: the ``top_terms`` terms that the source has and that exceed the language's p
    most. Ranks go by value, descending, ties by item in byte order.

    Terms are runs of letters A-Z, a-z and characters beyond ASCII, A-Z in lower case. Null
    texts, languages and sources are empty strings; a source without any term is still
    paired. Repeated rows are documents of their own. A very long text is one row with its
    distinct terms. An empty table gives an empty result. Other columns are not read, so
    their names cannot clash.
    """
    terms = written(document_terms(docs, text_col, lang_col, source_col), "terms")
    place = Window.partitionBy("lang").orderBy("source")
    # Numbers stand for sources and terms in what is counted and compared.
    sources = written(
        terms.select("lang", "source").distinct()
        .select("lang", "source", (F.row_number().over(place) - 1).alias("i"),
                F.monotonically_increasing_id().alias("g")), "sources")
    kept = written(kept_terms(terms, min_docs)
                   .select("lang", "term", F.monotonically_increasing_id().alias("t")), "kept")
    named = lookup_join(terms.select("lang", "source", "terms", "counts"), sources, ["lang", "source"],
                        "inner", fits(measure(sources)))
    each = named.select("lang", "g", F.inline(F.arrays_zip("terms", "counts")).alias("term", "c"))
    counts = written(lookup_join(each, kept, ["lang", "term"], "inner", fits(measure(kept)))
                     .groupBy("g", "t").agg(F.sum("c").alias("c")), "counts")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("g").agg(F.sum("c").alias("n"))
    groups = written(
        sources.join(totals, "g", "left").join(sizes, "lang", "left")
        .select("lang", "source", "i", "g", F.coalesce("n", F.lit(0)).alias("n"),
                F.coalesce("v", F.lit(0)).alias("v")), "groups")
    shares = written(counts.join(groups.select("lang", "i", "g", "n", "v"), "g")
                     .withColumn("p", share("c", "n", "v")).drop("g", "n", "v"), "shares")
    out = _pairs(shares, groups).unionByName(_terms(shares, groups, kept, top_terms))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``: every source of a language with every other one."""
    blocks = -(-shares.count() // BLOCK_ROWS) or 1
    tiles = groups.groupBy("lang").agg(F.floor(F.max("i") / TILE).alias("last"))
    zero = F.lit(0).cast("long")
    cells = (shares.join(tiles, "lang")
             .select("lang", F.pmod(F.xxhash64("t"), F.lit(blocks).cast("long")).alias("block"),
                     F.explode(F.sequence(zero, "last")).alias("tile"), "i", "p", "t"))
    spread = (groups.where("v > 0").join(tiles, "lang")
              .select("lang", "i", share("0", "n", "v").alias("p0"), "last",
                      F.explode(F.sequence(zero, F.lit(blocks - 1).cast("long"))).alias("block"))
              .select("lang", "i", "p0", "block", F.explode(F.sequence(zero, "last")).alias("tile")))
    keys = ["lang", "block", "tile"]
    sums = (cells.groupBy(*keys).cogroup(spread.groupBy(*keys))
            .applyInArrow(_distances, "lang string, g int, h int, value long")
            .groupBy("lang", "g", "h").agg(F.sum("value").alias("value")))
    names = groups.select("lang", "source", "i")
    pairs = (names.select("lang", "source", F.col("i").alias("g"))
             .join(names.select("lang", F.col("source").alias("item"), F.col("i").alias("h")), "lang")
             .where("g <> h").join(sums, ["lang", "g", "h"], "left")
             .withColumn("value", F.coalesce("value", F.lit(0))))
    return _ranked(pairs, "pair", None)


def _terms(shares: DataFrame, groups: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """Part ``term``: a source's terms that exceed their share of the language most."""
    whole = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.max("v").alias("v"))
    spelt = F.expr("substring(term, 1, octet_length(term) - 1)").cast("string")
    base = (shares.groupBy("lang", "t").agg(F.sum("c").alias("c")).join(whole, "lang")
            .join(kept.select("t", spelt.alias("item")), "t")
            .select("t", "item", share("c", "n", "v").alias("q")))
    above = (shares.select("lang", "i", "t", "p").join(base, "t").where("p > q")
             .join(groups.select("lang", "source", "i"), ["lang", "i"])
             .select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value")))
    return _ranked(above, "term", top)


def _ranked(rows: DataFrame, part: str, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))
    return (ranked if top is None else ranked.where(F.col("rank") <= top)).select(
        "lang", "source", "part", "item", "value", "rank")
