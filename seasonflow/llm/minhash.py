"""MinHash fingerprints of documents, and near-duplicate groups by signature bands.

A document's shingles (runs of ``shingle`` words) are hashed to 32 bits; permutation ``i``
maps a hash ``x`` to ``a_i x + b_i`` modulo 2^32 (``a_i`` odd, so it is a permutation), and
the fingerprint has the low 16 bits of the smallest image under each of ``PERMUTATIONS``.
Equal texts have equal fingerprints, and the share of equal positions estimates the Jaccard
similarity of two shingle sets. All permutations of a text run at once in numpy.

Near-duplicates: equal texts are one class. A band is ``ROWS`` consecutive positions; classes
that agree in one of ``BANDS`` bands meet in a Spark join on the band's value, which at a
similarity of 0.8 misses three pairs in a million. Only pairs leave that join whose sketches
(four bits of every position, compared as longs) agree in no less than ``SLACK`` below the
threshold, six standard deviations; the Jaccard similarity of the real shingle sets decides.

A bucket is not paired out, for many documents may share a passage, meet, and be unlike: its
classes are compared with its first class. Only classes of a bucket that is then more than
one group go on, to an exact prefix join: their shingles are put in one order, those of common
passages last, and two sets of that similarity must meet among the first fifth of either, early
enough for the rest to make up the overlap. Documents that share nothing but a passage do not.
Parities of the sets, which differ in no more bits than the sets in shingles, tell most of the
others apart in that join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import fits, lookup_join, measure
from .common import components, discard, under, written

PERMUTATIONS = 128
ROWS = 4
BANDS = 24
SLACK = 0.2
SAMPLE = 8  # one in so many open classes tells which shingles are common
PARITY = 512  # bits of the parities of a shingle set
MAX_COMMON = 1_000_000  # shingles that are put last in the order; it decides speed only
MAX_LOOKUP = 2_000_000  # rows of a lookup side that is broadcast, if its bytes fit too
_CHUNK = 1 << 12  # shingles whose images are held at once
_RNG = np.random.default_rng(42)
_A = _RNG.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, PERMUTATIONS, np.uint64).astype(np.uint32)


def text_words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return text.lower().split()


def shingle_hashes(found: list[bytes], shingle: int) -> np.ndarray:
    """64-bit hashes of all runs of ``shingle`` words; of the whole sequence when there are
    fewer, and nothing when there are none."""
    h = xxhash.xxh64_intdigest
    each = np.fromiter((h(w) for w in found), np.uint64, len(found))
    run = min(shingle, len(each))
    if not run:
        return np.array([], np.uint64)
    mixed = np.zeros(len(each) - run + 1, np.uint64)
    for i in range(run):  # the position enters, so order counts
        mixed = (mixed ^ each[i:len(each) - run + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def signature(text: bytes, shingle: int = 5) -> bytes:
    """The fingerprint: ``PERMUTATIONS`` little-endian 16-bit numbers, all ones for a text
    without words."""
    hashes = (shingle_hashes(text_words(text), shingle) >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(hashes), _CHUNK):
        images = hashes[i:i + _CHUNK, None] * _A + _B
        low = np.minimum(low, images.min(axis=0))
    return (low & np.uint32(0xFFFF)).astype("<u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity: the share of equal positions."""
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def jaccard(a: bytes, b: bytes, shingle: int = 5) -> float:
    """Jaccard similarity of the shingle sets of two texts; 1 if neither has words."""
    def runs(text):
        found = text_words(text)
        n = min(shingle, len(found))
        return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if n else set()
    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x or y else 1.0


def fingerprint(text: Column, shingle: int = 5) -> Column:
    """The fingerprint of a text as binary; null texts count as empty."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: signature(t or b"", shingle))

    return of(text.cast("binary"))


# --- every document against the next one --------------------------------------------

def half_replaced(text: str, following: str) -> str:
    """The last half of a text replaced by the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(texts: list[str], following: list[str], shingle: int, prints: list[bytes],
              next_prints: list[bytes]) -> list[pa.Array]:
    edited = [half_replaced(a, b).encode() for a, b in zip(texts, following)]
    marks = [signature(t, shingle) for t in edited]
    return [pa.array([hashlib.sha256(t).digest() for t in edited], pa.binary()),
            pa.array(marks, pa.binary()),
            pa.array(map(likeness, prints, marks), pa.float64()),
            pa.array(map(likeness, prints, next_prints), pa.float64())]


_OWN = "n_chars long, digest binary, print binary"
_NEXT = "edited_sha256 binary, edited_print binary, near_edited double, near_next double"


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
             keep: list[str] | None = None) -> DataFrame:
    """Every row with its fingerprint and how it compares with the next row by descending id
    (null ids last, ties by text; after the last row comes the first): the columns ``keep``
    (default all) under ``doc``, ``id``, ``n_chars`` (code points), ``digest`` (MD5 of the
    text), ``print``, the SHA-256 and fingerprint of the text whose last half is replaced by
    the next text's start, and the likeness to that and to the next text.

    One range shuffle brings rows in order; tasks stream their part with one row of look-ahead,
    and the last row of a part meets the first row of the next part in a small join.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    order = [F.desc_nulls_last("id"), F.xxhash64("text"), F.col("text")]
    ordered = (docs.select(under("doc", docs, keep), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
               .repartitionByRange(order[0], order[1]).sortWithinPartitions(*order))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the last row so far: its batch, text and fingerprint
        first = True
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                rows = batch.slice(low, 1000)
                texts = rows.column("text").to_pylist()
                prints = [signature(t.encode(), shingle) for t in texts]
                if held is not None:
                    rows = pa.Table.from_batches([held[0], rows]).combine_chunks().to_batches()[0]
                    texts, prints = [held[1], *texts], [held[2], *prints]
                if len(texts) > 1:
                    done = rows.slice(0, len(texts) - 1)
                    yield out(done, part, texts[:-1], prints[:-1], first, False,
                              _compared(texts[:-1], texts[1:], shingle, prints[:-1], prints[1:]))
                    first = False
                held = rows.slice(len(texts) - 1), texts[-1], prints[-1]
        if held is not None:
            none = [pa.nulls(1, t) for t in (pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            yield out(held[0], part, [held[1]], [held[2]], first, True, none)

    def out(rows, part, texts, prints, first, last, compared) -> pa.RecordBatch:
        n = len(texts)
        head = pa.array([texts[0], *[None] * (n - 1)] if first else [None] * n, pa.string())
        tail = pa.array([*[None] * (n - 1), texts[-1]] if last else [None] * n, pa.string())
        return pa.RecordBatch.from_arrays(
            [rows.column("doc"), rows.column("id"), pa.array(map(len, texts), pa.int64()),
             pa.array([hashlib.md5(t.encode()).digest() for t in texts], pa.binary()),
             pa.array(prints, pa.binary()), *compared, pa.array([part] * n, pa.int32()), head, tail],
            ["doc", "id", "n_chars", "digest", "print", "edited_sha256", "edited_print",
             "near_edited", "near_next", "part", "head", "tail"])

    fields = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}
    streamed = written(ordered.mapInArrow(
        stream, f"doc {fields['doc']}, id {fields['id']}, {_OWN}, {_NEXT}, part int, head string,"
                " tail string"), "followed")

    @F.pandas_udf(f"struct<{_NEXT.replace(' ', ':').replace(',:', ',')}>")
    def meet(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        a, b = list(texts), list(following)
        own, other = ([signature(t.encode(), shingle) for t in x] for x in (a, b))
        names = [c.split()[0] for c in _NEXT.split(", ")]
        return pd.DataFrame({k: v.to_pylist() for k, v in zip(names, _compared(a, b, shingle, own, other))})

    # Parts are as many as partitions; only their numbers pass through one task.
    heads = streamed.where(F.col("head").isNotNull()).select("part", "head")
    by = Window.orderBy("part")
    steps = heads.select("part").select(
        "part", F.coalesce(F.lead("part").over(by), F.min("part").over(
            by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    tails = streamed.where(F.col("tail").isNotNull()).select("part", "tail")
    met = (tails.join(steps, "part")
           .join(heads.select(F.col("part").alias("after"), "head"), "after")
           .select("part", meet("tail", "head").alias("met")))
    inner = streamed.where(F.col("tail").isNull())
    edges = streamed.where(F.col("tail").isNotNull()).join(met, "part")
    own = ["doc", "id", "n_chars", "digest", "print"]
    return inner.select(*own, *[c.split()[0] for c in _NEXT.split(", ")]).unionByName(
        edges.select(*own, "met.*"))


# --- groups ---------------------------------------------------------------------------

def band_keys(mark: str = "print") -> Column:
    """Array of one long per band."""
    width = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(k), F.substring(mark, k * width + 1, width))
                     for k in range(BANDS)])


def sketch(mark: Column) -> Column:
    """The low four bits of every position of a fingerprint, as an array of longs."""

    @F.pandas_udf("array<long>")
    def of(marks: pd.Series) -> pd.Series:
        lanes = np.frombuffer(b"".join(marks), "<u2").reshape(len(marks), PERMUTATIONS // 16, 16)
        shifts = np.arange(0, 64, 4, dtype=np.uint64)
        packed = ((lanes.astype(np.uint64) & np.uint64(15)) << shifts).sum(axis=2, dtype=np.uint64)
        return pd.Series(list(packed.view(np.int64)))

    return of(mark)


def close(a: str, b: str, threshold: float) -> Column:
    """Whether the sketches under ``a`` and ``b`` agree in the ``threshold`` less ``SLACK``."""
    apart = F.lit(0)
    for i in range(PERMUTATIONS // 16):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for by in (1, 2):  # any bit of a nibble moves to its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        apart = apart + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return apart <= int(PERMUTATIONS * (1 - threshold + SLACK))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float,
             shingle: int) -> DataFrame:
    """The ``pairs`` (a, b) of class numbers whose texts have a Jaccard similarity of at least
    ``threshold``. ``texts`` are all texts (digest, text), of which the candidates' are read."""
    side = classes.select("node", "digest", "sketch")
    x, y = side.toDF("a", "digest_a", "sketch_a"), side.toDF("b", "digest_b", "sketch_b")
    near = written(pairs.join(x, "a").join(y, "b").where(close("sketch_a", "sketch_b", threshold))
                   .select("a", "b", "digest_a", "digest_b"), "near")
    needed = written(near.select(F.explode(F.array("digest_a", "digest_b")).alias("digest"))
                     .distinct(), "needed")
    bodies = written(
        lookup_join(texts, needed, "digest", "left_semi", fits(measure(needed, MAX_LOOKUP)))
        .groupBy("digest").agg(F.first("text").alias("text")), "bodies")

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(x, y, shingle) for x, y in zip(a, b)], dtype=float)

    links = written(
        near.join(bodies.toDF("digest_a", "text_a"), "digest_a")
        .join(bodies.toDF("digest_b", "text_b"), "digest_b")
        .where(similarity("text_a", "text_b") >= threshold).select("a", "b"), "links")
    for table in (near, needed, bodies):
        discard(table)
    return links


def _shingles(texts: DataFrame, shingle: int) -> DataFrame:
    """Rows (sh): the distinct shingles of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                found = np.unique(shingle_hashes(text_words(text.as_py()), shingle))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["sh"])

    return texts.select("text").mapInArrow(run, "sh long")


def parities(hashes: np.ndarray) -> list[int]:
    """For each of PARITY classes of hashes whether the set has an odd number of them, as bits
    of longs. Each element that only one of two sets has changes one bit, so two sets differ in
    at least as many elements as their parities in bits."""
    odd = np.bincount((hashes % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _prefixes(texts: DataFrame, common: np.ndarray, threshold: float, shingle: int) -> DataFrame:
    """Rows (node, component, n, pos, sh, odd): the first shingles of every text (node, component,
    text) in the common order, as many as any similar text must share one of. The first row has
    the text's parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*(batch.column(c).to_pylist() for c in ("node", "component", "text")))
            for node, component, text in columns:
                found = np.unique(shingle_hashes(text_words(text), shingle))
                n = len(found)
                at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                late = common[at] == found if len(common) else np.zeros(n, bool)
                odd = parities(found)
                found = np.concatenate([found[~late], found[late]])
                found = found[:n - int(np.ceil(threshold * n - 1e-9)) + 1]
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, node, np.int64)), pa.array(np.full(k, component, np.int64)),
                     pa.array(np.full(k, n, np.int32)), pa.array(np.arange(k, dtype=np.int32)),
                     pa.array(found.view(np.int64)),
                     pa.array([odd, *[None] * (k - 1)][:k], pa.list_(pa.int64()))],
                    ["node", "component", "n", "pos", "sh", "odd"])

    return texts.select("node", "component", "text").mapInArrow(
        run, "node long, component long, n int, pos int, sh long, odd array<long>")


def prefix_pairs(open_: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Pairs (a, b) of ``open_`` classes (node, component, digest) of different components whose
    shingle sets may have the similarity ``threshold``; all that have it are among them."""
    wanted = open_.select("digest")
    bodies = written(
        lookup_join(texts, wanted, "digest", "left_semi", fits(measure(wanted, MAX_LOOKUP)))
        .groupBy("digest").agg(F.first("text").alias("text"))
        .join(open_, "digest").select("node", "component", "text"), "open_texts")
    some = bodies.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLE).cast("long")) == 0)
    often = (_shingles(some, shingle).groupBy("sh").agg(F.count("*").alias("n")).where("n > 2")
             .orderBy(F.desc("n"), "sh").limit(MAX_COMMON).select("sh").toPandas()["sh"])
    common = np.sort(often.to_numpy(np.int64).view(np.uint64))
    rows = written(_prefixes(bodies, common, threshold, shingle), "prefixes")
    # Shingles of one component only are left out; of the others the largest component is
    # not compared with itself.
    mixed = (rows.groupBy("sh", "component").agg(F.count("*").alias("n"))
             .groupBy("sh").agg(F.count("*").alias("parts"), F.max_by("component", "n").alias("main"))
             .where("parts > 1").select("sh", "main"))
    held = written(rows.drop("odd").join(mixed, "sh")
                   .join(rows.where("pos = 0").select("node", "odd"), "node"), "held")
    x, y = held.where("component <> main").alias("x"), held.alias("y")
    overlap = F.ceil((F.col("x.n") + F.col("y.n")) * (threshold / (1 + threshold)) - 1e-9)
    left = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    apart = sum((F.bit_count(F.get("x.odd", F.lit(i)).bitwiseXOR(F.get("y.odd", F.lit(i))))
                 for i in range(PARITY // 64)), F.lit(0))
    pairs = written(
        x.join(y, (F.col("x.sh") == F.col("y.sh")) & (F.col("x.component") != F.col("y.component"))
               & ((F.col("x.node") < F.col("y.node")) | (F.col("y.component") == F.col("y.main")))
               & (left >= overlap) & (apart <= F.col("x.n") + F.col("y.n") - 2 * overlap))
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct(), "prefix_pairs")
    for table in (bodies, rows, held):
        discard(table)
    return pairs


def link_groups(classes: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Rows (node, component) for the ``classes`` (node, digest, print, sketch) that have a
    link."""
    keyed = classes.select("node", F.explode(band_keys()).alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"))
    dense = written(keyed.join(buckets.where("n > 1"), "key").select("key", "node", "low"), "dense")
    star = dense.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    links = verified(star, classes, texts, threshold, shingle)
    known = written(components(links), "known")
    tagged = written(dense.drop("low").join(known, "node", "left")
                     .withColumn("component", F.coalesce("component", "node")), "tagged")
    parts = tagged.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = written(tagged.join(parts.where("low <> high").select("key"), "key", "left_semi")
                    .select("node", "component").distinct().join(classes.select("node", "digest"), "node"),
                    "open")
    rest = prefix_pairs(open_, texts, threshold, shingle)
    more = verified(rest, classes, texts, threshold, shingle)
    out = written(components(known.select(F.col("node").alias("a"), F.col("component").alias("b"))
                             .unionByName(more)), "groups")
    for table in (dense, links, known, tagged, open_, more):
        discard(table)
    return out


def grouped(prints: DataFrame, texts: DataFrame, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """``prints`` (with id, digest, print) with ``component_id``, the smallest id of its
    near-duplicate group. ``texts`` are the texts (digest, text) behind them."""
    classes = written(
        prints.groupBy("digest").agg(F.first("print").alias("print"), F.min("id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "digest", "print",
                sketch(F.col("print")).alias("sketch"), "first"), "classes")
    groups = link_groups(classes, texts, threshold, shingle)
    named = (classes.select("node", "digest", "first").join(groups, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_digest = written(named.join(ids, "component").select("digest", "component_id"), "by_digest")
    return lookup_join(prints, by_digest, "digest", "inner", fits(measure(by_digest, MAX_LOOKUP)))


def digests(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows (digest, text): every text and its MD5."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return docs.select(F.unhex(F.md5(text)).alias("digest"), text.alias("text"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.8, shingle: int = 5, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and group: the columns ``keep`` (default all)
    under ``doc``, ``id``, ``digest``, ``print`` and ``component_id``, the smallest id reachable
    by links of a Jaccard similarity of at least ``threshold``.

    Null texts are empty; texts without words are alike. Null ids are passed over: a group
    without any id has a null ``component_id``. Repeated rows are rows of one group. A very
    long text is hashed in blocks of shingles. An empty table gives an empty result. Columns of
    any other name stay inside ``doc`` and cannot clash.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    prints = written(
        docs.select(under("doc", docs, keep), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
        .select("doc", "id", F.unhex(F.md5("text")).alias("digest"),
                fingerprint(F.col("text"), shingle).alias("print")), "prints")
    return grouped(prints, digests(docs, text_col), threshold, shingle)
