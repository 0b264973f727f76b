"""Near-duplicate documents by SimHash and pivot distance tables.

A document's fingerprint has bit ``i`` set when over half of the hashes of its word
shingles have it set. Documents are linked when their fingerprints differ in at most
``radius`` bits; a group is a connected component of links.

Pivot distance tables. Every distinct fingerprint ``x`` gets its Hamming distances to
two sets of reference fingerprints:

* the staircase ``R_0 .. R_64`` (``R_i`` has the lowest ``i`` bits set). The distance
  profile ``d(x, R_i)`` steps by +1 or -1 at each ``i``; two fingerprints within
  ``radius`` have profiles that step differently at most ``radius`` times. Cut into
  ``radius + 3`` segments, at least three segments therefore have equal steps. The
  steps of any three segments are the equi-join key that fetches candidates (the step
  at ``i`` is a function of bit ``i``, so the steps of a segment are read off by a mask).
* ``PIVOTS`` scattered references. By the triangle inequality a pair within ``radius``
  has ``max_i |d(x, P_i) - d(y, P_i)| <= radius``; all other pairs are discarded.

Survivors are verified by the exact Hamming distance. Nothing is capped: equal
fingerprints are one node with a membership list, so copies are never paired, and
inside a bucket members are first linked to the bucket's extreme members, and only
pairs that are still in different groups are joined.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, under, written

BITS = 64
SEED = 42
PIVOTS = 16
_LANE = 8  # bits a pivot distance takes in a packed table
_CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Unsigned XXH64 (seed 42) of every run of ``shingle`` words, repeats included;
    of the whole sequence when there are fewer words, and nothing when there are none."""
    tokens = text.lower().split()  # bytes.lower() changes A-Z only
    h = xxhash.xxh64_intdigest
    if len(tokens) > shingle:
        runs = map(b" ".join, zip(*(tokens[i:] for i in range(shingle))))
        return np.fromiter((h(r, SEED) for r in runs), np.uint64, len(tokens) - shingle + 1)
    return np.array([h(b" ".join(tokens), SEED)] if tokens else [], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; zero for none."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    out = 0
    for i in np.flatnonzero(counts * 2 > len(hashes)):
        out |= 1 << int(i)
    return out


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of a text as a (signed) long; null texts count as empty."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        out = np.fromiter((simhash(shingle_hashes(t, shingle)) if t else 0 for t in texts),
                          np.uint64, len(texts))
        return pd.Series(out.view(np.int64))

    return of(text.cast("binary"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _references() -> list[int]:
    """The scattered reference fingerprints: XXH64 of their number."""
    return [_signed(xxhash.xxh64_intdigest(str(i), SEED)) for i in range(PIVOTS)]


def pivot_table(fp: Column) -> list[Column]:
    """Distances to the scattered references, eight to a long (8 bits each)."""
    refs = _references()
    per = BITS // _LANE
    packed = []
    for start in range(0, PIVOTS, per):
        lanes = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(r))).cast("long"), _LANE * i)
                 for i, r in enumerate(refs[start:start + per])]
        packed.append(reduce(lambda x, y: x.bitwiseOR(y), lanes).alias(f"p{start // per}"))
    return packed


def _coordinates_near(a: str, b: str, radius: int) -> Column:
    """True when no pivot coordinate differs by more than ``radius``."""
    tests = []
    for lane in range(PIVOTS):
        table, shift = f"p{lane * _LANE // BITS}", lane * _LANE % BITS
        x, y = (F.shiftrightunsigned(F.col(f"{s}.{table}"), shift).bitwiseAND(F.lit(0x7F))
                for s in (a, b))
        tests.append(F.abs(x - y) <= radius)
    return reduce(lambda p, q: p & q, tests)


def _segment_masks(radius: int) -> list[int]:
    """Masks of every choice of three of ``radius + 3`` profile segments."""
    n = radius + 3
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    segments = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in itertools.pairwise(cuts)]
    return [_signed(a | b | c) for a, b, c in itertools.combinations(segments, 3)]


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def link_groups(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Components of the distinct fingerprints ``fps`` (column fp) under links of at most
    ``radius`` bits: rows (node, component) for fingerprints that have a link."""
    keyed = fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m)) for m in _segment_masks(radius)])).alias("k", "key"))
    buckets = (keyed.groupBy("k", "key")
               .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
               .where("n > 1"))
    dense = written(keyed.join(buckets, ["k", "key"])
                    .select("k", "key", "fp", "low", "high", *pivot_table(F.col("fp"))), "dense")
    # Links to the two extreme members of each bucket: linear in the bucket's size.
    ends = dense.select("fp", F.explode(F.array("low", "high")).alias("end"))
    star = written(ends.where((F.col("fp") != F.col("end"))
                              & _near(F.col("fp"), F.col("end"), radius))
                   .select(F.col("fp").alias("a"), F.col("end").alias("b")).distinct(), "star")
    known = written(components(star), "known")
    # What is left: pairs of a bucket whose members are not in one group yet.
    tagged = written(dense.drop("low", "high")
                     .join(known.withColumnRenamed("node", "fp"), "fp", "left")
                     .withColumn("component", F.coalesce("component", "fp")), "tagged")
    x, y = tagged.alias("x"), tagged.alias("y")
    rest = (x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.key") == F.col("y.key"))
                   & (F.col("x.fp") < F.col("y.fp"))
                   & (F.col("x.component") != F.col("y.component"))
                   & _coordinates_near("x", "y", radius)
                   & _near(F.col("x.fp"), F.col("y.fp"), radius))
            .select(F.col("x.component").alias("a"), F.col("y.component").alias("b")).distinct())
    out = written(components(known.select(F.col("node").alias("a"), F.col("component").alias("b"))
                             .union(rest)), "groups")
    for table in (dense, star, known, tagged):
        discard(table)
    return out


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 3, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Written tables: the rows (doc, id, rid, fp) and the groups of their fingerprints (fp,
    group_fp, component_id)."""
    hashed = written(
        docs.select(under("doc", docs, keep), F.col(f"`{id_col}`").alias("id"),
                    F.col(f"`{text_col}`").alias("text"))
        .select("doc", "id", F.monotonically_increasing_id().alias("rid"),
                fingerprint(F.col("text"), shingle).alias("fp")), "hashed")
    owners = written(hashed.groupBy("fp").agg(F.min("id").alias("first")), "owners")
    groups = link_groups(owners.select("fp"), radius)
    named = (owners.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("group_fp", F.coalesce("component", "fp")))
    ids = named.groupBy("group_fp").agg(F.min("first").alias("component_id"))
    by_fp = written(named.join(ids, "group_fp").select("fp", "group_fp", "component_id"), "by_fp")
    return hashed, by_fp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and group: the columns ``keep`` (default
    all) under ``doc``, ``rid`` (a row number), ``fp`` (long), ``group_fp`` (the group's
    smallest fingerprint) and ``component_id``, the smallest id reachable by links.

    Options: ``text_col``, ``shingle`` (words), ``radius`` (bits) and ``keep``. Null and empty
    texts have fingerprint zero and are linked like any other. Null ids
    are passed over: a group without any id has a null ``component_id``. Repeated rows
    are rows of one group. An empty table gives an empty result. Columns of any other
    name stay inside ``doc`` and cannot clash.
    """
    hashed, by_fp = _grouped(docs, id_col, **options)
    return hashed.join(by_fp, "fp")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id,
    null ids last; of several rows with that id, the first as read.

    The rows that stay are found by their numbers alone; texts are moved once, to meet them."""
    hashed, by_fp = _grouped(docs, id_col, **options)
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    best = (hashed.select("id", "rid", "fp").join(by_fp.select("fp", "group_fp"), "fp")
            .groupBy("group_fp").agg(F.min(rank).alias("best")).select("best.rid"))
    return hashed.select("doc", "rid").join(best, "rid", "left_semi").select("doc.*")
