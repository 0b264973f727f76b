"""Near-duplicate embeddings by a subspace pigeonhole join.

For unit vectors ``cos >= t`` is ``|x - y|^2 <= D = 2 (1 - t)``. All vectors are rotated by
one orthogonal matrix and cut into BLOCKS of coordinates; each block has the share of
``D`` that its number of coordinates has of all. A pair within ``D`` is within its budget
in at least one block, so the union over blocks of the pairs within budget has every
link; each candidate is then verified by its exact cosine in double precision.

A block's range join is by strips of its leading coordinate: a vector is indexed in its
own strip and probes the strips that its radius touches. Strips are cut into tiles of
bounded size, and every pair of an index tile and a probe tile is one bounded group,
compared by matrix products. No pair leaves a group: a group returns, for each of its
vectors, how many links were found and the smallest vector it is connected to in this
group. A pair that qualifies in several blocks counts in the first of them only.
Vectors equal in every component are one node with a number of copies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, small_side, under, written

BLOCKS = 4
#: Rows of an index or probe tile, on average.
TILE = 4_096
_CHUNK = 512
_SLACK = 1e-9
SEED = 42


def rotation(dim: int) -> np.ndarray:
    """A seeded random orthogonal matrix (Gram-Schmidt on normal vectors)."""
    rows = np.random.default_rng(SEED).standard_normal((dim, dim))
    for i in range(dim):
        for _ in range(2):  # twice is enough for full precision
            rows[i] -= np.einsum("k,kj->j", np.einsum("kj,j->k", rows[:i], rows[i]), rows[:i])
        rows[i] /= np.sqrt(np.einsum("j,j->", rows[i], rows[i]))
    return rows


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow for large components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def rotated(units: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Row-wise products; each row's value does not depend on the rows beside it."""
    return np.einsum("kj,ij->ik", matrix, units)


def blocks_of(dim: int) -> list[tuple[int, int]]:
    n = min(BLOCKS, dim)
    cuts = [round(i * dim / n) for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def budgets(dim: int, threshold: float) -> np.ndarray:
    return np.array([2 * (1 - threshold) * (b - a) / dim + _SLACK for a, b in blocks_of(dim)])


def usable(vector: Column) -> Column:
    """Not null, with finite components only, and not all zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def _strips(threshold: float):
    """Keys of each vector: (block, strip, role), role 0 to be found, 1 to probe."""

    def run(vectors: pd.Series) -> pd.Series:
        out = [None] * len(vectors)
        dims = vectors.map(len).to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            points = rotated(unit(np.stack(vectors.iloc[at].to_numpy()).astype(float)),
                             rotation(int(dim)))
            lead = points[:, [a for a, _ in blocks_of(int(dim))]]
            radius = np.sqrt(budgets(int(dim), threshold)) + _SLACK
            width = 2 * radius
            own = np.floor(lead / width).astype(int)
            low = np.floor((lead - radius) / width).astype(int)
            high = np.floor((lead + radius) / width).astype(int)
            for row, i in enumerate(at):
                keys = [(j, int(s), 0) for j, s in enumerate(own[row])]
                keys += [(j, s, 1) for j, (x, y) in enumerate(zip(low[row], high[row]))
                         for s in range(int(x), int(y) + 1)]
                out[i] = [{"block": j, "strip": s, "role": r} for j, s, r in keys]
        return pd.Series(out)

    return F.pandas_udf(run, "array<struct<block:int,strip:int,role:int>>")


def _smallest(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets that the edges (a, b) join, in place. A label is the smallest member
    of its set, before and after: the old roots are lowered too, so edges that come in
    parts give the same sets as all at once."""
    while True:
        a, b = labels[a], labels[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _compare(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, dim = int(key[2]), int(key[1])
        index, probe = (rows[rows["role"] == r] for r in (0, 1))
        empty = pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        if index.empty or probe.empty:
            return empty
        matrix, spans, budget = rotation(dim), blocks_of(dim), budgets(dim, threshold)
        lo, hi = spans[block]
        starts = [a for a, _ in spans]
        nodes = np.concatenate([index["node"], probe["node"]]).astype(np.int64)
        names, where = np.unique(nodes, return_inverse=True)
        ax, px = where[:len(index)], where[len(index):]
        au, pu = (unit(np.stack(t["vec"].to_numpy()).astype(float)) for t in (index, probe))
        ar, pr = rotated(au, matrix), rotated(pu, matrix)
        weight = np.zeros(len(names), np.int64)
        weight[ax], weight[px] = index["n"].to_numpy(), probe["n"].to_numpy()
        links, labels = np.zeros(len(names), np.int64), np.arange(len(names))
        pb = pr[:, lo:hi]
        pb2 = np.einsum("ij,ij->i", pb, pb)
        for i in range(0, len(ax), _CHUNK):
            ab = ar[i:i + _CHUNK, lo:hi]
            near = (np.einsum("ij,ij->i", ab, ab)[:, None] + pb2 - 2 * ab @ pb.T
                    <= budget[block] + _SLACK)
            near &= ax[i:i + _CHUNK, None] < px  # names are sorted: the smaller node is found
            x, y = np.nonzero(near)
            if not len(x):
                continue
            x += i
            for part in range(0, len(x), 1 << 17):
                a, b = x[part:part + (1 << 17)], y[part:part + (1 << 17)]
                within = np.add.reduceat((ar[a] - pr[b]) ** 2, starts, axis=1) <= budget
                first = within[:, block] & ~within[:, :block].any(axis=1)
                a, b = a[first], b[first]
                ok = np.einsum("ij,ij->i", au[a], pu[b]) >= threshold
                a, b = ax[a[ok]], px[b[ok]]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                _smallest(labels, a, b)
        touched = np.flatnonzero(links)
        return pd.DataFrame({"node": names[touched], "links": links[touched],
                             "root": names[labels[touched]]})

    return run


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93,
                    keep: list[str] | None = None) -> DataFrame:
    """Every row of ``table`` (columns ``keep``, default all, under ``row``) with n_links
    (other rows of its label with a cosine of at least ``threshold``), component_id (the
    smallest id reachable by links, its own included) and kept (id = component_id).

    Rows with a null label, or with a vector that is null, empty, all zero or has null or
    non-finite components, have no links. Vectors are compared with those of equal
    dimension. Null ids are passed over as component ids. Repeated rows are linked to
    each other. An empty table gives an empty result.
    """
    vec, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    rows = written(table.select(
        under("row", table, keep), F.col(f"`{id_col}`").alias("id"), label.alias("label"),
        F.when(usable(vec) & label.isNotNull(), vec).alias("vec"),
        F.monotonically_increasing_id().alias("rid"))
        .withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(1), "vec")}), "vectors")
    nodes = written(
        rows.where("vec is not null").groupBy("label", "k1", "k2").agg(
            F.count("*").alias("n"), F.min("id").alias("first"), F.min_by("vec", "rid").alias("vec"))
        .select("label", "k1", "k2", "n", "first", "vec",
                F.monotonically_increasing_id().alias("node"), F.size("vec").alias("dim"),
                _strips(threshold)("vec").alias("keys")), "nodes")
    keyed = nodes.select("label", "dim", "node", "n", "vec", F.explode("keys").alias("k")).select(
        "label", "dim", "node", "n", "vec", "k.*")
    cell = ["label", "dim", "block", "strip"]
    sizes = written(keyed.groupBy(*cell).agg(
        F.ceil(F.sum(1 - F.col("role")) / TILE).alias("index_tiles"),
        F.ceil(F.sum("role") / TILE).alias("probe_tiles"))
        .where("index_tiles > 0 and probe_tiles > 0"), "cells")
    found = F.col("role") == 0
    own = F.pmod(F.xxhash64("node"), F.when(found, F.col("index_tiles")).otherwise(F.col("probe_tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(
        found, F.col("probe_tiles")).otherwise(F.col("index_tiles")) - 1))
    tiled = keyed.join(small_side(sizes), cell).withColumns({"own": own}).withColumn(
        "other", other).withColumns({
            "a": F.when(found, F.col("own")).otherwise(F.col("other")),
            "b": F.when(found, F.col("other")).otherwise(F.col("own"))})
    linked = written(tiled.select(*cell, "a", "b", "node", "n", "vec", "role")
                     .groupBy(*cell, "a", "b")
                     .applyInPandas(_compare(threshold), "node long, links long, root long"), "links")
    totals = linked.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (nodes.select("label", "k1", "k2", "n", "first", "node").join(groups, "node", "left")
             .join(totals, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    named = written(named, "named")
    ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_key = written(named.join(ids, "component").select(
        "label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        "component_id"), "by_key")
    out = rows.select("row", "id", F.when(F.col("vec").isNotNull(), F.col("label")).alias("label"),
                      "k1", "k2").join(by_key, ["label", "k1", "k2"], "left")
    component = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("row", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
