"""Mixing sources to target weights by balanced sampling (the cube method).

Targets: the sources, ordered by code point with null last, weigh 5, 2, 1, repeating,
and share a budget of tokens; a target stops at a multiple of its source's size and
the excess is shared again by weight, which is water-filling with a closed form over
the sources in order of size / weight.

A source's target over its size gives each of its documents the same expected number
of copies: a whole part that every document gets, and a fraction that becomes an
inclusion probability. The cube method turns the probabilities into 0 or 1: its flight
phase moves them along the null-space of two balancing constraints (documents and
tokens), so both totals stay what they were, until no more than two probabilities are
left between 0 and 1. It runs in blocks of bounded size in parallel; the few
documents still undecided in each block meet in the next level's blocks, until a
source has one block. There the flight holds back a few documents of all sizes, which
with its own last two are the landing problem, solved by trying all ways.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, under, words, written

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_COPIES = 2
BLOCK = 2_000
#: Units of a source's last block that the flight leaves to the landing, of all sizes.
HELD = 10
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Number of words, 0 for a null text, as a long."""
    return F.size(words(text)).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET,
            max_copies: int = MAX_COPIES) -> DataFrame:
    """``sources`` (one row per source: source, source_size, docs) with ``target``.

    One row per source is all that the windows here see; its size does not follow
    the number of documents. A target that is met at the cap is exactly the cap.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    capped = sources.withColumn("weight", pick).withColumn(
        "cap", F.col("source_size").cast("double") * max_copies)
    whole = Window.partitionBy(F.lit(0))
    by_ratio = whole.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (F.sum("source_size").over(whole) * budget
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    level = left / F.sum("weight").over(after)  # if this source and all later ones are free
    leveled = capped.withColumns({"level": level, "place": F.row_number().over(by_ratio)})
    # Sources before the first one that stays below its cap are at their caps; from it
    # on, all share at its level.
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                        F.struct("place", "level"))).over(whole)
    return leveled.withColumn("target", F.least(
        "cap", F.coalesce(free["level"] * F.col("weight"), F.col("cap")))).drop(
            "weight", "cap", "level", "place")


def flight(prob: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Flight phase for the constraints "documents" and "tokens" on units of equal
    initial probability: three units at a time move along the cross product of the
    two constraint rows until one of them is decided. ``draw[i]`` decides the direction
    of step ``i``. At most two probabilities stay between 0 and 1."""
    prob = prob.copy()
    active: list[int] = []
    step = 0
    for unit in range(len(prob) + 1):
        if unit < len(prob):
            if _EPS < prob[unit] < 1 - _EPS:
                active.append(unit)
        while len(active) == 3 or (unit == len(prob) and len(active) == 2
                                   and size[active[0]] == size[active[1]]):
            if len(active) == 3:
                a, b, c = (float(size[i]) for i in active)
                move = (c - b, a - c, b - a)
            else:
                move = (1.0, -1.0)
            if not any(move):
                move = (1.0, -1.0, 0.0)
            scale = max(abs(m) for m in move)
            move = [m / scale for m in move]
            up = min((1 - prob[i]) / m if m > 0 else prob[i] / -m
                     for i, m in zip(active, move) if m)
            down = min(prob[i] / m if m > 0 else (1 - prob[i]) / -m
                       for i, m in zip(active, move) if m)
            by = up if draw[step] * (up + down) < down else -down
            step += 1
            for i, m in zip(active, move):
                p = prob[i] + by * m
                prob[i] = 0.0 if p < _EPS else 1.0 if p > 1 - _EPS else p
            active = [i for i in active if 0.0 < prob[i] < 1.0]
    return prob


def spread(n: int, held: int = HELD) -> np.ndarray:
    """Evenly spaced places among ``n``: units that the flight leaves to the landing."""
    return np.unique(np.linspace(0, n - 1, min(n, held)).round().astype(int))


def land(prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing phase: of all ways to decide the open units (a dozen at most), the one whose
    token total is nearest to the expected one; a document too many or too few weighs as
    much as a hundredth of a document's tokens."""
    open_units = np.flatnonzero((prob > 0) & (prob < 1))
    ways = (np.arange(1 << len(open_units))[:, None] >> np.arange(len(open_units)) & 1).astype(float)
    off = ways - prob[open_units]
    cost = (np.abs((off * size[open_units]).sum(axis=1))
            + np.abs(off.sum(axis=1)) * size.mean() / 100)
    prob = prob.copy()
    prob[open_units] = ways[int(np.argmin(cost))]
    return prob


def _decide(units: DataFrame, seed: int) -> DataFrame:
    """One level: units (rid, source, size, mark, prob, blocks) with new probabilities.

    A unit's block is a hash of its mark, so the result does not depend on the
    partitions that the rows arrive in. Large documents go first: the ones left open at
    the end are then small."""
    schema = "rid long, source string, size long, mark long, prob double"

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "mark", "rid"], ascending=[False, True, True],
                                  ignore_index=True)
        sizes = block["size"].to_numpy()
        rng = np.random.default_rng([seed, len(block), int(block["mark"].iloc[0]) & 0x7FFFFFFF])
        prob, last = block["prob"].to_numpy(float, copy=True), block["blocks"].iloc[0] == 1
        fly = np.ones(len(block), bool)
        if last:
            fly[spread(len(block))] = False
        prob[fly] = flight(prob[fly], sizes[fly], rng.random(len(block) + 3))
        if last:
            prob = land(prob, sizes)
        return block.assign(prob=prob)[["rid", "source", "size", "mark", "prob"]]

    blocked = units.withColumn("block", F.pmod(F.xxhash64("mark", F.lit(seed)), F.col("blocks")))
    return blocked.groupBy("source", "block").applyInPandas(run, schema)


def balanced_sample(units: DataFrame, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """(rid, taken 0/1) for units (rid, source, size, mark, prob) with one probability for
    each source. Levels repeat until every source fits one block; each keeps two units
    of a block at most, so there are about log(units) / log(block / 2) levels."""
    decided, level = None, 0
    while True:
        count = units.groupBy("source").agg(F.count("*").alias("n"))
        blocks = written(count.select("source", F.ceil(F.col("n") / block).alias("blocks")),
                         "blocks")
        sized = units.alias("u").join(
            small_side(blocks).alias("b"), F.col("u.source").eqNullSafe(F.col("b.source"))
        ).select("u.*", "b.blocks")
        moved = written(_decide(sized, seed + level), f"flight{level}")
        done = moved.where("prob = 0 or prob = 1").select("rid", F.col("prob").alias("taken"))
        decided = done if decided is None else decided.union(done)
        units = moved.where("prob > 0 and prob < 1")
        level += 1
        if blocks.where("blocks > 1").isEmpty():
            return decided


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple = WEIGHTS, budget: float = BUDGET,
        max_copies: int = MAX_COPIES, seed: int = 42,
        keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and copies; its columns
    ``keep`` (default all) are under ``doc``.

    A null text has size 0; a null source is a source of its own, the last. Documents
    of size 0 take part in the document total only. Repeated rows are units of their
    own. An empty table gives an empty result. Extra columns stay inside ``doc``.
    The draw is seeded by a hash of each document's id and text, so reruns agree
    whatever the partitioning; only equal rows are interchangeable.
    """
    rows = written(docs.select(
        under("doc", docs, keep), F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("mark"),
        F.monotonically_increasing_id().alias("rid")), "sized")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(sources, weights, budget, max_copies).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        .otherwise(0.0).alias("ratio")), "goals")
    goal = small_side(goals).alias("g")
    rated = rows.alias("r").join(goal, F.col("r.source").eqNullSafe(F.col("g.source")))
    units = rated.select("r.rid", "r.source", "r.size", "r.mark",
                         (F.col("g.ratio") - F.floor("g.ratio")).alias("prob"))
    drawn = balanced_sample(units.where((F.col("prob") > _EPS) & (F.col("prob") < 1 - _EPS)),
                            seed=seed)
    # a probability within the tolerance of 0 or 1 is that number
    whole = F.floor(F.col("ratio") + _EPS)
    return (rated.select("r.*", "g.source_size", "g.target", "g.ratio")
            .join(drawn, "rid", "left")
            .withColumn("copies", (whole + F.coalesce("taken", F.lit(0.0))).cast("long"))
            .drop("taken", "ratio", "mark"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies."""
    return (mix(docs, **options).where("copies > 0")
            .select("doc", F.explode(F.expr("sequence(1, copies)"))).select("doc.*"))
