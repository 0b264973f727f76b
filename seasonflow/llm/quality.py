"""Quality rules: robust multivariate outliers of per-document statistics.

Base statistics come from one pass over the whole texts. Per language and source the
minimum-covariance-determinant (MCD) location and scatter of the transformed statistic
vectors are estimated, and documents far from them in Mahalanobis distance are
rejected. The estimate is deterministic: it starts from coordinate-wise medians and
MADs, and each concentration step takes mean and covariance of the half of the group
that is nearest under the last estimate. A step is two grouped aggregates over the
narrow statistics table: a histogram of distances that gives the group's radius, and
the sums of integers that give its moments. So a group may hold a third of all rows,
partial sums run in every task, and the result does not depend on partitioning.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, small_side, under, written

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Base rule: fewer words than this, or a larger percentage of repeated words, fails.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# --- the statistic vector ------------------------------------------------------------
VECTOR = ("v_length", "v_symbols", "v_lines", "v_repeats")
#: Values are held as integers of this many units, so that sums are exact.
SCALE = 256
#: Least standard deviation of each coordinate, in transformed units: a coordinate that
#: hardly varies in a group (no symbols, no repeated lines) must not reject a document
#: for its first symbol or line. But an extreme value of each coordinate must be able to
#: pass CUTOFF alone: its range over its floor is above the root of CUTOFF (log1p(100)
#: for lines, log1p(20) for the repeated words that the base rule lets through).
FLOORS = (0.10, 0.45, 0.60, 0.43)
#: Share of a group that the scatter is concentrated on.
COVERAGE = 0.75
STEPS = 4
#: Smallest group that gets an estimate of its own. Smaller ones are pooled by language,
#: and pools that stay smaller are pooled over all languages.
MIN_GROUP = 50
#: Squared Mahalanobis distance beyond which a document is rejected. The scatter is
#: scaled so that squared distances of normal vectors are chi-squared with four degrees
#: of freedom, which pass this once in some ten million documents; the rest of the
#: margin is for coordinates with heavier tails.
CUTOFF = 40.0
#: Words of the language's usual length that every text is smoothed with, so that the
#: ratios of a text of a dozen words do not look extreme.
PRIOR_WORDS, PRIOR_CHARS = 30, 5
#: Lines and words without a repeat that the repeats of every text are smoothed with, for
#: the same reason: one repeated line of a short text counts in both.
PRIOR_LINES, PRIOR_UNREPEATED = 30, 100
#: Bins of the distance histogram for each doubling of the squared distance.
BINS = 32


def repeated_words(tokens: list[bytes]) -> int:
    """Words in WINDOW-word windows that occur twice or more in the text.

    Windows are numbered exactly, one word at a time, by ranks of (number, next word)."""
    n = len(tokens) - WINDOW + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.int64, len(tokens))
    code = ids[:n]
    for k in range(1, WINDOW):
        _, code = np.unique(code * len(number) + ids[k:k + n], return_inverse=True)
    twice = np.bincount(code)[code] > 1
    if not twice.any():
        return 0
    steps = np.zeros(len(tokens) + 1, np.int64)
    steps[:n] += twice
    steps[WINDOW:] -= twice
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def text_counts(text: bytes) -> tuple:
    """COUNTS of one text."""
    tokens = text.split()
    chars = len(text.translate(None, SPACE).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(tokens), chars, symbols, len(lines), len(lines) - len(set(lines)),
            repeated_words(tokens))


def counts(text: Column) -> Column:
    """Struct of COUNTS of a text; a null text has none of anything."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t or b"") for t in texts], columns=COUNTS, dtype="int64")

    return of(text.cast("binary"))


def vector() -> list[Column]:
    """The transformed statistics as integers: smoothed mean word length, and smoothed
    symbols, repeated lines and repeated words per hundred."""
    n = F.col("n_words") + PRIOR_WORDS
    values = [F.log((F.col("word_chars") + PRIOR_CHARS * PRIOR_WORDS) / n),
              F.log1p(100 * F.col("n_symbols") / n),
              F.log1p(100 * F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES)),
              F.log1p(100 * F.col("n_repeat_words") / (F.col("n_words") + PRIOR_UNREPEATED))]
    return [F.round(v * SCALE).cast("long").alias(name) for v, name in zip(values, VECTOR)]


# --- the estimate --------------------------------------------------------------------

_P = len(VECTOR)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_ESTIMATE = ("est long, " + ", ".join(f"m{i} double" for i in range(_P)) + ", "
             + ", ".join(f"w{i}{j} double" for i, j in _PAIRS))


def _chi2(x: float, dof: int) -> float:
    """Distribution function of chi-squared with an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for k in range(1, dof // 2):
        term *= half / k
        total += term
    return 1 - math.exp(-half) * total


def consistency(coverage: float = COVERAGE) -> float:
    """Factor that makes the covariance of the nearest part of a normal sample that of
    the whole."""
    low, high = 0.0, 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2(mid, _P) < coverage else (low, mid)
    return coverage / _chi2(low, _P + 2)


def weights(covariance: np.ndarray) -> list[float]:
    """Entries of the inverse of a scatter matrix (in transformed units) after the floors
    are added to its diagonal."""
    inverse = np.linalg.inv(covariance + np.diag(np.square(FLOORS)))
    return [float(inverse[i, j]) for i, j in _PAIRS]


def distance() -> Column:
    """Squared Mahalanobis distance of a row joined to its estimate."""
    off = [F.col(v) / SCALE - F.col(f"m{i}") for i, v in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + off[i] * off[j] * F.col(f"w{i}{j}") * (1 if i == j else 2)
    return total


def _groups(good: DataFrame) -> DataFrame:
    """(lang, source, est): the group whose estimate applies, null if there is none."""

    def key(level, *cols):
        parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
        return F.xxhash64(F.lit(level), *parts)

    sizes = good.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pool = F.sum(F.when(F.col("n") < MIN_GROUP, F.col("n")))
    by_lang = sizes.withColumn("n_lang", pool.over(Window.partitionBy("lang")))
    rest = F.sum(F.when((F.col("n") < MIN_GROUP) & (F.col("n_lang") < MIN_GROUP), F.col("n")))
    pooled = by_lang.withColumn("n_all", rest.over(Window.partitionBy(F.lit(0))))
    return written(pooled.select("lang", "source", F.when(
        F.col("n") >= MIN_GROUP, key("source", "lang", "source")).when(
        F.col("n_lang") >= MIN_GROUP, key("lang", "lang")).when(
        F.col("n_all") >= MIN_GROUP, key("all")).alias("est")), "groups")


def _first_estimate(stats: DataFrame) -> DataFrame:
    """Medians and interquartile ranges (exact: the values are a few thousand integers,
    whose counts are merged)."""
    quartiles = stats.groupBy("est").agg(*[
        F.percentile(v, F.lit([0.25, 0.5, 0.75])).alias(v) for v in VECTOR])

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                q = np.array([getattr(row, v) for v in VECTOR], float) / SCALE
                scale = (q[:, 2] - q[:, 0]) / 1.349
                out.append([row.est, *q[:, 1], *weights(np.diag(scale ** 2))])
            yield pd.DataFrame(out, columns=names)

    names = [f.split()[0] for f in _ESTIMATE.split(", ")]
    return written(quartiles.mapInPandas(run, _ESTIMATE), "estimate")


def _concentrate(stats: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: mean and covariance of the nearest COVERAGE of each group."""
    bin_ = F.floor(F.log2(distance() + 1) * BINS)
    moments = [F.count("*").alias("n"), *(F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)),
               *(F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"s{i}{j}") for i, j in _PAIRS)]
    binned = (stats.join(small_side(estimate), "est").withColumn("bin", bin_)
              .groupBy("est", "bin").agg(*moments))
    upto = Window.partitionBy("est").orderBy("bin")
    names = [c for c in binned.columns if c not in ("est", "bin")]
    run_sums = binned.select("est", "bin", F.sum("n").over(Window.partitionBy("est")).alias("all"),
                             *(F.sum(c).over(upto).alias(c) for c in names))
    core = (run_sums.where(F.col("n") >= COVERAGE * F.col("all"))
            .groupBy("est").agg(F.min_by(F.struct(*names), "bin").alias("s")).select("est", "s.*"))
    factor = consistency()
    columns = [f.split()[0] for f in _ESTIMATE.split(", ")]

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                n = row["n"]
                mean = np.array([row[f"s{i}"] for i in range(_P)], float) / n
                second = np.zeros((_P, _P))
                for i, j in _PAIRS:
                    second[i, j] = second[j, i] = row[f"s{i}{j}"] / n
                cov = (second - np.outer(mean, mean)) / SCALE ** 2 * factor
                out.append([row["est"], *(mean / SCALE), *weights(cov)])
            yield pd.DataFrame(out, columns=columns)

    return written(core.mapInPandas(run, _ESTIMATE), "estimate")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", cutoff: float = CUTOFF,
          keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, default all, under ``doc``) with COUNTS,
    base_failed, distance (null where no estimate applies) and kept.

    A null or empty text has no words and fails the base rule. Null languages and sources
    are groups of their own. Documents of groups too small for an estimate, pools
    included, are judged by the base rule alone. Repeated rows count and are judged each.
    An empty table gives an empty result; extra columns stay inside ``doc``.
    """
    rows = docs.select(under("doc", docs, keep), F.col(f"`{lang_col}`").alias("lang"),
                       F.col(f"`{source_col}`").alias("source"),
                       counts(F.col(f"`{text_col}`")).alias("c"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = written(rows.select("doc", "lang", "source", "c.*").select(
        "*", *vector(), failed.alias("base_failed")), "statistics")
    good = rows.where("not base_failed").select("lang", "source", *VECTOR)
    groups = _groups(good)
    same = (F.col("r.lang").eqNullSafe(F.col("g.lang"))
            & F.col("r.source").eqNullSafe(F.col("g.source")))
    stats = written(good.alias("r").join(small_side(groups).alias("g"), same)
                    .where("est is not null").select("est", *VECTOR), "vectors")
    estimate = _first_estimate(stats)
    for _ in range(STEPS):
        better = _concentrate(stats, estimate)
        discard(estimate)
        estimate = better
    discard(stats)
    measured = (rows.alias("r").join(small_side(groups).alias("g"), same, "left")
                .select("r.*", "g.est").join(small_side(estimate), "est", "left"))
    return measured.withColumn("distance", distance()).select(
        "doc", *COUNTS, "base_failed",
        F.when(~F.col("base_failed"), F.col("distance")).alias("distance"),
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"))


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that the rules reject."""
    return judge(docs, **options).where("kept").select("doc.*")
