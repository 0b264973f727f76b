import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from llm_helpers import documents, no_documents, rows, words  # noqa: F401
from seasonflow.llm import quality as Q
from seasonflow.llm.catalogue import QUERIES


def brute_counts(text):
    text = text or ""
    w = words(text)
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup,
            len(covered))


def brute_keeps(rows):
    """The same estimator over whole groups in memory: medians and quartiles, then steps
    on the nearest three quarters (up to the end of a distance bin)."""
    groups = {}
    for key, v in rows:
        groups.setdefault(key, []).append(v)
    small = {k: v for k, v in groups.items() if len(v) < Q.MIN_GROUP}
    pools, out = {}, {}
    for (lang, _), v in small.items():
        pools.setdefault(lang, []).extend(v)
    rest = [x for v in pools.values() if len(v) < Q.MIN_GROUP for x in v]
    for key, v in groups.items():
        sample = v
        if key in small:
            sample = pools[key[0]] if len(pools[key[0]]) >= Q.MIN_GROUP else rest
        if len(sample) < Q.MIN_GROUP:
            out[key] = None
            continue
        x = np.array(sample, float) / Q.SCALE
        q = np.percentile(x, [25, 50, 75], axis=0)
        mean, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)
        for _ in range(Q.STEPS):
            d = distances(x, mean, cov)
            bins = np.floor(np.log2(d + 1) * Q.BINS)
            near = bins <= np.sort(bins)[int(np.ceil(Q.COVERAGE * len(x))) - 1]
            mean, cov = x[near].mean(0), np.cov(x[near].T, bias=True) * Q.consistency()
        out[key] = (mean, cov)
    return out


def distances(x, mean, cov):
    w = np.linalg.inv(cov + np.diag(np.square(Q.FLOORS)))
    return np.einsum("ij,jk,ik->i", x - mean, w, x - mean)


def test_query_matches_brute_force(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, SF_ORACLE).collect()}
    assert set(got) == set(docs)
    vectors = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select(
        "doc_id", Q.counts(F.col("text")).alias("c")).select("doc_id", "c.*").select(
        "doc_id", *Q.vector()).collect()
    vectors = {r["doc_id"]: [r[v] for v in Q.VECTOR] for r in vectors}
    good = []
    for i, d in docs.items():
        n, chars, symbols, dup, repeat = brute_counts(d["text"])
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        if not r["base_failed"]:
            good.append(((d["lang"], d["source"]), vectors[i]))
    estimates = brute_keeps(good)
    for i, d in docs.items():
        r = got[i]
        if r["base_failed"]:
            assert not r["kept"]
            continue
        estimate = estimates[d["lang"], d["source"]]
        if estimate is None:
            assert r["kept"] and r["distance"] is None
        else:
            d2 = distances(np.array([vectors[i]]) / Q.SCALE, *estimate)[0]
            assert abs(d2 - r["distance"]) < 1e-6 * max(1, d2)
            assert r["kept"] == (d2 <= Q.CUTOFF)


def test_consistency_factor():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200_000, 4))
    d = (x ** 2).sum(1)
    inside = x[d <= np.quantile(d, Q.COVERAGE)]
    assert abs(np.cov(inside.T)[0, 0] * Q.consistency() - 1) < 0.02


def test_junk_goes_and_clean_documents_stay(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    got = QUERIES["op3_quality"](spark, SF_ORACLE).where("not base_failed").join(labels, "doc_id")
    rate = {r["quality"]: r["kept"] for r in got.groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rate[1] == 1.0 and rate[0] < 0.2


def test_each_coordinate_rejects_its_outlier_alone(spark):
    """One planted document for each coordinate beside clean ones of one group, some of
    which have a first symbol or one repeated line."""
    rng = random.Random(5)

    def text(n, width=5):
        return [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(width - 2, width + 2)))
                         for _ in range(10)) for _ in range(n)]

    clean = [text(rng.randint(8, 20)) for _ in range(300)]
    clean[0].append("#")
    clean[1].append("a short line")
    clean[1].append("a short line")
    menu = [f"{a}{b}" for a in "abcde" for b in "vwxyz"]
    # in varying order: no window of five words comes twice often enough for the base rule
    lines = text(20) + [x for _ in range(40) for x in rng.sample(menu, len(menu))]
    passage = " ".join(text(5)).split()[:45]
    repeats = " ".join(text(38)).split() + passage + ["x"] + passage
    planted = {1000: text(10, 20), 1001: [x.replace("a", "#") for x in text(10)], 1002: lines,
               1003: [" ".join(repeats)]}
    docs = [(i, "\n".join(t), "en", "a") for i, t in [*enumerate(clean), *planted.items()]]
    got = {r["doc_id"]: r for r in Q.judge(spark.createDataFrame(
        docs, "doc_id long, text string, lang string, source string")).select(
        "doc.doc_id", *Q.COUNTS, "base_failed", "distance", "kept").collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert got[1002]["n_dup_lines"] > 0.9 * got[1002]["n_lines"]
    assert [i for i in planted if got[i]["kept"]] == []
    assert all(got[i]["kept"] for i in range(len(clean)))


def test_awkward_rows(documents, rows, no_documents):
    got = Q.judge(documents)
    assert "est" in got.select("doc.*").columns
    out = got.select("doc.doc_id", "n_words", "kept", "base_failed").collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] in (100, 101, 102):
            assert r["n_words"] == 0 and r["base_failed"] and not r["kept"]
    assert sorted(Q.kept_documents(documents).columns) == sorted(documents.columns)
    assert Q.judge(no_documents).count() == 0
