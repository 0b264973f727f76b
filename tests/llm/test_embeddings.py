import random

import numpy as np

from conftest import SF_SMALL
from llm_helpers import union_find
from seasonflow.llm import embeddings as E
from seasonflow.llm.catalogue import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.93):
    """n_links and component of every row (by position)."""
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    scaled = {k: np.array(rows[k][1], float) / max(map(abs, rows[k][1])) for k in good}
    unit = {k: v / np.linalg.norm(v) for k, v in scaled.items()}
    edges = [(a, b) for i, a in enumerate(good) for b in good[i + 1:]
             if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])
             and unit[a] @ unit[b] >= threshold]
    group = union_find(range(len(rows)), edges)
    smallest = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            smallest[group[k]] = min(i, smallest.get(group[k], i))
    links = [0] * len(rows)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    return sorted((str(r[0]), links[k], str(smallest.get(group[k]))) for k, r in enumerate(rows))


def run(df):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in
                  E.near_duplicates(df).select("row.vec_id", "n_links", "component_id").collect())


def clustered(dim, n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(6):
        centre = rng.standard_normal(dim)
        spread = [0.02, 0.15, 0.25, 0.27, 0.3, 0.5][c]
        out += [(len(out) + i, (centre + spread * rng.standard_normal(dim)).tolist(), c % 2)
                for i in range(n)]
    return out


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op9_embeddings"](spark, SF_SMALL).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_links_near_the_threshold_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 20)
    rows = clustered(24, 40, 1)
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_chains_over_several_chunks_of_a_tile(spark, monkeypatch):
    """Chains whose neighbours alone are linked: no other link can mend a lost one."""
    monkeypatch.setattr(E, "TILE", 4_096)
    monkeypatch.setattr(E, "_CHUNK", 4)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        x, y = np.linalg.qr(rng.standard_normal((8, 2)))[0].T
        rows += [(0, (np.cos(t) * x + np.sin(t) * y).tolist(), 0) for t in np.arange(14) * np.pi / 9]
    rows = [(i, v, label) for i, (_, v, label) in zip(rng.permutation(len(rows)).tolist(), rows)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_labels_of_edges_in_parts():
    labels = np.arange(6)
    for a, b in (([2], [5]), ([1], [5]), ([4, 3], [5, 4])):
        E._smallest(labels, np.array(a), np.array(b))
    assert labels.tolist() == [0, 1, 1, 1, 1, 1]


def test_awkward_rows(spark):
    rows = clustered(8, 10, 2)
    v = rows[0][1]
    rows += [(900, None, 0), (901, [0.0] * 8, 0), (902, [None] + v[1:], 0),
             (903, [float("nan")] + v[1:], 0), (904, [float("inf")] + v[1:], 0), (905, v, None),
             (906, [], 0), (None, v, 0), (907, v, 0), (907, v, 0), (908, [x * 1e200 for x in v], 0),
             (909, [1.0], 0), (910, [2.0], 0), (911, [1.0, 0.0], 0), (None, [0.0, 3.0], 5)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "node", "vec", "keys", "row", "k1"):
        df = df.withColumn(name, df["vec_id"])
    got = E.near_duplicates(df)
    assert "rid" in got.select("row.*").columns
    assert run(df) == brute(rows)
    kept = {r["vec_id"]: r["kept"] for r in got.select("row.vec_id", "kept").collect()}
    assert kept[905] and kept[900] and not kept[None] and not kept[907]
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
