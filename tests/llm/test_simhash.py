import itertools
import random

import xxhash

from conftest import SF_SMALL
from llm_helpers import documents, no_documents, rows, union_find  # noqa: F401
from seasonflow.llm import simhash
from seasonflow.llm.catalogue import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def brute_fingerprint(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in SPACE else c for c in lowered).split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or (
        [" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius=3):
    distinct = sorted(set(fps))
    edges = [(a, b) for a, b in itertools.combinations(distinct, 2)
             if (a ^ b).bit_count() <= radius]
    return union_find(distinct, edges)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    group = brute_groups(fps.values())
    smallest = {}
    for doc, fp in fps.items():
        g = group[fp]
        smallest[g] = min(doc, smallest.get(g, doc))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in QUERIES["op2_simhash"](spark, SF_SMALL).collect()}
    assert got == {d: (f"{fp:016x}", smallest[group[fp]]) for d, fp in fps.items()}


def test_links_in_dense_neighbourhoods(spark):
    """Chains and clusters of fingerprints a few bits apart, against all pairs."""
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
        step = rng.getrandbits(64)
        for _ in range(15):  # a chain whose ends are far apart
            fps.add(step)
            for b in rng.sample(range(64), 3):
                step ^= 1 << b
    table = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    got = {r["node"] % (1 << 64): r["component"] % (1 << 64)
           for r in simhash.link_groups(table).collect()}
    want = brute_groups(fps)
    members = {}
    for x in fps:
        members.setdefault(want[x], set()).add(x)
    for group in members.values():
        if len(group) == 1:
            assert not group & set(got)
        else:
            assert len({got[x] for x in group}) == 1
    assert len({got[x] for x in got}) == sum(len(g) > 1 for g in members.values())


def test_awkward_rows(documents, rows):
    got = simhash.near_duplicates(documents).select("doc.*", "fp", "component_id").drop("fp")
    out = simhash.near_duplicates(documents).select("doc.doc_id", "component_id", "fp").collect()
    assert len(out) == len(rows) and "rid" in got.columns
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[100]["fp"] == by_id[101]["fp"] == by_id[102]["fp"] == 0
    assert by_id[100]["component_id"] == by_id[101]["component_id"] == 100
    assert by_id[104]["component_id"] == by_id[105]["component_id"] == 0
    assert by_id[None]["component_id"] is None


def test_one_of_each_group_stays(documents, rows, no_documents):
    kept = [r["doc_id"] for r in simhash.first_of_groups(documents).collect()]
    group = brute_groups([brute_fingerprint(r[1]) for r in rows])
    assert len(kept) == len(set(group.values()))
    assert not {101, 102, 104, 105} & set(kept) and {0, 100, None} <= set(kept)
    assert simhash.first_of_groups(no_documents).count() == 0


def test_texts_meet_only_the_rows_that_stay(spark):
    """Rows that stay are found by their numbers: the columns of documents are in one join."""
    df = spark.createDataFrame([(2, "a b c d"), (1, "a b c d"), (None, "a b c d"), (3, "x y z w v")],
                               "doc_id long, text string")
    out = simhash.first_of_groups(df, shingle=3, radius=3)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    joins, above = [], []  # of every scan of the documents' columns, how many joins are above it
    for line in out._jdf.queryExecution().sparkPlan().toString().split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        joins = [d for d in joins if d < depth] + [depth] * ("Join " in line)
        above += [len(joins)] * ("FileScan parquet [doc#" in line)
    assert above == [1]
