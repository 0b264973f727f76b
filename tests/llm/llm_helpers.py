"""Small tables with every awkward row (nulls, empty and long texts, repeated rows, ties,
extra columns whose names the operators use themselves) and reference helpers."""

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASHING = ["rid", "fp", "doc", "size", "norm", "line_no", "est", "prob", "id", "tail", "path"]


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta",
                                "theta", "iota", "kappa", "lambda", "mu"]) + str(rng.randint(0, 60))
                    for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(30):
        text = "\n".join(sentence(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 5)))
        out.append((i, text, rng.choice(["en", "de"]), rng.choice(["a", "b", "c", "é"]), len(text)))
    long = sentence(rng, 6000) + "\n" + sentence(rng, 300)
    first = out[0][1]
    passage = sentence(rng, 50)
    near = sentence(rng, 400).split(" ")
    out += [
        (100, None, "en", "a", None), (101, "", "en", "a", 0), (102, " \t\n", None, None, 3),
        (None, sentence(rng, 30), "en", None, 1), (103, long, "en", "b", 9),
        (104, first, "en", "a", 1), (104, first, "en", "a", 1), (105, first, "de", "b", 2),
        (106, passage, "en", "a", 1), (107, "x y " + passage + " z", "en", "c", 1),
        (108, passage + "\n" + passage, "en", "c", 1), (109, "one", None, "c", 1),
        (110, " ".join(near), "en", "a", 1), (111, " ".join(near[:-1] + ["other"]), "en", "a", 1),
        (112, "ener, " * 500, "en", "a", 1), (113, "Released under the MIT License.", "en", "a", 1),
        (114, "### $$$ *** <<<>>> |||", "de", "c", 1),
    ]
    return out


@pytest.fixture(scope="session")
def documents(spark, rows):
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, df["n_chars"] + 1)
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def union_find(nodes, edges):
    """Smallest reachable node for every node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def words(text):
    return (text or "").encode().split()
