import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from compare import assert_same, duck
from llm_helpers import documents, no_documents, rows  # noqa: F401
from seasonflow.llm import licences as LI
from seasonflow.llm import rollups as RO
from seasonflow.llm import urlfilter as U
from seasonflow.llm.catalogue import ORACLE, QUERIES, URL_RULES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_oracle(spark, name):
    assert_same(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])


# --- URL rules -----------------------------------------------------------------------

def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if r.name and (
        host == r.name.split("/", 1)[0] or host.endswith("." + r.name.split("/", 1)[0]))
        and path.startswith("/" + r.name.split("/", 1)[1])]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    block = any(not r.name and re.search(r.pattern, host + path) for r in URL_RULES)
    return host, path, None, "block" if block else "allow"


URLS = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/x", "http://a.example.org/en/12",
        "http://example.org/en/2", "http://notexample.org/es/", "http://org/", "http://org",
        "http://x.com/fr/", "http://x.com/FR/", "http://com/de/?a=://b", "http://x.com?/de/",
        "http://x.net/en#f", "http://cheap-pills.net/a", "http://x.net/Casino/1", "http://x.net/casinos",
        "http://casino.org/x", "a://b://c.org/", "http://x.net/a\nb/poker/", "http://É.org/es/",
        "http://example.org:80/es/", "http://u@example.org/es/", "://org/"]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, u) for i, u in enumerate(URLS * 2)],
                               "page_id long, url string, host string").withColumn("rid", F.lit(1))
    out = U.judge(df, URL_RULES).select("page.page_id", "host", "path", "rule", "verdict").collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        assert tuple(r)[1:] == brute_url(URLS[r["page_id"] % len(URLS)]), URLS[r["page_id"] % len(URLS)]
    assert U.judge(df.limit(0), URL_RULES).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    urls = spark.createDataFrame([(["example", "org", "es"],), (["example", "org"],), (["org"],)],
                                 "tokens array<string>")
    rules = spark.createDataFrame([(0, "p", "v", ["example", "org", "es"], "n"), (1, "p", "v", ["org"], "n"),
                                   (2, "p", "v", ["absent", "org"], "n")],
                                  "rule_id int, pattern string, verdict string, tokens array<string>, name string")
    got = {r["rule_id"]: r["token"] for r in U.rarest_token_index(urls, rules).collect()}
    assert got == {0: "es", 1: "org", 2: "absent"}


def test_no_python_on_the_native_paths(spark):
    for name in ("op6_fuzzy_lines", "op7_url_rules"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# --- rollups -------------------------------------------------------------------------

def test_batches_are_idempotent_and_survive_a_failed_attempt(spark, documents, scratch):
    counts = {t: f"n {t}" for t in RO.TOKENIZERS}
    docs = RO.counted(documents)
    rollup = RO.Rollup(spark, f"{scratch}/rollup-test")
    assert rollup.totals().count() == 0
    assert rollup.commit("a", RO.inserts(docs, counts))
    once = sorted(map(tuple, rollup.totals().collect()), key=str)
    assert not rollup.commit("a", RO.inserts(docs, counts))
    # an attempt that died before its commit has files but no marker
    RO.inserts(docs, counts).write.parquet(f"{rollup.path}/batch=b")
    fs, marker = rollup._fs(f"{rollup.path}/batch=b/_SUCCESS")
    fs.delete(marker, False)
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == once
    assert rollup.commit("b", RO.deletes(docs, counts)) and rollup.totals().count() == 0
    assert rollup.commit("c", RO.revisions(docs.limit(0), counts, counts))
    assert rollup.totals().count() == 0


def test_counts_of_awkward_rows(documents, rows, no_documents, spark):
    got = Counter()
    for r in RO.inserts(RO.counted(documents), {t: f"n {t}" for t in RO.TOKENIZERS}).collect():
        got[r["source"], r["lang"], r["tokenizer"]] += r["tokens"]
    want = Counter()
    for _, text, lang, source, _ in rows:
        want[source, lang, "words.v1"] += len((text or "").encode().split())
        want[source, lang, "words.v2"] += len(re.findall(RO.TOKENIZERS["words.v2"], text or ""))
    assert got == want
    assert RO.counted(no_documents).count() == 0


# --- licences ------------------------------------------------------------------------

def brute_scan(files, templates=LI.TEMPLATES):
    """Dense TF-IDF vectors over all tokens, then a walk up the directories."""
    df = Counter(t for _, text in files for t in set(LI.tokens(text or "")))
    vocab = {t for _, text in templates for t in LI.tokens(text)}
    n = len(files)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}

    def vector(tokens):
        v = {t: c * idf.get(t, math.log(1 + n) + 1) for t, c in Counter(tokens).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    refs = [(name, vector(LI.tokens(text))) for name, text in templates]

    def match(text):
        v = vector(LI.tokens(text))
        scores = [sum(v.get(t, 0) * x for t, x in ref.items()) for _, ref in refs]
        best = max(range(len(refs)), key=lambda i: (round(scores[i], 12), -i))
        return (refs[best][0], scores[best]) if scores[best] >= LI.THRESHOLD else None

    own = []
    for path, text in files:
        whole, found = match(text or ""), None
        if whole:
            found = (*whole, "file")
        else:
            lines = [m for m in map(match, (text or "").split("\n")) if m]
            if lines:
                found = (*max(lines, key=lambda m: round(m[1], 12)), "header")
        own.append(found)
    parent = lambda p: p.rpartition("/")[0]
    declared = {}
    for d in {parent(p) for p, _ in files if p is not None}:
        here = [o for (p, _), o in zip(files, own) if p is not None and parent(p) == d and o]
        of_files = Counter(o[0] for o in here if o[2] == "file")
        headers = {o[0] for o in here if o[2] == "header"}
        if of_files:
            declared[d] = min(of_files, key=lambda x: (-of_files[x], x))
        elif len(headers) == 1:
            declared[d] = headers.pop()
    out = []
    for (path, _), o in zip(files, own):
        if o:
            out.append((o[0], o[2]))
            continue
        d, found = path, None
        while d and not found:
            d = parent(d)
            found = declared.get(d)
        out.append((found, "inherited" if found else None))
    return out


def test_licences_match_brute_force(spark):
    rng = random.Random(4)
    filler = lambda: " ".join(rng.choice(["alpha", "the", "of", "beta", "work", "version"])
                              for _ in range(rng.randint(3, 30)))
    files = []
    for i in range(120):
        path = "/".join([*(f"d{rng.randint(0, 2)}" for _ in range(rng.randint(0, 4))), f"f{i}"])
        lines = [filler() for _ in range(rng.randint(1, 4))]
        kind = rng.random()
        if kind < 0.2:
            lines.insert(rng.randint(0, len(lines)), rng.choice(LI.TEMPLATES)[1] + rng.choice(["", ".", " now"]))
        elif kind < 0.3:
            lines = [rng.choice(LI.TEMPLATES)[1]]
        files.append((path, "\n".join(lines)))
    files += [(None, "Released under the MIT License."), ("d0/x", None), ("d1/y", ""), (None, None),
              ("LICENSE", "Released under the MIT License."), ("LICENSE", "Released under the MIT License.")]
    df = spark.createDataFrame([(i, *f, "k") for i, f in enumerate(files)],
                               "n long, path string, text string, item string")
    got = {r["n"]: (r["licence"], r["origin"]) for r in LI.scan(df, F.col("path"), keep=["n", "item"]).select(
        "item.n", "licence", "origin").collect()}
    want = dict(enumerate(brute_scan(files)))
    assert got == want and {o for _, o in want.values()} == {"file", "header", "inherited", None}


def test_licence_query(spark):
    got = QUERIES["op1_licences"](spark, SF_SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        if re.search(r"(?m)^Released under the MIT License\.$", docs[r["doc_id"]] or ""):
            assert r["licence"] == "MIT" or r["origin"] == "file"


def test_licences_of_awkward_documents(documents, rows, no_documents):
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    out = LI.scan(documents, path).select("item.doc_id", "licence", "origin").collect()
    assert len(out) == len(rows)
    assert {(r["licence"], r["origin"]) for r in out if r["doc_id"] == 113} == {("MIT", "file")}
    assert LI.scan(no_documents, path).count() == 0
