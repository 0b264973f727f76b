"""Divergence of sources against dense counts."""

import re
from collections import Counter, defaultdict

import pytest

from llm_helpers import documents, no_documents, rows  # noqa: F401
from seasonflow.llm import divergence


def brute(rows, min_docs, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        each, q = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(-sum(abs(each[s][t] - each[o][t]) for t in kept), o.encode())
                     for o in sources if o != s]
            over = [(q[t] - each[s][t], t.encode()) for t in kept
                    if counts[lang, s][t] and each[s][t] > q[t]]
            for part, found, n in (("pair", pairs, None), ("term", over, top)):
                out |= {(lang, s, part, item.decode(), -v, i)
                        for i, (v, item) in enumerate(sorted(found)[:n], 1)}
    return out


def result(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("min_docs,top", [(1, 5), (4, 50), (10, 3), (1000, 50)])
def test_equals_dense_counts(spark, rows, documents, min_docs, top):
    expected = brute(rows, min_docs, top)
    assert expected and result(divergence.divergence(documents, min_docs, top)) == expected


def test_prefixes_are_refined_to_whole_terms(spark):
    long = "donaudampfschifffahrtsgesellschaftskapitän"
    texts = ["the then them thence", "The THEN " + long, long + " the", "theatre therapy", long + "s", "éé é"]
    df = spark.createDataFrame([("de", "s", t) for t in texts], "lang string, source string, text string")
    kept = divergence.kept_terms(divergence.document_terms(df), 2)
    assert {(r.term[:-1].decode(), r.docs) for r in kept.collect()} == {
        ("the", 3), ("then", 2), (long, 2)}


def test_many_sources_in_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 4)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 20)
    monkeypatch.setattr(divergence, "_CELLS", 32)
    rows = [(i, " ".join(f"{chr(97 + (i * j) % 26)}{chr(97 + j % 7)}" for j in range(30)), "en",
             f"s{i % 11}", 0) for i in range(60)]
    df = spark.createDataFrame([(r[2], r[3], r[1]) for r in rows], "lang string, source string, text string")
    assert result(divergence.divergence(df, 5, 7)) == brute(rows, 5, 7)


def test_groups_without_terms_are_paired_at_zero(spark):
    df = spark.createDataFrame([("en", "a", None), ("en", "b", "12 34"), (None, None, "")],
                               "lang string, source string, text string")
    assert result(divergence.divergence(df, 30, 50)) == {
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_empty_table(spark, no_documents):
    assert divergence.divergence(no_documents).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    c, n, v = 7 * 10 ** 15 + 3, 9 * 10 ** 16 + 1, 10 ** 6
    df = spark.createDataFrame([(c, n, v)], "c long, n long, v long")
    assert df.select(divergence.share("c", "n", "v")).first()[0] == 1 + 10 ** 9 * (c + 5) // (n + 5 * v)
