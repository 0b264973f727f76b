"""Collocations against a plain count of all phrases of every length."""

import re
from collections import Counter

import pytest

from llm_helpers import documents, no_documents, rows, sentence  # noqa: F401
from seasonflow.llm import phrases


def brute(rows, order, min_count, share, top):
    counts, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, order + 1):
                counts.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    out = {}
    candidates = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= min_count}
    for (lang, words), a in candidates.items():
        absorbed = any(
            long[0] == lang and len(long[1]) > len(words) and 100 * f >= share * a
            and any(long[1][i:i + len(words)] == words for i in range(len(long[1]) - len(words) + 1))
            for long, f in candidates.items())
        if absorbed:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((10 ** 6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, i, p.decode(), -a, left, right, sizes[lang], -score)
            for lang, found in out.items()
            for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def result(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


@pytest.mark.parametrize("order,min_count,share", [(2, 3, 50), (3, 3, 50), (3, 2, 101), (4, 3, 80)])
def test_equals_a_plain_count(spark, rows, documents, order, min_count, share):
    got = phrases.collocations(documents, order, min_count, share, top=40)
    expected = brute(rows, order, min_count, share, 40)
    assert expected and result(got) == expected


def test_pieces_padding_nulls_and_repeats(spark):
    data = [("en", "A b. a b, a\tb c! a b c\x0bA B"), ("en", "a b c"), ("en", "a b c"), ("en", None),
            ("en", ""), (None, "x y " * 6), (None, "X\nY"), ("", "one")]
    rows = [(i, text, lang, None, 0) for i, (lang, text) in enumerate(data)]
    df = spark.createDataFrame(data, "lang string, text string")
    assert result(phrases.collocations(df, 3, 2, 50, 100)) == brute(rows, 3, 2, 50, 100)


def test_all_candidates_without_a_limit(spark, rows, documents):
    got = phrases.collocations(documents, 3, 3, 50, top=None)
    assert got.count() == len(brute(rows, 3, 3, 50, 10 ** 9))


def test_empty_table_and_no_candidate(spark, no_documents):
    assert phrases.collocations(no_documents).collect() == []
    alone = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert phrases.collocations(alone).collect() == []


def test_a_long_text_is_cut_at_piece_ends_only():
    text = (b"one two three. " * 50 + b"four " * 100 + b"; five") * 3
    whole = text.lower().translate(phrases._PIECE_TABLE)
    parts = list(phrases.chunks(text, 64))
    assert b"".join(parts) == whole and len(parts) > 3
    assert all(p.endswith(b"\n") for p in parts[:-1])


def test_products_beyond_64_bits_are_exact(spark):
    big = 10 ** 12
    counts = spark.createDataFrame(
        [("en", None, 0, 4 * big), ("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big + 1),
         ("en", "a b", 2, 2 * big - 7)], "lang string, phrase string, n_words int, f long")
    row = phrases.scored(counts).first()
    assert row.score == 10 ** 6 * (2 * big - 7) ** 2 // (3 * big * (2 * big + 1))


def test_one_very_common_pair_is_summed_before_the_shuffle(spark):
    df = spark.range(20_000).selectExpr("'en' AS lang", "'same pair' AS text")
    assert phrases.windows(df, 3).count() <= 200
    got = phrases.collocations(df, 3, 10).first()
    assert (got.phrase, got.a, got.n) == ("same pair", 20_000, 40_000)


def test_prefix_sums_are_summed_before_the_rollup(spark, monkeypatch):
    """ROLLUP gets the sums by first word, not every prefix once for each of its levels."""
    df = spark.createDataFrame([("en", "a b c d. e")], "lang string, text string")
    monkeypatch.setattr(phrases, "written", lambda table, name: table)
    rolled = phrases.phrase_counts(df, 3, 1)._jdf.queryExecution().optimizedPlan().toString()
    after = rolled[rolled.index("Expand"):]
    assert after.index("Aggregate") < after.index("Window")
