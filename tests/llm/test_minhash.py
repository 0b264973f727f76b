"""Fingerprints against the real similarities, groups against all pairs."""

import hashlib
import random

import numpy as np
import pytest

from llm_helpers import documents, no_documents, rows, sentence, union_find  # noqa: F401
from seasonflow.llm import minhash


def text_of(row):
    return row[1] or ""


def following(rows):
    """The next text of every row by descending id, null ids last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(r, order[(i + 1) % len(order)]) for i, r in enumerate(order)]


def compared(df, **options):
    return minhash.followed(df, keep=["doc_id", "rid"], **options).collect()


def test_edited_texts_hashes_and_likeness(spark, rows, documents):
    expected = {}
    for row, after in following(rows):
        a, b = text_of(row), text_of(after)
        edited = a[:len(a) - len(a) // 2] + b[:len(a) // 2]
        expected.setdefault((row[0], a), set()).add(edited)
    got = compared(documents)
    assert len(got) == len(rows)
    sha = {hashlib.sha256(t.encode()).digest(): t for s in expected.values() for t in s}
    texts = {hashlib.md5(text_of(r).encode()).digest(): text_of(r) for r in rows}
    for r in got:
        own = texts[r["digest"]]
        edited = sha[r["edited_sha256"]]
        assert edited in expected[r["doc"]["doc_id"], own]
        assert r["n_chars"] == len(own)
        assert r["print"] == minhash.signature(own.encode())
        assert r["edited_print"] == minhash.signature(edited.encode())
        assert r["near_edited"] == minhash.likeness(r["print"], r["edited_print"])
        assert 0 <= r["near_next"] <= 1


def test_next_text_across_partitions(spark):
    data = [(i, f"text {i} " * 5) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    got = {r["doc"]["doc_id"]: r["edited_sha256"] for r in
           minhash.followed(df, keep=["doc_id"]).collect()}
    text = dict(data)
    assert len(got) == 500
    for i, sha in got.items():
        edited = minhash.half_replaced(text[i], text[i - 1 if i else 499])
        assert sha == hashlib.sha256(edited.encode()).digest()


def test_likeness_estimates_jaccard():
    rng = random.Random(3)
    errors = []
    for share in (0.1, 0.3, 0.5, 0.7, 0.9):
        for _ in range(20):
            words = sentence(rng, 600).split(" ")
            cut = int(600 * share)
            a, b = " ".join(words).encode(), " ".join(words[:cut] + sentence(rng, 600 - cut).split(" ")).encode()
            errors.append(minhash.likeness(minhash.signature(a), minhash.signature(b)) - minhash.jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_equal_texts_have_equal_fingerprints_and_blocks_do_not_matter(monkeypatch):
    text = sentence(random.Random(1), 9000).encode()
    whole = minhash.signature(text)
    monkeypatch.setattr(minhash, "_CHUNK", 100)
    assert minhash.signature(text) == whole == minhash.signature(text.upper().replace("É".encode(), "é".encode()))
    empty = minhash.signature(b"")
    assert empty == minhash.signature(b" \n\t") == b"\xff" * 256
    assert minhash.signature(b"one two") != minhash.signature(b"two one")


@pytest.fixture(scope="module")
def near_copies():
    """Groups of near copies with neighbours at every similarity, and texts that share half."""
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = sentence(rng, 120).split(" ")
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 4, 6):
            other = list(base)
            for at in rng.sample(range(120), edits):
                other[at] = "changed%d" % rng.randint(0, 99)
            texts += [" ".join(other)] * rng.choice([1, 2])
    shared = sentence(rng, 100)
    texts += [shared + " " + sentence(rng, 60) for _ in range(40)]
    texts += ["", "", "short text", "short text"]
    return list(enumerate(texts))


@pytest.mark.parametrize("common", [0, 1_000_000])
def test_groups_equal_all_pairs(spark, near_copies, monkeypatch, common):
    monkeypatch.setattr(minhash, "SAMPLE", 1)
    monkeypatch.setattr(minhash, "MAX_COMMON", common)  # the order changes no result
    df = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(4)
    got = {r["doc"]["doc_id"]: r["component_id"]
           for r in minhash.near_duplicates(df, keep=["doc_id"]).collect()}
    links = [(i, j) for i, a in near_copies for j, b in near_copies
             if i < j and minhash.jaccard(a.encode(), b.encode()) >= 0.8]
    assert links and got == union_find([i for i, _ in near_copies], links)


def test_nulls_repeats_and_empty_tables(spark, rows, documents, no_documents):
    got = minhash.near_duplicates(documents).collect()
    assert len(got) == len(rows)
    by = {r["doc"]["doc_id"]: r["component_id"] for r in got}
    assert by[100] == by[101] == by[102] == 100  # null, empty and blank are alike
    assert by[104] == by[105] == by[0] == 0
    assert by[110] == by[111] == 110
    assert minhash.near_duplicates(no_documents).collect() == []
    assert minhash.followed(no_documents).collect() == []


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = minhash.followed(df).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").digest() and row["near_next"] == 1


def test_sketches_count_positions_that_agree(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for same in (0, 60, 76, 77, 100, 128):
        a = rng.integers(0, 1 << 16, 128).astype("<u2")
        b = a.copy()
        b[same:] = (b[same:] & 0xFFF0) | ((b[same:] + 1 + rng.integers(0, 15, 128 - same)) & 15)
        pairs.append((same, a.tobytes(), b.tobytes()))
    df = spark.createDataFrame(pairs, "same int, a binary, b binary").repartition(2)
    df = df.select("same", minhash.sketch(df["a"]).alias("x"), minhash.sketch(df["b"]).alias("y"))
    got = {r[0]: r[1] for r in df.select("same", minhash.close("x", "y", 0.8)).collect()}
    assert got == {0: False, 60: False, 76: False, 77: True, 100: True, 128: True}


def test_prefix_pairs_have_all_similar_ones_and_few_of_a_shared_passage(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SAMPLE", 1)
    rng = random.Random(8)
    passage = sentence(rng, 100)
    texts = [passage + " " + sentence(rng, 40) for _ in range(60)]
    for _ in range(6):
        words = sentence(rng, 150).split(" ")
        texts += [" ".join(words), " ".join(words[:-6] + sentence(rng, 8).split(" "))]
    digest = [hashlib.md5(t.encode()).digest() for t in texts]
    rows = spark.createDataFrame([(i, i, d) for i, d in enumerate(digest)],
                                 "node long, component long, digest binary")
    bodies = spark.createDataFrame([(d, t.encode()) for d, t in zip(digest, texts)],
                                   "digest binary, text binary")
    got = {(r.a, r.b) for r in minhash.prefix_pairs(rows, bodies, 0.8, 5).collect()}
    similar = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
               if minhash.jaccard(texts[i].encode(), texts[j].encode()) >= 0.8}
    assert len(similar) == 6 and similar <= got and len(got) < 60


def test_parities_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(6)
    for n, only in ((0, 3), (5, 0), (300, 40), (3000, 900)):
        both = rng.integers(0, 1 << 63, n, np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, only, np.uint64)]) for _ in range(2))
        bits = sum((x ^ y).bit_count() if x ^ y >= 0 else (64 - (~(x ^ y)).bit_count())
                   for x, y in zip(minhash.parities(a), minhash.parities(b)))
        assert bits <= 2 * only and (bits > 0) == (only > 0)


def test_prefix_pairs_leave_out_texts_just_below_the_threshold(spark, monkeypatch):
    """Near copies that share many early shingles, but not enough, are no pairs."""
    monkeypatch.setattr(minhash, "SAMPLE", 1)
    rng = random.Random(12)
    base = sentence(rng, 200).split(" ")
    texts = []
    for _ in range(30):
        at = set(rng.sample(range(200), 8))
        texts.append(" ".join(f"x{rng.random()}" if i in at else w for i, w in enumerate(base)))
    texts.append(texts[0] + " more")
    digest = [hashlib.md5(t.encode()).digest() for t in texts]
    rows = spark.createDataFrame([(i, i, d) for i, d in enumerate(digest)],
                                 "node long, component long, digest binary")
    bodies = spark.createDataFrame([(d, t.encode()) for d, t in zip(digest, texts)],
                                   "digest binary, text binary")
    got = {(r.a, r.b) for r in minhash.prefix_pairs(rows, bodies, 0.8, 5).collect()}
    similar = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
               if minhash.jaccard(texts[i].encode(), texts[j].encode()) >= 0.8}
    assert (0, 30) in similar and similar <= got and len(got) < len(texts)
