import hashlib
import random
from collections import Counter

import numpy as np
import xxhash

from conftest import SF_SMALL
from llm_helpers import documents, no_documents, rows, words  # noqa: F401
from seasonflow.llm import substrings as S
from seasonflow.llm.catalogue import QUERIES


def brute(texts, width=S.WORDS):
    """(n_words, n_removed, hash of the rest) of each text."""
    docs = [words(t) for t in texts]
    seen = Counter(tuple(d[i:i + width]) for d in docs for i in range(len(d) - width + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[tuple(d[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        rest = b" ".join(w for w, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), hashlib.sha256(rest).hexdigest()))
    return out


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = dict(zip([d["doc_id"] for d in docs], brute([d["text"] for d in docs])))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in QUERIES["op4_substrings"](spark, SF_SMALL).collect()}
    assert got == want and sum(r[1] for r in got.values()) > 0


def test_random_repeats(spark):
    """Passages of 30 to 60 words, periodic runs and self-repeats in small alphabets."""
    rng = random.Random(11)
    texts = []
    pool = [" ".join(f"p{rng.randint(0, 9)}" for _ in range(rng.randint(30, 60))) for _ in range(12)]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(rng.choice(pool))
            elif kind < 0.6:
                parts.append(" ".join(["x", "y", "z"][:rng.randint(1, 3)] * rng.randint(5, 40)))
            else:
                parts.append(" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 50))))
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in
           S.remove_repeats(df).select("doc.doc_id", "n_words", "n_removed", "kept_sha256").collect()}
    assert got == dict(enumerate(brute(texts)))


def test_word_hashes_of_awkward_texts():
    texts = [b"", b" \t\n\x0b", b"one", "é  two\x0bone\x00x \x1f".encode(), b"", b"a b " * 50, b"one "]
    hashes, sizes = S.word_hashes(texts)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    assert hashes.tolist() == [xxhash.xxh64_intdigest(w, S.SEED) for t in texts for w in t.split()]
    hashes, sizes = S.word_hashes([b""])
    assert len(hashes) == 0 and sizes.tolist() == [0]


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 5, 300)
    docs = [b" ".join(str(x).encode() for x in np.concatenate([
        rng.integers(0, 5, rng.integers(0, 40)), shared, rng.integers(0, 5, 60)])) for _ in range(20)]
    words_, sizes = S.word_hashes(docs)
    first, last, _ = S._bounds(sizes)
    for level in S.levels(words_, first, last):
        assert (np.diff(level.lo) >= 0).all() and (np.diff(level.hi) >= 0).all()
    starts, name, place = S.anchors(words_, first, last)
    by_window = {}
    for k, i in enumerate(starts):
        by_window.setdefault(words_[i:i + S.WORDS].tobytes(), set()).add((name[k], place[k] - i))
    assert all(len(v) == 1 for v in by_window.values()) and len(by_window) < len(starts)


def test_awkward_rows(documents, rows, no_documents):
    got = S.remove_repeats(documents)
    assert "rid" in got.select("doc.*").columns
    out = got.select("doc.doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect()
    want = Counter((r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows])))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == want
    assert S.remove_repeats(no_documents).count() == 0
