import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from llm_helpers import documents, no_documents, rows  # noqa: F401
from seasonflow.llm import packing as P
from seasonflow.llm.catalogue import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_vocabulary())


def check_pieces(pieces, texts, tokenizer):
    """Every id lies in one piece; sequences are gapless; hardly any padding."""
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
           for k, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["key"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(texts)
    for key, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            part = np.array(ids[key][p["start"]:p["start"] + p["length"]], "<u4")
            assert p["start"] == at and len(part) == p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            assert p["doc_tokens"] == len(ids[key])
            at += p["length"]
        assert at == len(ids[key])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= P.SEQ_LEN
        padding += P.padded(at) - at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert padding <= 0.02 * sum(map(len, ids.values()))


def test_query_round_trip(spark, tokenizer):
    texts = {r["doc_id"]: r["text"]
             for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    pieces = QUERIES["op10_packing"](spark, SF_SMALL).collect()
    check_pieces([p.asDict() | {"key": p["doc_id"]} for p in pieces], texts, tokenizer)


def test_awkward_rows(documents, rows, no_documents, tokenizer):
    once = documents.dropDuplicates(["doc_id", "text"])
    pieces = P.pack(once.drop("id")).collect()
    texts = {r[0]: r[1] for r in rows}
    check_pieces([p.asDict() | {"key": p["id"]} for p in pieces], texts, tokenizer)
    twice = P.pack(documents.drop("id")).where("id = 104").groupBy("start").count().collect()
    assert sum(r["count"] for r in twice) >= 2
    assert P.pack(no_documents).count() == 0


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    encode = P.encoder(P.default_vocabulary())
    for text in ["", " ", "a  b\n\n c", "it's 12,000 été  x", "x<|endoftext|>y", "\t" * 50,
                 "漢字 and 😀 emoji", "don't we'll\r\n"]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_patterns_cover_demand_at_the_optimum():
    """Three lengths, where the best patterns are known."""
    patterns = P.solve_patterns({600: 100, 424: 100, 512: 40})
    assert abs(sum(x for _, x in patterns) - 120) < 1e-6
    covered = Counter()
    for pattern, x in patterns:
        assert sum(n * k for n, k in pattern.items()) <= P.SEQ_LEN
        for n, k in pattern.items():
            covered[n] += k * x
    assert covered[600] >= 100 - 1e-6 and covered[424] >= 100 - 1e-6 and covered[512] >= 40 - 1e-6


def test_column_generation_improves_on_the_start():
    rng = np.random.default_rng(3)
    histogram = Counter(map(int, rng.integers(1, 700, 5000)))
    cost = [sum(x * P.padded(sum(n * k for n, k in p.items()))
                for p, x in P.solve_patterns(dict(histogram), max_rounds=r)) for r in (0, 60)]
    total = sum(n * k for n, k in histogram.items())
    assert total <= cost[1] < cost[0]


def test_slots_and_stream():
    histogram = {600: 10, 424: 7, 3: 1}
    table, sequences, placed = P.slots(histogram, [({600: 1, 424: 1}, 7.0), ({600: 1}, 3.0)])
    assert sequences == 7 and placed[600] == placed[424] == 7
    assert table == [(600, 0, 7, 1, 0, 0), (424, 0, 7, 1, 0, 600)]
    assert P.stream_cuts(2048) == [] and P.stream_cuts(1024 + 700) == [1536, 1664, 1696, 1712, 1720, 1724]
