"""Exact repeated passages by recompression.

Recompression shortens a text in rounds: every maximal run of one symbol gets a name,
then every symbol is dealt to the left or the right side and every left-right pair of
neighbours gets a name. Names and sides are hashes of what they stand for, so they are
global without any exchange: equal substrings get equal symbols wherever they occur,
but for their ends, where what stands beside them decides. For each symbol the range of
words that decided it (``lo`` to ``hi``) is kept, so it is known which symbols *every*
occurrence of a window must show: those whose range lies inside the window.

Every window of WORDS words takes as its anchor one of the highest-level symbols that it
decides, chosen by their hashes. Equal windows have equal anchors at equal offsets, so only windows
whose anchor's name occurs twice in the corpus can be repeated. Consecutive windows with
one anchor form a span, and the table that Spark shuffles has one row for each span:
anchor name, hash of the span's words, document, place.

* Spans of equal name and hash are equal texts: where a span occurs twice, all of its
  windows are repeated.
* Where a name occurs in spans of different texts, the windows of those spans that occur
  once are compared one by one by two 64-bit hashes of their words.

The texts are written once, bucketed by row number, so neither of the two joins with
them shuffles a text. Common passages are counted by partial aggregates, never listed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, discard, under, written

WORDS = 35
ROUNDS = 5
#: Symbols of at least so many words make better anchors.
LONG = 6
#: Bytes of texts that are recompressed at once; a longer text is taken alone.
CHUNK_BYTES = 1 << 20
SEED = 42
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

_MASK = (1 << 64) - 1
_IN_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _name(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return _mix(_mix(a + np.uint64(salt * 0xD1B54A32D192ED03 & _MASK)) + b * _A + np.uint64(salt))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all words of some texts, in a row, and the number of words of each text."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    inside = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)),
        pa.py_buffer(raw[inside])]).dictionary_encode()
    h = xxhash.xxh64_intdigest
    known = np.fromiter((h(w, SEED) for w in words.dictionary.to_pylist()), np.uint64,
                        len(words.dictionary))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return known[words.indices.to_numpy()], np.diff(np.searchsorted(starts, begins))


class Level:
    """Symbols of one level: names, the words they span, and the words that decide them."""

    def __init__(self, name, start, end, lo, hi):
        self.name, self.start, self.end, self.lo, self.hi = name, start, end, lo, hi


def _compress_runs(s: Level, words: np.ndarray, first: np.ndarray, last: np.ndarray,
                   salt: int) -> Level:
    """Name maximal runs. That a neighbour differs is seen from its nearest word alone if
    that differs from the run's own, else it takes all that decides the neighbour."""
    n = len(s.name)
    same = np.zeros(n, bool)  # equal to the symbol before it, in the same document
    same[1:] = (s.name[1:] == s.name[:-1]) & (first[s.start[1:]] == first[s.start[:-1]])
    head = np.flatnonzero(~same)
    tail = np.append(head[1:], n) - 1
    count = (tail - head + 1).astype(np.uint64)
    name = np.where(count > 1, _name(s.name[head], count, salt), s.name[head])
    start, end = s.start[head], s.end[tail]
    lo, hi = np.minimum.reduceat(s.lo, head), np.maximum.reduceat(s.hi, head)
    at_start, at_end = start == first[start], end == last[start]
    left, right = np.maximum(head - 1, 0), np.minimum(tail + 1, n - 1)
    before, after = np.maximum(start - 1, 0), np.minimum(end, len(words) - 1)
    plain = words[before] != words[s.end[head] - 1]
    lo = np.minimum(lo, np.where(at_start | plain, start - 1, s.lo[left]))
    plain = words[after] != words[start]
    hi = np.maximum(hi, np.where(at_end | plain, end + 1, s.hi[right]))
    return Level(name, start, end, lo, hi)


def _compress_pairs(s: Level, first: np.ndarray, last: np.ndarray, salt: int) -> Level:
    """Name left-right pairs. A pair is decided by its two symbols; a left symbol that
    stays is decided by its right neighbour too, a right one by its left neighbour."""
    n = len(s.name)
    right = (_mix(s.name + np.uint64(salt * 0x9E3779B97F4A7C15 & _MASK)) >> np.uint64(63)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = ~right[:-1] & right[1:] & (first[s.start[:-1]] == first[s.start[1:]])
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    nxt, prev = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    at_start, at_end = s.start == first[s.start], s.end == last[s.start]
    lo = np.where(right, np.minimum(s.lo, np.where(at_start, s.start - 1, s.lo[prev])), s.lo)
    hi = np.where(right, s.hi, np.maximum(s.hi, np.where(at_end, s.end + 1, s.hi[nxt])))
    lo = np.where(pair, np.minimum(s.lo, s.lo[nxt]), lo)
    hi = np.where(pair, np.maximum(s.hi, s.hi[nxt]), hi)
    name = np.where(pair, _name(s.name, s.name[nxt], salt), s.name)
    end = np.where(pair, s.end[nxt], s.end)
    stay = ~second
    return Level(name[stay], s.start[stay], end[stay], lo[stay], hi[stay])


def levels(words: np.ndarray, first: np.ndarray, last: np.ndarray, rounds: int = ROUNDS):
    """All levels, the words first. ``first`` and ``last`` bound each word's document."""
    at = np.arange(len(words))
    out = [Level(words, at, at + 1, at, at + 1)]
    for r in range(rounds):
        runs = _compress_runs(out[-1], words, first, last, 2 * r + 1)
        out.append(_compress_pairs(runs, first, last, 2 * r + 2))
    return out


def _first_smallest(key: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the smallest key in each range [begin, end), the first among equals."""
    size, table = 1, [np.arange(len(key))]
    while 2 * size <= (end - begin).max(initial=0):
        a = table[-1][:-size]
        b = table[-1][size:]
        table.append(np.where(key[b] < key[a], b, a))
        size *= 2
    out = np.empty(len(begin), np.int64)
    power = np.log2(end - begin).astype(int)
    for k, best in enumerate(table):
        at = np.flatnonzero(power == k)
        a, b = best[begin[at]], best[end[at] - (1 << k)]
        out[at] = np.where(key[b] < key[a], b, a)
    return out


def anchors(words: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = WORDS):
    """For every window start: (starts, anchor name, anchor place).

    Of the symbols of the highest level that the window decides, the anchor is the one
    with the smallest hash, symbols of LONG words and more before shorter ones: smallest
    hashes are shared by many windows in a row, long symbols by few texts."""
    starts = np.flatnonzero(np.arange(len(words)) + width <= last)
    name, place = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    for level in reversed(levels(words, first, last)):
        at = starts[open_]
        begin = np.searchsorted(level.lo, at)
        end = np.searchsorted(level.hi, at + width, side="right")
        inside = begin < end
        short = (level.end - level.start < LONG).astype(np.uint64)
        key = (_mix(level.name) >> np.uint64(1)) | (short << np.uint64(63))
        j = _first_smallest(key, begin[inside], end[inside])
        name[open_[inside]], place[open_[inside]] = level.name[j], level.start[j]
        open_ = open_[~inside]
        if not len(open_):
            break
    return starts, name, place


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(base))
        out[:1] = 1
        return np.multiply.accumulate(out)


def _range_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of the word ranges [begin, end)."""
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(_mix(words ^ np.uint64(base)) * _powers(base, len(words)), out=prefix[1:])
    shift = _powers(pow(base, -1, 1 << 64), len(words) + 1)
    return _mix((prefix[end] - prefix[begin]) * shift[begin] + (end - begin).astype(np.uint64))


_BASE1, _BASE2 = 0xD1342543DE82EF95, 0x2545F4914F6CDD1D


def _chunks(batch: pa.RecordBatch):
    """(row numbers, their texts) of some rows of a batch at a time."""
    rows, texts, n = [], [], 0
    for i, text in enumerate(batch.column("text").to_pylist()):
        rows.append(i)
        texts.append(text or b"")
        n += len(texts[-1])
        if n >= CHUNK_BYTES:
            yield rows, texts
            rows, texts, n = [], [], 0
    if rows:
        yield rows, texts


def _bounds(sizes: np.ndarray):
    """For each word: where its document begins and ends, and the document's number."""
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return (ends - sizes)[doc], ends[doc], doc


def _spans(width: int):
    def run(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            for rows, texts in _chunks(batch):
                own = rid[np.array(rows)]
                words, sizes = word_hashes(texts)
                if sizes.max(initial=0) < width:
                    continue
                first, last, doc = _bounds(sizes)
                starts, name, place = anchors(words, first, last, width)
                new = np.ones(len(starts), bool)  # windows of one anchor symbol are a span
                new[1:] = ((place[1:] != place[:-1]) | (name[1:] != name[:-1])
                           | (starts[1:] != starts[:-1] + 1))
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(starts)) - 1
                lo, hi = starts[head], starts[tail]
                text = _range_hashes(words, lo, hi + width, _BASE1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[doc[lo]]), pa.array(name[head].view(np.int64)),
                     pa.array(text.view(np.int64)),
                     pa.array((lo - first[lo]).astype(np.int32)),
                     pa.array((hi - lo + 1).astype(np.int32))],
                    names=["rid", "name", "span", "lo", "windows"])

    return run


def _windows(width: int):
    """Two hashes of every window of the places given with each text."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words, _ = word_hashes([batch.column("text")[i].as_py()])
                places = batch.column("places")[i].as_py()
                at = np.concatenate([np.arange(p["lo"], p["lo"] + p["windows"]) for p in places])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), batch.column("rid")[i].as_py())),
                     pa.array(at.astype(np.int32)),
                     *(pa.array(_range_hashes(words, at, at + width, b).view(np.int64))
                       for b in (_BASE1, _BASE2)),
                     pa.array(np.concatenate([np.full(p["windows"], p["times"]) for p in places]))],
                    names=["rid", "at", "h1", "h2", "times"])

    return run


def remaining(tokens: list[bytes], ranges: list[tuple[int, int]]) -> list[bytes]:
    """The words outside all ranges [begin, end)."""
    steps = np.zeros(len(tokens) + 1, np.int64)
    for begin, end in ranges:
        steps[begin] += 1
        steps[end] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return [t for t, g in zip(tokens, gone) if not g]


def repeated_ranges(rows: DataFrame, width: int = WORDS) -> DataFrame:
    """(rid, ranges): the word ranges of each text that are covered by repeated windows.
    ``rows`` has rid and text and is bucketed by rid."""
    texts = rows.select("rid", F.col("text").cast("binary").alias("text"))
    spans = written(texts.mapInArrow(
        _spans(width), "rid long, name long, span long, lo int, windows int"), "spans")
    # Per name: how many spans there are and how many different ones; the first count is
    # partially aggregated, so a passage that is everywhere is one row for each task.
    distinct = spans.groupBy("name", "span").agg(F.count("*").alias("times"))
    names = distinct.groupBy("name").agg(F.sum("times").alias("all"), F.count("*").alias("kinds"))
    repeated = written(distinct.join(names.where("all > 1"), "name"), "repeated")
    hits = written(spans.join(repeated.select("name", "span", "times", "kinds"), ["name", "span"])
                   .select("rid", "lo", "windows", "times", "kinds", "name", "span"), "hits")
    whole = hits.where("times > 1").select(
        "rid", F.struct(F.col("lo").alias("begin"), (F.col("lo") + F.col("windows") - 1 + width)
                        .alias("end")).alias("range"))
    # One occurrence of every different span stands for all of them.
    stand_in = (hits.where("kinds > 1").groupBy("name", "span")
                .agg(F.min(F.struct("rid", "lo", "windows", "times")).alias("s")).select("s.*"))
    places = stand_in.groupBy("rid").agg(F.collect_list(F.struct("lo", "windows", "times"))
                                         .alias("places"))
    windows = written(texts.join(places.hint("shuffle_hash"), "rid").mapInArrow(
        _windows(width), "rid long, at int, h1 long, h2 long, times long"), "windows")
    twice = windows.groupBy("h1", "h2").agg(F.sum("times").alias("total")).where("total > 1")
    single = (windows.where("times = 1").join(twice, ["h1", "h2"], "left_semi")
              .select("rid", F.struct(F.col("at").alias("begin"), (F.col("at") + width)
                                      .alias("end")).alias("range")))
    out = written(whole.union(single).groupBy("rid")
                  .agg(F.collect_list("range").alias("ranges")), "ranges")
    for table in (spans, repeated, hits, windows):
        discard(table)
    return out


def remove_repeats(docs: DataFrame, text_col: str = "text", width: int = WORDS,
                   keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, default all, under ``doc``) with n_words,
    n_removed, ranges (what was removed, as word ranges that may overlap), kept_text (the
    words left, joined by one space) and kept_sha256.

    All occurrences of a repeated window go, the first included. A null or empty text has
    no words. Repeated rows are texts of their own, so all their windows are repeated.
    Texts shorter than a window lose nothing. An empty table gives an empty result; extra
    columns stay inside ``doc``.
    """
    rows = bucketed(docs.select(under("doc", docs, keep), F.col(f"`{text_col}`").alias("text"),
                                F.monotonically_increasing_id().alias("rid")), "rid", "texts")
    ranges = repeated_ranges(rows, width)

    def run(batches):
        for batch in batches:
            n, left, sums = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("ranges")):
                tokens = (text.as_py() or b"").split()
                gone = [(s["begin"], s["end"]) for s in spans.as_py() or []]
                kept = remaining(tokens, gone) if gone else tokens
                joined = b" ".join(kept)
                n.append((len(tokens), len(tokens) - len(kept)))
                left.append(joined.decode())
                sums.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array([x for x, _ in n], pa.int64()),
                 pa.array([x for _, x in n], pa.int64()), batch.column("ranges"),
                 pa.array(left, pa.string()), pa.array(sums, pa.string())],
                names=["doc", "n_words", "n_removed", "ranges", "kept_text", "kept_sha256"])

    joined = rows.join(ranges.hint("shuffle_hash"), "rid", "left").select(
        "doc", F.col("text").cast("binary").alias("text"), "ranges")
    doc_type = joined.schema["doc"].dataType.simpleString()
    range_type = joined.schema["ranges"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc {doc_type}, n_words long, n_removed long, "
                                  f"ranges {range_type}, kept_text string, kept_sha256 string")
