"""Packing documents into sequences of a fixed length by cutting-stock column generation.

A document of ``n`` tokens is cut into full sequences and a tail shorter than a
sequence. The tails' length histogram (at most ``seq_len - 1`` rows, whatever the
corpus) is a cutting-stock problem: a pattern is a multiset of tail lengths that fits
a sequence and costs the sequence's padded length, which is its fill when that is a
power of two and ``seq_len`` otherwise. A linear program over patterns is solved by
the simplex method with column generation; a knapsack dynamic program over the fill
prices all patterns at once.

The patterns without padding, in whole numbers (rounded down), are assigned to the
tails: tails of one length are ranked across the corpus (rank inside a hash bucket plus
the counts of earlier buckets), and a rank falls into one interval of pattern slots. The
tails left over form one stream in (length, rank) order, cut at every ``seq_len``
tokens; its last part is cut at powers of two.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import written

SEQ_LEN = 1024
END_ID = 0
#: Rows of a rank bucket, on average.
BUCKET_ROWS = 50_000
#: Column-generation rounds. What the program has not improved by then goes to the stream.
MAX_ROUNDS = 300
_EPS = 1e-7


# --- tokens ------------------------------------------------------------------------

def rank_encoder(vocabulary: str) -> tiktoken.Encoding | None:
    """A faster encoder of the same vocabulary, from the rank file beside it if there is
    one."""
    try:
        with open(vocabulary.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    except FileNotFoundError:
        return None
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Token ids of a whole text as the tokenizer file ``vocabulary`` gives them, no
    special tokens added. Texts that spell out a special token go to the tokenizer
    itself; for others the rank file of the same vocabulary gives equal ids."""
    tokenizer = Tokenizer.from_file(vocabulary)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    fast = rank_encoder(vocabulary)

    def encode(text: str) -> list[int]:
        if fast is None or any(s in text for s in special):
            return tokenizer.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """(rid, id, doc_tokens, full_crcs, tail, tail_crc, tail_ids) for each row of ``docs``.

    ``doc_tokens`` counts the end id; ``full_crcs`` has the CRC-32 of each full
    sequence and ``tail_ids`` the ids after them, little-endian unsigned 32-bit.
    """
    vocabulary = vocabulary or default_vocabulary()

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"rid long, id {id_type}, doc_tokens long, full_crcs array<long>, tail long, "
              "tail_crc long, tail_ids binary")

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            n_ids, full, tails = [], [], []
            for text in batch.column("text"):
                ids = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                cut = len(ids) // seq_len * seq_len
                n_ids.append(len(ids))
                full.append([zlib.crc32(ids[i:i + seq_len].tobytes())
                             for i in range(0, cut, seq_len)])
                tails.append(ids[cut:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), pa.array(n_ids, pa.int64()),
                 pa.array(full, pa.list_(pa.int64())),
                 pa.array([len(t) // 4 for t in tails], pa.int64()),
                 pa.array(map(zlib.crc32, tails), pa.int64()), pa.array(tails, pa.binary())],
                names=["rid", "id", "doc_tokens", "full_crcs", "tail", "tail_crc", "tail_ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return written(rows.mapInArrow(run, schema), "tokens")


# --- cutting stock -----------------------------------------------------------------

def padded(fill: int, seq_len: int = SEQ_LEN) -> int:
    """Tokens a sequence takes: its fill if that is a power of two, else ``seq_len``."""
    return fill if fill & (fill - 1) == 0 else seq_len


def _price(lengths: np.ndarray, duals: np.ndarray, seq_len: int) -> tuple[float, Counter]:
    """Knapsack over exact fills: the pattern whose duals exceed its cost by most."""
    value = np.full(seq_len + 1, -np.inf)
    value[0] = 0.0
    last = np.zeros(seq_len + 1, np.int64)
    for fill in range(int(lengths[0]), seq_len + 1):
        k = np.searchsorted(lengths, fill, side="right")
        gain = value[fill - lengths[:k]] + duals[:k]
        best = int(np.argmax(gain))
        value[fill], last[fill] = gain[best], best
    cost = np.array([padded(t, seq_len) for t in range(seq_len + 1)], float)
    profit = value - cost
    profit[0] = -np.inf
    fill = int(np.argmax(profit))
    items, left = Counter(), fill
    while left > 0:
        items[int(last[left])] += 1
        left -= int(lengths[last[left]])
    return float(profit[fill]), items


def _start(lengths: np.ndarray, demand: np.ndarray, seq_len: int):
    """A first basis and its inverse: lengths that complete each other go together, and
    the one of the two with more demand also alone, as often as it fits."""
    at = {int(n): i for i, n in enumerate(lengths)}
    columns, inverse = [], np.zeros((len(lengths), len(lengths)))
    for i, n in enumerate(map(int, lengths)):
        j = at.get(seq_len - n)
        if j is not None and j != i and (demand[i], -i) < (demand[j], -j):
            columns.append({i: 1, j: 1})
            inverse[i, i], inverse[j, i] = 1.0, -1.0 / (seq_len // int(lengths[j]))
        else:
            columns.append({i: seq_len // n})
            inverse[i, i] = 1.0 / (seq_len // n)
    return columns, inverse


def _dot(spec: str, *arrays: np.ndarray) -> np.ndarray:
    """Products of the driver-side program without BLAS threads, which do not survive
    the fork that starts the JVM."""
    return np.einsum(spec, *arrays)


def solve_patterns(histogram: dict[int, int], seq_len: int = SEQ_LEN,
                   max_rounds: int = MAX_ROUNDS) -> list[tuple[dict[int, int], float]]:
    """Patterns ({length: times}, how often) of a basic solution of the program
    "cover every length's demand at least padded cost", by column generation.

    At most one pattern for each length. With ``max_rounds`` reached the solution is
    feasible but may not be optimal.
    """
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], float)
    columns, inverse = _start(lengths, demand, seq_len)

    def cost_of(column):
        return padded(sum(int(lengths[i]) * k for i, k in column.items()), seq_len)

    cost = np.array([cost_of(c) for c in columns], float)
    for _ in range(max_rounds):
        profit, items = _price(lengths, _dot("i,ij->j", cost, inverse), seq_len)
        if profit <= _EPS * seq_len:
            break
        amount = _dot("ij,j->i", inverse, demand)
        along = sum(inverse[:, i] * k for i, k in items.items())
        rows = np.flatnonzero(along > _EPS)
        out = rows[np.argmin(np.maximum(amount[rows], 0) / along[rows])]
        pivot = inverse[out] / along[out]
        inverse -= np.outer(along, pivot)
        inverse[out] = pivot
        columns[out], cost[out] = dict(items), cost_of(items)
    amount = _dot("ij,j->i", inverse, demand)
    return [({int(lengths[i]): k for i, k in c.items()}, float(x))
            for c, x in zip(columns, amount) if x > _EPS]


def slots(histogram: dict[int, int], patterns: list, seq_len: int = SEQ_LEN):
    """Intervals of ranks for each length: rows (tail, first, until, times, sequence,
    offset): a tail of this length with a rank in [first, until) is item
    ``(rank - first) % times`` of sequence ``sequence + (rank - first) // times``.

    Patterns with padding are left out, the others are rounded down. Also returns the
    number of sequences and, by length, how many tails were placed.
    """
    placed: Counter = Counter()
    rows, sequence = [], 0
    for pattern, amount in patterns:
        fill = sum(n * k for n, k in pattern.items())
        if padded(fill, seq_len) != fill:
            continue
        whole = min(int(amount + _EPS), *((histogram[n] - placed[n]) // k
                                          for n, k in pattern.items()))
        if whole <= 0:
            continue
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            rows.append((n, placed[n], placed[n] + whole * k, k, sequence, offset))
            placed[n] += whole * k
            offset += n * k
        sequence += whole
    return rows, sequence, placed


def stream_cuts(total: int, seq_len: int = SEQ_LEN) -> list[int]:
    """Ends of the sequences in the stream's last part, cut at powers of two."""
    at = total // seq_len * seq_len
    ends = []
    for bit in reversed(range(seq_len.bit_length())):
        if (total - at) >> bit & 1 and total - at >= 1 << bit:
            at += 1 << bit
            ends.append(at)
    return ends


# --- assignment --------------------------------------------------------------------

def _running(table: DataFrame, key: list[str], count: str) -> DataFrame:
    """Per bucket: the sum of ``count`` over earlier buckets with the same ``key``."""
    before = Window.partitionBy(*key or [F.lit(0)]).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    return table.withColumn("before", F.coalesce(F.sum(count).over(before), F.lit(0)))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str | None = None, seq_len: int = SEQ_LEN,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Pieces of all rows of ``docs``: id, start, length, ids_crc32, doc_tokens,
    sequence_id (0, 1, ...), offset.

    A null or empty text is the end id alone. Null ids are kept; repeated rows are
    packed each. An empty table gives no pieces. Other columns of ``docs`` are not read.
    """
    rows = tokenized(docs, id_col, text_col, vocabulary, seq_len)
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("rid"), F.lit(buckets)))
    by_rid = Window.partitionBy("bucket").orderBy("rid")

    # Full sequences: a document's first one is the number of full ones before it.
    full = rows.where("size(full_crcs) > 0").select(
        "rid", "id", "doc_tokens", "full_crcs", "bucket", F.size("full_crcs").cast("long").alias("n"))
    full_base = written(_running(full.groupBy("bucket").agg(F.sum("n").alias("n")), [], "n"),
                        "full_base")
    n_full = full_base.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbered = full.withColumn(
        "own", F.sum("n").over(by_rid) - F.col("n")).join(
            full_base.select("bucket", "before"), "bucket")
    full_pieces = numbered.select(
        "id", "doc_tokens", F.posexplode("full_crcs").alias("k", "ids_crc32"), "own", "before"
    ).select("id", (F.col("k").cast("long") * seq_len).alias("start"),
             F.lit(seq_len).cast("long").alias("length"), "ids_crc32", "doc_tokens",
             (F.col("before") + F.col("own") + F.col("k")).alias("sequence_id"),
             F.lit(0).cast("long").alias("offset"))

    # Tails: rank among those of the same length, then the slot of that rank.
    tails = rows.where("tail > 0").drop("full_crcs")
    bases = written(_running(tails.groupBy("tail", "bucket").agg(F.count("*").alias("n")),
                             ["tail"], "n"), "tail_base")
    histogram = {r["tail"]: r["n"] for r in bases.groupBy("tail").agg(F.sum("n").alias("n")).collect()}
    table, n_patterned, placed = slots(
        histogram, solve_patterns(histogram, seq_len, max_rounds), seq_len)
    stream, at = [], 0  # the lengths' places in the stream
    for n in sorted(histogram):
        stream.append((n, placed[n], at))
        at += n * (histogram[n] - placed[n])
    spark = docs.sparkSession
    # Both tables have a row for each length, or for each length of each pattern.
    slot_table = F.broadcast(spark.createDataFrame(
        table, "tail long, first long, until long, times long, sequence long, place long"))
    stream_table = F.broadcast(spark.createDataFrame(
        stream, "tail long, placed long, stream_at long"))
    in_bucket = Window.partitionBy("bucket", "tail").orderBy("rid")
    ranked = (tails.withColumn("own", F.row_number().over(in_bucket) - 1)
              .join(bases.select("tail", "bucket", "before"), ["tail", "bucket"])
              .withColumn("rank", F.col("before") + F.col("own"))
              .join(stream_table, "tail"))
    turn = F.col("rank") - F.col("first")
    patterned = (ranked.where("rank < placed").drop("tail_ids").alias("t")
                 .join(slot_table.alias("s"), (F.col("t.tail") == F.col("s.tail"))
                       & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until")))
                 .select("id", (F.col("doc_tokens") - F.col("t.tail")).alias("start"),
                         F.col("t.tail").alias("length"),
                         F.col("tail_crc").alias("ids_crc32"), "doc_tokens",
                         (F.lit(n_full) + F.col("sequence") + F.floor(turn / F.col("times")))
                         .cast("long").alias("sequence_id"),
                         (F.col("place") + turn % F.col("times") * F.col("t.tail")).alias("offset")))
    streamed = ranked.where("rank >= placed").select(
        "id", "doc_tokens", "tail", "tail_ids",
        (F.col("stream_at") + (F.col("rank") - F.col("placed")) * F.col("tail")).alias("at"))
    return full_pieces.union(patterned).union(
        _stream_pieces(streamed, at, n_full + n_patterned, seq_len))


def _stream_pieces(streamed: DataFrame, total: int, first_sequence: int,
                   seq_len: int) -> DataFrame:
    """Cut the streamed tails at the sequences' ends."""
    whole = total // seq_len
    ends = np.array(stream_cuts(total, seq_len), np.int64)
    begins = np.array([whole * seq_len, *ends], np.int64)

    def pieces(at, tail):
        while tail > 0:
            number = at // seq_len
            if number < whole:
                begin, end = number * seq_len, (number + 1) * seq_len
            else:
                k = int(np.searchsorted(ends, at, side="right"))
                number, begin, end = whole + k, int(begins[k]), int(ends[k])
            length = min(tail, end - at)
            yield number, at - begin, length
            at, tail = at + length, tail - length

    def run(batches):
        for batch in batches:
            source, out = [], []
            at, tail, ids, tokens = (batch.column(c).to_pylist()
                                     for c in ("at", "tail", "tail_ids", "doc_tokens"))
            for i in range(batch.num_rows):
                done = 0
                for number, offset, length in pieces(at[i], tail[i]):
                    crc = zlib.crc32(ids[i][4 * done:4 * (done + length)])
                    source.append(i)
                    out.append((tokens[i] - tail[i] + done, length, crc, tokens[i],
                                first_sequence + number, offset))
                    done += length
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    id_type = streamed.schema["id"].dataType.simpleString()
    return streamed.mapInArrow(
        run, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long")
