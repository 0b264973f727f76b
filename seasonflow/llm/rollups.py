"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are kept as additive, signed sums: each
batch of changes (inserts, deletes, revisions) is reduced to one row for each group and
committed under its batch id in a folder of the shared store. A committed batch is
recognised by the marker that Spark writes when a job commits, so committing a batch
again, in whole or after a failure half-way, changes nothing. The totals are the sum
over the committed batches and never need the documents again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Tokenizer versions as patterns of one token (fixed values, same in Java and RE2).
TOKENIZERS = {
    "words.v1": r"[^\x20\x09-\x0D]+",
    "words.v2": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]",
}
GROUP = ("source", "lang", "tokenizer")


def token_count(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a whole text; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def inserts(docs: DataFrame, counts: Mapping[str, str], sign: int = 1) -> DataFrame:
    """Signed rows (source, lang, tokenizer, docs, tokens) for documents that come, or go
    with ``sign`` -1. ``counts`` names the column that has each tokenizer's count."""
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("tokenizer"),
                                        (F.col(f"`{c}`") * sign).cast("long").alias("tokens"))
                               for t, c in counts.items()]))
    return docs.select("source", "lang", each.alias("t")).select(
        "source", "lang", "t.tokenizer", F.lit(sign).cast("long").alias("docs"), "t.tokens")


def deletes(docs: DataFrame, counts: Mapping[str, str]) -> DataFrame:
    return inserts(docs, counts, -1)


def revisions(docs: DataFrame, old: Mapping[str, str], new: Mapping[str, str]) -> DataFrame:
    """Documents whose counts change from the columns ``old`` to the columns ``new``."""
    return deletes(docs, old).union(inserts(docs, new))


class Rollup:
    """A rollup in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{checkpoint_dir(spark)}/rollup-{uuid.uuid4().hex[:12]}"

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def committed(self) -> list[str]:
        """Paths of the batches whose job has committed."""
        fs, root = self._fs(self.path)
        if not fs.exists(root):
            return []
        paths = sorted(s.getPath().toString() for s in fs.listStatus(root))
        return [p for p in paths if self._done(p)]

    def _done(self, path: str) -> bool:
        fs, marker = self._fs(f"{path}/_SUCCESS")
        return fs.exists(marker)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add the signed rows ``changes`` as batch ``batch_id``; False if it is there
        already. What a failed attempt left is overwritten."""
        path = f"{self.path}/batch={batch_id}"
        if self._done(path):
            return False
        # summed in every task before the shuffle: a hot source is a few rows per task
        (changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(path))
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches; groups whose
        documents have all gone are left out. Null sources and languages are groups."""
        schema = "source string, lang string, tokenizer string, docs long, tokens long"
        paths = self.committed()
        rows = (self.spark.read.schema(schema).parquet(*paths) if paths
                else self.spark.createDataFrame([], schema))
        return (rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs <> 0 or tokens <> 0"))


def counted(docs: DataFrame, text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang") -> DataFrame:
    """source, lang and, for each tokenizer, the tokens of each text (``n <tokenizer>``)
    and of its distinct lines (``u <tokenizer>``). Repeated rows are documents of their
    own; extra columns are not read."""
    text = F.col(f"`{text_col}`")
    once = F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")
    return docs.select(
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        *(token_count(text, t).alias(f"n {t}") for t in TOKENIZERS),
        *(token_count(once, t).alias(f"u {t}") for t in TOKENIZERS))
