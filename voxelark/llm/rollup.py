"""Token counts kept as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed changes: an insert
adds a document and its tokens, a delete takes them away, a revision takes the old
count away and adds the new one. A batch of changes is added up first (pre-aggregated
before its shuffle) and written as one small table under its batch id; totals are the sum
of all committed batches, so no document is ever counted again.

Commits are idempotent. A batch counts only once it is complete (Spark's success
marker, written last by the job that wrote it); committing an id again changes
nothing, and the part files of a failed attempt are overwritten by the next one.

Null sources and languages are groups of their own. A null text is a document without
tokens. Groups whose changes cancel out have no total. Repeated rows count repeatedly. An empty table has
no totals, texts may have any length, and extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, shared_dir
from voxelark.llm.common import slices, stored, table

KEYS = ["source", "lang", "tokenizer"]
TOKENIZER = "byte_bpe_50k"


class TokenRollup:
    """Committed batches of changes below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/batch={batch_id}/_SUCCESS"))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of (source, lang, tokenizer, n_docs, n_tokens) changes; False if it was there already."""
        if self.committed(batch_id):
            return False
        sums = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return True

    def totals(self) -> DataFrame:
        """Sums over the committed batches; groups that cancelled out are left away."""
        folders = [f.getPath().toString() for f in self._fs.listStatus(self._path(self.path))] if self._fs.exists(self._path(self.path)) else []
        complete = [f for f in folders if self._fs.exists(self._path(f"{f}/_SUCCESS"))]
        schema = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
        rows = self.spark.read.schema(schema).parquet(*complete) if complete else self.spark.createDataFrame([], schema)
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 or n_tokens <> 0")


def inserts(counts: DataFrame, count: str = "n_tokens", tokenizer: str = TOKENIZER, sign: int = 1) -> DataFrame:
    """Changes that add (or with sign -1 take away) documents with their counts."""
    return counts.select(
        "source",
        "lang",
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("long").alias("n_docs"),
        (F.col(count) * sign).cast("long").alias("n_tokens"),
    )


def deletes(counts: DataFrame, count: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    return inserts(counts, count, tokenizer, -1)


def revisions(counts: DataFrame, old: str, old_tokenizer: str, new: str, new_tokenizer: str) -> DataFrame:
    """Changes that replace a count and its tokenizer version by others."""
    return deletes(counts, old, old_tokenizer).unionByName(inserts(counts, new, new_tokenizer))


@lru_cache(maxsize=1)
def _encoder(lines: bytes, pattern: str):
    """The encoder of a worker process; later tasks of the process find it ready."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("rollup", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, source, lang, mark, estimate, n_tokens) of every document; ``mark`` tells rows of one id by their text.

    The ranks reach the workers as a broadcast of a file of fixed size (below 1 MB for 50,000 tokens).
    """
    with open(ranks_path, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(lines.value, pattern)
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            n = [len(encoder.encode_ordinary(t)) if t else 0 for t in texts]
            rest = batch.select(["doc_id", "source", "lang", "mark", "estimate"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(n, pa.int64())], names=[*rest.schema.names, "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64("text").alias("mark"),
        F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4).cast("long").alias("estimate"),
        "text",
    )
    return rows.mapInArrow(run, "doc_id long, source string, lang string, mark long, estimate long, n_tokens long")


def later_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, mark): rows whose text is that of a row with a smaller doc_id.

    Groups of equal texts are reduced to their smallest id before the shuffle, and only groups with
    two ids are joined back, by measured size and with hot texts salted.
    """
    prints = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("mark"),
        F.unhex(F.sha2("text", 256)).alias("text_print"),
    )
    prints = prints.filter("doc_id is not null and text_print is not null")
    groups = prints.groupBy("text_print").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    return attach(prints, groups, ["text_print"], "inner", "copies").filter("doc_id > first").select("doc_id", "mark")


def rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading estimates of all documents, revising them to token counts, and deleting later copies."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    counts, _ = stored(token_counts(docs, public_tokenizers.path(f"{TOKENIZER}.tiktoken"), public_tokenizers.PATTERN), "token-counts")
    gone = later_copies(docs).distinct().withColumn("gone", F.lit(True))
    copies = attach(counts, gone, ["doc_id", "mark"], "inner", "gone")
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/voxelark-llm/rollup-{uuid.uuid4().hex}")
    rollup.commit("load", inserts(counts, "estimate", "quarter_bytes"))
    rollup.commit("revise", revisions(counts, "estimate", "quarter_bytes", "n_tokens", TOKENIZER))
    rollup.commit("revise", revisions(counts, "estimate", "quarter_bytes", "n_tokens", TOKENIZER))
    rollup.commit("copies", deletes(copies))
    return rollup.totals()


QUERIES = {"op1_token_rollup": rollup_query}
ORACLES: dict[str, str] = {}
