"""Five stages from raw documents to encoded training text.

Each stage reads what the one before wrote. All but the last return the columns
of ``documents``; a stage either drops rows or rewrites ``text`` (and ``n_chars`` with it).

An empty table passes through all stages. Rows without a text have no language and go in the first
stage. Rows without an id are kept wherever a decision rests on ids. Repeated rows of an id stay or go
together, texts may have any length, and of near duplicates the smallest id stays. Columns beyond
those of ``documents`` are left out.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, shared_dir
from voxelark.llm import decontaminate, language, minhash, pieces, suffixes
from voxelark.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose id is not among the dropped ones; their few ids are joined by measured size."""
    ids = dropped.select("doc_id").distinct().withColumn("__dropped", F.lit(True))
    return attach(docs, ids, ["doc_id"], "left", "dropped").filter(F.col("__dropped").isNull()).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null texts, texts without a letter, ambiguous decisions."""
    model = language.fit(docs)
    said = language.predict(docs, model)
    return _without(docs, said.filter("ambiguous"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of every group (shingles of five words, similarity 0.8)."""
    return _without(docs, minhash.near_duplicates(docs, width=5).filter(~F.col("kept")))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes strings of 100 bytes that start earlier; documents of which nothing remains are dropped."""
    rest = suffixes.cleaned(docs.select(*COLUMNS))
    return rest.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).filter(
        "text is null or char_length(trim(text)) > 0"
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and checksums of the encoded documents."""
    return pieces.digests(pieces.encode_texts(docs, public_tokenizers.path(pieces.MODEL)))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", cut_repeated_strings),
    ("contamination", drop_contaminated),
    ("pieces", encode),
]
#: A learned classifier and a tokenizer are among the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
