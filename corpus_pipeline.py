"""A corpus through the text operators, one stage after another, each written and read again."""

from __future__ import annotations

import gc
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from seriesmill.llm.common import free_name, recording, remove, scratch, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line chunks that occur before; their length is counted anew.

    One that lost lines and has fewer words left than the first stage asks for is a copy of others: it goes.
    """
    counts = tuple(free_name(docs, name) for name in ("chunks_removed", "lines_removed"))
    rows = line_dedup.remove_repeated_chunks(docs, counts=counts)
    words = F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    whole = rows.where((F.col(f"`{counts[1]}`") == 0) | (words >= quality_rules.LEAST_WORDS)).drop(*counts)
    return whole.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least doc_id."""
    return jaccard_join.one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with a checksum of their ids."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: Scratch folders of the stages so far. A stage begins when the one before has been written.
_scratch: list[str] = []


def _stage(function: Callable) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _scratch)
        # Spark drops the shuffles and broadcasts of the stage before as its plans are collected.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        with recording(_scratch):
            return function(spark, docs, sf_dir)

    return run_stage


#: (name, function of the session, the documents and the folder of the tables).
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", _stage(good_documents)),
    ("line dedup", _stage(new_lines)),
    ("n-gram Jaccard join", _stage(distinct_documents)),
    ("benchmark decontamination", _stage(clean_documents)),
    ("packing", _stage(packed)),
]

#: The model of the first stage is fitted by iteration, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
