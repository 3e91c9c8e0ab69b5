"""From raw documents to token ids: five stages, each on all that the one before it kept.

A row's id says which documents belong to a decision, so documents that share an id go or stay
together; a null id is an id like others. Stages but the last return the columns of documents.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantchron.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality
from grantchron.llm.queries import MULTI_BPE, for_whole_texts


def _let_go(spark: SparkSession) -> None:
    """Before a stage, the driver frees the plans and results of the one before."""
    gc.collect()
    spark._jvm.System.gc()


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns whose names clash with none that a stage makes, and these names."""
    names = {c: f"own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(own).alias(c) for c, own in names.items()))


def _with_ids(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose id has a row in kept."""
    rows, names = _renamed(docs)
    ids = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return _named(rows.join(ids, F.col(names["doc_id"]).eqNullSafe(F.col("kept_id")), "left_semi"), names)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    _let_go(spark)
    rows, names = _renamed(docs)
    labels = for_whole_texts(spark).read.parquet(f"{sf_dir}/labels.parquet")
    columns = {
        "text_col": names["text"],
        "categories": tuple(names[c] for c in quality.CATEGORIES),
        "numbers": tuple(names[c] for c in quality.NUMBERS),
    }
    labels = labels.withColumnRenamed("doc_id", names["doc_id"])
    model = quality.fit(rows, labels, id_col=names["doc_id"], **columns)
    scored = quality.score(rows, model, id_col=names["doc_id"], **columns)
    return _named(scored.filter("keep"), names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    _let_go(spark)
    return _with_ids(docs, exact_dedup.exact_dedup(docs).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that n-gram links connect the one with the smallest id."""
    _let_go(for_whole_texts(spark))
    return _with_ids(docs, ngram_join.ngram_join(docs).filter("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes the block with its first word."""
    _let_go(spark)
    rows, names = _renamed(docs)
    size = mixing.words(names["text"])
    mixed = mixing.mix(rows, id_col=names["doc_id"], source_col=names["source"], size=size)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    return _named(mixed.filter("copies > 0").select("*", copies), names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and the digest of the bytes that they decode to."""
    _let_go(for_whole_texts(spark))
    return byte_bpe.round_trip(docs, MULTI_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", classify),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mix", mix_sources),
    ("bpe", encode),
]

#: SQL has no words for a fitted classifier, a seeded mix or BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents; what a stage keeps is checkpointed for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
