"""The corpus pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import table, with_keys, written
from stratalake.llm.domain_mixing import mix_domains
from stratalake.llm.queries import DOMAIN_WEIGHTS, labelled_domains
from stratalake.llm.retrieval_packing import pack
from stratalake.llm.run_index import cut_repeats, keyed
from stratalake.llm.shingle_forest import shingle_join
from stratalake.llm.site_quality import site_quality


#: Columns of documents that stages look at.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def sheltered(stage: Stage) -> Stage:
    """Other columns go through a stage under plain names and come out under their own, whatever these are."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [name if name in KNOWN else f"column_{i}" for i, name in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*plain), sf_dir).toDF(*docs.columns)

    return run


@sheltered
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site's record call good."""
    judged = site_quality(docs, table(spark, sf_dir, "labels"))
    bad = written(judged.filter("not kept").select("doc_id", F.col("tid").alias("__tid")).distinct(), "rejected")
    return with_keys(keyed(docs), bad, ["doc_id", "__tid"], "left_anti").drop("__tid")


@sheltered
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, repeated rows and rows without a doc_id among them.

    Each row takes part under a number of its own. Of a group the row with the least
    doc_id stays, null last; ties go by a hash of the text, then of all columns but maps.
    """
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    classes = shingle_join(rows.select(F.col("__row").alias("doc_id"), "text"))
    grouped = written(classes.filter("n_links > 0").select(F.col("doc_id").alias("__row"), "class_id"), "grouped")
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64(*hashed), "__row")
    placed = with_keys(rows.select("__row", place.alias("place")), grouped.select("__row"), ["__row"]).join(grouped, "__row")
    # a minimum per group is combined before the shuffle, so a large group does not meet in one task
    first = placed.groupBy("class_id").agg(F.min("place").alias("place")).select(F.col("place.__row").alias("__row"))
    others = written(grouped.select("__row").join(first, "__row", "left_anti"), "duplicates")
    return with_keys(rows, others, ["__row"], "left_anti").drop("__row")


@sheltered
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 200 bytes or more that occur more than once; blank texts go."""
    cut = cut_repeats(docs).filter(F.trim("text") != "")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


@sheltered
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the domains' words approach the target shares; every document stays."""
    rates = mix_domains(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS, floor=1.0)
    more = written(rates.filter("copies > 1").select("doc_id", "tid", "copies"), "copies")
    more = more.select(F.col("doc_id").alias("__id"), F.col("tid").alias("__text"), F.col("copies").alias("__copies"))
    rows = keyed(docs)
    joined = rows.join(more, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__tid") == F.col("__text")), "left")
    copies = F.explode(F.sequence(F.lit(1), F.coalesce("__copies", F.lit(1))))
    return joined.withColumn("__copy", copies).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 ids, lexical neighbours together, copies apart."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1, window=2048)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixing", mixing),
    ("packing", packing),
]
#: The classifier, the forest and the packing cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
