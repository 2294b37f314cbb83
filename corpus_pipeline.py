"""The corpus pipeline: documents pass through the operators of ``gleaner.llm`` one after another."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.decontamination import clean_documents
from gleaner.llm.mixing import mix
from gleaner.llm.near_duplicates import NearDuplicateParams, near_duplicates
from gleaner.llm.sharding import shard
from gleaner.llm.toxicity import judge
from gleaner.operators.ordered import numbered
from gleaner.session import cut_lineage, ensure_checkpoint_dir


def beside(docs: DataFrame, names: Sequence[str], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply`` to the documents, whose own columns of the given names keep their values beside the ones it makes.
    Names count without regard to case, as Spark's do."""
    made = {n.lower() for n in names}
    aside = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c.lower() in made}
    out = apply(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return beside(docs, ["toxicity", "rejected"], lambda d: judge(d, labels).filter("not rejected"))


# Near duplicates share four fifths of their five-word shingles. A pair at that limit is missed with probability 3e-6.
NEAR = NearDuplicateParams(shingle=5, similarity=80, bands=24, rows=4, slack=0.25, hub_rounds=0)


def with_text_ids(docs: DataFrame) -> DataFrame:
    """The rows with a doc_id and ``__text_id``: the doc_id, but an id of its own, after all doc_ids, for each text that
    shares its doc_id with other texts and is not the first of them by MD5."""
    md5 = F.coalesce(F.md5("text"), F.lit(""))
    rows = docs.filter("doc_id is not null").withColumns({"__id": F.col("doc_id").cast("long"), "__md5": md5})
    texts = rows.select("__id", "__md5").distinct()
    firsts = texts.groupBy("__id").agg(F.min("__md5").alias("__first"), F.count("*").alias("__n")).filter("__n > 1")
    others = cut_lineage(texts.join(firsts, "__id").filter("__md5 != __first").select("__id", "__md5"))
    if others.isEmpty():
        return rows.withColumn("__text_id", F.col("__id"))
    most = texts.agg(F.max("__id")).first()[0]
    others = numbered(others, ["__id", "__md5"], "__text_id", first=most + 1)
    return rows.join(others, ["__id", "__md5"], "left").withColumn("__text_id", F.coalesce("__text_id", "__id"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id. Rows that repeat a doc_id and text count
    once, by the first of their other columns in the order of their JSON; of the texts that share a doc_id, those after the first by MD5 are documents
    of their own, which come after all others. Rows without an id stay."""
    rows = with_text_ids(docs)
    judged = near_duplicates(rows.select(F.col("__text_id").alias("doc_id"), "text"), NEAR)
    kept = judged.filter("kept").select(F.col("doc_id").alias("__text_id"))
    counts = cut_lineage(kept.groupBy("__text_id").agg(F.count("*").alias("__copies")))
    known = rows.join(counts, "__text_id")
    once, repeated = known.filter("__copies = 1"), known.filter("__copies > 1")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = repeated.groupBy("__text_id").agg(F.min_by(whole, F.to_json(others)).alias("__row")).select("__row.*")
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(first).unionByName(docs.filter("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


MIXED = ["mix_epoch", "mix_tokens", "mix_weight", "mix_block", "mix_order"]


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; those of small sources come up to twice, by the mixture's weights."""
    return beside(docs, MIXED, mix)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it, in place of columns of these names."""
    return shard(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# The learned scores of the first stage have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
