"""Corpus pipeline: quality rules, toxicity, near-duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works
on all rows that the stage before it kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultsmith.llm._common import keep, table
from vaultsmith.llm._tokens import tokenizer_path
from vaultsmith.llm.minmax import near_duplicates
from vaultsmith.llm.packing import pack
from vaultsmith.llm.quality import quality_rules
from vaultsmith.llm.toxicity import toxicity


def _whole(docs: DataFrame) -> DataFrame:
    """Every row as one struct beside the columns that the rules read: no name can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, "doc_id", "text", "lang", "source")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, by each group's own fences as in the registered query."""
    judged = quality_rules(_whole(docs), min_docs=0, drop=("doc_id", "text"))  # the row holds both
    return judged.where("kept").select("row.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted severity is not toxic."""
    scored = toxicity(_whole(docs), table(spark, sf_dir, "labels"))
    return scored.where(~F.col("toxicity.toxic")).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, similarity 0.8 or more): that of the smallest doc_id.

    Rows are told apart by a number of their own, so a doc_id may occur with several texts and
    rows may repeat. Rows without a doc_id take no part and stay.
    """
    at = "row"
    while at in [c.lower() for c in docs.columns]:
        at += "_"
    # Written before it is read several times: the numbers must not change between the reads.
    rows = keep(docs.withColumn(at, F.monotonically_increasing_id()), "pipeline-rows")
    named = rows.where("doc_id IS NOT NULL")
    judged = near_duplicates(named, id_col=at).select(F.col("doc_id").alias(at), "component_id")
    judged = keep(judged.join(named.select(at, "doc_id"), at), "pipeline-judged")
    first = judged.groupBy("component_id").agg(F.min(F.struct("doc_id", at)).alias("x")).select(F.col(f"x.{at}").alias(at))
    dropped = keep(judged.select(at).join(first, at, "left_anti"), "pipeline-dropped")
    return rows.join(dropped, at, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, neighbours alike."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=False).drop("ids")


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The stages train a classifier and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
