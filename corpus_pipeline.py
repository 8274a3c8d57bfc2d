"""Cleaning pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the last
keep the columns of ``documents``:

1. quality rules: documents that fail the rules or the trained model go;
2. quality classifier: documents ranked below the threshold go;
3. line dedup: lines whose key ``MIN_DOCS`` distinct texts hold go from all texts
   but the first that holds them, so copies stay whole for stage 4;
4. n-gram Jaccard join: one document of each group of near duplicates stays;
5. best-fit packing: the places of all pieces in training sequences.

The models of stages 1 and 2 learn from the labelled rows of ``sf_dir``. Null and
empty texts fail stage 1; copies and repeated rows count once in stage 3 and stay
rows of their own until stage 4; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import jaccard, lines, packing, quality_rank, quality_rules
from stationflow.llm.idfiles import Encoding
from stationflow.llm.queries import BYTE_FILE, END_ID
from stationflow.llm.store import documents, saved, table

MIN_DOCS = 10
# Near duplicates share 80 % of their shingles of five words (op4_jaccard_join has
# its own contract: three words, 90 %).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.train(documents(spark, sf_dir), _labels(spark, sf_dir))
    return quality_rules.keep(docs, model)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rank.train(documents(spark, sf_dir), _labels(spark, sf_dir))
    return quality_rank.keep(docs, model)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(docs, MIN_DOCS)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(f"`{c}`" for c in docs.columns))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, Encoding(BYTE_FILE, "byte", END_ID))[1]


STAGES = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("line_dedup", lines_stage),
    ("jaccard_join", duplicates_stage),
    ("packing", packing_stage),
]

# The trained models and the packing have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
