"""From raw documents to a training mixture, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of documents; rows without a doc_id, or with one
that other rows have, pass the stages like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import decontaminate, jaccard, mixing, pii, quality
from roomtide.llm.queries import learned_quality, table
from roomtide.session import materialise, scratch

LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality.score(docs, learned_quality(spark, sf_dir), docs.columns, out="__score")
    return scored.where(F.col("__score") >= LEAST_QUALITY).select(*docs.columns)


def _codes(columns: list[str]) -> list[Column]:
    """Two 64-bit codes of a row, nulls told from values."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest id.

    A row is known by a code of all its columns, so ids may be missing or come twice; rows
    without an id come last, and rows that are equal in all columns (by 128 bits) are one.
    Which rows stay is decided among ids and codes; the texts are joined with it once.
    """
    code, check = _codes(docs.columns)
    with scratch(spark):
        groups = jaccard.jaccard_components(docs.select(code.alias("row"), "text"), key="row")
        ids = docs.select(code.alias("row"), "doc_id")
        kept = materialise(
            groups.select(F.col("doc_id").alias("row"), "component_id").distinct()
            .join(ids.hint("merge"), "row").groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
                 .alias("first")).select(F.col("first.row").alias("__row")), "kept", outlive=True)
    return (docs.withColumns({"__row": code, "__check": check})
            .join(kept.hint("merge"), "__row", "left_semi")
            .dropDuplicates(["__row", "__check"]).select(*docs.columns))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them. An item shorter than a q-gram, as `42`,
    stands in most texts by chance and drops none."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), docs.columns,
                               out="__hits", least=decontaminate.Q)
    return found.where(F.size("__hits") == 0).select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    found = pii.find(docs, pii.train(docs), docs.columns, prefix="__")
    new = {"text": F.col("__clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("__clean").cast(docs.schema["n_chars"].dataType)
    return found.withColumns(new).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents with their epoch and the code that orders their block."""
    return mixing.mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]

# Neither the classifier nor the tagger can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, outlive=True)
    return STAGES[-1][1](spark, docs, sf_dir)
