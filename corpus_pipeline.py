"""The corpus pipeline: toxic documents out, shared lines out, near copies out, repeats out, packing.

Every stage takes any rows: a null text stays null until packing, where it is empty, like an empty one a document of one
id; of rows that share an id and are near copies one stays; rows with a null id are never near copies; other columns come
back as they are. An empty table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lumberline.datasets import read_table
from lumberline.llm import line_dedup, packing, simhash, substring_dedup, toxicity
from lumberline.llm.common import OWN, Stored
from lumberline.llm.queries import WORD_BPE


def _same_columns(docs: DataFrame, made: DataFrame) -> DataFrame:
    """The columns of ``docs``, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made.select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go; it learns from ``labels`` and these documents."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.filter(F.col(OWN + "score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten sources or more share go from the texts; documents stay."""
    return _same_columns(docs, line_dedup.drop_shared_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    return simhash.drop_near_duplicates(docs).select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; what stands around them stays as it is, white space included."""
    found = substring_dedup.drop_repeated_passages(docs, spaces=True)
    text = F.when(F.col(OWN + "removed") > 0, F.col(OWN + "kept")).otherwise(F.col("text"))
    return _same_columns(docs, found.withColumn("text", text))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    return packing.pack(docs, WORD_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]

#: Neither a trained classifier nor packing can be put in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir), f"stage-{name}").rows
    return docs
