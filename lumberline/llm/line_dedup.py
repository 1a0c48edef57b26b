"""Removal of lines that many sites share, with built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lumberline.llm.common import OWN, Stored

MIN_SITES = 10
#: Of a sketch: 2 ** LG_K registers, with a relative error of 1.04 / sqrt(2 ** LG_K) at most.
LG_K = 11
ERRORS = 5
BLANKS = " \t\r"


def _parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _hash(line: Column) -> Column:
    return F.xxhash64(_plain(line))


def shared_lines(
    docs: DataFrame, text_col: str, site_col: str, min_sites: int = MIN_SITES, lg_k: int = LG_K
) -> tuple[DataFrame, list[Stored]]:
    """``text, h``: each document text's key and the hash of each line of it that too many sites have.

    Lines are hashed to 128 bits. A sketch per line takes in the sites it is seen at, in the tasks
    first, so a line of a third of all documents is one row per task. Sketches that stay clearly
    below ``min_sites`` end here; near it the sites are counted exactly; above it they need not be.
    """
    own = docs.select(docs[text_col].alias("text"), docs[site_col].cast("string").alias("site"))
    lines = own.select(F.xxhash64("text").alias("text"), "site", F.explode(_parts(F.col("text"))).alias("line"))
    lines = lines.select("text", "site", _plain(F.col("line")).alias("line")).filter("line <> ''").select(
        "text", "site", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2")
    )
    sketches = lines.filter("site IS NOT NULL").groupBy("h", "h2").agg(
        F.hll_sketch_agg("site", lg_k).alias("sketch")
    )
    margin = max(1, math.ceil(ERRORS * 1.04 / math.sqrt(2**lg_k) * min_sites))
    spread = sketches.select("h", "h2", F.hll_sketch_estimate("sketch").alias("sites"))
    candidates = Stored(
        spread.filter(F.col("sites") >= min_sites - margin).select(
            "h", "h2", (F.col("sites") > min_sites + margin).alias("sure")
        ),
        "line-candidates",
    )
    found = Stored(lines.join(candidates.rows, ["h", "h2"]), "line-found")
    exact = (
        found.rows.filter("NOT sure AND site IS NOT NULL").groupBy("h", "h2")
        .agg(F.countDistinct("site").alias("sites")).filter(F.col("sites") >= min_sites).select("h", "h2")
    )
    counted = Stored(candidates.rows.filter("sure").select("h", "h2").unionByName(exact), "line-shared")
    return found.rows.join(counted.rows, ["h", "h2"], "left_semi").select("text", "h"), [candidates, found, counted]


def drop_shared_lines(
    docs: DataFrame, text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES
) -> DataFrame:
    """``docs`` with every line removed that stands at ``min_sites`` sites or more.

    Adds ``_llm_lines`` and ``_llm_removed`` (long). A line ends at a line feed; blanks around it
    don't count; empty lines are no lines to remove. A null site is no site, though shared lines go
    from its documents too. Null texts stay null and have no lines. Texts without such a line come
    out unchanged, all columns and rows as they were; a text of nothing else becomes empty.
    """
    found, _ = shared_lines(docs, text_col, site_col, min_sites)
    shared = found.groupBy("text").agg(F.collect_set("h").alias(OWN + "shared"))
    keyed = docs.withColumn(OWN + "key", F.xxhash64(docs[text_col]))
    # What is shared grows with the corpus, so it is never broadcast; copies of a hot text are split by
    # the adaptive planner.
    sets = shared.withColumnRenamed("text", OWN + "key").hint("merge")
    joined = keyed.join(sets, OWN + "key", "left")
    parts = _parts(F.col(text_col))
    kept = F.filter(parts, lambda line: ~F.array_contains(OWN + "shared", _hash(line)))
    known = F.col(OWN + "shared").isNotNull()
    total = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(parts))
    return joined.withColumns({
        OWN + "lines": total.cast("long"),
        OWN + "removed": F.when(known, F.size(parts) - F.size(kept)).otherwise(0).cast("long"),
        text_col: F.when(known, F.array_join(kept, "\n")).otherwise(F.col(text_col)),
    }).select(*docs.columns, OWN + "lines", OWN + "removed")
