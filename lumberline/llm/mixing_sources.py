"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumberline.llm.common import OWN, Stored, shuffle_partitions, text_key

#: A word is a run of other characters than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: No document is taken more often, and no source beyond this multiple of its size.
MOST = 3
SEED = 13


def size_in_words(text: Column) -> Column:
    """The number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``_llm_place``: 1, 2, 3… in ``order`` among the rows of equal ``by`` (nulls are equal).

    Rows are dealt by ranges of (``by``, ``order``), so a group of a third of all rows lies in a third of the
    partitions. A row's place is its place in its partition and the number of rows of its group in the
    partitions before. Groups lie side by side, so the table of these counts has at most one row for each
    group and each partition.
    """
    keys = [F.col(c).asc_nulls_last() for c in by] + order
    part, at = OWN + "part", OWN + "at"
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    # The lower bits of this function's numbers count the rows of a partition.
    held = Stored(dealt.withColumns({
        part: F.spark_partition_id(),
        at: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }), "numbered")
    own = [F.col(c).alias(OWN + c) for c in by]
    pieces = held.rows.groupBy(F.col(part).alias(OWN + "piece"), *own).agg(
        F.min(at).alias(OWN + "first"), F.count("*").alias(OWN + "rows"))
    before = Window.partitionBy(*[OWN + c for c in by]).orderBy(OWN + "piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn(OWN + "before", F.coalesce(F.sum(OWN + "rows").over(before), F.lit(0)))
    same = F.col(part) == F.col(OWN + "piece")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(OWN + c))
    place = F.col(at) - F.col(OWN + "first") + F.col(OWN + "before") + 1
    return held.rows.join(pieces, same).select(*rows.columns, place.alias(OWN + "place"))


def source_targets(sources: DataFrame, share: float = 1.0, most: float = MOST) -> DataFrame:
    """``source, size, weight`` with ``target``: a part of ``share`` of all sizes by weight, in words.

    No target is above ``most`` times its source's size; what is cut off goes to the others by their
    weights, until none is above. Every step is one aggregate over the sources, of which five numbers reach the
    driver. A null or negative weight counts as none.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0)).cast("double")
    held = Stored(sources.select("source", "size", weight.alias("weight")), "sources").rows
    limit = F.col("size") * F.lit(float(most))
    total, weights = held.agg(F.sum("size"), F.sum("weight")).first()
    words = float(total or 0) * share
    free, left = weights or 0.0, words

    def given() -> Column:
        return F.lit(left) * F.col("weight") / F.lit(free) if free else F.lit(0.0)

    while free:
        # As the rest only grows, a source that was above its limit stays so.
        full = given() > limit
        cut, rest = held.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if (rest or 0.0) == free:
            break
        free, left = rest or 0.0, words - (cut or 0.0)
    # Without a free source all that have a weight stand at their limits.
    target = F.least(given(), limit) if free else F.when(F.col("weight") > 0, limit).otherwise(0.0)
    return held.withColumn("target", target)


def mix(
    docs: DataFrame, weights: DataFrame, doc_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.0, most: float = MOST, seed: int = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``_llm_size``, ``_llm_source_size``, ``_llm_target`` and ``_llm_copies``: how often the mix takes it.

    ``weights`` has ``source, weight``, a source once; one that it lacks gets nothing. Every document of a source is
    expected target / size times. In the order of sizes, ids and texts these expectations are summed from
    the start of the source, one random offset in [0, 1) is added, and a document is taken once for each
    whole number that its part of the sum crosses: the number below the expectation or the one above it, and at most
    ``most`` times if that is whole. Because of the order a source's words come within one document, the longest, of
    its target. The offset depends on ``seed`` and the source only, so reruns agree.

    A null source is a source of its own. A null or empty text has size 0 and adds no words. Rows of equal ids and
    texts are documents of their own. All rows of ``docs`` come back, with all columns or those in ``keep``, which saves
    shuffling the texts where they are not wanted; an empty table gives an empty one.
    """
    kept = docs.columns if keep is None else keep
    own = [OWN + c for c in ("size", "source", "tie", "id")]
    found = (size_in_words(docs[text_col]), docs[source_col].cast("string"), text_key(docs[text_col]), docs[doc_col])
    # Words are counted once, though sizes are added up, sampled for their ranges, and sorted.
    sized = Stored(docs.select(*[docs[c] for c in kept], *[c.alias(name) for c, name in zip(found, own)]), "sizes").rows
    sizes = sized.groupBy(F.col(own[1]).alias("source")).agg(F.sum(own[0]).alias("size"))
    wanted = of_weights(weights)
    joined = sizes.join(wanted, sizes["source"].eqNullSafe(wanted[OWN + "named"]), "left").drop(OWN + "named")
    targets = source_targets(joined, share, most)
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 256), 1, 8), 16, 10)
    rates = targets.select(
        F.col("source").alias(OWN + "of"), F.col("size").alias(OWN + "source_size"), F.col("target").alias(OWN + "target"),
        F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0.0).alias(OWN + "rate"),
        (offset.cast("double") / F.lit(4294967296.0)).alias(OWN + "offset"),
    )
    placed = numbered(sized, [own[1]], [F.col(own[0]).asc(), F.col(own[3]).asc_nulls_first(), F.col(own[2]).asc()])

    def crossed(place: Column) -> Column:
        return F.floor(place * F.col(OWN + "rate") + F.col(OWN + "offset"))

    # A hot source is split by the adaptive planner; the other side has one row for it.
    found = placed.join(rates, placed[own[1]].eqNullSafe(rates[OWN + "of"]))
    copies = crossed(F.col(OWN + "place")) - crossed(F.col(OWN + "place") - 1)
    return found.select(
        *[F.col(c) for c in kept], own[0], OWN + "source_size", OWN + "target", copies.cast("long").alias(OWN + "copies"))


def of_weights(weights: DataFrame) -> DataFrame:
    return weights.select(weights["source"].cast("string").alias(OWN + "named"), weights["weight"].alias("weight"))


def repeating_weights(docs: DataFrame, source_col: str = "source", cycle: int = 3) -> DataFrame:
    """``source, weight``: the sources by code point, null last, weigh 1, 2, … ``cycle``, and so on again."""
    sources = docs.select(docs[source_col].cast("string").alias("source")).distinct()
    placed = numbered(sources, [], [F.col("source").asc_nulls_last()])
    return placed.select("source", ((F.col(OWN + "place") - 1) % cycle + 1).alias("weight"))
