"""Joins by nearness in time: as-of, interval and band joins.

Spark joins by equality. A join by order or range alone would compare every row with every other, so time is cut
into buckets here, and rows meet by bucket. What the joins take in as times may be a timestamp with or without a zone, a
date or a whole number; widths are intervals such as "1 hour", or whole numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, TimestampNTZType, TimestampType

DAY = 86_400_000_000
#: A level of buckets is so many times as wide as the one below, as a power of two.
FAN_BITS = 4
#: A bucket that holds more than this many rows and this part of all of them is dealt to several tasks.
ROWS_PER_SHARE, SHARES = 100_000, 1000


def position(column: Column, kind: DataType) -> Column:
    """A time as a whole number: microseconds since 1970 on its own clock, or the number itself."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, TimestampNTZType):
        # By parts, because a cast to an instant would depend on the session's zone.
        seconds = F.unix_date(column.cast("date")) * F.lit(86_400).cast("long") + F.hour(column) * 3600 + F.minute(column) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(column) * F.lit(DAY)
    if isinstance(kind, IntegralType):
        return column.cast("long")
    raise TypeError(f"{kind.simpleString()} is neither a time nor a whole number")


def width(interval: str | int) -> Column:
    """An interval as a whole number."""
    if isinstance(interval, str):
        return F.unix_micros(F.expr(f"timestamp_micros(0) + INTERVAL {interval}"))
    return F.lit(interval).cast("long")


def _start(at: Column, of: Column) -> Column:
    """The start of the bucket that a position is in."""
    return at - F.pmod(at, of)


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def _positioned(df: DataFrame, by: Sequence[str], names: list[str], **positions: str) -> DataFrame:
    """Keys and positions under names of our own, and the whole row."""
    keys = [df[c].alias(k) for c, k in zip(by, names)]
    places = [position(df[c], df.schema[c].dataType).alias(name) for name, c in positions.items()]
    return df.select(*keys, *places, F.struct(*[df[c] for c in df.columns]).alias("row"))


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    right_on: str | None = None,
    tolerance: str | int | None = None,
    direction: str = "backward",
    strict: bool = False,
    how: str = "left",
    bucket: str | int = "1 hour",
    prefix: str = "right_",
) -> DataFrame:
    """Every row of ``left`` with the latest row of ``right`` at or before its time, among those of equal ``by``.

    ``direction="forward"`` takes the earliest at or after it; ``strict`` leaves out the same time; ``tolerance`` is
    the farthest that counts. The columns of ``right`` but for ``by`` come with ``prefix``, NULL where no row is
    found; ``how="inner"`` drops such rows. Of several right rows of that time the one whose columns are
    greatest, in their order, is taken, so columns of ``right`` must have an order (no maps). Rows with a NULL time
    or key find nothing and are found by none.

    Both sides are cut into buckets of time, and a window over each key's bucket finds the rows inside it. What
    was last before a bucket is carried into it as one more row: for that, the right side is reduced to its last
    row per key and bucket. So a key that holds a third of all rows is spread over its buckets; ``bucket`` should
    be so wide that a key's rows of one bucket fit a task, and the buckets of one key too.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    names = [f"key{k}" for k in range(len(by))]
    others = [c for c in right.columns if c not in by]
    known_of = F.struct("at", F.struct(*[F.col(f"row.`{c}`") for c in others]).alias("row"))
    asking = _positioned(left, by, names, at=on)
    found = _positioned(right, by, names, at=right_on or on)
    if direction == "forward":
        # The same on a clock that runs backwards.
        asking, found = (df.withColumn("at", -F.col("at")) for df in (asking, found))
    some = _all_known([*names, "at"])
    of = width(bucket)
    place = [*names, "bucket"]
    found, asks = _finer(*[df.filter(some).withColumn("bucket", _start(F.col("at"), of)) for df in (found, asking)], place, of)
    found = found.select(*place, known_of.alias("known"))
    # One row per bucket and task leaves the tasks of either side.
    heads = found.withColumn("asks", F.lit(False)).unionByName(
        asks.select(*place).withColumn("asks", F.lit(True)), allowMissingColumns=True
    ).groupBy(*place).agg(F.max("known").alias("known"), F.max("asks").alias("asks"))
    before = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.withColumn("known", F.max("known").over(before)).filter("asks AND known IS NOT NULL").drop("asks")

    meets = found.unionByName(carried).select(*place, F.col("known.at").alias("at"), "known", F.lit(False).alias("asks"))
    rows = meets.unionByName(asks.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    same_time = F.col("asks").desc() if strict else F.col("asks").asc()
    so_far = Window.partitionBy(*place).orderBy("at", same_time).rowsBetween(Window.unboundedPreceding, 0)
    matched = rows.withColumn("known", F.max("known").over(so_far)).filter("asks")
    if tolerance is not None:
        near = F.col("at") - F.col("known.at") <= width(tolerance)
        matched = matched.withColumn("known", F.when(near, F.col("known")))
    matched = matched.select("row", "known")
    if how == "inner":
        matched = matched.filter(F.col("known").isNotNull())
    else:
        matched = matched.unionByName(asking.filter(~some).select("row"), allowMissingColumns=True)
    own = [F.col(f"row.`{c}`").alias(c) for c in left.columns]
    return matched.select(*own, *[F.col(f"known.row.`{c}`").alias(prefix + c) for c in others])


def _finer(left: DataFrame, right: DataFrame, place: list[str], of: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides with hot buckets cut into as many narrower ones as they have too many rows, by the rows of both."""
    counts = left.select(*place).unionByName(right.select(*place)).groupBy(*place).count()
    hot = _hot(counts, place)
    if hot is None:
        return left, right
    narrow = F.greatest(F.lit(1), F.floor(of / F.coalesce("shares", F.lit(1)))).cast("long")
    inside = F.col("at") - F.col("bucket")
    start = F.when(F.col("shares").isNull(), F.col("bucket")).otherwise(F.col("at") - F.pmod(inside, narrow))
    cut = [df.join(hot, place, "left").withColumn("bucket", start).drop("shares") for df in (left, right)]
    return cut[0], cut[1]


def _hot(counts: DataFrame, place: list[str]) -> DataFrame | None:
    """The hot buckets among ``counts``, and into how many ``shares`` each is to be cut; None if there is none.

    A hot bucket has more than a thousandth of the rows, so there are at most a thousand, few enough for
    every task to know.
    """
    total, largest = counts.agg(F.sum("count"), F.max("count")).first()
    most = max(ROWS_PER_SHARE, -(-(total or 0) // SHARES))
    if (largest or 0) <= most:
        return None
    shares = F.ceil(F.col("count") / most).cast("int").alias("shares")
    return F.broadcast(counts.filter(F.col("count") > most).select(*place, shares))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[str] = (),
    bucket: str | int = "1 hour",
    prefix: str = "right_",
) -> DataFrame:
    """All pairs of rows of equal ``by`` whose half-open spans ``[start, end)`` overlap, each pair once.

    The columns of ``right`` but for ``by`` come with ``prefix``. Empty spans, and rows with a NULL bound or
    key, overlap nothing.
    """
    return _overlaps(
        _spans(left, by, *left_span), _spans(right, by, *right_span), left.columns,
        [c for c in right.columns if c not in by], len(by), width(bucket), prefix)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    span: tuple[str, str],
    by: Sequence[str] = (),
    bucket: str | int = "1 hour",
    prefix: str = "right_",
) -> DataFrame:
    """All pairs of a row of ``points`` and one of ``intervals`` with ``start <= at < end`` and equal ``by``."""
    return _overlaps(
        _spans(points, by, at, None), _spans(intervals, by, *span), points.columns,
        [c for c in intervals.columns if c not in by], len(by), width(bucket), prefix, (F.lit(1), None))


def band_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    within: str | int,
    right_on: str | None = None,
    by: Sequence[str] = (),
    prefix: str = "right_",
) -> DataFrame:
    """All pairs of rows of equal ``by`` whose times are at most ``within`` apart."""
    around = _spans(right, by, right_on or on, None)
    around = around.withColumns({"start": F.col("start") - width(within), "end": F.col("end") + width(within)})
    lengths = F.lit(1), 2 * width(within) + 1
    return _overlaps(
        _spans(left, by, on, None), around, left.columns, [c for c in right.columns if c not in by], len(by),
        F.greatest(width(within), F.lit(1)), prefix, lengths)


def _spans(df: DataFrame, by: Sequence[str], start: str, end: str | None) -> DataFrame:
    """``key…, start, end, row``; a single time is a span that holds it alone."""
    names = [f"key{k}" for k in range(len(by))]
    if end is None:
        rows = _positioned(df, by, names, start=start).withColumn("end", F.col("start") + 1)
    else:
        rows = _positioned(df, by, names, start=start, end=end)
    return rows.filter(_all_known([*names, "start", "end"]) & (F.col("start") < F.col("end")))


def _overlaps(
    left: DataFrame, right: DataFrame, columns: list[str], others: list[str], keys: int, of: Column, prefix: str,
    lengths: tuple[Column | None, Column | None] = (None, None),
) -> DataFrame:
    """Pairs of overlapping spans. ``lengths`` says how long all spans of a side are, where they are alike.

    A span belongs to the lowest level whose buckets are no shorter than it, each level's buckets being 16 times as
    wide as those below. It stands in each bucket of its level that it touches (at most two), and as a visitor in those of the
    levels above that the other side has. Two spans meet on the level of the longer one, in the first
    bucket that both touch; so long spans are never cut into many short ones, and short ones never meet
    across a long bucket unless one of them belongs there.
    """
    left, right = (df.withColumn("level", _level(F.col("end") - F.col("start"), of)) for df in (left, right))
    # Levels are powers of 16 of a width, so there are at most 16 of them.
    one = left.sparkSession.range(1)
    levels = [
        sorted(r["level"] for r in (
            df.select("level").distinct() if length is None else one.select(_level(length, of).alias("level"))).collect())
        for df, length in zip((left, right), lengths)
    ]
    place = [f"key{k}" for k in range(keys)] + ["at_level", "bucket"]
    standing = _standing(left, of, levels[1], "l"), _standing(right, of, levels[0], "r")
    left_all, right_all = _dealt(*standing, place)
    meets = [*place, "share"]
    own_l, own_r = F.col("l_level") == F.col("at_level"), F.col("r_level") == F.col("at_level")
    overlap = (F.col("l_start") < F.col("r_end")) & (F.col("r_start") < F.col("l_end"))
    once = F.col("bucket") == F.greatest("l_first", "r_first")
    pairs = left_all.filter(own_l).join(right_all, meets).unionByName(left_all.filter(~own_l).join(right_all.filter(own_r), meets))
    pairs = pairs.filter(overlap & once)
    own = [F.col(f"l_row.`{c}`").alias(c) for c in columns]
    return pairs.select(*own, *[F.col(f"r_row.`{c}`").alias(prefix + c) for c in others])


def _level(length: Column, of: Column) -> Column:
    steps = F.log(F.greatest(length / of, F.lit(1.0))) / F.log(F.lit(float(1 << FAN_BITS)))
    return F.ceil(steps).cast("int")


def _standing(df: DataFrame, of: Column, others: list[int], side: str) -> DataFrame:
    """The spans in the buckets where they stand, columns named by side."""
    above = F.filter(F.array(*[F.lit(level) for level in others]).cast("array<int>"), lambda x: x > F.col("level"))
    rows = df.withColumn("at_level", F.explode(F.concat(F.array("level"), above)))
    wide = of * F.pow(F.lit(float(1 << FAN_BITS)), F.col("at_level")).cast("long")
    rows = rows.withColumn("wide", wide).withColumn("first", _start(F.col("start"), F.col("wide")))
    buckets = F.sequence(F.col("first"), _start(F.col("end") - 1, F.col("wide")), F.col("wide"))
    named = [F.col(c).alias(f"{side}_{c}") for c in ("start", "end", "level", "first", "row")]
    keys = [c for c in df.columns if c.startswith("key")]
    return rows.select(*keys, "at_level", F.explode(buckets).alias("bucket"), *named)


def _dealt(left: DataFrame, right: DataFrame, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``share``: the left rows of a hot bucket are dealt to shares, the right ones go to each of them."""
    hot = _hot(left.groupBy(*place).count(), place)
    if hot is None:
        return left.withColumn("share", F.lit(0)), right.withColumn("share", F.lit(0))
    n = F.coalesce("shares", F.lit(1))
    dealt = F.pmod(F.xxhash64(*left.columns), n).cast("int")
    left = left.join(hot, place, "left").withColumn("share", dealt).drop("shares")
    right = right.join(hot, place, "left").withColumn("share", F.explode(F.sequence(F.lit(0), n - 1))).drop("shares")
    return left, right
