"""Resampling towards a target distribution by hashed n-gram importance weights.

Texts are cut into lines by line feeds. The features inside a line are counted once for all texts that hold the line,
and multiplied by how often it stands there; n-grams that reach over a line's end are counted per text and added.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from lumberline.llm.common import OWN, Stored
from lumberline.llm.words import Words, flat, slices

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Words are runs of letters a to z, digits and characters beyond ASCII, after A to Z became a to z.
_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)

_LINES = "h long, h2 long, n_lines long, n_words long, n_features long, buckets array<int>"


def words_of(texts: pa.Array) -> Words:
    data, offsets = flat(pc.fill_null(texts, ""))
    plain = pa.py_buffer(_PLAIN[data].tobytes())
    made = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64).tobytes()), plain)
    return Words(made, lower=False)


class _Runs:
    """Hashed runs of consecutive words."""

    def __init__(self, words: Words, buckets: int):
        self.words, self.buckets = words, buckets
        self.joined: tuple[memoryview, np.ndarray, np.ndarray] | None = None

    def hashed(self, n: int, at: np.ndarray) -> np.ndarray:
        """Buckets of the runs of ``n`` words that begin at the given words."""
        if n == 1:
            codes, distinct = self.words.coded()
            crc = np.fromiter(map(zlib.crc32, distinct.cast(pa.large_binary()).to_pylist()), np.int64, len(distinct))
            return (crc % self.buckets)[codes][at]
        if self.joined is None:
            joined, starts, ends = self.words.bytes()
            self.joined = memoryview(joined), starts, ends
        joined, starts, ends = self.joined
        spans = zip(starts[at].tolist(), ends[at + n - 1].tolist())
        return np.fromiter((zlib.crc32(joined[a:b]) for a, b in spans), np.int64, len(at)) % self.buckets


def _line_features(lines: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features inside each line, one line after the other: buckets, how many, and the number of words."""
    words = words_of(lines)
    line, runs, found, owner = words.document(), _Runs(words, buckets), [], []
    for n in range(1, longest + 1):
        at = np.flatnonzero(line[: max(0, len(line) - n + 1)] == line[n - 1 :])
        found.append(runs.hashed(n, at))
        owner.append(line[at])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(lines)), words.counts


def _cross_features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The features of each text that reach over a line's end: buckets and their texts' numbers."""
    parts = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    offsets = parts.offsets.to_numpy()
    words = words_of(parts.values.slice(offsets[0], offsets[-1] - offsets[0]))
    line = words.document()
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))[line]
    runs, found, owner = _Runs(words, buckets), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in range(2, longest + 1):
        last = max(0, len(line) - n + 1)
        at = np.flatnonzero((text[:last] == text[n - 1 :]) & (line[:last] != line[n - 1 :]))
        found.append(runs.hashed(n, at))
        owner.append(text[at])
    return np.concatenate(found), np.concatenate(owner)


def _two_hashes(text: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(text).alias(a), F.xxhash64(F.lit(1), text).alias(b)]


def _tally(counts: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])


class Features:
    """The features of a table's texts, each distinct line's counted once."""

    def __init__(self, rows: DataFrame, text_col: str, longest: int = LONGEST, buckets: int = BUCKETS):
        self.texts = rows.select(rows[text_col].alias("text")).filter("text IS NOT NULL")
        self.longest, self.buckets = longest, buckets
        lines = self.texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).filter("line <> ''")
        counted = lines.groupBy("line").count().select(*_two_hashes(F.col("line"), "h", "h2"), "count", "line")

        def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                line = batch.column(3)
                for start, stop in slices(line):
                    found, n, words = _line_features(line.slice(start, stop - start), longest, buckets)
                    ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(ends, pa.array(found.astype(np.int32)))
                    own = [batch.column(k).slice(start, stop - start) for k in range(3)]
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(words), pa.array(n), lists], ["h", "h2", "n_lines", "n_words", "n_features", "buckets"])

        self.lines = Stored(counted.mapInArrow(extract, _LINES), "distinct-lines")

    def counts(self) -> DataFrame:
        """``bucket, n``: how often the table has a feature of the bucket."""
        buckets, longest = self.buckets, self.longest

        def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, np.int64)
            for batch in batches:
                sizes, times = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                # Sums of whole numbers are exact in doubles up to 2^53, far beyond a batch's.
                of_batch = np.bincount(
                    batch.column(2).flatten().to_numpy(), np.repeat(times, sizes).astype(np.float64), buckets)
                total += of_batch.astype(np.int64)
            yield _tally(total)

        def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, np.int64)
            for batch in batches:
                for start, stop in slices(batch.column(0)):
                    found, _ = _cross_features(batch.column(0).slice(start, stop - start), longest, buckets)
                    total += np.bincount(found, minlength=buckets)
            yield _tally(total)

        rows = self.lines.rows.select("n_features", "n_lines", "buckets")
        found = rows.mapInArrow(inside, "bucket long, n long")
        if longest > 1:
            found = found.unionByName(self.texts.mapInArrow(across, "bucket long, n long"))
        return found.groupBy("bucket").agg(F.sum("n").alias("n"))

    def weights(self, gains: np.ndarray) -> DataFrame:
        """``t, t2, n_words, n_features, weight`` of each distinct text: the mean gain of its features."""
        buckets, longest = self.buckets, self.longest

        def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column(3).to_numpy()
                ends = np.concatenate([[0], np.cumsum(gains[batch.column(4).flatten().to_numpy()])])
                at = np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k) for k in range(4)], pa.array(ends[at[1:]] - ends[at[:-1]])],
                    ["h", "h2", "n_words", "n_features", "gain"])

        def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, stop in slices(batch.column(2)):
                    found, owner = _cross_features(batch.column(2).slice(start, stop - start), longest, buckets)
                    n = np.bincount(owner, minlength=stop - start)
                    gain = np.bincount(owner, gains[found].astype(np.float64), stop - start).astype(np.int64)
                    own = [batch.column(k).slice(start, stop - start) for k in range(2)]
                    none = pa.array(np.zeros(stop - start, np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*own, none, none, pa.array(n), pa.array(gain)], ["t", "t2", "copies", "n_words", "n_features", "gain"])

        scored = self.lines.rows.select("h", "h2", "n_words", "n_features", "buckets").mapInArrow(
            inside, "h long, h2 long, n_words long, n_features long, gain long")
        # The first line of each copy of a text tells how many copies there are.
        placed = self.texts.select(
            *_two_hashes(F.col("text"), "t", "t2"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        placed = placed.filter("line <> '' OR at = 0").select(
            "t", "t2", *_two_hashes(F.col("line"), "h", "h2"), (F.col("at") == 0).cast("long").alias("first"))
        # Copies fold in the tasks first. A line that many texts share is split by the adaptive planner, since the
        # other side has it once.
        placed = placed.groupBy("t", "t2", "h", "h2").agg(F.count("*").alias("times"), F.sum("first").alias("copies"))
        joined = placed.join(scored.hint("merge"), ["h", "h2"], "left")

        def times(name: str) -> Column:
            return (F.col("times") * F.coalesce(name, F.lit(0))).alias(name)

        parts = joined.select("t", "t2", "copies", times("n_words"), times("n_features"), times("gain"))
        if longest > 1:
            parts = parts.unionByName(self.texts.select(*_two_hashes(F.col("text"), "t", "t2"), "text").mapInArrow(
                across, "t long, t2 long, copies long, n_words long, n_features long, gain long"))
        sums = parts.groupBy("t", "t2").agg(*[F.sum(c).alias(c) for c in ("copies", "n_words", "n_features", "gain")])
        # Division that rounds down, in whole numbers.
        mean = "(gain - pmod(gain, n_features)) div n_features"
        return sums.select(
            "t", "t2", F.expr("n_words div copies").alias("n_words"), F.expr("n_features div copies").alias("n_features"),
            F.when(F.col("n_features") > 0, F.expr(mean)).otherwise(0).cast("long").alias("weight"))


def gains(own: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds: 1000 times the log of its smoothed share in target over own, rounded down.

    Both tables have ``bucket, n``, so at most ``buckets`` rows each reach the driver.
    """
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, table in ((s, own), (t, target)):
        for row in table.collect():
            counts[row["bucket"]] = row["n"]
    of_s, of_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    found = (math.floor(1000 * math.log((b + 1) * of_s / ((a + 1) * of_t))) for a, b in zip(s.tolist(), t.tolist()))
    return np.fromiter(found, np.int64, buckets)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A whole number drawn for an id alone: 1000 times Gumbel noise, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, doc_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``_llm_words``, ``_llm_features``, ``_llm_weight``, ``_llm_score`` and ``_llm_rank``.

    Features are runs of 1 to ``longest`` consecutive words. Of the N rows with at least ``least_words`` words, those of the
    floor(``percent`` N / 100) highest scores have a rank, from 1; ties go to the smaller id (null first), then in any order
    among rows of one id and score. A null or empty text has no features and weight 0; a null id draws its noise as an
    empty text does. Rows of equal ids are drawn each for itself. All rows of ``docs`` come back, with all columns or
    those in ``keep``, which saves shuffling the texts where they are not wanted.
    """
    kept = docs.columns if keep is None else keep
    own = Features(docs, text_col, longest, buckets)
    gain = gains(own.counts(), Features(target, target_col, longest, buckets).counts(), buckets)
    weights = own.weights(gain).select(
        F.col("t").alias(OWN + "t"), F.col("t2").alias(OWN + "t2"), F.col("n_words").alias(OWN + "words"),
        F.col("n_features").alias(OWN + "features"), F.col("weight").alias(OWN + "weight"))
    keyed = docs.withColumns({
        OWN + "t": F.xxhash64(docs[text_col]), OWN + "t2": F.xxhash64(F.lit(1), docs[text_col]), OWN + "noise": noise(docs[doc_col], seed),
        OWN + "tie": docs[doc_col]})
    named = [OWN + c for c in ("words", "features", "weight")]
    scored = keyed.join(weights.hint("merge"), [OWN + "t", OWN + "t2"], "left").select(
        *kept, OWN + "tie", OWN + "noise", *[F.coalesce(c, F.lit(0)).alias(c) for c in named])
    scored = scored.withColumn(OWN + "score", F.col(OWN + "weight") + F.col(OWN + "noise")).drop(OWN + "noise")
    found = ranked(scored, F.col(OWN + "words") >= least_words, F.col(OWN + "score"), F.col(OWN + "tie"), percent)
    return found.drop(OWN + "tie")


def ranked(rows: DataFrame, may: Column, score: Column, tie: Column, percent: int) -> DataFrame:
    """``rows`` with ``_llm_rank`` for the ``percent`` of those that ``may`` have one with the highest scores.

    Scores are whole thousandths of logarithms, of which doubles allow some hundred thousand at most; so the table of how
    many rows have a score, all that a single task sorts, does not grow with the rows. Rows of one score are sorted for themselves.
    """
    held = Stored(rows.withColumns({OWN + "s": score, OWN + "may": F.coalesce(may, F.lit(False)), OWN + "by": tie}), "scored").rows
    counts = held.filter(OWN + "may").groupBy(OWN + "s").agg(F.count("*").alias(OWN + "n"))
    above = Window.orderBy(F.col(OWN + "s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    drawn = F.floor(F.sum(OWN + "n").over(Window.partitionBy()) * percent / 100).cast("long")
    table = Stored(counts.select(
        F.col(OWN + "s").alias(OWN + "of"), F.coalesce(F.sum(OWN + "n").over(above), F.lit(0)).alias(OWN + "above"),
        drawn.alias(OWN + "drawn")).filter(F.col(OWN + "above") < F.col(OWN + "drawn")), "score-counts").rows
    joined = held.join(F.broadcast(table), F.col(OWN + "may") & (F.col(OWN + "s") == F.col(OWN + "of")), "left")
    near = joined.filter(F.col(OWN + "of").isNotNull())
    place = F.col(OWN + "above") + F.row_number().over(
        Window.partitionBy(OWN + "s").orderBy(F.col(OWN + "by").asc_nulls_first()))
    columns = rows.columns
    near = near.select(*columns, F.when(place <= F.col(OWN + "drawn"), place).cast("long").alias(OWN + "rank"))
    rest = joined.filter(F.col(OWN + "of").isNull()).select(*columns, F.lit(None).cast("long").alias(OWN + "rank"))
    return near.unionByName(rest)
