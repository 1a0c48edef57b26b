"""SimHash near-duplicates, found by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lumberline.llm.common import OWN, Stored, give_back, of, shuffle_partitions
from lumberline.llm.components import components
from lumberline.llm.words import Words, slices

BITS = 64
SEGMENTS = 2
WIDTH = BITS // SEGMENTS
#: A segment value that more fingerprints share is crowded.
CROWD = 64
SEED = 42
#: Bytes of text worked on at once.
SLICE = 1 << 20
#: For each byte, its bits in eight lanes of eight bits.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
_LANE_MOST = 255


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """A fingerprint for each text of a batch."""
    words = Words(texts, lower=True)
    n = words.counts
    joined, starts, ends = words.bytes() if len(words) else (b"", np.zeros(0, int), np.zeros(0, int))
    size = np.minimum(n, shingle)
    how_many = np.where(n > 0, n - size + 1, 0)
    document = np.repeat(np.arange(len(n)), how_many)
    first = np.concatenate([[0], np.cumsum(how_many)])
    begin = words.first[:-1][document] + np.arange(len(document)) - first[document]
    stop = begin + size[document] - 1
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[begin].tolist(), ends[stop].tolist())),
        np.uint64, len(begin),
    )
    return _majority(hashed, first, how_many)


def _majority(hashed: np.ndarray, first: np.ndarray, how_many: np.ndarray) -> np.ndarray:
    """Bits set in over half of each document's hashes."""
    out = np.zeros(len(how_many), np.uint64)
    some = np.flatnonzero(how_many)
    if not len(some):
        return out
    # Lanes of eight bits hold the counts of at most 255 hashes, so long documents are cut for that.
    parts = -(-how_many[some] // _LANE_MOST)
    owner = np.repeat(np.arange(len(some)), parts)
    part_first = np.concatenate([[0], np.cumsum(parts)])[:-1]
    cuts = first[:-1][some][owner] + (np.arange(len(owner)) - part_first[owner]) * _LANE_MOST
    columns = hashed.view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[columns[:, k]], cuts).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes, part_first, axis=0, dtype=np.int64)
        over = 2 * counts > how_many[some][:, None]
        byte = np.packbits(over, axis=1, bitorder="little")[:, 0].astype(np.uint64)
        out[some] |= byte << np.uint64(8 * k)
    return out


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``_llm_id, _llm_fp`` (the fingerprint as a signed long) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE):
                part = batch.slice(start, stop - start)
                found = fingerprints(part.column(1), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], [OWN + "id", OWN + "fp"])
            give_back()

    rows = of(docs, id=id_col, text=text_col)
    return rows.mapInArrow(run, f"{OWN}id {rows.schema[OWN + 'id'].dataType.simpleString()}, {OWN}fp long")


def links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """Edges (``a``, ``b``) that join just the fingerprints (``fp``, distinct) within the distance.

    Two fingerprints within the distance differ by at most half of it in one of their two segments. So there is a
    table for each segment, by segment value, that has each fingerprint once; a fingerprint fetches what stands
    under the values of the ball of that radius around its own segment, and complete distances are verified on
    what is fetched. Of two values one bit apart only the one that has the bit asks for the other, which
    halves the ball.

    A segment value that more than ``CROWD`` fingerprints share would make all their pairs candidates. It has a mark
    in the table instead, and those that share it or fetch its mark are joined by :func:`neighbours`, so
    that no group of near copies, however large, makes pairs of all its members.
    """
    if max_distance not in (0, 1, 2):
        raise ValueError("max_distance must be 0, 1 or 2")
    none = prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    if max_distance == 0:
        return none
    # The fingerprints are few bytes and lie in few tasks, what they fetch is more.
    own = prints.repartition(shuffle_partitions(prints.sparkSession), "fp")
    radius = max_distance // SEGMENTS
    flips = F.array(*[F.lit(f).cast("long") for f in [0, *(1 << bit for bit in range(WIDTH) if radius)]])

    def entry(segment: int, value: Column) -> Column:
        return F.struct(F.lit(segment).alias("segment"), value.alias("value"))

    def ball(segment: int) -> Column:
        value = _segment(segment)
        asked = F.filter(flips, lambda flip: value.bitwiseAND(flip) == flip)
        return F.transform(asked, lambda flip: entry(segment, value.bitwiseXOR(flip)))

    entries = F.array(*[entry(k, _segment(k)) for k in range(SEGMENTS)])
    table = own.select("fp", F.explode(entries).alias("at")).select("at.*", F.col("fp").alias("other"))
    place = ["segment", "value"]
    crowded = Stored(table.groupBy(*place).count().filter(F.col("count") > CROWD).select(*place), "simhash-crowded").rows
    marked = table.join(crowded, place, "left_anti").unionByName(crowded, allowMissingColumns=True)
    probes = own.select("fp", F.explode(F.concat(*[ball(k) for k in range(SEGMENTS)])).alias("at")).select("at.*", "fp")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    near = F.col("other").isNull() | ((F.col("fp") != F.col("other")) & (distance <= max_distance))
    # Spark sizes both sides as before their explodes and would broadcast one, which grows with the fingerprints.
    met = Stored(probes.hint("merge").join(marked, place).filter(near).select("fp", "other").distinct(), "simhash-met").rows
    edges = met.filter("other IS NOT NULL").select(F.col("fp").alias("a"), F.col("other").alias("b"))
    sharing = table.join(crowded, place, "left_semi").select(F.col("other").alias("fp"))
    crowd = met.filter("other IS NULL").select("fp").unionByName(sharing).distinct()
    return edges.unionByName(neighbours(crowd, max_distance))


def _segment(number: int) -> Column:
    return F.shiftrightunsigned("fp", number * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))


def neighbours(prints: DataFrame, max_distance: int) -> DataFrame:
    """The same edges, or others that join the same, of crowded fingerprints, by their neighbours' values.

    Each fingerprint stands under its own value and under every value one bit away. Two that meet under a key
    differ by two bits at most, and any two that differ by so much meet. So a key has 65 members at most, whatever
    the size of a group, and is kept as one long: which bits its members have changed. Its first member
    is joined to the others.
    """
    balls = [F.shiftleft(F.lit(1).cast("long"), bit) for bit in range(BITS)]
    flip = F.explode(F.array(F.lit(0).cast("long"), *balls)).alias("flip")
    probes = prints.select("fp", flip).select(F.expr("fp ^ flip").alias("key"), "flip")
    tables = probes.groupBy("key").agg(
        F.bit_or("flip").alias("flips"), F.max(F.col("flip") == 0).alias("own")
    )
    met = F.bit_count("flips") + F.col("own").cast("int")
    if max_distance == 1:
        tables = tables.filter("own")
    changed = F.transform(
        F.filter(F.array(*balls), lambda bit: F.col("flips").bitwiseAND(bit) != 0),
        lambda bit: F.col("key").bitwiseXOR(bit),
    )
    members = F.when(F.col("own"), F.concat(F.array("key"), changed)).otherwise(changed)
    # With distance one the key itself is a member, and all others are one bit from it.
    centre = F.element_at("members", 1)
    edges = (
        tables.filter(met > 1).select(members.alias("members"))
        .select(centre.alias("a"), F.explode("members").alias("b")).filter("a <> b")
    )
    return edges.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """``doc_id`` (named as ``id_col``), ``fingerprint``, ``component_id`` for each row.

    A document without words (null, empty, blank) has the fingerprint zero and is linked like any
    other; one of fewer words than ``shingle`` has one shingle. Repeated rows come out repeated.
    The smallest id of a component ignores null ids; a component of null ids only has a null one.
    Other columns are not looked at.
    """
    prints = Stored(with_fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    ids = prints.rows.select(F.col(OWN + "id").alias("id"), F.col(OWN + "fp").alias("fp"))
    # One row per fingerprint: copies, however many, are counted before anything is compared.
    distinct = Stored(ids.groupBy("fp").agg(F.min("id").alias("smallest")), "simhash-distinct")
    nodes, _ = components(links(distinct.rows.select("fp"), max_distance), "simhash")
    groups = distinct.rows.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    least = groups.groupBy("root").agg(F.min("smallest").alias("component_id"))
    labels = Stored(
        groups.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-labels"
    )
    return ids.join(labels.rows, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group: that whose id is the group's smallest, all columns as they were.

    Rows with a null id stay. Of several rows of a kept id one stays; an id whose rows fall into several
    groups is kept if it is the smallest of one of them.
    """
    found = simhash_components(docs, id_col, text_col)
    own = F.col(id_col).alias(OWN + "id")
    fate = found.filter(F.col(id_col).isNotNull()).groupBy(own).agg(
        F.bool_or(F.col(id_col) == F.col("component_id")).alias(OWN + "kept"),
        F.count(F.lit(1)).alias(OWN + "rows"),
    )
    # Most ids are kept and have one row, so only the others are joined.
    other = Stored(fate.filter(~F.col(OWN + "kept") | (F.col(OWN + "rows") > 1)), "simhash-fate")
    rows = docs.withColumn(OWN + "id", docs[id_col]).join(other.rows, OWN + "id", "left")
    single = rows.filter(F.col(OWN + "rows").isNull())
    repeated = rows.filter(F.col(OWN + "kept") & (F.col(OWN + "rows") > 1)).dropDuplicates([OWN + "id"])
    return single.unionByName(repeated).select(*docs.columns)
