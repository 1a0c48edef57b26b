"""Near-duplicate vectors, found by small-world graphs per shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lumberline.llm.common import Stored
from lumberline.llm.components import components
from lumberline.llm.hnsw import Graph

THRESHOLD = 0.95
#: A shard has so many vectors at most, and there are so many shards at least.
SHARD_ROWS = 50_000
LEAST_SHARDS = 16
FIRST_BEAM = 24
#: Of so many queries of a shard, and of as many vectors planted beside its members, the links found are compared with
#: all there are. Planted ones are little nearer than the threshold, so the audit has links where the data have few.
AUDITED = 512
RECALL = 0.99
PLANTED_ABOVE = 0.002
#: Nearness in single precision is this far at most from that in double precision.
SLACK = 1e-4

SHARD = "shard int, ids binary, weights binary, vectors binary, levels binary, links array<binary>"


def _valid(vector: str):
    size = F.size(vector) > 0
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & size & finite & F.exists(vector, lambda x: x != 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    vectors = vectors / largest
    return vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]


def _build(key: tuple, table: pa.Table) -> pa.Table:
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    lists = table.column("v").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    vectors = lists.flatten().to_numpy().astype(np.float64).reshape(len(ids), int(sizes[0]))[order]
    graph = Graph.build(_unit(vectors).astype(np.float32))
    return pa.Table.from_pydict({
        "shard": pa.array([key[0].as_py()], pa.int32()),
        "ids": [ids[order].tobytes()],
        "weights": [table.column("weight").to_numpy()[order].tobytes()],
        "vectors": [vectors.tobytes()],
        "levels": [graph.levels.tobytes()],
        "links": [[x.tobytes() for x in graph.links]],
    }, pa.schema([
        ("shard", pa.int32()), ("ids", pa.binary()), ("weights", pa.binary()), ("vectors", pa.binary()),
        ("levels", pa.binary()), ("links", pa.list_(pa.binary())),
    ]))


class Shard:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.weights = np.frombuffer(row["weights"], np.int64)
        n = len(self.ids)
        self.exact = _unit(np.frombuffer(row["vectors"]).reshape(n, -1))
        links = [np.frombuffer(x, np.int32).reshape(n, -1) for x in row["links"]]
        self.graph = Graph(self.exact.astype(np.float32), np.frombuffer(row["levels"], np.int64), links)


def _directed(queries: Shard, index: Shard, same: bool, threshold: float) -> tuple:
    """Linked pairs (query, node), and the queries whose beam was full of links.

    The beam starts narrow and doubles until the audit finds nearly all links. Where none that is narrower than the
    shard does, every query counts as one whose beam was full, and is answered exactly.
    """
    short = queries.graph.vectors
    n = len(index.ids)
    rng = np.random.default_rng(0)
    sample = rng.permutation(len(short))[:AUDITED]
    probes = np.concatenate([short[sample], _planted(index.graph.vectors, threshold, rng)])
    there = probes @ index.graph.vectors.T >= threshold
    if same:
        there[np.arange(len(sample)), sample] = False
    width = FIRST_BEAM
    while True:
        if width >= n:
            none = np.zeros(0, np.int64)
            return none, none, np.arange(len(short))
        ids, near = index.graph.search(probes, width)
        hit = (near >= threshold) & (ids >= 0)
        full = hit[:, -1]
        found = np.zeros_like(there)
        found[np.nonzero(hit)[0], ids[hit]] = True
        # Full beams are answered exactly anyway.
        if (found & there)[~full].sum() >= RECALL * there[~full].sum():
            break
        width *= 2
    ids, near = index.graph.search(short, width)
    close = (near >= threshold - SLACK) & (ids >= 0)
    full = close[:, -1]
    q, column = np.nonzero(close & ~full[:, None])
    node = ids[q, column]
    if same:
        q, node = q[q != node], node[q != node]
    sure = np.einsum("nd,nd->n", queries.exact[q], index.exact[node]) >= threshold
    return q[sure], node[sure], np.flatnonzero(full)


def _planted(vectors: np.ndarray, threshold: float, rng: np.random.Generator) -> np.ndarray:
    """Vectors whose cosine with a member drawn by chance is just above the threshold."""
    own = vectors[rng.permutation(len(vectors))[:AUDITED]]
    other = rng.normal(size=own.shape).astype(np.float32)
    other -= np.einsum("nd,nd->n", other, own)[:, None] * own
    length = np.sqrt(np.einsum("nd,nd->n", other, other))[:, None]
    near = np.float32(min(threshold + PLANTED_ABOVE, 1.0))
    # In one dimension nothing lies beside a vector.
    return np.where(length > 1e-6, near * own + np.sqrt(1 - near**2) * other / np.maximum(length, 1e-6), own)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _compare(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        same = key[0] == key[1]
        if not same and table.num_rows == 1:  # the other shard got no vectors
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "links", "root")})
        shards = [Shard(row) for row in sorted(table.to_pylist(), key=lambda row: row["shard"])]
        left, right = shards[0], shards[-1]
        shift = 0 if same else len(left.ids)
        weights = left.weights if same else np.concatenate([left.weights, right.weights])
        ids = left.ids if same else np.concatenate([left.ids, right.ids])
        count = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        full = np.zeros(len(ids), bool)
        pairs = []
        turns = [(left, right, 0, shift)] + ([] if same else [(right, left, shift, 0)])
        for queries, index, q_shift, i_shift in turns:
            q, node, crowded = _directed(queries, index, same, threshold)
            pairs.append(np.stack([q + q_shift, node + i_shift], 1))
            full[crowded + q_shift] = True
        pair = np.unique(np.sort(np.concatenate(pairs), axis=1), axis=0)
        pair = pair[~full[pair].any(1)]
        for a, b in ((0, 1), (1, 0)):
            count += np.bincount(pair[:, a], weights[pair[:, b]], len(ids)).astype(np.int64)
        _unite(label, pair[:, 0], pair[:, 1])
        # A crowded vector is compared with the whole other shard; its links are counted, not listed.
        for queries, index, q_shift, i_shift in turns:
            crowded = np.flatnonzero(full[q_shift : q_shift + len(queries.ids)])
            other = slice(i_shift, i_shift + len(index.ids))
            for start in range(0, len(crowded), 256):
                own = crowded[start : start + 256]
                linked = queries.exact[own] @ index.exact.T >= threshold
                if same:
                    linked[np.arange(len(own)), own] = False
                count[own + q_shift] += linked @ index.weights
                count[other] += np.where(full[other], 0, queries.weights[own] @ linked)
                a, b = np.nonzero(linked)
                _unite(label, own[a] + q_shift, b + i_shift)
        some = np.flatnonzero((count > 0) | (label != np.arange(len(ids))))
        return pa.table({"id": ids[some], "links": count[some], "root": ids[label[some]]})

    return run


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """``vec_id`` (named as ``id_col``), ``n_links, component_id, kept`` for each row of ``rows``.

    Equal vectors count as one with a weight, so copies, however many, are compared once. Every
    vector is looked up in the graph of every shard, in tasks of two shards each; a beam full of
    links gives way to an exact comparison with that shard, whose links are counted and united where
    they are found, so no group is ever listed pair by pair. Links found are checked in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths link with each other. Rows of one id and vector count once as a
    partner and come out repeated; a null id links with nothing. Other columns are not looked at.
    """
    # Adding zero makes the two zeros one, so that equal vectors have equal hashes.
    doubles = F.transform(rows[vector_col], lambda x: x.cast("double") + 0.0)
    own = rows.select(rows[id_col].cast("long").alias("id"), doubles.alias("v"))
    valid = own.filter(_valid("v") & F.col("id").isNotNull()).distinct()
    distinct = Stored(
        valid.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
        .withColumn("key", F.xxhash64("v")),
        "vectors",
    )
    groups = distinct.rows.groupBy(F.size("v").alias("size")).count().collect()  # a row per length
    tables = []
    for size, n in sorted(groups):
        shards = max(LEAST_SHARDS, -(-n // SHARD_ROWS))
        dealt = distinct.rows.filter(F.size("v") == size).select(
            F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "weight", "v"
        )
        built = Stored(dealt.groupBy("shard").applyInArrow(_build, SHARD), "graphs")
        other = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
        there = built.rows.select("*", other.alias("other"))
        both = there.groupBy(F.least("shard", "other").alias("i"), F.greatest("shard", "other").alias("j"))
        tables.append(both.applyInArrow(_compare(threshold), "id long, links long, root long"))
    none = rows.sparkSession.createDataFrame([], "id long, links long, root long")
    found = none
    for table in tables:
        found = found.unionByName(table)
    linked = Stored(found, "vector-links")
    nodes, _ = components(
        linked.rows.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")), "vectors"
    )
    counts = linked.rows.groupBy("id").agg(F.sum("links").alias("links"))
    least = nodes.groupBy("root").agg(F.min("node").alias("component"))
    component = nodes.join(least, "root").select(F.col("node").alias("id"), "component")
    known = (
        distinct.rows.select("v", "key", "id", "weight").join(counts, "id", "left").join(component, "id", "left")
        .select(
            "v", "key", F.coalesce("component", "id").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        )
    )
    # Rows that take no part get no key, and so no partner.
    ok = F.coalesce(_valid("v") & F.col("id").isNotNull(), F.lit(False))
    asked = own.withColumn("key", F.when(ok, F.xxhash64("v"))).alias("x")
    joined = asked.join(
        known.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.v") == F.col("y.v")), "left"
    )
    component_id = F.coalesce("y.component", "x.id")
    return joined.select(
        F.col("x.id").alias(id_col),
        F.coalesce("y.links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        (F.col("x.id") == component_id).alias("kept"),
    )
