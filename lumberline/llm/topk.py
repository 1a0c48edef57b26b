"""Exact top-k search by integer inner product, block by block under bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lumberline.llm.common import Stored

K = 20
SCALE = 64
BLOCK_ROWS = 64
#: Rows of one range of documents and queries of one group, at most about.
RANGE_ROWS = 16_384
GROUP_QUERIES = 2048
LEAST_RANGES = 16
_STEP = 128


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _search(k: int, width: int):
    def run(key: tuple, docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not docs.num_rows or not asked.num_rows:
            return _result([], [], [], [])
        rows = _matrix(docs.column("v"), width)
        ids = docs.column("id").to_numpy()
        # Like vectors go into one block, so that its maxima say something about its members.
        strongest = np.argsort(-np.abs(rows), axis=1, kind="stable")[:, :3] if width else np.zeros((len(ids), 1), int)
        signed = strongest * 2 + (np.take_along_axis(rows, strongest, 1) < 0) if width else strongest
        order = np.lexsort((ids, *signed.T[::-1]))
        rows, ids = rows[order], ids[order]
        blocks = -(-len(ids) // BLOCK_ROWS)
        fill = blocks * BLOCK_ROWS - len(ids)
        begins = np.arange(blocks) * BLOCK_ROWS
        queries, query_ids = _matrix(asked.column("v"), width), asked.column("id").to_numpy()
        largest = int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(width, 1)
        # Sums of whole numbers below 2 ** 53 are exact in double precision, whose products are fast.
        kind = np.float64 if largest < 2**53 else object
        top = np.maximum.reduceat(rows, begins).astype(kind)
        low = np.minimum.reduceat(rows, begins).astype(kind)
        forward = np.concatenate([rows, np.zeros((fill, width), np.int64)]).astype(kind).reshape(blocks, BLOCK_ROWS, width)
        block_ids = np.concatenate([ids, np.full(fill, -1)]).reshape(blocks, BLOCK_ROWS)
        real = np.concatenate([np.ones(len(ids), bool), np.zeros(fill, bool)]).reshape(blocks, BLOCK_ROWS)
        out: list[list[np.ndarray]] = [[], [], [], []]
        none = -np.inf if kind is np.float64 else -(2**200)
        for start in range(0, len(query_ids), _STEP):
            q = queries[start : start + _STEP].astype(kind)
            own = query_ids[start : start + _STEP]
            bound = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
            visit = np.argsort(-bound, axis=1, kind="stable")
            best = np.full((len(q), k), none, kind)
            best_ids = np.full((len(q), k), np.iinfo(np.int64).max)
            for t in range(blocks):
                block = visit[:, t]
                # A block may hold an equal score of a smaller id, so only a lower bound ends the search.
                live = np.flatnonzero(np.take_along_axis(bound, visit, 1)[:, t] >= best[:, -1])
                if not len(live):
                    break
                at = block[live]
                score = np.matmul(forward[at], q[live][:, :, None])[:, :, 0]
                allowed = real[at] & (block_ids[at] != own[live][:, None])
                score = np.where(allowed, score, none)
                every = np.concatenate([best[live], score], 1)
                every_ids = np.concatenate([best_ids[live], np.where(allowed, block_ids[at], np.iinfo(np.int64).max)], 1)
                first = np.lexsort((every_ids, -every), axis=1)[:, :k]
                best[live] = np.take_along_axis(every, first, 1)
                best_ids[live] = np.take_along_axis(every_ids, first, 1)
            some = best > none
            row = np.nonzero(some)[0]
            out[0].append(own[row])
            out[1].append(asked.column("key").to_numpy()[start + row])
            out[2].append(best_ids[some])
            out[3].append(best[some].astype(np.int64))
        return _result(*out)

    return run


def _result(*columns: list[np.ndarray]) -> pa.Table:
    names = ("query_id", "key", "vec_id", "score")
    return pa.table({
        n: np.concatenate(c) if c else np.zeros(0, np.int64) for n, c in zip(names, columns)
    })


def top_k(
    rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows of highest integer inner product.

    A component x becomes floor(64 * x). Queries are the rows for which ``is_query`` holds. The rows are cut
    into ranges and these into blocks; a task has one range and one group of queries. It bounds every
    block for every query by the blocks' largest and smallest components, visits blocks by falling bound
    and scores all rows of a block, until the next bound is below the k-th score. The best of each range
    meet per query, ``k`` rows from each. Ties go to the smaller id.

    Vectors that are null or hold null or non-finite components, and null ids, take no part; shorter
    vectors count as filled up with zeros. Rows of one id and vector count once; a query's own id is no
    candidate of it.
    """
    spark = rows.sparkSession
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = (
        rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].alias("v"), is_query.alias("asks"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
        .withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)))
    )
    stored = Stored(valid.distinct().withColumn("key", F.xxhash64("v")), "topk")
    n, asking, width = stored.rows.agg(
        F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))
    ).first()
    ranges = max(LEAST_RANGES, -(-n // RANGE_ROWS))
    groups = max(1, -(-asking // GROUP_QUERIES))
    every_range = F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("part")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("query_group")
    dealt = F.pmod(F.xxhash64("id", "key"), F.lit(2**30))
    docs = stored.rows.select(
        (dealt % ranges).cast("int").alias("part"), every_group, "id", "key", "v"
    )
    asked = stored.rows.filter("asks").select(
        every_range, (dealt % groups).cast("int").alias("query_group"), "id", "key", "v"
    )
    by = ("part", "query_group")
    found = docs.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(
        _search(k, width), "query_id long, key long, vec_id long, score long"
    )
    ranked = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
