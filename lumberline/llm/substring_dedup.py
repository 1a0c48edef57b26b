"""Removal of repeated word sequences, found through anchors at fixed blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from lumberline.llm.common import LARGEST_LONG, OWN, Stored, give_back, shuffle_partitions, text_key
from lumberline.llm.words import Words, flat, hashes

WINDOW = 20
#: Any window of 20 words holds a whole block of 10 that begins at a multiple of 10.
BLOCK = (WINDOW + 1) // 2
#: Documents are read in so many buckets for each shuffle partition, and in more where a bucket would hold more than so
#: many bytes of text; so would a part of the index.
BUCKETS_PER_PARTITION = 4
BUCKET_BYTES, PART_BYTES = 16 << 20, 64 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[*range(0x09, 0x0E), 0x20]] = True
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64(0xFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """A hash of each ``n`` words in a row, for words given as hashes."""
    value = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        value = value * base + words[k : k + len(value)]
    return _mix(value)


class Bucket:
    """The documents of a bucket: one after the other, in the order that decides what is earlier."""

    def __init__(self, table: pa.Table):
        ids = table.column(OWN + "order").to_numpy()
        keys = table.column(OWN + "key").to_numpy()
        self.rank = np.lexsort((keys, ids))
        self.ids, self.keys = ids[self.rank], keys[self.rank]
        texts = table.column(OWN + "text").combine_chunks().cast(pa.large_string())
        self.texts = texts.take(pa.array(self.rank))
        self.words = Words(self.texts, lower=False)
        codes, distinct = self.words.coded()
        self.hashes = hashes(distinct, xxhash.xxh64_intdigest)[codes]
        self.document = self.words.document()
        self.position = np.arange(len(codes)) - self.words.first[:-1][self.document]
        self.left = self.words.counts[self.document] - self.position

    def windows(self, n: int) -> np.ndarray:
        """First words of all windows of ``n`` words within a document."""
        return np.flatnonzero(self.left >= n)

    def same(self, start: np.ndarray) -> np.ndarray:
        """For places in order: a number that repeated rows of one document share, place by place."""
        changed = np.ones(len(self.ids), bool)
        changed[1:] = (self.ids[1:] != self.ids[:-1]) | (self.keys[1:] != self.keys[:-1])
        first_row = np.maximum.accumulate(np.where(changed, np.arange(len(changed)), 0))
        return self.words.first[first_row[self.document[start]]] + self.position[start]


def _probe(buckets: int):
    """What a bucket asks and offers: its distinct block-long windows, and which of them are blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        give_back()
        own = Bucket(table)
        at = own.windows(BLOCK)
        value = rolling(own.hashes, BLOCK, _A)[at]
        is_block = own.position[at] % BLOCK == 0
        distinct, inverse, times = np.unique(value, return_inverse=True, return_counts=True)
        block = np.bincount(inverse, is_block, len(distinct)) > 0
        flags = block.astype(np.uint8) + 2 * (times > 1).astype(np.uint8)
        return _dealt(key[0].as_py(), buckets, distinct, [("low", (distinct & _LOW).astype(np.uint32)), ("flags", flags)])

    return run


def _dealt(source: int, buckets: int, value: np.ndarray, payload: list) -> pa.Table:
    """The payload by the bucket that the upper half of each value names."""
    to = ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to = to[order]
    used, begin = np.unique(to, return_index=True)
    cuts = np.append(begin, len(to))
    columns = {"to": pa.array(used, pa.int32()), "source": pa.array(np.full(len(used), source), pa.int32())}
    for name, values in payload:
        values = values[order]
        columns[name] = pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
    return pa.table(columns)


def _gather(table: pa.Table, **kinds) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows' payloads one after the other, and the row of each item."""
    parts = [
        [np.frombuffer(x, kind) for x in table.column(name).to_pylist()] for name, kind in kinds.items()
    ]
    sizes = [len(x) for x in parts[0]]
    return np.repeat(np.arange(len(sizes)), sizes), [np.concatenate(p) for p in parts]


def _answer(source: np.ndarray, to: int, table: pa.Table, values: np.ndarray, name: str) -> pa.Table:
    sources = table.column("source").to_numpy()
    used, begin = np.unique(source, return_index=True)
    cuts = np.append(begin, len(source))
    return pa.table({
        "bucket": pa.array(sources[used], pa.int32()), "part": pa.array(np.full(len(used), to), pa.int32()),
        name: pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
    })


def _match(key: tuple, table: pa.Table) -> pa.Table:
    """The windows that meet an indexed block anywhere else."""
    row, (low, flags) = _gather(table, low=np.uint32, flags=np.uint8)
    order = np.argsort(low, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], low[order][1:] != low[order][:-1]]))
    size = np.diff(np.append(begin, len(low)))
    block = np.bitwise_or.reduceat(flags[order], begin) & 1 > 0
    often = (size > 1) | (np.bitwise_or.reduceat(flags[order], begin) & 2 > 0)
    hit = np.zeros(len(low), bool)
    hit[order] = np.repeat(block & often, size)
    return _answer(row[hit], key[0].as_py(), table, low[hit], "low")


def _known(table: pa.Table, buckets: int, name: str, own: np.ndarray) -> np.ndarray:
    """Which of a bucket's values an answer names; each answer holds the lower halves of one part."""
    if not table.num_rows:
        return np.zeros(len(own), bool)
    row, (low,) = _gather(table, **{name: np.uint32})
    part = table.column("part").to_numpy()[row].astype(np.uint64)
    answers = (part << np.uint64(32)) | low
    mine = (((own >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (own & _LOW)
    return np.isin(mine, answers)


def _extend(buckets: int):
    """Hits grow into candidate windows; of each, its first place in the bucket goes out."""

    def run(key: tuple, table: pa.Table, hits: pa.Table) -> pa.Table:
        give_back()
        if not table.num_rows or not hits.num_rows:
            return _candidates(key[0].as_py(), buckets, *[np.zeros(0, t) for t in ("u8", "u8", "i8", "i8", "i8")])
        own = Bucket(table)
        at = own.windows(BLOCK)
        hit = np.zeros(len(own.hashes) + 1, bool)
        hit[at] = _known(hits, buckets, "low", rolling(own.hashes, BLOCK, _A)[at])
        start = own.windows(WINDOW)
        # A repeated window meets the other's block somewhere, and each block of its own is met.
        total = np.concatenate([[0], np.cumsum(hit)])
        some = total[start + WINDOW - BLOCK + 1] > total[start]
        first = start + (-own.position[start]) % BLOCK
        own_blocks = hit[first] & (hit[np.minimum(first + BLOCK, len(hit) - 1)] | (first + BLOCK > start + WINDOW - BLOCK))
        start = start[some & own_blocks]
        value = rolling(own.hashes, WINDOW, _A)[start]
        second = rolling(_mix(own.hashes), WINDOW, _B)[start]
        distinct, place = np.unique(np.stack([value, second], 1), axis=0, return_index=True)
        at = start[place]  # places are in order, so the first is the earliest
        document = own.document[at]
        return _candidates(
            key[0].as_py(), buckets, distinct[:, 0], distinct[:, 1],
            own.ids[document], own.keys[document], own.position[at],
        )

    return run


def _candidates(source, buckets, value, second, ids, keys, position) -> pa.Table:
    payload = [("value", value), ("second", second), ("id", ids), ("key", keys), ("position", position.astype(np.uint32))]
    return _dealt(source, buckets, value, payload)


def _earliest(key: tuple, table: pa.Table) -> pa.Table:
    """For each bucket the windows whose earliest place is in another one."""
    row, (value, second, ids, keys, position) = _gather(
        table, value=np.uint64, second=np.uint64, id=np.int64, key=np.int64, position=np.uint32
    )
    order = np.lexsort((position, keys, ids, second, value))
    v, s = value[order], second[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (s[1:] != s[:-1])])
    later = np.zeros(len(order), bool)
    later[order] = ~new
    both = np.stack([value[later], second[later]], 1)
    return _answer(row[later], key[0].as_py(), table, both, "later")


def _without(own: Bucket, covered: np.ndarray) -> pa.Array:
    """The texts without the covered words and the white space before each of them; all else stays as it is."""
    data, offsets = flat(pc.fill_null(own.texts, ""))
    blank = _BLANK[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    ends = offsets[1:-1]
    ends = ends[ends < len(data)]
    begins[ends] = ~blank[ends]
    # White space belongs to the word after it, and at the end of a text to none.
    number = np.cumsum(begins, dtype=np.int32)
    del begins
    kept = np.append(~covered, True)
    stays = kept[number - ~blank]
    stays |= blank & (number >= np.repeat(own.words.first[1:].astype(np.int32), np.diff(offsets)))
    del number
    moved = np.concatenate([[0], np.cumsum(stays, dtype=np.int32)])[offsets]
    return pa.LargeStringArray.from_buffers(
        len(own.texts), pa.py_buffer(moved.astype(np.int64).tobytes()), pa.py_buffer(data[stays].tobytes()))


def _cut(schema: T.StructType, fields: list[str], spaces: bool):
    def run(table: pa.Table, later: pa.Table) -> pa.Table:
        give_back()
        own = Bucket(table)
        n = len(own.hashes)
        start = own.windows(WINDOW)
        value = rolling(own.hashes, WINDOW, _A)[start]
        second = rolling(_mix(own.hashes), WINDOW, _B)[start]
        # Within the bucket: all places of a window but the first.
        order = np.lexsort((start, second, value))
        v, s = value[order], second[order]
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (s[1:] != s[:-1])])[: len(order)]
        same = own.same(start)[order]
        group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
        gone = np.zeros(len(order), bool)
        gone[order] = same != same[group] if len(order) else gone
        if later.num_rows:
            _, (pairs,) = _gather(later, later=np.uint64)
            pairs = pairs.reshape(-1, 2)
            gone |= np.isin(_mix(value) + second * _B, _mix(pairs[:, 0]) + pairs[:, 1] * _B)
        edge = np.bincount(start[gone], minlength=n + 1) - np.bincount(start[gone] + WINDOW, minlength=n + 1)
        covered = np.cumsum(edge)[:n] > 0
        removed = np.concatenate([[0], np.cumsum(covered)])
        n_removed = (removed[own.words.first[1:]] - removed[own.words.first[:-1]]).astype(np.int64)
        if spaces:
            kept = _without(own, covered).cast(pa.string())
        else:
            kept_words = own.words.values.filter(pa.array(~covered))
            kept_first = own.words.first - removed[own.words.first]
            offsets = pa.array(kept_first, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, kept_words.cast(pa.string()))
            kept = pc.binary_join(lists, " ")
        rows = table.select(fields).take(pa.array(own.rank))
        made = [pa.array(own.words.counts.astype(np.int64)), pa.array(n_removed), kept]
        return pa.Table.from_arrays([*[c.combine_chunks() for c in rows.columns], *made], names=schema.names)

    return run


def drop_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spaces: bool = False
) -> DataFrame:
    """``docs`` with ``_llm_words, _llm_removed`` (long) and ``_llm_kept``: the words kept, joined by a space.

    With ``spaces`` it is the text instead, from which only the words that go were cut, and the white space before each
    of them.

    A word goes if a window of 20 words of its document that covers it also starts earlier: in a
    document of smaller id, or earlier in the same one. Windows are those of the input. Null texts have
    no words. A null id comes after all others. Rows that share an id are ordered by their texts' hash;
    repeated rows of one id and text are the same document, and come out alike.

    Documents are read by buckets of their id. Each bucket sends its distinct windows of ten words, as
    32 bits within the part that the rest of the hash names; those at a multiple of ten are the index, all
    are probes. What meets an indexed block elsewhere is answered to the buckets that asked, which
    extend it to windows of 20 words; of these the earliest place is looked for by two 64-bit hashes.
    Within a bucket a window is sent once, so one that stands in a third of all documents is sent
    once by each bucket. There are so many buckets and parts that none is large, however few partitions Spark
    shuffles by; only rows of one id and text share a bucket whatever their number.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // PART_BYTES))
    buckets = max(BUCKETS_PER_PARTITION * shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    order = F.coalesce(docs[id_col].cast("long"), F.lit(LARGEST_LONG))
    keyed = docs.withColumns({OWN + "order": order, OWN + "key": text_key(docs[text_col])}).withColumn(
        OWN + "bucket", F.pmod(F.xxhash64(OWN + "order", OWN + "key"), F.lit(buckets)).cast("int")
    )
    texts = keyed.select(OWN + "bucket", OWN + "order", OWN + "key", F.col(text_col).alias(OWN + "text"))
    probes = texts.groupBy(OWN + "bucket").applyInArrow(
        _probe(parts), "to int, source int, low binary, flags binary"
    )
    hits = Stored(
        probes.groupBy("to").applyInArrow(_match, "bucket int, part int, low binary"), "repeat-hits"
    )
    candidates = texts.groupBy(OWN + "bucket").cogroup(hits.rows.groupBy("bucket")).applyInArrow(
        _extend(parts), "to int, source int, value binary, second binary, id binary, key binary, position binary"
    )
    later = Stored(
        candidates.groupBy("to").applyInArrow(_earliest, "bucket int, part int, later binary"), "repeat-later"
    )
    hits.discard()
    schema = T.StructType([
        *docs.schema.fields, T.StructField(OWN + "words", T.LongType()),
        T.StructField(OWN + "removed", T.LongType()), T.StructField(OWN + "kept", T.StringType()),
    ])
    whole = keyed.withColumn(OWN + "text", F.col(text_col))
    return whole.groupBy(OWN + "bucket").cogroup(later.rows.groupBy("bucket")).applyInArrow(
        _cut(schema, docs.columns, spaces), schema
    )
