"""Packing of token sequences as a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from lumberline.llm.common import OWN, Stored, give_back, of, shuffle_partitions, text_key, worker_cache
from lumberline.llm.words import Words, flat, slices, spread

CAPACITY = 4096
END = 2
#: Lengths are rounded up to this for the patterns; sequences hold the true lengths.
WIDTH = 8
UNITS = CAPACITY // WIDTH
#: The linear program ends when its value is proven to be this near the least.
GAP = 0.002
MOST_ROUNDS = 4000
#: Words whose ids a Python worker remembers; it then keeps those that it met again.
REMEMBERED = 600_000
#: Bytes of text worked on at once.
SLICE = 8 << 20
#: Words encoded at once, and what stands between them.
AT_ONCE = 500
MARK = "\x00"
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: The second byte of À to ÿ in UTF-8, after 0xC3, without the signs × and ÷.
_ACCENTED = np.zeros(256, bool)
_ACCENTED[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[*range(0x09, 0x0E), 0x20]] = True


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with a blank before each point or comma that ends a word after a letter.

    The tokenizer cuts there anyway, so the ids are the same, and a word has one entry instead of three.
    """
    data, offsets = flat(pc.fill_null(texts, ""))
    at = np.flatnonzero((data == 0x2E) | (data == 0x2C))
    at = at[np.isin(at, offsets, invert=True, assume_unique=False)] if len(at) else at
    padded = np.concatenate([np.zeros(2, np.uint8), data, np.full(1, 0x20, np.uint8)])
    before, earlier, after = padded[at + 1], padded[at], padded[at + 3]
    letter = _LETTER[before] | (_ACCENTED[before] & (earlier == 0xC3))
    ends = _BLANK[after] | np.isin(at + 1, offsets)
    at = at[letter & ends]
    made = np.insert(data, at, 0x20)
    moved = offsets + np.searchsorted(at, offsets, side="left")
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(moved.astype(np.int64).tobytes()), pa.py_buffer(made.tobytes()))


class WordIds:
    """Ids of words. No token spans white space, so a word has the same ids in every text.

    New words are encoded many at once. The tokenizer ends the last token of each part it cuts with ``</w>``, so words
    of letters, which are one part, are told apart by these ends; other words get a mark between them that is a
    token of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self._encode(MARK)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes = np.zeros(1 << 12, np.int32)
        self.begins = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0
        self.again = np.zeros(1 << 12, bool)

    def _clean(self) -> None:
        """Forgets the words that were not met again since they were learnt."""
        kept = [w for w, i in self.number.items() if self.again[i]]
        old = np.fromiter((self.number[w] for w in kept), np.int64, len(kept))
        sizes = self.sizes[old].astype(np.int64)
        ids, ends = spread(np.arange(len(old)), sizes, self.ids, self.begins[old])
        self._forget()
        if 2 * len(kept) > REMEMBERED:
            return
        self.number = dict(zip(kept, range(len(kept))))
        self.sizes, self.begins = sizes.astype(np.int32), ends[:-1].astype(np.int64)
        self.ids, self.used = ids.astype(np.uint32), len(ids)
        self.again = np.zeros(len(kept), bool)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _by_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        ids = self._encode(" ".join(words))
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(words) or (len(ids) and ends[-1] != len(ids) - 1):
            return None
        return np.diff(np.concatenate([[-1], ends])), ids

    def _by_mark(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        ids = self._encode(f" {MARK} ".join(words))
        cuts = np.flatnonzero(ids == self.mark[0])
        if len(self.mark) != 1 or len(cuts) != len(words) - 1 or any(MARK in w for w in words):
            return None
        return np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1, np.delete(ids, cuts)

    def _learn(self, words: list[str], plain: bool) -> None:
        found = self._by_parts(words) if plain else self._by_mark(words)
        if found is None:
            each = [self._encode(w) for w in words]
            found = np.array([len(x) for x in each], np.int64), np.concatenate(each)
        sizes, ids = found
        n = len(self.number)
        while len(self.sizes) < n + len(words):
            self.sizes, self.begins, self.again = (
                np.concatenate([x, np.zeros(len(x) + 64, x.dtype)]) for x in (self.sizes, self.begins, self.again))
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + 64, self.ids.dtype)])
        self.sizes[n : n + len(words)] = sizes
        self.begins[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.number.update(zip(words, range(n, n + len(words))))

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words the number of ids of each, and where they begin in ``self.ids``."""
        if len(self.number) + len(words) > REMEMBERED:
            self._clean()
        texts = words.to_numpy(zero_copy_only=False).tolist()
        get = self.number.get
        at = np.fromiter((get(w, -1) for w in texts), np.int64, len(texts))
        new = at < 0
        self.again[at[~new]] = True
        if new.any():
            plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
            for kind, chosen in ((True, new & plain), (False, new & ~plain)):
                own = np.flatnonzero(chosen)
                for begin in range(0, len(own), AT_ONCE):
                    self._learn([texts[i] for i in own[begin : begin + AT_ONCE].tolist()], kind)
            own = np.flatnonzero(new)
            at[own] = np.fromiter((get(texts[i]) for i in own.tolist()), np.int64, len(own))
        return self.sizes[at].astype(np.int64), self.begins[at]


def document_ids(words: Words, ids_of: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the documents, each followed by the end id, and where each document begins."""
    codes, distinct = words.coded()
    sizes, at = ids_of(distinct)
    ids, begins = spread(codes, sizes, ids_of.ids, at)
    documents = len(words.first) - 1
    first = begins[words.first] + np.arange(documents + 1)
    out = np.full(first[-1], END, np.uint32)
    out[np.arange(len(ids)) + np.repeat(words.document(), np.diff(begins))] = ids
    return out, first


PIECES = (
    "doc_id {kind}, doc_key long, start long, length long, ids_crc32 long, doc_tokens long"
)


def pieces_of(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> DataFrame:
    """Every document cut after each ``CAPACITY`` ids; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = worker_cache(f"ids {tokenizer}", lambda: WordIds(tokenizer))
        for batch in batches:
            for begin, end in slices(batch.column(1), SLICE):
                part = batch.slice(begin, end - begin)
                ids, first = document_ids(Words(spaced(part.column(1)), lower=False), ids_of)
                tokens = np.diff(first)
                n = -(-tokens // CAPACITY)
                row = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * CAPACITY
                length = np.minimum(CAPACITY, tokens[row] - start)
                at = first[row] + start
                crc = [zlib.crc32(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(row)), part.column(2).take(pa.array(row)),
                    pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(tokens[row]),
                ], ["doc_id", "doc_key", "start", "length", "ids_crc32", "doc_tokens"])
                # Other stages of the same workers need the room.
                del ids, first
                give_back()

    rows = of(docs, id=id_col, text=text_col).withColumn(OWN + "key", text_key(F.col(OWN + "text")))
    return rows.mapInArrow(run, PIECES.format(kind=rows.schema[OWN + "id"].dataType.simpleString()))


def best_pattern(prices: np.ndarray, sizes: np.ndarray) -> tuple[float, np.ndarray]:
    """The dearest set of items that fits, by dynamic programming over the room used."""
    best, last = np.zeros(UNITS + 1), np.full(UNITS + 1, -1)
    order = np.argsort(sizes)
    sizes, prices = sizes[order], prices[order]
    for room in range(1, UNITS + 1):
        n = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if n:
            value = best[room - sizes[:n]] + prices[:n]
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], last[room] = value[k], k
    pattern, room = np.zeros(len(sizes)), UNITS
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[order[last[room]]] += 1
            room -= sizes[last[room]]
    return float(best[UNITS]), pattern


def patterns(demand: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """How often to use which pattern, so that ``demand[k]`` pieces of ``k`` units are placed.

    The linear program over all patterns starts from those of one length; its dual prices go to a
    knapsack, whose answer is the next column, until no column can lower the value by more than
    ``GAP``. What rounding down leaves, less than one sequence per length, is packed largest first.
    The work depends on the number of lengths (``UNITS`` at most), not on the number of pieces.
    """
    sizes = np.flatnonzero(demand)
    left = demand[sizes].astype(np.int64)
    used: list[tuple[int, np.ndarray]] = []
    if len(sizes):
        columns = np.diag(UNITS // sizes).astype(float)
        inverse = np.diag(1.0 / (UNITS // sizes))
        x = inverse @ left
        for _ in range(MOST_ROUNDS):
            price, column = best_pattern(np.maximum(inverse.sum(0), 0), sizes)
            if price <= 1 + GAP:
                break
            step = inverse @ column
            ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                break
            x = x - ratio[out] * step
            x[out] = ratio[out]
            row = inverse[out] / step[out]
            inverse = inverse - np.outer(step, row)
            inverse[out] = row
            columns[:, out] = column
        for k in range(len(sizes)):
            column = columns[:, k].astype(np.int64)
            some = column > 0
            times = min(int(x[k] + 1e-6), int((left[some] // column[some]).min()))
            if times > 0:
                used.append((times, np.bincount(sizes, column, UNITS + 1).astype(np.int64)))
                left -= times * column
    while left.any():
        room, column = UNITS, np.zeros(len(sizes), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            column[k] = min(left[k], room // sizes[k])
            room -= column[k] * sizes[k]
        some = column > 0
        times = int((left[some] // column[some]).min())
        used.append((times, np.bincount(sizes, column, UNITS + 1).astype(np.int64)))
        left -= times * column
    return used


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document longer than a sequence fills sequences of its own; what is left of it, like every
    shorter document, is one piece. Pieces are ranked within their length; a pattern takes the next
    ranks of its lengths. Only the histogram of lengths (``UNITS`` numbers) reaches the driver. A null
    text is empty, and an empty one is the end id alone. Repeated rows and rows with a null id are
    packed like any other. Other columns are not looked at.
    """
    spark = docs.sparkSession
    cut = pieces_of(docs, id_col, text_col, tokenizer)
    spread = 4 * shuffle_partitions(spark)
    deal = F.pmod(F.xxhash64("doc_id", "doc_key", "start"), F.lit(spread)).cast("int")
    units = F.ceil(F.col("length") / WIDTH).cast("int")
    rows = Stored(cut.withColumns({"units": units, "deal": deal}), "pieces")
    # Ranks within a length are dealt out over many tasks, as a third of all pieces may have it.
    counts = rows.rows.groupBy("units", "deal").count()
    before = Window.partitionBy("units").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    base = Stored(
        counts.select("units", "deal", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")),
        "piece-ranks",
    )
    demand = np.zeros(UNITS + 1, np.int64)
    for k, n in base.rows.groupBy("units").agg(F.sum("count")).collect():
        demand[k] = n
    used = patterns(demand)
    within = Window.partitionBy("units", "deal").orderBy("doc_id", "doc_key", "start")
    ranked = rows.rows.withColumn("own", F.row_number().over(within) - 1).join(
        base.rows.drop("count"), ["units", "deal"]
    ).withColumn("rank", F.col("base") + F.col("own"))
    slots = _slots(used)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("units").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.unique(size):
                own = np.flatnonzero(size == k)
                begins, each, first = slots[int(k)]
                at = np.searchsorted(begins, rank[own], side="right") - 1
                turn, slot[own] = np.divmod(rank[own] - begins[at], each[at])
                sequence[own] = first[at] + turn
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(slot)],
                [*batch.schema.names, "sequence_id", "slot"],
            )

    schema = type(ranked.schema)([*ranked.schema.fields]).add("sequence_id", "long").add("slot", "long")
    # A sequence has as many pieces as fit, so this window is bounded.
    earlier = (
        Window.partitionBy("sequence_id").orderBy(F.desc("units"), "slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranked.mapInArrow(place, schema).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
    )


def _slots(used: list[tuple[int, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length, by pattern: its first rank, how many a sequence takes, its first sequence."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks = np.zeros(UNITS + 1, np.int64)
    sequence = 0
    for times, pattern in used:
        for k in np.flatnonzero(pattern):
            found.setdefault(int(k), []).append((int(ranks[k]), int(pattern[k]), sequence))
            ranks[k] += times * pattern[k]
        sequence += times
    return {k: tuple(np.array(column, np.int64) for column in zip(*v)) for k, v in found.items()}
