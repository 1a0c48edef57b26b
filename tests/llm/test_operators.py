"""Each operator on small frames with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lumberline.llm import (
    embedding_dedup, line_dedup, mixing_lm, packing, sentencepiece_codec, simhash, substring_dedup, topk,
    toxicity, warc,
)
from lumberline.llm.common import OWN
from lumberline.llm.components import components
from lumberline.llm.queries import PIECE_MODEL, WORD_BPE

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(3)
VOCABULARY = [f"w{k}" for k in range(400)]


def sentence(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


PASSAGE, LONG = sentence(60), sentence(6000)
TEXTS = [
    sentence(50), f"{sentence(15)} {PASSAGE} {sentence(9)}", f"{PASSAGE}\n{sentence(30)}", LONG, LONG, "", None, " \t\n ",
    "one", "two words", sentence(200), f"a\tb\x0bc\rd  {PASSAGE}", "é ü ß İ 日本語   x", f"{PASSAGE} {PASSAGE}", "A b C", "a B c",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(TEXTS)]
    rows += [rows[2], rows[2], (None, PASSAGE, None, None, None), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    # Names that the operators also use for what they return.
    extra = ("n_words", "fingerprint", "h", "word", "shard", "units", "score", "bucket", "key", "id", "v")
    return frame.withColumns({c: F.lit("extra") for c in extra})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    path = [(k, k + 1) for k in range(0, 300)]
    star = [(1000, 1000 + k) for k in range(1, 200)]
    pairs = [*path, *star, (7, 7), (2000, 2001), (2001, 2000), (2000, 2001)]
    found, _ = components(spark.createDataFrame(pairs, "a long, b long"), "test")
    groups = defaultdict(set)
    for node, root in found.collect():
        groups[root].add(node)
    assert sorted(map(min, groups.values())) == [0, 1000, 2000]
    assert sorted(map(len, groups.values())) == [2, 200, 301]
    none, _ = components(spark.createDataFrame([], "a long, b long"), "test")
    assert none.count() == 0


def test_line_dedup(spark):
    rows = []
    for k in range(12):
        lines = ["shared ", f"own {k}", "", "few" if k < 9 else "many", " shared", f"ten{k % 2}" if k < 11 else "x"]
        rows.append((k, "\n".join(lines), "en", f"site{k}", 0))
    rows += [rows[0], (50, None, "en", "site0", 0), (51, "", None, None, 0), (52, "shared", "en", None, 0), (None, "shared\ny", "en", "z", 0)]
    table = spark.createDataFrame(rows, DOCS)
    sites = defaultdict(set)
    for _, text, _, site, _ in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                sites[line.strip(" \t\r")].add(site)
    for least in (2, 5, 10, 13):
        bad = {line for line, s in sites.items() if len(s - {None}) >= least}
        expected = Counter()
        for i, text, _, _, _ in rows:
            lines = [] if text is None else text.split("\n")
            kept = [x for x in lines if x.strip(" \t\r") not in bad]
            expected[(i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
        found = line_dedup.drop_shared_lines(table, min_sites=least)
        assert found.columns[:5] == table.columns
        assert Counter(map(tuple, found.select("doc_id", "text", OWN + "lines", OWN + "removed").collect())) == expected
    assert line_dedup.drop_shared_lines(table.filter("false")).count() == 0


def test_line_dedup_counts_near_the_threshold_exactly(spark):
    """With four registers the estimates are poor; the result is exact nevertheless near the threshold."""
    rows = [(s, f"line {n}", "en", f"site{s}", 0) for n in range(1, 25) for s in range(n)]
    shared, _ = line_dedup.shared_lines(spark.createDataFrame(rows, DOCS), "text", "source", 12, 8)
    assert shared.select("h").distinct().count() == 13


def brute_repeats(rows):
    order = sorted(set(rows), key=lambda r: (math.inf if r[0] is None else r[0], r[1] or ""))
    first, out = set(), {}
    for i, text in order:
        words = (text or "").encode().split()
        covered = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in first:
                covered[s : s + 20] = [True] * 20
            first.add(window)
        kept = b" ".join(w for w, c in zip(words, covered) if not c)
        out[i, text] = len(words), sum(covered), hashlib.sha256(kept).hexdigest()
    return out


def test_substring_dedup(docs, empty):
    found = substring_dedup.drop_repeated_passages(docs)
    expected = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    rows = found.collect()
    assert len(rows) == docs.count() and found.columns[: len(docs.columns)] == docs.columns
    for row in rows:
        got = row[OWN + "words"], row[OWN + "removed"], hashlib.sha256(row[OWN + "kept"].encode()).hexdigest()
        assert got == expected[row.doc_id, row.text]
    assert substring_dedup.drop_repeated_passages(empty).count() == 0


def test_cut_texts_keep_their_white_space(spark):
    one, other = " ".join(f"p{k}" for k in range(25)), "\t".join(f"p{k}" for k in range(25))
    rows = [
        (1, f"first\n\n {one}\nend \n"), (2, f" a\n\tb  {other} \n c\n\nd "), (3, one), (4, None), (5, " \n "), (6, ""),
        (7, f"{one}\n{one} é\n日本  x"), (8, "no\n repeats  here\t"),
    ]
    found = substring_dedup.drop_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), spaces=True)
    kept = {r.doc_id: r[OWN + "kept"] for r in found.collect()}
    assert kept == {
        1: rows[0][1], 2: " a\n\tb \n c\n\nd ", 3: "", 4: "", 5: " \n ", 6: "", 7: " é\n日本  x", 8: "no\n repeats  here\t"}


def test_substring_dedup_in_many_buckets_of_one_partition(spark, docs, monkeypatch):
    """Buckets and parts follow the bytes of the texts, not the number of shuffle partitions."""
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substring_dedup, "PART_BYTES", 5000)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        found = substring_dedup.drop_repeated_passages(docs.select("doc_id", "text")).collect()
    finally:
        spark.conf.set(setting, before)
    expected = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert len(found) == docs.count()
    for row in found:
        got = row[OWN + "words"], row[OWN + "removed"], hashlib.sha256(row[OWN + "kept"].encode()).hexdigest()
        assert got == expected[row.doc_id, row.text]


def test_simhash(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def fingerprint(text):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))

    prints = {r: fingerprint(r[1]) for r in rows}
    label = union([(a, b) for a in set(prints.values()) for b in set(prints.values()) if (a ^ b).bit_count() <= 2], set(prints.values()))
    least = defaultdict(list)
    for (i, _), p in prints.items():
        least[label[p]] += [i] if i is not None else []
    expected = Counter((i, f"{prints[i, t]:016x}", min(least[label[prints[i, t]]])) for i, t in rows)
    assert Counter(map(tuple, simhash.simhash_components(docs).collect())) == expected
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert {i for i in ids if i is not None} == {i for i, _, root in expected if i == root} and ids.count(None) == 2


@pytest.mark.parametrize("distance, crowd", [(0, 64), (1, 64), (2, 64), (1, 1), (2, 1), (2, 5)])
def test_simhash_links_are_all_links(spark, monkeypatch, distance, crowd):
    """Also where most segment values are shared by more fingerprints than are compared with each other."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40)
    values = {int(b) for b in base} | {0, -1, 1, 3, 7}
    for b in base:
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            value = int(b)
            for f in flips:
                value ^= 1 << int(f)
            values.add(value - 2**64 if value >= 2**63 else value)
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), distance).collect()
    far = [(a, b) for a, b in edges if ((a ^ b) & (2**64 - 1)).bit_count() > distance]
    brute = [(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance]
    assert not far and union(edges, values) == union(brute, values)
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 3)


def test_simhash_probes_are_never_broadcast(spark, monkeypatch):
    """Their number is many times that of the fingerprints, by which Spark sizes them."""
    plans = {}

    class Seen(simhash.Stored):
        def __init__(self, df, label, *more):
            super().__init__(df, label, *more)
            # What ran, as the same frame runs it again.
            df.count()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(simhash, "Stored", Seen)
    prints = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    simhash.links(prints.unionByName(prints.select(F.expr("fp ^ 1").alias("fp"))), 2)
    joins = re.findall(r"(\w+Join)[^\n]*\[segment[^\n]*, Inner", plans["simhash-met"])
    assert joins and set(joins) == {"SortMergeJoin"}


def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + rng.normal(scale=0.12 * (k % 4), size=16)).tolist(), 1) for k in range(400)]
    rows += [(400 + k, rows[0][1], 2) for k in range(60)]  # copies
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [None] + [1.0] * 15, 0), (503, [math.nan] * 16, 0), (504, [math.inf] * 16, 0)]
    rows += [(505, [], 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), rows[3], rows[3], (None, rows[0][1], 0), (508, [-0.0, 1.0], 0), (509, [0.0, 1.0], 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1))


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("beam", [2, 24])
def test_embedding_dedup(spark, monkeypatch, beam):
    """A beam of two is full for nearly all vectors, which are then compared exactly."""
    monkeypatch.setattr(embedding_dedup, "FIRST_BEAM", beam)
    monkeypatch.setattr(embedding_dedup, "LEAST_SHARDS", 4)
    rows, table = vectors(spark)
    own = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and usable(v)})

    def cosine(a, b):
        return np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)) if len(a) == len(b) else 0

    pairs = [(a[0], b[0]) for a in own for b in own if a != b and cosine(a[1], b[1]) >= 0.95]
    count = Counter(a for a, _ in pairs)
    root = union(pairs, [i for i, _ in own])
    found = embedding_dedup.near_duplicates(table).collect()
    assert len(found) == len(rows)
    for vec_id, n_links, component, kept in found:
        assert component == root.get(vec_id, vec_id) and n_links == count[vec_id]
        assert kept == (None if vec_id is None else vec_id == component)
    assert embedding_dedup.near_duplicates(table.filter("false")).count() == 0


def test_topk(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "LEAST_RANGES", 3)
    rows, table = vectors(spark)
    fine = sorted({
        (i, tuple(math.floor(64 * x) for x in v)) for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    })
    for k in (5, 1000):
        expected = []
        for i, v in fine:
            if i % 20 == 0:
                scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in fine if j != i)
                expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
        assert sorted(map(tuple, topk.top_k(table, table["vec_id"] % 20 == 0, k=k).collect())) == sorted(expected)
    assert topk.top_k(table.filter("false"), table["vec_id"] % 20 == 0).count() == 0


PAGE = (
    "<html><head><title>A &amp; B</title><style>p{}</style><script>var x='<a href=\"no\">';</script></head><body><!-- <a href='no'> -->"
    "<h1>Head</h1><p>One  <b>two</b><br>three &lt;four&gt;</p><a class=k href='/x?a=1&amp;b=2'>link</a><img src=pic.png></body></html>"
)


def test_warc(spark, folder):
    rows = [(1, "http://a/b", PAGE), (2, "http://a/é", ""), (3, None, None), (1, "http://a/b", PAGE), (4, "u", "no tags & < 5 ퟿"), (None, "v", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("block", F.lit("clash"))
    records = warc.responses(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z")
    made = {(r.page_id, r.warc_type): r for r in warc.derive(records, keep="page_id").collect()}
    sources = {r.page_id: r for r in records.collect()}
    assert warc.derive(records).count() == 12
    for (page, kind), row in made.items():
        assert row.refers_to == sources[page].record_id and row.payload_digest == sources[page].payload_digest
        assert row.warc_date == sources[page].warc_date and row.target_uri == sources[page].target_uri
        assert row.block_digest == warc.digest(bytes(row.block)) and row.content_length == len(row.block)
        other = made[page, "conversion" if kind == "metadata" else "metadata"]
        assert row.concurrent_to == other.record_id != row.record_id
    assert bytes(made[1, "conversion"].block).decode() == "A & B\nHead\nOne two\nthree <four>\nlink"
    described = __import__("json").loads(bytes(made[1, "metadata"].block))["Envelope"]
    http = described["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert http["Status"] == "HTTP/1.1 200 OK" and http["HTML-Metadata"]["Title"] == "A & B"
    assert {"path": "A@/href", "url": "/x?a=1&b=2"} in http["HTML-Metadata"]["Links"]
    assert described["WARC-Header-Metadata"]["WARC-Record-ID"] == sources[1].record_id
    assert bytes(made[None, "conversion"].block) == b"x" * 300_000 and bytes(made[3, "conversion"].block) == b""
    for compression in ("none", "gzip"):
        path = folder(f"warc-{compression}")
        everything = records.drop("page_id").unionByName(warc.derive(records))
        warc.write_warc(everything, path, compression)
        back = warc.read_warc(spark, path)
        assert sorted(map(str, back.collect())) == sorted(map(str, everything.collect()))
    other = records.drop("page_id").withColumn("block", F.encode(F.lit("HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\nx"), "utf-8"))
    assert {r.warc_type for r in warc.derive(other).collect()} == {"metadata"}
    assert warc.derive(records.filter("false")).count() == 0


def test_word_ids_are_the_tokenizers():
    tokenizer, ids_of = Tokenizer.from_file(WORD_BPE), packing.WordIds(WORD_BPE)
    texts = [
        "Hello, world. it's <|endoftext|> a\x00b \x00 x \x00\x00 naïve ÀÉ. İstanbul ﬁ é z w   1234 !!! ab.. ,. 日本語 don't",
        "", " \n", "\x00", "A" * 3000, "the <|startoftext|>x of.", LONG,
    ]
    for _ in range(2):  # new words, then remembered ones
        ids, first = packing.document_ids(packing.Words(pa.array(texts), lower=False), ids_of)
        for k, text in enumerate(texts):
            expected = tokenizer.encode(text, add_special_tokens=False).ids + [packing.END]
            assert ids[first[k] : first[k + 1]].tolist() == expected


def test_packing(spark, docs, empty):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    long_rows = spark.createDataFrame([(900 + k, sentence(300 + 37 * k), None, None, 0) for k in range(60)], DOCS)
    table = docs.select(*long_rows.columns).unionByName(long_rows)
    rows = packing.pack(table, WORD_BPE).collect()
    wanted = Counter()
    for r in table.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [packing.END], "<u4")
        for s in range(0, len(ids), packing.CAPACITY):
            part = ids[s : s + packing.CAPACITY]
            wanted[(r.doc_id, s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    tokens = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * tokens / packing.CAPACITY + 2
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_patterns_place_every_piece():
    rng = np.random.default_rng(2)
    for size in (1, 30, 3000, 200_000):
        demand = np.bincount(np.clip(rng.lognormal(3.5, 1, size).astype(int), 1, packing.UNITS), minlength=packing.UNITS + 1)
        placed = np.zeros_like(demand)
        for times, pattern in packing.patterns(demand):
            assert (pattern * np.arange(len(pattern))).sum() <= packing.UNITS
            placed += times * pattern
        assert (placed == demand).all()
        used = sum(times for times, _ in packing.patterns(demand))
        least = (demand * np.arange(len(demand))).sum() / packing.UNITS
        assert used <= 1.01 * least + len(np.flatnonzero(demand))


def test_lm_scoring(spark, docs, empty):
    more = spark.createDataFrame([(100 + k, sentence(80), "en", "s", 0) for k in range(120)], DOCS)
    table = docs.select(*more.columns).unionByName(more)
    rows = [(r.doc_id, r.text) for r in table.collect()]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1

    def tokens(text):
        return [*(text or "").encode().lower().split(), b" "]

    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for most in (mixing_lm.HELD_WORDS, 50):  # all counts held by every task, and most of them joined
        mixing_lm.HELD_WORDS, before = most, mixing_lm.HELD_WORDS
        found = mixing_lm.score_documents(table).collect()
        mixing_lm.HELD_WORDS = before
        assert len(found) == len(rows)
        by_id = {r.doc_id: r for r in found if r.doc_id is not None}
        for i, text in rows:
            if i is None:
                continue
            own, r = tokens(text), by_id[i]
            base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(own), sum(t in counts for t in own), total)
            assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        new = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id >= 100]
        if most > 50:  # words drawn evenly, so that no context helps
            assert sum(r.score for r in new) > sum(r.base_score for r in new) * 1.1
    assert mixing_lm.score_documents(empty).count() == 0


def lm_chances(model, steps):
    """The chance of each bit under the start weights and refinement, written down anew."""
    z = (model.start[:, steps.gate] * steps.x).sum(0)
    z = z + model.refined[steps.gate, np.rint(np.clip(2 * z, -mixing_lm.HALF, mixing_lm.HALF)).astype(int) + mixing_lm.HALF]
    return 1 / (1 + np.exp(-np.where(steps.bits == 1, z, -z).astype(np.float64)))


def test_lm_chances_add_up_to_one():
    """All symbols that may come next, the escape included, sum to one in any context, and so do all bytes that may follow."""
    rng = np.random.default_rng(0)
    words, counts = np.arange(10, 40, dtype=np.uint64), rng.integers(1, 60, 30)
    code, ways = mixing_lm.build_code(words, counts, 4)
    pairs, rest = mixing_lm.first_context(code, ways, rng.integers(0, 20, (mixing_lm.FREQUENT + 1, 31)), 4.0)

    def table(doubt):
        total = rng.integers(0, 30, 1 << mixing_lm.SLOT_BITS)
        return mixing_lm._pairs(rng.integers(0, total + 1), total, doubt)

    model = mixing_lm.Model(
        code, [pairs, table(4.0), table(4.0)], rest, [table(8.0) for _ in mixing_lm.ORDERS], words, counts, True, 93, 6,
        rng.normal(1, 0.4, (mixing_lm.INPUTS, mixing_lm.GATES)).astype(np.float32),
        rng.normal(0, 0.3, (mixing_lm.GATES, mixing_lm.REFINED)).astype(np.float32))
    tokens = mixing_lm.Tokens(pa.array(["b c b"]))
    for before in ([], [3], [30, 3], [3, 7, 3]):
        at = len(before)
        sums = 0.0
        for symbol in range(31):
            symbols = np.array([*before, symbol, *[0] * (3 - at)])
            turn = np.arange(4)
            steps = mixing_lm.coded_steps(model, tokens, symbols, turn, False)
            sums += lm_chances(model, steps)[steps.turn == at].prod()
        assert sums == pytest.approx(1, abs=1e-5)
    # A word of each single byte: the chances of its first eight bits.
    every = SimpleNamespace(
        code=np.arange(256), document=np.arange(256), distinct=pa.array([bytes([b]) for b in range(256)], pa.binary()))
    steps = mixing_lm.spelled_steps(model, every, np.full(256, 30), np.zeros(256, np.int64), False)
    first = lm_chances(model, steps).reshape(256, 2, 8)[:, 0].prod(1)
    assert first.sum() == pytest.approx(1, abs=1e-5) and first.min() > 0
    # The score of a text is the sum of these, as long as nothing was learnt on the way.
    one = mixing_lm.Tokens(pa.array([""]))
    for symbol in range(30):
        steps = mixing_lm.coded_steps(model, one, np.array([symbol]), np.zeros(1, np.int64), False)
        expected = np.log10(lm_chances(model, steps)).sum()
        assert mixing_lm.code_scores(model, one, np.array([symbol]))[0] == pytest.approx(expected, abs=1e-4)


def test_lm_mixing_bit_by_bit():
    """Weights and refinement as a document goes on, one document, stretch and bit at a time."""
    rng = np.random.default_rng(4)
    words, counts = np.arange(10, 40, dtype=np.uint64), rng.integers(1, 60, 30)
    code, ways = mixing_lm.build_code(words, counts, 4)
    pairs, rest = mixing_lm.first_context(code, ways, rng.integers(0, 20, (mixing_lm.FREQUENT + 1, 31)), 4.0)

    def table(doubt):
        total = rng.integers(0, 30, 1 << mixing_lm.SLOT_BITS)
        return mixing_lm._pairs(rng.integers(0, total + 1), total, doubt)

    start = rng.normal(1, 0.3, (mixing_lm.INPUTS, mixing_lm.GATES)).astype(np.float32)
    refined = rng.normal(0, 0.2, (mixing_lm.GATES, mixing_lm.REFINED)).astype(np.float32)
    model = mixing_lm.Model(
        code, [pairs, table(4.0), table(4.0)], rest, [table(8.0) for _ in mixing_lm.ORDERS], words, counts, True, 93, 6, start, refined)
    texts = [sentence(150), "a", "", sentence(70), "b c b c b c b"]
    tokens = mixing_lm.Tokens(pa.array(texts))
    symbols = rng.integers(0, 31, len(tokens.code))
    steps = mixing_lm.steps(model, tokens, symbols)
    expected = []
    for document in range(len(texts)):
        weight, extra = start.astype(float).copy(), refined.astype(float).copy()
        bent, varied = np.full_like(weight, 1 / mixing_lm.RATE), np.full_like(extra, 1 / mixing_lm.REFINED_RATE)
        score = 0.0
        for turn in sorted(set(steps.turn[steps.owner == document].tolist())):
            change, off = np.zeros_like(weight), np.zeros_like(extra)
            for i in np.flatnonzero((steps.owner == document) & (steps.turn == turn)):
                x, g, sign = steps.x[:, i].astype(float), steps.gate[i], 1 if steps.bits[i] else -1
                z = float(weight[:, g] @ x)
                bucket = int(np.rint(np.clip(2 * z, -mixing_lm.HALF, mixing_lm.HALF))) + mixing_lm.HALF
                chance = 1 / (1 + math.exp(-max(-18, min(18, z + extra[g, bucket])) * sign))
                score += math.log10(chance)
                error, variance = (1 - chance) * sign, chance * (1 - chance)
                bent[:, g] += variance * np.abs(x).sum() * np.abs(x)
                change[:, g] += error * x
                varied[g, bucket] += variance
                off[g, bucket] += error
            weight = np.clip(weight + change / bent, -4, 4)
            extra = np.clip(extra + off / varied, -1, 1)
        expected.append(score)
    found = mixing_lm.code_scores(model, tokens, symbols)
    # Single precision puts a few bits into the next bucket.
    assert found == pytest.approx(expected, rel=2e-3, abs=1e-3)


def test_lm_mixes_every_bit_under_every_context():
    """What a word costs depends on the two before it down to its last bit, and nothing is left to a fixed table."""
    n = 1 << 10
    words = np.sort(np.random.default_rng(1).integers(10, 1 << 60, n).astype(np.uint64))
    counts = np.full(n, 7)
    code, ways = mixing_lm.build_code(words, counts, 7)
    symbol, nodes, _, mixed = ways
    assert mixed.all() and len(code.nodes) == len(nodes) and np.diff(code.first).min() >= 10
    _, rest = mixing_lm.first_context(code, ways, np.ones((mixing_lm.FREQUENT + 1, n + 1), np.int64), 4.0)
    assert not rest.any()
    tokens = mixing_lm.Tokens(pa.array(["a b c", "d b c", "b c"]))
    last, two = code.contexts(tokens, np.zeros(len(tokens.code), np.int64))[1:]
    after = tokens.position == np.array([2] * 4 + [2] * 4 + [1] * 3)  # "c" of each text
    assert len(set(last[after].tolist())) == 1 and len(set(two[after].tolist())) == 3
    # Ten sightings of one word after the same two raise its chance at the deepest bits too.
    empty, own = np.zeros(1 << 20), np.zeros(2 << 20)
    target = 3
    slot = mixing_lm._slot(np.repeat(two[after][:1], np.diff(code.first)[target]), code.expand(np.array([target]))[0])
    np.add.at(own, 2 * slot + code.expand(np.array([target]))[1], 10)
    blank = mixing_lm._pairs(empty, empty, 4.0)
    seen = mixing_lm._pairs(own[1::2], own[::2] + own[1::2], 4.0)
    symbols = np.full(len(tokens.code), n)
    symbols[after] = target
    model = mixing_lm.Model(code, [blank, blank, seen], rest, [blank] * 4, words, counts, True, 7 * n, n)
    a, d, _ = mixing_lm.code_scores(model, tokens, symbols)
    assert a - d > 2  # of about three for ten bits that cost a half each


def test_lm_start_is_learnt(spark):
    """The start weights come from the training texts, short texts gain by them, and spelled words are mixed too."""
    rng = random.Random(5)
    follows = {w: rng.sample(VOCABULARY, 2) for w in VOCABULARY}

    def chain(n):
        words = [rng.choice(VOCABULARY)]
        while len(words) < n:
            words.append(rng.choice(follows[words[-1]]))
        return " ".join(words)

    texts = spark.createDataFrame([(chain(30),) for _ in range(400)], "text string")
    model, _ = mixing_lm.train(texts, "text")
    weights, refined = mixing_lm.constant_start()
    used = np.abs(model.start - weights) > 0.01
    assert used[:, :mixing_lm.CODED_GATES].any() and model.refined.shape == refined.shape and model.refined.any()
    short = mixing_lm.Tokens(pa.array([chain(8) for _ in range(200)]))
    symbols = model.code.symbols(short.code_hashes)[short.code]
    fixed = model._replace(start=None, refined=None)
    assert mixing_lm.code_scores(model, short, symbols).sum() > mixing_lm.code_scores(fixed, short, symbols).sum()
    # A word without a code is refined as it comes again; before, each sighting cost the same.
    again = mixing_lm.Tokens(pa.array([" ".join(["qqxqq"] * n) for n in (1, 2, 40, 41)]))
    symbols = model.code.symbols(again.code_hashes)[again.code]
    steps = mixing_lm.steps(model, again, symbols)
    assert (steps.gate >= mixing_lm.CODED_GATES).sum() == 8 * 6 * (1 + 2 + 40 + 41)
    one, two, forty, more = mixing_lm.code_scores(model, again, symbols)
    assert more - forty > two - one


def test_lm_own_sighting_is_left_out():
    total = np.array([1, 1, 2, 7, 50, 1000])
    ones = np.array([0, 1, 1, 3, 50, 10])
    bits = np.array([0, 1, 0, 1, 1, 0])
    found = mixing_lm._without(mixing_lm._pairs(ones, total, 4.0), bits, 4.0)
    assert np.allclose(found, mixing_lm._pairs(ones - bits, total - 1, 4.0), atol=1e-3)


def test_lm_left_out_of_both_bits():
    """The tables to learn from hold what is worked out bit by bit without them."""
    rng = np.random.default_rng(6)
    total = rng.integers(0, 40, 1 << mixing_lm.SLOT_BITS)
    seen = mixing_lm._pairs(rng.integers(0, total + 1), total, 4.0)
    slots, bits = rng.integers(0, len(seen), 5000), rng.integers(0, 2, 5000).astype(np.uint8)
    assert np.array_equal(mixing_lm._left_out(seen, 4.0)[2 * slots + bits], mixing_lm._without(seen[slots], bits, 4.0))


def test_lm_spelled_words_are_learnt_from_once(spark):
    """A word without a code is learnt from by its distinct bytes and how often they come, as if each came alone."""
    times = {"abc": 30, "abd": 2, "the": 50, "añb": 1, "abcdefg": 4}
    the = np.array([xxhash.xxh64_intdigest(w, mixing_lm.SEED) for w in (b"the", mixing_lm.END_WORD)], np.uint64)
    code, ways = mixing_lm.build_code(the, np.array([50, 9]), 37)
    counts = spark.createDataFrame(
        [(w.encode(), n) for w, n in times.items()] + [(mixing_lm.END_WORD, 9)], "word binary, n long"
    ).withColumn("h", F.xxhash64("word"))
    found = {r.gram: r.n for r in mixing_lm.spelled_grams(counts, code).collect()}
    expected = Counter()
    for word, n in times.items():
        data = b"    " + word.encode() + b" "
        for at in range(5, len(data) + 1) if word != "the" else ():
            expected[int.from_bytes(data[at - 5 : at], "big")] += n
    assert found == expected and max(found.values()) > 30
    # Each distinct byte with its count adds as much as all sightings one by one.
    rng = np.random.default_rng(7)
    total = rng.integers(0, 60, 1 << mixing_lm.SLOT_BITS)
    spelling = [mixing_lm._pairs(rng.integers(0, total + 1), total, 8.0) for _ in mixing_lm.ORDERS]
    model = mixing_lm.Model(code, [], ways[0], spelling, the, np.array([50, 9]), True, 96, 6)
    start = rng.normal(1, 0.3, (mixing_lm.INPUTS, mixing_lm.GATES)).astype(np.float32)

    def sums(grams, n, refine):
        x, bits, gate = mixing_lm.gram_bits(model, np.array(grams, np.uint64), True)
        x = np.concatenate([x, np.zeros((1, *bits.shape), np.float32)]).reshape(mixing_lm.INPUTS, -1)
        times = None if n is None else np.repeat(n, 8)
        return mixing_lm.slopes(start, x, bits.reshape(-1), gate.reshape(-1), refine, times)

    for refine in (False, True):
        once = sums(list(found), np.array(list(found.values())), refine)
        alone = sums([g for g, n in found.items() for _ in range(n)], None, refine)
        assert all(np.allclose(a, b) and a.any() for a, b in zip(once, alone))


CLASHES = ("line", "site", "h", "h2", "text_key", "doc_key", "units", "deal", "rank", "own", "asks", "v", "id", "key", "row", "part")


def test_columns_with_clashing_names(spark, docs):
    """Columns named like the operators' own change nothing: the results are those of the plain columns."""
    rows = docs.select("doc_id", "text", "source")
    odd = rows.withColumns({c: F.lit("extra") for c in CLASHES})
    for operator in (
        line_dedup.drop_shared_lines, lambda d: packing.pack(d, WORD_BPE), mixing_lm.score_documents,
        lambda d: sentencepiece_codec.encode(d, PIECE_MODEL), lambda d: simhash.simhash_components(d),
    ):
        plain, found = operator(rows), operator(odd)
        keys = ["doc_id", "start", "length", "offset"] if "sequence_id" in plain.columns else plain.columns
        keys = [c for c in keys if c != "offset"]
        if "score" in plain.columns:
            keys = ["doc_id", "n_tokens", "n_known"]
        assert sorted(map(str, found.select(*keys).collect())) == sorted(map(str, plain.select(*keys).collect()))
    vectors = spark.createDataFrame([(k, [float(k % 5), 1.0]) for k in range(60)], "vec_id long, embedding array<double>")
    extra = vectors.withColumns({c: F.lit("extra") for c in CLASHES})
    for operator in (
        lambda t: topk.top_k(t, t["vec_id"] % 20 == 0), embedding_dedup.near_duplicates,
    ):
        assert sorted(map(str, operator(extra).collect())) == sorted(map(str, operator(vectors).collect()))


def test_toxicity(spark, docs, empty):
    bad = ["zorgle", "blatfen", "grumsk"]
    rows, labels = [], []
    for k in range(600):
        words = sentence(40).split()
        if k % 5 == 0:
            for at in range(0, 40, 12):
                words[at] = RNG.choice(bad) + RNG.choice(["", "s", "ed", "ing"])
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, int(k % 5 == 0)))
    labels += [(0, 1, None), (1, None, 0), (None, 1, 1), (3, 1, 0), (3, 1, 0)]
    texts = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("extra"))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(texts, table)
    scored = {r.doc_id: r[OWN + "score"] for r in toxicity.score_toxicity(texts, model).collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 3 == 1]
    right = [(scored[k] >= toxicity.THRESHOLD) == (k % 5 == 0) for k in held]
    assert sum(right) >= 0.97 * len(held), (sum(right), len(held))
    # A misspelling never seen shares its subwords.
    unseen = toxicity.scores(model, pa.array([f"{sentence(30)} zorglez blatfenn grumske {sentence(30)}", sentence(60), "", None]))
    assert unseen[0] > unseen[1] < toxicity.THRESHOLD and unseen[2] == unseen[3] < 0.5
    everything = toxicity.score_toxicity(docs, model)
    assert everything.count() == docs.count() and all(0 <= r[OWN + "score"] <= 1 for r in everything.collect())
    for none in (table.filter("false"), table.filter("toxic = 0")):
        prior = toxicity.fit_toxicity(texts, none)
        assert 0 < toxicity.scores(prior, pa.array(["x"]))[0] < 1
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_toxicity_learns_from_long_texts(spark):
    """All rows of a class are longer than the sample's bound, and only the end of a text tells."""
    rows = [(k, " ".join([sentence(5000), "zorgle blatfen grumsk " * 500 if k % 2 else ""])) for k in range(60)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(texts, labels)
    bad, good = toxicity.scores(model, pa.array([f"{sentence(30)} zorgle blatfen grumsk zorgle", sentence(40)]))
    assert bad > 0.7 > 0.5 > good
    odd = spark.createDataFrame([("x " * 40000 + "Y", 1), ("a b a\tB \n", 2), (None, 3), (" ", 4)], "text string, k int").orderBy("k")
    found = [r[0].split() for r in odd.select(toxicity._distinct_words(F.col("text"))).collect()]
    assert found == [["x", "y"], ["a", "b"], [], []]


def test_strongest_words_count_the_same_wherever_they_stand():
    texts = ["c b a", "a b c d", "a", "", "b b b b", None, "d c x"]
    bags = toxicity.Bags(pa.array(texts))
    worth = {"a": 6.0, "b": 3.0, "c": -1.0, "d": 0.5, "x": -3.0}
    names = {w: k for k, w in enumerate(dict.fromkeys(" ".join(t or "" for t in texts).split()))}
    of_word = np.array([worth[w] for w in names])
    mean, chosen = bags.strongest(of_word)
    assert mean.tolist() == [8 / 3, 9.5 / 3, 2.0, 0.0, 1.0, 0.0, -3.5 / 3]
    assert chosen[1].tolist() == [names["a"], names["b"], names["d"]] and chosen[3].tolist() == [-1, -1, -1]
    assert chosen[4].tolist() == [names["b"], -1, -1]


def test_sentencepiece(docs, empty):
    coded = sentencepiece_codec.encode(docs, PIECE_MODEL)
    back = sentencepiece_codec.decode(coded, PIECE_MODEL)
    assert back.columns[: len(docs.columns)] == docs.columns
    for row in back.collect():
        assert row[OWN + "decoded"] == (row.text or "")
    assert sentencepiece_codec.encode(empty, PIECE_MODEL).count() == 0


def test_streaming_viterbi_finds_the_best_path():
    pieces = sentencepiece_codec.Pieces(PIECE_MODEL)

    def whole(text):
        best, back = [0.0], [(0, -1)]
        for end in range(1, len(text) + 1):
            value, origin = best[end - 1] + pieces.unknown, (end - 1, -1)
            for begin in range(max(0, end - pieces.longest), end):
                found = pieces.score.get(text[begin:end])
                if found and best[begin] + found[0] > value:
                    value, origin = best[begin] + found[0], (begin, found[1])
            best.append(value)
            back.append(origin)
        ids, end = [], len(text)
        while end:
            begin, i = back[end]
            ids = ([i] if i >= 0 else pieces.byte[list(text[begin:end].encode())].tolist()) + ids
            end = begin
        return ids

    samples = ["", "a", "  two  spaces ", "Straße 日本語 \U0001f600\x00 x", sentence(50), "ab" * 300, " " * 100, "line\nline\tend", LONG[:3000]]
    samples += ["".join(RNG.choice("thera n\néß") for _ in range(200)) for _ in range(30)]
    for text in samples:
        marked = sentencepiece_codec.SPACE + text.replace(" ", sentencepiece_codec.SPACE)
        ids = pieces.encode(text).tolist()
        assert ids == (whole(marked) if text else [])
        assert list(pieces.stream(marked)) == whole(marked)
        joined, begins = pieces.encode_all(pa.array([text, None, text]))
        assert joined.tolist() == ids + ids and begins.tolist() == [0, len(ids), len(ids), 2 * len(ids)]
        assert pieces.decode_all(joined, begins)[0].decode() == text


def test_streaming_viterbi_holds_a_bounded_window():
    pieces = sentencepiece_codec.Pieces(PIECE_MODEL)
    given = 0

    def letters():
        nonlocal given
        for char in "therationed" * 3000:
            given += 1
            yield char

    late = 0
    out = 0
    for i in pieces.stream(letters()):
        out += len(pieces.text[i])
        late = max(late, given - out)
    assert out == 33_000 and late < 20 * pieces.longest


def test_pipeline(spark, docs, folder):
    sf = folder("sf")
    texts = docs.select("doc_id", "text", "lang", "source", "n_chars", "score", "key")
    texts.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    table = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf)
        assert table.columns == texts.columns and table.count() > 0
        assert table.filter("text IS NOT NULL AND n_chars <> length(text)").count() == 0 or name == "toxicity"
    assert corpus_pipeline.run(spark, sf).count() >= 10


def brute_pipeline(rows, toxic):
    """All stages but packing, on rows of (id, text, source) with ids of their own."""
    rows = [r for r in rows if r[0] not in toxic]
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                sites[line.strip(" \t\r")].add(source)
    shared = {line for line, found in sites.items() if len(found) >= line_dedup.MIN_SITES}
    rows = [
        (i, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" \t\r") not in shared), s) for i, t, s in rows]

    def fingerprint(text):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))

    prints = {r[0]: fingerprint(r[1]) for r in rows}
    label = union([(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2], prints)
    rows = sorted(r for r in rows if label[r[0]] == r[0])
    first, out = set(), {}
    for i, text, _ in rows:
        spans = [m.span() for m in __import__("re").finditer(r"[^\x20\x09-\x0D]+", text or "")]
        words = [text[a:b] for a, b in spans]
        gone = set()
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in first:
                gone.update(range(k, k + 20))
            first.add(window)
        at, kept = 0, ""
        for k, (a, b) in enumerate(spans):
            kept += "" if k in gone else text[at:b]
            at = b
        out[i] = None if text is None else kept + text[at:]
    return out


def test_pipeline_against_brute_force(spark, folder, monkeypatch):
    """Every stage's decision takes effect on what the stage before it kept; then all of it is packed."""
    sf = folder("sf")
    passage = sentence(45)
    rows = [(k, f"site line\n{sentence(60)}\n\n  {sentence(30)} \n", f"s{k % 12}") for k in range(40)]
    rows += [(100 + k, f"{sentence(20)}\n{passage}\n\t{sentence(25)}", f"s{k}") for k in range(6)]
    rows += [(200 + k, f"{rows[5][1]} " + ("x" if k else ""), "s1") for k in range(3)]
    rows += [(300, None, "s1"), (301, "", None), (302, " \n", "s2"), (303, "site line", "s3"), (304, rows[0][1].replace(" ", "  "), "s3")]
    bad = {7, 8, 100}
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    # The classifier is compared with labels elsewhere; here it is told what to say.
    monkeypatch.setattr(
        toxicity, "score_toxicity",
        lambda docs, model: docs.withColumn(OWN + "score", F.col("doc_id").isin(*bad).cast("double")))
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf)
    expected = brute_pipeline(rows, bad)
    assert {r.doc_id: r.text for r in table.collect()} == expected
    assert len(expected) < len(rows) - len(bad)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    packed = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf).collect():
        packed[r.doc_id] += r.length
    assert packed == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in expected.items()}


def test_pipeline_of_an_empty_table(spark, empty, folder):
    sf = folder("sf")
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
