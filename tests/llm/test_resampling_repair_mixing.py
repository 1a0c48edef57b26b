"""Resampling, conversation repair and mixing of sources against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lumberline.llm import conversation_repair as repair, importance, mixing_sources
from lumberline.llm.common import OWN
from lumberline.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(11)
VOCABULARY = [f"Wort{k}" for k in range(60)] + ["É", "a1", "x-y", "日本", "don't"]


def prose(n, lines=3):
    return "\n".join(" ".join(RNG.choice(VOCABULARY) for _ in range(n // lines)) for _ in range(lines))


LONG = prose(9000, 40)
TEXTS = [prose(RNG.randint(3, 90), RNG.randint(1, 5)) for _ in range(60)]
TEXTS += [LONG, LONG, "", None, "\n\n", " .,; ", "one", "A b\nC d\nA b\nC d", "x\ny\nz\nw", f"{TEXTS[0]}\n{TEXTS[1]}\n{TEXTS[0]}"]
ROWS = [(k, t, "en", None if k % 17 == 0 else f"s{min(k % 7, 4)}", 0) for k, t in enumerate(TEXTS)]
ROWS += [ROWS[3], ROWS[3], (None, TEXTS[4], None, "s1", None), (None, None, None, None, None), (2, TEXTS[9], "en", "S9", 0)]
CLASHING = ("line", "h", "t", "count", "n", "bucket", "weight", "score", "rank", "size", "target", "place", "key", "part", "no", "turns", "copies")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate([prose(40), prose(12), None, ""])], "item_id long, text string")


def as_multiset(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# Resampling


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, longest, buckets):
    own = words(text)
    return [
        zlib.crc32(" ".join(own[i : i + n]).encode()) % buckets
        for n in range(1, longest + 1) for i in range(len(own) - n + 1)
    ]


def brute_resample(rows, targets, longest, buckets, least, percent):
    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(features(text, longest, buckets))
    for text in targets:
        t.update(features(text, longest, buckets))
    of_s, of_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (of_s + buckets) / ((s[b] + 1) * (of_t + buckets))))

    scored = []
    for i, text, *_ in rows:
        found = features(text, longest, buckets)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    may = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    drawn = Counter((r[0], r[3], k + 1) for k, r in enumerate(may[: percent * len(may) // 100]))
    return Counter(r[:4] for r in scored), drawn


@pytest.mark.parametrize("longest, buckets, least, percent", [(1, 10000, 20, 10), (2, 997, 5, 40), (4, 50, 0, 100)])
def test_resampling(docs, benchmark, longest, buckets, least, percent):
    found = importance.resample(docs, benchmark, longest=longest, buckets=buckets, least_words=least, percent=percent)
    assert found.columns[: len(docs.columns)] == docs.columns
    targets = [r.text for r in benchmark.collect()]
    scored, drawn = brute_resample(ROWS, targets, longest, buckets, least, percent)
    names = [OWN + c for c in ("features", "weight", "score", "rank")]
    assert as_multiset(found, "doc_id", *names[:3]) == scored
    assert as_multiset(found.filter(F.col(names[3]).isNotNull()), "doc_id", *names[2:]) == drawn
    assert as_multiset(found, *docs.columns) == as_multiset(docs, *docs.columns)


def test_resampling_of_empty_tables(docs, benchmark):
    none = docs.filter("false")
    assert importance.resample(none, benchmark).count() == 0
    assert importance.resample(docs, benchmark.filter("false")).count() == docs.count()


def test_a_line_is_counted_once_for_all_its_texts(spark):
    rows = [(k, f"shared line of words\nown{k}", "en", "s", 0) for k in range(50)]
    own = importance.Features(spark.createDataFrame(rows, DOCS), "text")
    assert own.lines.rows.count() == 51
    assert {r.n_lines for r in own.lines.rows.collect()} == {1, 50}


# Conversations

AFTER = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute_repair(rows):
    """Left to right over (rows read, last initial), which is not how the operator works."""
    seen, kinds = set(), []
    for _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not stripped else "duplicate" if (role, text) in seen else "fine" if stripped[-1] in ".!?" else "truncated"
        seen.add((role, text))
        kinds.append(kind)
    best = {(0, ""): (0, "", ())}

    def offer(at, found):
        if at not in best or found[:2] < best[at][:2]:
            best[at] = found

    for i in range(len(rows) + 1):
        for _ in range(3):
            for last in AFTER:
                if (i, last) in best:
                    cost, audit, out = best[i, last]
                    for q in AFTER[last].replace("s", ""):
                        offer((i, q), (cost + 5, audit + "I", (*out, ("user" if q == "u" else "assistant", ""))))
        if i == len(rows):
            break
        _, role, text = rows[i]
        for last in AFTER:
            if (i, last) not in best:
                continue
            cost, audit, out = best[i, last]
            offer((i + 1, last), (cost + 2, audit + "D", out))
            if kinds[i] in ("blank", "duplicate"):
                continue
            more = 5 if kinds[i] == "truncated" else 0
            for q in AFTER[last]:
                if role[:1] == q:
                    offer((i + 1, q), (cost + more, audit + "K", (*out, (role, text))))
                if q != "s":
                    offer((i + 1, q), (cost + more + 1, audit + "R", (*out, ("user" if q == "u" else "assistant", text))))
    cost, audit, out = min((best[len(rows), q] for q in ("", "a") if (len(rows), q) in best), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, digest,
    )


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", "a", None]
SAID = ["Hello.", "Yes!", "no", "why?", "cut off,", "", " \t", None, "Hello. \n", "é?", "a.b"]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def talk(conv, n):
    return [(conv, RNG.choice([k, k, k, k // 2, None]), RNG.choice(ROLES[: RNG.choice([4, 10])]), RNG.choice(SAID)) for k in range(n)]


def found_of(spark, rows, extra=True):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        frame = frame.withColumns({c: F.lit("extra") for c in (*CLASHING, "audit", "n", "blank")})
    made = repair.repair_conversations(frame)
    joined = made.conversations.join(made.digests(), "key").select("key", *COUNTS, "sha256")
    return made, {r.key: tuple(r)[1:] for r in joined.collect()}


def expected_of(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by["-" if conv is None else f"={conv}"].append((turn, " " if role is None else role, " " if text is None else text))
    return {key: brute_repair(ordered(own)) for key, own in by.items()}


@pytest.mark.parametrize("span_rows", [512, 3])
def test_repair(spark, monkeypatch, span_rows):
    """Also with conversations cut into spans of three rows."""
    monkeypatch.setattr(repair, "SPAN_ROWS", span_rows)
    rows = [r for conv in range(80) for r in talk(conv, RNG.randint(1, 9))]
    rows += talk(100, 300) + talk(None, 40) + [(101, 5, "user", "same?")] * 40 + [(102, k, "user", "same?") for k in range(40)]
    rows += [(103, k, "user" if k % 2 == 0 else "assistant", f"{k} {'long ' * 2000}.") for k in range(24)]
    made, found = found_of(spark, rows)
    assert found == expected_of(rows)
    turns = defaultdict(list)
    for r in made.turns().orderBy("key", "place").collect():
        turns[r.key].append((r.edit, r.role, r.text))
    for key, own in turns.items():
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in own).encode()).hexdigest()
        assert found[key][-1] == digest
        assert [e for e, _, _ in own] == [e for e in found[key][-2] if e != "D"]
        assert re.fullmatch(r"(s?(ua)+)?", "".join(role[:1] for _, role, _ in own))


def test_repair_of_nothing(spark):
    made, found = found_of(spark, [])
    assert found == {} and made.turns().count() == 0


def test_every_split_of_a_span_gives_the_same_cell():
    """Which is why the operator needs cells of lengths 1, 2, 4… alone."""
    for _ in range(30):
        cells = [repair.row_cell(RNG.random() < 0.3, RNG.random() < 0.3, RNG.choice(["s", "u", "a", "x"])) for _ in range(RNG.randint(2, 9))]
        chart = {(k, k + 1): cell for k, cell in enumerate(cells)}
        for length in range(2, len(cells) + 1):
            for start in range(len(cells) - length + 1):
                stop = start + length
                ways = [repair.joined(chart[start, k], chart[k, stop]) for k in range(start + 1, stop)]
                assert all(way == ways[0] for way in ways)
                chart[start, stop] = ways[0]
        whole = chart[0, len(cells)]
        cost, audit, ends = repair.parse(cells)
        assert (cost, audit) == min(whole[""][q] for q in repair.ENDS if q in whole[""])
        assert repair.merged(cells) == whole and len(ends) == len(cells)


def test_repair_query(spark, tmp_path):
    rows = [r for conv in range(150) for r in talk(conv, RNG.randint(1, 5))] + talk(None, 12)
    rows += [(conv, 0, "user", "Alone.") for conv in range(200, 300)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    damaged = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    expected = expected_of(damaged)
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    wanted = {conv: expected.get("-" if conv is None else f"={conv}", none) for conv, *_ in rows}
    assert none in wanted.values()
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    assert {r.conv_id: tuple(r)[1:] for r in found.select("conv_id", *COUNTS, "repaired_sha256").collect()} == wanted
    assert found.count() == len(wanted)


# Mixing


def brute_targets(sizes, weights, most=3):
    """The excess reshared, step by step, as exact fractions."""
    from fractions import Fraction

    total = sum(sizes.values())
    target = {s: Fraction(total * weights[s], sum(weights.values())) for s in sizes}
    while over := [s for s in sizes if target[s] > most * sizes[s]]:
        excess = sum(target[s] - most * sizes[s] for s in over)
        for s in over:
            target[s] = Fraction(most * sizes[s])
        open_ = [s for s in sizes if target[s] < most * sizes[s]]
        for s in open_:
            target[s] += excess * Fraction(weights[s], sum(weights[o] for o in open_))
    return {s: float(t) for s, t in target.items()}


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mixing(docs):
    found = mixing_sources.mix(docs, mixing_sources.repeating_weights(docs))
    assert found.columns[: len(docs.columns)] == docs.columns
    assert as_multiset(found, *docs.columns) == as_multiset(docs, *docs.columns)
    sizes, longest = Counter(), Counter()
    for _, text, _, source, _ in ROWS:
        sizes[source] += size_of(text)
        longest[source] = max(longest[source], size_of(text))
    weights = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    targets = brute_targets(sizes, weights)
    taken = Counter()
    for r in found.collect():
        assert r[OWN + "size"] == size_of(r.text) and r[OWN + "source_size"] == sizes[r.source]
        assert r[OWN + "target"] == pytest.approx(targets[r.source], rel=1e-12)
        rate = targets[r.source] / sizes[r.source]
        assert math.floor(rate) <= r[OWN + "copies"] <= min(3, math.ceil(rate - 1e-9))
        taken[r.source] += r[OWN + "copies"] * r[OWN + "size"]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= longest[s] + 1e-6
    again = mixing_sources.mix(docs.repartition(5), mixing_sources.repeating_weights(docs))
    own = ("doc_id", "source", *[OWN + c for c in ("size", "target", "copies")])
    assert as_multiset(again, *own) == as_multiset(found, *own)


def test_targets_stop_at_the_limit(spark):
    for _ in range(8):
        sizes = {f"s{k:02d}": RNG.choice([0, 1, 5, 40, 300, 9000]) for k in range(RNG.randint(1, 14))}
        weights = {s: RNG.randint(1, 3) for s in sizes}
        rows = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, size long, weight long")
        found = {r.source: r.target for r in mixing_sources.source_targets(rows).collect()}
        expected = brute_targets(sizes, weights)
        assert found == pytest.approx(expected, rel=1e-12, abs=1e-9)
        assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_share_beyond_all_limits(spark):
    rows = spark.createDataFrame([("a", 10, 1), ("b", 20, 2), ("c", 30, None), ("d", 5, -1)], "source string, size long, weight long")
    found = {r.source: r.target for r in mixing_sources.source_targets(rows, share=50.0).collect()}
    assert found == {"a": 30.0, "b": 60.0, "c": 0.0, "d": 0.0}


def test_mixing_of_an_empty_table_and_unknown_sources(docs, spark):
    none = docs.filter("false")
    assert mixing_sources.mix(none, mixing_sources.repeating_weights(none)).count() == 0
    only = spark.createDataFrame([("s1", 1)], "source string, weight int")
    found = mixing_sources.mix(docs, only)
    assert found.count() == docs.count()
    assert found.filter((F.col("source") != "s1") & (F.col(OWN + "copies") > 0)).count() == 0


def test_places_in_a_hot_group(spark):
    rows = spark.range(5000).select((F.col("id") % 10 < 9).cast("int").alias("g"), (F.col("id") * 7 % 5000).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 3), (None, 1)], "g int, v long"))
    placed = mixing_sources.numbered(rows, ["g"], [F.col("v").asc()])
    by = defaultdict(list)
    for r in placed.collect():
        by[r.g].append((r[OWN + "place"], r.v))
    for own in by.values():
        own.sort()
        assert [p for p, _ in own] == list(range(1, len(own) + 1))
        assert [v for _, v in own] == sorted(v for _, v in own)
