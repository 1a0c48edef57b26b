"""Repair of conversation structure by weighted interval parsing.

The grammar has a nonterminal [p, q] for each pair of role initials: "what stands between an output that ends in p
and one that ends in q". In Chomsky normal form its rules are [p, q] -> [p, r] [r, q], and [p, q] -> a row under one
of its edits. A cell holds, for one span of rows, the cheapest (cost, audit) of each nonterminal; insertions cost
alike anywhere, so every cell is closed under them. Cells are filled bottom-up by span length: 1, 2, 4, 8 and so on.
Other spans need no cell: since [p, r] is there for every r, all splits of a span give the same cell, so one
split is enough, and work grows with the length and not with its cube.

Comparing audits as texts is sound: of two edits of the same rows that cost the same, neither audit begins with
the other, since what would be left are insertions, which cost something.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lumberline.llm.common import OWN, Stored, shuffle_partitions

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
BLANKS = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"

#: Initials that may follow an output: nothing yet, or one that ends in the initial. These are the language (s?(ua)+)?.
NOTHING = ""
FOLLOWS = {NOTHING: "su", "s": "u", "u": "a", "a": "u"}
ENDS = (NOTHING, "a")

#: Rows and characters of one span; longer conversations are several spans.
SPAN_ROWS = 512
SPAN_CHARS = 1 << 20

Cell = dict[str, dict[str, tuple[int, str]]]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans together."""
    out: Cell = {}
    for p, ways in left.items():
        best: dict[str, tuple[int, str]] = {}
        for r, (cost, audit) in ways.items():
            for q, (more, rest) in right[r].items():
                found = (cost + more, audit + rest)
                if q not in best or found < best[q]:
                    best[q] = found
        out[p] = best
    return out


def _least(cells: Iterable[Cell]) -> Cell:
    out: Cell = {p: {} for p in FOLLOWS}
    for cell in cells:
        for p, ways in cell.items():
            for q, found in ways.items():
                if q not in out[p] or found < out[p][q]:
                    out[p][q] = found
    return out


def _inserted() -> Cell:
    """The cell of no rows: nothing, or inserted turns. A system turn is never inserted."""
    nothing: Cell = {p: {p: (0, "")} for p in FOLLOWS}
    step: Cell = {p: {q: (INSERT_COST, INSERT) for q in after if q != "s"} for p, after in FOLLOWS.items()}
    closed = _least([nothing, step])
    while (longer := _least([closed, joined(closed, closed)])) != closed:
        closed = longer
    return closed


_NO_ROWS = _inserted()
_KINDS: dict[tuple[bool, bool, str], Cell] = {}


def row_cell(must_go: bool, truncated: bool, initial: str) -> Cell:
    """The cell of one row, closed under insertions before and after it."""
    kind = (must_go, truncated and not must_go, initial if initial in FOLLOWS and not must_go else NOTHING)
    if kind not in _KINDS:
        deleted: Cell = {p: {p: (DELETE_COST, DELETE)} for p in FOLLOWS}
        kept: Cell = {p: {} for p in FOLLOWS}
        penalty = TRUNCATED_COST if kind[1] else 0
        for p, after in FOLLOWS.items() if not must_go else ():
            for q in after:
                if q != "s":
                    kept[p][q] = (REROLE_COST + penalty, REROLE)
                if q == kind[2]:
                    kept[p][q] = (penalty, KEEP)
        _KINDS[kind] = joined(joined(_NO_ROWS, _least([deleted, kept])), _NO_ROWS)
    return _KINDS[kind]


def parse(cells: list[Cell]) -> tuple[int, str, list[tuple[str, str]]]:
    """The cheapest cost and audit of neighbouring spans, and between which initials each of them lies."""
    levels = [cells]
    while len(levels[-1]) > 1:
        below = levels[-1]
        pairs = [joined(below[k], below[k + 1]) for k in range(0, len(below) - 1, 2)]
        levels.append(pairs + below[2 * len(pairs):])
    whole = levels[-1][0] if cells else _NO_ROWS
    (cost, audit), end = min((whole[NOTHING][q], q) for q in ENDS if q in whole[NOTHING])
    ends = [(NOTHING, end)]
    for below in reversed(levels[:-1]):
        split = []
        for k, (p, q) in enumerate(ends):
            if 2 * k + 1 < len(below):
                left, right = below[2 * k], below[2 * k + 1]
                _, r = min(
                    ((way[0] + right[r][q][0], way[1] + right[r][q][1]), r)
                    for r, way in left[p].items() if q in right[r])
                split += [(p, r), (r, q)]
            else:
                split.append((p, q))
        ends = split
    return cost, audit, ends if cells else []


def merged(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans together."""
    while len(cells) > 1:
        pairs = [joined(cells[k], cells[k + 1]) for k in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[2 * len(pairs):]
    return cells[0]


# Rows of a span: turn, role, text, n (how many such rows stand side by side), blank, truncated.


def _judged(turns: list[dict], seen: Iterable[int] = ()) -> list[tuple[bool, bool]]:
    """For each row of a span whether it was seen before, and whether it is truncated; blank rows are neither.

    ``seen`` are the rows that an earlier span of the conversation has.
    """
    met, earlier, out = set(), set(seen), []
    for k, t in enumerate(turns):
        same = (t["role"], t["text"])
        again = not t["blank"] and (k in earlier or same in met)
        met.add(same)
        out.append((again, t["truncated"] and not t["blank"] and not again))
    return out


def _cells(turns: list[dict], judged: list[tuple[bool, bool]]) -> list[Cell]:
    """A cell for each row; of rows that repeat side by side all but the first must go."""
    out = []
    for t, (again, truncated) in zip(turns, judged):
        cell = row_cell(t["blank"] or again, truncated, t["role"][:1])
        n = t["n"] - 1
        power = row_cell(True, False, NOTHING)
        while n:
            if n & 1:
                cell = joined(cell, power)
            power, n = joined(power, power), n >> 1
        out.append(cell)
    return out


def _counts(turns: list[dict], judged: list[tuple[bool, bool]]) -> dict[str, int]:
    """What is counted in one span; pairs across a span's end are added by :func:`_across`."""
    initials = [t["role"][:1] for t in turns]
    own = [t["turn"] for t in turns if t["turn"] is not None]
    repeats = sum((t["n"] - 1) for t in turns)
    return {
        "blank": sum(t["n"] for t in turns if t["blank"]),
        "duplicate": sum((t["n"] - 1) + again for t, (again, _) in zip(turns, judged) if not t["blank"]),
        "truncated": sum(cut for _, cut in judged),
        # A row beside its copy: no initial may follow itself.
        "illegal": repeats + sum(_illegal(a, b) for a, b in zip(initials, initials[1:])),
        "distinct_turns": len(set(own)), "first_turn": own[0] if own else None, "last_turn": own[-1] if own else None,
        "first_initial": initials[0], "last_initial": initials[-1],
    }


def _illegal(before: str, after: str) -> bool:
    return not before or not after or after not in FOLLOWS.get(before, "")


def _across(spans: list[dict]) -> dict[str, int]:
    """The counts of a whole conversation from those of its spans, in order."""
    out = {c: sum(s[c] for s in spans) for c in ("blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum(_illegal(a["last_initial"], b["first_initial"]) for a, b in zip(spans, spans[1:]))
    timed = [s for s in spans if s["first_turn"] is not None]
    distinct = sum(s["distinct_turns"] for s in timed) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(timed, timed[1:]))
    out["gaps"] = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - distinct if timed else 0
    return out


def repaired(turns: list[dict], audit: str, before: str) -> list[dict]:
    """The turns that ``audit`` makes of a span's rows, after an output that ends in ``before``."""
    out, rows = [], (t for t in turns for _ in range(t["n"]))
    for edit in audit:
        t = None if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        given = ASSISTANT if before == "u" else USER
        role = t["role"] if edit == KEEP else given
        out.append({"edit": edit, "turn": t and t["turn"], "role": role, "text": t["text"] if t else ""})
        before = role[:1]
    return out


def _is_blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS)) == ""


def _is_truncated(text: Column) -> Column:
    ended = F.rtrim(text, F.lit(BLANKS))
    return ~F.right(ended, F.lit(1)).isin(*SENTENCE_ENDS)


_TURNS = "array<struct<turn: bigint, role: string, text: string, n: bigint, blank: boolean, truncated: boolean>>"
_REPAIRED = "array<struct<edit: string, turn: bigint, role: string, text: string>>"
_COUNTED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_CELL = "array<struct<p: string, q: string, cost: bigint, audit: string>>"
_SPAN_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct_turns", "first_turn", "last_turn")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are alike become one with their number, so that copies fold before they are dealt out."""
    for batch in batches:
        names = batch.schema.names
        table = pa.Table.from_batches([batch]).group_by(names[:-1]).aggregate([("n", "sum")])
        yield from table.rename_columns(names).to_batches()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Spans of rows that come in order; ``alone`` if the span is surely a whole conversation."""
    key, turns, chars, number, first, cut = None, [], 0, 0, True, False
    for batch in batches:
        for row in batch.to_pylist():
            name = row.pop("key")
            if turns and (name != key or chars >= SPAN_CHARS or len(turns) >= SPAN_ROWS):
                # The first and the last conversation of a task may go on in another.
                goes_on = name == key
                yield {"key": key, "no": number, "alone": not first and not cut and not goes_on, "turns": turns}
                first, cut, turns, chars, number = first and goes_on, goes_on, [], 0, number + 1
            key = name
            last = turns[-1] if turns else None
            if last and all(last[c] == row[c] for c in ("turn", "role", "text")):
                last["n"] += row["n"]
                continue
            turns.append(row)
            chars += len(row["text"])
    if turns:
        yield {"key": key, "no": number, "alone": False, "turns": turns}


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(t["text"] or "") + 64 for t in row.get("turns") or ()) + len(row.get("audit") or "")
        if size >= SPAN_CHARS or len(held) >= 1000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(schema: str) -> pa.Schema:
    """The Arrow schema of a Spark one with the types used here."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


@dataclass
class Repaired:
    """``conversations``: ``key, gaps, blank, duplicate, truncated, illegal, cost, audit``, a row each.

    ``pieces``: ``key, part, no, whole, turns``, the repaired turns (``edit, turn, role, text``) of each conversation in
    pieces, in the order of ``part`` and ``no``; ``whole`` where one piece is all of it.
    """

    conversations: DataFrame
    pieces: DataFrame

    def turns(self) -> DataFrame:
        """``key, place, edit, turn, role, text``: a row per repaired turn, ``place`` by ``part``, ``no`` and number."""
        rows = self.pieces.select("key", "part", "no", F.posexplode("turns").alias("number", "t"))
        return rows.select("key", F.struct("part", "no", "number").alias("place"), "t.*")

    def digests(self) -> DataFrame:
        """``key, sha256`` of each conversation's ``role:text``, joined by line feeds.

        A conversation of many pieces is read in order and never held as a whole.
        """
        line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
        text = self.pieces.select("key", "part", "no", "whole", F.size("turns").alias("n"), F.array_join(line, "\n").alias("text"))
        whole = text.filter("whole").select("key", F.sha2("text", 256).alias("sha256"))

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def found() -> Iterator[dict]:
                key, state, some = None, None, False
                for batch in batches:
                    for row in batch.to_pylist():
                        if row["key"] != key or state is None:
                            if state is not None:
                                yield {"key": key, "sha256": state.hexdigest()}
                            key, state, some = row["key"], hashlib.sha256(), False
                        if row["n"]:
                            state.update((("\n" if some else "") + row["text"]).encode())
                            some = True
                if state is not None:
                    yield {"key": key, "sha256": state.hexdigest()}

            yield from _batched(found(), schema)

        schema = _arrow("key string, sha256 string")
        parted = text.filter("NOT whole").select("key", "part", "no", "n", "text").repartition("key")
        parted = parted.sortWithinPartitions("key", "part", "no")
        return whole.unionByName(parted.mapInArrow(digest, "key string, sha256 string"))


def key_of(conv: Column) -> Column:
    """A conversation's id as text, null ids being one conversation."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def repair_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """The cheapest repair of each conversation to an optional system turn and pairs of user and assistant turns.

    A conversation's rows go by turn (nulls first), then role and text. A row is blank without a character other than
    white space, else a duplicate if the conversation has its role and text before, else truncated if its last such
    character ends no sentence. Keeping costs 0, giving the role of user or assistant 1, deleting 2 (which
    blank and duplicate rows must be), inserting an empty turn 5, and 5 each truncated row that stays. Of
    cheapest edits the one whose initials come first in ASCII is taken.

    Conversations are keyed by :func:`key_of`; null ids are one conversation. A null role or text is one space, so
    a null text is blank and a null role never legal. Other columns are not read. An empty table gives empty results.

    Rows are dealt out by ranges of (conversation, turn, role, text), so that a conversation of a third of all
    rows is cut over a third of the tasks, and copies of a row fold beforehand. Most conversations lie whole in
    a task. The others are parsed span by span, and their cells, without texts, are put together by conversation.
    A conversation's audit is one value of the result, so it must fit into one row; its texts need not.
    """
    spark = rows.sparkSession
    text = F.coalesce(rows[text_col].cast("string"), F.lit(" "))
    own = rows.select(
        key_of(rows[conv_col]).alias("key"), rows[turn_col].cast("long").alias("turn"),
        F.coalesce(rows[role_col].cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.lit(1).cast("long").alias("n"))
    order = [F.col("key").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    dealt = own.mapInArrow(_folded, own.schema).repartitionByRange(shuffle_partitions(spark), *order)
    ordered = dealt.sortWithinPartitions(*order).withColumns({"blank": _is_blank(F.col("text")), "truncated": _is_truncated(F.col("text"))})
    span_schema = f"key string, part int, no long, alone boolean, turns {_TURNS}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _batched(({"part": part, **span} for span in _cut(batches)), arrow_spans)

    arrow_spans = _arrow(span_schema)
    spans = Stored(ordered.mapInArrow(cut, span_schema), "conversation-spans").rows

    counted = ", ".join(f"{c} long" for c in _COUNTED)
    alone_schema = f"key string, part int, no long, {counted}, audit string, turns {_REPAIRED}"
    arrow_alone = _arrow(alone_schema)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for batch in batches:
                for span in batch.to_pylist():
                    turns = span["turns"]
                    judged = _judged(turns)
                    cost, audit, _ = parse(_cells(turns, judged))
                    yield {
                        "key": span["key"], "part": span["part"], "no": span["no"], "cost": cost, "audit": audit,
                        "turns": repaired(turns, audit, NOTHING), **_across([_counts(turns, judged)])}

        yield from _batched(found(), arrow_alone)

    done = Stored(spans.filter("alone").select("key", "part", "no", "turns").mapInArrow(alone, alone_schema), "conversations-alone").rows

    # What spans of one conversation know of each other: the rows that an earlier one has.
    rest = spans.filter("NOT alone").select("key", "part", "no", "turns")
    same = F.md5(F.concat(F.col("t.role"), F.lit("\0"), F.col("t.text")))
    slim = rest.select("key", "part", "no", F.posexplode("turns").alias("number", "t")).select(
        "key", "part", "no", "number", same.alias("same"))
    firsts = slim.groupBy("key", "same").agg(F.min(F.struct("part", "no")).alias("first"))
    again = slim.join(firsts, ["key", "same"]).filter(F.struct("part", "no") > F.col("first"))
    again = again.groupBy("key", "part", "no").agg(F.collect_list("number").alias("seen"))
    joint = Stored(rest.join(again, ["key", "part", "no"], "left").withColumn(
        "seen", F.coalesce("seen", F.array().cast("array<int>"))), "conversations-cut").rows

    counts = ", ".join(f"{c} long" for c in _SPAN_COUNTS)
    cell_schema = f"key string, part int, no long, {counts}, first_initial string, last_initial string, cell {_CELL}"
    arrow_cells = _arrow(cell_schema)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for batch in batches:
                for span in batch.to_pylist():
                    judged = _judged(span["turns"], span["seen"])
                    cell = merged(_cells(span["turns"], judged))
                    flat = [{"p": p, "q": q, "cost": c, "audit": a} for p, ways in cell.items() for q, (c, a) in ways.items()]
                    yield {"key": span["key"], "part": span["part"], "no": span["no"], "cell": flat, **_counts(span["turns"], judged)}

        yield from _batched(found(), arrow_cells)

    parsed_schema = f"key string, part int, no long, before string, segment string, first boolean, {counted}, audit string, alone boolean"
    arrow_parsed = _arrow(parsed_schema)

    def together(table: pa.Table) -> pa.Table:
        members = sorted(table.to_pylist(), key=lambda s: (s["part"], s["no"]))
        own_cells: list[Cell] = []
        for s in members:
            cell: Cell = {p: {} for p in FOLLOWS}
            for way in s["cell"]:
                cell[way["p"]][way["q"]] = (way["cost"], way["audit"])
            own_cells.append(cell)
        cost, audit, ends = parse(own_cells)
        total = _across(members)
        out = []
        for k, (s, cell, (p, q)) in enumerate(zip(members, own_cells, ends)):
            whole = {**total, "cost": cost, "audit": audit} if k == 0 else {}
            out.append({
                "key": s["key"], "part": s["part"], "no": s["no"], "before": p, "segment": cell[p][q][1], "first": k == 0,
                "alone": len(members) == 1, **whole})
        return pa.Table.from_pylist(out, arrow_parsed)

    parsed = Stored(joint.mapInArrow(cells, cell_schema).groupBy("key").applyInArrow(together, parsed_schema), "conversations-parsed").rows

    piece_schema = f"key string, part int, no long, whole boolean, turns {_REPAIRED}"
    arrow_pieces = _arrow(piece_schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for batch in batches:
                for span in batch.to_pylist():
                    turns = repaired(span.pop("turns"), span.pop("segment"), span.pop("before"))
                    yield {**span, "whole": span.pop("alone"), "turns": turns}

        yield from _batched(found(), arrow_pieces)

    segments = parsed.select("key", "part", "no", "before", "segment", "alone")
    pieces = joint.drop("seen").join(segments, ["key", "part", "no"]).mapInArrow(render, piece_schema)
    summary = ["key", *_COUNTED, "audit"]
    return Repaired(
        done.select(*summary).unionByName(parsed.filter("first").select(*summary)),
        done.select("key", "part", "no", F.lit(True).alias("whole"), "turns").unionByName(pieces),
    )


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by crc32 of ``conv_id:turn``; nulls are one space.

    Of twenty remainders, 0 drops the row, 1 empties its text, 2 removes its ends of sentences, 3 repeats
    it, and 4 makes it the user's.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    made = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias(OWN + "fault"))
    made = made.filter(F.col(OWN + "fault") != 0)
    text = F.when(F.col(OWN + "fault") == 1, "").when(
        F.col(OWN + "fault") == 2, F.translate("text", SENTENCE_ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col(OWN + "fault") == 4, USER).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col(OWN + "fault") == 3, 2).otherwise(1))
    return made.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias(OWN + "copy")).drop(OWN + "copy")
