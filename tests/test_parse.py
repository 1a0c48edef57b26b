from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import lumberline as ll
from bench import GRAMMAR
from lumberline.sources.raw import read_raw_logs

TS = "2024-01-02 03:04:05"

NO_MATCH = (None, None, None, None)


def lines_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def expected(text):
    match = GRAMMAR.match(text)
    return match.groups() if match else NO_MATCH


def parsed(df):
    return [tuple(row) for row in df.collect()]


CASES = {
    ", INFO: hi": ("INFO", "hi", None),
    ", ERROR: a, (A), (B)": ("ERROR", "a, (A)", "B"),
    ", ERROR: ": ("ERROR", "", None),
    ", ERROR: , (E1)": ("ERROR", "", "E1"),
    ", ERROR: x, (E-1)": ("ERROR", "x, (E-1)", None),
    ", ERROR: x, (E1) ": ("ERROR", "x, (E1) ", None),
    ", Debug: x": ("Debug", "x", None),
    ", ERROR: x, ()": ("ERROR", "x, ()", None),
    ", ERROR: a: b: c, (E_1)": ("ERROR", "a: b: c", "E_1"),
    ", ERROR: x\u2028y, (E1)": ("ERROR", "x\u2028y", "E1"),
    ", ERROR: x\u0085y\u2028": ("ERROR", "x\u0085y\u2028", None),
    ", ERROR: x\ry, (E1)": ("ERROR", "x\ry", "E1"),
    ", \u00c4rger: gr\u00fc\u00dfe \U0001f600, (\u00e91)": (
        "\u00c4rger", "gr\u00fc\u00dfe \U0001f600", "\u00e91",
    ),
    ", INFO: tail\n": ("INFO", "tail", None),
    ", INFO: tail, (E1)\n": ("INFO", "tail", "E1"),
    ", INFO: \n": ("INFO", "", None),
}
DROPPED = [
    "",
    f" {TS}, INFO: leading blank",
    f"{TS}, INFO no colon",
    f"{TS}, INFO:no blank",
    f"{TS} INFO: no comma",
    f"{TS}, : no level",
    f"{TS}, two words: x",
    "2024-1-02 03:04:05, INFO: short month",
    f"x{TS}, INFO: x",
    f"{TS}, INFO: two\nlines",
    f"{TS}, INFO: two ends\n\n",
    "plain text",
]


def test_grammar_table(spark):
    texts = [TS + tail for tail in CASES]
    got = parsed(ll.parse_log_lines(lines_of(spark, texts)))
    assert got == [(TS, *fields) for fields in CASES.values()]
    assert got == [expected(t) for t in texts]


def test_other_digits_are_digits(spark):
    text = "\u0662\u0660\u0662\u0664-01-02 03:04:05, INFO: x"
    assert parsed(ll.parse_logs(lines_of(spark, [text]))) == [expected(text)]


def test_bad_lines_stay_as_nulls_until_dropped(spark):
    lines = lines_of(spark, [*DROPPED, f"{TS}, INFO: kept"])
    every = ll.parse_log_lines(lines)
    assert parsed(every) == [NO_MATCH] * len(DROPPED) + [(TS, "INFO", "kept", None)]
    assert parsed(ll.drop_unparsed(every)) == [(TS, "INFO", "kept", None)]
    assert parsed(ll.parse_logs(lines)) == [(TS, "INFO", "kept", None)]


def test_null_line(spark):
    lines = spark.createDataFrame([(None,)], "value string")
    assert parsed(ll.parse_log_lines(lines)) == [NO_MATCH]
    assert ll.parse_logs(lines).count() == 0


def test_schema(spark):
    for df in (ll.parse_log_lines(lines_of(spark, [""])), ll.parse_logs(lines_of(spark, [""]))):
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in ll.LOG_SCHEMA
        ]


pieces = st.one_of(
    st.sampled_from([
        TS, ", ", ": ", ", (", ")", "E1", "INFO", "(", ",", ":", " ", "\n", "\r", "\u2028", "\u0085",
        "\u00e9", "\u4e2d", "\u0661", "_", "-", "\U0001f600", "\x00", "9999-99-99 99:99:99",
    ]),
    st.text(alphabet="abAB01_-., :()\u00df\u3042", max_size=4),
)
any_line = st.lists(pieces, max_size=10).map("".join)
log_like = st.tuples(st.sampled_from([TS, "0000-00-00 00:00:00"]), any_line, any_line).map(
    lambda t: f"{t[0]}, INFO: {t[1]}, (E{t[2]})"
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(any_line, log_like), min_size=50, max_size=200))
def test_same_as_the_grammar_on_any_line(spark, texts):
    lines = lines_of(spark, texts)
    groups = [expected(t) for t in texts]
    assert parsed(ll.parse_log_lines(lines)) == groups
    assert parsed(ll.parse_logs(lines)) == [g for g in groups if g != NO_MATCH]


no_breaks = st.text(
    alphabet=st.characters(blacklist_characters="\n", blacklist_categories=("Cs", "Cn", "Co")),
    max_size=20,
)
word = st.text(alphabet="ABCabc012_", min_size=1, max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(word, no_breaks, st.none() | word), min_size=20, max_size=100))
def test_parse_undoes_render(spark, rows):
    rows = [
        (TS, level, message, log_id)
        for level, message, log_id in rows
        if log_id is not None or not re.search(r", \(\w+\)$", message)
    ]
    logs = spark.createDataFrame(rows, ll.LOG_SCHEMA)
    assert parsed(ll.parse_logs(ll.render_log_lines(logs))) == rows


def test_broken_bytes_become_replacement_characters(spark, tmp_path):
    file = tmp_path / "raw.log"
    file.write_bytes(
        f"{TS}, ERROR: a".encode() + b"\xf0, (E1)\n" + f"{TS}, INFO: ".encode() + b"\xff\xfe b\n"
    )
    got = parsed(ll.parse_logs(read_raw_logs(spark, str(tmp_path))))
    assert got == [(TS, "ERROR", "a\ufffd", "E1"), (TS, "INFO", "\ufffd\ufffd b", None)]


def test_broken_bytes_next_to_separators(spark):
    start = f"{TS}, INFO: ".encode()
    lines = spark.createDataFrame(
        [
            (bytearray(b),)
            for b in (
                start + b"a\xf0\n",
                start + b"\xf0, (E1)\n",
                start + b"\xe2\x82, (E2)",
                start + b"x\xf0\ny",
                start + b"x, (E\xff)",
                f"{TS}, IN".encode() + b"\xf0FO: x",
                b"\xf0" + start + b"x",
            )
        ],
        "value binary",
    ).selectExpr("CAST(value AS string) AS value")
    assert parsed(ll.parse_logs(lines)) == [
        (TS, "INFO", "a\ufffd", None),
        (TS, "INFO", "\ufffd", "E1"),
        (TS, "INFO", "\ufffd", "E2"),
        (TS, "INFO", "x, (E\ufffd)", None),
    ]


def test_very_long_lines(spark):
    long = 500_000
    texts = [
        f"{TS}, INFO: " + "x" * long,
        f"{TS}, {'L' * long}: m, ({'i' * long})",
        f"{TS}, INFO: " + ", (a" * long + ", (E1)",
        f"{TS}, INFO: " + "\u00e9" * long + ", (E1)",
        "x" * long,
    ]
    lines = lines_of(spark, texts)
    assert parsed(ll.parse_logs(lines)) == [g for g in map(expected, texts) if g != NO_MATCH]


def test_no_row_leaves_the_jvm(spark):
    plan = ll.parse_logs(lines_of(spark, ["x"]).filter("value <> ''"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in text
    assert text.count("RLIKE") == 1 and text.count("regexp_extract") == 1


def test_to_json_rows_leaves_out_nulls(spark):
    logs = spark.createDataFrame(
        [(TS, "ERROR", 'say "hi"', "E1"), (TS, "INFO", "", None)], ll.LOG_SCHEMA
    )
    assert [r.json_data for r in ll.to_json_rows(logs).collect()] == [
        f'{{"timestamp":"{TS}","level":"ERROR","message":"say \\"hi\\"","id":"E1"}}',
        f'{{"timestamp":"{TS}","level":"INFO","message":""}}',
    ]


@pytest.mark.parametrize("text", ["9999-99-99 99:99:99", "2023-02-29 00:00:00", "2024-01-01 24:00:00"])
def test_impossible_time_is_null(spark, text):
    logs = spark.createDataFrame([(text, "ERROR", "x", None)], ll.LOG_SCHEMA)
    row = ll.with_event_time(logs).first()
    assert (row.timestamp, row.event_ts, row.day) == (text, None, None)
