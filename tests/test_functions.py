"""Parsers, truthiness, seasons and small game expressions."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from boxlake.functions import games as G
from boxlake.functions import parsing as P
from boxlake.functions.seasons import ANY_YEARS, LEAGUE_YEARS, is_season_text, season_of_date


def _apply(spark, values, parser):
    rows = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(values)], "i int, payload string")
    value = P.get(P.parse_document(F.col("payload")), "$.v")
    return [r.out for r in rows.select("i", parser(value).alias("out")).orderBy("i").collect()]


INTS = [
    (17, 17), ("17", 17), (17.9, 17), ("007", 7), (None, None), ("seven", None), ("", None), ("1.2.3", None), ("17.9", None),
    ([17], None), ({"n": 17}, None), (0, 0), ("0", 0), (0.0, 0), (-17, -17), ("-17", -17), (-17.9, -17), ("2e2", None),
    (True, 1), ("\t9\r", 9), (2e2, 200), (2**63, 2**63 - 1), (1e30, 2**63 - 1), (-1e30, -(2**63)), ("9" * 20, 2**63 - 1),
    ("-" + "9" * 20, -(2**63)), ("1e30", None),
]
FLOATS = [
    (0.25, 0.25), ("0.25", 0.25), (17, 17.0), ("17.875", 17.875), (None, None), ("seven", None), ("", None),
    ([0.25], None), (0, 0.0), (0.0, 0.0), ("0.0", 0.0), (-0.25, -0.25), ("-0.25", -0.25), ("2e2", 200.0),
]
BOOLS = [
    (True, True), (False, False), ("true", True), ("True", True), ("T", True), ("yes", True), ("y", True), ("1", True),
    ("false", False), ("False", False), ("F", False), ("no", False), ("n", False), ("0", False), (1, True), (17, True),
    (-3, True), (0.5, True), (0, False), (0.0, False), ("perhaps", None), (None, None), ("", None), ([False], None),
    ("\tyes", True), ("no \n", False),
]
TEXTS = [
    ("ball", "ball"), ("Two Words", "Two Words"), (17, "17"), (0.25, "0.25"), (None, None), ("", None),
    (" \t ", None), (" ball\n", "ball"), (True, "True"), (17.0, "17.0"),
]


@pytest.mark.parametrize(
    ("cases", "parser"),
    [(INTS, P.to_long), (FLOATS, P.to_double), (BOOLS, P.to_bool), (TEXTS, P.to_clean_text)],
    ids=["int", "float", "bool", "string"],
)
def test_parsers(spark, cases, parser):
    assert _apply(spark, [v for v, _ in cases], parser) == [e for _, e in cases]


def test_float_special_texts(spark):
    nan, inf = _apply(spark, ["nan", "inf"], P.to_double)
    assert math.isnan(nan) and math.isinf(inf)


def test_plain_text_columns(spark):
    rows = spark.createDataFrame([("42",), ("42.7",), ("x",), (None,)], "t string")
    found = rows.select(P.int_from_text(F.col("t")).alias("i"), P.double_from_text(F.col("t")).alias("d")).collect()
    assert [(r.i, r.d) for r in found] == [(42, 42.0), (None, 42.7), (None, None), (None, None)]


def test_truthy_agrees_with_python(spark):
    values = [0, 0.0, -0.0, "", "0", " ", False, True, [], [0], {}, {"a": 0}, None, 1, -1, 0.5, "word", 1e3, 10**25]
    assert _apply(spark, values, P.truthy) == [bool(v) for v in values]


ABSENT = object()


@pytest.mark.parametrize("zero_as_missing", [True, False])
def test_alias_choice_replay(spark, zero_as_missing):
    """Every pair of operands against a replay in Python."""
    operands = [ABSENT, None, 0, "0", "", False, [], {}, 7, "8", "word"]
    cases = [(a, b) for a in operands for b in operands]
    docs = [json.dumps({k: v for k, v in (("a", a), ("b", b)) if v is not ABSENT}) for a, b in cases]
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, payload string")
    fields = P.get_struct(P.parse_document(F.col("payload")), "$", ("a", "b"))
    found = rows.select("i", P.to_long(P.any_of(fields, ("a", "b"), zero_as_missing)).alias("out")).orderBy("i").collect()

    def as_int(v):
        try:
            return int(v)
        except (TypeError, ValueError):
            return None

    def expected(a, b):
        a, b = (None if x is ABSENT else x for x in (a, b))
        return as_int((a or b) if zero_as_missing else (b if a is None else a))

    assert [r.out for r in found] == [expected(a, b) for a, b in cases]


def test_nested_get(spark):
    doc = P.parse_document(F.lit('{"a": {"b": null, "c": 5}, "d": [1]}'))
    row = spark.range(1).select(
        P.get_or(doc, "$.a.b", F.lit("x")).alias("null_stays"),
        P.get_or(doc, "$.a.z", F.lit("x")).alias("absent"),
        P.get_or(doc, "$.d.z", F.lit("x")).alias("not_an_object"),
        P.get_or(doc, "$.a.c", F.lit("x")).alias("found"),
    ).first()
    assert tuple(row) == (None, "x", "x", "5")


def test_season_texts(spark):
    cases = [
        ("2024-25", True, True), ("2023-24", True, True), ("1999-00", True, True), ("2024-2025", False, False),
        ("24-25", False, False), ("2024-26", False, False), ("2024-24", False, False), ("", False, False),
        (None, False, False), ("1945-46", True, False), ("1946-47", True, True), ("2101-02", True, False),
        ("0999-00", False, False), ("2004-+5", True, True), ("2004--5", False, False), ("abcd-ef", False, False),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    found = rows.select(
        "i", is_season_text(F.col("s"), ANY_YEARS).alias("a"), is_season_text(F.col("s"), LEAGUE_YEARS).alias("b")
    ).orderBy("i").collect()
    assert [(r.a, r.b) for r in found] == [c[1:] for c in cases]


def test_season_of_date(spark):
    days = [dt.date(2025, 3, 1), dt.date(2025, 9, 30), dt.date(2025, 10, 1), dt.date(2000, 1, 1), dt.date(1999, 12, 31)]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    found = [r.s for r in rows.select(season_of_date(F.col("d")).alias("s")).collect()]
    assert found == ["2024-25", "2024-25", "2025-26", "1999-00", "1999-00"]
    assert rows.select(season_of_date(F.col("d"), "2019-20").alias("s")).distinct().collect()[0].s == "2019-20"
    assert rows.select(season_of_date(F.col("d"), "").alias("s")).first().s == "2024-25"


def test_game_expressions(spark):
    rows = spark.createDataFrame(
        [(1, 1, 2, "A", "B"), (2, 1, 2, None, "B"), (3, 1, 2, None, None), (1, 1, 1, "", "")],
        "t int, h int, a int, f string, l string",
    )
    t, h, a = F.col("t"), F.col("h"), F.col("a")
    found = rows.select(G.is_home(t, h, a), G.opponent(t, h, a), G.full_name(F.col("f"), F.col("l"))).collect()
    assert [tuple(r) for r in found] == [
        (True, 2, "A B"), (False, 1, "B"), (None, None, None), (True, 1, None),
    ]
    texts = spark.createDataFrame([("2024-11-15T19:00:00Z",), ("2024-13-01",), ("soon",), ("",)], "x string")
    assert [r.d for r in texts.select(G.iso_date(F.col("x")).alias("d")).collect()] == [dt.date(2024, 11, 15), None, None, None]
