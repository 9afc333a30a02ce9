"""Expressions on inline rows, the hazards of a naive port among them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from moneyflow.functions import numbers as N, text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("value", "want"), [("0", "AL"), ("00", "AL"), ("7", "07"), ("07", "07"), ("7.0", "07"), ("", ""), (None, ""), ("x", "X"), ("nan", ""), (" 12 ", "12")]
)
def test_house_district(spark, value, want):
    assert one(spark, value, T.house_district) == want


@pytest.mark.parametrize(
    ("state", "district", "want"),
    [("WY", "AL", True), ("WY", "01", False), ("CA", "52", True), ("CA", "53", False), ("CA", "AL", False), ("CA", "", False), ("QQ", "x", True), ("QQ", "", False)],
)
def test_valid_district(spark, state, district, want):
    df = spark.createDataFrame([(state, district)], "s string, d string")
    assert df.select(T.valid_house_district(F.col("s"), F.col("d"))).first()[0] is want


@pytest.mark.parametrize(
    ("value", "want"), [("04072024", dt.date(2024, 4, 7)), ("4072024", dt.date(2024, 4, 7)), ("13012024", None), ("", None), ("abc", None), (None, None), ("02302024", None)]
)
def test_parse_mdy(spark, value, want):
    assert one(spark, value, N.parse_mdy) == want


@pytest.mark.parametrize(("day", "want"), [("2024-04-07", "2024-04-07"), ("2024-04-08", "2024-04-14"), ("2024-04-13", "2024-04-14")])
def test_week_end(spark, day, want):
    assert str(one(spark, day, lambda c: N.week_end(F.to_date(c)))) == want


def test_money_never_fails(spark):
    assert [one(spark, v, N.money) for v in ("", "abc", "-3.5", None)] == [0.0, 0.0, -3.5, 0.0]


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(N.ratio(F.col("a"), F.col("b"))).first()[0] is None


def test_strip_takes_all_white_space(spark):
    assert one(spark, "\t Acme  Co\n ", T.key) == "ACME  CO"


@pytest.mark.parametrize(
    ("value", "norm", "core"), [("A & B, Inc.", "A AND B INC", "A AND B"), ("X Holdings LLC", "X HOLDINGS LLC", "X"), ("Inc", "INC", ""), ("Coco", "COCO", "COCO"), (None, "", "")]
)
def test_names(spark, value, norm, core):
    assert one(spark, value, T.normalize_name) == norm
    assert one(spark, value, lambda c: T.core_name(T.normalize_name(c))) == core


def test_three_party_schemes_differ(spark):
    df = spark.createDataFrame([(0.0, 0.0), (7.0, 3.0), (3.0, 7.0), (5.0, 5.0), (-1.0, -1.0)], "d double, r double")
    d, r = F.col("d"), F.col("r")
    rows = df.select(N.behavioural_party(d, r), N.donor_party(d, r), N.summary_party(d, r)).collect()
    assert [tuple(x) for x in rows[:4]] == [("Mixed", "Unknown", "Unknown"), ("D", "D", "D"), ("R", "R", "R"), ("Mixed", "Mixed", "Mixed")]
    assert rows[4][1] == "Unknown"


def test_lookahead_and_case(spark):
    assert one(spark, "Metabolic", lambda c: T.matches_any(c, ["META(?!BOL)"])) is False
    assert one(spark, "meta inc", lambda c: T.matches_any(c, ["META(?!BOL)"])) is True


def test_labels(spark):
    assert one(spark, 1234567.0, T.money_label, "double") == "$1,234,567"
    assert one(spark, None, T.pct_label, "double") == ""
    assert one(spark, "$1.5m", T.parsed_number) == 1.5e6
    assert one(spark, "a/b/c", lambda c: T.substring_count(c, "/")) == 2
    assert one(spark, None, N.present) is None and one(spark, "false", N.present) is True and one(spark, "", N.present) is False


def test_bins_are_right_closed(spark):
    assert [one(spark, v, lambda c: N.bins(c, [0.0, 10.0]), "double") for v in (0.0, 0.1, 10.0, 10.1, None)] == [0, 1, 1, 2, None]
