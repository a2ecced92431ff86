"""Scalar functions: label derivation, key normalisation, lenient casts, NULL tokens, headers."""

from __future__ import annotations

import pytest

from conform.functions.scalars import (
    clean_header,
    key_normalise,
    lenient_number,
    lenient_ts,
    lookup_key,
    null_tokens,
    wide_to_label,
)
from conform.spec import UTILITY1_LABELS

LABEL_COLS = ["SolarPV", "EnergyStorageSystem", "Wind", "Other"]


def _label(spark, rows, with_flag=True):
    df = spark.createDataFrame(rows, "Hybrid string, SolarPV string, EnergyStorageSystem string, Wind string, Other string")
    cols = [(c, lbl) for c, lbl in UTILITY1_LABELS if c in LABEL_COLS]
    return [r[0] for r in df.select(wide_to_label(cols, "Hybrid" if with_flag else None)).collect()]


@pytest.mark.parametrize("row,expected", [
    (("N", "0", "0", "8.25", "0"), "Wind"),             # one type
    (("Y", "0", "0", "0", "3"), "Hybrid"),              # flag
    (("N", "1", "2", "0", "4"), "Hybrid"),              # several
    (("N", "0.0", "0", None, "0"), "Unknown"),          # none
    (("N", "n/a", "6", "", "-"), "Energy Storage"),     # garbage text and empty
    (("y", "10", "0", "0", "0"), "Hybrid"),             # lower-case flag
    ((None, "0", "0", "0", "7"), "Other"),              # NULL flag
    (("N", "-5", "0", "0", "0"), "Unknown"),            # negative does not count
    (("N", "NaN", "0", "0", "0"), "Solar"),             # NaN > 0 holds in Spark
    (("N", "0", "1e2", "0", "0"), "Energy Storage"),    # exponent spelling
])
def test_wide_to_label(spark, row, expected):
    assert _label(spark, [row]) == [expected]


def test_wide_to_label_absent_columns(spark):
    df = spark.createDataFrame([("5",)], "Wind string")
    assert df.select(wide_to_label([("SolarPV", "Solar")] * 0 + [("Wind", "Wind")])).first()[0] == "Wind"
    assert df.select(wide_to_label([])).first()[0] == "Unknown"


@pytest.mark.parametrize("text,expected", [
    ("1105354.0", "1105354"), ("1105354", "1105354"), ("1.105354E6", "1105354"), (" 42 ", "42"),
    ("007", "7"), ("36_13_81756", None), ("", None), (None, None), ("UNRESOLVED_ID", None),
])
def test_key_normalise(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(key_normalise("x")).first()[0] == expected


def test_key_normalise_numeric_input(spark):
    df = spark.createDataFrame([(1105354.0,)], "x double")
    assert df.select(key_normalise("x")).first()[0] == "1105354"


def test_lookup_key_keeps_text_ids(spark):
    df = spark.createDataFrame([("7.0",), ("P12",), (None,)], "x string")
    assert [r[0] for r in df.select(lookup_key("x")).collect()] == ["7", "P12", None]


@pytest.mark.parametrize("text,expected", [
    ("7.6", 7.6), ("6", 6.0), ("NULL", None), ("n/a", None), ("", None), ("-5", -5.0), ("1.0E-4", 1e-4),
])
def test_lenient_number(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(lenient_number("x")).first()[0] == expected


def test_lenient_number_special_values(spark):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("-inf",)], "x string")
    vals = [r[0] for r in df.select(lenient_number("x")).collect()]
    assert vals[0] != vals[0] and vals[1] == float("inf") and vals[2] == float("-inf")


def test_lenient_ts(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([("2022/10/01 00:00:00+00",), ("na",), ("2022/13/01 00:00:00+00",)], "x string")
    out = [r[0] for r in df.select(lenient_ts("x", "yyyy/MM/dd HH:mm:ssx").cast("timestamp_ntz")).collect()]
    assert str(out[0]) == "2022-10-01 00:00:00" and out[1] is None and out[2] is None
    df2 = spark.createDataFrame([("2022-10-15 00:00:00+00:00",), ("garbage",)], "x string")
    out2 = [r[0] for r in df2.select(lenient_ts("x").cast("timestamp_ntz")).collect()]
    assert str(out2[0]) == "2022-10-15 00:00:00" and out2[1] is None


def test_null_tokens(spark):
    df = spark.createDataFrame([("null",), (" NULL ",), ("x",), ("",)], "x string")
    got = [r[0] for r in df.select(null_tokens("x", ("", "null", "NULL"))).collect()]
    assert got == [None, None, "x", None]
    got_ref = [r[0] for r in df.select(null_tokens("x", ("",))).collect()]
    assert got_ref == ["null", " NULL ", "x", None]


def test_clean_header():
    assert clean_header("\ufeffDER_ID ") == "DER_ID"
    assert clean_header("  a b ") == "a b"


def test_wide_to_label_stays_in_codegen(spark):
    df = spark.createDataFrame([("N", "1", "0", "0", "0")],
                               "Hybrid string, SolarPV string, EnergyStorageSystem string, Wind string, Other string")
    plan = df.select(wide_to_label([(c, c) for c in LABEL_COLS], "Hybrid").alias("t"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "lambdafunction" not in plan


from hypothesis import given, settings, strategies as st


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(min_value=-10**15, max_value=10**15), st.sampled_from(["int", "dot", "exp", "pad"])),
                min_size=1, max_size=20))
def test_key_normalise_spellings(spark, values):
    """Every spelling of an integer id normalises to its plain decimal text."""
    def spell(n, how):
        return {"int": str(n), "dot": f"{n}.0", "exp": f"{n}E0", "pad": f" {n} "}[how]
    df = spark.createDataFrame([(spell(n, h),) for n, h in values], "x string")
    assert [r[0] for r in df.select(key_normalise("x")).collect()] == [str(n) for n, _ in values]
