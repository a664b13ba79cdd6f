"""Strict CSV gate and field split agree with Python's strict csv reader (property test)."""

import csv

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlark.functions import contract
from pyspark.sql import functions as F


def python_split(line):
    try:
        rows = list(csv.reader([line], strict=True))
    except csv.Error:
        return None
    return rows[0] if rows else []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='a,"  b', max_size=9), min_size=300, max_size=300))
def test_strict_split_matches_python(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, raw_text string")
    got = {r["i"]: (r["ok"], r["v"]) for r in df.select(
        "i", contract.is_strict_csv(F.col("raw_text")).alias("ok"),
        F.when(contract.is_strict_csv(F.col("raw_text")), contract.split_fields(F.col("raw_text"))).alias("v")
    ).collect()}
    for i, line in enumerate(lines):
        expected = python_split(line)
        ok, values = got[i]
        assert ok == (expected is not None), repr(line)
        if expected is not None:
            assert list(values) == expected, repr(line)


def accepted(spark, lines, reason):
    """Per line, whether the production parser finds no ``reason``."""
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, raw_text string")
    return {r["i"]: reason not in r["reason_codes"] for r in contract.parse_frame(df).select("i", "reason_codes").collect()}


def python_amount_ok(text, currency):
    from decimal import Decimal, InvalidOperation
    try:
        amount = Decimal(text.strip())
    except InvalidOperation:
        return False
    try:
        scale = 6 if currency.strip() == "Bitcoin" else 2
        return not (not amount.is_finite() or amount < 0 or amount.as_tuple().exponent < -scale
                    or amount >= Decimal("1e18"))
    except InvalidOperation:
        return False


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="0123456789._-+eE ", max_size=8),
                          st.sampled_from(["US Dollar", "Bitcoin", " Bitcoin "])), min_size=300, max_size=300))
def test_amount_rule_matches_python_decimal(spark, cases):
    got = accepted(spark, [f"2022/09/01 00:20,1,A,2,B,1,US Dollar,{t},{c},ACH,0" for t, c in cases], "invalid_amount_paid")
    for i, (t, c) in enumerate(cases):
        assert got[i] == python_amount_ok(t, c), (t, c)


def python_ts_ok(text):
    import datetime as dt
    for fmt in ("%Y/%m/%d %H:%M", "%Y-%m-%d %H:%M:%S"):
        try:
            dt.datetime.strptime(text.strip(), fmt)
            return True
        except ValueError:
            pass
    return False


TS = st.builds(lambda y, sep, mo, d, ws, h, mi, s, tail: (
    f"{y}{sep}{mo}{sep}{d}{ws}{h}:{mi}" + (f":{s}" if sep == "-" else "") + tail),
    st.sampled_from(["2022", "2024", "1999", "22", "20224", "0000"]), st.sampled_from(["/", "-"]),
    st.sampled_from(["1", "01", "9", "09", "009", "12", "13", "0", "00"]),
    st.sampled_from(["1", "01", "29", "30", "31", "32", "0"]),
    st.sampled_from([" ", "  ", "\t", "", "T"]),
    st.sampled_from(["0", "00", "9", "023", "23", "24"]), st.sampled_from(["0", "05", "5", "59", "60"]),
    st.sampled_from(["0", "00", "7", "59", "60"]), st.sampled_from(["", " ", ":00", "x"]))


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.large_base_example])
@given(st.lists(TS, min_size=300, max_size=300))
def test_timestamp_rule_matches_strptime(spark, texts):
    got = accepted(spark, [f"{t},1,A,2,B,1,US Dollar,1,US Dollar,ACH,0" for t in texts], "invalid_timestamp")
    for i, t in enumerate(texts):
        assert got[i] == python_ts_ok(t), repr(t)
