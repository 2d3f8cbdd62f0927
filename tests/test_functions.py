"""Literal cases of the column functions."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from payments_lake.functions import (
    clean_contract_number,
    clean_numeric,
    clean_text,
    composite_key,
    exact_total,
    fiscal_year,
    normalize_key_value,
    normalize_text,
    nullify_tokens,
    parse_date,
    parse_timestamp,
    percent,
    row_hash,
    trim_text,
    year_month,
)
from payments_lake.functions.text import MISSING_TOKENS, WHITESPACE

INF = float("inf")


def check(spark, function, cases):
    rows = [(i, text) for i, (text, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, v string").coalesce(1)
    out = {r.i: r.out for r in frame.select("i", function(F.col("v")).alias("out")).collect()}
    assert [(text, out[i]) for i, (text, _) in enumerate(cases)] == list(cases)


def test_clean_numeric(spark):
    good = [
        ("1,234.50", 1234.5), ("$500.00", 500.0), ("(123.45)", -123.45), ("1e3", 1000.0),
        (" 12 ", 12.0), ("($5)", -5.0), ("1.", 1.0), (".5", 0.5), ("+5", 5.0), ("inf", INF),
        ("-Infinity", -INF), ("(5 )", -5.0), (" 5　", 5.0), ("1e-400", 0.0),
    ]
    bad = [
        "", None, "-(5)", "((5))", "( 5 )", "5-", "- 5", "0x10", "0x1p3", "1_000", "1d", "1f",
        "5%", "1 234", "nan", "NaN", "1e400", "-1e400", "TRUE", "--5", ".", "-", "1e",
    ]
    check(spark, clean_numeric, good + [(text, None) for text in bad])


def test_fiscal_year(spark):
    check(
        spark,
        fiscal_year,
        [("2019", 2019), (" 2019", 2019), ("2019.0", 2019), ("2e3", 2000), ("2019.5", None),
         ("abc", None), (None, None), ("1e12", None), ("inf", None)],
    )


def test_parse_timestamp_ignores_session_zone(spark):
    half_past_two = dt.datetime(2019, 6, 26, 14, 32, 12)
    check(
        spark,
        parse_timestamp,
        [
            ("2019/06/26 02:32:12 PM", half_past_two),
            ("2019/6/26 2:32:12 pm", half_past_two),
            ("2019/06/26  02:32:12\tPM", half_past_two),
            ("2019/06/ 6 02:32:12 PM", dt.datetime(2019, 6, 6, 14, 32, 12)),
            ("2019/06/26 12:10:00 AM", dt.datetime(2019, 6, 26, 0, 10)),
            ("2019/06/26 12:10:00 PM", dt.datetime(2019, 6, 26, 12, 10)),
            # does not exist on a clock in the session zone
            ("2019/03/10 02:30:00 AM", dt.datetime(2019, 3, 10, 2, 30)),
            *[
                (text, None)
                for text in [
                    "2019/06/26 14:32:12 PM", "2019/06/26 00:32:12 AM", "2019/06/26 02:32:12 PM ",
                    " 2019/06/26 02:32:12 PM", "2019/06/26", "19/06/26 02:32:12 PM",
                    "2019/006/26 02:32:12 PM", "2019/06/26 02:60:12 PM", "2019/06/26 02:32:12PM",
                    "2019/02/29 02:32:12 PM", "2019/06/26 02:32:12 PM\n",
                    "2019/06/26 02:32:12 PM\r\n", "", None,
                ]
            ],
        ],
    )


def test_parse_date(spark):
    seventh = dt.date(2018, 8, 7)
    check(
        spark,
        parse_date,
        [("2018/08/07", seventh), ("2018/8/7", seventh), ("2018/08/ 7", seventh)]
        + [
            (text, None)
            for text in ["2018/08/07\n", "2018/08/07\r\n", "2018/02/30", "2018-08-07", "20180807", "2018/08/07 ", " 2018/08/07",
                         "2018/008/07", "18/08/07", "unknown", None]
        ],
    )
    check(spark, lambda c: year_month(parse_date(c)), [("2018/8/7", "2018-08"), ("x", None)])


def test_text_cleaning(spark):
    check(
        spark,
        lambda c: clean_text(c, "Unknown"),
        [(" ABC ", "ABC"), (None, "Unknown"), ("   ", ""), ("\t a b\n", "a b")],
    )
    check(spark, trim_text, [(w + "a" + w, "a") for w in WHITESPACE] + [(None, None), ("", "")])
    check(spark, normalize_text, [(" DPH Public Health ", "dph public health"), (None, None)])
    check(
        spark,
        clean_contract_number,
        [("1000001664.0", "1000001664"), ("5.0.0", "5.0"), ("1.00", "1.00"), ("A.0", "A"),
         ("12.0 ", "12"), ("nan", None), ("NaN", None), ("<NA>", None), ("nan.0", "nan"),
         (None, None)],
    )
    check(
        spark,
        nullify_tokens,
        [(token, None) for token in MISSING_TOKENS] + [(" NA ", " NA "), ("x", "x"), (None, None)],
    )


def test_keys(spark):
    check(spark, normalize_key_value, [(None, "<NULL>"), (" ABC ", "ABC")])
    frame = spark.createDataFrame([("2025", " PO001", "ABC INC", None)] * 2, "a string, b string, c string, d string")
    keys = [r[0] for r in frame.select(composite_key(["a", "b", "c", "d"])).collect()]
    assert keys == ["2025||PO001||ABC INC||<NULL>"] * 2
    hashes = {r[0] for r in frame.select(row_hash(["a", "b", "c", "d"])).collect()}
    assert hashes == {hashlib.md5(keys[0].encode()).hexdigest()}


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([0.1] * 10, 1.0),
        ([1e15, 0.01, -1e15], 0.01),
        ([None, None], 0.0),
        ([INF, 1.0], INF),
        ([1e20, 5.0], 1e20),
    ],
)
def test_exact_total(spark, values, expected):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert frame.agg(exact_total(F.col("v"))).first()[0] == expected


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(percent(F.lit(1), F.lit(3)), percent(F.lit(0), F.lit(0))).first()
    assert tuple(row) == (33.3333, 0.0)


def test_exact_total_keeps_every_digit_in_any_order(spark):
    def total(values):
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
        return frame.agg(exact_total(F.col("v")).alias("t")).first().t

    assert abs(total([1e-7] * 1000) - 1e-4) < 1e-12
    for values in ([2e18, 1.0, -2e18], [1.0, 2e18, -2e18], [-2e18, 2e18, 1.0]):
        assert total(values) == 1.0
    assert total([0.1] * 10 + [-0.1] * 10) == 0.0
    assert total([INF, 1.0]) == INF
    assert total([None, None]) == 0.0


def test_long_money_and_usual_years(spark):
    """Texts on either side of the lengths that the short ways take."""
    nines = "9" * 299
    check(spark, clean_numeric, [(nines, float(nines)), ("9" * 309, None), ("(" + "9" * 309 + ")", None)])
    check(
        spark,
        fiscal_year,
        [("2019", 2019), ("000000000002019", 2019), ("0000000000002019", 2019), (" 2019 ", 2019), ("2019\n", 2019)],
    )
