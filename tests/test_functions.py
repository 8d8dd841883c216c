from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vendaflow.functions.calendar import calendar
from vendaflow.functions.measures import margin_pct, mean_line, row_margin
from vendaflow.functions.text import currency, known, normalize_postal, percent, strip, thousands

POSTAL = [
    (None, None), ("nan", None), ("NaN", None), (" ", None), ("", None), ("90210.0", "90210"),
    ("90210", "90210"), ("01234", "01234"), (" 10024 ", "10024"), ("\t10024\n", "10024"),
    ("10.0.0", "10"), ("1.05.0", "15"), ("10024.00", "10024.00"),
]


def test_postal_code(spark):
    df = spark.createDataFrame(POSTAL, "raw string, expected string")
    bad = df.withColumn("found", normalize_postal(strip(F.col("raw"))))
    assert bad.filter("NOT (found <=> expected)").collect() == []


def test_known(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("",), ("Nan",), ("x",)], "t string")
    assert [r[0] for r in df.select(known(F.col("t"))).collect()] == [None, None, None, "Nan", "x"]


@pytest.mark.parametrize(
    "sales, profit, expected", [(200, 50, 25.0), (0, 5, 0.0), (-10, 5, -50.0), (3, 1, 33.3333)]
)
def test_row_margin(spark, sales, profit, expected):
    found = spark.range(1).select(row_margin(F.lit(float(profit)), F.lit(float(sales))))
    assert found.first()[0] == expected


@pytest.mark.parametrize(
    "sales, profit, expected",
    [("200", "50", "25.00"), ("0", "5", "0"), ("-10", "5", "0"), ("8", "0.1234", "1.54"),
     ("80", "0.1", "0.13"), ("80", "-0.1", "-0.13")],
)
def test_margin_of_sums(spark, sales, profit, expected):
    df = spark.range(1).select(
        F.lit(Decimal(profit)).alias("p"), F.lit(Decimal(sales)).alias("s")
    )
    assert df.select(margin_pct("p", "s")).first()[0] == Decimal(expected)


def test_margin_keeps_digits_of_wide_sums(spark):
    wide = spark.sql("SELECT CAST(1 AS decimal(38,4)) p, CAST(3 AS decimal(38,4)) s")
    assert wide.select(margin_pct("p", "s")).first()[0] == Decimal("33.33")


def test_mean_line_rounds_half_up(spark):
    df = spark.sql("SELECT CAST(0.125 AS decimal(12,4)) AS s, 1 AS n")
    assert df.select(mean_line("s", "n")).first()[0] == Decimal("0.13")


DAYS = [
    ("2016-02-29", 0, "Segunda", 1, 1, "Fevereiro", "2016-02"),
    ("2017-01-01", 6, "Domingo", 1, 1, "Janeiro", "2017-01"),
    ("2017-01-02", 0, "Segunda", 1, 1, "Janeiro", "2017-01"),
    ("2017-07-04", 1, "Terça", 3, 2, "Julho", "2017-07"),
]


def test_calendar(spark):
    days = spark.createDataFrame([(d[0],) for d in DAYS], "t string")
    parts = calendar(F.col("t").cast("date"))
    names = ["dia_semana", "nome_dia_semana", "trimestre", "semestre", "nome_mes", "ano_mes"]
    found = days.select("t", *[parts[n].alias(n) for n in names]).collect()
    assert [tuple(r) for r in found] == DAYS
    assert found and days.select(parts["nome_trimestre"]).first()[0] == "Q1"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=50, max_size=50))
def test_formats(spark, values):
    df = spark.createDataFrame([(v, int(v)) for v in values], "x double, n bigint")
    found = df.select(currency(F.col("x")), thousands(F.col("n"))).collect()
    for (text, whole), value in zip(found, values):
        expected = f"${value:,.2f}"
        assert text == expected or expected == "$-0.00"
        assert whole == f"{int(value):,}"


def test_percent(spark):
    assert spark.range(1).select(percent(F.lit(Decimal("12.5")))).first()[0] == "12.50%"
