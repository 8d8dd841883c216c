import datetime as dt
from decimal import Decimal

import pytest
from data import BASE, sales
from pyspark.sql import functions as F

from vendaflow.errors import SourceError
from vendaflow.operators.staging import canonical_columns, canonical_headers, stage
from vendaflow.schema import CANONICAL, HEADERS


def one(spark, **changes):
    return stage(sales(spark, changes)).first()


def test_headers_in_both_languages_and_padded():
    for language in (0, 1):
        headers = [f"﻿ {pair[language]} " for pair in HEADERS.values()]
        assert canonical_headers(headers) == CANONICAL


def test_two_headers_for_one_column():
    with pytest.raises(SourceError, match="sales"):
        canonical_headers(["Sales", "Vendas"])


def test_missing_column_is_named(spark):
    without = sales(spark, {}, columns=[c for c in CANONICAL if c not in ("sales", "profit")])
    with pytest.raises(SourceError, match="sales, profit"):
        stage(without)


def test_missing_discount_is_zero(spark):
    without = sales(spark, {}, columns=[c for c in CANONICAL if c != "discount"])
    assert stage(without).first().discount == 0


def test_other_order_and_extra_columns(spark):
    shuffled = sales(spark, {}, columns=CANONICAL[::-1]).withColumn("note", F.lit("x"))
    twice = shuffled.select("*", F.lit("y").alias("note"))
    assert canonical_columns(twice).columns == CANONICAL


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2017-07-04", dt.date(2017, 7, 4)), ("7/4/2017", dt.date(2017, 7, 4)),
        ("07/04/2017", dt.date(2017, 7, 4)), ("7/4/2017 0:00", dt.date(2017, 7, 4)),
        ("07-04-2017", dt.date(2017, 7, 4)), (" 2017-07-04 13:00:00 ", dt.date(2017, 7, 4)),
        ("bad", None), ("", None), ("13/13/2017", None),
    ],
)
def test_dates(spark, text, expected):
    row = one(spark, order_date=text)
    assert row.order_date == expected
    assert row.problems == (None if expected else "order_date")


def test_numbers(spark):
    row = one(spark, row_id="7.0", quantity="3.7", sales=" 957.57749999999999 ", profit="1e1")
    assert (row.row_id, row.quantity) == (7, 3)
    assert (row.sales, row.profit) == (Decimal("957.5775"), Decimal("10.0000"))


def test_margin_uses_the_source_digits(spark):
    row = one(spark, sales="0.00012345", profit="0.00012345")
    assert row.margem_lucro_pct == Decimal("100.0000")
    assert row.sales == Decimal("0.0001")


@pytest.mark.parametrize(
    "changes, problems",
    [
        ({"sales": None}, ["sales"]),
        ({"sales": "NaN"}, ["sales"]),
        ({"sales": "many"}, ["sales"]),
        ({"sales": "123456789"}, ["sales"]),
        ({"quantity": "3000000000"}, ["quantity"]),
        ({"ship_mode": "x" * 31}, ["ship_mode"]),
        ({"ship_mode": "x" * 30}, None),
        ({"product_name": "NULL"}, ["product_name"]),
        ({"sales": "1", "profit": "100"}, ["margem_lucro_pct"]),
        ({"sales": "0", "profit": "100"}, None),
        ({"postal_code": "9" * 21}, ["postal_code"]),
        ({"postal_code": None}, None),
        ({"order_date": "bad", "row_id": "x"}, ["row_id", "order_date"]),
    ],
)
def test_problems(spark, changes, problems):
    assert one(spark, **changes).problems == (problems and ",".join(problems))


def test_typed_input_is_cast(spark):
    typed = sales(spark, {}).withColumns({
        "row_id": F.lit(5), "order_date": F.lit(dt.datetime(2017, 1, 1, 23)),
        "sales": F.lit(12.5), "profit": F.lit(float("nan")), "postal_code": F.lit(10024.0),
    })
    row = stage(typed).first()
    assert (row.row_id, row.order_date, row.sales) == (5, dt.date(2017, 1, 1), Decimal("12.5"))
    assert row.postal_code == "10024"
    assert "profit" in row.problems


def test_texts_are_kept_as_they_are(spark):
    assert one(spark, product_name=" Saw ").product_name == " Saw "
    assert one(spark).segment == BASE["segment"]


def test_largest_generated_method_is_compiled(spark, conf):
    """HotSpot leaves methods of 8,000 bytes and more to its interpreter."""
    conf(spark__sql__adaptive__enabled="false")
    text = stage(sales(spark, {}).repartition(2))._jdf.queryExecution().debug().codegenToSeq().mkString()
    sizes = [int(part.split(",")[0]) for part in text.split("ByteCodeStats(")[1:]]
    assert sizes and max(sizes) < 8000, sizes
