"""A flat sales table mapped from order, line item, customer and part tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vendaflow.operators.joins import BROADCAST_BYTES, hot_keys, measure, spread_join
from vendaflow.operators.numbering import number_rows
from vendaflow.schema import HEADERS

# Line items carry no id of their own: these columns order them, and _pos, the place in
# the scan, orders exact copies, so a large group of copies is spread over partitions.
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
    "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
# Of these, what a sale is made of; the others only order.
SOLD = ["l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount"]


def numbered_lines(spark: SparkSession, folder: str, extra: tuple[str, ...] = ()) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(*LINE_ORDER)
    placed = lines.withColumn("_pos", F.monotonically_increasing_id())
    kept = list(dict.fromkeys([*SOLD, *extra]))
    return number_rows(placed, [*LINE_ORDER, "_pos"], "row_id", kept=kept)


def flat_sales(spark: SparkSession, folder: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per line item under English headers, with dirty postal codes.

    `extra` names line columns to carry along; staging ignores them.
    Sides of a measured small size are broadcast; others are shuffled with hot keys spread.
    """
    def read(name: str, *columns: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)

    def join(rows, base, key, side, count, own, by):
        """Inner join on rows[key] = side[own]. `base`: the table that brought the key into
        `rows`, where its hot values are looked for; `by` identifies a row of `rows`."""
        if measure(side, count, BROADCAST_BYTES).fits(BROADCAST_BYTES):
            return rows.join(F.broadcast(side), rows[key] == side[own])
        (hot,) = hot_keys(base, [key])
        return spread_join(rows, side, [(key, own)], "inner", hot, [by])

    region, nation = read("region", "r_regionkey", "r_name"), read(
        "nation", "n_nationkey", "n_name", "n_regionkey"
    )
    customer = read("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    orders = read("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = read("part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")

    numbered = numbered_lines(spark, folder, extra)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    places = join(
        nation, nation, "n_regionkey", region, region.count(), "r_regionkey", "n_nationkey"
    )
    buyers = join(
        customer, customer, "c_nationkey", places, nation.count(), "n_nationkey", "c_custkey"
    )
    bought = join(
        orders, orders, "o_custkey", buyers, customer.count(), "c_custkey", "o_orderkey"
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    # Parts first, since their texts are shorter than those of orders and buyers: lines travel with
    # them to the orders. What a line says is computed before, so that numbers travel, not their sources.
    lines = numbered.select(
        "row_id", "l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"), *extra,
        net.alias("net"), "l_quantity", F.col("l_discount").cast("decimal(6,4)").alias("discount"),
    )
    sales = join(lines, numbered, "l_partkey", part, part.count(), "p_partkey", "row_id")
    cost = F.col("l_quantity") * F.col("p_retailprice")
    sales = sales.select(
        "row_id", "l_orderkey", "p_partkey", "ship_date", *extra, "p_name", "p_brand", "p_type", "discount",
        F.col("net").cast("decimal(12,4)").alias("sales"), F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("net") - cost).cast("decimal(12,4)").alias("profit"),
    )
    sales = join(sales, numbered, "l_orderkey", bought, orders.count(), "o_orderkey", "row_id")
    tail = F.col("c_custkey") % 10
    dirt = F.col("c_custkey") % 7
    postal = (
        F.when(dirt == 0, F.lit(None))
        .when(dirt == 1, "nan")
        .when(dirt == 2, "  ")
        .otherwise(F.concat(F.lit(" "), (10000 + tail).cast("string"), F.lit(".0")))
    )
    columns = {
        "row_id": F.col("row_id"),
        "order_id": F.col("o_orderkey").cast("string"),
        "order_date": F.col("o_orderdate"),
        "ship_date": F.col("ship_date"),
        "ship_mode": F.col("o_orderpriority"),
        "customer_id": F.col("c_custkey").cast("string"),
        "customer_name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "country": F.lit("ALL"),
        "city": F.concat(F.lit("CITY_"), tail.cast("string")),
        "state": F.col("n_name"),
        "postal_code": postal,
        "region": F.col("r_name"),
        "product_id": F.concat(F.lit("P"), F.col("p_partkey").cast("string")),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_name": F.col("p_name"),
        "sales": F.col("sales"),
        "quantity": F.col("quantity"),
        "discount": F.col("discount"),
        "profit": F.col("profit"),
    }
    return sales.select(*[e.alias(HEADERS[c][0]) for c, e in columns.items()], *extra)
