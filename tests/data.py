"""Small sales rows for tests."""

from __future__ import annotations

from vendaflow.schema import CANONICAL

BASE = {
    "row_id": "1", "order_id": "O1", "order_date": "2017-01-01", "ship_date": "2017-01-02",
    "ship_mode": "First Class", "customer_id": "C1", "customer_name": "Ana",
    "segment": "Consumer", "country": "X", "city": "T", "state": "S", "postal_code": "10.0",
    "region": "R", "product_id": "P1", "category": "Tools", "sub_category": "Saws",
    "product_name": "Saw", "sales": "200", "quantity": "2", "discount": "0", "profit": "50",
}


def sales(spark, *rows: dict, columns: list[str] | None = None):
    """One text row per dict of changes; row ids count up unless given."""
    columns = columns or CANONICAL
    filled = [{**BASE, "row_id": str(i), **row} for i, row in enumerate(rows, start=1)]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in filled], schema)


def rows(df, *columns: str) -> set[tuple]:
    found = df.select(*columns).collect() if columns else df.collect()
    assert len(found) == len(set(map(tuple, found)))
    return set(map(tuple, found))
