"""Loads that overlap end as if they had run in turn."""

import pytest
from data import rows, sales
from pyspark.sql import functions as F

from vendaflow.operators.joins import Sized
from vendaflow.plans.layout import CLUSTERED
from vendaflow.plans.rebase import relabel
from vendaflow.plans.warehouse import Warehouse
from vendaflow.schema import ROLES

BASE = [{}, {"product_id": "P2", "product_name": "Axe"}, {"customer_id": "C2", "postal_code": None}]
THEIRS = [
    {"product_id": "PB", "order_date": "2018-05-05"}, {"product_id": "PS", "product_name": "theirs"},
    {"product_name": "their saw"}, {"product_id": "P2", "product_name": "their axe"},
    {"ship_mode": "Both", "city": "B"},
]
MINE = [
    {"product_id": "PA", "order_date": "2018-04-04"}, {"product_id": "PS", "product_name": "mine"},
    {"product_name": "my saw", "segment": None}, {"ship_mode": "Both", "city": "A", "postal_code": None},
    {"ship_mode": "Mine", "order_date": "2018-05-05", "product_id": "PZ"},
]


def overlapped(spark, root, monkeypatch, base, theirs, mine, **settings):
    """Load `base`, then `mine` with each of `theirs` published just before it."""
    house = Warehouse(spark, str(root), **settings)
    if base:
        house.load(sales(spark, *base))
    publish, waiting = Warehouse._publish, list(theirs)

    def late(self, *args):
        if self is house and waiting:
            Warehouse(spark, house.root).load(sales(spark, *waiting.pop(0)))
        publish(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_publish", late)
        summary = house.load(sales(spark, *mine))
    return house, summary


def in_turn(spark, root, *loads):
    house = Warehouse(spark, str(root))
    for one in loads:
        summary = house.load(sales(spark, *one))
    return house, summary


def same(found, expected):
    (a, told), (b, expected_told) = found, expected
    for name, table in b.tables().items():
        other = a.tables()[name]
        assert rows(other.df) == rows(table.df), name
        assert (other.rows, other.bytes) == (table.rows, table.bytes)
    assert told == expected_told and a.entries()[0].load == b.entries()[0].load


@pytest.fixture(scope="module")
def turns(spark, tmp_path_factory):
    return in_turn(spark, tmp_path_factory.mktemp("turns"), BASE, THEIRS, MINE)


def test_members_of_both_loads(spark, tmp_path, monkeypatch, turns):
    found = overlapped(spark, tmp_path, monkeypatch, BASE, [THEIRS], MINE)
    same(found, turns)
    names = rows(found[0].star().table("dim_produto"), "product_id", "nome_produto")
    assert {("P1", "my saw"), ("P2", "their axe"), ("PS", "mine"), ("PB", "Saw")} <= names


def test_first_loads_and_two_in_between(spark, tmp_path, monkeypatch, turns):
    """Without a common load every key may change; here by shuffles, nothing being broadcast."""
    found = overlapped(spark, tmp_path, monkeypatch, [], [BASE, THEIRS], MINE, broadcast_bytes=0)
    same(found, turns)


def test_the_fact_is_kept_where_no_key_changes(spark, tmp_path, monkeypatch):
    wrote, write = [], Warehouse._write_fact
    monkeypatch.setattr(Warehouse, "_write_fact", lambda self, *a: wrote.append(a) or write(self, *a))
    known = [{"product_name": "their saw"}]
    house, _ = overlapped(spark, tmp_path, monkeypatch, [{}], [known], [{"product_id": "P2"}])
    assert len(wrote) == 3
    names = rows(house.star().table("dim_produto"), "sk_produto", "nome_produto")
    assert names == {(1, "their saw"), (2, "Saw")}
    assert rows(house.star().table("fato_vendas"), "sk_produto") == {(2,)}
    assert house.vacuum(keep=1) and house.star().table("fato_vendas").count() == 1


def test_relabel_shuffled_or_broadcast(spark):
    """Only keys that moved change, in both roles of a table."""
    columns = [f"z_{c}" for c in CLUSTERED]
    fact = spark.range(200).select(
        F.col("id").alias("row_id"), F.lit(2017).alias("ano_pedido"), F.lit("O").alias("order_id"),
        *[(F.col("id") % (n + 2)).alias(r.foreign_key) for n, r in enumerate(ROLES.values())],
        *[F.lit("x").alias(c) for c in columns],
    )
    keys = spark.createDataFrame([(0, 100), (2, 102)], "_old bigint, sk_tempo bigint")
    moved = {"dim_tempo": Sized(keys, 2, 80)}
    expected = {
        (i, *[{0: 100, 2: 102}.get(i % (n + 2), i % (n + 2)) if n < 2 else i % (n + 2) for n in range(6)])
        for i in range(200)
    }
    for limit in (0, 1000):
        changed = relabel(fact, moved, limit)
        assert rows(changed, "row_id", *[r.foreign_key for r in ROLES.values()]) == expected


def test_empty_load(spark, tmp_path, monkeypatch):
    house, _ = overlapped(spark, tmp_path, monkeypatch, BASE, [THEIRS], [])
    assert not house.ready() and house.tables()["dim_produto"].rows == 4
