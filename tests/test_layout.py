"""Files of the fact along the curve, and reports that open only the files they need."""

import pytest
from test_star import same

from vendaflow.plans import layout, reports
from vendaflow.plans.layout import STORED, Zones
from vendaflow.plans.star import Filters, Star
from vendaflow.plans.warehouse import Warehouse
from vendaflow.schema import ROLES
from vendaflow.session import list_folders
from vendaflow.sources.tables import flat_sales

SF = "/root/testdata/sf0.001"
CHOICES = [
    Filters(["BUILDING"], ["ASIA"], ["PROMO"], [1996, 1997]),
    Filters(["BUILDING", "MACHINERY"], ["ASIA", "EUROPE"], ["PROMO", "LARGE"]),
    Filters(categorias=["PROMO"]),
    Filters(regioes=["ATLANTIS"]),
    Filters(segmentos=["A", "BUILDING", "Z"], anos=[1995]),
]


@pytest.fixture(scope="module")
def pieces(spark, tmp_path_factory):
    """The small tables in files of 50 sales."""
    built = Warehouse(spark, str(tmp_path_factory.mktemp("pieces")), file_rows=50)
    built.load(flat_sales(spark, SF))
    return built


@pytest.mark.parametrize("filters", CHOICES)
def test_same_rows_from_fewer_files(pieces, filters):
    star = pieces.star()
    plain = Star(star.tables, star.limit)
    for report in (reports.kpi, reports.mensal, reports.estados, reports.habitos, reports.produtos):
        same(report(star, filters), report(plain, filters))
    read = star.fact(filters).inputFiles()
    every = plain.fact(filters).inputFiles()
    assert len(read) < len(every) / (2 if filters in CHOICES[:1] + CHOICES[3:] else 1)
    assert set(read) <= set(every)


def test_ranges_hold_every_sale(pieces):
    """The stored attributes are the members', and each lies in its file's range."""
    star = pieces.star()
    path = pieces.entries()[-1].path
    files = pieces.spark.read.schema(layout.stored_schema()).parquet(path)
    for name, role in layout.CLUSTERED.items():
        members = star.table(ROLES[role].table.name)
        key = ROLES[role].foreign_key
        joined = files.join(members, files[key] == members[ROLES[role].table.key])
        assert joined.filter(~members[name].eqNullSafe(files[STORED[name]])).isEmpty()
    zones = star.zones.files.collect()
    assert sum(z.rows for z in zones) == star.table("fato_vendas").count()
    assert max(z.rows for z in zones) <= 50


def test_spark_finds_the_files_where_they_are_many(pieces, monkeypatch):
    zones = pieces.star().zones
    wanted = [sorted(zones.needed(f.chosen(), f.anos)) for f in CHOICES]
    monkeypatch.setattr(layout, "KNOWN_FILES", 3)
    many = Zones(zones.files, zones.fact_path)
    assert many.known is None
    assert 0 < len(wanted[0]) < len(wanted[1])
    assert [sorted(many.needed(f.chosen(), f.anos)) for f in CHOICES] == wanted


def test_curve_keeps_neighbours_together(spark):
    """On the curve, a quarter of each axis is an eighth-cube that is one stretch."""
    places = spark.range(64).selectExpr(
        "cast((id % 4) * 64 as int) AS place_segmento", "cast((id div 4 % 4) * 64 as int) AS place_regiao",
        "cast((id div 16) * 64 as int) AS place_categoria",
    )
    rows = places.withColumn("c", layout.curve()).collect()
    order = sorted(rows, key=lambda r: r.c)
    assert len({r.c for r in rows}) == 64
    halves = [{(r[0] >= 128, r[1] >= 128, r[2] >= 128) for r in order[i : i + 8]} for i in range(0, 64, 8)]
    assert all(len(h) == 1 for h in halves)


def test_loads_without_ranges_and_vacuum(spark, tmp_path):
    from data import sales

    house = Warehouse(spark, str(tmp_path))
    house.create()
    assert house.star().zones is None
    for _ in range(3):
        house.load(sales(spark, {}))
    assert house.star().zones.files.count() > 0
    assert len(list_folders(spark, f"{tmp_path}/zones")) == 3
    house.vacuum(keep=1)
    assert len(list_folders(spark, f"{tmp_path}/zones")) == 1
    assert house.star().zones.files.count() > 0
