from pyspark.sql import functions as F

from vendaflow.operators.quality import quality_report


def report(tables):
    return {r.check: r.violations for r in quality_report(tables).collect()}


def test_violations_are_counted(house):
    tables = {n: t.df for n, t in house.tables().items()}
    fact = tables["fato_vendas"]
    year = fact.agg(F.min("ano_pedido")).first()[0]
    lost = fact.filter(F.col("ano_pedido") == year).count()
    spoiled = {
        **tables,
        "fato_vendas": fact.withColumns({
            "order_id": F.when(F.col("ano_pedido") == year, F.lit("x" * 31)).otherwise(F.col("order_id")),
            "lucro": F.when(F.col("ano_pedido") == year, F.col("lucro")),
            "sk_produto": F.when(F.col("ano_pedido") == year, -1).otherwise(F.col("sk_produto")),
        }),
        "dim_envio": tables["dim_envio"].unionByName(tables["dim_envio"]),
    }
    clean, found = report(tables), report(spoiled)
    assert set(clean.values()) == {0} and set(clean) == set(found)
    assert {c: v for c, v in found.items() if v} == {
        "length fato_vendas.order_id": lost,
        "not_null fato_vendas.lucro": fact.count() - lost,
        "foreign_key fato_vendas.sk_produto": lost,
        "unique dim_envio(sk_envio)": tables["dim_envio"].count(),
        "unique dim_envio(ship_mode)": tables["dim_envio"].count(),
    }


def test_location_key_counts_missing_parts_as_equal(house):
    tables = {n: t.df for n, t in house.tables().items()}
    tables["dim_localizacao"] = tables["dim_localizacao"].withColumn("cep", F.lit(None).cast("string"))
    found = report(tables)
    # Same place with different postal codes collapses once the codes are gone.
    places = tables["dim_localizacao"].drop("sk_localizacao").distinct().count()
    key = "unique dim_localizacao(pais, regiao, estado, cidade, cep)"
    assert found[key] == tables["dim_localizacao"].count() - places
