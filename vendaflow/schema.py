"""Names, types and fixed values of the sales warehouse."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Canonical source column -> (English header, Portuguese header).
HEADERS = {
    "row_id": ("Row ID", "ID_Linha"),
    "order_id": ("Order ID", "ID_Pedido"),
    "order_date": ("Order Date", "Dta_Pedido"),
    "ship_date": ("Ship Date", "Dta_Envio"),
    "ship_mode": ("Ship Mode", "Envio_Forma"),
    "customer_id": ("Customer ID", "ID_Cliente"),
    "customer_name": ("Customer Name", "Nme_Cliente"),
    "segment": ("Segment", "Segmento"),
    "country": ("Country", "Pais"),
    "city": ("City", "Cidade"),
    "state": ("State", "Estado"),
    "postal_code": ("Postal Code", "Codigo_Postal"),
    "region": ("Region", "Regiao"),
    "product_id": ("Product ID", "ID_Produto"),
    "category": ("Category", "Categoria_Produto"),
    "sub_category": ("Sub-Category", "Sub-categoria_Produto"),
    "product_name": ("Product Name", "Nme_Produto"),
    "sales": ("Sales", "Vendas"),
    "quantity": ("Quantity", "Quantidade_Itens"),
    "discount": ("Discount", "Desconto"),
    "profit": ("Profit", "Lucro"),
}
CANONICAL = list(HEADERS)
OPTIONAL = {"discount"}
CANONICAL_OF = {header: name for name, pair in HEADERS.items() for header in pair}

# Texts that a CSV reader with default settings takes as missing.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

@dataclass(frozen=True)
class Table:
    """A warehouse table: its columns as DDL types and its keys."""

    name: str
    key: str
    natural: tuple[str, ...]
    columns: dict[str, str]
    nullable: frozenset[str] = frozenset()

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.columns if c != self.key and c not in self.natural]

    @property
    def struct(self) -> T.StructType:
        ddl = ", ".join(f"{c} {_plain(t)}" for c, t in self.columns.items())
        return T.StructType.fromDDL(ddl)

    def limit(self, column: str) -> int | None:
        found = re.fullmatch(r"varchar\((\d+)\)", self.columns[column])
        return int(found.group(1)) if found else None


def _plain(ddl: str) -> str:
    return "string" if ddl.startswith("varchar") else ddl


DIM_TEMPO = Table(
    "dim_tempo", "sk_tempo", ("data",),
    {
        "sk_tempo": "bigint", "data": "date", "dia": "int", "mes": "int", "ano": "int",
        "trimestre": "int", "semestre": "int", "nome_mes": "varchar(20)",
        "nome_trimestre": "varchar(10)", "ano_mes": "varchar(7)", "dia_semana": "int",
        "nome_dia_semana": "varchar(15)",
    },
)
DIM_PRODUTO = Table(
    "dim_produto", "sk_produto", ("product_id",),
    {
        "sk_produto": "bigint", "product_id": "varchar(50)", "nome_produto": "varchar(255)",
        "categoria": "varchar(50)", "subcategoria": "varchar(50)",
    },
)
DIM_CLIENTE = Table(
    "dim_cliente", "sk_cliente", ("customer_id",),
    {
        "sk_cliente": "bigint", "customer_id": "varchar(50)", "nome_cliente": "varchar(100)",
        "segmento": "varchar(30)",
    },
)
DIM_LOCALIZACAO = Table(
    "dim_localizacao", "sk_localizacao", ("pais", "regiao", "estado", "cidade", "cep"),
    {
        "sk_localizacao": "bigint", "pais": "varchar(50)", "regiao": "varchar(20)",
        "estado": "varchar(50)", "cidade": "varchar(100)", "cep": "varchar(20)",
    },
    frozenset({"cep"}),
)
DIM_ENVIO = Table(
    "dim_envio", "sk_envio", ("ship_mode",),
    {"sk_envio": "bigint", "ship_mode": "varchar(30)"},
)
# ano_pedido is the partition column on disk; the year filter prunes on it.
FATO_VENDAS = Table(
    "fato_vendas", "sk_venda", ("row_id",),
    {
        "sk_venda": "bigint", "row_id": "bigint", "order_id": "varchar(30)",
        "sk_tempo_pedido": "bigint", "sk_tempo_envio": "bigint", "sk_produto": "bigint",
        "sk_cliente": "bigint", "sk_localizacao": "bigint", "sk_envio": "bigint",
        "vendas": "decimal(12,4)", "quantidade": "int", "desconto": "decimal(6,4)",
        "lucro": "decimal(12,4)", "margem_lucro_pct": "decimal(8,4)", "ano_pedido": "int",
    },
)
DIMENSIONS = [DIM_TEMPO, DIM_PRODUTO, DIM_CLIENTE, DIM_LOCALIZACAO, DIM_ENVIO]
TABLES = {t.name: t for t in [*DIMENSIONS, FATO_VENDAS]}


@dataclass(frozen=True)
class Role:
    """One way the fact points at a dimension; time plays two of them."""

    name: str
    table: Table
    foreign_key: str


ROLES = {
    r.name: r
    for r in [
        Role("tempo_pedido", DIM_TEMPO, "sk_tempo_pedido"),
        Role("tempo_envio", DIM_TEMPO, "sk_tempo_envio"),
        Role("produto", DIM_PRODUTO, "sk_produto"),
        Role("cliente", DIM_CLIENTE, "sk_cliente"),
        Role("localizacao", DIM_LOCALIZACAO, "sk_localizacao"),
        Role("envio", DIM_ENVIO, "sk_envio"),
    ]
}
