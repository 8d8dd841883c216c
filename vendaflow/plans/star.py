"""Filtered aggregation over the star, joining only the dimensions a query names."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from vendaflow.functions.measures import SUM, margin_pct, mean_line
from vendaflow.operators.joins import Sized, spread_join
from vendaflow.plans.layout import Zones
from vendaflow.schema import ROLES

# Attribute names as queries use them: name -> (role, dimension column).
ATTRIBUTES = {
    "ano_mes": ("tempo_pedido", "ano_mes"),
    "ano": ("tempo_pedido", "ano"),
    "mes": ("tempo_pedido", "mes"),
    "nome_mes": ("tempo_pedido", "nome_mes"),
    "data_pedido": ("tempo_pedido", "data"),
    "data_envio": ("tempo_envio", "data"),
    "product_id": ("produto", "product_id"),
    "nome_produto": ("produto", "nome_produto"),
    "categoria": ("produto", "categoria"),
    "subcategoria": ("produto", "subcategoria"),
    "customer_id": ("cliente", "customer_id"),
    "nome_cliente": ("cliente", "nome_cliente"),
    "segmento": ("cliente", "segmento"),
    "pais": ("localizacao", "pais"),
    "regiao": ("localizacao", "regiao"),
    "estado": ("localizacao", "estado"),
    "cidade": ("localizacao", "cidade"),
    "ship_mode": ("envio", "ship_mode"),
}
SUMMED = ["vendas", "lucro", "quantidade", "linhas"]
COUNTED_ROWS = 1_500_000  # sales of a task that counts distinct values: 150 to 400 MB


@dataclass(frozen=True)
class Filters:
    """Chosen values of four attributes. An empty choice means no restriction."""

    segmentos: Sequence[str] = ()
    regioes: Sequence[str] = ()
    categorias: Sequence[str] = ()
    anos: Sequence[int] = ()

    def chosen(self) -> dict[str, list]:
        picks = {
            "segmento": self.segmentos, "regiao": self.regioes, "categoria": self.categorias,
        }
        return {name: list(values) for name, values in picks.items() if values}


@dataclass(frozen=True)
class Measure:
    """An aggregate over vendas, lucro, quantidade and linhas, or a distinct count."""

    name: str
    build: Callable[[], Column]
    counted: str | None = None

    @property
    def column(self) -> Column:
        return self.build().alias(self.name)

    @property
    def merged(self) -> Column:
        """The same over sums and counts of parts that share no counted value."""
        return F.sum(self.counted).alias(self.name) if self.counted else self.column


def total(column: str, name: str) -> Measure:
    return Measure(name, lambda: _sum(column))


def total_or_zero(column: str, name: str) -> Measure:
    return Measure(name, lambda: F.coalesce(_sum(column), F.lit(0)))


def distinct(column: str, name: str) -> Measure:
    return Measure(name, lambda: F.countDistinct(column), column)


def ticket(name: str) -> Measure:
    return Measure(name, lambda: mean_line("sum(vendas)", "sum(linhas)"))


def margin(name: str) -> Measure:
    return Measure(name, lambda: margin_pct("sum(lucro)", "sum(vendas)"))


def _sum(column: str) -> Column:
    kind = SUM if column in ("vendas", "lucro") else "bigint"
    return F.sum(column).cast(kind)


def grouped(
    rows: DataFrame, by: Sequence[str], measures: Sequence[Measure], tasks: int
) -> DataFrame:
    """Group by attributes. Each column with a distinct count is dealt to `tasks` tasks by group
    and value, before anything is held in memory: a task keeps the values of its own rows only,
    however many there are in all, and the counts of the tasks add up."""
    counted = list(dict.fromkeys(m.counted for m in measures if m.counted))
    if not counted:
        return rows.groupBy(*by).agg(*[m.column for m in measures])
    parts = []
    for column in counted:
        # The sums come with the first column only.
        sums = [] if parts else [F.sum(c).alias(c) for c in SUMMED]
        dealt = rows.select(*by, column, *[c for c in SUMMED if sums]).repartition(tasks, *by, column)
        values = dealt.groupBy(*by, column).agg(*sums) if sums else dealt.distinct()
        parts.append(values.groupBy(*by).agg(F.count(column).alias(column), *sums))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.groupBy(*by).agg(*[m.merged for m in measures])


class Star:
    """The loaded tables, and aggregation over them."""

    def __init__(
        self,
        tables: dict[str, Sized],
        limit: int,
        zones: Zones | None = None,
        namesakes: Mapping[str, int] = {},
    ):
        self.tables = tables
        self.limit = limit
        self.zones = zones
        self.namesakes = namesakes  # by table, the most members of one name; large tables only

    def table(self, name: str) -> DataFrame:
        return self.tables[name].df

    @property
    def tasks(self) -> int:
        """Tasks that count distinct values of the fact."""
        return max(1, math.ceil(self.tables["fato_vendas"].rows / COUNTED_ROWS))

    def _roles(self, names: Sequence[str]) -> list[str]:
        """Roles of the named attributes, small dimensions first."""
        roles = list(dict.fromkeys(ATTRIBUTES[n][0] for n in names))
        return sorted(roles, key=lambda r: not self._small(r))

    def _small(self, role: str) -> bool:
        return self.tables[ROLES[role].table.name].fits(self.limit)

    def _stored(self, by: Sequence[str], chosen: Mapping[str, list]) -> list[str]:
        """Attributes read from the fact's own files: of dimensions too large to broadcast of which
        nothing else is named."""
        if not self.zones:
            return []
        names = list(dict.fromkeys([*by, *chosen]))
        joined = {ATTRIBUTES[n][0] for n in names if n not in self.zones.stored}
        return [n for n in names if ATTRIBUTES[n][0] not in joined and not self._small(ATTRIBUTES[n][0])]

    def _join(
        self, rows: DataFrame, role_name: str, names: Sequence[str], chosen, by: Sequence[str]
    ) -> DataFrame:
        """Inner join of one dimension: its named attributes, its filters applied first.
        `by` tells the rows of one key apart.

        Every fact key has a member (checked at load), so a dimension that no attribute
        or filter names can be left out without changing a result.
        """
        role = ROLES[role_name]
        dim = self.tables[role.table.name]
        members = dim.df
        for name, values in chosen.items():
            if ATTRIBUTES[name][0] == role_name:
                members = members.filter(F.col(ATTRIBUTES[name][1]).isin(values))
        key = f"_{role_name}"
        mine = [n for n in names if ATTRIBUTES[n][0] == role_name]
        members = members.select(
            F.col(role.table.key).alias(key),
            *[F.col(ATTRIBUTES[n][1]).alias(n) for n in mine],
        )
        if dim.fits(self.limit):
            match = rows[role.foreign_key] == members[key]
            return rows.join(F.broadcast(members), match).drop(key)
        pairs = [(role.foreign_key, key)]
        return spread_join(rows, members, pairs, "inner", dim.hot, by).drop(key)

    def fact(self, filters: Filters, stored: Sequence[str] = ()) -> DataFrame:
        """The fact, with the named attributes that its files hold; a choice of years prunes its
        partitions, one of members its files."""
        if self.zones and (stored or filters.chosen()):
            return self.zones.read(filters.chosen(), filters.anos, stored)
        rows = self.table("fato_vendas")
        if filters.anos:
            rows = rows.filter(F.col("ano_pedido").isin(list(filters.anos)))
        return rows

    def lines(self, names: Sequence[str], filters: Filters = Filters()) -> DataFrame:
        """Fact rows with the named attributes."""
        chosen = filters.chosen()
        stored = self._stored(names, chosen)
        rows = self.fact(filters, stored)
        for role in self._roles([n for n in [*names, *chosen] if n not in stored]):
            rows = self._join(rows, role, names, chosen, ["row_id"])
        return rows

    def aggregate(
        self, by: Sequence[str], measures: Sequence[Measure], filters: Filters = Filters()
    ) -> DataFrame:
        """Group by attributes. Dimensions too large to broadcast are joined after the fact
        has been summed per key, so no hot key crosses the network row by row. Attributes that the
        fact's files hold need no join."""
        chosen = filters.chosen()
        stored = self._stored(by, chosen)
        rows = self.fact(filters, stored).withColumn("linhas", F.lit(1))
        roles = self._roles([n for n in [*by, *chosen] if n not in stored])
        small = [r for r in roles if self._small(r)]
        large = [r for r in roles if not self._small(r)]
        for role in small:
            rows = self._join(rows, role, by, chosen, [])
        if large:
            kept = [n for n in by if n in stored or ATTRIBUTES[n][0] in small]
            keys = [ROLES[r].foreign_key for r in large]
            counted = [m.counted for m in measures if m.counted]
            groups = list(dict.fromkeys([*kept, *keys, *counted]))
            if counted:
                rows = rows.repartition(self.tasks, *groups)
            rows = rows.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in SUMMED])
            for role in large:
                rows = self._join(rows, role, by, chosen, groups)
        return grouped(rows, by, measures, self.tasks)

    def shared(self, filters: Filters = Filters()) -> SharedStar:
        """The filtered rows with all report attributes, kept for several reports."""
        return SharedStar(self, filters)


class SharedStar:
    """Filtered and joined rows, persisted once while a set of reports runs on them.

    Use as a context manager. Worth it where the filters leave a small part of the fact;
    without filters, separate scans of a few columns each are cheaper.
    """

    NAMES = [
        "ano_mes", "ano", "mes", "nome_mes", "nome_produto", "categoria", "subcategoria",
        "segmento", "regiao", "estado", "ship_mode",
    ]
    KEPT = ["order_id", "sk_cliente", "vendas", "lucro", "quantidade"]

    def __init__(self, star: Star, filters: Filters):
        self.star = star
        self.filters = filters
        rows = star.lines(self.NAMES, filters).withColumn("linhas", F.lit(1))
        self.rows = rows.select(*self.NAMES, *self.KEPT, "linhas")

    def __enter__(self) -> SharedStar:
        self.rows = self.rows.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *_) -> None:
        self.rows.unpersist()

    def aggregate(
        self, by: Sequence[str], measures: Sequence[Measure], filters: Filters = Filters()
    ) -> DataFrame:
        if filters != Filters() and filters != self.filters:
            raise ValueError("shared rows were filtered differently")
        return grouped(self.rows, by, measures, self.star.tasks)
