"""From a flat source table, texts or typed, to 21 clean typed columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vendaflow.errors import SourceError
from vendaflow.functions.measures import row_margin
from vendaflow.functions.text import known, normalize_postal, strip
from vendaflow.schema import CANONICAL, CANONICAL_OF, OPTIONAL, TABLES

# Accepted date texts besides ISO ones, by separator; the month comes first.
DATE_FORMATS = {"/": "M/d/yyyy[ H:mm[:ss]]", "-": "M-d-yyyy[ H:mm[:ss]]"}

NUMBERS = {
    "row_id": "bigint",
    "sales": "decimal(12,4)",
    "quantity": "int",
    "discount": "decimal(6,4)",
    "profit": "decimal(12,4)",
}
DATES = ["order_date", "ship_date"]
MARGIN = "margem_lucro_pct"
PROBLEMS = "problems"
MALFORMED = "_malformed"  # the line a reader could not split into its columns, else NULL
LINE = "line"  # the problem of such a row

# Source column -> warehouse table and column that hold its text.
TEXT_TARGETS = {
    "order_id": ("fato_vendas", "order_id"),
    "ship_mode": ("dim_envio", "ship_mode"),
    "customer_id": ("dim_cliente", "customer_id"),
    "customer_name": ("dim_cliente", "nome_cliente"),
    "segment": ("dim_cliente", "segmento"),
    "country": ("dim_localizacao", "pais"),
    "city": ("dim_localizacao", "cidade"),
    "state": ("dim_localizacao", "estado"),
    "postal_code": ("dim_localizacao", "cep"),
    "region": ("dim_localizacao", "regiao"),
    "product_id": ("dim_produto", "product_id"),
    "category": ("dim_produto", "categoria"),
    "sub_category": ("dim_produto", "subcategoria"),
    "product_name": ("dim_produto", "nome_produto"),
}
TEXT_LIMITS = {c: TABLES[t].limit(target) for c, (t, target) in TEXT_TARGETS.items()}
# Only the first row of a product or customer brings these into the warehouse.
DESCRIPTIVE = ["customer_name", "segment", "category", "sub_category", "product_name"]


def canonical_headers(headers: list[str]) -> list[str]:
    """Clean the headers and give known ones, in either language, their canonical name."""
    clean = [h.strip().lstrip("\ufeff").strip() for h in headers]
    names = [CANONICAL_OF.get(h, h) for h in clean]
    twice = sorted(n for n, count in Counter(names).items() if count > 1 and n in CANONICAL)
    if twice:
        raise SourceError(f"more than one header for: {', '.join(twice)}")
    return names


def require_columns(names: list[str]) -> None:
    missing = [c for c in CANONICAL if c not in names and c not in OPTIONAL]
    if missing:
        raise SourceError(f"columns missing in the source: {', '.join(missing)}")


def canonical_columns(df: DataFrame) -> DataFrame:
    """Rename, check and project to the 21 canonical columns. Starts no job."""
    names = canonical_headers(df.columns)
    require_columns(names)
    # Extra columns get a throwaway name: two of them may share one.
    known_names = {*CANONICAL, MALFORMED}
    df = df.toDF(*[n if n in known_names else f"_extra{i}" for i, n in enumerate(names)])
    if "discount" not in names:
        df = df.withColumn("discount", F.lit(0).cast("decimal(6,4)"))
    return df.select(*CANONICAL, *[c for c in (MALFORMED,) if c in df.columns])


def _source_value(column: str, kind: T.DataType) -> Column:
    """The value as it came; a text for a missing value is NULL, a parsed text is stripped."""
    if column == "postal_code":
        return known(strip(F.col(column).cast("string")))
    if not isinstance(kind, T.StringType):
        return F.col(column)
    parsed = column in NUMBERS or column in DATES
    return known(strip(F.col(column)) if parsed else F.col(column))


def _date(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StringType):
        return F.to_date(value)
    # Without the test, a text with a time but no date would be a time of the current day.
    tries = [F.when(value.rlike(r"^[0-9]{4}-"), F.try_to_timestamp(value))]
    for separator, form in DATE_FORMATS.items():
        parsed = F.try_to_timestamp(value, F.lit(form))
        tries.append(F.when(value.contains(separator), parsed))
    return F.to_date(F.coalesce(*tries))


def _number(value: Column, kind: T.DataType, target: str) -> Column:
    if target in ("int", "bigint") and not isinstance(kind, T.IntegralType):
        value = value.try_cast("decimal(38,4)")  # '3.0' and 3.7 become 3
    return value.try_cast(target)


def stage(source: DataFrame) -> DataFrame:
    """Typed canonical columns, the row margin, and what is wrong with the row.

    `problems` is NULL for a good row, `line` for one that the reader could not split into its
    columns, else the offending columns with commas between. Text
    columns are parsed; columns that arrive typed are only cast. Each step is a projection
    of its own, so a value used several times is computed once.
    """
    flat = canonical_columns(source)
    kinds = {f.name: f.dataType for f in flat.schema}
    line = F.col(MALFORMED) if MALFORMED in flat.columns else F.lit(None).cast("string")
    raw = flat.select(
        *[_source_value(c, kinds[c]).alias(c) for c in CANONICAL], line.isNotNull().alias(MALFORMED)
    )

    typed: dict[str, Column] = {}
    for c in CANONICAL:
        if c in DATES:
            typed[c] = _date(F.col(c), kinds[c])
        elif c in NUMBERS:
            typed[c] = _number(F.col(c), kinds[c], NUMBERS[c])
        elif c == "postal_code":
            typed[c] = normalize_postal(F.col(c))
        else:
            typed[c] = F.col(c).cast("string")
    sales, profit = (F.col(c).try_cast("double") for c in ("sales", "profit"))
    typed[MARGIN] = row_margin(profit, sales).try_cast("decimal(8,4)")
    clean = raw.select(*[e.alias(c) for c, e in typed.items()], MALFORMED)

    bad = {c: F.col(c).isNull() for c in typed if c != "postal_code"}
    for c, limit in TEXT_LIMITS.items():
        # Characters are counted only where the bytes exceed the limit.
        too_long = (F.octet_length(c) > limit) & (F.length(c) > limit)
        bad[c] = bad[c] | too_long if c in bad else F.coalesce(too_long, F.lit(False))
    any_bad = F.lit(False)
    for test in bad.values():
        any_bad = any_bad | test
    # concat_ws skips NULLs and, unlike array functions with a lambda, stays in generated code.
    names = F.concat_ws(",", *[F.when(test, F.lit(c)) for c, test in bad.items()])
    found = F.when(F.col(MALFORMED), F.lit(LINE)).otherwise(F.when(any_bad, names))
    return clean.select(*typed, found.alias(PROBLEMS))


def unfit(problems: Column) -> Column:
    """Whether a row cannot be loaded at all: something other than a description is wrong."""
    keys = F.array_except(F.split(problems, ","), F.array(*[F.lit(c) for c in DESCRIPTIVE]))
    return F.coalesce(F.size(keys) > 0, F.lit(False))
