"""Calendar attributes of a date, with Portuguese names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month names January to December, weekday names Monday to Sunday.
MONTHS = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAYS = ["Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"]


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), position)


def calendar(day: Column) -> dict[str, Column]:
    """Attribute name -> expression, in the column order of the time dimension."""
    month = F.month(day)
    return {
        "dia": F.dayofmonth(day),
        "mes": month,
        "ano": F.year(day),
        "trimestre": F.quarter(day),
        "semestre": F.when(month <= 6, 1).otherwise(2),
        "nome_mes": _pick(MONTHS, month),
        "nome_trimestre": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "ano_mes": F.date_format(day, "yyyy-MM"),
        "dia_semana": F.weekday(day),
        "nome_dia_semana": _pick(WEEKDAYS, F.weekday(day) + 1),
    }
