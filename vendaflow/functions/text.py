"""Text cleaning and display formats as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vendaflow.schema import NULL_WORDS

# The characters stripped from both ends of a text.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2002\u2003\u2009\u202f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def known(text: Column) -> Column:
    """The text, or NULL where it is a word for a missing value. Long texts are not looked up."""
    longest = max(map(len, NULL_WORDS))
    return F.when((F.octet_length(text) > longest) | ~text.isin(NULL_WORDS), text)


def normalize_postal(bare: Column) -> Column:
    """Postal code, already stripped, without float tail; blank and 'nan' become NULL.

    A text that ends in '.0' loses every '.0' in it.
    """
    whole = F.when(bare.endswith(".0"), F.replace(bare, F.lit(".0"), F.lit(""))).otherwise(bare)
    return F.when(~F.lower(bare).isin("", "nan"), whole)


def currency(value: Column) -> Column:
    """1234.5 -> $1,234.50"""
    return F.concat(F.lit("$"), F.format_number(value.cast("double"), 2))


def thousands(value: Column) -> Column:
    """1234567 -> 1,234,567"""
    return F.format_number(value.cast("bigint"), 0)


def percent(value: Column) -> Column:
    """12.5 -> 12.50%"""
    return F.format_string("%.2f%%", value.cast("double"))
