"""Finding source files and reading CSV."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T

from vendaflow.errors import SourceError
from vendaflow.operators.staging import (
    MALFORMED, canonical_columns, canonical_headers, require_columns,
)
from vendaflow.schema import CANONICAL
from vendaflow.session import first_line, list_files, path_exists
from vendaflow.sources.xlsx import read_xlsx


def find_source(spark: SparkSession, folder: str, names: list[str]) -> str:
    """The first of `names`, in their order, that exists in `folder`."""
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        if path_exists(spark, path):
            return path
    raise SourceError(f"none of {', '.join(names)} found in {folder}")


def _headers(spark: SparkSession, paths: tuple[str, ...], encoding: str) -> dict[str, str]:
    """File -> its first line. Only first lines are read, several at a time, without a job."""
    files = [f for path in paths for f in list_files(spark, path)]
    if not files:
        raise SourceError(f"no file at {', '.join(paths)}")
    with ThreadPoolExecutor(16) as pool:
        lines = pool.map(lambda f: first_line(spark, f, encoding), files)
        return {f: line for f, line in zip(files, lines) if line is not None}


def read_csv(
    spark: SparkSession, *paths: str, encoding: str = "UTF-8", multiline: bool = False
) -> DataFrame:
    """The 21 canonical columns, as texts, from CSV files, folders or globs.

    Each file may have its own header, language and column order; files with the same header
    are read in one scan. A line with too many or too few fields is kept in `_malformed`, and
    staging makes it an unfit row. `multiline` allows line breaks inside quotes, at the price
    of one task per file.
    """
    if not paths:
        raise SourceError("no CSV path given")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, line in _headers(spark, paths, encoding).items():
        header = tuple(canonical_headers(next(csv.reader([line]))))
        by_header.setdefault(header, []).append(file)
    if not by_header:
        raise SourceError(f"no header in {', '.join(paths)}")
    parts = []
    for header, files in by_header.items():
        require_columns(list(header))
        names = [n if n in CANONICAL else f"_extra{i}" for i, n in enumerate(header)]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
        # Pruned columns would hide a line with a wrong number of fields.
        lines = spark.read.schema(schema).options(
            header=True, quote='"', escape='"', encoding=encoding, multiLine=multiline,
            columnNameOfCorruptRecord=MALFORMED, columnPruning=False,
        )
        parts.append(canonical_columns(lines.csv(files)))
    texts = [p.select(*[p[c].cast("string").alias(c) for c in p.columns]) for p in parts]
    return reduce(DataFrame.unionByName, texts)


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Read a source by its file type."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "xlsx":
        return read_xlsx(spark, path)
    if kind == "xls":
        raise SourceError(f"legacy binary workbooks are not supported: {path}")
    if kind == "parquet":
        return spark.read.parquet(path)
    return read_csv(spark, path)
