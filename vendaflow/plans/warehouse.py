"""Loading and versioning the warehouse."""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from vendaflow.errors import LoadError, Overtaken
from vendaflow.operators.dimensions import first_seen, merge
from vendaflow.operators.fact import FOREIGN_KEYS, build_fact, key_spans, number_sales, value_edges, value_spans
from vendaflow.operators.joins import BROADCAST_BYTES, Sized, hot_keys, row_bytes
from vendaflow.operators.staging import PROBLEMS, stage, unfit
from vendaflow.plans.layout import (
    FILE_ROWS, Zones, axes, carried, clustered, stored_schema, with_places, write_zones,
)
from vendaflow.plans.ranking import most_namesakes
from vendaflow.plans.rebase import OLD, new_keys, rebased, relabel
from vendaflow.plans.star import Star
from vendaflow.schema import DIM_CLIENTE, DIM_PRODUTO, DIMENSIONS, FATO_VENDAS, ROLES, TABLES, Table
from vendaflow.session import (
    COMPRESSION, create_file, delete_file, file_age, list_folders, path_exists, scratch_path, writing,
)

PATIENCE = 120  # seconds from the claim of a load's number to its publication, a small file later
MANIFEST = (
    "load bigint, id string, name string, path string, rows bigint, bytes bigint, "
    "hot map<bigint, double>"
)


@dataclass
class LoadSummary:
    extracted: int
    loaded: int
    rejected: int
    members: dict[str, int] = field(default_factory=dict)


class Warehouse:
    """Five dimensions and a fact as Parquet files under one folder.

    A load writes every table to a new folder and then appends one small file that names
    them all. Readers follow the newest such file, so a load shows up whole or not at all
    and a failed one changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        broadcast_bytes: int = BROADCAST_BYTES,
        file_rows: int = FILE_ROWS,
        patience: float = PATIENCE,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.limit = broadcast_bytes
        self.file_rows = file_rows
        self.patience = patience
        self._known_zones: dict[str, Zones] = {}
        self.staged: DataFrame | None = None  # the good rows of the last load by this object

    # -- reading -------------------------------------------------------------------

    def entries(self) -> list[Row]:
        """Name, path and size of each table of the newest load, dimensions first, the fact
        last; empty before the first load."""
        log = f"{self.root}/loads"
        if not path_exists(self.spark, log):
            return []
        manifest = self.spark.read.schema(MANIFEST).parquet(log)
        newest = manifest.groupBy("load").agg(F.collect_list(F.struct("*")).alias("tables"))
        found = newest.orderBy(F.desc("load")).limit(1).select(F.inline("tables")).collect()
        return sorted(found, key=lambda e: list(TABLES).index(e["name"]))

    def tables(self) -> dict[str, Sized]:
        """The tables of the newest load; empty before the first."""
        return self._sized(self.entries())

    def _sized(self, entries: list[Row]) -> dict[str, Sized]:
        return {
            e["name"]: Sized(self._read(e["name"], e.path), e.rows, e.bytes, e.hot or {})
            for e in entries
        }

    def star(self) -> Star:
        entries = self.entries()
        if not entries:
            raise LoadError(f"nothing has been loaded into {self.root}")
        zones = self._zones(entries[-1].path)
        return Star(self._sized(entries), self.limit, zones, self._namesakes(entries))

    def _namesakes(self, entries: list[Row]) -> dict[str, int]:
        """The most products of one name, where the load counted them."""
        found = {}
        for e in entries:
            path = self._namesakes_path(e.path)
            if e["name"] == DIM_PRODUTO.name and e.bytes > self.limit and path_exists(self.spark, path):
                found[e["name"]] = self.spark.read.schema("most bigint").parquet(path).first()["most"]
        return found

    def _namesakes_path(self, path: str) -> str:
        return f"{self.root}/namesakes/{path.rsplit('/', 1)[-1]}"

    def _count_namesakes(self, path: str, size: int) -> None:
        """Kept beside products that reports cannot broadcast, for their rankings."""
        if size > self.limit:
            most = most_namesakes(self._read(DIM_PRODUTO.name, path), DIM_PRODUTO.attributes)
            counted = self.spark.createDataFrame([(most,)], "most bigint").coalesce(1)
            counted.write.mode("overwrite").parquet(self._namesakes_path(path))

    def _zones(self, fact_path: str) -> Zones | None:
        """The ranges of the fact's files; None for a load that has none."""
        if fact_path not in self._known_zones:
            path = self._zones_path(fact_path)
            if not path_exists(self.spark, path):
                return None
            self._known_zones[fact_path] = Zones(self.spark.read.parquet(path), fact_path)
        return self._known_zones[fact_path]

    def _zones_path(self, fact_path: str) -> str:
        return f"{self.root}/zones/{fact_path.rsplit('/', 1)[-1]}"

    def ready(self) -> bool:
        """Whether the fact holds any row."""
        tables = self.tables()
        return bool(tables) and not tables["fato_vendas"].df.isEmpty()

    def _read(self, name: str, path: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name].struct).parquet(path)

    # -- writing -------------------------------------------------------------------

    def create(self) -> None:
        """Publish empty tables if nothing has been loaded yet."""
        if not self.entries():
            load_id = uuid.uuid4().hex
            written = {}
            for name, table in TABLES.items():
                empty = self.spark.createDataFrame([], table.struct)
                written[name] = self._write(empty, name, load_id)
            self._publish(written, load_id, 1)

    def load(self, source: DataFrame, strict: bool = True) -> LoadSummary:
        """Merge the dimensions, replace the fact, publish both together.

        If another load was published meanwhile, this one is moved onto it: members of both
        stay, and the fact and the attributes are those of the later, as if the loads had
        run in turn.

        Strict: any unfit row stops the load. Otherwise unfit rows go to the folder
        `rejected` and the rest is loaded.
        """
        load_id = uuid.uuid4().hex
        staged, extracted, rejected, undescribed, values = self._stage(source)
        good, bad = staged.filter(~unfit(F.col(PROBLEMS))), staged.filter(unfit(F.col(PROBLEMS)))
        if undescribed:
            good, lost = self._without_unfit_members(good)
            if lost is not None:
                rejected += lost.count()
                bad = bad.unionByName(lost)
        if rejected:
            if strict:
                raise LoadError(f"{rejected} unfit rows, for example: {_examples(bad)}")
            bad.write.parquet(f"{self.root}/rejected/{load_id}")
        good = self.staged = good.drop(PROBLEMS)

        published = self.entries()
        number = max((e.load for e in published), default=0) + 1
        before = self._sized(published)

        def write_dimension(table: Table) -> tuple[str, int, int]:
            old = before[table.name].df if table.name in before else None
            return self._write(merge(old, good, table), table.name, load_id)

        # Independent jobs over the staged rows: started together, so that the tail of one
        # does not leave the cluster idle.
        with ThreadPoolExecutor(len(DIMENSIONS) + 1) as pool:
            numbering = pool.submit(number_sales, good)
            writes = [pool.submit(write_dimension, t) for t in DIMENSIONS]
            written = {t.name: w.result() for t, w in zip(DIMENSIONS, writes)}
            numbered = numbering.result()

        dims = {n: Sized(self._read(n, p), rows, size) for n, (p, rows, size) in written.items()}
        placed = with_places(dims)
        spans = key_spans(placed, carried()) | values
        fact = build_fact(numbered, placed, self.limit, carried(), spans)
        years = -(-dims["dim_tempo"].rows // 366)
        fact = clustered(fact, axes(dims), spans, extracted, years, self.file_rows)
        written["fato_vendas"] = self._write_fact(fact, load_id)
        while not self._published(written, load_id, number):
            newer = self._newer(number)
            written, load_id = self._rebase(written, published, newer)
            published, number = newer, newer[0].load + 1
        return LoadSummary(
            extracted, written["fato_vendas"][1], rejected,
            {n: rows for n, (_, rows, _) in written.items() if n != "fato_vendas"},
        )

    def _published(
        self, written: dict[str, tuple[str, int, int]], load_id: str, number: int
    ) -> bool:
        dims = {t.name: Sized(None, *written[t.name][1:]) for t in DIMENSIONS}
        path, _, size = written[DIM_PRODUTO.name]
        self._count_namesakes(path, size)
        try:
            self._publish(written, load_id, number, self._hot(dims, written["fato_vendas"][0]))
        except Overtaken:
            return False
        return True

    def _newer(self, number: int) -> list[Row]:
        """The newest load, once it is `number` or later."""
        end = time.monotonic() + self.patience
        while True:
            found = self.entries()
            if found and found[0].load >= number:
                return found
            if time.monotonic() > end:
                raise LoadError(
                    f"load {number} was claimed but not published within {self.patience} s; "
                    "if it has died, release it, then load again"
                )
            time.sleep(min(1.0, self.patience))

    def _rebase(
        self, written: dict[str, tuple[str, int, int]], base: list[Row], newer: list[Row]
    ) -> tuple[dict[str, tuple[str, int, int]], str]:
        """The tables of a load built on `base`, moved onto the `newer` load.

        The source is not read again, and the fact is written again only if a key in it
        changes. What the load wrote before is left to `vacuum`.
        """
        load_id = uuid.uuid4().hex
        last = {e["name"]: e.rows for e in base}  # keys are dense, so this is the last one, too
        theirs = self._sized(newer)
        path, rows, size = written[FATO_VENDAS.name]
        fact = self.spark.read.schema(stored_schema()).parquet(path)

        def move(table: Table) -> tuple[tuple[str, int, int], Sized]:
            mine, common = self._read(table.name, written[table.name][0]), last.get(table.name, 0)
            found = new_keys(mine, theirs[table.name], table, common)
            seen, place = Observation(), scratch_path(self.spark, f"rebase-{table.name}")
            changed = F.col(OLD) != F.col(table.key)
            found.observe(seen, F.count_if(changed).alias("moved")).write.parquet(place)
            settled = self.spark.read.schema(found.schema).parquet(place)
            moved = settled.filter(changed).select(OLD, table.key)
            after = rebased(mine, theirs[table.name], settled, fact, table, common)
            each = 8 * (len(moved.columns) + 3)
            return (
                self._write(after, table.name, load_id),
                Sized(moved, seen.get["moved"], seen.get["moved"] * each),
            )

        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            results = dict(zip((t.name for t in DIMENSIONS), pool.map(move, DIMENSIONS)))
        after = {name: entry for name, (entry, _) in results.items()}
        moved = {name: keys for name, (_, keys) in results.items() if keys.rows}
        after[FATO_VENDAS.name] = (
            self._write_fact(relabel(fact, moved, self.limit), load_id)
            if moved and rows else (path, rows, size)
        )
        return after, load_id

    def _without_unfit_members(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The rows whose product and customer can be described, and the others; None if there are none.

        A member is described by its first row, so a missing or too long name matters there
        and nowhere else. The members that cannot be described are written first: without any,
        the rows are left as they are; many are taken from the rows once, and not by each
        step of the load.
        """
        lost = None
        for table, key in ((DIM_PRODUTO, "product_id"), (DIM_CLIENTE, "customer_id")):
            wrong = F.lit(False)
            for c in table.attributes:
                wrong = wrong | F.col(c).isNull() | (F.length(c) > table.limit(c))
            unknown = first_seen(rows, table).filter(wrong).select(F.col(key).alias(f"_{key}"))
            keys = self._kept(unknown, f"undescribed-{table.name}")
            if not keys.rows:
                continue
            side = F.broadcast(keys.df) if keys.fits(self.limit) else keys.df
            match = rows[key] == side[f"_{key}"]
            hit = rows.join(side, match, "left_semi")
            rows = rows.join(side, match, "left_anti")
            if not keys.fits(self.limit):
                hit, rows = self._kept(hit, "undescribed").df, self._kept(rows, "described").df
            lost = hit if lost is None else lost.unionByName(hit)
        return rows, lost

    def _kept(self, df: DataFrame, label: str) -> Sized:
        """The rows in a scratch folder."""
        path = scratch_path(self.spark, label)
        rows, size = self._write_to(path, df)
        return Sized(self.spark.read.schema(df.schema).parquet(path), rows, size)

    def _stage(self, source: DataFrame) -> tuple[DataFrame, int, int, int, dict[str, tuple[int, int]]]:
        """Parse once into the shared folder; six later steps read only what they need.

        Returns the rows, how many there are, how many are unfit, how many others lack a
        description or have one that is too long, and the lowest and highest of their values.
        """
        staged = stage(source)
        seen = Observation()
        path = scratch_path(self.spark, "staged")
        counted = staged.observe(
            seen, F.count("*").alias("rows"), F.count(PROBLEMS).alias("odd"),
            F.count_if(unfit(F.col(PROBLEMS))).alias("unfit"), *value_edges(staged),
        )
        with writing(self.spark):
            counted.write.parquet(path, compression=COMPRESSION)
        rows, odd, bad = seen.get["rows"], seen.get["odd"], seen.get["unfit"]
        found = self.spark.read.schema(staged.schema).parquet(path)
        return found, rows, bad, odd - bad, value_spans(seen.get)

    def _write(self, df: DataFrame, name: str, load_id: str) -> tuple[str, int, int]:
        path = f"{self.root}/{name}/{load_id}"
        return path, *self._write_to(path, df)

    def _write_to(self, path: str, df: DataFrame) -> tuple[int, int]:
        """Rows written, and their size in a hash relation."""
        seen = Observation()
        size = F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))
        with writing(self.spark):
            df.observe(seen, F.count("*").alias("rows"), size.alias("bytes")).write.parquet(path, compression=COMPRESSION)
        return seen.get["rows"], seen.get["bytes"]

    def _write_fact(self, fact: DataFrame, load_id: str) -> tuple[str, int, int]:
        """Write by order year; a row without all its keys stops the load unpublished."""
        path = f"{self.root}/{FATO_VENDAS.name}/{load_id}"
        seen = Observation()
        misses = [F.count_if(F.col(k).isNull()).alias(k) for k in FOREIGN_KEYS]
        with writing(self.spark):
            (
                fact.observe(seen, F.count("*").alias("rows"), *misses)
                .write.option("maxRecordsPerFile", self.file_rows)
                .partitionBy("ano_pedido")
                .parquet(path, compression=COMPRESSION)
            )
        missing = {k: seen.get[k] for k in FOREIGN_KEYS if seen.get[k]}
        if missing:
            raise LoadError(f"keys not found in their dimension: {missing}")
        rows = seen.get["rows"]
        if rows:
            write_zones(self.spark, path, self._zones_path(path))
        return path, rows, rows * 8 * len(FATO_VENDAS.columns)

    def _hot(self, dims: dict[str, Sized], fact_path: str) -> dict[str, dict[int, float]]:
        """Frequent fact keys of the dimensions that reports cannot broadcast."""
        large = [r for r in ROLES.values() if not dims[r.table.name].fits(self.limit)]
        if not large:
            return {}
        fact = self._read(FATO_VENDAS.name, fact_path)
        found = hot_keys(fact, *[[r.foreign_key] for r in large])
        hot: dict[str, dict[int, float]] = {}
        for role, keys in zip(large, found):
            hot.setdefault(role.table.name, {}).update(keys)
        return hot

    def _publish(
        self,
        written: dict[str, tuple[str, int, int]],
        load_id: str,
        number: int,
        hot: dict[str, dict[int, float]] | None = None,
    ) -> None:
        """Append one file that names all tables of the load.

        `number` follows the load that this one was built on. It is claimed by a file that
        can be created only once, so that of two loads built on the same tables one is
        overtaken instead of hiding the other's members. A claim whose load died before it
        published is released with `release`.
        """
        if not create_file(self.spark, f"{self.root}/claims/{number}"):
            raise Overtaken(f"load {number} is being or has been published by someone else; load again")
        lines = [
            (number, load_id, n, p, rows, size, (hot or {}).get(n, {}))
            for n, (p, rows, size) in written.items()
        ]
        entries = self.spark.createDataFrame(lines, MANIFEST)
        entries.coalesce(1).write.mode("append").parquet(f"{self.root}/loads")

    def release(self) -> None:
        """Give up the claim of a load that was never published, after a crash in between.

        A claim younger than `patience` may belong to a load that is about to publish.
        """
        number = max((e.load for e in self.entries()), default=0) + 1
        claim = f"{self.root}/claims/{number}"
        age = file_age(self.spark, claim)
        if age is not None and age < self.patience:
            raise LoadError(f"load {number} was claimed {age:.0f} s ago and may be alive")
        delete_file(self.spark, claim)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the files of all but the newest `keep` loads, and of loads never published.

        Not while a load is running, nor while someone reads a load that goes. Returns the
        tables' folders that were removed; the ranges, summaries and counts of a load go with it.
        """
        log = f"{self.root}/loads"
        if keep < 1 or not path_exists(self.spark, log):
            return []
        manifest = self.spark.read.schema(MANIFEST).parquet(log)
        numbers = [r.load for r in manifest.select("load").distinct().orderBy(F.desc("load")).limit(keep).collect()]
        kept = {
            r.path for r in manifest.filter(F.col("load").isin(numbers)).select("path").collect()
        }
        gone = []
        for name in [*TABLES, "zones", "summaries", "namesakes"]:
            for path in list_folders(self.spark, f"{self.root}/{name}"):
                if path.rsplit("/", 1)[-1] not in {k.rsplit("/", 1)[-1] for k in kept}:
                    delete_file(self.spark, path)
                    if name in TABLES:
                        gone.append(path)
        return gone


def _examples(bad: DataFrame) -> list[tuple]:
    return [(r.row_id, r[PROBLEMS]) for r in bad.select("row_id", PROBLEMS).limit(5).collect()]
