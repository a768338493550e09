"""Year-partitioned Parquet tables kept current by keyed updates.

A write replaces only the files that may hold one of its keys: new ones are written aside, moved in, and put in force by the
next numbered list of the table's files (``files``). So a job may read the table it rewrites, a failed job leaves it as it was,
and of two writers that started from one state the later fails. Files are ranges of the keys, date first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.files import File, FileList, Files, as_key, days_of, key_order
from panelwright.functions.frames import check_unique, require_columns
from panelwright.functions.scalars import quoted
from panelwright.operators.asof import RightSide, asof_update_many
from panelwright.operators.skew import ROWS_PER_RANGE
from panelwright.operators.keyed import dedupe_latest, update, upsert
from panelwright.session import Staging
from panelwright.specs import ARRIVAL, DATABASES, TableSpec

YEAR = "year"
#: File beside the years that names added columns; readers of the data skip names that start so.
_ADDED = "_added_columns.json"
#: Folder beside the tables for the steps that are done.
_STEPS = "_steps"


@dataclass(frozen=True)
class Change:
    """Rows for one table: ``insert`` adds unknown keys, otherwise they are left out.

    ``unique`` says that no key repeats, as after a pivot, and saves the shuffle that would see to it.
    """

    rows: DataFrame
    insert: bool
    keys: tuple[str, ...] | None = None
    unique: bool = False


class PanelStore:
    """The tables below ``root/database``. ``rows_per_file`` bounds what a small change has to rewrite."""

    def __init__(self, spark: SparkSession, root: str, database: str = "development", rows_per_file: int = 4_000_000):
        if database not in DATABASES:
            raise ValueError(f"database must be one of {DATABASES}, not {database!r}")
        self.spark = spark
        self.base = f"{root.rstrip('/')}/{database}"
        self.rows_per_file = rows_per_file

    def path(self, spec: TableSpec) -> str:
        return f"{self.base}/{spec.name}"

    def read(self, spec: TableSpec, years: int | Iterable[int] | None = None) -> DataFrame:
        """The table, or some years of it; an empty typed frame where nothing is stored."""
        frame = self._stored(self.stored_spec(spec), years)
        return frame.drop(YEAR)

    def years(self, spec: TableSpec) -> list[int]:
        """Years stored, from the list of files, or from partition names where there is none."""
        files = Files(self.spark, self.path(spec))
        known = files.latest()
        if known is not None:
            return sorted({f.year for f in known.files})
        if not files.exists():
            return []
        names = [s.getPath().getName() for s in files.fs.listStatus(files._path(files.root))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{YEAR}="))

    def file_names(self, spec: TableSpec) -> list[str]:
        """Files in force, below the table's folder."""
        return [f.path for f in self._files(spec)[0].files]

    def exists(self, spec: TableSpec, year: int) -> bool:
        return year in self.years(spec)

    def create_if_not_exists(self, spec: TableSpec) -> None:
        """An empty table folder, read as an empty typed frame; years come with their first row."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(spec))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def upsert(self, spec: TableSpec, rows: DataFrame, on_repeat: str = "latest", unique: bool = False) -> None:
        self.apply(spec, [Change(rows, insert=True, unique=unique)], on_repeat)

    def update(
        self,
        spec: TableSpec,
        rows: DataFrame,
        keys: Sequence[str] | None = None,
        on_repeat: str = "latest",
        unique: bool = False,
    ) -> None:
        self.apply(spec, [Change(rows, False, tuple(keys) if keys else None, unique)], on_repeat)

    def apply(self, spec: TableSpec, changes: Sequence[Change], on_repeat: str = "latest") -> None:
        """Apply changes in order and rewrite once the files that may hold their keys.

        Repeated keys in a change: ``latest`` keeps the row that arrived last if the rows tell (``ARRIVAL`` columns), else the
        greatest one; ``error`` fails. A null in a key column or the date fails before anything is written. Columns that an as-of update added earlier stay.
        """
        with Staging(self.spark) as staging:
            frames = staging.put_all([_known(spec, c.rows) for c in changes])
            staged = [replace(c, rows=f, keys=c.keys or spec.keys) for c, f in zip(changes, frames)]
            spec = self.stored_spec(spec)
            base, order = self._files(spec)
            touched: set[str] = set()
            for change in staged:
                touched |= base.reached(_reach(change.rows, change.keys, order))
                if on_repeat == "error" and not change.unique:
                    check_unique(change.rows, change.keys)
            if not touched and not any(c.insert and not c.rows.isEmpty() for c in staged):
                return
            merged = self._of(spec, [f for f in base.files if f.path in touched]).drop(YEAR)
            for change in staged:
                rows = change.rows
                if on_repeat == "latest" and not change.unique:
                    rows = dedupe_latest(rows, change.keys, [c for c in ARRIVAL if c in rows.columns])
                merged = (upsert if change.insert else update)(merged, rows, change.keys)
            self._rewrite(spec, base, touched, merged)

    def update_asof(
        self,
        spec: TableSpec,
        rights: Sequence[RightSide],
        by: str | Sequence[str],
        left_on: str = "date",
        strategy: str = "backward",
        years: Iterable[int] | None = None,
        only_changed: bool = True,
    ) -> TableSpec:
        """As-of updates of the stored rows of ``years`` (default all), in one pass and one rewrite.

        Right-only columns widen the table; the widened spec is returned. The join runs once, over keys and the columns
        concerned; its rows are staged and put into their years by key. ``only_changed`` keeps only rows in which some value
        changes, so that other files are not rewritten.
        """
        by = [by] if isinstance(by, str) else list(by)
        years = sorted(set(self.years(spec)) & set(self.years(spec) if years is None else years))
        fields = [
            f for r in rights for f in r.frame.schema.fields if f.name not in {*by, left_on, r.time, *r.drop}
        ]
        wider = self.stored_spec(spec).widened(fields)
        with Staging(self.spark) as staging:
            frames = staging.put_all([r.frame for r in rights])
            rights = [replace(r, frame=f) for r, f in zip(rights, frames)]

            # where ``by`` and the time are the whole key, it bounds the rows per asset to one per session
            whole = set(spec.keys) <= {*by, left_on}
            concerned = list(dict.fromkeys(f.name for f in fields))
            now = F.struct(*map(quoted, concerned))
            narrow = list(dict.fromkeys([*spec.keys, *by, left_on]))
            base, order = self._files(wider)
            stored = self._of(wider, base.of_years(years)).select(*map(quoted, narrow), *map(quoted, concerned), now.alias("__before"))
            updated = asof_update_many(stored, rights, left_on, by, strategy, None if whole else ROWS_PER_RANGE)
            if only_changed:
                updated = updated.where(~F.col("__before").eqNullSafe(now))
            changed = staging.put(updated.select(*map(quoted, dict.fromkeys([*spec.keys, *concerned]))))
            touched = base.reached(_reach(changed, spec.keys, order)) if years else set()
            if touched:
                self._keep_columns(wider, spec)
                merged = update(self._of(wider, [f for f in base.files if f.path in touched]).drop(YEAR), changed, spec.keys)
                self._rewrite(wider, base, touched, merged)
        return wider

    def _files(self, spec: TableSpec) -> tuple[FileList, list[str]]:
        """The table's files as they are now, and the keys they are ordered by."""
        order = key_order(spec.keys, spec.schema)
        return Files(self.spark, self.path(spec)).current(order, _with_year(spec)), order

    def _rewrite(self, spec: TableSpec, base: FileList, touched: set[str], rows: DataFrame) -> None:
        """Put the rows in place of the touched files.

        Tasks get ranges of the keys, so files do not overlap in any but the years they were cut at, and files and row groups can
        be skipped. Adaptive execution joins small ranges.
        """
        require_columns(rows, spec.columns)
        placed = rows.select(*map(quoted, spec.columns)).withColumn(YEAR, F.year("date"))
        by = list(map(quoted, dict.fromkeys(["date", *spec.keys])))
        folder = f"{self.path(spec)}/_new-{uuid.uuid4().hex}"
        writer = placed.repartitionByRange(*by).sortWithinPartitions(YEAR, *by).write
        files = Files(self.spark, self.path(spec))
        try:
            writer.option("maxRecordsPerFile", self.rows_per_file).partitionBy(YEAR).parquet(folder)
            files.switch(base, touched, folder, key_order(spec.keys, spec.schema), _with_year(spec))
        finally:
            files.remove(folder)

    def stored_spec(self, spec: TableSpec) -> TableSpec:
        """The declared table with the columns that as-of updates have added to the stored one."""
        fs, path = self._file(spec, _ADDED)
        if not fs.exists(path):
            return spec
        stream = fs.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return spec.widened(T.StructType.fromJson(json.loads(text)).fields)

    def _keep_columns(self, wider: TableSpec, declared: TableSpec) -> None:
        """Note the columns beyond the declared ones beside the years."""
        added = [f for f in wider.schema.fields if f.name not in declared.columns]
        if added:
            fs, path = self._file(declared, _ADDED)
            stream = fs.create(path, True)
            stream.write(bytearray(T.StructType(added).json().encode()))
            stream.close()

    def _file(self, spec: TableSpec, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(spec), name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def is_noted(self, run: str, step: str) -> bool:
        """Whether a step of a run is done."""
        fs, path = self._step(run, step)
        return fs.exists(path)

    def note(self, run: str, step: str) -> None:
        """An empty file that says that a step of a run is done."""
        fs, path = self._step(run, step)
        fs.create(path, True).close()

    def _step(self, run: str, step: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{_STEPS}/{run}", step)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def between(self, spec: TableSpec, start: date, end: date) -> DataFrame:
        """Rows of a date range; only files that reach into it are opened."""
        spec = self.stored_spec(spec)
        known = Files(self.spark, self.path(spec)).latest()
        if known is None:
            frame = self._stored(spec, None)
        else:
            reached = known.reached([days_of(start, end)])
            frame = self._of(spec, [f for f in known.files if f.path in reached])
        frame = frame.where(F.col(YEAR).between(start.year, end.year))
        return frame.where(F.col("date").between(F.lit(start), F.lit(end))).drop(YEAR)

    def _of(self, spec: TableSpec, files: Sequence[File]) -> DataFrame:
        return Files(self.spark, self.path(spec)).read(files, _with_year(spec))

    def _stored(self, spec: TableSpec, years: int | Iterable[int] | None) -> DataFrame:
        wanted = None if years is None else [years] if isinstance(years, int) else sorted(set(years))
        files = Files(self.spark, self.path(spec))
        known = files.latest()
        if known is not None:
            return files.read(known.of_years(wanted), _with_year(spec))
        if not files.exists():
            return self.spark.createDataFrame([], _with_year(spec))
        frame = self.spark.read.schema(_with_year(spec)).parquet(self.path(spec))
        return frame if wanted is None else frame.where(F.col(YEAR).isin(*wanted))


def _with_year(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.schema.fields, T.StructField(YEAR, T.IntegerType())])


def _known(spec: TableSpec, rows: DataFrame) -> DataFrame:
    """The columns of the table that the rows have, with its types, and where the rows come from."""
    require_columns(rows, [*spec.keys])
    known = [quoted(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name in rows.columns]
    return rows.select(known + [quoted(c) for c in ARRIVAL if c in rows.columns and c not in spec.columns])


def _reach(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[tuple[list, list]]:
    """Ranges of the keys in force: from the least to the greatest of each day. Fails if a key or the date is null.

    One row per day comes here. Where the keys leave the date out, rows reach all days of their years.
    """
    names = list(dict.fromkeys([*keys, "date"]))
    null = F.bool_or(reduce(or_, [quoted(k).isNull() for k in names])).alias("null")
    known = [c for c in order if c in keys or c == "date"]
    if "date" in keys and known == list(order[: len(known)]):
        key = F.struct(*map(quoted, known))
        found = rows.groupBy("date").agg(null, F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    else:
        found = rows.groupBy(F.year("date").alias("y")).agg(null).collect()
    if any(r["null"] for r in found):
        raise ValueError(f"null key in {names}")
    if found and "y" in found[0]:
        return [days_of(date(r["y"], 1, 1), date(r["y"], 12, 31)) for r in found]
    # a shorter key comes before all that begin so; with a last part beyond all others it comes after them
    whole = len(known) == len(order)
    return [(as_key(r["lo"]), as_key(r["hi"])) if whole else days_of(r["date"], r["date"]) for r in found]
