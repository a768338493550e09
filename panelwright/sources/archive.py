"""The ``archive`` data source: delimited members of zip archives, read in parallel.

Members are packed into partitions by their compressed bytes, in the order of the archives and of their directories: a
task opens an archive once and reads its run of members, each decompressed and parsed as a stream of Arrow batches with
the types the reader was given. The directories themselves are read in tasks by ``listing``, so that the driver
opens no archive. A path that is no zip archive is read as one plain delimited file.

Options: ``root`` folder; ``members`` JSON list of [archive, member] pairs below it, or ``archives`` JSON list of
globs with ``memberPrefix``, or ``packs``, members that were listed and packed before; ``slots``, the tasks to pack members
for that the reader lists itself; ``skipLines`` before the header; ``separator``; ``trailer``, a marker line to drop.
Schema columns are looked up by name in each member's header. One that it lacks fails the read, unless the JSON list
``optional`` names it; then it is null. The columns ``_archive``, ``_member`` and ``_line`` (rows before it in the member)
give a row's origin when the schema names them.
"""

from __future__ import annotations

import csv
import glob
import hashlib
import io
import json
import os
import sys
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from datetime import date
from itertools import groupby

import pyarrow as pa
from pyarrow import csv as pa_csv
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from panelwright.session import ship_package
from panelwright.specs import ARRIVAL, END_OF_FILE, DatasetSpec

#: Most compressed bytes of a partition, unless one member is larger; what opening a member counts for.
PACK_BYTES, OPEN_BYTES = 16 << 20, 16 << 10
#: Bytes of a member that are read and parsed at once.
CHUNK_BYTES = 4 << 20
#: Rows of small members that are handed on together.
_TOGETHER = 1 << 15

#: An archive, a member (none: a plain file), and its compressed bytes.
Sized = tuple[str, str | None, int]


class Pack(InputPartition):
    """Members that one task reads, one after the other."""

    def __init__(self, members: list[tuple[str, str | None]]):
        super().__init__(members)
        self.members = members
        self.archive = members[0][0]


def pack(members: Iterable[Sized], slots: int) -> list[list[tuple[str, str | None]]]:
    """Runs of successive members of about equal bytes: at least one run per slot if there are as many members, none of
    more than ``PACK_BYTES`` unless it is one member."""
    members = list(members)
    total = sum(size + OPEN_BYTES for *_, size in members)
    most = min(PACK_BYTES, total / max(slots, 1))
    packs, filled = [], 0.0
    for archive, member, size in members:
        if not packs or filled + size + OPEN_BYTES > most:
            packs.append([])
            filled = 0.0
        packs[-1].append((archive, member))
        filled += size + OPEN_BYTES
    return packs


def directory(path: str, prefix: str = "", only: str | None = None) -> list[Sized]:
    """Members of an archive with a prefix, or one by name, from the archive's directory alone; in its order.

    A member that is not there is listed all the same, so that reading it fails.
    """
    if not zipfile.is_zipfile(path):
        return [(path, None, os.path.getsize(path))]
    with zipfile.ZipFile(path) as archive:
        if only is not None:
            return [(path, only, archive.getinfo(only).compress_size if only in archive.NameToInfo else 0)]
        return [(path, i.filename, i.compress_size) for i in archive.infolist() if i.filename.startswith(prefix)]


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        raise ValueError("give the reader a schema: raw files are read with declared types only")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return ArchiveStreamReader(schema, dict(self.options))


class _Reading:
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema = schema
        self.options = {k.lower(): v for k, v in options.items()}

    def _option(self, name: str, default: str = "") -> str:
        return self.options.get(name.lower(), default)

    def _path(self, archive: str) -> str:
        return os.path.join(self._option("root"), archive)

    def _archives(self) -> list[str]:
        found = {p for pattern in json.loads(self._option("archives", "[]")) for p in glob.glob(self._path(pattern))}
        return sorted(found)

    def _packs(self, members: Iterable[Sized]) -> list[Pack]:
        members = list(members)
        slots = int(self._option("slots", "0")) or len(members)
        return [Pack(p) for p in pack(members, slots)]

    def _read(self, part: Pack) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for path, run in groupby(part.members, key=lambda m: m[0]):
            names = [name for _, name in run]
            if names == [None]:
                with open(path, "rb") as stream:
                    yield from self._batches(stream, path, "")
                continue
            with zipfile.ZipFile(path) as archive:
                for name in names:
                    with archive.open(name) as stream:
                        for batch in self._batches(stream, path, name):
                            held.append(batch)
                            if sum(b.num_rows for b in held) >= _TOGETHER:
                                yield from _joined(held)
                                held = []
        yield from _joined(held)

    def _batches(self, stream, path: str, member: str) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        wanted = [f for f in target if f.name not in ARRIVAL]
        marker = self._option("trailer", END_OF_FILE)

        def on_odd_row(row) -> str:
            # the marker line has fewer fields than the header; any other odd row is damage
            return "skip" if row.text is not None and row.text.startswith(marker) else "error"

        stream = io.BufferedReader(stream)
        for _ in range(int(self._option("skipLines", "0"))):
            stream.readline()
        line = stream.readline().decode("utf-8-sig").rstrip("\r\n")
        header = next(csv.reader([line], delimiter=self._option("separator", "|")), [])
        optional = json.loads(self._option("optional", "[]"))
        lacking = [f.name for f in wanted if f.name not in header and f.name not in optional]
        if lacking:
            raise ValueError(f"{path} {member}: no column {lacking} in {header}")
        if not stream.peek(1):
            return
        # a chunk at a time: a streaming reader reads on by up to 32 blocks while its last batch is in use
        line = 0
        for chunk in _line_chunks(stream):
            batch = pa_csv.read_csv(
                pa.BufferReader(chunk),
                read_options=pa_csv.ReadOptions(use_threads=False, column_names=header, block_size=len(chunk) + 1),
                parse_options=pa_csv.ParseOptions(delimiter=self._option("separator", "|"), invalid_row_handler=on_odd_row),
                convert_options=pa_csv.ConvertOptions(
                    column_types={f.name: f.type for f in wanted},
                    include_columns=[f.name for f in wanted],
                    include_missing_columns=True,
                    null_values=[""],
                    strings_can_be_null=True,
                ),
            )
            n = batch.num_rows
            origin = {
                "_archive": lambda: pa.repeat(pa.scalar(os.path.basename(path)), n),
                "_member": lambda: pa.repeat(pa.scalar(member), n),
                "_line": lambda: pa.array(range(line, line + n), pa.int64()),
            }
            arrays = [
                origin[f.name]() if f.name in ARRIVAL else batch.column(batch.schema.get_field_index(f.name)).combine_chunks().cast(f.type)
                for f in target
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
            line += n


def _line_chunks(stream) -> Iterator[bytes]:
    """The rest of a stream as runs of whole lines of about ``CHUNK_BYTES``; a longer line comes whole, empty lines alone do not come."""
    held: list[bytes] = []
    while data := stream.read(CHUNK_BYTES):
        if end := data.rfind(b"\n") + 1:
            chunk, held = b"".join([*held, data[:end]]), [data[end:]]
            if chunk.strip(b"\r\n"):
                yield chunk
        else:
            held.append(data)
    chunk = b"".join(held)
    if chunk.strip(b"\r\n"):
        yield chunk


def _joined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Small batches as one."""
    return pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else []


class ArchiveReader(_Reading, DataSourceReader):
    def partitions(self) -> Sequence[Pack]:
        packed = json.loads(self._option("packs", "[]"))
        if packed:
            return [Pack([(path, name) for path, name in p]) for p in packed]
        named = json.loads(self._option("members", "[]"))
        if named:
            # an archive that is not there is skipped; a member that is not there fails the read
            found = [(self._path(a), m) for a, m in named if os.path.exists(self._path(a))]
            return self._packs(x for path, m in found for x in directory(path, only=m))
        return self._packs(x for path in self._archives() for x in directory(path, self._option("memberPrefix")))

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition is None else self._read(partition)


class ArchiveStreamReader(_Reading, DataSourceStreamReader):
    """Archives that are new or changed since the offset, by their names, sizes and times.

    So a corrected archive of the same name is read again, and one that arrives late with an old time stamp is read at all.
    With the option ``log``, a folder that lives as long as the stream, an offset is the digest of a state and the log has
    the states themselves: what a batch writes does not grow with the archives ever seen. A committed state replaces those before
    it. Without a log the offset is the state.
    """

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        state = {p: [s.st_size, s.st_mtime_ns] for p, s in ((p, os.stat(p)) for p in self._archives())}
        log = self._option("log")
        if not log or not state:
            return state
        text = json.dumps(state, sort_keys=True)
        digest = hashlib.sha256(text.encode()).hexdigest()
        path = os.path.join(log, f"{digest}.json")
        if not os.path.exists(path):
            os.makedirs(log, exist_ok=True)
            part = f"{path}.{os.getpid()}.part"
            with open(part, "w") as out:
                out.write(text)
            os.replace(part, path)
        return {"state": digest}

    def _state(self, offset: dict) -> dict:
        if not self._option("log") or not offset:
            return offset
        with open(os.path.join(self._option("log"), f"{offset['state']}.json")) as found:
            return json.load(found)

    def partitions(self, start: dict, end: dict) -> Sequence[Pack]:
        before, after = self._state(start), self._state(end)
        fresh = sorted(p for p in after if after[p] != before.get(p))
        return self._packs(x for path in fresh for x in directory(path, self._option("memberPrefix")))

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        return self._read(partition)

    def commit(self, end: dict) -> None:
        """Older states are not asked for again: the next batch starts from this one."""
        log = self._option("log")
        if log and end:
            kept = os.path.join(log, f"{end['state']}.json")
            written = os.stat(kept).st_mtime_ns
            for path in glob.glob(os.path.join(glob.escape(log), "*.json")):
                if path != kept and os.stat(path).st_mtime_ns < written:
                    os.remove(path)


def register(spark: SparkSession) -> None:
    """Make the source known. It is pickled by value: the process that plans a stream sees no shipped files."""
    ship_package(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ArchiveSource)


def listing(spark: SparkSession, root: str, wanted: Sequence[tuple[str, str, str | None]]) -> list[list[Sized]]:
    """For each (glob of archives, prefix of members, member by name or none) the members that are there.

    The globs are looked up and the directories read in tasks. The driver gets one narrow row per member, as it does per
    file of any table.
    """
    register(spark)
    rows = [(i, *w) for i, w in enumerate(wanted)]
    slots = max(1, min(len(rows), spark.sparkContext.defaultParallelism))
    # dealt by position: one glob may stand for many archives
    asked = spark.createDataFrame(rows, "i int, pattern string, prefix string, only string").repartitionByRange(slots, "i")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                paths = sorted(glob.glob(os.path.join(glob.escape(root), row["pattern"])))
                members = (m for path in paths for m in directory(path, row["prefix"], row["only"]))
                found += [(row["i"], k, *m) for k, m in enumerate(members)]
            columns = list(zip(*found)) if found else [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["i", "k", "archive", "member", "size"])

    result: list[list[Sized]] = [[] for _ in wanted]
    for r in sorted(asked.mapInArrow(look, "i int, k int, archive string, member string, size long").collect()):
        result[r.i].append((r.archive, r.member, r.size))
    return result


def _scan(spark: SparkSession, root: str, spec: DatasetSpec, members: Iterable[Sized], origin: bool = False) -> DataFrame:
    packs = pack(members, spark.sparkContext.defaultParallelism)
    schema = with_origin(spec.raw) if origin else spec.raw
    if not packs:
        return spark.createDataFrame([], schema)
    register(spark)
    reader = spark.read.format("archive").schema(schema).option("root", root).option("skipLines", spec.skip_lines)
    return reader.option("packs", json.dumps(packs)).load()


def with_origin(schema: T.StructType) -> T.StructType:
    """The schema with the columns that tell where a row stands."""
    origin = [T.StructField(n, T.LongType() if n == "_line" else T.StringType()) for n in ARRIVAL]
    return T.StructType([*schema.fields, *origin])


def _of_sessions(spark: SparkSession, root: str, spec: DatasetSpec, sessions: Sequence[date]) -> list[list[Sized]]:
    return listing(spark, root, [(glob.escape(spec.daily_archive(s)), "", spec.daily_member(s)) for s in sessions])


def scan_sessions(spark: SparkSession, root: str, spec: DatasetSpec, sessions: Sequence[date], origin: bool = False) -> DataFrame:
    """One member per session; sessions without an archive are skipped, none at all is an error."""
    found = [m for members in _of_sessions(spark, root, spec, sessions) for m in members]
    if not found:
        raise FileNotFoundError(f"no archive of {spec.name} for {len(sessions)} sessions below {root}")
    return _scan(spark, root, spec, found, origin)


def scan_latest(spark: SparkSession, root: str, spec: DatasetSpec, sessions: Sequence[date], origin: bool = False) -> DataFrame:
    """The newest of the sessions that has an archive; an empty frame if none has."""
    in_order = sorted(sessions)
    there = [members for members in _of_sessions(spark, root, spec, in_order) if members]
    return _scan(spark, root, spec, there[-1] if there else [], origin)


def scan_history(spark: SparkSession, root: str, spec: DatasetSpec, years: Sequence[int], origin: bool = False) -> DataFrame:
    """All members of the dataset in the archives of the years, in one scan; each year must have one."""
    found = listing(spark, root, [(spec.history_archives(y), spec.member, None) for y in years])
    for year, members in zip(years, found):
        if not members and not glob.glob(os.path.join(glob.escape(root), spec.history_archives(year))):
            raise FileNotFoundError(f"no history archive of {spec.name} for {year} below {root}")
    # a name may hold two of the years
    return _scan(spark, root, spec, dict.fromkeys(m for members in found for m in members), origin)


def scan_text(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, skip_lines: int = 0, optional: Sequence[str] = ()
) -> DataFrame:
    """Unzipped delimited files of the same layout; ``optional`` columns may be absent from a file."""
    register(spark)
    reader = spark.read.format("archive").schema(schema).option("skipLines", skip_lines)
    reader = reader.option("optional", json.dumps(list(optional)))
    return reader.option("archives", json.dumps(list(paths))).load()


def stream_daily(spark: SparkSession, root: str, spec: DatasetSpec, log: str = "", origin: bool = False) -> DataFrame:
    """Stream of the daily archives of a dataset, new and corrected ones; ``log`` is the folder of its states."""
    register(spark)
    pattern = f"{spec.daily_folder}/{spec.daily_zip}_{'[0-9]' * 6}.zip"
    return (
        spark.readStream.format("archive")
        .schema(with_origin(spec.raw) if origin else spec.raw)
        .option("root", root)
        .option("log", log)
        .option("archives", json.dumps([pattern]))
        .option("memberPrefix", spec.member + ".")
        .option("skipLines", spec.skip_lines)
        .option("slots", spark.sparkContext.defaultParallelism)
        .load()
    )
