"""Tables partitioned by snapshot: replacing months as a whole, reading them, listing them.

A write goes to a staging folder inside the table first. Then one small file, the list of
the months it replaces, is put in place by a rename: from that moment on the new months
hold. Only then are month folders renamed, the old ones away and the new ones into place.
Whoever meets the list, a reader or the next write, takes the months on it from staging as
far as they still lie there. So a run that ends at any point leaves all of its months old or
all of them new; the next write finishes the renames and clears what is left over.

This asks for a file system that renames folders as one step, and for one writer per table.
Names that begin with an underscore are no data to Spark, so other readers of the folder see
the renames one by one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions.validity import holds
from siltstone.operators.snapshots import SNAPSHOT, on_snapshots

#: The name that Spark gives to the folder of a null date.
NO_SNAPSHOT = "__HIVE_DEFAULT_PARTITION__"

_STAGING, _SWITCH, _OLD = "_staging-", "_switch-", "_old-"
#: In a staging folder: months as the tasks of a write have left them, until their files are united.
_PARTS = "_parts"

_CODEC = "spark.sql.parquet.compression.codec"
#: Takes a quarter to a third less disk than Spark's default, snappy, and no more time.
CODEC = "zstd"
#: Where the files of a month are smaller than this on average, they are united to files of the second size.
SMALL_FILE, FILE_SIZE = 1 << 20, 64 << 20
#: Months whose files are united at the same time: until one is done, it lies on disk twice.
UNITED_AT_ONCE = 8


class NoSnapshotsError(LookupError):
    """A table has no snapshot where at least one is needed."""


@dataclass(frozen=True)
class WriteCounts:
    """Rows written per month, and rows left out where they were asked for."""

    months: dict[date, int]
    left_out: int | None = None

    @property
    def total(self) -> int:
        return sum(self.months.values())


# ---------------------------------------------------------------- files


class _Files:
    """The folder of a table, through the file system that Spark uses."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder: one listing, no file is opened."""
        if not self.exists(name):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._at(name))]

    def sizes(self, name: str) -> list[int]:
        """The bytes of each data file in a folder."""
        found = self._fs.listStatus(self._at(name))
        return [status.getLen() for status in found if not status.getPath().getName().startswith(("_", "."))]

    def make(self, name: str) -> None:
        self._fs.mkdirs(self._at(name))

    def move(self, name: str, to: str) -> None:
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"could not rename {self.path}/{name} to {to}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _folder(day: date) -> str:
    return f"{SNAPSHOT}={day.isoformat()}"


def _days(names: Iterable[str]) -> list[date]:
    """The dates of month folders among the names, in order."""
    prefix = f"{SNAPSHOT}="
    days = [name.removeprefix(prefix) for name in names if name.startswith(prefix)]
    return sorted(date.fromisoformat(day) for day in days if day != NO_SNAPSHOT)


@dataclass(frozen=True)
class _Switch:
    """Months that hold anew: those with rows lie in staging until they are in place, the others go."""

    name: str
    filled: tuple[date, ...]
    emptied: tuple[date, ...]

    @property
    def staging(self) -> str:
        return _STAGING + self.name

    def text(self) -> str:
        return json.dumps({kind: [d.isoformat() for d in getattr(self, kind)] for kind in ("filled", "emptied")})

    @staticmethod
    def of(files: _Files, name: str) -> _Switch:
        found = json.loads(files.read(_SWITCH + name))
        days = {kind: tuple(date.fromisoformat(d) for d in found[kind]) for kind in ("filled", "emptied")}
        return _Switch(name, days["filled"], days["emptied"])


def _open_switch(files: _Files, names: Sequence[str]) -> _Switch | None:
    """The switch that holds but whose renames may not be through."""
    found = [name.removeprefix(_SWITCH) for name in names if name.startswith(_SWITCH)]
    return _Switch.of(files, found[0]) if found else None


def _finish(files: _Files, switch: _Switch) -> None:
    """Puts the months of a switch into place, from wherever an earlier run has stopped."""
    old = _OLD + switch.name
    files.make(old)
    staged = set(files.names(switch.staging))
    for day in switch.filled:
        folder = _folder(day)
        if folder in staged:
            if files.exists(folder):
                files.move(folder, f"{old}/{folder}")
            files.move(f"{switch.staging}/{folder}", folder)
    for day in switch.emptied:
        if files.exists(_folder(day)):
            files.move(_folder(day), f"{old}/{_folder(day)}")
    files.delete(_SWITCH + switch.name)
    files.delete(old)
    files.delete(switch.staging)


def settle(spark: SparkSession, path: str) -> None:
    """Finishes what an earlier write of the table left undone, and clears what it left over."""
    files = _Files(spark, path)
    if switch := _open_switch(files, files.names()):
        _finish(files, switch)
    for name in files.names():
        if name.startswith((_STAGING, _OLD, f".{_SWITCH}")):
            files.delete(name)


# ---------------------------------------------------------------- the store


def write_snapshots(
    df: DataFrame,
    path: str,
    months: Sequence[date],
    *,
    cluster: bool = True,
    unite: bool = False,
    count_left_out: bool = False,
    file_format: str = "parquet",
    max_records_per_file: int = 0,
) -> WriteCounts:
    """Replaces the given months of the table, all at once, and counts the rows written for each.

    Rows of other dates, or without one, are left out; other months on disk stay
    as they are. A wanted month that gets no rows is removed.

    ``cluster`` shuffles the rows so that each month ends in few, evenly sized
    files; adaptive execution splits a month that is too large for one task.
    Turn it off where the input already lies by month (a narrow plan over
    another snapshot table).

    ``unite``, for Parquet and instead of ``cluster``, suits tables whose rows take far more disk in
    a shuffle than in their files: each task writes its rows of each month, and then
    months of small files (`SMALL_FILE`) are read again and written as few of `FILE_SIZE`.
    No row is shuffled, and only months being united lie on disk twice.

    The rows are counted in the files written, before they hold: in a Parquet file its
    footer tells. So counts are right whatever tasks were run again, and no state is kept
    per month. With ``count_left_out`` the rows of other dates travel to the stage that
    writes, which suits a run over (nearly) all months.
    """
    wanted = list(dict.fromkeys(months))
    if not wanted:
        raise NoSnapshotsError("no months to write")
    if unite and (cluster or file_format != "parquet" or max_records_per_file):
        raise ValueError("unite is for Parquet, without cluster or max_records_per_file")
    spark = df.sparkSession
    belongs = on_snapshots(wanted)
    counters = Observation()
    rows = df if count_left_out else df.where(belongs)
    if cluster:
        rows = rows.hint("rebalance", SNAPSHOT)
    if count_left_out:
        rows = rows.observe(counters, F.count(F.when(~holds(belongs), 1)).alias("left_out")).where(belongs)
    settle(spark, path)
    name = uuid.uuid4().hex
    files = _Files(spark, path)
    staging = f"{files.path}/{_STAGING}{name}"
    writer = rows.write.partitionBy(SNAPSHOT).options(**_codec(spark, file_format))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if file_format == "csv":
        writer = writer.option("header", True)
    parts = f"{_STAGING}{name}/{_PARTS}"
    writer.format(file_format).save(f"{files.path}/{parts}" if unite else staging)
    if unite:
        _unite(spark, files, parts, _STAGING + name, df.drop(SNAPSHOT).schema)
    found = {}
    if _days(files.names(_STAGING + name)):
        staged = _load(spark, staging, df.drop(SNAPSHOT), file_format)
        found = {row[SNAPSHOT]: row["row_count"] for row in snapshot_counts(staged).collect()}
    left_out = counters.get["left_out"] if count_left_out else None
    emptied = tuple(day for day in wanted if day not in found)
    if not found and not set(_days(files.names())) - set(wanted):
        _write_no_rows(df, path, file_format)
    switch = _Switch(name, tuple(found), emptied)
    files.write(f".{_SWITCH}{name}", switch.text())
    files.move(f".{_SWITCH}{name}", _SWITCH + name)  # from here on the new months hold
    _finish(files, switch)
    return WriteCounts({day: found.get(day, 0) for day in wanted}, left_out)


def _codec(spark: SparkSession, file_format: str) -> dict[str, str]:
    """The option for `CODEC`, unless the session sets a codec of its own."""
    return {"compression": CODEC} if file_format == "parquet" and not spark.conf.get(_CODEC, None) else {}


def _unite(spark: SparkSession, files: _Files, parts: str, to: str, schema: StructType) -> None:
    """Moves each month to another folder; one of small files is written anew, as few of `FILE_SIZE`."""

    def month(folder: str) -> None:
        sizes = files.sizes(f"{parts}/{folder}")
        few = max(1, -(-sum(sizes) // FILE_SIZE))
        if len(sizes) <= few or sum(sizes) >= SMALL_FILE * len(sizes):
            files.move(f"{parts}/{folder}", f"{to}/{folder}")
            return
        small = spark.read.schema(schema).parquet(f"{files.path}/{parts}/{folder}")
        # The folder of a month holds data only.
        options = _codec(spark, "parquet") | {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
        small.coalesce(few).write.options(**options).parquet(f"{files.path}/{to}/{folder}")
        files.delete(f"{parts}/{folder}")

    with ThreadPoolExecutor(UNITED_AT_ONCE) as pool:
        list(pool.map(month, map(_folder, _days(files.names(parts)))))


def _load(spark: SparkSession, path: str, like: DataFrame | None, file_format: str) -> DataFrame:
    """A table of month folders; with the columns of ``like`` no file is opened for its schema."""
    reader = spark.read
    if like is not None and file_format == "parquet":
        reader = reader.schema(like.schema.add(SNAPSHOT, "date"))
    if file_format == "csv":
        reader = reader.option("header", True)
    return reader.format(file_format).load(path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))


def _write_no_rows(df: DataFrame, path: str, file_format: str) -> None:
    """Keeps a table without any snapshot readable: a file with its columns and no rows, of no month."""
    empty = df.sparkSession.createDataFrame([], df.drop(SNAPSHOT).schema)
    writer = empty.coalesce(1).write.mode("overwrite").options(**_codec(df.sparkSession, file_format)).format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(f"{path.rstrip('/')}/{SNAPSHOT}={NO_SNAPSHOT}")


def read_snapshots(
    spark: SparkSession,
    path: str,
    months: Sequence[date] | None = None,
    *,
    file_format: str = "parquet",
) -> DataFrame:
    """The table, or the given months of it; the filter prunes partitions.

    Where a write has ended after its months hold but before all are in place, those come from staging.
    """
    files = _Files(spark, path)
    names = files.names()
    switch = _open_switch(files, names)
    if switch is None:
        df = _load(spark, path, None, file_format)
    else:
        staged = _days(files.names(switch.staging))
        stale = [day for day in (*staged, *switch.emptied) if _folder(day) in names]
        in_place = [name for name in names if name.startswith(f"{SNAPSHOT}=")]
        df = _load(spark, path, None, file_format) if in_place else None
        if df is not None and stale:
            df = df.where(F.col(SNAPSHOT).isNull() | ~on_snapshots(stale))
        if staged:
            new = _load(spark, f"{files.path}/{switch.staging}", None, file_format)
            df = new if df is None else df.unionByName(new)
        if df is None:
            df = _load(spark, path, None, file_format)
    return df if months is None else df.where(on_snapshots(months))


def read_month(spark: SparkSession, path: str, day: date, columns: DataFrame) -> DataFrame:
    """One month of a Parquet table with the columns of another frame of it: lists that month's folder only."""
    files = _Files(spark, path)
    switch = _open_switch(files, files.names())
    staged = switch is not None and files.exists(f"{switch.staging}/{_folder(day)}")
    base = f"{files.path}/{switch.staging}" if staged else files.path
    reader = spark.read.option("basePath", base).schema(columns.schema)
    return reader.parquet(f"{base}/{_folder(day)}")


def list_snapshots(spark: SparkSession, path: str) -> list[date]:
    """Dates of the snapshots of a table, in order; an error where there is none.

    Lists the table's folder, which has a folder for each snapshot that holds rows; starts no
    job and opens no data file, whatever their number.
    """
    files = _Files(spark, path)
    names = files.names()
    found = set(_days(names))
    if switch := _open_switch(files, names):
        found = (found | set(switch.filled)) - set(switch.emptied)
    if not found:
        raise NoSnapshotsError(f"no snapshots in {path}")
    return sorted(found)


def snapshot_counts(df: DataFrame) -> DataFrame:
    """Rows per snapshot; on a Parquet table only file footers are read."""
    return df.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("row_count"))
