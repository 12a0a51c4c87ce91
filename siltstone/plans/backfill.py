"""The backfill: raw tables to bronze, silver and gold on disk.

Each stage handles all months of a table in one job. A job starts as soon as the
tables that it reads are written, whatever other tables still wait for, so that one
fills the cores which the tail of another leaves idle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from siltstone import credit
from siltstone.functions.casts import lenient_date
from siltstone.operators.rules import rewrite_present
from siltstone.operators.snapshots import SNAPSHOT, month_starts
from siltstone.plans.gold import gold_features, gold_labels
from siltstone.plans.silver import CLEANERS
from siltstone.sources.snapshot_store import (
    NoSnapshotsError,
    WriteCounts,
    read_snapshots,
    write_snapshots,
)

_READ_SIZE = "spark.sql.files.maxPartitionBytes"
#: Deriving and cleaning cost some seconds a megabyte: with the default of 128 MB a stage of a few
#: gigabytes has little more tasks than cores, and its last ones keep most cores waiting.
READ_SIZE = "8m"
#: What a shuffle has left on the disks of all executors goes when its write is done: otherwise it
#: stays until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Raw tables which land without a shuffle (see ``unite`` of `write_snapshots`): a row for each
#: installment of a loan, which take two to three times the disk of their files in one.
UNITED = ("loan_daily",)


@dataclass(frozen=True)
class Layout:
    """Where the tables lie below a root folder."""

    root: str

    def table(self, zone: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{name}"


def all_months() -> list[date]:
    """The months of the full backfill."""
    return month_starts(credit.FIRST_SNAPSHOT, credit.LAST_SNAPSHOT)


def land_bronze(
    raw: DataFrame,
    path: str,
    months: Sequence[date],
    *,
    full: bool = True,
    cluster: bool = True,
    unite: bool = False,
    file_format: str = "parquet",
) -> WriteCounts:
    """Raw text to the bronze table, sliced by snapshot; values stay as they came.

    ``full`` also counts the rows of no wanted month; leave it out for a run
    over a few months, which then filters before it shuffles. ``cluster``, ``unite``
    and ``file_format`` are those of `write_snapshots`: without clustering nothing is
    shuffled, which suits raw files that already lie by month.
    """
    dated = rewrite_present(raw, {SNAPSHOT: lenient_date})
    return write_snapshots(
        dated, path, months, count_left_out=full, cluster=cluster, unite=unite, file_format=file_format
    )


def build_silver(
    spark: SparkSession, table: str, layout: Layout, months: Sequence[date]
) -> WriteCounts:
    """One bronze table, cleaned. The plan is narrow and its input lies by month."""
    bronze = read_snapshots(spark, layout.table("bronze", table), months)
    return write_snapshots(CLEANERS[table](bronze), layout.table("silver", table), months, cluster=False)


def build_features(
    spark: SparkSession, layout: Layout, months: Sequence[date], *, with_loans: bool = False
) -> WriteCounts:
    """The gold feature store."""
    read = lambda table: read_snapshots(spark, layout.table("silver", table), months)
    features = gold_features(
        read("clickstream"),
        read("attributes"),
        read("financials"),
        read("loan_daily") if with_loans else None,
    )
    return write_snapshots(features, layout.table("gold", "feature_store"), months)


def build_labels(
    spark: SparkSession, layout: Layout, months: Sequence[date], *, dpd: int = 30, mob: int = 6
) -> WriteCounts:
    """The gold label store."""
    loans = read_snapshots(spark, layout.table("silver", "loan_daily"), months)
    labels = gold_labels(loans, dpd=dpd, mob=mob)  # narrow: lies by month as its input does
    return write_snapshots(labels, layout.table("gold", "label_store"), months, cluster=False)


def backfill(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    months: Sequence[date] | None = None,
    *,
    with_loans: bool = False,
    dpd: int = 30,
    mob: int = 6,
) -> dict[tuple[str, str], WriteCounts]:
    """Runs all stages for the given months (all by default); rerunning is safe.

    ``sources`` maps clickstream, attributes, financials and loan_daily to raw
    text tables. Gives the rows written, by zone and table.
    """
    layout = Layout(root)
    full = months is None
    days = all_months() if full else list(months)
    jobs: dict[tuple[str, str], _Job] = {}
    for table, raw in sources.items():
        unite = table in UNITED
        land = partial(land_bronze, raw, layout.table("bronze", table), days, full=full, cluster=not unite, unite=unite)
        jobs["bronze", table] = _Job(land)
    for table in sources:
        clean = partial(build_silver, spark, table, layout, days)
        jobs["silver", table] = _Job(clean, [("bronze", table)])
    features = partial(build_features, spark, layout, days, with_loans=with_loans)
    labels = partial(build_labels, spark, layout, days, dpd=dpd, mob=mob)
    joined = [table for table in sources if with_loans or table != "loan_daily"]
    jobs["gold", "feature_store"] = _Job(features, [("silver", table) for table in joined])
    jobs["gold", "label_store"] = _Job(labels, [("silver", table) for table in sources if table == "loan_daily"])
    with _settings(spark, {_READ_SIZE: READ_SIZE, _CLEANUP: "true"}):
        return _in_order(jobs)


def read_back(spark: SparkSession, root: str, name: str = "feature_store") -> DataFrame:
    """A whole gold table over all its snapshots; an error where there is none."""
    path = Layout(root).table("gold", name)
    table = read_snapshots(spark, path)
    if table.isEmpty():
        raise NoSnapshotsError(f"no snapshots in {path}")
    return table


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for a while, but for those that the session sets itself; unset again at the end."""
    ours = {name: value for name, value in values.items() if not spark.conf.get(name, None)}
    for name, value in ours.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)


@dataclass(frozen=True)
class _Job:
    """What writes a table, and the tables that it reads."""

    run: Callable[[], WriteCounts]
    after: Sequence[tuple[str, str]] = ()


def _in_order(jobs: Mapping[tuple[str, str], _Job]) -> dict[tuple[str, str], WriteCounts]:
    """Runs each job once those before it are done; the first error is raised, and jobs after a failed one do not run."""
    running: dict[tuple[str, str], Future[WriteCounts]] = {}

    def run(job: _Job, before: Sequence[Future[WriteCounts]]) -> WriteCounts:
        for future in before:
            future.result()
        return job.run()

    # A thread for each job: one that waits holds up no other.
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        for key, job in jobs.items():
            running[key] = pool.submit(run, job, [running[name] for name in job.after])
        return {key: future.result() for key, future in running.items()}
