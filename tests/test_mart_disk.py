"""What the mart takes on disk: loans land without a shuffle, shuffles go once written, files are zstd."""

import time
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone.plans import backfill as plan
from siltstone.sources import snapshot_store as store
from siltstone.sources.derived import raw_table, raw_tables

JAN, FEB, MAR = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)
CODEC = "spark.sql.parquet.compression.codec"
SIZE, CLEANUP = "spark.sql.files.maxPartitionBytes", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _table(spark, tasks=6):
    """Rows of two months, some twice, some of another month or without one, in each of several tasks."""
    day = F.element_at(F.array(F.lit(JAN), F.lit(FEB), F.lit(MAR), F.lit(None).cast("date")), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(4_000, numPartitions=tasks).select((F.col("id") % 3_000).cast("string").alias("k"), day.alias("snapshot_date"))


def _rows(df):
    return sorted(map(tuple, df.select("k", "snapshot_date").collect()), key=str)


def _files(path, day):
    return sorted(p for p in (path / f"snapshot_date={day}").iterdir() if not p.name.startswith((".", "_")))


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


@pytest.mark.parametrize(("small", "size", "files"), [(1 << 20, 64 << 20, 1), (1, 64 << 20, 6), (1 << 20, 2_000, 3)])
def test_small_files_of_a_month_are_united_without_a_shuffle(spark, tmp_path, monkeypatch, small, size, files):
    monkeypatch.setattr(store, "SMALL_FILE", small)
    monkeypatch.setattr(store, "FILE_SIZE", size)
    df, hinted = _table(spark), []
    monkeypatch.setattr(type(df), "hint", lambda self, *a: hinted.append(a) or self)
    counts = store.write_snapshots(df, str(tmp_path / "t"), [JAN, FEB], cluster=False, unite=True, count_left_out=True)
    assert counts.months == {JAN: 1_000, FEB: 1_000} and counts.left_out == 2_000 and not hinted
    assert _rows(store.read_snapshots(spark, str(tmp_path / "t"))) == _rows(df.where(F.col("snapshot_date") < MAR))
    found = [len(_files(tmp_path / "t", day)) for day in (JAN, FEB)]
    assert found == [files] * 2 if files != 3 else all(1 < n < 6 for n in found)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == [f"snapshot_date={day}" for day in (JAN, FEB)]


def test_uniting_is_part_of_the_write(spark, tmp_path, monkeypatch):
    path, options = str(tmp_path / "t"), {"cluster": False, "unite": True}
    old = spark.createDataFrame([("a", JAN)], "k string, snapshot_date date")
    store.write_snapshots(old, path, [JAN], **options)
    with monkeypatch.context() as patch:
        patch.setattr(store._Files, "sizes", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            store.write_snapshots(_table(spark), path, [JAN, FEB], **options)
    assert _rows(store.read_snapshots(spark, path)) == [("a", JAN)]
    assert store.write_snapshots(_table(spark), path, [JAN, FEB], **options).months == {JAN: 1_000, FEB: 1_000}
    assert store.write_snapshots(old.limit(0), path, [JAN, FEB], **options).total == 0
    assert _rows(store.read_snapshots(spark, path)) == []


@pytest.mark.parametrize("other", [{}, {"cluster": False, "file_format": "csv"}, {"cluster": False, "max_records_per_file": 9}])
def test_uniting_is_refused_where_it_is_not_meant(spark, tmp_path, other):
    with pytest.raises(ValueError, match="unite"):
        store.write_snapshots(_table(spark), str(tmp_path / "t"), [JAN], unite=True, **other)
    assert not (tmp_path / "t").exists()


@pytest.mark.parametrize("own", [None, "gzip"])
def test_files_are_zstd_unless_the_session_sets_a_codec(spark, tmp_path, own):
    if own:
        spark.conf.set(CODEC, own)
    try:
        store.write_snapshots(_table(spark), str(tmp_path / "shuffled"), [JAN])
        store.write_snapshots(_table(spark), str(tmp_path / "united"), [JAN], cluster=False, unite=True)
    finally:
        spark.conf.unset(CODEC)
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) == 2
    for file in files:
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == (own or "zstd").upper()


def test_a_backfill_shuffles_no_loans_and_leaves_no_shuffle_on_disk(spark, sf_dir, tmp_path, monkeypatch):
    loans = raw_table(spark, sf_dir, "loan_daily").count()
    before, shuffled = _shuffle_files(spark), []
    real = plan.write_snapshots

    def write(df, path, *args, **options):
        shuffled.extend(["/".join(path.split("/")[-2:])] if options.get("cluster", True) else [])
        assert spark.conf.get(CLEANUP) == "true"
        return real(df, path, *args, **options)

    monkeypatch.setattr(plan, "write_snapshots", write)
    counts = plan.backfill(spark, raw_tables(spark, sf_dir), str(tmp_path))
    assert counts["bronze", "loan_daily"].total + counts["bronze", "loan_daily"].left_out == loans
    assert sorted(shuffled) == ["bronze/attributes", "bronze/clickstream", "bronze/financials", "gold/feature_store"]
    assert spark.conf.get(CLEANUP) == "false" and spark.conf.get(SIZE) == "134217728b"
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.5)
    assert not left
