"""The snapshot store, CSV sources and the backfill, on disk."""

import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltstone.catalog.queries import QUERIES
from siltstone.operators.snapshots import month_starts
from siltstone.plans import backfill as bf
from siltstone.sources import snapshot_store as store
from siltstone.sources import text_files
from siltstone.sources.derived import TABLES, raw_table, raw_tables

JAN, FEB, MAR = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)
SCHEMA = "k string, snapshot_date date"


def rows(df):
    return sorted([tuple(row) for row in df.collect()], key=str)


def content(spark, path, **options):
    return rows(store.read_snapshots(spark, path, **options).select("k", "snapshot_date"))


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
@pytest.mark.parametrize("cluster", [True, False])
def test_months_are_replaced_one_by_one(spark, tmp_path, file_format, cluster):
    path = str(tmp_path / "t")
    options = {"file_format": file_format, "cluster": cluster}
    first = spark.createDataFrame([("a", JAN), ("b", FEB), ("c", FEB), ("d", MAR), ("e", None)], SCHEMA)
    counts = store.write_snapshots(first, path, [JAN, FEB], **options, count_left_out=True)
    assert counts.months == {JAN: 1, FEB: 2} and counts.left_out == 2 and counts.total == 3
    assert content(spark, path, file_format=file_format) == [("a", JAN), ("b", FEB), ("c", FEB)]
    again = spark.createDataFrame([("z", FEB)], SCHEMA)
    counts = store.write_snapshots(again, path, [FEB], **options)
    assert counts.months == {FEB: 1} and counts.left_out is None
    assert content(spark, path, file_format=file_format) == [("a", JAN), ("z", FEB)]
    store.write_snapshots(again, path, [FEB], **options)
    assert content(spark, path, file_format=file_format) == [("a", JAN), ("z", FEB)]


def test_a_month_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_snapshots(spark.createDataFrame([("a", JAN), ("b", FEB)], SCHEMA), path, [JAN, FEB])
    nothing = spark.createDataFrame([], SCHEMA)
    assert store.write_snapshots(nothing, path, [FEB]).months == {FEB: 0}
    assert content(spark, path) == [("a", JAN)]
    assert store.list_snapshots(spark, path) == [JAN]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_only_stale_months_are_emptied(spark, tmp_path, file_format):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", JAN), ("b", FEB)], SCHEMA)
    store.write_snapshots(first, path, [JAN, FEB], file_format=file_format)
    counts = store.write_snapshots(first.where("k = 'a'"), path, [JAN, FEB, MAR], file_format=file_format)
    assert counts.months == {JAN: 1, FEB: 0, MAR: 0}
    assert content(spark, path, file_format=file_format) == [("a", JAN)]
    assert not (tmp_path / "t" / "snapshot_date=2023-03-01").exists()


APR = date(2023, 4, 1)


class Stopped(Exception):
    pass


def stop_after(monkeypatch, steps):
    """Every step that changes files counts; the one after ``steps`` of them fails, as does all that follows."""
    done = [0]
    for name in ("make", "move", "delete", "write"):
        real = getattr(store._Files, name)

        def step(self, *args, real=real):
            if done[0] >= steps:
                raise Stopped
            done[0] += 1
            return real(self, *args)

        monkeypatch.setattr(store._Files, name, step)


def test_months_change_all_at_once_wherever_a_run_ends(spark, tmp_path, monkeypatch):
    base, file_format = tmp_path / "base", "parquet"
    first = spark.createDataFrame([("a", JAN), ("b", FEB), ("c", FEB), ("d", APR)], SCHEMA).coalesce(1)
    store.write_snapshots(first, str(base), [JAN, FEB, MAR, APR], file_format=file_format)
    second = spark.createDataFrame([("A", JAN), ("B", JAN), ("M", MAR)], SCHEMA).coalesce(1)
    old = [("a", JAN), ("b", FEB), ("c", FEB), ("d", APR)]
    new = [("A", JAN), ("B", JAN), ("M", MAR), ("d", APR)]
    seen, steps = [], 0
    while True:
        path = tmp_path / f"t{steps}"
        shutil.copytree(base, path)
        with monkeypatch.context() as patch:
            stop_after(patch, steps)
            try:
                store.write_snapshots(second, str(path), [JAN, FEB, MAR], file_format=file_format)
                ended = True
            except Stopped:
                ended = False
        found = content(spark, str(path), file_format=file_format)
        assert found in (old, new), (steps, found)
        assert store.list_snapshots(spark, str(path)) == sorted({day for _, day in found})
        assert content(spark, str(path), file_format=file_format, months=[JAN]) == [r for r in found if r[1] == JAN]
        whole = store.read_snapshots(spark, str(path)).select("k", "snapshot_date")
        for day in (JAN, APR):
            assert rows(store.read_month(spark, str(path), day, whole)) == [r for r in found if r[1] == day]
        seen.append(found)
        counts = store.write_snapshots(second, str(path), [JAN, FEB, MAR], file_format=file_format)  # repairs
        assert counts.months == {JAN: 2, FEB: 0, MAR: 1}
        assert content(spark, str(path), file_format=file_format) == new
        assert not [p.name for p in path.iterdir() if p.name.startswith(("_staging", "_switch", "_old", "._switch"))]
        if ended:
            break
        steps += 1
    assert steps > 8 and seen[0] == old and seen[-1] == new
    assert [rows_ == new for rows_ in seen] == sorted(rows_ == new for rows_ in seen)  # once new, it stays


def test_a_table_emptied_in_steps_stays_readable(spark, tmp_path, monkeypatch):
    first = spark.createDataFrame([("a", JAN)], SCHEMA)
    for steps in range(12):
        path = str(tmp_path / f"t{steps}")
        store.write_snapshots(first, path, [JAN])
        with monkeypatch.context() as patch:
            stop_after(patch, steps)
            try:
                store.write_snapshots(first.limit(0), path, [JAN])
            except Stopped:
                pass
        assert content(spark, path) in ([("a", JAN)], [])
        store.write_snapshots(first.limit(0), path, [JAN])
        assert content(spark, path) == []


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(JAN).alias("snapshot_date"))
    store.write_snapshots(df, path, [JAN])
    plan = store.snapshot_counts(store.read_snapshots(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_many_snapshots_are_counted_exactly(spark, tmp_path):
    path = str(tmp_path / "t")
    days = month_starts("1990-01-01", "2023-04-01")
    assert len(days) == 400
    at = F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % 390 + 1).cast("int"))
    df = spark.range(8_000, numPartitions=4).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 7 > 0, at).alias("snapshot_date")
    )
    counts = store.write_snapshots(df, path, days, cluster=False, count_left_out=True)
    expected = {row[0]: row[1] for row in store.snapshot_counts(df).collect()}
    assert counts.left_out == expected.pop(None)
    assert {day: n for day, n in counts.months.items() if n} == expected
    assert len(counts.months) == 400 and store.list_snapshots(spark, path) == sorted(expected)


def test_listing_starts_no_job(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_snapshots(spark.createDataFrame([("a", JAN), ("b", FEB)], SCHEMA), path, [JAN, FEB])
    for file in (tmp_path / "t").rglob("*.parquet"):
        file.write_bytes(b"not to be opened")
    spark.sparkContext.setJobGroup("listing", "")
    assert store.list_snapshots(spark, path) == [JAN, FEB]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_a_table_without_rows_is_readable(spark, tmp_path, file_format):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", JAN)], SCHEMA)
    store.write_snapshots(first, path, [JAN], file_format=file_format)
    assert store.write_snapshots(first.limit(0), path, [JAN], file_format=file_format).total == 0
    assert content(spark, path, file_format=file_format) == []
    store.write_snapshots(first, path, [JAN], file_format=file_format)
    assert content(spark, path, file_format=file_format) == [("a", JAN)]
    assert store.list_snapshots(spark, path) == [JAN]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_bronze_options(spark, sf_dir, tmp_path, file_format):
    raw = raw_table(spark, sf_dir, "attributes")
    path = str(tmp_path / "bronze")
    counts = bf.land_bronze(raw, path, bf.all_months(), cluster=False, file_format=file_format)
    found = store.read_snapshots(spark, path, file_format=file_format)
    assert found.count() == counts.total > 0 and counts.left_out == raw.count() - counts.total


def test_listing_needs_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_snapshots(spark.createDataFrame([], SCHEMA), path, [JAN])
    with pytest.raises(store.NoSnapshotsError):
        store.list_snapshots(spark, path)
    with pytest.raises(store.NoSnapshotsError):
        store.write_snapshots(spark.createDataFrame([], SCHEMA), path, [])


def test_reading_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.write_snapshots(spark.createDataFrame([("a", JAN), ("b", FEB)], SCHEMA), path, [JAN, FEB])
    df = store.read_snapshots(spark, path, [FEB])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "snapshot_date#" in plan
    assert rows(df) == [("b", FEB)]
    assert rows(store.snapshot_counts(store.read_snapshots(spark, path))) == [(JAN, 1), (FEB, 1)]


def test_a_month_ends_in_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    days = month_starts("2023-01-01", "2023-06-01")
    df = spark.range(60_000, numPartitions=8).select(
        F.col("id").cast("string").alias("k"),
        F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % 6 + 1).cast("int")).alias("snapshot_date"),
    )
    store.write_snapshots(df, path, days)
    assert len(store.read_snapshots(spark, path).inputFiles()) == len(days)


def test_a_hot_month_is_split_into_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(90_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(JAN)).when(F.col("id") % 50 == 1, F.lit(FEB)).otherwise(F.lit(MAR)).alias("snapshot_date"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        counts = store.write_snapshots(df, path, [JAN, FEB, MAR])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = store.read_snapshots(spark, path, [JAN]).inputFiles()
    of_month = {day: sum(f"snapshot_date={day}" in name for name in files) for day in (JAN, FEB)}
    assert of_month[JAN] > 1
    assert counts.months[JAN] == 30_000 and counts.total == 90_000
    assert store.read_snapshots(spark, path).select("k").distinct().count() == 90_000


def test_csv_sources(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("007", "2023-01-01"), (None, "x")], "a string, b string").coalesce(1).write.option(
        "header", True
    ).csv(path)
    for columns in (None, ["a", "b"]):
        df = text_files.read_csv_text(spark, path, columns)
        assert df.dtypes == [("a", "string"), ("b", "string")]
        assert rows(df) == [("007", "2023-01-01"), (None, "x")]
    assert text_files.read_csv_inferred(spark, path).dtypes[0] == ("a", "int")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        text_files.read_csv_text(spark, path, ["b", "a"]).collect()


CSV = """id,note,n\r
1,"two
lines",5\r
2,plain,
3,"says ""yes"", twice",
4,"open,7
5,,""
6,short
7,a,b,c
8,"closed" tail,1
9,in"side,2

10,"x
y
z",3
11,"last is open
"""


def test_broken_records_go_to_a_side_table(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV, newline="")
    read = text_files.read_csv_checked(spark, str(path), ["id", "note", "n"], line_breaks=True)
    assert {r.id: (r.note, r.n) for r in read.rows.collect()} == {
        "1": ("two\nlines", "5"), "2": ("plain", None), "3": ('says "yes", twice', None), "5": (None, ""), "10": ("x\ny\nz", "3"),
    }
    broken = {r.record: r.reason for r in read.broken.collect()}
    assert broken == {
        '4,"open,7': "unterminated", "6,short": "short", "7,a,b,c": "long", '8,"closed" tail,1': "stray quote",
        '9,in"side,2': "unterminated", '11,"last is open': "unterminated",
    }
    assert {r.file.rsplit("/", 1)[1] for r in read.broken.collect()} == {"a.csv"}


def test_lines_are_split_among_tasks(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("id,note\n" + "".join(f'{i},"n ""{i}"""\n' if i % 50 else f'{i},"open\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        read = text_files.read_csv_checked(spark, str(path), ["id", "note"])
        assert read.rows.select(F.spark_partition_id()).distinct().count() > 4
        assert read.rows.count() == 19_600 and read.rows.where("note = concat('n \"', id, '\"')").count() == 19_600
        assert {r.reason: r["count"] for r in read.broken.groupBy("reason").count().collect()} == {"unterminated": 400}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_without_records(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("id,note\n")
    for line_breaks in (True, False):
        read = text_files.read_csv_checked(spark, str(tmp_path / "c"), ["id", "note"], line_breaks=line_breaks)
        assert read.rows.collect() == [] == read.broken.collect()


@pytest.fixture(scope="module")
def mart(spark, sf_dir, tmp_path_factory):
    """CSV files of the raw tables and a full backfill over them."""
    base = tmp_path_factory.mktemp("mart")
    sources = {}
    for table in TABLES:
        path = f"{base}/csv/{table}"
        raw = raw_table(spark, sf_dir, table)
        raw.write.option("header", True).csv(path)
        sources[table] = text_files.read_csv_text(spark, path, raw.columns)
    root = f"{base}/mart"
    return sources, root, bf.backfill(spark, sources, root)


def same_rows(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def in_months(df):
    """The rows of the backfill's months: queries also give those of other dates, or without one."""
    return df.where(F.col("snapshot_date").isin(*bf.all_months()))


def test_backfill_equals_the_queries(spark, sf_dir, mart):
    sources, root, counts = mart
    for table in TABLES:
        raw = raw_table(spark, sf_dir, table)
        landed = counts[("bronze", table)]
        assert landed.left_out > 0 and landed.total + landed.left_out == raw.count()
    layout = bf.Layout(root)
    # A CSV file does not tell an empty text from a missing one.
    for table in ("clickstream", "attributes", "loan_daily"):
        found = store.read_snapshots(spark, layout.table("silver", table))
        assert same_rows(in_months(QUERIES[f"silver_{table}"](spark, sf_dir)), found)
        assert counts[("silver", table)].total == found.count()
    labels = bf.read_back(spark, root, "label_store")
    assert same_rows(in_months(QUERIES["gold_labels"](spark, sf_dir)), labels)
    features = bf.read_back(spark, root)
    assert features.count() == counts[("gold", "feature_store")].total
    assert features.select("Customer_ID", "snapshot_date").distinct().count() == features.count()


def test_rerunning_a_month_changes_nothing(spark, mart):
    sources, root, counts = mart
    before = bf.read_back(spark, root).toPandas().sort_values("Customer_ID").reset_index(drop=True)
    day = date(2023, 5, 1)
    again = bf.backfill(spark, sources, root, [day])
    assert again[("gold", "feature_store")].months == {day: counts[("gold", "feature_store")].months[day]}
    after = bf.read_back(spark, root).toPandas().sort_values("Customer_ID").reset_index(drop=True)
    assert before.equals(after[before.columns])


def test_backfill_with_loans(spark, sf_dir, tmp_path):
    bf.backfill(spark, raw_tables(spark, sf_dir), str(tmp_path / "mart"), with_loans=True)
    features = bf.read_back(spark, str(tmp_path / "mart"))
    features = features.withColumn("loan_amt_sum", F.round("loan_amt_sum", 2))
    assert same_rows(in_months(QUERIES["gold_features_with_loans"](spark, sf_dir)), features)
