"""The queries that write tables on their way, over tables without rows."""

import pytest

from siltstone.catalog.queries import QUERIES


@pytest.mark.parametrize(
    "name", ["mart_round_trip", "feature_store_union", "csv_round_trip", "free_day_texts", "mart_month_counts"]
)
def test_tables_without_rows(spark, sf_dir, tmp_path, name):
    for table in ("customer", "orders"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    assert df.columns and df.collect() == []
