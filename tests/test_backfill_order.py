"""The order of a backfill: a table waits for what it reads, not for other tables."""

import threading
from datetime import date

import pytest

from siltstone.plans import backfill as plan
from siltstone.sources.snapshot_store import WriteCounts

TABLES = ("clickstream", "attributes", "financials", "loan_daily")
DAYS = [date(2023, 5, 1)]


def _steps(monkeypatch, started):
    """Steps that write nothing; each calls ``started`` with its zone and table."""

    def step(zone, table):
        started(zone, table)
        return WriteCounts({DAYS[0]: 1})

    zone_and_table = lambda path: path.split("/")[-2:]
    monkeypatch.setattr(plan, "land_bronze", lambda raw, path, *a, **k: step(*zone_and_table(path)))
    monkeypatch.setattr(plan, "build_silver", lambda spark, table, *a, **k: step("silver", table))
    monkeypatch.setattr(plan, "build_features", lambda *a, **k: step("gold", "feature_store"))
    monkeypatch.setattr(plan, "build_labels", lambda *a, **k: step("gold", "label_store"))


def test_a_table_does_not_wait_for_the_bronze_of_another(spark, tmp_path, monkeypatch):
    cleaned, waited = threading.Event(), []

    def started(zone, table):
        if (zone, table) == ("gold", "feature_store"):
            cleaned.set()
        if (zone, table) == ("bronze", "loan_daily"):
            waited.append(cleaned.wait(20))

    _steps(monkeypatch, started)
    done = plan.backfill(spark, dict.fromkeys(TABLES), str(tmp_path), DAYS)
    assert waited == [True]
    zones = [(zone, table) for zone in ("bronze", "silver") for table in TABLES]
    assert list(done) == [*zones, ("gold", "feature_store"), ("gold", "label_store")]


@pytest.mark.parametrize("with_loans", [True, False])
def test_each_step_comes_after_what_it_reads(spark, tmp_path, monkeypatch, with_loans):
    steps, lock = [], threading.Lock()

    def started(zone, table):
        with lock:
            steps.append((zone, table))

    _steps(monkeypatch, started)
    plan.backfill(spark, dict.fromkeys(TABLES), str(tmp_path), DAYS, with_loans=with_loans)
    assert len(steps) == 10
    assert all(steps.index(("bronze", table)) < steps.index(("silver", table)) for table in TABLES)
    read = TABLES if with_loans else TABLES[:3]
    assert all(steps.index(("silver", table)) < steps.index(("gold", "feature_store")) for table in read)
    assert steps.index(("silver", "loan_daily")) < steps.index(("gold", "label_store"))


def test_nothing_is_built_on_a_table_that_failed(spark, tmp_path, monkeypatch):
    steps = []

    def started(zone, table):
        steps.append((zone, table))
        if (zone, table) == ("bronze", "financials"):
            raise RuntimeError("no financials")

    _steps(monkeypatch, started)
    with pytest.raises(RuntimeError, match="no financials"):
        plan.backfill(spark, dict.fromkeys(TABLES), str(tmp_path), DAYS)
    assert ("silver", "financials") not in steps and ("gold", "feature_store") not in steps
