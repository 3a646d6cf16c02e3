"""Atomic, repeatable writes: dead runs, repeated runs, writers side by side."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from cirrus import schema as S
from cirrus.sources import committed
from cirrus.sources.local import empty_frame, local_frame
from cirrus.sources.tables import append_or_create, read_readings, replace_table, target_exists
from cirrus.streaming.incremental import high_water_mark, incremental_run

T0 = dt.datetime(2026, 6, 1, 12, 0, 0)


def frame(spark, n, start=T0, city="Paris"):
    rows = [(city, "FR", 15.0 + i, 14.0, 60, 1013, "clear", 3.5, 10000, start + dt.timedelta(hours=i)) for i in range(n)]
    return local_frame(spark, rows, S.READINGS_SCHEMA)


@pytest.fixture
def target(tmp_dir):
    return os.path.join(tmp_dir, "t")


def dies(monkeypatch, when):
    """Make the next commit fail before or after its entry is in place."""
    real = committed._commit

    def commit(*args):
        if when == "after":
            real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(committed, "_commit", commit)
    return lambda: monkeypatch.setattr(committed, "_commit", real)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_run_repeated_adds_no_row_twice(spark, target, monkeypatch, when):
    incremental_run(spark, frame(spark, 3), target)
    revive = dies(monkeypatch, when)
    with pytest.raises(RuntimeError):
        incremental_run(spark, frame(spark, 8), target)
    seen = read_readings(spark, target).count()
    assert seen == (3 if when == "before" else 8)  # rows without an entry are not there
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=seen - 1)
    revive()
    assert incremental_run(spark, frame(spark, 8), target).count() == 8
    assert incremental_run(spark, frame(spark, 8), target).count() == 8
    assert [b.rows for b in committed.batches(spark, target)] == [3, 5]
    assert committed.vacuum(spark, target) == (1 if when == "before" else 0)
    assert read_readings(spark, target).count() == 8


def test_a_run_that_dies_first_leaves_no_table(spark, target, monkeypatch):
    revive = dies(monkeypatch, "before")
    with pytest.raises(RuntimeError):
        append_or_create(frame(spark, 3), target)
    assert not target_exists(spark, target) and high_water_mark(spark, target) is None
    revive()
    assert incremental_run(spark, frame(spark, 2), target).count() == 2


def test_empty_input_writes_nothing(spark, target):
    assert append_or_create(empty_frame(spark, S.READINGS_SCHEMA), target) == 0
    assert not target_exists(spark, target)
    append_or_create(frame(spark, 2), target)
    before = sorted(os.listdir(f"{target}/data"))
    assert append_or_create(empty_frame(spark, S.READINGS_SCHEMA), target) == 0
    assert sorted(os.listdir(f"{target}/data")) == before and len(committed.batches(spark, target)) == 1


def test_a_batch_id_counts_once(spark, target):
    assert append_or_create(frame(spark, 2), target, batch_id="a") == 2
    assert append_or_create(frame(spark, 5), target, batch_id="a") == 0
    assert append_or_create(frame(spark, 1), target, batch_id="b") == 1
    assert read_readings(spark, target).count() == 3


def test_writers_side_by_side(spark, target):
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: committed.append(frame(spark, 1 + i, city=f"c{i}"), target, f"b{i % 4}"), range(6)))
    got = committed.batches(spark, target)
    assert sorted(b.batch_id for b in got) == ["b0", "b1", "b2", "b3"]
    assert committed.read(spark, target).count() == sum(b.rows for b in got)
    assert len({b.number for b in got}) == 4


def test_a_failed_replacement_leaves_the_old_rows(spark, target):
    append_or_create(frame(spark, 5), target)
    broken = frame(spark, 3).selectExpr("* EXCEPT (temperature)", "CAST(raise_error('no') AS DOUBLE) AS temperature")
    with pytest.raises(Exception, match="no"):
        replace_table(broken, target)
    assert read_readings(spark, target).count() == 5
    # The replacement may read the table itself, and may start from other columns.
    assert replace_table(read_readings(spark, target).where("temperature > 17").select("city", "recorded_at"), target) == 2
    assert committed.read(spark, target).columns == ["city", "recorded_at"]
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=4)
    assert replace_table(empty_frame(spark, S.READINGS_SCHEMA), target) == 0
    assert target_exists(spark, target) and read_readings(spark, target).count() == 0
    assert committed.vacuum(spark, target) >= 2


def test_other_columns_are_refused(spark, target):
    append_or_create(frame(spark, 1), target)
    with pytest.raises(ValueError, match="missing"):
        append_or_create(frame(spark, 1).drop("city"), target)


def test_the_mark_comes_from_the_log(spark, target):
    append_or_create(frame(spark, 30), target)
    for b in committed.batches(spark, target):  # no row is read
        for root, _, files in os.walk(f"{target}/{b.folder}"):
            for f in files:
                os.truncate(os.path.join(root, f), 0)
    assert high_water_mark(spark, target) == T0 + dt.timedelta(hours=29)


def test_exports_side_by_side_are_all_listed(spark, tmp_dir):
    from cirrus.sinks.parquet_export import export_all, list_exports

    out = os.path.join(tmp_dir, "exports")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: export_all({"q": frame(spark, 1 + i)}, out, f"run{i}"), range(4)))
    assert [r["run_ts"] for r in list_exports(spark, out).collect()] == [f"run{i}" for i in range(4)]
