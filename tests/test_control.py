from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.control import EVENT_SCHEMA, latest_states, plan_files
from tidemark.sources import files
from tidemark.sources.control_log import file_state, read_events, record_state
from tidemark.sources.files import child_names
from tidemark.sources.tables import EventLog

NOON = datetime(2025, 1, 1, 12)


def event(minute, file_hash, status, batch="b", entity="orders"):
    return (entity, "f.csv", file_hash, batch, status, NOON + timedelta(minutes=minute))


def test_the_newest_event_counts(frame):
    events = frame(
        EVENT_SCHEMA,
        event(0, "h1", "BRONZE_WRITTEN", "b1"),
        event(2, "h1", "SUCCESS", "b1"),
        event(1, "h2", "SUCCESS", "b2"),
        event(3, "h2", "BRONZE_WRITTEN", "b3"),
        event(3, "h2", "SUCCESS", "b4", entity="products"),
    )
    found = {(r["entity"], r["file_hash"]): (r["status"], r["batch_id"]) for r in latest_states(events).collect()}
    assert found == {
        ("orders", "h1"): ("SUCCESS", "b1"),
        ("orders", "h2"): ("BRONZE_WRITTEN", "b3"),
        ("products", "h2"): ("SUCCESS", "b4"),
    }
    assert latest_states(events, "file_hash").count() == 2


def test_finished_wins_at_equal_times(frame):
    events = frame(EVENT_SCHEMA, event(0, "h", "SUCCESS"), event(0, "h", "BRONZE_WRITTEN"))
    assert latest_states(events).first()["status"] == "SUCCESS"


def test_every_file_gets_an_action(frame):
    events = frame(
        EVENT_SCHEMA,
        event(0, "done", "SUCCESS", "b1"),
        event(0, "half", "BRONZE_WRITTEN", "b2"),
        event(0, "odd", "LOST", "b3"),
    )
    files = frame(
        "entity string, source_file string, file_hash string",
        *[("orders", f"{h}.csv", h) for h in ("done", "half", "odd", "new")],
        ("products", "done.csv", "done"),
    )
    planned = plan_files(files, events).collect()
    assert {(r["entity"], r["file_hash"]): (r["action"], r["batch_id"]) for r in planned} == {
        ("orders", "done"): ("skip", "b1"),
        ("orders", "half"): ("resume", "b2"),
        ("orders", "odd"): ("unknown", "b3"),
        ("orders", "new"): ("run", None),
        ("products", "done"): ("run", None),
    }


def test_recorded_states_are_found_again(spark, tmp_path):
    path = str(tmp_path / "control")
    assert file_state(spark, path, "orders", "h") is None
    for status in ("BRONZE_WRITTEN", "SUCCESS"):
        record_state(
            spark, path, entity="orders", source_file="f", file_hash="h", batch_id="b", status=status
        )
    assert file_state(spark, path, "orders", "h")["status"] == "SUCCESS"
    assert file_state(spark, path, "products", "h") is None
    assert read_events(spark, path).count() == 2


def test_many_events_are_few_files(spark, tmp_path):
    log = EventLog(spark, str(tmp_path / "log"), "n bigint", every=4)
    assert log.read().count() == 0
    early = None
    for n in range(18):
        log.append(spark.range(n, n + 1).select(F.col("id").alias("n")))
        assert sorted(r["n"] for r in log.read().collect()) == list(range(n + 1))
        assert len(log.read().inputFiles()) <= 4
        if n == 14:
            early = log.read()
    assert early.count() == 15  # a reader outlives the next fold
    folders = [n for n in child_names(spark, log.path) if not n.startswith("_")]
    assert folders == ["after-00000003", "after-00000004", "fold-00000003", "fold-00000004"]


def test_a_fold_that_was_lost_is_made_again(spark, tmp_path, monkeypatch):
    log = EventLog(spark, str(tmp_path / "log"), "n bigint", every=2)
    one = spark.range(1).select(F.col("id").alias("n"))
    log.append(one)
    with monkeypatch.context() as patch:
        patch.setattr(files, "move", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.append(one)
    assert log.read().count() == 2
    log.append(one)
    assert log.read().count() == 3 and "fold-00000001" in child_names(spark, log.path)
