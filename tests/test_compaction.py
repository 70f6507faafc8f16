from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.plans import near_realtime
from millrace.schemas import LANDED
from millrace.streaming import compaction
from millrace.streaming.landing import raw_landing
from millrace.streaming.queries import run_to_end, start_parquet_query

DAY = datetime(2026, 5, 14)


class Landing:
    """A landed topic whose records say their processing hour."""

    def __init__(self, spark, topic, folder):
        self.spark, self.topic = spark, topic
        self.path, self.archive = str(folder / "raw_order_created"), str(folder / "archive" / "raw_order_created")
        self.checkpoint = str(folder / "checkpoint")
        self.sent = []

    def land(self, *hours, copies=2):
        texts = [f"{hour} {i} {len(self.sent)}" for hour in hours for i in range(copies)]
        for text in texts:
            self.topic.send(text)
        self.sent += texts
        stamp = F.timestamp_add("HOUR", F.split("raw_json", " ")[0].cast("int"), F.lit(DAY))
        landed = raw_landing(self.topic.stream(), processed_at=stamp)
        run_to_end(start_parquet_query(landed, self.path, self.checkpoint, every=None, partition_by=compaction.HOUR))

    def compact(self, hour):
        return compaction.compact(self.spark, self.path, self.archive, LANDED, DAY.replace(hour=hour))

    def read(self):
        return compaction.read_landed(self.spark, self.path, self.archive, LANDED)

    def texts(self):
        return sorted(row.raw_json for row in self.read().collect())


@pytest.fixture
def landing(spark, topic, tmp_path):
    return Landing(spark, topic(), tmp_path)


def files(folder, hour):
    return len(list(folder.glob(f"ingest_date=2026-05-14/ingest_hour={hour}/**/*.parquet")))


def test_closed_hours_move_once_and_every_record_is_read_once(landing, tmp_path):
    landing.land(3, 4, copies=4)
    before = files(tmp_path / "raw_order_created", 3)
    assert landing.compact(4) and landing.texts() == sorted(landing.sent)
    assert landing.compact(4) is None
    hours = tmp_path / "archive" / "raw_order_created" / "hours"
    assert (before, files(hours, 3), files(hours, 4)) == (4, 1, 0)
    landing.land(3, 4, 5)  # two late ones
    assert landing.texts() == sorted(landing.sent)
    assert landing.compact(5) and landing.texts() == sorted(landing.sent)
    assert (files(hours, 3), files(hours, 4), files(hours, 5)) == (2, 1, 0)
    assert landing.read().columns == LANDED.names


def test_replaced_files_are_dropped_by_a_later_run(spark, landing, tmp_path):
    landing.land(3, copies=3)
    landing.compact(4)
    assert compaction.drop_replaced(spark, landing.path, landing.archive) == 0
    landing.land(4)
    landing.compact(5)
    assert compaction.drop_replaced(spark, landing.path, landing.archive) == 3
    assert files(tmp_path / "raw_order_created", 3) == 0
    assert landing.texts() == sorted(landing.sent)
    assert compaction.drop_replaced(spark, landing.path, landing.archive) == 0
    landing.land(5)
    assert landing.texts() == sorted(landing.sent)


@pytest.mark.parametrize("broken_at", ["replaced", "runs"])
def test_a_run_that_breaks_off_changes_nothing(spark, landing, tmp_path, monkeypatch, broken_at):
    landing.land(3, copies=3)
    real = spark.createDataFrame

    def create(rows, schema=None, *rest):
        if rows and schema in (compaction._REPLACED if broken_at == "replaced" else compaction._RUNS,):
            raise OSError("broken off")
        return real(rows, schema, *rest)

    monkeypatch.setattr(spark, "createDataFrame", create)
    with pytest.raises(OSError):
        landing.compact(4)
    monkeypatch.undo()
    assert landing.texts() == sorted(landing.sent)
    assert landing.compact(4) and landing.texts() == sorted(landing.sent)


def test_nothing_landed_is_empty(spark, landing):
    assert landing.texts() == [] and landing.compact(4) is None
    landing.land(3)
    assert landing.texts() == sorted(landing.sent)


def test_both_archives(spark, topic, tmp_path):
    folders = near_realtime.Folders(str(tmp_path / "tables"), str(tmp_path / "checkpoints"))
    orders, payments = topic("orders"), topic("payments")
    orders.send("a", "b")
    payments.send("c")
    topics = near_realtime.Topics(orders.stream(), payments.stream())
    run_to_end(*near_realtime.start_raw_landing(topics, folders, every=None, retention="7d"))
    done = near_realtime.compact_landing(spark, folders, str(tmp_path / "archive"), datetime(2100, 1, 1))
    assert all(done.values())
    names = {"raw_order_created": ["a", "b"], "raw_payment_confirmed": ["c"]}
    for name, texts in names.items():
        rows = compaction.read_landed(spark, f"{folders.tables}/{name}", str(tmp_path / "archive" / name), LANDED)
        assert sorted(row.raw_json for row in rows.collect()) == texts
        assert compaction.open_files(spark, f"{folders.tables}/{name}", str(tmp_path / "archive" / name), LANDED) == []
