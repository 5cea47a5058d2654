"""Parts of the deliveries: written by many tasks, one batch each, with the outcomes of one batch."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from girolens import catalog
from girolens.operators.ranking import ensure_checkpoint_dir
from girolens.sources import state


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """Events in six files; every third row is the row before it once more."""
    kinds = ["signup", "error", "click"]
    rows = [(n, datetime(2024, 1, 1) + timedelta(seconds=n), (n - (n % 3 == 2)) % 40, kinds[(n - (n % 3 == 2)) % 3], float(n % 50), f'{{"k": {(n - (n % 3 == 2)) % 30}}}')
            for n in range(240)]
    folder = tmp_path_factory.mktemp("events")
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    frame.repartition(6).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parts_are_written_by_many_tasks_and_stay_batches(spark, many_files, small_splits):
    """One task used to write a whole part."""
    ensure_checkpoint_dir(spark.range(1))
    place = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    seen = set(place.glob("stream-*"))
    parted = {tuple(r) for r in catalog._streamed(spark, many_files, 3, fan=9).collect()}
    (base,) = set(place.glob("stream-*")) - seen
    assert len([f for f in (base / "records").glob("part-*") if f.stat().st_size]) > 3
    done = state.read_table(spark, str(base / "state"), "processed_messages").groupBy(state.BATCH).agg(F.countDistinct("message_id")).collect()
    assert {r[0] for r in done} == {0, 1, 2}
    assert parted == {tuple(r) for r in catalog._streamed(spark, many_files, 1).collect()} and len({r[1] for r in parted}) > 2
