"""What the streaming job keeps on disk: packed records, and the text of a message once in what it holds."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from girolens import catalog
from girolens.operators.ranking import ensure_checkpoint_dir
from girolens.operators.routing import route
from tests.test_stream_parts import many_files  # noqa: F401


@pytest.fixture()
def held(spark, monkeypatch):
    """Columns of each frame that is held; the frames that are held now."""
    kind, columns, now = type(spark.range(1)), [], []
    plain = kind.persist, kind.unpersist

    def persist(frame, *args):
        columns.append(frame.columns)
        now.append(frame)
        return plain[0](frame, *args)

    def unpersist(frame, *args):
        now[:] = [f for f in now if f is not frame]
        return plain[1](frame, *args)

    monkeypatch.setattr(kind, "persist", persist)
    monkeypatch.setattr(kind, "unpersist", unpersist)
    return columns, now


def test_text_of_a_message_is_held_once(spark, many_files, held):  # noqa: F811
    """The raw bytes and the text that is parsed were held beside the payload that gives both."""
    columns, now = held
    assert catalog._streamed(spark, many_files, 1).count() > 0
    assert len(columns) >= 4 and not [c for names in columns for c in names if c in ("content", "xml")] and not now


def test_records_are_written_packed(spark, many_files):  # noqa: F811
    ensure_checkpoint_dir(spark.range(1))
    place = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    seen = set(place.glob("stream-*"))
    catalog._streamed(spark, many_files, 1)
    (base,) = set(place.glob("stream-*")) - seen
    assert {f.suffix for f in (base / "records").glob("part-*")} == {".gz"}


def test_side_topics_carry_the_whole_payload(spark, many_files):  # noqa: F811
    """Only what passed is held without its text."""
    ensure_checkpoint_dir(spark.range(1))
    place = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    seen = set(place.glob("stream-*"))
    catalog._streamed(spark, many_files, 1)
    (base,) = set(place.glob("stream-*")) - seen
    sent = {json.loads(r.value)["file_name"]: json.loads(r.value) for r in spark.read.json(f"{base}/records").collect()}
    found = [json.loads(json.loads(line)["value"]) for f in base.glob("state/topics/*/batch_id=*/*.json") for line in f.read_text().splitlines()]
    assert len(found) > 10 and all(record.items() <= got.items() for got in found for record in [sent[got["file_name"]]])


def test_all_deliveries_are_counted_without_their_ids(spark):
    """The copies of all ids were added up after grouping once more by id."""
    rows = spark.createDataFrame([(f"m{n % 7}", n) for n in range(50)], "message_id string, offset long")
    placed = route(rows, None, ["offset"], F.lit(True))
    assert "sum(copies" not in placed._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.offset for r in placed.collect() if r.route == "fresh") == list(range(7))
