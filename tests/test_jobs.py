"""Jobs that go on where they stopped: new files only, and a stop between batches."""

from __future__ import annotations

import threading
import time

from pyspark.sql import functions as F

from girolens.plans import recon
from girolens.sources import corpus, events, state
from girolens.streaming import receiver, sender
from tests import samples as s
from tests.test_streaming import AS_OF, XSD, Topic, payload, table


def put(tmp_path, name, xml):
    target = tmp_path / "data/pain/001" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(xml)


def test_a_second_run_touches_new_files_only(spark, tmp_path):
    for k in range(5):
        put(tmp_path, f"gen-pass-{k}.xml", s.credit(s.payment(s.credit_tx(f"E{k % 4}"))))  # two files of one content
    put(tmp_path, "sub/deeper.xml", "<x/>")
    published = []

    def publish(records):
        published.append(sorted(r.key for r in records.collect()))

    def run():
        query = sender.follow(spark, str(tmp_path / "data"), str(tmp_path / "state"), str(tmp_path / "offsets"), publish, {"pain.001": "credit.xsd"}, 2)
        query.awaitTermination()
        assert query.exception() is None
        return sum(p["numInputRows"] for p in query.recentProgress)

    assert run() >= 5 and sum(map(len, published)) == 4
    published.clear()
    put(tmp_path, "gen-pass-9.xml", s.credit(s.payment(s.credit_tx("E9"))))
    put(tmp_path, "gen-pass-10.xml", s.credit(s.payment(s.credit_tx("E1"))))  # known content
    put(tmp_path, "gen-pass-1.xml.part", "not a message")
    run_rows = run()
    assert 2 <= run_rows <= 4 and sum(map(len, published)) == 1  # rows of the two new files, read for ids and then sent
    assert run() == 0
    # the log is the one of a run over the whole corpus
    batch = str(tmp_path / "batch")
    sender.send(corpus.read_corpus(spark, str(tmp_path / "data")), batch, lambda r: None, {"pain.001": "credit.xsd"})
    columns = ("message_id", "domain", "message_set", "schema_name", "kafka_topic")
    assert table(spark, tmp_path / "state", "sent_messages", *columns) == table(spark, batch, "sent_messages", *columns)


def test_a_stop_in_the_middle_leaves_whole_batches(spark, tmp_path):
    topic = Topic(tmp_path / "in")
    for k in range(6):
        one = payload(f"m{k}.xml", s.credit(s.payment(s.credit_tx(f"S{k}"))))
        topic.put(one, one, one | {"signature": "", "message_id": f"t{k}"})
    root, gate = str(tmp_path / "state"), receiver.Gate()
    options = {"xsd_paths": XSD, "as_of": F.lit(AS_OF).cast("date"), "gate": gate}
    query = receiver.start(events.file_stream(spark, str(topic.folder), 1), root, str(tmp_path / "offsets"), drain=False, **options)
    while not gate.batches:
        time.sleep(0.05)
    stopping = threading.Thread(target=gate.stop, args=(query,))  # while the next batch may run
    stopping.start()
    stopping.join(60)
    assert not query.isActive
    done = len(gate.batches)
    assert 1 <= done < 6 and all(v == {"processed_messages": 1, "duplicate_events": 1, "tampered_messages": 1, "rule_violations": 0} for v in gate.batches.values())
    assert {r[0] for r in table(spark, root, "processed_messages", "batch_id")} == set(range(done))
    again = receiver.Gate()
    query = receiver.start(events.file_stream(spark, str(topic.folder), 1), root, str(tmp_path / "offsets"), drain=False, **options | {"gate": again})
    again.drain(query, 3)
    assert not query.isActive and len(again.batches) == 6 - done
    tables = state.load_all(spark, root)
    sent = tables["processed_messages"].select("message_id", "domain", "message_set", "file_name", F.lit("credit.xsd").alias("schema_name"),
                                               F.lit("t").alias("kafka_topic"), F.col("processed_at").alias("sent_at"))
    summary = recon.run_all(tables | {"sent_messages": sent})["summary"].first()
    assert (summary.total_sent, summary.passed, summary.duplicates, summary.tampered, summary.fully_reconciled) == (6, 6, 6, 6, True)
