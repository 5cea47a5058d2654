"""The pipeline end to end: send, receive, replay, reconcile."""

from __future__ import annotations

import base64
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from girolens.plans import recon
from girolens.sources import corpus, events, state
from girolens.streaming import receiver, sender
from tests import samples as s

XSD = {"001": str(Path(__file__).parent / "fixtures" / "credit.xsd")}
AS_OF = "2026-01-01"


class Topic:
    """Writes records of the shape of a topic partition, one file per call."""

    def __init__(self, folder: Path):
        self.folder, self.offset, self.files = folder, 0, 0
        folder.mkdir(parents=True, exist_ok=True)

    def put(self, *payloads: dict) -> None:
        lines = []
        for payload in payloads:
            lines.append(json.dumps({
                "key": payload["message_id"], "value": json.dumps(payload), "topic": f"iso20022.pain.{payload['message_set']}",
                "partition": 0, "offset": self.offset, "timestamp": "2026-01-01T00:00:00Z",
            }))
            self.offset += 1
        (self.folder / f"part-{self.files:04d}.json").write_text("\n".join(lines))
        self.files += 1


def payload(name: str, xml: str, message_set: str = "001", **changes) -> dict:
    raw = xml.encode()
    out = {
        "message_id": hashlib.sha256(f"pain.{message_set}:".encode() + raw).hexdigest(), "domain": "pain", "message_set": message_set,
        "schema_name": "credit.xsd", "file_name": name, "sent_at": "2026-01-01T00:00:00+00:00", "xml_content": xml,
        "signature": base64.b64encode(hashlib.sha256(raw).digest()).decode(),
    }
    return out | changes


def drain(spark, folder, root, checkpoint, per_file: int | None = 1):
    query = receiver.start(
        events.file_stream(spark, str(folder), per_file), str(root), str(checkpoint), xsd_paths=XSD,
        as_of=F.lit(AS_OF).cast("date"))
    query.awaitTermination()
    assert query.exception() is None


def table(spark, root, name, *columns):
    return sorted(tuple(r) for r in state.read_table(spark, str(root), name).select(*columns).collect())


def topic_values(root, topic):
    return [
        json.loads(json.loads(line)["value"])
        for path in sorted(Path(root).glob(f"topics/{topic}/batch_id=*/*.json")) for line in path.read_text().splitlines() if line
    ]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stream")
    topic = Topic(base / "in")
    good, warned = s.credit(s.payment(s.credit_tx())), s.credit(s.payment(s.credit_tx("W"), date="2020-01-01"))
    rule_error = s.credit(s.payment(s.credit_tx("R", ccy="QQQ")))
    a, w, r = payload("good.xml", good), payload("warned.xml", warned), payload("rule.xml", rule_error)
    # batch 0: a tampered copy first, then the clean one twice
    topic.put(a | {"xml_content": good.replace("100.00", "900.00")}, a, a, w, r)
    # batch 1: redelivery, unsigned, malformed, wrong order, unknown schema
    topic.put(
        a, w | {"signature": "", "message_id": "unsigned"}, payload("broken.xml", "<Document>"),
        payload("order.xml", good.replace("<GrpHdr>", "<X/><GrpHdr>")), payload("other.xml", s.status(), "002"))
    drain(spark, topic.folder, base / "state", base / "checkpoint")
    return base, topic


def test_routes(spark, run):
    base, _ = run
    root = base / "state"
    assert table(spark, root, "processed_messages", "file_name", "validation_status", "dlq_topic") == [
        ("broken.xml", "fail", "iso20022.dlq"), ("good.xml", "pass", None), ("order.xml", "fail", "iso20022.dlq"),
        ("other.xml", "fail", "iso20022.dlq"), ("rule.xml", "fail", "iso20022.dlq"), ("warned.xml", "pass", None)]
    details = dict(table(spark, root, "processed_messages", "file_name", "error_detail"))
    assert "'{schema}X': This element is not expected. Expected is ( {schema}GrpHdr )." in details["order.xml"]
    assert details["other.xml"] == "Schema unavailable" and details["rule.xml"].startswith("[BR-010]")
    assert table(spark, root, "duplicate_events", "file_name", "batch_id") == [("good.xml", 0), ("good.xml", 1)]
    assert table(spark, root, "tampered_messages", "file_name", "tampered_topic") == [
        ("good.xml", "iso20022.tampered"), ("warned.xml", "iso20022.tampered")]
    assert table(spark, root, "rule_violations", "file_name", "rule_id", "severity") == [
        ("rule.xml", "BR-010", "ERROR"), ("warned.xml", "BR-011", "WARNING")]


def test_side_topics(run):
    base, _ = run
    caught = topic_values(base / "state", "iso20022.tampered")
    assert sorted(v["tamper_reason"] for v in caught) == ["missing signature", "signature mismatch"]
    dead = topic_values(base / "state", "iso20022.dlq")
    assert {v["file_name"] for v in dead} == {"broken.xml", "order.xml", "other.xml", "rule.xml"}
    assert all(v["validation_error"] and v["xml_content"] for v in dead)


def test_replay_of_a_batch_changes_nothing(spark, run):
    base, topic = run
    root = base / "state"
    names = ["processed_messages", "duplicate_events", "tampered_messages", "rule_violations"]
    before = {n: table(spark, root, n, "message_id", "batch_id") for n in names}
    again = spark.read.schema(events.RECORD_DDL).json(str(topic.folder / "part-0001.json"))
    receiver.batch_writer(str(root), receiver.file_sink(str(root)), XSD, F.lit(AS_OF).cast("date"))(again, 1)
    assert {n: table(spark, root, n, "message_id", "batch_id") for n in names} == before


def test_restart_from_checkpoint(spark, run):
    base, topic = run
    count = len(table(spark, base / "state", "processed_messages", "message_id"))
    topic.put(payload("late.xml", s.credit(s.payment(s.credit_tx("LATE")))))
    drain(spark, topic.folder, base / "state", base / "checkpoint")
    rows = table(spark, base / "state", "processed_messages", "file_name", "batch_id")
    assert len(rows) == count + 1 and ("late.xml", 2) in rows


def test_sender_to_receiver(spark, tmp_path):
    """Corpus to sent log to state tables; a second run sends nothing new."""
    for name, content in {
        "gen-pass-1.xml": s.credit(s.payment(s.credit_tx())).encode(),
        "gen-pass-2.xml": s.credit(s.payment(s.credit_tx())).encode(),  # same content
        "gen-edge-3.xml": s.credit(s.payment(s.credit_tx("é"))).encode("latin-1"),  # not UTF-8
    }.items():
        target = tmp_path / "data/pain/001" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    topic, sent = Topic(tmp_path / "in"), []

    def publish(records):
        rows = [json.loads(r.value) for r in records.collect()]
        sent.append(len(rows))
        if rows:
            topic.put(*rows)

    root = tmp_path / "state"
    messages = corpus.read_corpus(spark, str(tmp_path / "data"))
    for _ in range(2):
        sender.send(messages, str(root), publish, {"pain.001": "credit.xsd"})
    assert sent == [2, 0]
    assert table(spark, root, "sent_messages", "file_name", "schema_name", "kafka_topic") == [
        ("gen-edge-3.xml", "credit.xsd", "iso20022.pain.001"), ("gen-pass-1.xml", "credit.xsd", "iso20022.pain.001")]
    drain(spark, topic.folder, root, tmp_path / "checkpoint")
    assert table(spark, root, "tampered_messages", "file_name") == []
    tables = state.load_all(spark, str(root))
    summary = recon.run_all(tables)["summary"].first()
    assert (summary.total_sent, summary.not_processed, summary.fully_reconciled) == (2, 0, True)
    state.register(tables)
    assert spark.sql("SELECT count(*) FROM sent_messages").first()[0] == 2


def test_content_that_was_never_sent(spark, tmp_path):
    """A message altered together with its digest passes the digest, but not the log of the sender."""
    good, other = s.credit(s.payment(s.credit_tx("A"))), s.credit(s.payment(s.credit_tx("B")))
    for k, xml in enumerate([good, other]):
        target = tmp_path / f"data/pain/001/gen-pass-{k}.xml"
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(xml)
    sender.send(corpus.read_corpus(spark, str(tmp_path / "data")), str(tmp_path / "sender"), lambda records: None, {"pain.001": "credit.xsd"})
    altered = good.replace("100.00", "900.00")
    topic = Topic(tmp_path / "in")
    a = payload("a.xml", good)
    topic.put(payload("swapped.xml", other) | {"message_id": a["message_id"]}, payload("altered.xml", altered) | {"message_id": a["message_id"]},
              payload("new.xml", altered), a, payload("b.xml", other))
    records = spark.read.schema(events.RECORD_DDL).json(str(topic.folder))
    root = str(tmp_path / "state")
    receiver.batch_writer(root, receiver.file_sink(root), XSD, F.lit(AS_OF).cast("date"), manifest_root=str(tmp_path / "sender"))(records, 0)
    assert table(spark, root, "processed_messages", "file_name", "validation_status") == [("a.xml", "pass"), ("b.xml", "pass")]
    caught = topic_values(root, "iso20022.tampered")
    assert sorted((v["file_name"], v["tamper_reason"]) for v in caught) == [
        ("altered.xml", "differs from manifest"), ("new.xml", "differs from manifest"), ("swapped.xml", "differs from manifest")]
