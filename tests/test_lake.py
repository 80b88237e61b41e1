import json
from datetime import datetime

import pytest

from netquarry.operators.serving import batch_summary, snapshot_difference
from netquarry.plans import stored
from netquarry.sources import captures
from netquarry.sources import lake as L
from netquarry.sources import pieces
from netquarry.streaming import bronze
from tests.test_contract import FLOW, changed


def document(*flows, state="complete"):
    return '{"capture": {"file_name": "a.pcap"}, "completion_state": "%s", "flows": [%s]}' % (state, ", ".join(flows))


def landing(tmp_path):
    files = {
        "sensor=s1/a.json": document(json.dumps(FLOW), changed("flow_id", 2), changed("duration_seconds", float("nan"))),
        "x/b.JSON": document(changed("flow_id", 7)), "c.json": '{"error": {"code": "bad_magic", "category": "c", "message": "m"}}', "d.json": "{", "e.json": '{"flows": 5}',
        "_x/f.json": document(), ".hidden.json": document(), "g.PCAP": "\n\r\r\n", "h.txt": "no", "same/sensor=s1/a2.json": document(json.dumps(FLOW), changed("flow_id", 2), changed("duration_seconds", float("nan"))),
    }
    for name, text in files.items():
        p = tmp_path / "landing" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    return f"{tmp_path}/landing"


def test_discovery_status_and_sensor(spark, tmp_path):
    files = captures.landing_files(spark, landing(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in files.collect()) == ["a.json", "a2.json", "b.JSON", "c.json", "d.json", "e.json", "g.PCAP"]
    found = {r["path"].rsplit("/", 1)[1]: r for r in captures.capture_documents(files).collect()}
    assert {k: (r["status"], r["sensor_id"]) for k, r in found.items()} == {"a.json": ("valid", "s1"), "a2.json": ("valid", "s1"), "b.JSON": ("valid", "default"), "c.json": ("rejected", "default"), "d.json": ("rejected", "default"), "e.json": ("rejected", "default")}
    assert {r["sensor_id"] for r in captures.capture_documents(files, "given").collect()} == {"given"}
    assert found["c.json"]["error"] == "upstream error: bad_magic" and len(found["a.json"]["flows"]) == 3
    assert {r["format"] for r in captures.capture_inventory(files).where("path like '%PCAP'").collect()} == {"pcapng"}


def test_capture_documents_are_of_bounded_size(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(stored, "FLOWS_A_DOCUMENT", 7, raising=False)
    ids = [r["event_id"] for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect()]
    held = sorted(len(r["flows"]) for r in stored.documents(spark, sf).collect())
    assert held[-1] <= 7 and sum(held) == len(ids) and len(held) == len({(i % 20, i // 140) for i in ids}) > 20
    assert [tuple(r) for r in stored.capture_documents(spark, sf).collect()] == [("s1", "valid", "complete", 20, len(ids))]
    sizes = [sum(i % 20 == k for i in ids) for k in range(20)]
    assert {r["record_index"]: r["n"] for r in stored.explode_flows(spark, sf).collect()} == {k: sum(n > k for n in sizes) for k in range(max(sizes))}


def test_ingest_is_idempotent(spark, tmp_path):
    path, lake = landing(tmp_path), f"{tmp_path}/lake"
    assert L.table(spark, lake, "flows").isEmpty()
    first = L.ingest(spark, lake, path)
    assert sorted(r["status"] for r in first.collect()) == ["ingested", "ingested", "rejected", "rejected", "rejected"]  # equal files are one batch
    assert L.table(spark, lake, "flows").count() == 3 and {r["error_type"] for r in L.table(spark, lake, "quarantine").collect()} == {"finite_number"}
    assert {r["status"] for r in L.ingest(spark, lake, path).collect()} == {"skipped"} and L.table(spark, lake, "flows").count() == 3
    L.ingest(spark, lake, path, force=True)
    flows = L.table(spark, lake, "flows")
    assert flows.count() == 3 and L.table(spark, lake, "quarantine").count() == 1  # in place of the first files
    summary = {r["status"]: r["records_written"] for r in batch_summary(L.table(spark, lake, "ledger")).collect()}
    assert summary == {"ingested": 6, "rejected": 0}
    day = flows.agg({"ingest_date": "max"}).first()[0]
    assert len(L.drop_before(spark, lake, "flows", "9999-01-01")) == 1 and day is not None


def test_a_batch_that_failed_on_the_way_is_written_once(spark, tmp_path, monkeypatch):
    path, lake = landing(tmp_path), f"{tmp_path}/lake"

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(L, "write_ledger", broken)
        L.ingest(spark, lake, path, ingested_at=datetime(2026, 1, 1))
    # nothing counts before the ledger says so
    assert L.table(spark, lake, "flows").isEmpty() and L.stored_table(spark, lake, "flows").count() == 3 and L.table(spark, lake, "ledger").isEmpty()
    L.ingest(spark, lake, path, ingested_at=datetime(2026, 1, 2))
    assert L.table(spark, lake, "flows").count() == 3 and L.table(spark, lake, "quarantine").count() == 1
    assert {str(r["ingest_date"]) for r in L.table(spark, lake, "flows").collect()} == {"2026-01-02"}
    assert L.vacuum(spark, lake) == [] and len(L.vacuum(spark, lake, hours=0)) == 1
    assert L.stored_table(spark, lake, "flows").count() == 3


def test_a_batch_written_again_counts_once_and_readers_see_one_state(spark, tmp_path, monkeypatch):
    path, lake, seen, write = landing(tmp_path), f"{tmp_path}/lake", [], L.write_ledger
    L.ingest(spark, lake, path, ingested_at=datetime(2026, 1, 1))
    look = lambda: sorted((r["record_id"], str(r["ingest_date"])) for r in L.table(spark, lake, "flows").collect())
    before = look()
    monkeypatch.setattr(L, "write_ledger", lambda *a: (seen.append(look()), write(*a))[1])
    L.ingest(spark, lake, path, force=True, ingested_at=datetime(2026, 1, 3))
    assert seen == [before] and [(i, "2026-01-03") for i, _ in before] == look() and L.stored_table(spark, lake, "flows").count() == 6
    plan = L.table(spark, lake, "flows")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "commit" in plan


def unreadable(path):
    if path.endswith("a.json"):
        raise OSError("gone")
    return pieces.open_path(path)


def test_files_that_cannot_be_read_fail_alone(spark, tmp_path):
    path, lake = landing(tmp_path), f"{tmp_path}/lake"
    found = {r["path"].rsplit("/", 1)[1]: r["status"] for r in L.ingest(spark, lake, path, largest=100, open_file=unreadable).collect()}
    assert {k: v for k, v in found.items() if k[0] in "abd"} == {"a.json": "failed", "a2.json": "ingested", "b.JSON": "ingested", "d.json": "rejected"}
    assert L.table(spark, lake, "flows").count() == 3
    # a.json is tried again, and turns out to be what a2.json was
    assert sorted(r["status"] for r in L.ingest(spark, lake, path).collect()) == ["skipped"] * 6


def test_invalid_sensor_ids_are_refused(spark, tmp_path):
    path = landing(tmp_path)
    p = tmp_path / "landing" / "sensor=s1" / "sensor=-x"
    p.mkdir()
    (p / "z.json").write_text(document())
    with pytest.raises(ValueError, match="no sensor id"):
        L.ingest(spark, f"{tmp_path}/lake", path)
    with pytest.raises(ValueError, match="no sensor id"):
        L.ingest(spark, f"{tmp_path}/lake", path, sensor="a b")
    assert not L.exists(spark, f"{tmp_path}/lake/flows")


def test_bare_numbers_in_texts_are_left_alone(spark, tmp_path):
    flow = json.dumps(FLOW | {"end_reason": "path: NaN, z", "dominant_endpoint": "[NaN]"})
    (tmp_path / "a.json").write_text(document(flow, changed("duration_seconds", float("-inf"))))
    found = captures.capture_documents(captures.landing_files(spark, str(tmp_path))).first()
    assert found["status"] == "valid" and json.loads(found["flows"][0]) == json.loads(flow) and "-Infinity" in found["flows"][1]


def test_stream_is_files(spark, tmp_path):
    path = landing(tmp_path)
    messages = bronze.encode_messages(captures.capture_documents(captures.landing_files(spark, path)).where("path like '%/a.json' or path like '%b.JSON'"))
    messages.coalesce(1).write.parquet(f"{tmp_path}/messages")
    spark.createDataFrame([("k", "not json"), ("k", "{}")], "key string, value string").write.mode("append").parquet(f"{tmp_path}/messages")
    for _ in range(2):  # the second run reads nothing new
        stream = spark.readStream.schema("key string, value string").parquet(f"{tmp_path}/messages")
        bronze.stream_to_bronze(stream, f"{tmp_path}/s", f"{tmp_path}/checkpoint", available_now=True).awaitTermination()
    L.ingest(spark, f"{tmp_path}/f", path)
    ids = lambda lake: L.table(spark, lake, "flows").select("record_id", "bytes_total")
    assert snapshot_difference(ids(f"{tmp_path}/s"), ids(f"{tmp_path}/f")).isEmpty() and ids(f"{tmp_path}/s").count() == 3
    assert sorted(r["error_type"] for r in L.table(spark, f"{tmp_path}/s", "quarantine").collect()) == ["envelope_missing", "finite_number", "invalid_json"]


def test_replays_in_a_stream_come_once(spark, tmp_path):
    at = lambda minute: datetime(2026, 1, 1, 0, minute)
    messages = [('{"x": 1}', at(1)), ('{"x": 2}', at(2)), ('{"x": 1}', at(9))]
    more = [('{"x": 2}', at(20)), ('{"x": 3}', at(21))]
    for k, rows in enumerate((messages, more)):  # the second run is a restart: its replay is told by the checkpoint's state
        spark.createDataFrame(rows, "value string, timestamp timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/m")
        stream = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{tmp_path}/m")
        bronze.stream_to_bronze(stream, f"{tmp_path}/lake", f"{tmp_path}/checkpoint", available_now=True, time="timestamp", within="30 minutes").awaitTermination()
        assert L.table(spark, f"{tmp_path}/lake", "quarantine").count() == (2, 3)[k]


def test_stream_batch_id_by_offsets(spark):
    rows = [("t.x", 1, o) for o in (5, 6, 9)] + [("t.x", 0, 2)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    import hashlib

    assert bronze.stream_batch_id(df, 3, "n") == "kafka-t.x-" + hashlib.sha256(b"t.x|0:2-2;1:5-9").hexdigest()[:24]
    assert bronze.stream_batch_id(df.drop("offset"), 3, "n") == "stream-n-3"


def test_streaming_windows(spark, tmp_path):
    from netquarry.plans import adapter

    adapter.bronze(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/flows")
    schema = spark.read.parquet(f"{tmp_path}/flows").schema
    found = bronze.windowed_scans(spark.readStream.schema(schema).parquet(f"{tmp_path}/flows"), 1)
    found.writeStream.format("memory").queryName("scans").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("scans").count() > 0
