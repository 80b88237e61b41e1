"""Plans that must not grow with the data: tasks, sizes and rows that pass one task or the driver."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from netquarry.operators import contract, facts, incremental
from netquarry.plans import adapter, contract_cases, stored
from netquarry.sources import captures
from netquarry.sources.reference import SITE_ZONES, reference_table
from netquarry.sources.versions import Versioned
from netquarry.streaming import bronze

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_contract_cases_are_spread_over_tasks(spark):
    """One row group was one task."""
    rows = contract_cases.raw(spark, SF)
    tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == spark.sparkContext.defaultParallelism
    assert contract_cases.envelopes(spark, SF).rdd.getNumPartitions() == tasks


def test_messages_ask_once_whether_a_record_is_an_object(spark):
    """the schema of the whole record was made anew for each of the rules."""
    checked = spark.createDataFrame([("{}", 1)], "raw string, record_index long").selectExpr("*", "parse_json(raw) AS v", "'x' AS __ip_initiator", "'x' AS __ip_responder", "'missing' AS error_type")
    told = contract.with_messages(checked)
    assert plan(told).count("schema_of_variant(v#") == 1
    assert told.first()["error_message"].startswith("flow_id: the field is missing; ip_version: the field is missing")


def test_fact_brings_no_rows_together_by_address_port_or_id(spark):
    """Whole rows were shuffled to few addresses and one port, some five times."""
    rows = facts.fct_flows(facts.stage_flows(adapter.bronze(spark, SF)), reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports"))
    assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == adapter.bronze(spark, SF, replay=False).count()


def test_latest_rows_of_ids_and_of_none(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 1, "x"), (None, 1, "x"), (None, 2, "x")], "record_id string, ingested_at int, batch_id string")
    assert sorted(map(str, (tuple(r) for r in facts.dedupe_latest(rows).collect()))) == sorted(map(str, [("a", 2, "y"), ("b", 1, "x"), (None, 1, "x"), (None, 2, "x")]))


def test_merge_broadcasts_no_ids_of_fresh_rows(spark, tmp_path, monkeypatch):
    """All new ids went through the driver, as one column of a table looks small."""
    plans, write = [], Versioned.write

    def noted(self, df, *given, **named):
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        plans.append([leaves.apply(k).relation().location().rootPaths().toString() for k in range(leaves.size())])
        return write(self, df, *given, **named)

    monkeypatch.setattr(Versioned, "write", noted)
    bronze = adapter.bronze(spark, SF)
    ref = reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")
    for k, rows in enumerate((bronze.where("ingested_at < '2024-01-20'"), bronze), 1):
        incremental.update_facts(spark, rows, f"{tmp_path}/fct_flows", *ref, datetime(2024, 3, k))
    # the fresh rows are read as rows alone, not for their ids as well
    assert len([x for x in plans[-1] if re.search(r"_fresh_[0-9a-f]{32}\b(?!_)", x)]) == 1
    assert Versioned(spark, f"{tmp_path}/fct_flows").read().count() == adapter.bronze(spark, SF, replay=False).count()


def test_lake_commit_parses_its_documents_once(spark, monkeypatch):
    """each of four reads made and parsed all documents anew."""
    formats = []

    def noted(told, batches, lake):
        for df in (told, batches):
            leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
            formats.extend(leaves.apply(k).relation().fileFormat().toString() for k in range(leaves.size()))
        raise InterruptedError

    monkeypatch.setattr(stored.L, "commit", noted)
    with pytest.raises(InterruptedError):
        stored.lake_commit(spark, SF)
    assert set(formats) == {"Parquet"}


MESSAGE = (
    '{"contract_version":1,"sensor_id":"s","capture_id":"c","completion_state":"complete","flow":{"flow_id":1,"ip_version":4,"protocol":6,"protocol_name":"TCP","initiator":{"ip":"10.1.1.1","port":1},"responder":{"ip":"10.1.1.2","port":2},'
    '"initiator_basis":"syn","first_seen":{"unix_seconds":5,"nanos":0,"rfc3339":"x"},"last_seen":{"unix_seconds":6,"nanos":0,"rfc3339":"x"},"duration_seconds":1.0,"first_packet_index":0,"last_packet_index":9,'
    '"initiator_to_responder":{"packets":6,"bytes":1,"payload_bytes":1},"responder_to_initiator":{"packets":4,"bytes":2,"payload_bytes":1},"packets_total":10,"bytes_total":3,"packet_size":null,"inter_arrival":null,"tcp":null,'
    '"application":{},"dominant_endpoint":"initiator","end_reason":"idle"}}'
)


def test_messages_of_a_stream_are_parsed_once_and_written_as_no_text(spark, tmp_path):
    """each flow was written as text and parsed anew, by which 1.0 became 1, and the schema of all of a message was read twice."""
    cases = {None: MESSAGE, "int_type": MESSAGE.replace('"flow_id":1,', '"flow_id":1.0,'), "finite_number": MESSAGE.replace(":1.0,", ":NaN,"), "string_type": MESSAGE.replace('"idle"', "NaN"), "envelope_dict_type": MESSAGE[: MESSAGE.index('"flow":')] + '"flow":[]}', "envelope_missing": "{}", "invalid_json": "{"}
    df = spark.createDataFrame([(v,) for v in cases.values()], "value string")
    decoded = contract.decode_messages(df, as_text=False)
    assert "to_json" not in plan(decoded) and "schema_of_variant(e#" not in plan(decoded)
    told = contract.checked(decoded).withColumn("error_type", F.coalesce("envelope_error", "error_type"))
    found = {r["value"]: r["error_type"] for r in told.select("value", "error_type").collect()}
    assert [found[v] for v in cases.values()] == list(cases)
    lake = str(tmp_path / "lake")
    bronze.write_batch(df, 0, lake, "n")
    kept = {r["error_type"]: r["raw_record"] for r in stored.L.table(spark, lake, "quarantine").collect()}
    assert stored.L.table(spark, lake, "flows").count() == 1 and set(kept) == set(cases) - {None}
    assert kept["invalid_json"] == "{" and '"end_reason":"idle"' in kept["int_type"] and kept["envelope_missing"] == "{}"


def test_messages_of_records_with_the_right_fields_are_the_same(spark):
    """a record that is only out of bounds was taken apart field by field for its message."""
    checked = contract.checked(contract_cases.raw(spark, SF)).where("error_type is not null").cache()
    one, other = (contract.with_messages(x).select("record_index", "error_message", "errors") for x in (checked, checked.drop("__shaped")))
    assert checked.where("__shaped").count() > checked.where("not __shaped").count() > 0
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_documents_are_known_without_the_schema_of_all_flows(spark):
    """whether flows are a list was asked twice by a schema of all of them."""
    rows = {"valid": '{"capture":{},"completion_state":"c","flows":[1,{}]}', "not a flows document": '{"capture":{},"completion_state":"c","flows":{}}', "malformed error document": '{"error":{}}', "not valid JSON": "{"}
    rows |= {"not a flows document ": '{"error":{},"flows":null}', "valid ": '{"capture":{},"completion_state":"c","flows":[]}'}
    files = spark.createDataFrame([(f"/{k}.json", bytearray(v.encode())) for k, v in enumerate(rows.values())], "path string, content binary")
    docs = captures.capture_documents(files)
    assert "schema_of_variant(variant_get(whole#" in plan(docs) and not re.search(r"schema_of_variant\(variant_get\(whole#\d+, \$\.flows,", plan(docs))
    assert [r[0] for r in docs.orderBy("path").select(F.coalesce("error", "status")).collect()] == [k.strip() for k in rows]


def test_bronze_rows_are_spread_over_tasks(spark):
    """One row group was one task up to the written fact, which has no shuffle of rows."""
    rows = adapter.bronze(spark, SF, replay=False)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == spark.sparkContext.defaultParallelism
    fact = facts.fct_flows(facts.stage_flows(adapter.bronze(spark, SF)), reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports"))
    assert fact.select(F.spark_partition_id().alias("p")).distinct().count() >= spark.sparkContext.defaultParallelism
