"""Versioned tables, and the gold tables kept in them: crashes, later columns, pruning, hours."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from netquarry.operators import gold, incremental
from netquarry.operators.detections import Thresholds
from netquarry.operators.serving import snapshot_difference
from netquarry.plans import adapter, stored
from netquarry.sources.reference import SITE_ZONES, reference_table
from netquarry.sources.versions import KEPT, Conflict, Versioned

SF = "/root/testdata/sf0.001"
RUN = datetime(2024, 3, 1)
NO_LOOKBACK = Thresholds.of(incremental_lookback_minutes=0)


def rows(spark, *values):
    return spark.createDataFrame(values, "day string, k long, v string")


def test_a_version_is_there_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    t = Versioned(spark, f"{tmp_path}/t")
    one = t.write(rows(spark, ("a", 1, "x"), ("b", 2, "y")), "day", keys=["k"])
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(t, "_switch", lambda made: (_ for _ in ()).throw(RuntimeError("lost")))
        t.write(rows(spark, ("a", 9, "z")), "day", replaced=[], keys=["k"], base=one)
    assert {tuple(r) for r in t.read().collect()} == {("a", 1, "x"), ("b", 2, "y")} and t.manifest() == one
    before = t.read()
    two = t.write(rows(spark, ("a", 9, "z")), "day", replaced=[], keys=["k"], base=one)
    assert {tuple(r) for r in t.read().collect()} == {("a", 9, "z"), ("b", 2, "y")}
    assert {tuple(r) for r in before.collect()} == {("a", 1, "x"), ("b", 2, "y")}  # a reader stays at its version
    with pytest.raises(Conflict):
        t.write(rows(spark, ("c", 1, "x")), "day", replaced=[], keys=["k"], base=one)
    assert t.parts_with(rows(spark, ("", 2, ""), ("", 7, ""))) == ["day=b"] and t.manifest() == two
    (tmp_path / "t" / "_versions" / f"{two['version'] + 1:012d}.json").write_text('{"version"')  # its writer stopped within it
    assert t.manifest() == two
    three = t.write(rows(spark), "day", replaced=["day=a"], keys=["k"], base=two)
    assert {tuple(r) for r in t.read().collect()} == {("b", 2, "y")} and three["version"] == two["version"] + 2


def test_later_columns_are_null_before(spark, tmp_path):
    t = Versioned(spark, f"{tmp_path}/t")
    base = t.write(rows(spark, ("a", 1, "x"), ("b", 2, "y")), "day")
    base = t.write(rows(spark, ("c", 3, "z")).withColumn("w", F.lit(5)), "day", replaced=[], base=base)
    base = t.write(rows(spark, ("a", 4, "u")), "day", replaced=[], base=base)
    assert t.read().columns == ["day", "k", "v", "w"] and {(r["k"], r["w"]) for r in t.read().collect()} == {(4, None), (2, None), (3, 5)}
    with pytest.raises(ValueError, match="column k is bigint"):
        t.write(rows(spark, ("a", 1, "x")).withColumn("k", F.lit("1")), "day", replaced=[], base=base)


def test_old_files_go(spark, tmp_path):
    t, base = Versioned(spark, f"{tmp_path}/t"), None
    for k in range(KEPT + 3):
        base = t.write(rows(spark, ("a", k, "x")), "day", replaced=[], base=base)
    assert len(list((tmp_path / "t" / "data").glob("commit=*"))) == KEPT and t.read().first()["k"] == KEPT + 2


def refs(spark):
    return reference_table(spark, "network_zones", SITE_ZONES), reference_table(spark, "service_ports")


def by_days(spark):
    """Flows of six days whose capture is that of their day."""
    return adapter.bronze(spark, SF, replay=False).where("first_seen < '2024-01-07'").withColumn("capture_id", F.concat(F.lit("c-"), F.to_date("first_seen").cast("string")))


def test_a_late_capture_opens_only_the_days_of_its_captures(spark, tmp_path, monkeypatch):
    flows = by_days(spark)
    incremental.build(spark, flows, f"{tmp_path}/g", *refs(spark), RUN)
    fact, hours = Versioned(spark, f"{tmp_path}/g/fct_flows"), Versioned(spark, f"{tmp_path}/g/agg_traffic_hourly")
    days = sorted(fact.manifest()["parts"])
    late = flows.where(F.to_date("first_seen") == days[3][-10:]).where("flow_id % 5 = 0").withColumns({"ingested_at": F.lit("2024-03-02").cast("timestamp"), "ingest_date": F.lit("2024-03-02").cast("date"), "bytes_total": F.col("bytes_total") + 1})
    opened, read = [], Versioned.read
    monkeypatch.setattr(Versioned, "read", lambda self, parts=None, tree="data", manifest=None: (opened.append((self.path[-9:], tree, None if parts is None else sorted(parts))), read(self, parts, tree, manifest))[1])
    old = hours.manifest()
    incremental.build(spark, flows.unionByName(late), f"{tmp_path}/g", *refs(spark), RUN, NO_LOOKBACK)
    monkeypatch.undo()
    assert {tuple(p) for path, tree, p in opened if tree == "data" and path == "fct_flows" and p is not None} == {(days[3],)}
    assert not [x for x in opened if x[:2] == ("fct_flows", "data") and x[2] is None]
    assert [d for d, c in hours.manifest()["parts"].items() if old["parts"][d] != c] == [days[3]]
    plan = fact.read([days[3]])._jdf.queryExecution().executedPlan().toString()
    assert days[4] not in plan
    incremental.build(spark, flows.unionByName(late), f"{tmp_path}/full", *refs(spark), RUN)
    for name in ("fct_flows", "agg_traffic_hourly"):
        drop = ("loaded_at", "max_loaded_at", "flow_warnings")
        assert snapshot_difference(Versioned(spark, f"{tmp_path}/g/{name}").read().drop(*drop), Versioned(spark, f"{tmp_path}/full/{name}").read().drop(*drop)).isEmpty()


def test_one_late_row_computes_one_hour(spark, tmp_path, monkeypatch):
    flows = by_days(spark)
    incremental.build(spark, flows, f"{tmp_path}/g", *refs(spark), RUN)
    late = flows.where("flow_id = 7").withColumns({"flow_id": F.lit(10**6).cast("long"), "record_id": F.lit("late"), "ingested_at": F.lit("2024-03-02").cast("timestamp"), "ingest_date": F.lit("2024-03-02").cast("date")})
    seen, make = [], incremental.hourly
    monkeypatch.setattr(incremental, "hourly", lambda f: (seen.append(f.select("flow_hour").distinct().count()), make(f))[1])
    incremental.build(spark, flows.unionByName(late), f"{tmp_path}/g", *refs(spark), RUN, NO_LOOKBACK)
    assert seen == [1]
    incremental.build(spark, flows.unionByName(late), f"{tmp_path}/full", *refs(spark), RUN)
    read = lambda top: Versioned(spark, f"{tmp_path}/{top}/agg_traffic_hourly").read()
    assert snapshot_difference(read("g"), read("full")).isEmpty()


@pytest.mark.parametrize("lost", [1, 2, 3, 4])
def test_a_build_that_stops_anywhere_is_run_again(spark, tmp_path, monkeypatch, lost):
    monkeypatch.setattr(gold, "DAILY", {"det_exfiltration": gold.DAILY["det_exfiltration"]})
    monkeypatch.setattr(gold, "WHOLE", {"dq_batches": gold.WHOLE["dq_batches"]})
    inputs, flows = stored._inputs(spark, SF), by_days(spark).where("first_seen < '2024-01-04'")
    early, calls, switch = flows.where("ingested_at < '2024-01-03'"), [], Versioned._switch

    def stops(self, made):
        calls.append(self.path)
        if len(calls) == lost:
            raise RuntimeError("lost")
        return switch(self, made)

    if lost % 2:  # the first build, else one with late rows
        early = flows
    else:
        gold.build(spark, inputs | {"flows": early}, f"{tmp_path}/g", RUN)
    monkeypatch.setattr(Versioned, "_switch", stops)
    with pytest.raises(RuntimeError, match="lost"):
        gold.build(spark, inputs | {"flows": flows}, f"{tmp_path}/g", RUN)
    monkeypatch.setattr(Versioned, "_switch", switch)
    again = gold.build(spark, inputs | {"flows": flows}, f"{tmp_path}/g", RUN)
    whole = gold.build(spark, inputs | {"flows": flows}, f"{tmp_path}/full", RUN)
    for name in ("fct_flows", "agg_traffic_hourly", "det_exfiltration", "dq_batches"):
        drop = ("flow_warnings", "quarantine_reasons")
        assert snapshot_difference(again(name).drop(*drop), whole(name).drop(*drop)).isEmpty(), name


def test_other_thresholds_make_detections_anew(spark, tmp_path):
    inputs = stored._inputs(spark, SF) | {"flows": by_days(spark)}
    assert gold.build(spark, inputs, f"{tmp_path}/g", RUN)("det_exfiltration").isEmpty()
    assert not gold.build(spark, inputs, f"{tmp_path}/g", RUN, Thresholds.of(exfiltration_min_bytes_out=1, exfiltration_min_upload_ratio=0))("det_exfiltration").isEmpty()


def test_a_column_of_a_later_build_stays(spark, tmp_path, monkeypatch):
    flows, path = by_days(spark), f"{tmp_path}/fct_flows"
    incremental.update_facts(spark, flows.where("flow_id % 3 = 0"), path, *refs(spark), RUN)
    with monkeypatch.context() as m:
        m.setattr(incremental, "fct_flows", lambda *a, made=incremental.fct_flows: made(*a).withColumn("extra", F.lit("e")))
        later = flows.where("flow_id % 3 = 1").withColumn("ingested_at", F.lit("2024-03-01").cast("timestamp")).withColumn("ingest_date", F.lit("2024-03-01").cast("date"))
        incremental.update_facts(spark, later, path, *refs(spark), RUN)
    last = flows.where("flow_id % 3 = 2").withColumn("ingested_at", F.lit("2024-03-05").cast("timestamp")).withColumn("ingest_date", F.lit("2024-03-05").cast("date"))
    incremental.update_facts(spark, last, path, *refs(spark), RUN)
    found = Versioned(spark, path).read()
    assert found.where("extra = 'e'").count() == later.count() and found.where("extra is null").count() == flows.where("flow_id % 3 = 0").count() + last.count() > 0
