"""The ledger's compaction: no row is lost or counted twice at any time, and old files go when no reader has them."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netquarry.schemas import LEDGER
from netquarry.sources import lake as L


def write(spark, lake, batch, at, commit="c"):
    rows = [(batch, "ingested", "file", f"/{batch}", "s1", at, 0, {"x": 1}, None, ["f"], None, datetime(2026, 1, 1), f"{commit}{at}")]
    L.write_ledger(spark.createDataFrame(rows, LEDGER), lake)


def state(spark, lake):
    return sorted((r["batch_id"], r["records_written"], r["reasons"]["x"]) for r in L.table(spark, lake, "ledger").collect())


def files(lake):
    return {p.name for p in Path(f"{lake}/ledger").glob("part-*")}


def test_rows_count_once_before_during_and_after(spark, tmp_path, monkeypatch):
    lake = f"{tmp_path}/lake"
    assert L.compact_ledger(spark, lake) == 0
    for at in range(5):
        write(spark, lake, f"b{at % 3}", at)  # a batch may be written again by a later commit
    before, old = state(spark, lake), files(lake)
    assert len(before) == 5 and len(old) >= 5
    reader = L.table(spark, lake, "ledger")  # planned before the compaction
    # a compaction that stops before it names what it replaced
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(spark, "createDataFrame", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")) if "file string" in _ else type(spark).createDataFrame(spark, *_))
        L.compact_ledger(spark, lake)
    assert state(spark, lake) == before and old < files(lake)
    assert L.compact_ledger(spark, lake) == 0 and state(spark, lake) == before
    write(spark, lake, "b9", 9)
    assert reader.count() >= 5 and old < files(lake)
    assert L.compact_ledger(spark, lake, hours=0) >= 5 and not old & files(lake)
    assert L.compact_ledger(spark, lake, hours=0) >= 1
    assert state(spark, lake) == sorted([*before, ("b9", 9, 1)]) and len(files(lake)) <= 3
    assert L.table(spark, lake, "ledger").where(F.col("batch_id") == "b9").count() == 1
