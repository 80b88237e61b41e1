"""Listing by changed folders: what is seen, what is looked at again, and that known files aren't opened."""

import os
import time

import pytest

from netquarry.sources import captures
from netquarry.sources import lake as L
from netquarry.sources.discovery import Listing, visited
from tests.test_contract import changed
from tests.test_lake import document

OLD = time.time() - 10_000


def put(top, name, n, at=OLD):
    """A document with flow n; the times of all folders above it are set to `at`."""
    p = top / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(document(changed("flow_id", n)))
    aged(top, at)
    return p


def aged(top, at=OLD):
    for x in [top, *top.rglob("*")]:
        if x.stat().st_mtime > at:
            os.utime(x, (at, at))


def run(spark, tmp_path, **kwargs):
    """(status by file name, folders listed, folders unchanged) of one ingestion."""
    listing = Listing(spark, f"{tmp_path}/lake/_listing", f"{tmp_path}/landing", **kwargs)
    found = L.ingest(spark, f"{tmp_path}/lake", f"{tmp_path}/landing", listing=listing)
    note = listing.table.manifest()["note"]
    return {r["path"].rsplit("/", 1)[1]: r["status"] for r in found.collect()}, note["listed"], note["unchanged"]


def test_only_changed_folders_are_listed(spark, tmp_path):
    top = tmp_path / "landing"
    for k in range(6):
        put(top, f"sensor=s{k % 2}/d{k}/f{k}.json", k + 1)
    put(top, "_x/no.json", 90), put(top, ".y/no.json", 91), put(top, "sensor=s0/a b%c/[g]*.JSON", 92)
    assert run(spark, tmp_path) == ({f"f{k}.json": "ingested" for k in range(6)} | {"[g]*.JSON": "ingested"}, 10, 0)
    assert run(spark, tmp_path) == ({}, 0, 10)
    # a new file in a known folder, and new folders below another: their folders alone are listed
    put(top, "sensor=s0/d0/new.json", 50, OLD + 10)
    os.utime(top / "sensor=s0/d0", (OLD + 10,) * 2)
    put(top, "sensor=s1/e/f/deep.json", 51, OLD + 10)
    os.utime(top / "sensor=s1", (OLD + 10,) * 2)
    assert run(spark, tmp_path) == ({"f0.json": "skipped", "new.json": "ingested", "deep.json": "ingested"}, 4, 8)
    assert run(spark, tmp_path) == ({}, 0, 12)
    # the whole listing agrees
    whole = L.ingest(spark, f"{tmp_path}/lake", f"{tmp_path}/landing")
    assert [(r["status"], r["count"]) for r in whole.groupBy("status").count().collect()] == [("skipped", 9)]
    assert L.table(spark, f"{tmp_path}/lake", "flows").count() == 9


def test_folders_are_listed_until_they_are_settled(spark, tmp_path):
    top = tmp_path / "landing"
    put(top, "a/f.json", 1)
    late = put(top, "a/g.json", 2)
    late.write_text("{")
    now = time.time()
    os.utime(late, (now, now))
    os.utime(top / "a", (OLD, OLD))
    # g.json is young: its folder, old as it is, is listed again, and sees it grow
    assert run(spark, tmp_path) == ({"f.json": "ingested", "g.json": "rejected"}, 2, 0)
    late.write_text(document(changed("flow_id", 2)))
    os.utime(late, (now + 1, now + 1))
    os.utime(top / "a", (OLD, OLD))
    assert run(spark, tmp_path) == ({"f.json": "skipped", "g.json": "ingested"}, 1, 1)
    os.utime(late, (OLD, OLD))
    assert run(spark, tmp_path)[1:] == (1, 1)
    assert run(spark, tmp_path) == ({}, 0, 2)


def test_a_run_that_stops_is_done_again(spark, tmp_path, monkeypatch):
    put(tmp_path / "landing", "a/f.json", 1)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(L, "write_ledger", broken)
        run(spark, tmp_path)
    assert run(spark, tmp_path) == ({"f.json": "ingested"}, 2, 0)


def test_unread_files_keep_their_folder_open(spark, tmp_path, monkeypatch):
    top = tmp_path / "landing"
    put(top, "a/f.json", 1), put(top, "b/g.json", 2)
    with monkeypatch.context() as m:
        m.setattr(L, "named_files", lambda s, p, wanted: captures.named_files(s, p, wanted.where("path not like '%g.json'")))
        assert run(spark, tmp_path) == ({"f.json": "ingested", "g.json": "failed"}, 3, 0)
    assert run(spark, tmp_path) == ({"g.json": "ingested"}, 1, 2)
    assert run(spark, tmp_path) == ({}, 0, 3)


def test_vanished_and_empty(spark, tmp_path):
    top = tmp_path / "landing"
    assert run(spark, tmp_path) == ({}, 0, 0)
    top.mkdir()
    assert run(spark, tmp_path) == ({}, 1, 0)
    put(top, "a/f.json", 1)
    assert run(spark, tmp_path) == ({"f.json": "ingested"}, 2, 0)
    (top / "a/f.json").unlink(), (top / "a").rmdir()
    os.utime(top, (OLD + 5, OLD + 5))
    assert run(spark, tmp_path) == ({}, 1, 0)
    gone = spark.createDataFrame([(f"file:{top}/nowhere", 5)], "folder string, settled bigint")
    assert visited(gone).collect() == []


def test_known_files_are_not_opened(spark, tmp_path):
    top = tmp_path / "landing"
    for k in range(3):
        put(top, f"f{k}.json", k + 1)
    L.ingest(spark, f"{tmp_path}/lake", f"{top}")
    put(top, "new.json", 9)
    names = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(captures, "landing_files", lambda s, p: (names.append(p), LANDING(s, p))[1])
        assert {r["status"] for r in L.ingest(spark, f"{tmp_path}/lake", f"{top}").collect()} == {"skipped", "ingested"}
    assert [[x.rsplit("/", 1)[1] for x in n] for n in names] == [["new.json"]]


LANDING = captures.landing_files


def test_named_files_by_scan_give_the_same_rows(spark, tmp_path):
    for k in range(3):
        put(tmp_path, f"f{k}.json", k)
    wanted = captures.landing_files(spark, f"{tmp_path}").select("path", "modified").where("path not like '%f1%'")
    by_name, by_scan = (captures.named_files(spark, f"{tmp_path}", wanted, most) for most in (10, 1))
    assert sorted(by_name.collect()) == sorted(by_scan.select(by_name.columns).collect()) and by_name.count() == 2
