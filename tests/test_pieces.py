"""Files read in pieces: the same documents, flows and hashes as read whole, with bounded memory."""

import hashlib
import io
import json
import subprocess
import sys

import pytest

from netquarry.operators.serving import snapshot_difference
from netquarry.sources import captures, pieces
from netquarry.sources import lake as L
from tests.test_contract import FLOW, changed
from tests.test_lake import document, landing

FLOWS = ['{"a": "x,]}\\"\\\\", "b": [1, [2], {"c": null}]}', "NaN", "-Infinity", "12", '"é\\u00e9"', "[]", "{}", "1e5", "true"]
TEXTS = {
    "plain": document(*FLOWS), "spaces": " {\n\"flows\" : [ 1 ,\t2 ] , \"capture\":{ } ,\"completion_state\":\"c\"}\n ", "none": document(), "last": '{"flows": [1, 2], "capture": {"file_name": "f"}, "completion_state": "c", "flows": [3]}',
    "cut": document(*FLOWS)[:-3], "behind": document() + "x", "comma": document("1,"), "array": "[1, 2]", "number": "12", "empty": "", "space": "  ", "name": '{1: 2}', "state": '{"flows": [], "capture": {}, "completion_state": ""}',
    "object": '{"flows": {"a": 1}, "capture": {}, "completion_state": "c"}', "error": '{"error": {"code": "c", "category": "d", "message": "m"}}', "short": '{"error": {"code": "c"}}', "both": '{"error": {"code": "c"}, "flows": 1}',
    "deep": document("[" * 100_000), "digits": document("1" * 5000), "colon": '{"flows" []}',
}


def expected(text):
    """By json.loads of the whole."""
    try:
        d = json.loads(text)
    except (ValueError, RecursionError):
        return "not valid JSON", None
    if isinstance(d, dict) and isinstance(d.get("error"), dict) and "flows" not in d:
        e = d["error"]
        return (f"upstream error: {e['code']}" if all(isinstance(e.get(x), str) for x in ("code", "category", "message")) else "malformed error document"), None
    if isinstance(d, dict) and isinstance(d.get("flows"), list) and isinstance(d.get("capture"), dict) and d.get("completion_state"):
        return None, d["flows"]
    return "not a flows document", None


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1 << 20])
def test_any_piece_gives_what_the_whole_gives(piece):
    for name, text in TEXTS.items():
        for data in (text.encode(), text.encode("utf-8-sig"), text.encode("utf-16")):
            *rows, last = pieces.parse("p", io.BytesIO(data), piece)
            error, flows = expected(text)
            assert (last[4], last[1]) == (error, hashlib.sha256(data).hexdigest()), name
            if flows is not None:
                mine = [r for r in rows if r[5] == last[5]]
                assert [r[6] for r in mine] == list(range(len(flows))) and json.dumps([json.loads(r[7]) for r in mine]) == json.dumps(flows), name
    assert list(pieces.parse("p", io.BytesIO(b'{"flows": ["\xff"]}'), piece))[-1][4] == "not valid JSON"


def test_too_long_a_value_is_refused_alone():
    text = document("1", '"' + "x" * 5000 + '"')
    assert list(pieces.parse("p", io.BytesIO(text.encode()), 100, 1000))[-1][4] == "not valid JSON"
    assert list(pieces.parse("p", io.BytesIO(text.encode()), 100, 6000))[-1][4] is None


def test_a_lake_is_the_same_by_pieces(spark, tmp_path):
    path = landing(tmp_path)
    more = {"twice": '{"capture": {}, "completion_state": "c", "flows": [%s, 5]}' % json.dumps(FLOW | {"flow_id": 9}), "bare": document(changed("duration_seconds", float("inf")), json.dumps(FLOW | {"end_reason": "NaN, ]"})), "short": '{"error": {"code": "c"}}'}
    for name, text in more.items():
        (tmp_path / "landing" / f"{name}.json").write_text(text)
    reports = {k: L.ingest(spark, f"{tmp_path}/{k}", path, largest=n) for k, n in (("whole", captures.LARGEST), ("pieces", 0))}
    told = {k: sorted((r["path"], r["batch_id"], r["status"]) for r in v.collect()) for k, v in reports.items()}
    assert told["whole"] == told["pieces"] and "failed" not in {x[2] for x in told["whole"]}
    for name, left_out in (("flows", ["ingested_at", "ingest_date", "flow_warnings"]), ("quarantine", ["ingested_at", "ingest_date", "raw_record", "error_message"]), ("ledger", ["commit", "finished_at", "modified", "reasons"])):
        one, other = (L.table(spark, f"{tmp_path}/{k}", name).drop(*left_out) for k in ("whole", "pieces"))
        assert one.count() > 2 and snapshot_difference(one, other).isEmpty(), name
    # the texts that were refused are the ones written
    kept = [json.loads(r[0]) for r in L.table(spark, f"{tmp_path}/pieces", "quarantine").select("raw_record").collect()]
    assert 5 in kept and any(isinstance(x, dict) and x["duration_seconds"] == float("inf") for x in kept)


def test_inventory_by_pieces(spark, tmp_path):
    files = captures.landing_files(spark, landing(tmp_path))
    rows = lambda n: sorted(map(tuple, captures.capture_inventory(files, n).collect()))
    assert rows(captures.LARGEST) == rows(0) and len(rows(0)) == 7

    def broken(path):
        raise OSError(path)

    assert {(r["sha256"], r["format"]) for r in captures.capture_inventory(files, 0, broken).collect()} == {(None, None)}


MEASURE = """
import resource, sys
from netquarry.sources import pieces
class Made:
    # a document of n flows of 1 KB, made as it is read
    def __init__(self, n): self.left, self.head, self.n = n, b'{"capture": {}, "completion_state": "c", "flows": [1', 0
    def read(self, size):
        k = min(self.left, size // 1024)
        self.left -= k
        out = self.head + (b', {"x": "' + b'y' * 1013 + b'"}') * k if self.head or k else b''
        if self.head is not None and not k and self.head != b'':
            out = self.head
        self.head = b''
        if not out and self.n == 0: self.n = 1; out = b']}'
        return out
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n, last = 0, None
for last in pieces.parse("p", Made(int(sys.argv[1]))): n += 1
print(n, last[4], (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_memory_does_not_grow_with_the_document():
    told = [subprocess.run([sys.executable, "-c", MEASURE, str(n)], capture_output=True, text=True, check=True).stdout.split() for n in (20_000, 300_000)]
    assert [int(x[0]) for x in told] == [20_002, 300_002] and {x[1] for x in told} == {"None"}
    assert int(told[1][2]) <= int(told[0][2]) + 16, told
