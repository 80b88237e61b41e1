"""The pipeline against a brute-force version of its stages on the smallest table."""

import re

import corpus_pipeline
from netquarry.llm import langid, neardup
from tests.llm.test_text_operators import PlainPpm, near_classes

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert docs.count() < langid.PER_LANGUAGE  # so that the sample is all
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    labelled = {(r["lang"], r["text"]) for r in docs.collect() if r["lang"] and r["text"]}
    trees = [PlainPpm([t.encode() for k, t in labelled if k == lang]) for lang in {k for k, _ in labelled}]
    # Russian and random letters go in beside the table's own rows
    rows |= {10**6: "\u042d\u0442\u043e \u0440\u0443\u0441\u0441\u043a\u0438\u0439 \u0442\u0435\u043a\u0441\u0442", 10**6 + 1: "qxzjv kwqpz xjqkv zzqxw"}
    some = {i: t for i, t in rows.items() if t and re.search(r"[^\W\d_]", t)}
    kept = {i: t for i, t in some.items() if min(x.bits(t.encode()) for x in trees) <= langid.MAX_BITS * len(t.encode())}
    assert set(some) - set(kept) == {10**6, 10**6 + 1}
    first, gone = {}, {}
    for i in sorted(kept):
        lines = kept[i].split("\n")
        for k in range(len(lines) - 2):
            if first.setdefault(tuple(lines[k : k + 3]), (i, k)) != (i, k):
                gone.setdefault(i, set()).update((k, k + 1, k + 2))
    for i, k in gone.items():
        kept[i] = "\n".join(x for n, x in enumerate(kept[i].split("\n")) if n not in k)
    kept = {i: t for i, t in kept.items() if re.search(r"\w", t)}
    ids = sorted(kept)
    roots = near_classes([kept[i] for i in ids])
    kept = {i: kept[i] for k, i in enumerate(ids) if roots[k] == k}
    plain = lambda t: " ".join(re.findall(r"[^\s!-/:-@\[-`{-~\x00-\x1f\x7f]+", t)).lower()
    leaks = {i for i, t in kept.items() if any(f" {plain(b)} " in f" {plain(t)} " for b in bench)}
    more = spark.createDataFrame([(i, rows[i], None, "s", 0) for i in (10**6, 10**6 + 1)], docs.schema)
    left = docs.unionByName(more)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, left, SF).write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
    found = {r["doc_id"]: r["n_tokens"] for r in left.collect()}
    assert found == {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(found) == set(kept) - leaks
    assert leaks and neardup.MIN_SIMILARITY == 0.8 and all(found.values())


def test_stage_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "bpe_encoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
