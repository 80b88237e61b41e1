"""Awkward rows through every operator: null and repeated ids, repeated rows, long texts, clashing names, empty tables."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from netquarry.llm import bpe, decontaminate, fingerprint, langid, linededup, lmscore, neardup, store, substrings, urlfilter
from netquarry.llm.common import BASE
from tests.llm.test_text_operators import PATH, prose

LONG = prose(5, 60_000)
ROWS = [(1, prose(1, 40)), (1, prose(1, 40)), (1, prose(2, 40)), (None, prose(1, 40)), (None, None), (None, ""), (2, ""), (3, LONG), (4, LONG), (5, prose(2, 40) + "\n" + prose(3, 30)), (6, None)]
CLASHES = "ids decoded n_lines n_removed removed lang_pred score bits_per_byte fingerprint class_id part hashes root contaminated item_ids gone hit letters lines right_key doc".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    found = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return found.withColumns({c: F.lit("x") for c in CLASHES})


def texts_of(df, *columns):
    return collections.Counter((r["doc_id"], *(r[c] for c in columns)) for r in df.collect())


def test_every_row_comes_back(spark, docs, tmp_path):
    ids = collections.Counter((i,) for i, _ in ROWS)
    queries = (
        bpe.digests(docs, PATH), linededup.op2_line_dedup(docs), lmscore.op3_lm_score(docs), fingerprint.op6_fingerprints(docs), store.op7_token_store(docs, PATH, f"file://{tmp_path}/s"), substrings.op8_substring_dedup(docs),
        langid.op9_language_id(docs), neardup.op10_near_dedup(docs),
    )
    for df in queries:
        assert texts_of(df) == ids, df.columns


def test_results_replace_columns_of_their_names(docs):
    done = bpe.encode_decode(docs, PATH)
    assert set(done.columns) == set(docs.columns) and {type(r["ids"]) for r in done.collect()} == {list}
    assert set(linededup.dedup_lines(docs).columns) == set(docs.columns) | {"n_lines"} and set(fingerprint.fingerprint(docs).columns) == set(docs.columns)
    found = langid.identify(docs, docs)
    assert set(found.columns) == set(docs.columns) and {r["lang_pred"] for r in found.collect()} == {"en", "und"}


def test_ids_in_order_of_their_documents(spark, docs, tmp_path):
    rows = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in store.op7_token_store(docs, PATH, f"file://{tmp_path}/s").collect())
    assert [r[0] for r in rows] == np.cumsum([0, *[r[1] for r in rows[:-1]]]).tolist()
    ids = [r[2] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_next_documents_of_tied_ids(docs):
    order = sorted(((i, t or "") for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = collections.Counter()
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        k = len(t) // 4
        want[i, len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest()] += 1
    assert texts_of(fingerprint.op6_fingerprints(docs), "n_chars", "edited_sha256") == want


def test_windows_of_one_document_id(docs):
    """Rows that share an id are one document, so each loses what any of them has at its places; the null id is the smallest."""
    found = texts_of(substrings.op8_substring_dedup(docs), "n_words", "n_removed")
    assert found[None, 40, 0] == 1 and found[1, 40, 40] == 3 and found[4, 60_000, 60_000] == 1 and found[3, 60_000, 0] == 1


def test_classes_of_odd_ids(docs):
    found = texts_of(neardup.op10_near_dedup(docs), "class_id")
    assert found == collections.Counter({(1, 1): 3, (None, None): 3, (2, 2): 1, (3, 3): 1, (4, 3): 1, (5, 5): 1, (6, 6): 1})
    assert texts_of(neardup.keep_one(docs)) == collections.Counter({(1,): 3, (None,): 3, (2,): 1, (3,): 1, (5,): 1, (6,): 1})


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/casino"), (1, "http://a.b/casino"), (None, None), (2, "")], "page_id long, url string").withColumns({c: F.lit(0) for c in ("host", "path", "rule", "verdict", "weight", "strict_terms")})
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in urlfilter.op4_url_filter(pages).collect()) == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow")]


def test_stages_on_odd_rows(spark, docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF)
        assert done.count() <= len(ROWS)
        if name != "bpe_encoding":
            assert done.columns == docs.columns
        assert stage(spark, plain.limit(0), SF).isEmpty(), name
    assert texts_of(corpus_pipeline.language_id(spark, docs, SF)) == collections.Counter((i,) for i, t in ROWS if t)


def test_decontamination_of_a_long_text(spark, docs):
    bench = spark.createDataFrame([(1, prose(71, 20)), (2, " ".join(LONG.split()[50_000:50_030]))], "item_id long, text string")
    found = {r["doc_id"]: r["item_ids"] for r in decontaminate.op5_decontamination(docs, bench).collect()}
    assert set(found) >= {3, 4} and all(2 in found[i] for i in (3, 4)) and decontaminate.op5_decontamination(docs.limit(0), bench).isEmpty()


# ---------------------------------------------------------------- fingerprints by definition

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 32
    for _ in range(2):
        x = x * 0xD6E8FEB86659FD93 & MASK
        x ^= x >> 32
    return x


def named(symbols):
    return mixed((sum(s * pow(BASE, k, 1 << 64) for k, s in enumerate(symbols)) + len(symbols) * 0xA24BAED4963EE407) & MASK)


def phrases(symbols):
    """One level: runs collapsed, coins tossed thrice with the left neighbour, phrases from one local maximum to the next."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    names = [mixed((s + n * 0x9FB21C651E98DF25) & MASK) if n > 1 else s for s, n in runs]
    label = names
    for _ in range(fingerprint.ROUNDS):
        tossed = []
        for i, x in enumerate(label):
            differ = x ^ (label[i - 1] if i else ~x & MASK)
            low = differ & -differ
            tossed.append((low.bit_length() - 1) * 2 + bool(x & low))
        label = tossed
    cuts = [i for i in range(len(names)) if i == 0 or (i < len(names) - 1 and label[i] > (label[i - 1]) and label[i] >= label[i + 1])]
    return [named(names[a:b]) for a, b in zip(cuts, [*cuts[1:], len(names)][: len(cuts)], strict=True)]


def test_phrases_by_definition():
    for text in ("", "a", "aaaa", "ab", prose(3, 50), "xx" + prose(3, 50), "né ñ 日本" * 9, "abcabcabcabc" * 5):
        symbols = [mixed(ord(c) + 1) for c in text]
        names = np.array(symbols, np.uint64)
        for _ in range(fingerprint.LEVELS):
            symbols = phrases(symbols)
            names, _ = fingerprint.parse(names, np.zeros(len(names), np.int64))
            assert names.tolist() == symbols


def test_samples_of_long_texts_are_cut_before_they_are_gathered(spark):
    docs = spark.range(4).selectExpr("id AS doc_id", "repeat(concat('word', id, ' is long '), 300000) AS text", "'en' AS lang")
    found = langid.sample(docs).collect()
    assert [len(r["text"]) for r in found] == [langid.SAMPLE_CHARS] * 4
    assert {r["lang_pred"] for r in langid.identify(docs, docs).select("lang_pred").collect()} == {"en"}
    many = spark.range(langid.MAX_LANGUAGES + 1).selectExpr("concat('l', id) AS lang", "concat('text ', id) AS text")
    with pytest.raises(ValueError, match="languages"):
        langid.identify(docs, many)


def test_weights_are_whole_numbers(spark):
    with pytest.raises(ValueError, match="no whole number"):
        urlfilter.terms_of([("a", "soft", 0.5)])
    pages = spark.createDataFrame([(1, "http://x.test/" + "casino" * 500_000), (2, "http://x.test/" + "-ab" * 500_000 + "-casino")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in urlfilter.op4_url_filter(pages).collect()} == {1: "allow", 2: "block"}


def test_grams_are_counted_by_one_sort(monkeypatch):
    """op3 over its budget: distinct grams and training counts were sorted apart."""
    import numpy as np

    from netquarry.llm import lmscore

    keys, train = np.random.default_rng(5).integers(0, 1 << 48, 500)[np.random.default_rng(6).integers(0, 500, 5000)], np.random.default_rng(7).random(5000) < 0.5
    want = {int(k): int(train[keys == k].sum()) for k in np.unique(keys)}
    hashes = keys - (1 << 47)
    assert dict(zip(*(x.tolist() for x in lmscore.counted(hashes, train)), strict=True)) == {k - (1 << 47): n for k, n in want.items()}
    monkeypatch.setattr(np, "unique", None)
    found, n = lmscore.counted(keys, train)
    assert dict(zip(found.tolist(), n.tolist(), strict=True)) == want and (np.diff(found) > 0).all()
