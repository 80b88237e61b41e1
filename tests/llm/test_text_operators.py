"""Small fixtures with the awkward rows, each operator against a brute-force version."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from netquarry.llm import bpe, decontaminate, fingerprint, langid, linededup, lmscore, neardup, store, substrings, urlfilter

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
WORDS = "der die und haus the of and house tree walked over río niño está año".split()


def prose(seed, n, words=WORDS):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) for _ in range(n))


SHARED = prose(1, 60)
TEXTS = [
    "", None, " \t\n ", "one", "Hello, World! it's <|endoftext|> done", SHARED, SHARED, SHARED + " tail", prose(2, 30) + " " + " ".join(SHARED.split()[10:40]) + " " + prose(3, 20),
    "a\nb\nc\nd\ne", "x\na\nb\nc\ny", "b\nc\nd", prose(4, 20_000), "ΑΣ İx \x1c 日本 é́", "\x00\x7f", "!!!",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, ["en", "de", None][i % 3], f"s{i}", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def words_of(text):
    return (text or "").encode().split()


def test_bpe_is_the_library(docs):
    library = Tokenizer.from_file(PATH)
    found = by_id(bpe.digests(docs, PATH), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert found[i * 3] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_bpe_encode_then_decode_is_encode_decode(docs):
    apart = by_id(bpe.decode(bpe.encode(docs, PATH), PATH), "decoded")
    assert apart == by_id(bpe.encode_decode(docs, PATH), "decoded")


def test_bpe_pairs_by_definition():
    vocabulary = bpe.vocabulary(PATH)
    pick = random.Random(5)
    ids = [i for t, i in vocabulary.usable.items() if t.isascii() and not t.endswith("</w>")]
    ends = [i for t, i in vocabulary.usable.items() if t.isascii()]
    a, b = np.array([pick.choice(ids) for _ in range(3000)]), np.array([pick.choice(ends) for _ in range(3000)])
    want = [vocabulary.exact(vocabulary.symbols(vocabulary.tokens[x]) + vocabulary.symbols(vocabulary.tokens[y])) == [x, y] for x, y in zip(a, b, strict=True)]
    assert vocabulary.compatible(a, b).tolist() == want
    assert any(want) and not all(want)


ALPHABETS = ["abcdefgh'stmdrevl", "ABCdef<|>endoftext ", "äöüßéèñ'", "αβγΣΑσς", "ЖдйЁ", "日本語テキスト", "0123456789½Ⅳ٣", " \t\n\x1c\u00a0\u3000", "!?.,;&%$#|<>'", "e\u0301H\u0331İǅ", "👍🏽😀\u200d"]
SPELLINGS = ["<|endoftext|>", "<|ENDOFTEXT|>", "x<|EndOfText|>y", "<|startoftext|><|endoftext|>", "a <|endoftext|>'s b", "<|endoftext", "''s don't I'LL we've o'clock 'S 'tis x''re", "a" * 300, "<" * 200 + "ab" * 100, "\u00e9" * 100]


def random_texts(n):
    pick = random.Random(17)
    for _ in range(n):
        parts = pick.sample(ALPHABETS, pick.randint(1, 4))
        yield "".join(pick.choice(pick.choice(parts)) for _ in range(pick.randint(0, 60)))


def test_encoders_are_the_library_on_any_text():
    library, every = Tokenizer.from_file(PATH), [*SPELLINGS, *random_texts(10_000)]
    want = [e.ids for e in library.encode_batch(every, add_special_tokens=False)]
    vocabulary = bpe.vocabulary(PATH)
    for encode in (vocabulary.words().encode, store.Library(PATH).table.encode):
        flat, n = encode(every)
        ends = np.cumsum(n)
        assert [flat[a:b].tolist() for a, b in zip(ends - n, ends, strict=True)] == want
    flat, n = vocabulary.words().encode(every)
    assert vocabulary.decode(flat.astype(np.int64), n).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want]


def test_word_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    library, table = Tokenizer.from_file(PATH), bpe.vocabulary(PATH).words()
    for i in range(20):
        words = [f"word{i}x{k}" for k in range(10)]
        flat, n = table.encode(words)
        assert flat.tolist() == [x for w in words for x in library.encode(w, add_special_tokens=False).ids]
    assert len(table.keys) < 100


def test_merkle_by_levels():
    def by_levels(level):
        level = level or [store.digest(b"")]
        while len(level) > 1:
            level = [store.digest(b"\x00" + b"".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        return store.digest(b"\x01" + level[0])

    leaves = [bytes([i]) for i in range(40)]
    assert [store.merkle(leaves[:n]) for n in range(40)] == [by_levels(leaves[:n]) for n in range(40)]


def test_line_dedup(docs):
    first, gone = {}, collections.defaultdict(set)
    for i, t in enumerate(TEXTS):
        lines = (t or "").split("\n")
        for k in range(len(lines) - 2):
            if first.setdefault(tuple(lines[k : k + 3]), (i, k)) != (i, k):
                gone[i] |= {k, k + 1, k + 2}
    found = by_id(linededup.dedup_lines(docs), "n_lines", "n_removed", "text", "source")
    for i, t in enumerate(TEXTS):
        lines = (t or "").split("\n")
        left = t if not gone[i] else "\n".join(x for k, x in enumerate(lines) if k not in gone[i])
        assert found[i * 3] == (len(lines), len(gone[i]), left, f"s{i}")
    assert gone[10] == {1, 2, 3} and gone[11] == {0, 1, 2}


def test_line_dedup_repeats_within_a_document_and_null_ids(spark):
    rows = [(None, "p\nq\nr"), (1, "p\nq\nr\np\nq\nr"), (1, "p\nq\nr\np\nq\nr")]
    found = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in found.collect()) == [(0, 0), (1, 6), (1, 6)]


def test_lm_scores(docs):
    order, train = lmscore.ORDER, [i for i in range(len(TEXTS)) if zlib.crc32(str(i * 3).encode()) % 5 != 1]
    contexts, counts = collections.defaultdict(collections.Counter), collections.Counter()
    low = lambda t: [w.lower() for w in words_of(t)]
    for i in train:
        counts.update([*low(TEXTS[i]), "END"])
        data = b"\xfe" * order + b" ".join(low(TEXTS[i])) + b"\xff"
        for p in range(order, len(data)):
            for k in range(order + 1):
                contexts[data[p - k : p]][data[p]] += 1
    total, distinct = sum(counts.values()), len(counts)
    found = by_id(lmscore.op3_lm_score(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for i, t in enumerate(TEXTS):
        data, score = b"\xfe" * order + b" ".join(low(t)) + b"\xff", 0.0
        for p in range(order, len(data)):
            excluded = set()
            for k in range(order, -1, -1):
                seen = {s: c for s, c in contexts.get(data[p - k : p], {}).items() if s not in excluded}
                n = sum(seen.values())
                if data[p] in seen:
                    score += math.log10((seen[data[p]] - 0.5) / n)
                    break
                if seen:
                    score += math.log10(0.5 * len(seen) / n)
                    excluded |= seen.keys()
            else:
                score -= math.log10(lmscore.ALPHABET - len(excluded))
        tokens = [*low(t), "END"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        got = found[i * 3]
        assert got[:4] == (i not in train, len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert got[4:] == pytest.approx((base, score), rel=1e-9)


def test_lm_probabilities_sum_to_one():
    code, of = lmscore.grams([b"abracadabra", b"banana"], 3)
    keys, n = lmscore.counted(code, np.ones(len(code), bool))
    threes, back = np.unique(keys & 0xFFFFFF, return_inverse=True)
    low = lmscore.LowOrders(threes, np.bincount(back, n).astype(np.int64))
    context = int(keys[3] >> 8)
    every = np.array([context << 8 | s for s in range(256) if s != lmscore.START])
    more = np.union1d(keys, every)
    count = np.zeros(len(more), np.int64)
    count[np.searchsorted(more, keys)] = n
    found = 10 ** lmscore.log_probabilities(more, count, low, 3)
    assert found[np.searchsorted(more, every)].sum() == pytest.approx(1)


def test_lm_adaptive_prefers_repetition(docs):
    assert lmscore.adaptive_code_length(b"abc" * 100) < lmscore.adaptive_code_length(bytes(random.Random(1).choices(range(97, 123), k=300))) / 3
    short = docs.where(F.length("text") < 1000)
    assert all(r["bits"] > 0 for r in lmscore.adaptive(short).collect())


def test_url_filter(spark):
    urls = [None, "", "no scheme", "https://WWW.Example.org/es/x", "http://a.example.org/en/12?q=/fr/", "http://x.com/fr/casino", "http://x.com/de/", "http://casino-win.net/a", "http://casinos.net/a", "http://m.free-bets.net", "x://free.net#bet", "http://xorg/"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id long, url string, host long")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.op4_url_filter(pages).collect()}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert found[4] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert found[5][2:] == ("com/fr/", "allow") and found[6][2:] == ("com/de/", "block")
    assert found[7][2:] == (None, "block") and found[8][2:] == (None, "allow") and found[9] == ("m.free-bets.net", "", None, "block") and found[10] == ("free.net", "", None, "block")
    assert found[11][2:] == (None, "allow")


def test_url_vocabulary_is_a_parameter(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.b/Foo-bar", "x"), (2, "http://a.b/foot", "x"), (3, "http://a.b/casino", "x"), (4, "http://a.b/" + "z/" * 50_000 + "foo", "x"), (None, None, "x")], "page_id long, url string, weight string")
    table = spark.createDataFrame([("FOO", "soft", 3), ("foo", "soft", 1), ("bar", "strict", 1), (None, "soft", 1), ("z", "soft", None)], "term string, kind string, weight int")
    found = {r["page_id"]: (r["verdict"], r["weight"], r["strict_terms"], r["soft_terms"]) for r in urlfilter.judge(pages, (), table, limit=3).collect()}
    assert found == {1: ("block", 4, ["bar"], ["foo"]), 2: ("block", 3, [], ["foo"]), 3: ("allow", 0, [], []), 4: ("block", 3, [], ["foo"]), None: ("allow", 0, [], [])}
    assert {r["verdict"] for r in urlfilter.judge(pages, (), []).collect()} == {"allow"}
    assert urlfilter.op4_url_filter(pages.limit(0)).isEmpty()
    monkeypatch.setattr(urlfilter, "MAX_TERMS", 2)
    with pytest.raises(ValueError, match="over 2 terms"):
        urlfilter.judge(pages, (), table)
    with pytest.raises(ValueError, match="neither strict nor soft"):
        urlfilter.judge(pages, (), [("x", "loud", 1)])


def test_decontamination(spark):
    items = [(1, prose(7, 30)), (2, "two words"), (3, None), (4, ""), (5, prose(8, 80))]
    w = items[0][1].split()
    for k in (4, 14, 24):  # substitutions inside
        w[k] = "replaced"
    half = prose(8, 80).split()[20:75]
    texts = [None, "", prose(9, 50) + " " + items[0][1].upper() + ". " + prose(10, 9), prose(11, 40) + " " + " ".join(w), "say: Two, words!", prose(12, 300), " ".join(half), items[0][1][:60]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert by_id(decontaminate.op5_decontamination(docs, bench), "item_ids") == {2: ([1],), 3: ([1],), 4: ([2],), 6: ([5],)}
    assert sorted(r["doc_id"] for r in decontaminate.keep_uncontaminated(docs, bench).collect()) == [0, 1, 5, 7]


def test_decontamination_in_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(i, prose(20 + i, 25)) for i in range(6)], "item_id long, text string")
    docs = spark.createDataFrame([(i, "pre " + prose(20 + i, 25)) for i in range(6)], "doc_id long, text string")
    whole = by_id(decontaminate.op5_decontamination(docs, bench), "item_ids")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    assert by_id(decontaminate.op5_decontamination(docs, bench), "item_ids") == whole == {i: ([i],) for i in range(6)}


def test_decontamination_finds_every_allowed_overlap(spark):
    """Random substitutions at 0.8 for items of every length; one more and the item isn't there."""
    pick, items, texts, want = random.Random(6), [], [], {}
    for n in range(1, 61):
        word = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(word)))
        need = min(n, 50)
        spoilt = need - -(-need * 4 // 5)
        for turn in range(8):
            start = pick.randrange(n - need + 1)
            gone = set(pick.sample(range(start, start + need), spoilt + turn % 2)) | set(range(n)) - set(range(start, start + need))
            if turn % 2 == 0:
                want[len(texts)] = ([n],)
            texts.append(" ".join(["before"] * pick.randrange(9) + [f"x{k}" if k in gone else x for k, x in enumerate(word)] + ["after"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert by_id(decontaminate.op5_decontamination(docs, bench), "item_ids") == want


def test_decontamination_masks_leave_one_whole():
    pick = random.Random(7)
    for n in [*range(1, 61), 200]:
        step, kept, starts = decontaminate.masks(n, 0.8, 50)
        need = min(n, 50)
        for _ in range(200):
            lo = pick.randrange(n - need + 1)
            gone = set(pick.sample(range(lo, lo + need), need - -(-need * 4 // 5)))
            places = [range(s, s + step * kept, step) for s in starts.tolist()]
            assert all(x[-1] < n for x in places)
            assert any(lo <= x[0] and x[-1] < lo + need and not gone & set(x) for x in places)


def test_decontamination_of_items_with_one_text(spark):
    text = prose(77, 20)
    bench = spark.createDataFrame([(i, text) for i in range(5)] + [(9, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a {text} b", "x"), (1, f"a {text} b", "y"), (None, text, "z"), (3, "a", "z")], "doc_id long, text string, item_ids string")
    assert sorted((r["doc_id"] or 0, r["item_ids"]) for r in decontaminate.op5_decontamination(docs, bench).collect()) == [(0, [0, 1, 2, 3, 4]), (1, [0, 1, 2, 3, 4])]
    assert [r["doc_id"] for r in decontaminate.keep_uncontaminated(docs, bench).collect()] == [3]


def test_fingerprints(docs):
    found = by_id(fingerprint.op6_fingerprints(docs), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    texts = [t or "" for t in TEXTS]
    for i, t in enumerate(texts):
        following, k = texts[(i + 1) % len(texts)], len(t) // 4
        edited = t[: len(t) - k] + following[:k]
        want = fingerprint.hexed(fingerprint.fingerprints([t, edited, following]))
        assert found[i * 3][:4] == (len(t), hashlib.sha256(edited.encode()).hexdigest(), want[0], want[1])
        assert 0 <= found[i * 3][4] <= 1 and 0 <= found[i * 3][5] <= 1
    assert found[15][5] == 1.0 and found[36][4] > 0.4


def test_fingerprints_keep_every_row(spark):
    rows = [(i * 7 % 1009, prose(i, 9)) for i in range(1009)]
    found = fingerprint.with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(13)).collect()
    text = dict(rows)
    ids = sorted(text)
    want = {i: text[i][: len(text[i]) - len(text[i]) // 4] + text[n][: len(text[i]) // 4] for i, n in zip(ids, [*ids[1:], ids[0]], strict=True)}
    assert {r["doc_id"]: r["edited"] for r in found} == want and len(found) == len(rows)


def test_fingerprint_cuts_do_not_depend_on_the_place():
    text = prose(31, 400)
    base, moved, other = fingerprint.fingerprints([text, "zz " + text, prose(32, 400, "lorem ipsum dolor sit amet".split())])
    assert fingerprint.likeness(base[None], moved[None])[0] > 0.9 and fingerprint.likeness(base[None], other[None])[0] < 0.2


def test_token_store(spark, docs, tmp_path):
    library, start = Tokenizer.from_file(PATH), 0
    found = by_id(store.op7_token_store(docs, PATH, f"file://{tmp_path}/s"), "start", "n_tokens", "ids_crc32")
    ids = by_id(store.read(spark, f"file://{tmp_path}/s"), "ids")
    for i, t in enumerate(TEXTS):
        a = np.array([*library.encode(t or "", add_special_tokens=False).ids, store.END_ID], "<u4")
        assert found[i * 3] == (start, len(a), zlib.crc32(a.tobytes())) and bytes(ids[i * 3][0]) == a.tobytes()
        start += len(a)
    assert store.verify_manifest(spark, f"file://{tmp_path}/s").isEmpty()


def test_token_store_finds_damage(spark, docs, tmp_path):
    store.write(docs.limit(5), PATH, f"file://{tmp_path}/s")
    chunks = spark.read.parquet(f"file://{tmp_path}/s/chunks").withColumn("ids", F.concat("ids", F.lit(b"\0\0")))
    chunks.write.parquet(f"file://{tmp_path}/bad")
    import shutil

    shutil.rmtree(f"{tmp_path}/s/chunks")
    shutil.move(f"{tmp_path}/bad", f"{tmp_path}/s/chunks")
    with pytest.raises(Exception, match="missing or differs"):
        store.read(spark, f"file://{tmp_path}/s").collect()


@pytest.mark.parametrize("window", [13, 4])
def test_substring_dedup(docs, window):
    first = {}
    for i, t in enumerate(TEXTS):
        w = words_of(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    found = by_id(substrings.dedup_substrings(docs, window), "n_words", "n_removed", "kept")
    for i, t in enumerate(TEXTS):
        w, gone = words_of(t), set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        assert found[i * 3] == (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())


def test_substring_levels_double(docs):
    found = substrings.levels(docs.where("doc_id in (15, 18, 21, 24)")).collect()
    assert {r["length"] for r in found} == {13, 26, 52}
    assert [len(r["starts"]) for r in found if r["doc"] == 18 and r["length"] == 52] == [9]


def test_language_id(spark):
    tongues = {"en": "the of and house tree walked over with".split(), "es": "el río niño está año señor muy".split()}
    rows = [(i, prose(i, 40, tongues[x]), x) for i, x in enumerate(["en", "es"] * 40)] + [(100, None, "en"), (101, "123 ...", "es"), (102, "", None), (103, prose(9, 5000, tongues["es"]), None)]
    found = by_id(langid.op9_language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")), "held_out", "lang_pred", "score")
    assert all(found[i][1] == x for i, _, x in rows[:80]) and found[103][1] == "es"
    assert [found[i][1:] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert all(found[i][0] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in found)


def test_language_code_lengths_are_exact():
    rows, table = langid.context_tree([b"banana band", b"abba"])
    assert np.allclose((2.0 ** table.astype(np.float64)).sum(1), 1, atol=1e-4)
    text, bits = b"band", 0.0
    for k, s in enumerate(text):
        context = (b"\n\n" + text)[k : k + 2]
        bits -= table[rows[context[0] << 8 | context[1]], s]
    assert langid.code_lengths([text], [(rows, table)])[0, 0] == pytest.approx(bits, rel=1e-5)


class PlainPpm:
    """The definition, byte by byte: order 2 with exclusion; a context's distinct bytes are the escape's weight."""

    def __init__(self, samples):
        self.seen = {}
        data = b"\n".join(samples).lower()
        for i in range(len(data)):
            for k in range(min(i, 2) + 1):
                own = self.seen.setdefault(data[i - k : i], {})
                own[data[i]] = own.get(data[i], 0) + 1

    def bits(self, text):
        data, total = b"\n\n" + text.lower(), 0.0
        for i in range(2, len(data)):
            gone = set()
            for k in (2, 1, 0):
                own = {b: n for b, n in self.seen.get(data[i - k : i], {}).items() if b not in gone}
                if not own:
                    continue
                whole = sum(own.values()) + (len(own) if len(own) + len(gone) < 256 else 0)
                if data[i] in own:
                    total -= math.log2(own[data[i]] / whole)
                    break
                total -= math.log2(len(own) / whole)
                gone |= own.keys()
            else:
                total += math.log2(256 - len(gone))
        return total


def test_language_code_lengths_by_definition():
    samples = [b"banana band", b"abba Banal", bytes(range(256))]
    tree, plain = langid.context_tree(samples), PlainPpm(samples)
    texts = [b"band", b"xyz", "r\u00edo ni\u00f1o".encode(), b"", b"ABBA banana", bytes(range(0, 256, 7))]
    assert langid.code_lengths(texts, [tree])[:, 0] == pytest.approx([plain.bits(t) for t in texts], rel=1e-4)


def test_language_sample_counts_copies_once(spark):
    rows = [("same text", "en")] * 20_000 + [(f"text number {i}", "en") for i in range(50)] + [("uno", "es"), (None, "es"), ("x", None)]
    found = langid.sample(spark.createDataFrame(rows, "text string, lang string"), per_language=40).collect()
    by = collections.Counter(r["lang"] for r in found)
    assert by == {"en": 40, "es": 1} and len({r["text"] for r in found}) == 41


def test_language_stage_rejects_what_no_tree_can_read(spark):
    tongues = {"en": "the of and house tree walked over with".split(), "es": "el r\u00edo ni\u00f1o est\u00e1 a\u00f1o se\u00f1or muy".split()}
    pick = random.Random(1)
    rows = [(i, prose(i, 40, tongues[x]), x, "k") for i, x in enumerate(["en", "es"] * 40)]
    rows += [(100, "".join(pick.choice("bcdfghjklmnpqrstvwxz ") for _ in range(300)), None, "k"), (101, "\u042d\u0442\u043e \u0440\u0443\u0441\u0441\u043a\u0438\u0439", "en", "k"), (102, "123", "en", "k"), (103, None, None, "k"), (None, prose(3, 9, tongues["en"]), None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    kept = langid.keep_identified(docs, docs.where("doc_id < 100"))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {*range(80), None}


def near_classes(texts):
    which, h, _ = neardup.weighted_shingles([(t or "").encode() for t in texts])
    sets = [set(h[which == i].tolist()) for i in range(len(texts))]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))]


def test_near_dedup(spark):
    pick, texts = random.Random(3), [None, "", "one two", "one two", "One, two!"]
    for k in range(12):
        base = prose(50 + k, 150).split()
        for n in (0, 0, 1, 2, 6, 12):
            w = list(base)
            for at in pick.sample(range(150), n):
                w[at] = f"w{pick.random()}"
            texts.append(" ".join(w))
    rows = [(i * 2, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    want = near_classes(texts)
    assert by_id(neardup.op10_near_dedup(docs), "class_id") == {i * 2: (want[i] * 2,) for i in range(len(texts))}
    assert {r["doc_id"] for r in neardup.keep_one(docs).collect()} == {c * 2 for c in want}


def test_near_dedup_where_a_passage_is_repeated(spark):
    texts = []
    for k in range(24):
        base = prose(200 + k, 200).split()
        texts += [" ".join(base), " ".join(base[:60] + base[26:60] * (10 + k % 3 * 10) + base[60:])]
    want = near_classes(texts)
    assert want == [i - i % 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert by_id(neardup.op10_near_dedup(docs), "class_id") == {i: (c,) for i, c in enumerate(want)}


def test_pairs_across_classes_by_differences(spark):
    """Prefix filtering finds every pair at 0.8 among texts that aren't near their leader."""
    pick, base = random.Random(4), prose(70, 200).split()
    texts = []
    for _ in range(14):
        w = list(base)
        for at in pick.sample(range(200), 14):
            w[at] = f"w{pick.random()}"
        texts.append(" ".join(w))
        w[pick.randrange(200)] = "changed"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate([" ".join(base), *texts])), "doc_id long, text string")
    shingles = neardup.shingle_sets(docs)
    members = docs.where("doc_id > 0").select("doc_id", F.lit(0).cast("long").alias("leader"), F.col("doc_id").alias("root"), F.lit(0).cast("long").alias("main"))
    found = {(r["a"], r["b"]) for r in neardup.likely_pairs(neardup.differences(members, shingles, 0.8), 0.8).collect()}
    sets = [set(np.frombuffer(r["shingles"], "<u4").tolist()) for r in shingles.orderBy("doc_id").collect()]
    want = {(i, j) for i in range(1, len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    assert want <= found and len(want) >= 14


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {(r["node"], r["root"]) for r in neardup.components(links).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_prob_min_hash_estimates_the_probability_jaccard_similarity():
    shingles = neardup.mix(np.arange(1, 41, dtype=np.uint64))
    x, y = np.arange(1.0, 41), np.arange(40.0, 0, -1)
    text = np.repeat([0, 1], 40)
    found = neardup.prob_min_hash(text, np.tile(shingles, 2), np.concatenate([x, y]), 2, 4000)
    px, py = x / x.sum(), y / y.sum()
    want = sum(1 / np.maximum(px / px[d], py / py[d]).sum() for d in range(40))
    assert (found[0] == found[1]).mean() == pytest.approx(want, abs=0.03)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert bpe.digests(docs, PATH).isEmpty() and linededup.op2_line_dedup(docs).isEmpty() and lmscore.op3_lm_score(docs).isEmpty()
    assert decontaminate.op5_decontamination(docs, bench).isEmpty() and fingerprint.op6_fingerprints(docs).isEmpty() and substrings.op8_substring_dedup(docs).isEmpty()
    assert langid.op9_language_id(docs).isEmpty() and neardup.op10_near_dedup(docs).isEmpty()


def test_empty_store(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert store.op7_token_store(docs, PATH, f"file://{tmp_path}/s").isEmpty()
