r"""Spelling variants: words that differ by one code point, grouped around the frequent form.

Words are the maximal runs of Latin letters, counted over all texts. All words form one trie, kept as a table: a node is
a prefix of some word (with an end mark), and an edge leads from a node over a label to a longer one. The search starts with
the state (word, 0, root, no edit) for each word and goes on by the nodes' depth, each level one equi join of states and
edges on (node, label):

- without an edit: one code point further along the word;
- the edit: a code point of the word left out, another in its place, or one put in; the last two are edges that skip one
  code point and carry a label of the LOOK next ones, so that a state only arises where the word goes on behind it;
- after the edit: LOOK code points further along the word.

A state without an edit whose node has no other word below ends; one with an edit whose node has one word below ends as a
pair if the rest of both words is equal. Edits within a run of equal code points are made at its end only, so each pair
is found once from either side. The trie is for words of up to LONG code points, whose prefixes are short; longer words
meet by hashes of themselves without each one code point, and are compared.

A word's form is the near word of largest count, if that is at least RATIO times its own; roots come by pointer jumping,
in as many rounds as the logarithm of the longest chain, and counts at least double along a chain.

Results for special rows: null and empty texts have no words; very long texts and words are taken whole; rows that
share an id and text count each; a null doc_id counts as the empty text; without frequent words the result is empty, as
for an empty table; ties for the form go to the smallest word in code-point order; other columns aren't read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import BASE, BYTES, LOWER, UNBASE, dropped, mix, powers, rolled, shared_dir, shuffles_cleaned, steps, stored, texts

#: Fixed values of the contract: least code points and occurrences of a word, one run in so many loses a code point.
LEAST, TIMES, EDITED = 5, 3, 97
#: How often a form must occur for one occurrence of its variant.
RATIO = 2
#: Code points that a step after the edit compares at once.
LOOK = 3
#: Words of more code points don't go into the trie.
LONG = 48
END, SKIP = "$", "*"
#: Bytes of text that are counted together.
STEP = 4 << 20

_ASCII = np.zeros(256, bool)
_ASCII[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


# ---------------------------------------------------------------- words


def letter_runs(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and lengths in code points of the runs [A-Za-z\\u00C0-\\u00FF]+ in UTF-8."""
    lead = buf == 0xC3  # of U+00C0 to U+00FF, each two bytes
    letter = _ASCII[buf] | lead
    letter[1:] |= lead[:-1]
    step = np.diff(letter.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    twos = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, ends - starts - (twos[ends] - twos[starts])


def crcs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of buf[start:end] after what has the CRC-32 `before`, for each pair."""
    order = np.argsort(starts - ends, kind="stable")
    at, size, state = starts[order], (ends - starts)[order], before[order] ^ np.uint32(0xFFFFFFFF)
    for k in range(min(int(size.max(initial=0)), 64)):
        n = int(np.searchsorted(-size, -k, "left"))
        state[:n] = _CRC[(state[:n] ^ buf[at[:n] + k]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for k in range(int(np.searchsorted(-size, -64, "left"))):  # longer than 64 bytes
        state[k] = zlib.crc32(buf[at[k] + 64 : at[k] + size[k]].tobytes(), int(state[k]))
    out = np.empty_like(state)
    out[order] = state
    return out


def counted(ids: list, values: list[bytes], least: int = LEAST, edited: int = EDITED) -> tuple[pa.Array, np.ndarray]:
    """(distinct words of at least `least` code points, their occurrences); edited: see the contract, 0 for no edits."""
    buf = LOWER[np.frombuffer(b"\n".join(values), np.uint8)]
    starts, ends, size = letter_runs(buf)
    keep = size >= least
    starts, ends, size = starts[keep], ends[keep], size[keep]
    first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in values])])
    doc = np.searchsorted(first, starts, "right") - 1
    h = rolled(BYTES[buf], starts, ends)
    out: list[tuple[pa.Array, np.ndarray]] = []
    if edited:
        # the edit depends on document and word
        _, one, of = np.unique(mix(h ^ mix(doc.astype(np.uint64))), return_index=True, return_inverse=True)
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        crc = crcs(buf, starts[one], ends[one], before[doc[one]])
        hit = np.flatnonzero(crc % edited == 0)
        times = np.bincount(of, minlength=len(one))
        changed: dict[str, int] = {}
        for k in hit.tolist():
            word = buf[starts[one[k]] : ends[one[k]]].tobytes().decode()
            at = int(crc[k]) % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                changed[word] = changed.get(word, 0) + int(times[k])
        out.append((pa.array(changed.keys(), pa.string()), np.array([*changed.values()], np.int64)))
        whole = np.ones(len(one), bool)
        whole[hit] = False
        whole = whole[of]
        starts, ends, h = starts[whole], ends[whole], h[whole]
    _, one, n = np.unique(h, return_index=True, return_counts=True)
    offsets = np.stack([starts[np.sort(one)], ends[np.sort(one)]], 1).ravel()  # every second piece is a word
    pieces = pa.StringArray.from_buffers(max(len(offsets) - 1, 0), pa.py_buffer(np.append(offsets, 0)[: max(len(offsets), 1)].astype(np.int32)), pa.py_buffer(buf))
    out.append((pieces.take(pa.array(np.arange(0, len(pieces), 2))), n[np.argsort(one)]))
    return pa.concat_arrays([w for w, _ in out]), np.concatenate([k for _, k in out])


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, times: int = TIMES, edited: int = EDITED) -> DataFrame:
    """(word, n) of the words with at least `least` code points and `times` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.column(0), texts(batch.column(1))
            for lo, hi in steps(values, STEP):
                found, n = counted(ids[lo:hi].to_pylist(), values[lo:hi], least, edited)
                yield pa.RecordBatch.from_arrays([found, pa.array(n, pa.int64())], names=["word", "n"])

    return docs.select(doc_id, text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# ---------------------------------------------------------------- trie


def trie(words: DataFrame) -> DataFrame:
    """(node, depth, below, only): every prefix of a word with END, how many words are below, and the smallest of them."""
    marked = words.select("word", F.concat("word", F.lit(END)).alias("w"))
    prefixes = marked.select("word", F.explode(F.transform(F.sequence(F.lit(1), F.length("w")), lambda k: F.left(F.col("w"), k))).alias("node"))
    return prefixes.groupBy("node").agg(F.count("*").alias("below"), F.min("word").alias("only")).withColumn("depth", F.length("node"))


def edges(nodes: DataFrame, depth: int, look: int = LOOK) -> DataFrame:
    """(node, label, child, below, only): the edges from nodes of one depth; nodes: as from trie().

    Labels are the code points to the child: one, `look`, or fewer up to the end of a word; behind SKIP, all but the first.
    """
    label, far, ends = F.substring("node", depth + 1, look + 1), F.col("depth"), F.col("node").endswith(END)
    plain = F.when((far == depth + 1) | (far == depth + look) | ends & (far < depth + look), label)
    skip = F.when((far == depth + look + 1) | ends & (far > depth + 1), F.concat(F.lit(SKIP), F.substring("node", depth + 2, look)))
    near = nodes.where((far > depth) & (far <= depth + look + 1))
    return near.select(F.left("node", F.lit(depth)).alias("node"), F.explode(F.array(plain, skip)).alias("label"), F.col("node").alias("child"), "below", "only").where("label IS NOT NULL")


def lookups(states: DataFrame, look: int = LOOK) -> DataFrame:
    """The labels that a state (word, pos, node, edits) asks for: with pos and edits behind them, and what the skipped code point must not be."""
    rest = f"substring(concat(word, '{END}'), pos + 1)"
    step = lambda label, pos, edits, other="CAST(NULL AS STRING)": f"named_struct('label', {label}, 'pos', {pos}, 'edits', {edits}, 'other', {other})"
    ahead, behind = f"left(rest, {look})", f"substring(rest, 2, {look})"
    after = step(ahead, f"pos + length({ahead})", "1")
    free = ", ".join([
        f"CASE WHEN first <> '{END}' THEN {step('first', 'pos + 1', '0')} END",
        f"CASE WHEN first <> '{END}' AND first <> substring(rest, 2, 1) THEN {step(behind, f'pos + 1 + length({behind})', '1')} END",
        f"CASE WHEN first <> '{END}' THEN {step(f'''concat('{SKIP}', {behind})''', f'pos + 1 + length({behind})', '1', 'first')} END",
        step(f"concat('{SKIP}', {ahead})", f"pos + length({ahead})", "1", "first"),
    ])
    asked = states.selectExpr("word", "pos", "node", "edits", f"{rest} AS rest").selectExpr("*", "left(rest, 1) AS first")
    made = asked.selectExpr("word", "node", f"explode(CASE WHEN edits = 0 THEN array({free}) ELSE array({after}) END) AS next")
    return made.where("next IS NOT NULL").selectExpr("word", "node", "next.label AS label", "next.pos AS pos", "next.edits AS edits", "next.other AS other")


def level(states: DataFrame, nodes: DataFrame, depth: int, look: int = LOOK) -> DataFrame:
    """(word, pos, node, edits, depth, near): the states that follow those of one depth; near: of ended ones the word found."""
    found = lookups(states, look).join(edges(nodes, depth, look), ["node", "label"])
    found = found.where(f"other IS NULL OR substring(child, {depth + 1}, 1) <> other").where("edits = 1 OR below > 1")
    ended = F.col("below") == 1
    same = F.expr(f"substring(concat(word, '{END}'), pos + 1) = substring(concat(only, '{END}'), length(child) + 1)")
    return found.where(~ended | same).select(
        "word", "pos", F.col("child").alias("node"), "edits", F.length("child").alias("depth"), F.when(ended, F.col("only")).alias("near")
    )


def near_short(words: DataFrame, look: int = LOOK) -> DataFrame:
    """(word, near): pairs of words of at most LONG code points, each from both sides."""
    spark = words.sparkSession
    top = f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}"
    with shuffles_cleaned(spark):
        trie(words).write.partitionBy("depth").parquet(f"{top}/nodes")
    schema = "node string, below long, only string, depth int"
    nodes = spark.read.schema(schema).parquet(f"{top}/nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    states = words.select("word", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits"))
    schema, last = "word string, pos int, node string, edits int, near string, came int, depth int", -1
    for depth in range(deepest):
        if depth:
            # states come here from look + 1 levels before at most
            if last < depth - look - 1:
                break
            arrived = (F.col("came") >= depth - look - 1) & (F.col("depth") == depth) & F.col("near").isNull()
            states = spark.read.schema(schema).parquet(f"{top}/states").where(arrived)
            if states.isEmpty():
                continue
        last = depth
        with shuffles_cleaned(spark):
            level(states, nodes, depth, look).write.partitionBy("depth").parquet(f"{top}/states/came={depth}")
    found = spark.read.schema(schema).parquet(f"{top}/states") if last >= 0 else spark.createDataFrame([], schema)
    pairs = stored(found.where("near IS NOT NULL").select("word", "near"))
    nodes.stored_at = top
    dropped(nodes)
    return pairs


def near_long(words: DataFrame) -> DataFrame:
    """(word, near): pairs of which the longer word has over LONG code points, each from both sides.

    Each word sends the hash of itself and, for each code point, of itself without that; equal ones meet and are compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                values = BYTES[np.frombuffer(word.encode("latin-1"), np.uint8)]
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(BASE, len(values))[: len(values)])])
                whole, without = mix(total[-1:]), mix(total[:-1] + (total[-1] - total[1:]) * np.uint64(UNBASE))
                at = np.arange(-1, len(values), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(whole, len(at)).view(np.int64)), pa.array(at), pa.array(np.concatenate([whole, without]).view(np.int64))], names=["id", "at", "key"])

    long = words.where(F.length("word") >= LONG).select("word")
    sent = stored(long.mapInArrow(run, "id long, at int, key long"))
    names = stored(long.mapInArrow(_named, "id long, word string"))
    whole, without = sent.where("at < 0").select("key", F.col("id").alias("other")), sent.where("at >= 0")
    replaced = without.join(without.select("key", "at", F.col("id").alias("other")), ["key", "at"]).where("id <> other").select("id", "other", "at")
    shorter = without.join(whole, "key").select("id", "other", "at")
    pairs = replaced.unionByName(shorter).groupBy("id", "other").agg(F.min("at").alias("at"))
    pairs = pairs.join(names, "id").join(names.select(F.col("id").alias("other"), F.col("word").alias("near")), "other")
    cut = lambda x: F.expr(f"concat(left({x}, at), substring({x}, at + 2))")
    pairs = pairs.where((cut("word") == cut("near")) & (F.length("word") == F.length("near")) | (cut("word") == F.col("near")))
    pairs = pairs.where(F.greatest(F.length("word"), F.length("near")) > LONG).select("word", "near", (F.length("word") > F.length("near")).alias("one_way"))
    done = stored(pairs.select(F.explode(F.expr("CASE WHEN one_way THEN array(struct(word, near), struct(near AS word, word AS near)) ELSE array(struct(word, near)) END")).alias("p")).select("p.word", "p.near"))
    dropped(sent, names)
    return done


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, word) with the ids of near_long."""
    for batch in batches:
        ids = []
        for word in batch.column(0).to_pylist():
            values = BYTES[np.frombuffer(word.encode("latin-1"), np.uint8)]
            ids.append(mix(np.array([np.sum(values * powers(BASE, len(values))[: len(values)])], np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *ids]).view(np.int64)), batch.column(0)], names=["id", "word"])


# ---------------------------------------------------------------- forms and roots


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word that following forms leads to; forms: (word, form)."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        dropped(at)
        at = moved
        if at.where("moved").isEmpty():
            return at


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; words: (word, n), each word once."""
    near = near_short(words.where(F.length("word") <= LONG).select("word"))
    if not words.where(F.length("word") > LONG).isEmpty():
        near = near.unionByName(near_long(words))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("form_n"))
    best = near.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("k"), F.col("near").alias("form"), "form_n")).alias("best"))
    own = words.join(best, "word", "left").withColumn("strong", F.coalesce(F.col("best.form_n") >= RATIO * F.col("n"), F.lit(False)))
    own = stored(own.select(
        "word", F.when(F.col("strong"), F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("strong"), F.col("best.form_n")).alias("form_n")
    ))
    found = own.join(roots(own.where("form IS NOT NULL")).select("word", "root"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(docs: DataFrame) -> DataFrame:
    """The contract's columns, for all words of the documents."""
    return variants(stored(word_counts(docs)))
