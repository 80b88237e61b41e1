"""LM scoring by prediction by partial matching (PPM) over bytes.

A byte-context trie of order ORDER is counted over the training documents. A byte's probability is taken in the longest
context that the trie has; a byte unseen there escapes to the next shorter context (each distinct byte
of the context gives half a count to the escape, method D), and the bytes of the longer context are excluded there; below order 0 the bytes left are
equally likely. With frozen counts the probability depends on the last ORDER bytes and the byte alone.

The trie grows with the corpus, so it is never broadcast. Documents are dealt to blocks of bounded size by a hash of
id and text. Each block sends its distinct (ORDER+1)-grams with their training counts; they are summed over all blocks, all
contexts that end in the same three bytes come together, where the log probability of each of their grams is computed, and
each block gets those of its own grams back. Only orders 0 to 2 are broadcast, counts of at most 16.8 million three-byte
sequences however large the corpus is (some hundred thousand in natural text, twelve bytes each). Word counts take the
same way.

What is scored is the lower-cased (A-Z) token sequence: words `[^\\x20\\x09-\\x0D]+` joined by one space, then an end
symbol; so it compares with a word model of the same tokens. `adaptive` scores each document by counts of its own
preceding bytes instead.

Results for special rows: null and empty texts are the end alone; very long texts are scored whole; repeated rows and
equal texts get equal scores; a null doc_id counts as the empty text for the fold; without training documents every byte
is equally likely; an empty table gives an empty table; only doc_id and text are read. Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import BYTES, blocks_for, crc_mod5, dropped, rolled, spans, steps, stored, texts

ORDER = 5
START, END = 0xFE, 0xFF
#: Bytes that can follow: all but START, which only pads the beginning.
ALPHABET = 255
#: What each distinct byte of a context gives to the escape (method D).
DISCOUNT = 0.5
#: Bytes of text in a block, and in one numpy step, which takes some eighty times as much.
BLOCK, STEP = 8 << 20, 1 << 19
END_TOKEN = np.uint64(0xE7D)


def tokens(values: list[bytes]) -> list[bytes]:
    """Lower-cased words joined by one space."""
    return [b" ".join(x.lower().split()) for x in values]


def grams(values: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(gram, text) of every byte of each text and its end: the order bytes before and the byte, as one number."""
    pad = bytes([START]) * order
    buf = np.frombuffer(b"".join([pad + x + bytes([END]) for x in values]), np.uint8).astype(np.int64)
    size = np.array([len(x) + 1 for x in values], np.int64)
    code = np.zeros(max(len(buf) - order, 0), np.int64)
    for k in range(order + 1):
        code = (code << 8) | buf[k : k + len(code)]
    begin = np.cumsum(size + order) - (size + order)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    return code[at], np.repeat(np.arange(len(values)), size)


def word_keys(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every token of each text; values: from tokens(); the end token comes last."""
    buf = np.frombuffer(b" ".join(values) + b" ", np.uint8)
    starts, ends = spans(buf)
    first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in values])]).astype(np.int64)
    h = rolled(BYTES[buf], starts, ends)
    bounds = np.searchsorted(starts, first)
    h = np.insert(h, bounds[1:], END_TOKEN)
    return h.view(np.int64), np.repeat(np.arange(len(values)), np.diff(bounds) + 1)


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, how often each is in training texts)."""
    if len(keys) and keys.min() >= 0 and keys.max() < 1 << 62:
        # grams leave room for a bit, so that one sort tells both
        marked = np.sort((keys << 1) | train)
        found = marked >> 1
        new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        return found[new], np.add.reduceat(marked & 1, new)
    found = np.unique(keys)
    mine, n = np.unique(keys[train], return_counts=True)
    out = np.zeros(len(found), np.int64)
    out[np.searchsorted(found, mine)] = n
    return found, out


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n, new) if len(new) else n


class LowOrders:
    """Training counts of orders 0 to 2: how often each sequence of three, two and one bytes was seen."""

    def __init__(self, threes: np.ndarray, n: np.ndarray) -> None:
        """threes: distinct sequences of three bytes as numbers."""
        order = np.argsort(threes)
        self.keys, self.n = threes[order].astype(np.int32), n[order].astype(np.int64)
        self.two = np.bincount(self.keys & 0xFFFF, self.n, 65536).astype(np.int64).reshape(256, 256)
        self.one = self.two.sum(0)
        context = self.keys >> 8
        self.whole = {2: np.bincount(context, self.n, 65536).astype(np.int64), 1: self.two.sum(1), 0: np.array([self.one.sum()])}
        self.distinct = {2: np.bincount(context, minlength=65536), 1: (self.two > 0).sum(1), 0: np.array([(self.one > 0).sum()])}
        # counts at order 0 (1) of the bytes that each context of one byte (two bytes) has
        self.shadow = (self.two > 0) @ self.one
        self.shadow_one = np.bincount(context, self.two.ravel()[self.keys & 0xFFFF], 65536).astype(np.int64)

    def counts(self, order: int, gram: np.ndarray) -> np.ndarray:
        if order < 2:
            return self.two.ravel()[gram] if order else self.one[gram]
        slot = np.searchsorted(self.keys, gram)
        slot[slot == len(self.keys)] = 0
        return np.where(self.keys[slot] == gram, self.n[slot], 0) if len(self.keys) else np.zeros(len(gram), np.int64)


def log_probabilities(code: np.ndarray, n: np.ndarray, low: LowOrders, order: int = ORDER) -> np.ndarray:
    """log10 probability of each distinct gram, given the training counts n of all grams that share the last three context bytes.

    Orders 2 to 0 come from low; order is 3 at least.
    """
    symbol, out = code & 255, np.zeros(len(code))
    open_ = np.ones(len(code), bool)
    longer: tuple | None = None  # of the next longer order: its context exists, distinct bytes, contexts, grams, counts
    for k in range(order, -1, -1):
        context = (code >> 8) & ((1 << (8 * k)) - 1)
        gram = (context << 8) | symbol
        if k > 2:
            grams_, row = np.unique(gram, return_inverse=True)
            count = np.bincount(row, n, len(grams_)).astype(np.int64)
            names, of = np.unique(grams_ >> 8, return_inverse=True)
            whole = np.bincount(of, count, len(names)).astype(np.int64)[of][row]
            distinct = np.bincount(of, count > 0, len(names)).astype(np.int64)[of][row]
            c = count[row]
        else:
            c, whole, distinct = low.counts(k, gram), low.whole[k][context], low.distinct[k][context]
        exists = whole > 0
        escape, total = DISCOUNT * distinct, whole
        if longer is not None:
            was, was_distinct, was_context, was_gram, was_count = longer
            if k == 0:
                excluded = low.shadow[was_context]
            elif k == 1:
                excluded = low.shadow_one[was_context]
            else:
                # counts at this order of the bytes that the longer context has: one row for each of its grams
                _, one = np.unique(was_gram, return_index=True)
                seen = one[was_count[one] > 0]
                names, at = np.unique(was_context, return_inverse=True)
                excluded = np.bincount(at[seen], c[seen], len(names)).astype(np.int64)[at]
            escape = DISCOUNT * np.where(was, distinct - was_distinct, distinct)
            total = np.where(was, whole - excluded, whole)
        hit = open_ & exists & (c > 0)
        out[hit] += np.log10((c[hit] - DISCOUNT) / total[hit])
        miss = open_ & exists & (c == 0) & (escape > 0)
        out[miss] += np.log10(escape[miss] / total[miss])
        open_ &= ~hit
        longer = exists, distinct, context, gram, c
    out[open_] -= np.log10(max(ALPHABET - int((low.one > 0).sum()), 1))
    return out


def in_blocks(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(block, doc_id, text, held_out)."""
    n = blocks_for(docs, text, BLOCK)
    # by the text as well, as many rows may share an id
    return docs.select(F.pmod(F.xxhash64(doc_id, text), F.lit(n)).cast("int").alias("block"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), "held_out")


def gathered(blocks: DataFrame, order: int = ORDER) -> DataFrame:
    """(block, word, key, n): each block's distinct grams (word: false) and words (true) with their counts in training texts."""

    def run(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        values, train = texts(group.column("text").combine_chunks()), ~group.column("held_out").to_numpy()
        out = []
        for f in (lambda x: grams(x, order), word_keys):
            parts = []
            for lo, hi in steps(values, STEP):
                keys, of = f(tokens(values[lo:hi]))
                parts.append(counted(keys, train[lo:hi][of]))
            out.append(merged(parts))
        n = [len(k) for k, _ in out]
        return pa.table({"block": pa.array(np.full(sum(n), block, np.int32)), "word": pa.array(np.repeat([False, True], n)), "key": pa.array(np.concatenate([k for k, _ in out])), "n": pa.array(np.concatenate([c for _, c in out]))})

    return blocks.groupBy("block").applyInArrow(run, "block int, word boolean, key long, n long")


def low_orders(counts: DataFrame) -> LowOrders:
    """Orders 0 to 2 from the grams' last three bytes: at most 16.8 million rows, whatever the corpus."""
    last = F.col("key").bitwiseAND(F.lit(0xFFFFFF)).cast("int").alias("three")
    found = counts.where("not word and n > 0").groupBy(last).agg(F.sum("n").alias("n")).toArrow()
    return LowOrders(found.column("three").to_numpy(), found.column("n").to_numpy())


def gram_values(counts: DataFrame, low: LowOrders, order: int = ORDER) -> DataFrame:
    """(word, key, value): the log10 probability of every gram. Contexts come sorted by their last three bytes, and all that
    are complete in a batch are computed together."""
    sent = counts.sparkSession.sparkContext.broadcast(low)

    def told(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        value = log_probabilities(code, n, sent.value, order)
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(code), bool)), pa.array(code), pa.array(value)], names=["word", "key", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            code, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            last = (code >> 8) & 0xFFFFFF
            if not len(code):
                continue
            if held and (held[-1][0][-1] >> 8) & 0xFFFFFF != last[-1] or not held and last[0] != last[-1]:
                cut = int(np.searchsorted(last == last[-1], True))
                yield told(*(np.concatenate([*(h[k] for h in held), (code, n)[k][:cut]]) for k in (0, 1)))
                held = [(code[cut:], n[cut:])]
            else:
                held.append((code, n))
        if held:
            yield told(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))

    context = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFFFF))
    dealt = counts.where("not word").select("key", "n").repartition(context).sortWithinPartitions(context)
    return dealt.mapInArrow(run, "word boolean, key long, value double")


def scored(blocks: DataFrame, values: DataFrame, train_tokens: int, distinct: int, order: int = ORDER) -> DataFrame:
    """Every document's scores; values: (block, word, key, value)."""
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    floor = train_tokens + 0.5 * (distinct + 1)

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        texts_, out = texts(docs.column("text").combine_chunks()) if docs.num_rows else [], []
        is_word, keys, value = (table.column(x).to_numpy() for x in ("word", "key", "value"))
        found = []
        for kind in (False, True):
            k, v = keys[is_word == kind], value[is_word == kind]
            sort = np.argsort(k)
            found.append((k[sort], v[sort]))
        for lo, hi in steps(texts_, STEP):
            part, n = tokens(texts_[lo:hi]), hi - lo
            code, of = grams(part, order)
            # one lookup for each distinct gram of a text; in the grams' order, in which lookups are far quicker
            room = 64 - 8 * (order + 1)
            if n < 1 << room:
                key = np.sort((code.astype(np.uint64) << np.uint64(room)) | of.astype(np.uint64))
                new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                times = np.diff(np.append(new, len(key)))
                of, code = (key[new] & np.uint64((1 << room) - 1)).astype(np.int64), (key[new] >> np.uint64(room)).astype(np.int64)
            else:
                times = np.ones(len(code))
            score = np.bincount(of, times * found[0][1][np.searchsorted(found[0][0], code)], n)
            h, of = word_keys(part)
            c = found[1][1][np.searchsorted(found[1][0], h)]
            base = np.bincount(of, np.log10((c + 0.5) / floor), n)
            out.append((np.bincount(of, minlength=n), np.bincount(of, c > 0, n), base, score))
        size, known, base, score = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0),) * 4
        return pa.table({
            "doc_id": docs.column("doc_id").cast(pa.int64()), "held_out": docs.column("held_out"), "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(size), train_tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(score),
        })

    return blocks.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(run, schema)


def pretrained(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER) -> DataFrame:
    """Scores of all documents under the trie of those that aren't held_out (a boolean column)."""
    blocks = in_blocks(docs, text, doc_id)
    sent = stored(gathered(blocks, order))
    counts = stored(sent.groupBy("word", "key").agg(F.sum("n").alias("n")))
    train_tokens, distinct = counts.where("word and n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    values = gram_values(counts, low_orders(counts), order).unionByName(counts.where("word").select("word", "key", F.col("n").cast("double").alias("value")))
    own = stored(sent.select("block", "word", "key").join(values, ["word", "key"]).select("block", "word", "key", "value"))
    dropped(sent, counts)
    return scored(blocks, own, train_tokens, distinct, order)


def adaptive_code_length(text: bytes, order: int = ORDER) -> float:
    """Bits of one text under counts of its own bytes so far, with escapes and exclusion as above."""
    counts: dict[bytes, dict[int, int]] = {}
    data, bits = bytes([START]) * order + text + bytes([END]), 0.0
    for i in range(order, len(data)):
        byte, excluded = data[i], set()
        for k in range(order, -1, -1):
            seen = {s: c for s, c in counts.get(data[i - k : i], {}).items() if s not in excluded}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if byte in seen:
                bits -= np.log2(seen[byte] / total)
                break
            bits -= np.log2(len(seen) / total)
            excluded |= seen.keys()
        else:
            bits += np.log2(ALPHABET - len(excluded))
        for k in range(order + 1):
            own = counts.setdefault(data[i - k : i], {})
            own[byte] = own.get(byte, 0) + 1
    return float(bits)


def adaptive(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER) -> DataFrame:
    """(doc_id, n_bytes, bits): the adaptive code length of each document's lower-cased token sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = tokens(texts(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in values], pa.int64()), pa.array([adaptive_code_length(x, order) for x in values])], names=["doc_id", "n_bytes", "bits"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, n_bytes long, bits double")


def op3_lm_score(docs: DataFrame) -> DataFrame:
    """The contract's columns: documents whose crc32(doc_id as text) mod 5 is 1 are held out."""
    return pretrained(docs.select("doc_id", "text", (crc_mod5() == 1).alias("held_out")))


