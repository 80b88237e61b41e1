"""BPE encoding and decoding: speculate and verify.

A word is first cut greedily into the longest tokens that the vocabulary has. That guess is the exact result if each pair
of neighbours is compatible, i.e. merging the two tokens' letters alone gives just these two tokens. The test of a pair
walks down the right edge of the left token and the left edge of the right token in the order in which merging would
have built them, and fails where a merge across the seam would have come first; it is done in numpy for all pairs of all
words of a batch at once. Only words with a pair that fails are merged exactly, one merge after the
other, all such words of a batch side by side.

Texts are cut into words in numpy as well, by the classes of their characters; each word is known by a 64-bit hash among
the at most REMEMBERED words of a worker's table (a clash is expected once in 100 million such tables).

Files: the JSON format of the tokenizers library, BPE with a word-end suffix, NFC, white space and lower-case
normalizers, the word pattern PATTERN and the byte-level alphabet, no decoder (tokens joined by a space).

Results for special rows: null and empty texts have no ids and decode to the empty text; very long texts are encoded
whole; special tokens in a text become their ids as they are spelled, as the library does by default (in other cases they
are plain text); null ids and ids out of the vocabulary decode to nothing; repeated rows get equal results; an empty table
gives an empty one; other columns stay, those named like the results are replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from netquarry.llm.common import BYTES, rolled, steps

#: Words that a worker remembers, about 40 bytes each; its table is started anew beyond that.
REMEMBERED = 1 << 19
#: Words of more bytes than this are cut and merged one by one.
LONG = 64
#: Fixed value: the word pattern of the files this module reads.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE, LETTER, DIGIT, SIGN, SPECIAL = range(5)
#: The first of the bytes that stand for special tokens: UTF-8 has none of them.
MARK = 0xF8
_NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 as is, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = [""] * 256, 0
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return table


def _every() -> str:
    return "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))


def character_classes(cut: pre_tokenizers.PreTokenizer) -> np.ndarray:
    """The class of each code point, as the library's own word pattern sees it; cut: its pre-tokenizer.

    One pass over all code points gives runs of one class (digits alone); the first of each run is tried beside a letter and a
    sign.
    """
    alone = lambda text: len(cut.pre_tokenize_str(text)) == 1
    kind = np.full(0x110000, WHITE, np.uint8)
    kind[0xD800:0xE000] = SIGN
    gap = lambda at: at + 0x800 * (at >= 0xD800)
    for piece, (start, end) in cut.pre_tokenize_str(_every()):
        found = LETTER if alone("a" + piece[0]) else SIGN if alone("+" + piece[0]) else DIGIT
        kind[gap(start) : gap(end - 1) + 1] = found
    return kind


def unlike_points(normalize: Callable[[str], str]) -> set[int]:
    """Code points on which this Python's Unicode tables and the library's may differ, alone or behind and before marks.

    Those that Python doesn't know, and those which come out otherwise in three surroundings, with what they come out as.
    """
    unknown = [unicodedata.category(c) == "Cn" for c in _every()]
    found = {ord(c) for c, new in zip(_every(), unknown, strict=True) if new}
    every = [c for c, new in zip(_every(), unknown, strict=True) if not new and c != "|"]
    for before, after in (("", ""), ("a", "\u0334\u0301"), ("\u1100", "\u11a8")):
        text = "".join([f"{before}{c}{after}|" for c in every])
        mine, theirs = Splitter.folded(text), normalize(text)
        if mine != theirs:
            for c, x, y in zip(every, mine.split("|"), theirs.split("|"), strict=False):
                if x != y:
                    found |= {ord(k) for k in c + Splitter.folded(c) + normalize(c)}
    # compositions that one side alone makes
    pairs = [(c, d.split()) for c in every if len((d := unicodedata.decomposition(c)).split()) == 2 and "<" not in d]
    for c, parts in pairs:
        text = "".join([chr(int(x, 16)) for x in parts])
        if Splitter.folded(text) != normalize(text):
            found |= {ord(k) for k in c + text}
    return {x for x in found if x > 0xFF}


@lru_cache(maxsize=4)
def library_tables(normalizer: str, cut: str) -> tuple[np.ndarray, np.ndarray]:
    """(classes of all code points, whether the library must normalize a text that has one); from the file's JSON parts."""
    part = json.loads(cut)
    split = pre_tokenizers.Split(Regex(part["pattern"]["Regex"]), part["behavior"].lower(), part["invert"])
    unlike = np.zeros(0x110000, bool)
    unlike[sorted(unlike_points(library_normalizer(normalizer, ("NFC", "Lowercase")).normalize_str))] = True
    return character_classes(split), unlike


def library_normalizer(normalizer: str, kinds: tuple[str, ...] = ("NFC", "Replace", "Lowercase")) -> normalizers.Normalizer:
    made = {"NFC": lambda n: normalizers.NFC(), "Lowercase": lambda n: normalizers.Lowercase(), "Replace": lambda n: normalizers.Replace(Regex(n["pattern"]["Regex"]), n["content"])}
    return normalizers.Sequence([made[n["type"]](n) for n in json.loads(normalizer)["normalizers"] if n["type"] in kinds])


class Splitter:
    """Cuts texts into the words of PATTERN; special tokens are words of one byte from MARK on.

    Letters, digits and white space are what the library takes them for. Texts are folded by Python; where one has a code
    point on which the two may differ, by the library.
    """

    def __init__(self, special: list[str], normalizer: str, cut: str) -> None:
        if len(special) > 256 - MARK:
            raise ValueError(f"over {256 - MARK} special tokens")
        self.marks = {t: bytes([0x20, MARK + k, 0x20]) for k, t in enumerate(special)}
        self.found = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.kind, self.unlike = library_tables(normalizer, cut)
        self.normalizer, self.library = normalizer, None
        self.ascii = np.full(256, SPECIAL, np.uint8)
        self.ascii[:128] = self.kind[:128]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"library": None}

    def normalized(self, text: str) -> bytes:
        """UTF-8 of the text in NFC and lower case; special tokens, found as spelled, are marked."""
        if self.found and "<" in text:
            return b"".join([self.marks[x] if k % 2 else self._plain(x) for k, x in enumerate(self.found.split(text))])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            return text.lower().encode()
        if not self._alike(text):
            if self.library is None:
                self.library = library_normalizer(self.normalizer)
            return self.library.normalize_str(text).encode()
        return self.folded(text).encode()

    def _alike(self, text: str) -> bool:
        """Whether Python folds the text as the library does; the two never differ on Latin-1."""
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            return not self.unlike[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any()

    @staticmethod
    def folded(text: str) -> str:
        # lower-cased letter by letter, without final forms
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()

    def words(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words in buf (uint8)."""
        n = len(buf)
        kind = self.ascii[buf]
        new = np.ones(n + 1, bool)
        lead = np.flatnonzero((buf >= 0xC0) & (buf < MARK))
        begins = None
        if len(lead):
            padded = np.append(buf, np.zeros(3, np.uint8)).astype(np.int32)
            b0, b1, b2, b3 = (padded[lead + k] for k in range(4))
            size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
            point = np.where(size == 2, (b0 & 31) << 6 | b1 & 63, np.where(size == 3, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63, (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
            value = self.kind[np.minimum(point, 0x10FFFF)]
            kind[lead] = value
            for k in (1, 2, 3):
                kind[lead[size > k] + k] = value[size > k]
            begins = (buf & 0xC0) != 0x80
        single = (kind == DIGIT) | (kind == SPECIAL)
        new[1:n] = (kind[1:] != kind[:-1]) | (single[1:] if begins is None else single[1:] & begins[1:])
        at = np.flatnonzero(buf == 0x27)
        if len(at):
            at = at[new[at]]  # an apostrophe inside a run of signs starts no contraction
            ext = np.append(buf, np.zeros(2, np.uint8))
            c, d = ext[at + 1], ext[at + 2]
            one = np.isin(c, np.frombuffer(b"stmd", np.uint8))
            two = ((c == 0x72) | (c == 0x76)) & (d == 0x65) | (c == 0x6C) & (d == 0x6C)
            new[at[one | two] + 1] = False
            new[at[one] + 2] = True
            new[at[two] + 3] = True
        edges = np.flatnonzero(new)
        word = kind[edges[:-1]] != WHITE
        return edges[:-1][word], edges[1:][word]


class WordTable:
    """Ids of the words met so far by the words' hashes, in flat arrays; started anew beyond REMEMBERED words."""

    def __init__(self, splitter: Splitter, learn: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> None:
        """learn(buf, starts, ends): (ids of all these words, number of ids of each)."""
        self.splitter, self.learn = splitter, learn
        self.reset()

    def reset(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.end = np.zeros(1 << 14, np.int32), 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        values = [self.splitter.normalized(x) if x else b"" for x in texts]
        flat, n = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lo, hi in steps(values):
            ids, count = self._encode(values[lo:hi])
            flat.append(ids)
            n.append(count)
        return np.concatenate(flat), np.concatenate(n)

    def _encode(self, values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        buf = np.frombuffer(b" ".join(values) + b" ", np.uint8)
        starts, ends = self.splitter.words(buf)
        first = np.zeros(len(values) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in values], out=first[1:])
        hashes, one, back = np.unique(rolled(BYTES[buf], starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.reset()
        slot = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == hashes[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            ids, size = self.learn(buf, starts[one[new]], ends[one[new]])
            while self.end + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.end : self.end + len(ids)] = ids
            self.keys = np.insert(self.keys, slot[new], hashes[new])
            self.start = np.insert(self.start, slot[new], self.end + np.cumsum(size) - size)
            self.size = np.insert(self.size, slot[new], size)
            self.end += len(ids)
            slot = np.searchsorted(self.keys, hashes)
        which = slot[back]
        n = self.size[which].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        flat = self.flat[np.arange(total[-1]) + np.repeat(self.start[which] - total[:-1], n)]
        bounds = np.searchsorted(starts, first)
        return flat, np.diff(total[bounds])


class Bpe:
    """A vocabulary with its merges, ready to encode words."""

    def __init__(self, source: bytes) -> None:
        data = json.loads(source)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        kinds = [n["type"] for n in data["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or data.get("decoder") or data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"a tokenizer of another kind: {kinds}")
        self.splitter = Splitter(list(self.special), json.dumps(data["normalizer"]), json.dumps(data["pre_tokenizer"]["pretokenizers"][0]))
        letters = byte_letters()
        n = 1 + max(chain(self.ids.values(), self.special.values()))
        self.tokens = [""] * n
        for t, i in chain(self.ids.items(), self.special.items()):
            self.tokens[i] = t
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        left = np.array([self.ids[a] for a, _ in pairs], np.int64)
        right = np.array([self.ids[b] for _, b in pairs], np.int64)
        self.size = n
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.merge = {(a, b): (r, c) for r, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True))}
        key = left * n + right
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order.astype(np.int64)
        # how each token is built: the halves and rank of its last merge; letters have none
        self.left, self.right, self.rank = np.arange(n), np.arange(n), np.full(n, -1, np.int64)
        reachable = np.zeros(n, bool)
        reachable[[i for t, i in self.ids.items() if len(t.removesuffix(self.end) if t != self.end else t) == 1]] = True
        for r, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True)):
            if self.rank[c] < 0 and reachable[a] and reachable[b]:
                left_, right_ = self._last(self.symbols(self.tokens[c]))
                if self.merge.get((left_, right_), (0, -1))[1] == c:
                    self.left[c], self.right[c] = left_, right_
                    self.rank[c] = self.merge[left_, right_][0]
                    reachable[c] = True
        self.made = made
        #: Ids of each byte's letter, inside a word and at its end.
        self.letter = np.array([self.ids[x] for x in letters], np.int64)
        self.last_letter = np.array([self.ids[x + self.end] for x in letters], np.int64)
        # the walk in compatible() needs halves that were built before the whole; words with other tokens are merged exactly
        early = (self.rank > self.rank[self.left]) & (self.rank > self.rank[self.right]) | (self.rank < 0)
        self.usable = {t: i for t, i in self.ids.items() if reachable[i] and early[i]}
        self._plant(self.usable, {x: b for b, x in enumerate(letters)})
        utf8 = [t.encode() + b" " for t in self.tokens]
        self.said = np.frombuffer(b"".join(utf8), np.uint8)
        self.said_size = np.array(list(map(len, utf8)), np.int64)
        self.said_at = np.cumsum(self.said_size) - self.said_size
        self.table: WordTable | None = None

    def _plant(self, usable: dict[str, int], byte: dict[str, int]) -> None:
        """The trie of the usable tokens: sorted (node, byte) keys, their children, and the tokens that end at a node inside or at the end of a word."""
        child: dict[int, int] = {}
        ends: list[tuple[int, int, bool]] = []
        for t, i in usable.items():
            body = t.removesuffix(self.end)
            node = 0
            for x in body:
                node = child.setdefault(node * 256 + byte[x], len(child) + 1)
            ends.append((node, i, body != t))
        keys = np.array(list(child), np.int64)
        order = np.argsort(keys)
        self.trie, self.child = keys[order], np.array(list(child.values()), np.int64)[order]
        self.inside, self.whole = np.full(len(child) + 1, -1, np.int64), np.full(len(child) + 1, -1, np.int64)
        for node, i, last in ends:
            (self.whole if last else self.inside)[node] = i

    def symbols(self, word: str) -> list[int]:
        """Ids of the letters of a word in byte letters with its end mark, if it has one."""
        body = word.removesuffix(self.end)
        letters = list(body)
        if body != word and letters:
            letters[-1] += self.end
        return [self.ids[x] for x in letters]

    def exact(self, ids: list[int]) -> list[int]:
        """Merging by rank, the leftmost of equals first; the pairs wait in a heap, so long words take little more than their length."""
        ids, n = list(ids), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merge[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merge]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merge[a, b][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (p := (ids[k], ids[after[k]])) in self.merge:
                    heapq.heappush(heap, (self.merge[p][0], k, *p))
        return [x for x in ids if x >= 0]

    def _last(self, ids: list[int]) -> tuple[int, int]:
        """The two tokens that the last merge of these letters would join."""
        while len(ids) > 2:
            r, i = min((self.merge.get(p, (_NONE, 0))[0], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)))
            if r == _NONE:
                return -1, -1
            ids[i : i + 2] = [self.merge[ids[i], ids[i + 1]][1]]
        return ids[0], ids[1]

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        slot = np.searchsorted(self.keys, key)
        slot[slot == len(self.keys)] = 0
        return np.where(self.keys[slot] == key, self.ranks[slot], _NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the letters of a and b together gives a, b.

        Time runs backwards: at each step the edge token that was built last is taken apart. A merge across the seam
        must not have come before the merges that consumed its two tokens; of equal ranks the left one comes first.
        """
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        # rank of the merge that took the left (right) edge token into a larger one; none yet
        used_a, used_b = np.full(len(a), _NONE), np.full(len(a), _NONE)
        while len(live):
            r = self.pair_rank(a, b)
            # consumed on the left by a merge at a place before the seam: that one wins a tie, the one behind loses it
            bad = (r < used_a) & (r <= used_b) & (r < _NONE)
            ok[live[bad]] = False
            go = ~bad & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            live, a, b, used_a, used_b = live[go], a[go], b[go], used_a[go], used_b[go]
            if not len(live):
                break
            ra, rb = self.rank[a], self.rank[b]
            take_a = ra > rb  # of equal ranks the right one is built later, but both orders meet the same pairs
            used_a = np.where(take_a, ra, used_a)
            used_b = np.where(take_a, used_b, rb)
            a, b = np.where(take_a, self.right[a], a), np.where(take_a, b, self.left[b])
        return ok

    def greedy(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, word of each): the longest token at each place of each word, all words at once, one token a round."""
        word, at = np.arange(len(starts)), starts.copy()
        tokens, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(word):
            best, size = np.full(len(word), -1), np.zeros(len(word), np.int64)
            live, node, k = np.arange(len(word)), np.zeros(len(word), np.int64), 0
            while len(live):
                key = node * 256 + buf[at[live] + k]
                slot = np.searchsorted(self.trie, key)
                slot[slot == len(self.trie)] = 0
                ok = self.trie[slot] == key
                live, node = live[ok], self.child[slot[ok]]
                k += 1
                # a token without the end mark can't take the word's last letter
                left = ends[word[live]] - at[live] - k
                found = np.where(left == 0, self.whole[node], self.inside[node])
                hit = found >= 0
                best[live[hit]], size[live[hit]] = found[hit], k
                live, node = live[left > 0], node[left > 0]
            tokens.append(best)
            of.append(word)
            at = at + size
            more = at < ends[word]
            word, at = word[more], at[more]
        tokens, of = np.concatenate(tokens), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        return tokens[order], of[order]

    def _ranks(self, flat: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair at each of these places; none at the end of a word."""
        out = np.full(len(at), _NONE)
        k = np.flatnonzero(at + 1 < len(flat))
        k = k[word[at[k]] == word[at[k] + 1]]
        out[k] = self.pair_rank(flat[at[k]], flat[at[k] + 1])
        return out

    def merge_all(self, flat: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exact() of many words at once: in each round every word makes its merge of lowest rank, the leftmost of equals."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self._ranks(flat, word, np.arange(len(flat)))
        while len(flat):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(flat))))
            over = lowest == _NONE
            if over.any():
                done.append((word[over], flat[over]))
            at = np.flatnonzero((rank == lowest) & ~over)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])] if len(at) else at
            flat[at] = self.made[rank[at]]
            keep = ~over
            keep[at + 1] = False
            flat, word, rank = flat[keep], word[keep], rank[keep]
            # only the pairs on both sides of a merge are new
            moved = np.cumsum(keep)[at] - 1
            fresh = np.concatenate([moved, moved[moved > 0] - 1])
            rank[fresh] = self._ranks(flat, word, fresh)
        if not done:
            return flat, word
        word, flat = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return flat[order], word[order]

    def learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of the words buf[starts:ends]."""
        special, long = buf[starts] >= MARK, ends - starts > LONG
        plain = np.flatnonzero(~special & ~long)
        flat, of = self._learn(buf, starts[plain], ends[plain])
        parts = [(flat, plain[of])]
        for k in np.flatnonzero(special | long).tolist():
            if special[k]:
                ids = [list(self.special.values())[int(buf[starts[k]]) - MARK]]
            else:
                letters = self.letter[buf[starts[k] : ends[k]]]
                letters[-1] = self.last_letter[buf[ends[k] - 1]]
                ids = self.exact(letters.tolist())
            parts.append((np.array(ids, np.int64), np.full(len(ids), k)))
        flat, of = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(of, kind="stable")
        return flat[order].astype(np.int32), np.bincount(of, minlength=len(starts))

    def _learn(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, of = self.greedy(buf, starts, ends)
        seam = np.flatnonzero(of[1:] == of[:-1])
        if not len(seam):
            return flat, of
        pair, back = np.unique(flat[seam] * self.size + flat[seam + 1], return_inverse=True)
        fine = self.compatible(pair // self.size, pair % self.size)[back]
        failed = np.unique(of[seam[~fine]])
        if not len(failed):
            return flat, of
        size = ends[failed] - starts[failed]
        total = np.cumsum(size)
        letters = self.letter[buf[np.arange(int(total[-1])) + np.repeat(starts[failed] - total + size, size)]]
        letters[total - 1] = self.last_letter[buf[ends[failed] - 1]]
        merged, whose = self.merge_all(letters, np.repeat(failed, size))
        bad = np.zeros(len(starts), bool)
        bad[failed] = True
        keep = ~bad[of]
        flat, of = np.concatenate([flat[keep], merged]), np.concatenate([of[keep], whose])
        order = np.argsort(of, kind="stable")
        return flat[order], of[order]

    def words(self) -> WordTable:
        """The worker's table, kept from task to task."""
        if self.table is None:
            self.table = WordTable(self.splitter, self.learn)
        return self.table

    def decode(self, flat: np.ndarray, n: np.ndarray) -> pa.Array:
        """The texts of n[0], n[1], ... ids each: their tokens joined by one space."""
        size = np.where((flat >= 0) & (flat < self.size), self.said_size[np.clip(flat, 0, self.size - 1)], 0)
        total = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.said_at[np.clip(flat, 0, self.size - 1)] - total[:-1], size) + np.arange(total[-1])
        out = self.said[at]
        bounds = total[np.concatenate([[0], np.cumsum(n)])]
        # the space after each text's last token goes
        last = bounds[1:][np.diff(bounds) > 0] - 1
        out = np.delete(out, last)
        bounds = bounds - np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)])
        return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))


def vocabulary(path: str) -> Bpe:
    """The vocabulary file with its tables, made on the driver; its size (a few MB) doesn't depend on the data."""
    with open(path, "rb") as f:
        return Bpe(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with `ids` (array<int>)."""
    return _apply(docs, path, text, ids, None)


def decode(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """docs with `decoded` (the text of the ids)."""
    return _apply(docs, path, None, ids, decoded)


def encode_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """docs with `ids` and, decoded from them in the same pass, `decoded`."""
    return _apply(docs, path, text, ids, decoded)


#: Bytes of text, or ids, that one batch on its way back to Spark holds; a longer document is a batch of its own.
BATCH = 1 << 20


def _apply(docs: DataFrame, path: str, text: str | None, ids: str, decoded: str | None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    replaced = {decoded} | ({ids} if text else set())
    fields = [f for f in docs.schema.fields if f.name not in replaced]
    added = ([T.StructField(ids, T.ArrayType(T.IntegerType()))] if text else []) + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = sent.value
        for whole in batches:
            size = whole.column(text or ids)
            size = pa.compute.binary_length(size) if text else pa.compute.list_value_length(size)
            upto = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // BATCH
            cuts = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), whole.num_rows]
            for batch in (whole.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a):
                columns = [batch.column(f.name) for f in fields]
                if text:
                    flat, n = bpe.words().encode(batch.column(text).to_pylist())
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(flat, pa.int32())))
                else:
                    given = batch.column(ids)
                    flat, n = given.flatten().fill_null(-1).to_numpy(zero_copy_only=False), given.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                if decoded:
                    columns.append(bpe.decode(flat.astype(np.int64), n).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*fields, *added]])

    return docs.select(*[f.name for f in docs.schema.fields if f.name not in replaced or f.name == text]).mapInArrow(run, T.StructType([*fields, *added]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    done = encode_decode(docs.select("doc_id", "text"), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
