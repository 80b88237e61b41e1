r"""Periodic runs of words, by Baier's grouping.

A run is a stretch of words with smallest period q that can't be extended on either side. Each run contains a Lyndon root:
the longest Lyndon word that starts at some place of it, under one of the two orders of the words, is q words long. So:

1. Suffix-sorter phase one (Baier): suffixes start in groups by their first word. From the highest group down, each
   suffix tells its group to the nearest place before it whose group is still lower; that place joins, in a group of its own
   right above its old one, with as many copies of the group's prefix as it was told. At the end each suffix's prefix is
   its longest Lyndon word: the Lyndon array, here for the words' order and for the reverse one.
2. Each Lyndon word is a candidate root; equal words q apart are extended both ways by longest common extensions (binary
   search over prefix hashes, all candidates together), and what is long enough is a run. Each run found is compared word
   by word, so that no hash decides.

Before that, places that can be in no run wanted are put aside: a run of at least 4 periods and 6 words holds each of its
three-word windows at least three times. Texts are cut where a window occurs less often, again and again until nothing
changes (in numpy for many texts together); the phases run on the stretches left, where words are ranked exactly.

Words: `[^\x20\x09-\x0D]+`. Results for special rows: null, empty and short texts have no runs; very long texts are taken
whole, each in one task, with memory in proportion to their words; repeated rows and rows that share an id have their own
results; a null doc_id counts as the empty text for the fold; an empty table gives an empty table; other columns aren't
read; ties for the strongest run go to the smallest start, then the smallest period.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from netquarry.llm.common import mix, rolled, steps, texts, words

#: Least exponent and least length of the runs told.
EXPONENT, LENGTH = 4, 6
GRAM = 3

Run = tuple[int, int, int]  # start, length, period


def lyndon_array(s: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place of s, by Baier's phase one."""
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    group = [0] * (n + 1)
    members: list[list[int]] = []
    size: list[int] = []
    last = None
    for i in order:  # ascending by word, then place
        if s[i] != last:
            last = s[i]
            members.append([])
            size.append(1)
        group[i + 1] = len(members) - 1
        members[-1].append(i + 1)
    n_groups = len(members)
    below, above = list(range(-1, n_groups - 1)), list(range(1, n_groups + 1))
    length = [0] * (n + 1)
    # of a place whose group is done: towards the nearest place before it whose group isn't; of the others: itself; 0: none
    lower = list(range(n + 1))
    g = n_groups - 1
    while g >= 0:
        own, wide = [i for i in members[g] if group[i] == g], size[g]
        members[g] = []
        for i in own:
            length[i] = wide
            lower[i] = i - 1
        told: dict[int, int] = {}
        for i in own:
            p = i
            while lower[p] != p:
                lower[p] = p = lower[lower[p]]
            if p:
                told[p] = told.get(p, 0) + 1
        fresh: dict[tuple[int, int], list[int]] = {}
        for p, times in told.items():
            fresh.setdefault((times, group[p]), []).append(p)
        # the more copies the higher, and all right above the old group
        for times, old in sorted(fresh, reverse=True):
            new, over = len(members), above[old]
            for p in fresh[times, old]:
                group[p] = new
            members.append(fresh[times, old])
            size.append(size[old] + times * wide)
            below.append(old)
            above.append(over)
            above[old] = below[over] = new
        g = below[g]
    return length[1:]


def _common(same, at: np.ndarray, period: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each pair the largest length in 0..most for which same(at, period, length) holds; it holds for all shorter ones."""
    lo, hi = np.zeros(len(at), np.int64), most.astype(np.int64)
    while (lo < hi).any():
        middle = (lo + hi + 1) >> 1
        ok = same(at, period, middle)
        lo, hi = np.where(ok, middle, lo), np.where(ok, hi, middle - 1)
    return lo


def runs_of(ranks: np.ndarray, exponent: int = EXPONENT, least: int = LENGTH) -> list[Run]:
    """Runs of at least max(least, exponent * period) places, sorted; exponent: 2 at least."""
    n = len(ranks)
    orders = ranks.tolist(), (int(ranks.max(initial=0)) - ranks).tolist()
    at, period = np.tile(np.arange(n), 2), np.concatenate([np.array(lyndon_array(s), np.int64) for s in orders])
    # a run's first root is followed by exponent - 2 more whole periods at least
    more = (exponent - 2) * period
    at, period, more = (x[at + period + more <= n] for x in (at, period, more))
    values = mix(ranks.astype(np.uint64) + np.uint64(1))
    ok = rolled(values, at, at + more) == rolled(values, at + period, at + period + more)
    pairs = np.unique(np.stack([period[ok], at[ok]], 1), axis=0)
    if not len(pairs):
        return []
    period, at = pairs[:, 0], pairs[:, 1]
    if exponent > 2:
        # of repeated roots one period apart, which are in the same run, the first does
        key = period * (n + 1) + at
        first = ~np.isin(key - period, key) | (at < period)
        at, period = at[first], period[first]
    right = _common(lambda i, p, k: rolled(values, i, i + k) == rolled(values, i + p, i + p + k), at, period, n - at - period)
    left = _common(lambda i, p, k: rolled(values, i - k, i) == rolled(values, i + p - k, i + p), at, period, at)
    found = set()
    for i, p, s, e in zip(at.tolist(), period.tolist(), (at - left).tolist(), (at + period + right).tolist(), strict=True):
        if (s, e - s, p) in found:
            continue
        if not _holds(ranks, s, e, p):
            # a hash lied: compare words
            other = np.flatnonzero(ranks[p:] != ranks[:-p])
            s, e = int(other[other < i].max(initial=-1)) + 1, int(other[other >= i].min(initial=n - p)) + p
        if e - s >= max(least, exponent * p):
            found.add((s, e - s, p))
    return sorted((s, k, p) for s, k, p in found)


def _holds(ranks: np.ndarray, s: int, e: int, p: int) -> bool:
    ends = s and ranks[s - 1] == ranks[s - 1 + p] or e < len(ranks) and ranks[e] == ranks[e - p]
    return not ends and bool((ranks[s : e - p] == ranks[s + p : e]).all())


# ---------------------------------------------------------------- many texts


def stretches(hashes: np.ndarray, bounds: np.ndarray, exponent: int = EXPONENT, least: int = LENGTH, rounds: int = 8) -> list[tuple[int, int, int]]:
    """(text, from, to): stretches of words outside of which no wanted run can have a word; from, to: places in the text.

    Further rounds would only shorten stretches, so that their number decides nothing.
    """
    n = np.maximum(np.diff(bounds) - GRAM + 1, 0)
    part = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[:-1], n)
    window = rolled(hashes, at, at + GRAM)
    for _ in range(rounds):
        _, which, count = np.unique(mix(window ^ mix(part.astype(np.uint64))), return_inverse=True, return_counts=True)
        good = count[which] >= exponent - 1
        if good.all():
            break
        at, window, part = at[good], window[good], part[good]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (part[1:] != part[:-1])
        part = np.cumsum(new) - 1
        long = np.bincount(part, minlength=1)[part] >= least - GRAM + 1 if len(at) else new
        at, window, part = at[long], window[long], part[long]
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    text = np.searchsorted(bounds, at[first], "right") - 1
    base = bounds[text]
    return list(zip(text.tolist(), (at[first] - base).tolist(), (at[last] + GRAM - base).tolist(), strict=True))


def planted(doc_id: object, n: int) -> tuple[int, int] | None:
    """(a, p) if the contract has the document's words from place a on repeat with period p."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def found_in(ids: list, values: list[bytes], edit: bool, exponent: int = EXPONENT, least: int = LENGTH) -> Iterator[tuple[list[bytes], list[Run]]]:
    """(words, runs) of each text; edit: words repeat as planted() says."""
    hashes, bounds = words(values)
    whole: dict[int, np.ndarray] = {}
    if edit:
        place = np.arange(len(hashes))
        for k, doc_id in enumerate(ids):
            lo, hi = int(bounds[k]), int(bounds[k + 1])
            if at := planted(doc_id, hi - lo):
                a, p = at
                whole[k] = np.arange(hi - lo)
                whole[k][a:] = a + np.arange(hi - lo - a) % p
                place[lo:hi] = lo + whole[k]
        hashes = hashes[place]
    kept: dict[int, list[tuple[int, int]]] = {}
    for k, lo, hi in stretches(hashes, bounds, exponent, least):
        kept.setdefault(k, []).append((lo, hi))
    for k, value in enumerate(values):
        own = value.split()
        if k in whole:
            own = [own[i] for i in whole[k].tolist()]
        runs: list[Run] = []
        for lo, hi in kept.get(k, ()):
            rank = {w: r for r, w in enumerate(sorted(set(own[lo:hi])))}
            runs += [(lo + s, n, p) for s, n, p in runs_of(np.array([rank[w] for w in own[lo:hi]], np.int64), exponent, least)]
        yield own, sorted(runs)


def collapsed(own: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return own
    step = np.zeros(len(own) + 1, np.int64)
    for s, n, p in runs:
        step[s + p] += 1
        step[s + n] -= 1
    return [w for w, gone in zip(own, (np.cumsum(step)[:-1] > 0).tolist(), strict=True) if not gone]


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", edit: bool = False, exponent: int = EXPONENT, least: int = LENGTH) -> DataFrame:
    """(doc_id, runs, collapsed): every document's runs by start and period, and its words without their repeats."""
    kind = docs.schema[doc_id].dataType.simpleString()
    row = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = batch.column(0), texts(batch.column(1))
            for lo, hi in steps(values):
                found, kept = [], []
                for own, runs in found_in(ids[lo:hi].to_pylist(), values[lo:hi], edit, exponent, least):
                    found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in sorted(runs, key=lambda r: (r[0], r[2]))])
                    kept.append(b" ".join(collapsed(own, runs)))
                yield pa.RecordBatch.from_arrays([ids[lo:hi], pa.array(found, row), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    """The contract's columns; the strongest run by exact fractions: length * other period against other length * period."""
    stronger = "r.length * s.period > s.length * r.period OR r.length * s.period = s.length * r.period AND struct(r.start, r.period) < struct(s.start, s.period)"
    best = f"aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>), (s, r) -> CASE WHEN s IS NULL OR {stronger} THEN r ELSE s END)"
    lines = r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    return periodic_runs(docs, edit=True).selectExpr("doc_id", "runs", "collapsed", f"{best} AS best").selectExpr(
        "doc_id", "CAST(size(runs) AS BIGINT) AS n_runs", "best.start AS start", "best.length AS length", "best.period AS period",
        "1000 * best.length DIV best.period AS exponent_milli", f"sha2({lines}, 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256",
    )
