"""Near-duplicate documents by ProbMinHash, banding and verification.

Shingles are runs of five words (a text of fewer words is one shingle). Each distinct one counts once, for candidates as
for verification: how often a passage is repeated makes no difference. For each shingle arrivals of a Poisson process,
whose rate is its weight, fall on the registers of the signature at random; a register keeps the shingle that arrived
first, so two documents agree in a register with the probability Jaccard similarity of their weights. All weights are 1
here, with which that is the Jaccard similarity of the shingle sets, the one that is verified. A shingle is dropped as
soon as its next arrival would be later than every register's: after a few rounds none is left. Bands of registers give
candidate groups.

From candidates to classes, without all pairs of a group:
1. Texts with equal shingles form one class from the start; one representative of each goes on.
2. In each group every member is compared with the group's leader by the exact Jaccard similarity of the shingle sets;
   those at MIN_SIMILARITY or more are linked. The leader is the most central member: the one that meets most others over
   all bands, as a text does that the others were made from. Those that fail elect another leader, ELECTIONS times in all.
3. In groups whose members are then still in several classes, pairs across classes are found by prefix filtering on how
   the members differ from the leader (see likely_pairs) and compared. No group is cut and no pair is ruled out that could
   be at MIN_SIMILARITY, so a link can only be missed by the bands (four pairs in 10,000 at similarity 0.8, fewer above).
Classes are the connected components of the links, found by rounds of large-star and small-star steps on tables.

Words: runs of anything but white space, ASCII punctuation and controls; A-Z are lower-cased. Results for special rows:
texts without words (null, empty) are not near anything, each row is a class of its own; rows with a null doc_id take
no part and have a null class; rows that share a doc_id are one document (it joins its texts' classes); equal rows are in one class;
ties in arrival times are broken by the shingle's hash; an empty table gives an empty table; only doc_id and text are
read, so that other columns don't matter. class_id is the smallest doc_id of the class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netquarry.llm.common import BREAKS, dropped, free, mix, rolled, steps, stored, texts, windows, words

WIDTH = 5
MIN_SIMILARITY = 0.8
#: 20 bands of 5 registers find a pair at similarity 0.8 with probability 0.9996.
BANDS, ROWS = 20, 5
#: How often the members of a group that aren't near their leader elect another one.
ELECTIONS = 3

SIGNATURES = "doc_id long, content binary, bands array<long>"


def weighted_shingles(values: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, weight) of the distinct shingles of each text, sorted by text and hash."""
    hashes, bounds = words(values, BREAKS, lower=True)
    h, text, _ = windows(hashes, bounds, width)
    n = np.diff(bounds)
    short = np.flatnonzero((n > 0) & (n < width))
    h = np.concatenate([h, rolled(hashes, bounds[:-1][short], bounds[1:][short])])
    text = np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])) if len(h) else np.zeros(0, np.int64)
    return text[new], h[new], np.diff(np.append(new, len(h)))


def prob_min_hash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures (n x registers): the shingle that arrived first at each register; 0 where a text has none."""
    first = np.full(n * registers, np.inf)
    who = np.zeros(n * registers, np.uint64)
    live, time = np.arange(len(text)), np.zeros(len(text))
    k = 0
    while len(live):
        k += 1
        draw = mix(shingle[live] + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        # waiting time from the upper bits, register from another mix
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[live]
        slot = text[live] * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        hit = np.flatnonzero(time < first[slot])
        order = hit[np.lexsort((shingle[live][hit], -time[hit]))]
        # later entries win in numpy: sorted so that the earliest arrival comes last
        first[slot[order]] = time[order]
        who[slot[order]] = shingle[live][order]
        stop = first.reshape(n, registers).max(1)
        go = time < stop[text[live]]
        live, time = live[go], time[go]
    return who.reshape(n, registers)


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, content, bands) of the documents that have words and an id.

    content: 128-bit hash of the distinct shingles, equal for equal ones; bands: a hash of each band's registers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = texts(batch.column(1))
            for lo, hi in steps(values):
                which, h, _ = weighted_shingles(values[lo:hi])
                n = hi - lo
                size = np.bincount(which, minlength=n)
                has = np.flatnonzero(size)
                if not len(has):
                    continue
                found = prob_min_hash(which, h, np.ones(len(h)), n, bands * rows)[has]
                start = np.arange(0, bands * rows, rows)
                flat = found.ravel()
                at = (np.arange(len(has))[:, None] * (bands * rows) + start).ravel()
                keys = rolled(flat, at, at + rows).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(size)])
                both = np.stack([rolled(h, ends[:-1][has], ends[1:][has]), rolled(mix(h), ends[:-1][has], ends[1:][has])], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n).take(pa.array(has)), pa.array([x.tobytes() for x in both], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, bands), pa.int32()), pa.array(keys)),
                    ],
                    names=["doc_id", "content", "bands"],
                )

    return docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(run, SIGNATURES)


def shingle_sets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, shingles): the sorted distinct shingle hashes, 32 bits each: within a pair of documents as good as exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = texts(batch.column(1))
            for lo, hi in steps(values):
                which, h, _ = weighted_shingles(values[lo:hi])
                raw = (h >> np.uint64(32)).astype("<u4").tobytes()
                ends = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=hi - lo))]).tolist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["doc_id", "shingles"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, shingles binary")


def similarity(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """pairs (a, b) with `similarity`: the exact Jaccard similarity of their shingle sets; shingles: (doc_id, shingles)."""
    left = shingles.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = shingles.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.zeros(batch.num_rows)
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                same = len(np.intersect1d(x, y))
                got[i] = same / max(len(x) + len(y) - same, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got)], names=["a", "b", "similarity"])

    # shingles grow with the data, so neither side is for broadcasting
    return pairs.hint("merge").join(left, "a").hint("merge").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, similarity double")


def differences(members: DataFrame, shingles: DataFrame, min_similarity: float) -> DataFrame:
    """(leader, e, at, n_differ, size, doc_id, root, main): how members (doc_id, leader, root, main) differ from their leader.

    e: a shingle that only the member has, or one that only the leader has; those come after all of the first kind. Of the
    sorted differences so many are told that a partner at min_similarity must share one of them: it shares all but a
    quarter (at 0.8) of the member's size at least.
    """
    own = shingles.select(F.col("doc_id"), F.col("shingles").alias("x"))
    lead = shingles.select(F.col("doc_id").alias("leader"), F.col("shingles").alias("y"))
    spare = (1 - min_similarity) / min_similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                told, n, size = [], [], []
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                    x, y = np.unique(np.frombuffer(x, "<u4")), np.unique(np.frombuffer(y, "<u4"))
                    only = np.concatenate([np.setdiff1d(x, y, True).astype(np.int64), np.setdiff1d(y, x, True).astype(np.int64) | (1 << 32)])
                    told.append(only[: int(spare * len(x)) + 2])
                    n.append(len(only))
                    size.append(len(x))
                k = np.array(list(map(len, told)), np.int64)
                row = np.repeat(np.arange(len(told)), k)
                at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                columns = {c: batch.column(c).take(pa.array(row)) for c in ("leader", "doc_id", "root", "main")}
                columns |= {"e": pa.array(np.concatenate([*told, np.zeros(0, np.int64)])), "at": pa.array(at, pa.int32()), "n_differ": pa.array(np.array(n, np.int32)[row]), "size": pa.array(np.array(size, np.int32)[row])}
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    names = ["leader", "e", "at", "n_differ", "size", "doc_id", "root", "main"]
    both = members.hint("merge").join(own, "doc_id").hint("merge").join(lead, "leader").select("leader", "doc_id", "root", "main", "x", "y")
    return both.mapInArrow(run, "leader long, e long, at int, n_differ int, size int, doc_id long, root long, main long")


def likely_pairs(parts: DataFrame, min_similarity: float) -> DataFrame:
    """Pairs (a, b) of different classes that may be at min_similarity; one of each is not of the leader's class.

    x and y are at s or more iff their symmetric difference is at most (1-s)/(1+s) of the sum of their sizes. It is the
    sum of both differences to the leader less twice what these share, so the sizes tell how much they must share, and of
    two sorted lists that share m items the lists without their last m-1 items share one (prefix filtering). As x isn't
    near the leader, m is above 0 for every y: no pair is lost.
    """
    x, y = parts.where("root <> main").alias("x"), parts.alias("y")
    share = (1 - min_similarity) / (1 + min_similarity)
    c = F.col
    need = F.greatest((c("x.n_differ") + c("y.n_differ") - share * (c("x.size") + c("y.size"))) / 2 - 1e-6, F.lit(1.0))
    fits = (c("x.at") <= c("x.n_differ") - need) & (c("y.at") <= c("y.n_differ") - need)
    once = (c("y.root") == c("y.main")) | (c("x.doc_id") < c("y.doc_id"))
    found = x.join(y, (c("x.leader") == c("y.leader")) & (c("x.e") == c("y.e")) & (c("x.root") != c("y.root")) & once & fits)
    return found.select(*in_pairs(c("x.doc_id"), c("y.doc_id"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root: the smallest node of its connected component.

    Large-star and small-star steps by turns, each a table in the shared folder, until nothing changes. So are the smallest
    neighbours that a step looks up: as aggregates of the join's own stage they would keep Spark from splitting the rows of
    a node with very many neighbours.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        root = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(root.select("u", F.col("m").alias("v"))).distinct()
        old, edges = edges, stored(small)
        dropped(old, least, large, root)
        n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, total) == before:
            break
        before = (n, total)
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def in_pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every document."""
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    made = stored(signatures(docs, text, doc_id))
    # as a table of its own, not an aggregate of the join's own stage: so Spark can split the rows of a text with many copies
    copies = stored(made.groupBy("content").agg(F.min("doc_id").alias("rep")))
    member = stored(made.select("doc_id", "content").join(copies, "content").select("doc_id", "rep"))
    keyed = made.join(member.where("doc_id = rep").select("doc_id").distinct(), "doc_id").select("doc_id", F.posexplode("bands").alias("band", "key"))
    # the groups of several representatives
    several = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    grouped = stored(keyed.join(several, ["band", "key"]))
    # a text that the others were made from shares more of its groups with more of them: it leads
    central = grouped.groupBy("doc_id").agg(F.sum("n").alias("central"))
    told = stored(grouped.drop("n").join(central, "doc_id").withColumn("rank", F.struct(-F.col("central"), F.xxhash64("doc_id"), "doc_id")).drop("central"))
    candidates = grouped.select("doc_id").distinct()
    shingles = stored(shingle_sets(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(candidates.hint("merge"), "doc_id", "left_semi")))
    near = F.col("similarity") >= min_similarity
    is_pair = (F.least("doc_id", "leader") == F.col("a")) & (F.greatest("doc_id", "leader") == F.col("b"))
    waiting, done, rest = told, None, [grouped]
    for turn in range(ELECTIONS):
        leaders = waiting.groupBy("band", "key").agg(F.min("rank").getField("doc_id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
        led = waiting.join(leaders, ["band", "key"])
        pairs = led.where("doc_id <> leader").select(*in_pairs(F.col("doc_id"), F.col("leader"))).distinct()
        found = stored(similarity(pairs if done is None else pairs.join(done, ["a", "b"], "left_anti"), shingles))
        done = found if done is None else done.unionByName(found)
        compared = stored(led.join(done, is_pair, "left").select("band", "key", "doc_id", "rank", "leader", F.coalesce("similarity", F.lit(1.0)).alias("s1")))
        rest += [found, compared]
        if turn == 0:
            first = compared
        waiting = compared.where(F.col("s1") < min_similarity).drop("leader", "s1")
    roots = stored(components(done.where(near).select("a", "b")))
    # groups that still hold several classes: pairs across them whose differences to the leader may agree enough
    placed = first.join(roots, F.col("doc_id") == F.col("node"), "left").select("band", "key", "doc_id", "leader", F.coalesce("root", "doc_id").alias("root"))
    main = F.min(F.when(F.col("doc_id") == F.col("leader"), F.col("root"))).alias("main")
    mixed = placed.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), main).where("lo <> hi").select("band", "key", "main")
    several = placed.join(mixed, ["band", "key"]).where("doc_id <> leader").select("doc_id", "leader", "root", "main").distinct()
    parts = stored(differences(several, shingles, min_similarity))
    untold = stored(likely_pairs(parts, min_similarity).join(done, ["a", "b"], "left_anti"))
    last = stored(similarity(untold, shingles))
    # copies are linked with their text's representative
    links = done.unionByName(last).where(near).select("a", "b").unionByName(member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = stored(components(links))
    dropped(made, copies, member, told, shingles, *rest, roots, parts, untold, last)
    return ids.join(final, F.col("doc_id") == F.col("node"), "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("class_id"))


def op10_near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, class_id of every document: its class is named after its smallest doc_id."""
    return classes(docs.select("doc_id", "text"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each class: the one with the smallest doc_id (of rows that share it, all stay)."""
    own = free("gone", *docs.columns)
    gone = classes(docs).where("class_id <> doc_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(own), "left_anti")
