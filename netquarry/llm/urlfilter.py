"""URL filters: site rules first, then a weighted vocabulary.

Rules: a rule is a host and a path; it fits its host and all subdomains if the url's path starts with the rule's path; of
the fitting rules the longest (host, then path) decides.

Vocabulary: terms with a kind and a weight, given as rows or as a table (term, kind, weight). One Aho-Corasick pass over
the lower-cased url finds all terms. A strict term counts where it is a word of its own (no letter or digit on either
side), a soft term also where it only starts a word. One strict hit rejects, so do distinct soft terms whose weights
reach LIMIT; the weight of a url is the sum over its distinct terms. The vocabulary is broadcast, so a table of over
MAX_TERMS rows is refused.

Results for special rows: a null url, or one without `://`, has an empty host and path and is judged by its text alone
(null: allowed with weight 0); very long urls are scanned whole; equal rules are one, of equal terms the strict and then
the heavier one counts; null terms and weights are left out; repeated rows get equal results; an empty table gives an
empty table; columns other than page_id and url aren't read, and columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: The default vocabulary: terms that reject alone, and terms that do so together.
STRICT = """
adclick adserver adserv ads-track adult adultcam anabolic backlinks betting bongs botnet bukkake camgirl camgirls carding casino cialis clickbait clickfraud
counterfeit cracked cracks cryptominer darknet ddos deepfake doorway doubleclick dropper escort escorts exploit fakeid fetish gambling hentai jackpot keygen keylogger
lesbian-porn levitra linkfarm lottery malware nudes onlyfans payday phish phishing pirate piracy poker porn porno pornhub pornstar ransomware replica roulette scam scams
sexcam sexchat shemale slots spam spambot spyware stripper sugarbaby swinger torrent torrents tramadol trojan valium viagra virus warez xanax xrated xxx xxxvideo
""".split()
SOFT = """
ads affiliate auction banner bargain bet bingo bonus buy-now cash cheap clearance click cluster-mail coupon credit crypto deal deals discount dating download-now earn
easy-money forex free freebie gift giveaway hot-offer instant investment keno loan loans mega-sale miracle money offer pills popup prize profit promo quick-cash rebate
referral refinance rich sale scratch signup slot special-offer sponsor subscribe sweepstake track trading trial voucher weight-loss wholesale win winner
""".split()
LIMIT = 2
VOCABULARY = tuple((t, "strict", LIMIT) for t in STRICT) + tuple((t, "soft", 1) for t in SOFT)
MAX_TERMS = 1_000_000


def host(url: str = "url") -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty if there is none."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: str = "url") -> Column:
    """After the host, up to ?, # or the end."""
    return F.regexp_extract(_rest(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(set(rules), key=lambda r: (len(r[0]), len(r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        chosen = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def terms_of(vocabulary: Iterable[tuple[str, str, int]] | DataFrame) -> list[tuple[str, str, int]]:
    """The vocabulary as rows, lower-cased, one for each term; a table may have MAX_TERMS rows at most."""
    if isinstance(vocabulary, DataFrame):
        rows = [tuple(r) for r in vocabulary.select("term", "kind", "weight").limit(MAX_TERMS + 1).collect()]
    else:
        rows = list(vocabulary)
    if len(rows) > MAX_TERMS:
        raise ValueError(f"over {MAX_TERMS} terms")
    found: dict[str, tuple[str, int]] = {}
    for term, kind, weight in rows:
        if not term or weight is None:
            continue
        if kind not in ("strict", "soft"):
            raise ValueError(f"the kind of {term!r} is neither strict nor soft: {kind!r}")
        if weight != int(weight):
            raise ValueError(f"the weight of {term!r} is no whole number: {weight!r}")
        found[_lower(term)] = max(found.get(_lower(term), ("", 0)), (kind, int(weight)))
    return [(t, *kw) for t, kw in sorted(found.items())]


def automaton(terms: Sequence[tuple[str, str, int]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, kind, _ in terms:
        found.add_word(term, (term, kind == "strict"))
    found.make_automaton()
    return found


def hits(url: str, terms: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """(strict terms, soft terms) of a lower-cased url that stand at word boundaries."""
    strict, soft, n = set(), set(), len(url)
    for end, (term, is_strict) in terms.iter(url):
        start = end + 1 - len(term)
        if start and _word(url[start - 1]):
            continue
        if is_strict:
            if end + 1 == n or not _word(url[end + 1]):
                strict.add(term)
        else:
            soft.add(term)
    return strict, soft


def _word(c: str) -> bool:
    return c.isascii() and c.isalnum()


class _Terms:
    """The vocabulary as it is broadcast; each worker builds the automaton once."""

    def __init__(self, terms: list[tuple[str, str, int]]) -> None:
        self.terms, self.found = terms, None

    def get(self) -> tuple[ahocorasick.Automaton | None, dict[str, int]]:
        if self.found is None:
            self.found = automaton(self.terms) if self.terms else None, {t: w for t, _, w in self.terms}
        return self.found


def vocabulary_hits(pages: DataFrame, url: str = "url", vocabulary: Iterable[tuple[str, str, int]] | DataFrame = VOCABULARY) -> DataFrame:
    """pages with strict_terms and soft_terms (sorted arrays) and weight, replaced if there."""
    kept = [f.name for f in pages.schema.fields if f.name not in ("strict_terms", "soft_terms", "weight")]
    sent = pages.sparkSession.sparkContext.broadcast(_Terms(terms_of(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = sent.value.get()
        for batch in batches:
            found = [hits(_lower(x), terms) if x and terms else (set(), set()) for x in batch.column(url).to_pylist()]
            columns = [batch.column(c) for c in kept] + [pa.array([sorted(x[k]) for x in found], pa.list_(pa.string())) for k in (0, 1)]
            columns.append(pa.array([sum(weights[t] for t in a | b) for a, b in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "strict_terms", "soft_terms", "weight"])

    lists = [F.array().cast("array<string>").alias(c) for c in ("strict_terms", "soft_terms")]
    return pages.select(*kept).mapInArrow(run, pages.select(*kept, *lists, F.lit(0).cast("long").alias("weight")).schema)


def _lower(url: str) -> str:
    return url.lower() if url.isascii() else "".join([c.lower() if c.isascii() else c for c in url])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, vocabulary: Iterable[tuple[str, str, int]] | DataFrame = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, weight, strict_terms, soft_terms of every page."""
    found = vocabulary_hits(pages.select("page_id", "url"), vocabulary=vocabulary).withColumns({"host": host(), "path": path()})
    found = found.withColumn("__rule", rule_of(rules, F.col("host"), F.col("path")))
    rejected = (F.size("strict_terms") > 0) | (F.col("weight") >= limit)
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(rejected, "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "weight", "strict_terms", "soft_terms")


def op4_url_filter(pages: DataFrame) -> DataFrame:
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "weight")


def oracle(rules: Sequence[tuple[str, str, str]] = RULES, vocabulary: Sequence[tuple[str, str, int]] = VOCABULARY, limit: int = LIMIT) -> str:
    """The same in DuckDB SQL, for a vocabulary whose strict terms weigh the limit at least."""
    order = sorted(set(rules), key=lambda r: (-len(r[0]), -len(r[1]), r))
    pick = lambda k: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[k]}'" for h, p, v in order) + " END"
    lower = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ends = {"strict": "([^a-z0-9]|$)", "soft": ""}
    weight = " + ".join([f"{w} * CAST(contains(low, '{t}') AND regexp_matches(low, '(^|[^a-z0-9]){t}{ends[kind]}') AS BIGINT)" for t, kind, w in vocabulary])
    return f"""
WITH a AS (
  SELECT page_id, {lower} AS low, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (
  SELECT page_id, low, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (
  SELECT page_id, host, path, {pick(0)} AS rule, {pick(1)} AS ruled, CAST({weight} AS BIGINT) AS weight FROM b)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN weight >= {limit} THEN 'block' ELSE 'allow' END) AS verdict, weight FROM c
"""
