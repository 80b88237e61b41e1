r"""Secret scans: keyword prefilter, anchored regular expressions near hits, embedded checksums.

One Aho-Corasick pass over the text (A-Z lower-cased) finds all keywords. A regular expression is only tried at a hit, or
in the few code points behind it; what has a checksum inside is a finding only if that is right:

| kind | keyword, then | check |
|-|-|-|
| assign | password, passwd, secret, token, apikey, api_key, then `:` or `=` and a value | value of 8 characters |
| access | AKIA, then upper-case letters and digits | 16 characters |
| hex | none: some aligned block of 16 is all hexadecimal in any run of 31 | 32 characters |
| github | ghp_ gho_ ghu_ ghs_ ghr_, 36 letters and digits | the last six are the CRC-32 of the others, base 62 |
| npm | npm_, 36 letters and digits | the same |
| card | card, visa, amex; a number of 13 to 19 digits within NEAR | Luhn |
| iban | iban; an account number within NEAR | remainder 1 modulo 97 |
| wif | wif, privkey, private key; 51 or 52 characters of base 58 within NEAR | four bytes of double SHA-256 |
| pem | `-----begin ` and `private key-----` | the DER length inside is that of the decoded body |

The first three are the base kinds: leftmost non-overlapping matches, whatever the others find. Spans are in code points.

Results for special rows: null texts are empty and have no spans; very long texts are scanned whole; repeated rows and
rows that share an id each have their own result; an empty table gives an empty table; other columns aren't read. Only ASCII
letters count as equal in either case. Spans of one kind that are equal are one; spans of different kinds may overlap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: The base kinds, in order.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "card", "iban", "wif", "pem")
#: How many code points after a keyword of card, iban and wif a number may start.
NEAR = 24
VALUE, ACCESS, HEX = 8, 16, 32
BLOCK = 16

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
AKIA = re.compile(r"AKIA[A-Z0-9]+")
TOKEN = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])")
IBAN = re.compile(r"(?<![0-9A-Z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
WIF = re.compile(r"(?<![0-9A-Za-z])[5KL9c][1-9A-HJ-NP-Za-km-z]{50,51}(?![0-9A-Za-z])")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END \1PRIVATE KEY-----", re.A)

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = {c: i for i, c in enumerate("123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz")}
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*b"0123456789abcdef"]] = True

Span = tuple[int, int, str]


# ---------------------------------------------------------------- checksums


def crc_token(body: str, check: str) -> bool:
    """Whether check is the CRC-32 of body in base 62, six digits."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, k = divmod(n, 62)
        digits = BASE62[k] + digits
    return digits == check


def luhn(digits: str) -> bool:
    total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
    return total % 10 == 0 and digits[0] in "3456"


def mod97(account: str) -> bool:
    return int("".join([str(int(c, 36)) for c in account[4:] + account[:4]])) % 97 == 1


def base58_check(key: str) -> bool:
    n = 0
    for c in key:
        n = 58 * n + BASE58[c]
    raw = n.to_bytes(-(-n.bit_length() // 8), "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def der_length(body: str) -> bool:
    """Whether the body is base 64 of one DER sequence and nothing behind it."""
    packed = "".join(body.split())
    try:
        raw = base64.b64decode(packed, validate=True)
    except ValueError:
        return False
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    wide = raw[1] & 0x7F
    return len(raw) == 2 + wide + int.from_bytes(raw[2 : 2 + wide], "big")


# ---------------------------------------------------------------- findings at hits


def _at_token(text: str, start: int, end: int) -> Span | None:
    m = TOKEN.match(text, start)
    return (start, m.end(), "npm" if text[start] == "n" else "github") if m and crc_token(m[1], m[2]) else None


def _behind(kind: str, pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable[[str, int, int], Span | None]:
    def found(text: str, start: int, end: int) -> Span | None:
        for m in pattern.finditer(text, end, end + NEAR + 64):
            if m.start() > end + NEAR:
                return None
            if valid(re.sub("[ -]", "", m[0])):
                return m.start(), m.end(), kind
        return None

    return found


def _at_pem(text: str, start: int, end: int) -> Span | None:
    m = PEM.match(text, start)
    return (start, m.end(), "pem") if m and der_length(m[2]) else None


def automaton() -> ahocorasick.Automaton:
    """Keywords, each with what looks at a hit; the keywords of the two base kinds have their kind's name instead."""
    found = ahocorasick.Automaton()
    looks: dict[str, object] = dict.fromkeys("password passwd secret token apikey api_key".split(), "assign") | {"akia": "access", "-----begin ": _at_pem}
    looks |= dict.fromkeys("ghp_ gho_ ghu_ ghs_ ghr_ npm_".split(), _at_token)
    looks |= dict.fromkeys(("card", "visa", "amex"), _behind("card", CARD, luhn)) | {"iban": _behind("iban", IBAN, mod97)}
    looks |= dict.fromkeys(("wif", "privkey", "private key"), _behind("wif", WIF, base58_check))
    for word, look in looks.items():
        found.add_word(word, (len(word), look))
    found.make_automaton()
    return found


def hex_runs(text: str) -> list[Span]:
    """Runs of at least HEX characters: looked for around aligned blocks that are hexadecimal throughout."""
    codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    blocks = np.flatnonzero(_IS_HEX[codes[: len(codes) // BLOCK * BLOCK]].reshape(-1, BLOCK).all(1)) * BLOCK
    out, done = [], 0
    for at in blocks.tolist():
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = at + BLOCK
        while done < len(text) and text[done] in "0123456789abcdef":
            done += 1
        if done - start >= HEX:
            out.append((start, done, "hex"))
    return out


def spans(text: str, keywords: ahocorasick.Automaton) -> list[Span]:
    """(start, end, kind) of all findings, by start, then kind as listed, then end."""
    lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found: set[Span] = set()
    free = {"assign": 0, "access": 0}
    for end, (size, look) in keywords.iter(lower):
        start = end + 1 - size
        if not isinstance(look, str):
            if span := look(text, start, end + 1):
                found.add(span)
        # no keyword of these kinds ends before another of its kind that starts earlier, so hits come by start
        elif start >= free[look] and (m := (ASSIGN if look == "assign" else AKIA).match(text, start)):
            free[look] = m.end()
            if (len(m[2]) >= VALUE) if look == "assign" else (m.end() - start >= ACCESS):
                found.add((start, m.end(), look))
    found.update(hex_runs(text))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def told(found: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for start, end, kind in found])


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, findings): every document's findings as an array of (kind, start, end)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords, row = automaton(), pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(x.as_py() or "", keywords)] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, row)], names=["doc_id", "findings"])

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, findings array<struct<kind:string,start:bigint,end:bigint>>")


def op13_secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    own = "array_join(transform({}, f -> concat_ws(':', f.kind, f.start, f.end)), ',')"
    base = f"filter(findings, f -> f.kind IN {BASE_KINDS})"
    counts = [f"CAST(size(filter(findings, f -> f.kind = '{k}')) AS BIGINT) AS n_{k}" for k in BASE_KINDS]
    return scan(docs).selectExpr("doc_id", *counts, f"sha2({own.format(base)}, 256) AS base_sha256", f"{own.format('findings')} AS spans")

