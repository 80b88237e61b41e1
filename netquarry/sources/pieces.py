"""Files of any size, read in pieces inside tasks: flows of a capture document as they come, hashes as they run.

A file is one task's work, as its hash and its JSON go from front to end; what a task holds is a piece of the file and the
values that aren't whole yet. Spark's own reader of whole files, which is faster on small ones, ends at 2 GB.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes read at a time.
PIECE = 4 << 20
#: Most characters of one flow or of one other value of a document; a longer one makes the document `rejected`.
LONGEST = 64 << 20
#: Flows in one batch of rows that leaves a task, and characters after which it leaves earlier.
FLOWS, CHARACTERS = 2000, 8 << 20

PARSED = "path string, content_sha256 string, capture_file string, completion_state string, error string, section int, record_index bigint, raw string"
HASHED = "path string, length bigint, sha256 string, magic string"
_SPACE = " \t\n\r"
_AFTER = frozenset(_SPACE + ",:]}")
Opener = Callable[[str], BinaryIO]


def open_path(path: str) -> BinaryIO:
    """A file of any filesystem that pyarrow knows (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)


class Broken(Exception):
    """The text is no JSON, or a value of it is longer than LONGEST."""


class Reader:
    """Whole values of a JSON text that comes in pieces; `digest` is of the bytes read so far."""

    def __init__(self, file: BinaryIO, piece: int = PIECE, longest: int = LONGEST) -> None:
        self.file, self.piece, self.longest = file, piece, longest
        self.digest, self.decoder, self.parse = hashlib.sha256(), None, json.JSONDecoder().raw_decode
        self.text, self.at, self.ended = "", 0, False

    def more(self, n: int) -> None:
        """Drop what was used and append the next n bytes or more."""
        data = self.file.read(max(n, self.piece))
        while self.decoder is None and len(data) < 4 and (first := self.file.read(4 - len(data))):
            data += first  # the first four bytes tell the encoding
        self.digest.update(data)
        self.ended = not data
        if self.decoder is None:
            self.decoder = codecs.getincrementaldecoder(json.detect_encoding(data[:4]))()
        try:
            self.text = self.text[self.at :] + self.decoder.decode(data, final=self.ended)
        except UnicodeDecodeError:
            raise Broken from None
        self.at = 0

    def peek(self) -> str:
        """The next character that is no space, not yet taken; empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in _SPACE:
                self.at += 1
            if self.at < len(self.text):
                return self.text[self.at]
            if self.ended:
                return ""
            self.more(0)

    def take(self, *wanted: str) -> str:
        found = self.peek()
        if found not in wanted or not found:
            raise Broken
        self.at += 1
        return found

    def value(self) -> tuple[object, str]:
        """The next value and its text. It is whole if what follows can't be part of it (as in `1` of `1e5`) or the text has ended."""
        self.peek()
        while True:
            try:
                value, end = self.parse(self.text, self.at)
                if self.ended or self.text[end : end + 1] in _AFTER:
                    text, self.at = self.text[self.at : end], end
                    return value, text
            except (ValueError, RecursionError):
                pass
            have = len(self.text) - self.at
            if self.ended or have > self.longest:
                raise Broken
            self.more(have)  # twice as much each time, so a value is parsed from its start a few times only

    def rest(self) -> None:
        """Read to the end, for the hash alone."""
        self.text, self.at = "", 0
        while not self.ended:
            data = self.file.read(self.piece)
            self.digest.update(data)
            self.ended = not data


def members(r: Reader) -> Iterator[tuple[str, object, int, str]]:
    """(name, value, -1, "") of each field of the document; for an array `flows` (name, None, index, text) of each element.

    An array is announced by (name, [], -1, ""). Ends with the text; anything behind the document is an error.
    """
    r.take("{")
    close = r.peek() == "}" and r.take("}")
    while not close:
        name, _ = r.value() if r.peek() == '"' else r.take('"')
        r.take(":")
        if name == "flows" and r.peek() == "[":
            r.take("[")
            yield name, [], -1, ""
            index, done = 0, r.peek() == "]" and r.take("]")
            while not done:
                _, text = r.value()
                yield name, None, index, text
                index += 1
                done = r.take(",", "]") == "]"
        else:
            value, _ = r.value()
            yield name, value, -1, ""
        close = r.take(",", "}") == "}"
    if r.peek():
        raise Broken


def parse(path: str, file: BinaryIO, piece: int = PIECE, longest: int = LONGEST) -> Iterator[tuple]:
    """PARSED rows of one document: its flows as they come, then one row (record_index null) that tells what it is.

    A field that comes again takes the place of the earlier one; `section` counts the arrays `flows`, the last row names the
    one that counts. The rows of a document that turns out to be none must be left out by whoever reads them.
    """
    r, top, section, error = Reader(file, piece, longest), {}, 0, None
    try:
        if r.peek() == "{":
            for name, value, index, text in members(r):
                if index >= 0:
                    yield path, None, None, None, None, section, index, text
                    continue
                if name == "flows" and isinstance(value, list):
                    section += 1
                top[name] = value
        else:
            r.value()
            if r.peek():
                raise Broken
        capture, state, failure = top.get("capture"), top.get("completion_state"), top.get("error")
        if isinstance(failure, dict) and "flows" not in top:
            told = all(isinstance(failure.get(x), str) for x in ("code", "category", "message"))
            error = f"upstream error: {failure['code']}" if told else "malformed error document"
        elif not (isinstance(top.get("flows"), list) and isinstance(capture, dict) and isinstance(state, str) and state):
            error = "not a flows document"
    except Broken:
        error = "not valid JSON"
    r.rest()
    name = None if error else top["capture"].get("file_name")
    yield path, r.digest.hexdigest(), name if name is None or isinstance(name, str) else json.dumps(name), None if error else top["completion_state"], error, section, None, None


def parsed(files: DataFrame, open_file: Opener = open_path, piece: int = PIECE, longest: int = LONGEST) -> DataFrame:
    """PARSED rows of the documents at `path`. One that can't be read leaves no last row."""
    names = [x.split()[0] for x in PARSED.split(", ")]

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                try:
                    with open_file(path) as file:
                        for row in parse(path, file, piece, longest):
                            rows.append(row)
                            size += len(row[-1] or "")
                            if len(rows) >= FLOWS or size >= CHARACTERS:
                                yield pd.DataFrame(rows, columns=names).astype({"record_index": "Int64"})
                                rows, size = [], 0
                except OSError:
                    continue
                yield pd.DataFrame(rows, columns=names).astype({"record_index": "Int64"})

    # one file a task, whatever their number of rows; more tasks than files cost nothing
    return _spread(files.select("path", "length")).mapInPandas(tell, PARSED)


def hashed(files: DataFrame, open_file: Opener = open_path, piece: int = PIECE) -> DataFrame:
    """path, length, sha256 and the first four bytes as hex of the files at `path`; null for files that can't be read."""

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, length in zip(batch["path"], batch["length"], strict=True):
                digest, magic = hashlib.sha256(), b""
                try:
                    with open_file(path) as file:
                        while data := file.read(piece):
                            magic = magic or data[:4]
                            digest.update(data)
                    told = digest.hexdigest(), magic.hex().upper()
                except OSError:
                    told = None, None
                yield pd.DataFrame([(path, length, *told)], columns=["path", "length", "sha256", "magic"])

    return _spread(files.select("path", "length")).mapInPandas(tell, HASHED)


def _spread(files: DataFrame) -> DataFrame:
    """Few and large files over the session's shuffle partitions, by path."""
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("path"))
