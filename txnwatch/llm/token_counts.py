"""Token counts of whole texts without encoding most of them.

Byte-level pair encoding cuts a text into pre-tokens and merges inside each. Which vocabulary strings come out of the
merges as one token is proved once, ahead of the corpus; a pre-token that is one of them counts one, and only the others
are merged. Pre-tokens are cut by the published pattern; the code points on which this splitter and the tokenizer's own
disagree are found by comparing the two on every code point, and a text that holds such a one is encoded as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

# Fixed value: the published pattern of this family of vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LAST = 0x110000


def byte_names() -> list[str]:
    """How the vocabulary writes each byte: printable ones as themselves, the others as code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer, checked to be of the kind that this module knows: byte-level pairs, nothing normalised."""
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    said = json.loads(tokenizer.to_str())
    cut, added = said["pre_tokenizer"] or {}, said["added_tokens"]
    known = (said["model"]["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut["use_regex"]
             and not cut["add_prefix_space"] and not said["normalizer"]
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added))
    if not known:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    return tokenizer, [t["content"] for t in added]


@lru_cache(maxsize=2)
def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings that the merges turn into one token. Entries that are no whole characters are no pre-tokens."""
    tokenizer, _ = load(path)
    byte = {name: b for b, name in enumerate(byte_names())}
    proved = set()
    for name in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte[c] for c in name).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if len(tokenizer.model.tokenize(name)) == 1:
            proved.add(text)
    return frozenset(proved)


def disputed(path: str, first: int, end: int) -> list[int]:
    """Code points from ``first`` up to ``end`` that the two splitters put into different classes.

    A probe shows the class: next to a letter, a digit, a mark and after a blank the point either joins or stands apart.
    """
    tokenizer, _ = load(path)
    ours, names = regex.compile(PATTERN).findall, byte_names()
    theirs = lambda text: [t for t, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    agree = lambda text: theirs(text) == ["".join([names[b] for b in t.encode()]) for t in ours(text)]
    probe = lambda c: f"a{chr(c)}a1{chr(c)}1!{chr(c)}! {chr(c)}a\n"
    # points that join into one piece with letters, or digits, or marks in both are of one class in both
    alike = lambda run: any(len(ours(e + run)) == 1 == len(theirs(e + run)) for e in "a1!")

    points = [c for c in range(first, end) if not 0xD800 <= c < 0xE000]
    found = []
    for k in range(0, len(points), 64):
        block = points[k:k + 64]
        if not alike("".join(map(chr, block))) and not agree("".join(map(probe, block))):
            found += [c for c in block if not agree(probe(c))]
    return found


def disputed_points(spark: SparkSession, path: str) -> str:
    """All of them, compared in parallel; no more than there are code points, in practice those that one side's edition of
    Unicode does not know yet."""
    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [c for k in batch.column(0).to_pylist() for c in disputed(path, k, min(k + 4096, LAST))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["c"])

    return "".join(sorted(chr(r["c"]) for r in spark.range(0, LAST, 4096).mapInArrow(compare, "c long").collect()))


def ranges(points: str) -> str:
    """A character class of the points, neighbours as one range."""
    codes = sorted(map(ord, points))
    cuts = [k for k in range(1, len(codes)) if codes[k] != codes[k - 1] + 1]
    spans = [(codes[a], codes[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(codes)])]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]"


class Pieces(dict):
    """Tokens of a pre-token: known ones from the proof, others merged when first met and kept while there is room."""

    def __init__(self, path: str, limit: int = 500_000):
        super().__init__(dict.fromkeys(whole_tokens(path), 1))
        self.tokenizer, self.path, self.proved, self.limit = load(path)[0], path, len(self), limit
        self.names = byte_names()

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.model.tokenize("".join([self.names[b] for b in piece.encode()])))
        if len(piece) <= 64:
            if len(self) > self.proved + self.limit:
                self.clear()
                self.update(dict.fromkeys(whole_tokens(self.path), 1))
            self[piece] = n
        return n


class Counter:
    """Token counts as the library gives them, special strings included."""

    def __init__(self, path: str, points: str):
        self.tokenizer, special = load(path)
        self.pieces, self.cut = Pieces(path), regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.odd = re.compile(ranges(points)) if points else None

    def count(self, text: str) -> int:
        if self.odd and self.odd.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.special.split(text) if self.special else [text]
        look, findall = self.pieces.__getitem__, self.cut.findall
        return sum([sum(map(look, findall(part))) for part in parts]) + len(parts) - 1


@lru_cache(maxsize=2)
def counter(path: str, points: str) -> Counter:
    """One per Python worker, kept from task to task."""
    return Counter(path, points)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``__id``, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as empty: no bytes, no tokens. Special strings inside a text count as the library counts them by
    default. Repeated rows are counted each, ids may be null or of any type, other columns are not read, and an empty table
    gives no rows. Nothing is shuffled.
    """
    points = disputed_points(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = StructType([StructField("__id", rows.schema["__id"].dataType), StructField("n_bytes", LongType()),
                      StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        own = counter(path, points)
        for batch in batches:
            text = batch.column(1)
            n = pa.array([own.count(t.as_py()) for t in text], pa.int64())  # one text at a time in memory
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(text), pa.int64()), n, pc.greater(n, limit)], out.names)

    return rows.mapInArrow(count, out)
