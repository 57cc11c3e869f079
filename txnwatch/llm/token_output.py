"""Token ids as canonical Huffman code in files of independent blocks.

Ids are counted over all documents, code lengths come from the package-merge method with a limit, and codes are
canonical, so the code book is a list of lengths. A block holds whole documents in id order: a header, document ids,
token counts, checkpoints (the bit at which every ``STRIDE``-th token of a document starts) and the code. Decoding looks
``LIMIT`` bits up in one table and runs over all checkpoints of a block at once; no block needs another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .common import groups_for, slots, staged, token_cache

LIMIT, STRIDE, MAGIC = 20, 256, b"HUF1"


def tokenize(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = 1) -> DataFrame:
    """``__id``, ``ids`` (16-bit little-endian, the end id last) and ``n_tokens`` of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cache = token_cache(tokenizer)
        for batch in batches:
            size = np.concatenate([[0], np.cumsum(np.diff(_offsets(batch.column(1))))])
            part = size[:-1] // (2 << 20)  # about 2 MB of text at once
            for lo, hi in _runs(part):
                piece = batch.slice(lo, hi - lo)
                ids = cache.encode(piece.column(1).to_pylist(), end)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 2 for x in ids], pa.int64())],
                    ["__id", "ids", "n_tokens"])

    return docs.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text")).mapInArrow(
        encode, f"__id {kind}, ids binary, n_tokens long")


def _offsets(column) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, int)


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])
    return ((int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


def count_ids(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs: at most one row per id and task is shuffled, at most one per id comes to the driver."""
    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            column = batch.column(0)
            if not len(column):
                continue
            cuts, held = _offsets(column), column.buffers()[2]
            at, end = int(cuts[0]), int(cuts[-1])  # whole ids of two bytes, document after document
            for lo in range(at, end, 8 << 20):
                total += np.bincount(np.frombuffer(held, "<u2", (min(end, lo + (8 << 20)) - lo) // 2, lo), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["token", "n"])

    rows = tokens.select("ids").mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def code_lengths(counts: dict[int, int], limit: int = LIMIT) -> dict[int, int]:
    """Lengths of an optimal prefix code with no code longer than ``limit``."""
    if len(counts) > 1 << limit:
        raise ValueError(f"{len(counts)} ids do not fit codes of {limit} bits")
    symbols = sorted(counts, key=lambda s: (counts[s], s))
    if len(symbols) < 2:
        return {s: 1 for s in symbols}
    leaves = np.array([counts[s] for s in symbols], np.int64)
    packages, levels = np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(leaves))
        merged = both[order]
        pairs = len(merged) // 2
        packages = merged[0:2 * pairs:2] + merged[1:2 * pairs:2]
    lengths, take = np.zeros(len(leaves), np.int64), 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    return dict(zip(symbols, lengths.tolist()))


@dataclass
class CodeBook:
    """Canonical codes: by length, then by id."""

    length: np.ndarray  # of each id, 0 where it has no code
    code: np.ndarray
    symbol: np.ndarray  # by the next LIMIT bits
    width: np.ndarray

    @classmethod
    def of(cls, lengths: dict[int, int]) -> "CodeBook":
        length, code = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)
        symbol, width = np.zeros(1 << LIMIT, np.uint16), np.zeros(1 << LIMIT, np.uint8)
        at = 0
        for s in sorted(lengths, key=lambda s: (lengths[s], s)):
            n = lengths[s]
            length[s], code[s] = n, at >> (LIMIT - n)
            symbol[at:at + (1 << (LIMIT - n))] = s
            width[at:at + (1 << (LIMIT - n))] = n
            at += 1 << (LIMIT - n)
        return cls(length, code, symbol, width)

    def encode(self, docs: list[np.ndarray]) -> list[tuple[bytes, np.ndarray]]:
        """Code and checkpoints of each document; every document starts at a whole byte."""
        sizes = np.array([len(d) for d in docs], np.int64)
        ids = np.concatenate(docs) if docs else np.zeros(0, np.uint16)
        if not len(ids):
            return [(b"", np.zeros(0, np.uint32)) for _ in docs]
        length = self.length[ids].astype(np.int64)
        ends = np.cumsum(length)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        bit_at = np.concatenate([[0], ends])
        bits = bit_at[bounds[1:]] - bit_at[bounds[:-1]]
        whole = (bits + 7) // 8
        base = np.concatenate([[0], np.cumsum(whole)])
        inner = ends - length - np.repeat(bit_at[bounds[:-1]], sizes)
        place = inner + 8 * np.repeat(base[:-1], sizes)
        word = place >> 5
        value = self.code[ids] << (64 - (place & 31) - length).astype(np.uint64)
        heads = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        out[word[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
        out[word[heads] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), heads)
        raw = out.astype(">u4").tobytes()
        return [(raw[a:b], inner[lo:hi:STRIDE].astype(np.uint32)) for a, b, lo, hi in zip(
            base[:-1].tolist(), base[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]

    def decode(self, code: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of runs of at most STRIDE tokens that start at the given bits, one run after another."""
        raw = np.frombuffer(code + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        order = np.argsort(-counts, kind="stable")
        at = starts.astype(np.int64)[order]
        to = (np.cumsum(counts) - counts)[order]
        sizes = counts[order]
        out = np.zeros(int(counts.sum()), np.uint16)
        live = len(order)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            while live and sizes[live - 1] <= step:
                live = int(np.searchsorted(-sizes, -step, side="left"))
            p = at[:live]
            look = (window[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - LIMIT)
            out[to[:live] + step] = self.symbol[look]
            at[:live] = p + self.width[look]
        return out


def write_block(ids: list[int], coded: list[tuple[int, bytes, bytes]]) -> bytes:
    """``coded``: tokens, code and checkpoints of each document."""
    docs = np.array(ids, "<i8").tobytes() + np.array([c[0] for c in coded], "<u4").tobytes()
    marks = b"".join([c[2] for c in coded])
    return b"".join([MAGIC, np.array([len(coded), len(marks) // 4], "<u4").tobytes(), docs, marks, *[c[1] for c in coded]])


def read_block(data: bytes, book: CodeBook) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, token counts and all token ids of a block."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, m = np.frombuffer(data, "<u4", 2, 4).tolist()
    ids = np.frombuffer(data, "<i8", n, 12)
    counts = np.frombuffer(data, "<u4", n, 12 + 8 * n).astype(np.int64)
    marks = np.frombuffer(data, "<u4", m, 12 + 12 * n).astype(np.int64)
    runs = -(-counts // STRIDE)
    owner = np.repeat(np.arange(n), runs)
    nth = np.arange(m) - np.repeat(np.cumsum(runs) - runs, runs)
    size = np.minimum(counts[owner] - nth * STRIDE, STRIDE)
    return ids, counts, book.decode(data[12 + 12 * n + 4 * m:], marks, size)


def write_token_files(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                      end: int = 1, block_bytes: int = 1 << 20, part_tokens: int = 4 << 20) -> tuple[str, CodeBook]:
    """Writes all documents in ascending id order and returns the folder and the code book, which is stored there too.

    ``blocks``: part, block, n_docs, n_tokens, data. Ids are whole numbers; documents without an id come last, stored with
    the largest number. Rows that share an id stay next to each other. Null texts are empty and hold the end id. No
    documents give no blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-tokens")
    tokens = staged(tokenize(docs, tokenizer, id_col, text_col, end), "token-ids")
    counts = count_ids(tokens)
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(k), int(v)) for k, v in lengths.items()], "token int, length int").coalesce(1).write.parquet(
        f"{path}/book")
    book = CodeBook.of(lengths)
    shared = spark.sparkContext.broadcast(book)  # bounded by the tables of LIMIT bits

    parts = groups_for(sum(counts.values()), part_tokens, slots(spark))
    bounds = sorted(set(tokens.where("__id is not null").approxQuantile("__id", [k / parts for k in range(1, parts)], 1 / (4 * parts))))
    edges = spark.sparkContext.broadcast(np.array(bounds))  # one number per part

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = np.array(batch.column(2))
            for lo, hi in _runs((np.cumsum(sizes) - sizes) // (1 << 20)):
                piece = batch.slice(lo, hi - lo)
                coded = shared.value.encode([np.frombuffer(x.as_buffer(), "<u2") for x in piece.column(1)])
                ids = piece.column(0).fill_null((1 << 63) - 1).cast(pa.int64())
                key = np.searchsorted(edges.value, np.array(ids), side="right").astype(np.int32)
                # rows without an id may be many: their order is free, so they take parts of their own
                empty = np.array(piece.column(0).is_null())
                key[empty] = len(edges.value) + 1 + np.arange(int(empty.sum())) % 64
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int32()), ids, piece.column(2), pa.array([c[0] for c in coded], pa.binary()),
                     pa.array([c[1].astype("<u4").tobytes() for c in coded], pa.binary())],
                    ["part", "id", "n_tokens", "code", "marks"])

    def assemble(group):
        import pyarrow as pa

        group = group.sort_by("id")
        size = np.array([len(x) for x in group.column("code").to_pylist()], np.int64)
        rows = []
        for block, (lo, hi) in enumerate(_runs((np.cumsum(size) - size) // block_bytes)):
            piece = group.slice(lo, hi - lo)
            coded, shift = [], 0
            for n, code, marks in zip(*(piece.column(c).to_pylist() for c in ("n_tokens", "code", "marks"))):
                coded.append((n, code, (np.frombuffer(marks, "<u4").astype(np.int64) + 8 * shift).astype("<u4").tobytes()))
                shift += len(code)
            rows.append((group.column("part")[0].as_py(), block, hi - lo, sum(c[0] for c in coded), write_block(
                piece.column("id").to_pylist(), coded)))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                    ["part", "block", "n_docs", "n_tokens", "data"])

    coded = tokens.mapInArrow(encode, "part int, id long, n_tokens long, code binary, marks binary")
    blocks = coded.groupBy("part").applyInArrow(assemble, "part int, block int, n_docs long, n_tokens long, data binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    return path, book


def read_token_files(spark, path: str) -> DataFrame:
    """Per document: ``__id``, start (tokens before it), n_tokens, ids (32-bit little-endian), from the files alone."""
    lengths = {r["token"]: r["length"] for r in spark.read.schema("token int, length int").parquet(f"{path}/book").collect()}
    shared = spark.sparkContext.broadcast(CodeBook.of(lengths))
    blocks = spark.read.schema("part int, block int, n_docs long, n_tokens long, data binary").parquet(f"{path}/blocks")

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, block, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids, counts, tokens = read_block(data, shared.value)
                raw, cuts = tokens.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(counts)])
                values = [raw[4 * a:4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part), pa.int32()), pa.array(np.full(len(ids), block), pa.int32()),
                     pa.array([None if i == (1 << 63) - 1 else i for i in ids.tolist()], pa.int64()),
                     pa.array(cuts[:-1], pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([zlib.crc32(v) for v in values], pa.int64()), pa.array(values, pa.binary())],
                    ["part", "block", "__id", "skip", "n_tokens", "ids_crc32", "ids"])

    rows = blocks.select("part", "block", "data").mapInArrow(
        decode, "part int, block int, __id long, skip long, n_tokens long, ids_crc32 long, ids binary")
    per_part = blocks.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("first", F.coalesce(F.sum("t").over(before), F.lit(0))).drop("t")
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("base")).join(
        per_part, "part")
    return rows.join(starts, ["part", "block"]).select(
        "__id", (F.col("first") + F.col("base") + F.col("skip")).alias("start"), "n_tokens", "ids_crc32", "ids")
