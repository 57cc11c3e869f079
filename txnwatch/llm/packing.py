"""Best-fit packing by minimum bin slack.

How many pieces there are of each length is all the search needs, and that histogram has at most ``capacity`` rows
however large the corpus is. A bin starts with the longest piece left; a subset-sum over the lengths left, as a bit set,
finds the fullest way to fill the rest; the combination is removed as often as the counts allow. What comes out are
patterns. Pieces are ranked within their length by distributed counts and take their places in the patterns by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import staged
from .sharding import ranked
from .token_output import tokenize


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(length, uses) of a combination with the largest sum up to ``room``. ``lengths``: those left, longest first."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for n in lengths:
        if n > room:
            continue
        steps.append((n, reach))
        left, power = min(counts[n], room // n), 1
        while left > 0:
            use = min(power, left)
            reach |= reach << (n * use) & mask
            left, power = left - use, power * 2
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        uses = 0
        while not before >> target & 1:
            target, uses = target - n, uses + 1
        if uses:
            chosen.append((n, uses))
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as (length, uses) lists, each with the number of times it is made; together they take every piece."""
    counts = {n: c for n, c in counts.items() if c > 0}
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("a piece is empty or longer than a bin")
    lengths, out = sorted(counts, reverse=True), []
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        inner = lengths if counts[top] else lengths[1:]
        chosen = dict(fullest(counts, inner, capacity - top))
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        times = min(counts[n] // uses for n, uses in chosen.items())
        out.append((sorted(chosen.items(), reverse=True), times))
        for n, uses in chosen.items():
            counts[n] -= uses * times
            if not counts[n]:
                del counts[n]
                lengths.remove(n)
    return out


def place(found: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """For each length and run of ranks: length, first rank, uses, first bin, offset. Sorted by length and rank."""
    rows, used, bin_ = [], {}, 0
    for items, times in found:
        offset = 0
        for n, uses in items:
            first = used.get(n, 0)
            rows.append((n, first, uses, bin_, offset))
            used[n] = first + uses * times
            offset += n * uses
        bin_ += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(tokens: DataFrame, capacity: int) -> DataFrame:
    """``__id``, piece, start, length, ids_crc32 of every document of ``tokens`` (``__id``, 16-bit ``ids``)."""
    kind = tokens.schema["__id"].dataType.simpleString()

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = ([], [], [], [], [])
            for k, raw in enumerate(batch.column(1)):
                ids = np.frombuffer(raw.as_buffer(), "<u2").astype("<u4")
                for nth, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    for column, value in zip(rows, (k, nth, start, len(part), zlib.crc32(part.tobytes()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[0], pa.int32())), pa.array(rows[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in rows[2:])], ["__id", "piece", "start", "length", "ids_crc32"])

    return tokens.select("__id", "ids").mapInArrow(
        cut, f"__id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_lengths(items: DataFrame, capacity: int, order: list[str], cell_rows: int = 2048) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``. Its column ``length`` lies between 1 and ``capacity``; rows that
    agree in all columns of ``order`` are interchangeable."""
    histogram = items.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in histogram.collect()}
    spark = items.sparkSession
    table = spark.sparkContext.broadcast(place(patterns(counts, capacity)))  # bounded by the capacity
    cells = spark.createDataFrame([(n, max(1, c // cell_rows)) for n, c in counts.items()], "length long, n_cells long")
    ranks = ranked(items.join(F.broadcast(cells), "length"), ["length"], F.col("n_cells"), order).drop("n_cells", "position")
    names = [f.name for f in items.schema.fields]

    def put(batches: Iterator) -> Iterator:
        import pyarrow as pa

        t = table.value
        keys = (t[:, 0] << 44) + t[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = t[np.searchsorted(keys, (length << 44) + rank, side="right") - 1] if len(length) else t[:0]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(row[:, 3] + nth // np.maximum(row[:, 2], 1), pa.int64()),
                 pa.array(row[:, 4] + nth % np.maximum(row[:, 2], 1) * length, pa.int64())], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema.fields)
    return ranks.select(*names, "rank").mapInArrow(put, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text",
                   end: int = 1) -> DataFrame:
    """One row per piece: ``__id``, piece, start, length, ids_crc32, sequence_id, offset.

    Only documents longer than the capacity are cut. Null and empty texts hold the end id alone. Null ids and repeated
    rows are packed like others. No documents give no rows. Other columns are not read.
    """
    cut = staged(pieces(tokenize(docs, tokenizer, id_col, text_col, end), capacity), "pieces")
    return pack_lengths(cut, capacity, ["__id", "piece", "ids_crc32"])
