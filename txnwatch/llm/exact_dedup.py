"""Exact deduplication against an immutable snapshot.

A snapshot holds one row per distinct text, spread over buckets of its digest, and for every bucket a static
binary-fuse filter. Digests of an incoming batch are screened by the filter of their bucket. Positives join the
exact bucket and their texts are compared byte by byte; the rest are new, and duplicates among them are grouped on
their own. No filter is ever broadcast: bucket and filter meet in one task, whose size is set by ``per_bucket``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import groups_for, normal, staged

MASK = (1 << 64) - 1


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & MASK)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


@dataclass
class FuseFilter:
    """A binary-fuse filter: every key's fingerprint is the xor of three cells in three neighbouring segments."""

    seed: int
    segment: int
    cells: np.ndarray

    @staticmethod
    def _shape(n: int) -> tuple[int, int]:
        """Segment length (a power of two) and number of starting segments for n keys."""
        segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        factor = max(1.125, 0.875 + 0.25 * np.log(1_000_000) / np.log(max(n, 3)))
        return segment, max(1, -(-int(n * factor) // segment) - 2)

    @staticmethod
    def _places(h: np.ndarray, segment: int, starts: int) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(starts) >> np.uint64(32)) * np.uint64(segment)
        mask = np.uint64(segment - 1)
        return np.stack([first + (h & mask), first + np.uint64(segment) + (h >> np.uint64(13) & mask),
                         first + np.uint64(2 * segment) + (h >> np.uint64(20) & mask)]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(40))) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        keys = np.unique(np.asarray(keys).astype(np.int64).view(np.uint64))
        n = len(keys)
        segment, starts = cls._shape(n)
        for seed in range(100):
            if seed and seed % 10 == 0:
                starts += max(1, starts // 10)
            h = _mix(keys, seed)
            places = cls._places(h, segment, starts)
            order = cls._peel(places, (starts + 2) * segment)
            if order is not None:
                return cls(seed, segment, cls._fill(h, places, order, (starts + 2) * segment))
        raise RuntimeError(f"no binary-fuse filter found for {n} keys")

    @staticmethod
    def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, the cell each of them owns); a round takes all cells that one remaining key uses."""
        n = places.shape[1]
        left = np.ones(n, bool)
        count = np.bincount(places.ravel(), minlength=size)
        which = np.zeros(size, np.int64)
        ids = np.arange(n)
        for row in places:
            np.bitwise_xor.at(which, row, ids)
        rounds, taken = [], 0
        while taken < n:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                return None
            keys, first = np.unique(which[alone], return_index=True)
            rounds.append((keys, alone[first]))
            taken += len(keys)
            left[keys] = False
            for row in places[:, keys]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(which, row, keys)
        return rounds

    @classmethod
    def _fill(cls, h, places, rounds, size) -> np.ndarray:
        cells = np.zeros(size, np.uint16)
        prints = cls._print(h)
        for keys, own in reversed(rounds):
            p = places[:, keys]
            cells[own] = 0
            cells[own] = prints[keys] ^ cells[p[0]] ^ cells[p[1]] ^ cells[p[2]]
        return cells

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(np.asarray(keys).astype(np.int64).view(np.uint64), self.seed)
        p = self._places(h, self.segment, len(self.cells) // self.segment - 2)
        return self._print(h) == self.cells[p[0]] ^ self.cells[p[1]] ^ self.cells[p[2]]


@dataclass
class Snapshot:
    """Stored once, never changed. ``entries``: bucket, key, sha, keep_id, copies. ``filters``: bucket, seed, segment,
    cells."""

    entries: DataFrame
    filters: DataFrame
    buckets: int


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id``, ``__sha`` (of the normalised text), ``__key`` (its first 64 bits)."""
    sha = F.sha2(normal(F.col(text_col)), 256)
    return docs.select(F.col(id_col).alias("__id"), sha.alias("__sha")).withColumn(
        "__key", F.conv(F.substring("__sha", 1, 15), 16, 10).cast("long"))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One row per digest: the smallest id and the number of rows. Reduced before the shuffle, so any number of copies
    of one text costs one row per task."""
    return rows.groupBy("__sha", "__key").agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))


def build_snapshot(distinct: DataFrame, buckets: int) -> Snapshot:
    entries = staged(distinct.withColumn("bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)).cast("int")), "snapshot")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(group["__key"].to_numpy())
        return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "seed": [f.seed], "segment": [f.segment],
                             "cells": [f.cells.tobytes()]})

    filters = staged(entries.select("bucket", "__key").groupBy("bucket").applyInPandas(
        build, "bucket int, seed int, segment int, cells binary"), "filters")
    return Snapshot(entries, filters, buckets)


def screen(distinct: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``__key`` of the incoming digests that the snapshot may hold. Only keys and buckets go through Python."""
    def look(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not (len(found) and len(keys)):
            return keys[["__key"]].iloc[:0]
        row = found.iloc[0]
        f = FuseFilter(int(row["seed"]), int(row["segment"]), np.frombuffer(row["cells"], np.uint16))
        return keys.loc[f.contains(keys["__key"].to_numpy()), ["__key"]]

    bucket = F.pmod(F.xxhash64("__key"), F.lit(snapshot.buckets)).cast("int").alias("bucket")
    keyed = distinct.select(bucket, "__key")
    return keyed.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(look, "__key long").distinct()


def classes(docs: DataFrame, is_old, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 200_000,
            rows: int | None = None) -> DataFrame:
    """One row per distinct text of ``docs``: ``__sha``, ``keep_id``, ``group_size``.

    ``is_old`` is a condition that splits the rows in the batch that becomes the snapshot and the incoming batch; every
    row is in one of them. Two texts that share a digest but not their bytes stop the job.
    """
    rows_of = lambda part: distinct_texts(digests(part, id_col, text_col))
    old = F.coalesce(is_old, F.lit(False))
    buckets = groups_for(docs.count() if rows is None else rows, per_bucket, 4)
    snapshot = build_snapshot(rows_of(docs.where(old)), buckets)
    seen = staged(rows_of(docs.where(~old)), "incoming")
    maybe = seen.join(screen(seen, snapshot), "__key", "left_semi")
    hits = maybe.join(snapshot.entries.select("__sha", F.col("keep_id").alias("old_id"),
                                              F.col("copies").alias("old_copies")), "__sha")
    hits = staged(hits.select("__sha", "keep_id", "copies", "old_id", "old_copies"), "hits")

    # one text per digest and side, compared as bytes
    def texts(part: DataFrame, name: str) -> DataFrame:
        own = part.select(normal(F.col(text_col)).alias("__text")).withColumn("__sha", F.sha2("__text", 256))
        return own.join(hits.select("__sha"), "__sha", "left_semi").groupBy("__sha").agg(
            F.min("__text").alias(name), F.max("__text").alias(f"{name}_max"))

    same = (F.col("a") == F.col("b")) & (F.col("a") == F.col("a_max")) & (F.col("b") == F.col("b_max"))
    checked = texts(docs.where(old), "a").join(texts(docs.where(~old), "b"), "__sha").where(
        F.when(same, True).otherwise(F.raise_error("two different texts share a digest").cast("boolean"))).select("__sha")
    merged = hits.join(checked, "__sha").select(
        "__sha", F.least("keep_id", "old_id").alias("keep_id"), (F.col("copies") + F.col("old_copies")).alias("group_size"))
    only_old = snapshot.entries.join(hits.select("__sha"), "__sha", "left_anti")
    only_new = seen.join(hits.select("__sha"), "__sha", "left_anti")
    single = [p.select("__sha", "keep_id", F.col("copies").alias("group_size")) for p in (only_old, only_new)]
    return staged(merged.unionByName(single[0]).unionByName(single[1]), "classes")


def _found(docs: DataFrame, id_col: str, text_col: str, per_bucket: int) -> tuple[DataFrame, int]:
    """The classes of all rows, and the number of rows."""
    low, high, rows = docs.agg(F.min(id_col), F.max(id_col), F.count(F.lit(1))).first()
    middle = (low + high) // 2 if low is not None else 0
    found = classes(docs, F.col(id_col) <= middle, id_col, text_col, per_bucket, rows)
    return found.withColumnsRenamed({"keep_id": "__keep_id", "group_size": "__group_size"}), rows


def _by_text(rows: DataFrame, found: DataFrame, n: int, big: int) -> DataFrame:
    """``rows`` with the class of their ``__sha``. A group of more than ``big`` rows is not gathered: at most 100 000 groups
    are so large, and their classes are broadcast."""
    limit = max(big, n // 100_000)
    large = F.broadcast(found.where(F.col("__group_size") > limit))
    small = rows.join(large.select("__sha"), "__sha", "left_anti").join(found.where(F.col("__group_size") <= limit), "__sha")
    return small.unionByName(rows.join(large, "__sha"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 200_000,
                big: int = 100_000) -> DataFrame:
    """All columns of ``docs`` with ``__keep_id``, ``__group_size``, ``__kept``, ``__sha``.

    The lower half of the id range is the snapshot, the upper half arrives. Null and empty texts are equal. A row
    without an id arrives, and stays only if no equal row has an id. Rows repeated with id and text: one of them
    stays. An empty table gives an empty result. Columns of the input that start with two underscores are not allowed;
    others may have any name. Whole rows meet their class by the digest; ``drop_duplicates`` moves less.
    """
    found, n = _found(docs, id_col, text_col, per_bucket)
    rows = docs.withColumn("__sha", F.sha2(normal(F.col(text_col)), 256))
    first = F.col(id_col).eqNullSafe(F.col("__keep_id"))
    if not _repeated(rows, id_col):
        return _by_text(rows, found, n, big).withColumn("__kept", first)
    # rows are told apart by numbers, which are stored, so that every reader sees the same
    joined = staged(_by_text(rows, found, n, big).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    one = joined.where(first).groupBy("__sha").agg(F.min("__row").alias("__first"))
    one = one.withColumnRenamed("__sha", "__of")
    joined = joined.join(one, F.when(first, F.col("__sha")) == F.col("__of"), "left")
    return joined.withColumn("__kept", F.coalesce(F.col("__row") == F.col("__first"), F.lit(False))).drop("__row", "__first", "__of")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 200_000) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns; odd rows as in ``exact_dedup``. Rows meet the kept ones by digest and
    id, so a text that a third of all rows share is spread like any other."""
    if _repeated(docs, id_col):
        return exact_dedup(docs, id_col, text_col, per_bucket).where("__kept").select(*docs.columns)
    found, _ = _found(docs, id_col, text_col, per_bucket)
    rows = docs.withColumn("__sha", F.sha2(normal(F.col(text_col)), 256))
    kept = found.select(F.col("__sha").alias("__of"), "__keep_id")
    return rows.join(kept, (F.col("__sha") == F.col("__of")) & F.col(id_col).eqNullSafe(F.col("__keep_id")),
                     "left_semi").select(*docs.columns)


def _repeated(rows: DataFrame, id_col: str) -> bool:
    """Whether any id stands on more than one row."""
    return bool(rows.groupBy(id_col).count().where("count > 1").take(1))
