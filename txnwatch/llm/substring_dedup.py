"""Removal of long passages that an earlier document already holds.

Every window of ``width`` words gets a Rabin-Karp hash. A map task settles what repeats among its own documents and
sends each remaining hash once, with the smallest id that has it, packed by bucket of the hash; so a passage in a third
of all documents costs a bucket one entry per map batch. A bucket's task finds the smallest id of every hash and sends
the repeats, packed by bucket of the id, to where the texts meet them. There windows become intervals of words.

Hashes have 64 bits: among n different windows about n * n / 2 ** 65 pairs are taken for equal by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import groups_for, pieces, release, slots

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 16
NO_ID = (1 << 63) - 1
KEPT = ["__id", "n_words", "n_removed", "kept", "intervals"]
_powers: dict[int, np.ndarray] = {}
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(16, int(n).bit_length()), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


class Words:
    """The words of many texts, each followed by one space, in one array of bytes."""

    def __init__(self, texts: list[bytes | None]):
        raw = np.frombuffer(b" ".join([t or b"" for t in texts]) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
        blank = IS_BLANK[raw]
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]
        self.bytes = np.where(blank, np.uint8(32), raw)[keep]
        ends = np.flatnonzero(self.bytes == 32) + 1
        self.starts = np.concatenate([[0], ends]).astype(np.int64)  # of words; the last entry is the end
        at = np.cumsum([len(t or b"") + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        blank[1:] |= ~blank[:-1]  # from here on false only where a word begins
        self.offsets = np.concatenate([[0], np.searchsorted(np.flatnonzero(~blank), at)]).astype(np.int64)  # of texts, in words
        self.counts = np.diff(self.offsets)

    def _sums(self) -> np.ndarray:
        """Sums of the values of all bytes before each word. Blocks of bytes are summed one after the other, so that only
        words, not bytes, take eight bytes of memory each."""
        sums, total, scale = np.zeros(len(self.starts), np.uint64), 0, 1
        for lo in range(0, len(self.bytes), BLOCK):
            part = BYTE_VALUES[self.bytes[lo:lo + BLOCK]]
            part *= powers(BASE, BLOCK)[:len(part)]
            run = np.cumsum(part, dtype=np.uint64)
            i, j = np.searchsorted(self.starts, [lo, lo + len(part)], side="right")
            sums[i:j] = run[self.starts[i:j] - lo - 1] * np.uint64(scale) + np.uint64(total)
            total, scale = (total + int(run[-1]) * scale) % (1 << 64), scale * pow(BASE, BLOCK, 1 << 64) % (1 << 64)
        return sums

    def hashes(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rabin-Karp hash of the words from ``first`` up to ``end`` (word numbers)."""
        sums, a = self._sums(), self.starts[first]
        h = sums[end] - sums[first]
        h *= powers(INVERSE, BLOCK)[a % BLOCK]
        h *= powers(pow(INVERSE, BLOCK, 1 << 64), len(self.bytes) // BLOCK + 1)[a // BLOCK]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h

    def windows(self, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window inside one text: first word, text, hash. ``short``: a text with fewer words than a window has
        all its words as one window."""
        per = np.maximum(self.counts - width + 1, np.minimum(self.counts, 1) if short else 0)
        text = np.repeat(np.arange(len(per)), per)
        first = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + self.offsets[:-1][text]
        return first, text, self.hashes(first, np.minimum(first + width, self.offsets[1:][text]))

    def without(self, removed: np.ndarray) -> list[bytes]:
        """The words of each text that are not removed, joined by one space."""
        lengths = np.diff(self.starts)
        kept = self.bytes[np.repeat(~removed, lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(np.where(removed, 0, lengths))])[self.offsets]
        return [kept[a:b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _pack(bucket: np.ndarray, n: int, *arrays: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    order = np.lexsort((arrays[-1], bucket))  # by id within a bucket, so that ids form runs
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        rows = order[cuts[b]:cuts[b + 1]]
        yield int(b), [a[rows].tobytes() for a in arrays]


def _hash_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    return (hashes % np.uint64(n)).astype(np.int32)


def _id_bucket(ids: np.ndarray, n: int) -> np.ndarray:
    return ((ids ^ (ids.view(np.uint64) >> np.uint64(17)).view(np.int64)) % n).astype(np.int32)


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = 8 << 20, flush_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: ``__id``, n_words, n_removed, kept_text, intervals (words [first, end) taken out).

    Ids are whole numbers. A document without an id counts as later than all that have one. Rows that share an id do not
    remove from each other. Texts of fewer than ``width`` words stay whole; a null text has no words; empty tables give no
    rows. Other columns are not read. Windows are judged on the input, so a removed passage still removes later ones.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__id"),
                       F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = groups_for(total, bucket_bytes, slots(docs.sparkSession)) | 1

    def hashes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def settle(ids: list[int], texts: list[bytes | None]) -> pa.RecordBatch:
            _, text, h = Words(texts).windows(width)
            doc = np.array(ids, np.int64)[text]
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            lead = np.ones(len(h), bool)
            lead[1:] = h[1:] != h[:-1]
            least = doc[lead][np.cumsum(lead) - 1] if len(h) else doc
            local = doc > least  # repeats that this batch can settle
            out: list[tuple[int, bool, bytes, bytes]] = []
            for b, (hs, ds) in _pack(_hash_bucket(h[lead], buckets), buckets, h[lead], doc[lead]):
                out.append((b, False, hs, ds))
            for b, (hs, ds) in _pack(_id_bucket(doc[local], buckets), buckets, h[local], doc[local]):
                out.append((b, True, hs, ds))
            columns = list(zip(*out)) if out else [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary()),
                 pa.array(map(_squeeze, columns[3]), pa.binary())], ["bucket", "settled", "hashes", "ids"])

        release()
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                texts.append(t)
                size += len(t or b"")
                if size >= flush_bytes:
                    yield settle(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield settle(ids, texts)

    def count(group):
        """The repeats of one bucket of hashes, and what map tasks had settled, packed by bucket of the id."""
        import pyarrow as pa

        release()
        settled = group.column("settled").to_pylist()
        hs = [np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()]
        ds = [_unsqueeze(x) for x in group.column("ids").to_pylist()]
        mine = [k for k, done in enumerate(settled) if not done]
        h = np.concatenate([hs[k] for k in mine]) if mine else np.zeros(0, np.uint64)
        d = np.concatenate([ds[k] for k in mine]) if mine else np.zeros(0, np.int64)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        lead = np.ones(len(h), bool)
        lead[1:] = h[1:] != h[:-1]
        again = d > (d[lead][np.cumsum(lead) - 1] if len(h) else d)
        h = np.concatenate([h[again], *[hs[k] for k, done in enumerate(settled) if done]])
        d = np.concatenate([d[again], *[ds[k] for k, done in enumerate(settled) if done]])
        out = [(b, hx, _squeeze(dx)) for b, (hx, dx) in _pack(_id_bucket(d, buckets), buckets, h, d)]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.Table.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()),
                                     pa.array(columns[2], pa.binary())], ["bucket", "hashes", "ids"])

    def remove(left, right):
        import pyarrow as pa

        release()
        mixed = lambda h, d: (h ^ (d.astype(np.uint64) * np.uint64(BASE))) * np.uint64(INVERSE | 1)
        known = [mixed(np.frombuffer(h, np.uint64), _unsqueeze(d)) for h, d in zip(
            right.column("hashes").to_pylist(), right.column("ids").to_pylist())]
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *known]))
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        parts = [pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), kind)], KEPT)]
        for part in pieces(left.select(["__id", "text"])):
            ids = part.column("__id").to_numpy()
            words = Words(part.column("text").to_pylist())
            n_removed, spans, kept = _taken_out(words, ids, known, mixed, width)
            parts.append(pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()),
                                               pa.array(kept, pa.binary()), pa.array(spans, kind)], KEPT))
        return pa.concat_tables(parts)

    sent = rows.mapInArrow(hashes, "bucket int, settled boolean, hashes binary, ids binary")
    repeats = sent.groupBy("bucket").applyInArrow(count, "bucket int, hashes binary, ids binary")
    route = F.pmod(F.col("__id").bitwiseXOR(F.shiftrightunsigned("__id", 17)), F.lit(buckets)).cast("int")
    out = rows.withColumn("bucket", route).groupBy("bucket").cogroup(repeats.groupBy("bucket")).applyInArrow(
        remove, "__id long, n_words long, n_removed long, kept binary, intervals array<struct<first:int,end:int>>")
    return out.withColumn("__id", F.nullif("__id", F.lit(NO_ID))).withColumn("kept_text", F.col("kept").cast("string")).drop("kept")


def _taken_out(words: Words, ids: np.ndarray, known: np.ndarray, mixed, width: int) -> tuple[np.ndarray, list[list[dict]], list[bytes]]:
    """Of each text: number of words removed, runs of them, what is left. ``known``: sorted mixtures of hash and id."""
    removed = np.zeros(int(words.offsets[-1]), bool)
    if len(known) and len(removed):
        first, text, own = words.windows(width)
        own = mixed(own, ids[text])
        hit = first[known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own]
        edge = np.bincount(hit, minlength=len(removed) + width + 1) - np.bincount(hit + width, minlength=len(removed) + width + 1)
        removed = np.cumsum(edge)[:len(removed)] > 0
    total = np.concatenate([[0], np.cumsum(removed)])[words.offsets]
    step = np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))
    # a run of removed words is cut where a text ends
    cut = np.zeros(len(removed) + 1, bool)
    inner = words.offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(removed))]
    cut[inner] = removed[inner - 1] & removed[inner] if len(inner) else False
    begin, end = np.flatnonzero((step == 1) | cut), np.flatnonzero((step == -1) | cut)
    owner = np.searchsorted(words.offsets, begin, side="right") - 1
    spans: list[list[dict]] = [[] for _ in words.counts]
    for o, a, b in zip(owner.tolist(), begin.tolist(), end.tolist()):
        at = int(words.offsets[o])
        spans[o].append({"first": a - at, "end": b - at})
    return np.diff(total), spans, words.without(removed)


def _squeeze(ids: bytes) -> bytes:
    """Ids as runs: count of runs, run lengths, values."""
    a = np.frombuffer(ids, np.int64)
    lead = np.ones(len(a), bool)
    lead[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(lead)
    return np.int64(len(at)).tobytes() + np.diff(np.append(at, len(a))).astype(np.int32).tobytes() + a[at].tobytes()


def _unsqueeze(packed: bytes) -> np.ndarray:
    n = int(np.frombuffer(packed[:8], np.int64)[0])
    return np.repeat(np.frombuffer(packed[8 + 4 * n:], np.int64), np.frombuffer(packed[8:8 + 4 * n], np.int32))
