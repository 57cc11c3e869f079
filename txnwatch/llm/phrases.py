"""Phrases whose words stand together more often than chance, from a weighted de Bruijn graph.

Nodes are runs of four words, edges runs of five: every word of a piece starts one edge, or near the end of its piece a
shorter run. Map tasks add up equal runs before anything moves, and runs meet by their first word. A task then has all
edges that leave a node, so the count of every shorter phrase is the flow through its node: what the edges carry plus the
runs that end with the piece. A node that passes its whole flow on by one edge is stored with that edge, as a path that
covers several lengths.

First words, pairs, and so on that would fill half a bucket are spread by their next word; their flows are added up
afterwards. A sample of the runs names them, which decides where runs go and never what is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import groups_for, slots, staged

LONGEST = 5
SAMPLE = 256  # one run in so many is looked at for hot beginnings
MAX_BUCKETS = 200_000
WORD, BLANK, BREAK = 0, 1, 2
KIND = np.zeros(256, np.uint8)  # of each byte
KIND[[9, 32]] = BLANK
KIND[[*b".,;:!?\n\x0b\x0c\r"]] = BREAK
LOWER = bytes(range(256)).lower()


@dataclass
class Runs:
    """Distinct runs of up to five words in order: ``lang`` and ``words`` (one row per place, 0 where the run is over) number
    the entries of ``langs`` and ``texts``, words from 1; ``count`` says how often a run occurs."""

    lang: np.ndarray
    words: np.ndarray
    count: np.ndarray
    langs: list[str]
    texts: object  # a binary Arrow array

    @property
    def length(self) -> np.ndarray:
        return (self.words > 0).sum(0)


def _in_order(lang: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order by language and words, and the sorted keys that tell runs apart."""
    bits = int(words.max(initial=0)).bit_length()
    if 3 * bits <= 64 and int(lang.max(initial=0)).bit_length() + 2 * bits <= 64:
        w, b = words.astype(np.uint64), np.uint64(bits)
        keys = [((lang.astype(np.uint64) << b | w[0]) << b) | w[1], ((w[2] << b | w[3]) << b) | w[4]]
    else:
        keys = [lang, *words]
    order = np.lexsort(keys[::-1])
    return order, [k[order] for k in keys]


def _numbered(lists: list[tuple[np.ndarray, bytes]]):
    """The distinct words of many lists, and the number, from 1, of every entry."""
    import pyarrow as pa

    sizes = np.concatenate([s for s, _ in lists]) if lists else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    data = b"".join([d for _, d in lists])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    numbers = coded.indices.to_numpy() + np.int32(1)
    return coded.dictionary, np.split(numbers, np.cumsum([len(s) for s, _ in lists])[:-1]) if lists else []


def cut(langs: list[str], texts: list[bytes]) -> Runs:
    """The runs of some texts, equal ones added up."""
    import pyarrow as pa

    names = sorted(set(langs))
    number = {name: k for k, name in enumerate(names)}
    raw = np.frombuffer(b"\n".join(texts).translate(LOWER) + b"\n", np.uint8)
    kind = KIND[raw]
    inside = kind == WORD
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = len(starts)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside].tobytes())]).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int32) + 1
    piece = np.cumsum(kind == BREAK, dtype=np.int64)[starts]
    left = np.searchsorted(piece, piece, side="right") - np.arange(n)  # words to the end of the piece
    ends = np.cumsum([len(t) + 1 for t in texts])
    lang = np.array([number[x] for x in langs], np.int32)[np.searchsorted(ends, starts, side="right")]
    words = np.zeros((LONGEST, n), np.int32)
    for k in range(LONGEST):
        words[k, :n - k] = np.where(left[:n - k] > k, code[k:], 0)
    order, keys = _in_order(lang, words)
    lead = np.ones(n, bool)
    lead[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    first = np.flatnonzero(lead)
    at = order[first]
    return Runs(lang[at], words[:, at], np.diff(np.append(first, n)), names, coded.dictionary)


def beginnings(runs: Runs) -> np.ndarray:
    """A hash of the first 1 ... 5 words of each run with its language; over its end a run keeps its last hash."""
    import xxhash

    of = np.array([0, *[xxhash.xxh64_intdigest(w.as_py()) for w in runs.texts]], np.uint64)
    h = np.array([xxhash.xxh64_intdigest(x.encode(), 7) for x in runs.langs] or [0], np.uint64)[runs.lang]
    out = np.zeros(runs.words.shape, np.uint64)
    for k, w in enumerate(runs.words):
        mixed = (h ^ of[w]) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = np.where(w > 0, mixed ^ (mixed >> np.uint64(32)), h)
        out[k] = h
    return out


def _batches(batches: Iterator, flush_bytes: int) -> Iterator[Runs]:
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            langs.append(lang.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= flush_bytes:
                yield cut(langs, texts)
                langs, texts, size = [], [], 0
    if langs:
        yield cut(langs, texts)


def survey(rows: DataFrame, flush_bytes: int) -> DataFrame:
    """``level`` 0: words per language. -1: sampled runs. 1 to 4: how many sampled runs begin with the words of ``key``."""
    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for runs in _batches(batches, flush_bytes):
            h, length = beginnings(runs), runs.length
            total = np.bincount(runs.lang, weights=runs.count, minlength=len(runs.langs)).astype(np.int64)
            taken = h[-1] % np.uint64(SAMPLE) == 0
            level, key, n = [0] * len(total) + [-1], [0] * (len(total) + 1), [*total.tolist(), int(taken.sum())]
            lang = [*runs.langs, ""]
            for k in range(1, LONGEST):
                keys, counts = np.unique(h[k - 1][taken & (length >= k)].view(np.int64), return_counts=True)
                level += [k] * len(keys)
                key += keys.tolist()
                n += counts.tolist()
                lang += [""] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(level, pa.int32()), pa.array(key, pa.int64()),
                                              pa.array(n, pa.int64())], ["lang", "level", "key", "n"])

    return rows.mapInArrow(look, "lang string, level int, key long, n long").groupBy("lang", "level", "key").agg(F.sum("n").alias("n"))


def route(runs: Runs, hot: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run, and the least number of first words that no other bucket shares: one where the first word is not
    hot, two where it is but the pair is not, and so on; more than the run has where all of it is hot."""
    h, length = beginnings(runs), runs.length
    own = np.ones(len(length), np.int64)
    for k in range(1, LONGEST):
        own += (own == k) & (length >= k) & np.isin(h[k - 1], hot[k - 1])
    at = h[np.minimum(own, length) - 1, np.arange(len(length))]
    return (at % np.uint64(buckets)).astype(np.int64), own


def flows(group: list[Received], least: int) -> dict[str, list]:
    """Paths of one bucket: lang, phrase, ``shortest``, ``longest`` (numbers of first words that it counts), f, whole (no other
    bucket adds to it)."""
    langs = sorted({x for r in group for x in r.langs})
    place = {x: k for k, x in enumerate(langs)}
    texts, numbers = _numbered([r.texts for r in group])
    lang = np.concatenate([np.array([place[x] for x in r.langs], np.int32)[r.lang] for r in group])
    words = np.concatenate([np.concatenate([np.zeros(1, np.int32), n])[r.words] for r, n in zip(group, numbers)], axis=1)
    count, shared = np.concatenate([r.count for r in group]).astype(np.int64), np.concatenate([r.own for r in group])
    order, _ = _in_order(lang, words)
    lang, words, count, shared = lang[order], words[:, order], count[order], shared[order]
    n = len(lang)
    change, starts = np.ones(n, bool), []
    change[1:] = lang[1:] != lang[:-1]
    for w in words:  # where the runs with the same first 1 ... 5 words begin
        change = change.copy()
        change[1:] |= w[1:] != w[:-1]
        starts.append(np.flatnonzero(change))
    flow: list[np.ndarray] = [np.zeros(0, np.int64)] * LONGEST
    flow[-1] = np.add.reduceat(count, starts[-1]) if n else count
    for k in range(LONGEST - 2, -1, -1):  # a node's flow: its edges and the runs that end there
        flow[k] = np.add.reduceat(flow[k + 1], np.searchsorted(starts[k + 1], starts[k])) if n else count
    out: dict[str, list] = {c: [] for c in ("lang", "phrase", "shortest", "longest", "f", "whole")}
    shortest = np.ones(len(starts[0]), np.int64)
    for k in range(LONGEST):
        at, there = starts[k], words[k][starts[k]] > 0
        whole = shared[at] <= k + 1
        through = np.zeros(len(at), bool)
        if k + 1 < LONGEST:
            parent = np.searchsorted(at, starts[k + 1], side="right") - 1
            ways = np.bincount(parent, minlength=len(at))
            through = whole & (ways == 1) & (words[k + 1][at] > 0)
        told = np.flatnonzero(there & ~through & ((flow[k] >= least) | ~whole))
        tops = at[told]
        picked = [texts.take(words[j][tops] - 1).to_pylist() for j in range(k + 1)]
        out["lang"] += [langs[x] for x in lang[tops].tolist()]
        out["phrase"] += [b" ".join(p) for p in zip(*picked)]
        out["shortest"] += shortest[told].tolist()
        out["longest"] += [k + 1] * len(told)
        out["f"] += flow[k][told].tolist()
        out["whole"] += whole[told].tolist()
        if k + 1 < LONGEST:
            shortest = np.where(through[parent], shortest[parent], k + 2)
    return out


def _words(texts) -> tuple[np.ndarray, bytes]:
    """The lengths of the words of an Arrow array, and all of them joined."""
    if not len(texts):
        return np.zeros(0, np.int64), b""
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.diff(ends), texts.buffers()[2].to_pybytes()[ends[0]:ends[-1]] if ends[-1] else b""


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}" if n else "u1")


def _send(runs: Runs, bucket: np.ndarray, own: np.ndarray, buckets: int) -> Iterator[dict]:
    """One row per bucket that gets runs of this batch, with the words these use."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    number = np.zeros(len(runs.texts) + 1, np.int32)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[b]:cuts[b + 1]]
        words = runs.words[:, at]
        used = np.unique(words)
        used = used[used > 0]
        number[used] = np.arange(1, len(used) + 1)
        langs, lang = np.unique(runs.lang[at], return_inverse=True)
        sizes, data = _words(runs.texts.take(used - 1))
        yield {"bucket": b, "n_runs": len(at), "n_words": len(used), "langs": [runs.langs[k] for k in langs.tolist()], "lang": _narrow(lang),
               "words": _narrow(number[words]), "sizes": _narrow(sizes), "data": data, "count": _narrow(runs.count[at]), "own": _narrow(own[at])}


@dataclass
class Received:
    """Runs as another task sent them; ``texts`` are word lengths and the words joined."""

    lang: np.ndarray
    words: np.ndarray
    count: np.ndarray
    own: np.ndarray
    langs: list[str]
    texts: tuple[np.ndarray, bytes]

    @classmethod
    def of(cls, row: dict) -> "Received":
        n = row["n_runs"]
        return cls(_wide(row["lang"], n), _wide(row["words"], LONGEST * n).reshape(LONGEST, n), _wide(row["count"], n), _wide(row["own"], n),
                   row["langs"], (_wide(row["sizes"], row["n_words"]).astype(np.int64), row["data"]))


def phrase_counts(docs: DataFrame, least: int = 100, lang_col: str = "lang", text_col: str = "text", per_bucket: int = 400_000,
                  flush_bytes: int = 6 << 20) -> tuple[DataFrame, DataFrame]:
    """(lang, n) with the words of each language; (lang, phrase, m, f, top) with every phrase of up to five words that occurs
    ``least`` times or more. ``top``: no longer phrase that begins with it has its whole count, as far as its bucket knows."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    seen = staged(survey(rows, flush_bytes), "survey")
    sampled = seen.where("level = -1").agg(F.sum("n")).first()[0] or 0
    buckets = min(MAX_BUCKETS, groups_for(sampled * SAMPLE, per_bucket, slots(docs.sparkSession)))
    # a level has at most 2 * buckets beginnings with so large a share of the sample
    hot: list = [[] for _ in range(1, LONGEST)]
    for r in seen.where((F.col("level") > 0) & (F.col("n") > max(8, sampled / (2 * buckets)))).collect():
        hot[r["level"] - 1].append(r["key"])
    hot = [np.array(sorted(keys), np.int64).view(np.uint64) for keys in hot]

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for runs in _batches(batches, flush_bytes):
            if len(runs.count):
                yield pa.RecordBatch.from_pylist(list(_send(runs, *route(runs, hot, buckets), buckets)), SENT)

    def count(group):
        import pyarrow as pa

        names = group.column_names
        got = [Received.of(dict(zip(names, row))) for row in zip(*[group.column(c).to_pylist() for c in names])]
        return pa.Table.from_pydict(flows(got, least), PATHS)

    import pyarrow as pa

    SENT = pa.schema([("bucket", pa.int32()), ("n_runs", pa.int32()), ("n_words", pa.int32()), ("langs", pa.list_(pa.string())),
                      *[(c, pa.binary()) for c in ("lang", "words", "sizes", "data", "count", "own")]])
    PATHS = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("shortest", pa.int32()), ("longest", pa.int32()),
                       ("f", pa.int64()), ("whole", pa.bool_())])
    sent = rows.mapInArrow(send, "bucket int, n_runs int, n_words int, langs array<string>, lang binary, words binary,"
                                 " sizes binary, data binary, count binary, own binary")
    found = staged(sent.groupBy("bucket").applyInArrow(
        count, "lang string, phrase binary, shortest int, longest int, f long, whole boolean"), "paths")
    found = found.withColumn("phrase", F.col("phrase").cast("string"))
    spread = found.where("not whole").groupBy("lang", "phrase", "longest").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    spread = spread.select("lang", "phrase", F.col("longest").alias("m"), "f", F.lit(True).alias("top"))
    paths = found.where("whole").withColumn("m", F.explode(F.sequence("shortest", "longest")))
    part = F.when(F.col("m") == F.col("longest"), F.col("phrase")).otherwise(_part(F.col("m")))
    counts = paths.select("lang", part.alias("phrase"), "m", "f", (F.col("m") == F.col("longest")).alias("top"))
    return seen.where("level = 0").select("lang", "n"), staged(counts.unionByName(spread), "phrases")


def collocations(docs: DataFrame, least: int = 100, first: int = 2000, lang_col: str = "lang", text_col: str = "text",
                 per_bucket: int = 400_000, flush_bytes: int = 6 << 20) -> DataFrame:
    """Per language the ``first`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``, a null text is empty, repeated rows count each, ties go by the count and then the phrase. Texts
    of any length are cut whole. Tables without words give no rows. Other columns are not read. Exact: words are compared as
    texts, products are decimals of 38 digits; a score beyond 64 bits stops the job.
    """
    n, counts = phrase_counts(docs, least, lang_col, text_col, per_bucket, flush_bytes)
    longer = counts.where("m >= 3")
    inside = [longer.select("lang", part.alias("phrase"), "f") for part in (
        _part(F.col("m") - 1), _part(1 - F.col("m")))]
    left = counts.where("top and m >= 2").join(inside[0].unionByName(inside[1]), ["lang", "phrase", "f"], "left_anti")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumns({"one": _part(F.col("k")),
                             "two": _part(F.col("k") - F.col("m"))})
    look = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(look("one", "l"), ["lang", "one"]).join(look("two", "r"), ["lang", "two"]).join(n, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    ratio = F.call_function("div", wide("f") * wide("n") * F.lit(1000).cast("decimal(4,0)"), wide("l") * wide("r"))
    scored = cuts.withColumn("score", _whole(ratio)).groupBy("lang", "phrase", "f", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    from pyspark.sql import Window

    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("f"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def _part(words: Column | int) -> Column:
    """The first words of the phrase, or, where the number is negative, its last ones."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), words if isinstance(words, Column) else F.lit(words))


def _whole(value: Column) -> Column:
    return F.coalesce(value, F.raise_error("a score does not fit 64 bits").cast("long"))
