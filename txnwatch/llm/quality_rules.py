"""Quality rules with an isolation forest over rule statistics.

One pass over the texts takes the statistics of every document. Two fixed rules reject at once. The rest is judged by
an isolation forest: trees of random splits in which odd documents reach a leaf after few steps. The forest is grown
from a bounded sample of rows labelled good, so that junk, however common, stays odd, and the threshold on the score is
set on all other labelled rows, counted in Spark: it weighs the bad rows it rejects against the good ones, each of which costs ``price`` bad ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import release, some_labels, staged

# Fixed values of the base rules
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_upper", "n_digits", "n_marks", "n_distinct", "n_top", "n_lines"]
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?.,;:"


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of COUNTS + EXTRA; a null text has none of anything."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    repeated = 0
    if n >= 3:
        _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
        _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        again = count[window] >= 2
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift:n - 2 + shift] |= again
        repeated = int(covered.sum())
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            *(len(raw) - len(raw.translate(None, kind)) for kind in (UPPER, DIGITS, MARKS)),
            len(known), int(np.bincount(ids).max()) if n else 0, len(lines))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``__id``, the counts of COUNTS + EXTRA (long) and ``base_failed`` for every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        for batch in batches:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[] for _ in COUNTS + EXTRA]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                             ["__id", *COUNTS, *EXTRA])

    counted = docs.select(F.col(id_col).alias("__id"), F.col(text_col)).mapInArrow(
        count, f"__id {kind}, " + ", ".join(f"{c} long" for c in COUNTS + EXTRA))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def features(stats: pd.DataFrame) -> np.ndarray:
    """Rule statistics as shares, one row per document. Shares of repetition are damped in short documents, where one
    repeated line is much of the whole."""
    s = stats[COUNTS + EXTRA].astype(float)
    words, chars, lines = s["n_words"].clip(lower=1), s["word_chars"].clip(lower=1), s["n_lines"].clip(lower=1)
    return np.column_stack([
        s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / (lines + 20), s["n_repeat_words"] / (words + 200),
        s["n_upper"] / chars, s["n_digits"] / chars, s["n_marks"] / words, s["n_distinct"] / words ** 0.85, s["n_top"] / words])


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Expected steps of an unsuccessful search in a random tree over n rows."""
    n = np.asarray(n, float)
    long = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class IsolationForest:
    """Trees as flat arrays: split feature (-1 at a leaf), split value, left child (right is next), path length at a leaf."""

    n_trees: int = 200
    sample: int = 256
    seed: int = 11
    widen: float = 0.5
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    scale: float = 1.0

    def fit(self, x: np.ndarray, seen: np.ndarray | None = None) -> "IsolationForest":
        """``seen``: rows of any kind, whose spread tells how far outside of ``x`` a split may lie."""
        rng = np.random.default_rng(self.seed)
        seen = x if seen is None else seen
        self.margin = self.widen * (seen.max(axis=0) - seen.min(axis=0))
        size = min(self.sample, len(x))
        self.scale = float(max(mean_path(size), 1.0))
        self.trees = [self._grow(x[rng.choice(len(x), size, replace=False)], rng) for _ in range(self.n_trees)]
        return self

    def _grow(self, x: np.ndarray, rng) -> tuple:
        feature, value, left, length = [], [], [], []
        limit = 2 * int(np.ceil(np.log2(max(len(x), 2))))

        def add() -> int:
            for a, v in ((feature, -1), (value, 0.0), (left, 0), (length, 0.0)):
                a.append(v)
            return len(feature) - 1

        todo = [(add(), np.arange(len(x)), 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            low, high = low - self.margin, high + self.margin
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(open_):
                length[node] = depth + float(mean_path(len(rows)))
                continue
            k = int(rng.choice(open_))
            at = float(rng.uniform(low[k], high[k]))
            below = x[rows, k] < at
            feature[node], value[node] = k, at
            a = add()
            b = add()
            left[node] = a
            for child, part in ((a, rows[below]), (b, rows[~below])):
                if len(part):
                    todo.append((child, part, depth + 1))
                else:
                    length[child] = depth + 1.0
        return np.array(feature, np.int32), np.array(value), np.array(left, np.int32), np.array(length)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, higher for odder rows."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, length in self.trees:
            node = np.zeros(len(x), np.int32)
            while True:
                k = feature[node]
                inner = k >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(k, 0)] >= value[node]
                node = np.where(inner, left[node] + right, node)
            total += length[node]
        return 2.0 ** (-total / max(len(self.trees), 1) / self.scale)


@dataclass
class QualityModel:
    forest: IsolationForest | None
    threshold: float

    def keep(self, x: np.ndarray) -> np.ndarray:
        if self.forest is None:
            return np.ones(len(x), bool)
        return self.forest.score(x) < self.threshold


def calibrate(scored: DataFrame, price: float, bins: int = 1 << 14) -> float:
    """The threshold with the largest share of bad rows rejected minus ``price`` times the share of good rows rejected,
    half way between the two scores it parts. If no threshold gains anything, one that rejects nothing.

    ``scored`` (stored): score between 0 and 1, good. Exact over all its rows: sums are taken over ranges of scores, and
    within a range over its distinct scores; only sums by range reach the driver."""
    counts = scored.groupBy("score").agg(
        F.count(F.when(F.col("good"), 1)).alias("g"), F.count(F.when(~F.col("good"), 1)).alias("b")).withColumn(
        "bin", F.floor(F.col("score") * bins).cast("int"))
    ranges = counts.groupBy("bin").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    totals = {r["bin"]: (r["g"], r["b"]) for r in ranges.collect()}  # at most bins + 1 rows
    n_good, n_bad = (sum(v[k] for v in totals.values()) for k in (0, 1))
    above, up_good, up_bad = [], 0, 0
    for k in sorted(totals, reverse=True):
        above.append((k, up_good, up_bad))
        up_good, up_bad = up_good + totals[k][0], up_bad + totals[k][1]
    if not above:
        return 2.0
    higher = scored.sparkSession.createDataFrame(above, "bin int, more_g long, more_b long")
    within = Window.partitionBy("bin").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    gain = (F.col("more_b") + F.sum("b").over(within)) / F.lit(max(1, n_bad)) - price * (
        (F.col("more_g") + F.sum("g").over(within)) / F.lit(max(1, n_good)))
    best = counts.join(F.broadcast(higher), "bin").select(F.struct(gain.alias("gain"), "score").alias("x")).agg(F.max("x")).first()[0]
    if best["gain"] <= 0:
        return 2.0
    below = scored.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return float(best["score"] if below is None else (best["score"] + below) / 2)


def fit(stats: DataFrame, labels: DataFrame, label_rows: int = 20_000, price: float = 20.0) -> QualityModel:
    """Forest and threshold from the labelled rows that pass the base rules (of repeated rows of an id one counts). The
    forest grows from at most ``label_rows`` labelled ids, chosen by a hash of their ids, of which the even half is used;
    all labelled rows that it does not see set the threshold. Without good rows in both nothing but the base rules rejects."""
    passed = stats.where(~F.col("base_failed"))
    known = some_labels(labels, F.min("quality"), label_rows).where(F.xxhash64("doc_id") % 2 == 0)
    sample = passed.join(F.broadcast(known), F.col("__id") == F.col("doc_id")).withColumn(
        "__h", F.xxhash64("__id")).dropDuplicates(["__id"]).toPandas().sort_values(["__h", "__id"])
    good = (sample["__label"] == 1).to_numpy(bool)
    if not good.any():
        return QualityModel(None, 1.0)
    x = features(sample)
    forest = IsolationForest().fit(x[good], x)
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"score": shared.value.score(features(batch)), "good": batch["__label"] == 1})

    every = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__label")).where("__label is not null")
    rest = passed.join(every.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti"), F.col("__id") == F.col("doc_id"))
    scored = staged(rest.dropDuplicates(["__id"]).select(*COUNTS, *EXTRA, "__label").mapInPandas(score, "score double, good boolean"), "scores")
    if not scored.where("good").head(1):
        return QualityModel(None, 1.0)
    return QualityModel(forest, calibrate(scored, price))


def judge(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``stats`` with ``kept``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # trees x 2 x sample nodes, whatever the size of the data

    def verdicts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["kept"] = ~batch["base_failed"].to_numpy(bool) & shared.value.keep(features(batch))
            yield batch

    kind = stats.schema["__id"].dataType.simpleString()
    return stats.mapInPandas(verdicts, f"__id {kind}, " + ", ".join(f"{c} long" for c in COUNTS + EXTRA)
                             + ", base_failed boolean, kept boolean")


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_rows: int = 20_000, price: float = 20.0) -> DataFrame:
    """One row per document: ``__id``, its counts, base_failed and kept.

    Null and empty texts have no words and fail the base rules. Null ids are judged like others, and repeated rows each
    get the verdict of their text. Labels without id or quality are left out; of several labels of one id the lowest
    counts. Empty tables give no rows, and without usable labels only the base rules decide. Other columns are not read.
    """
    stats = staged(document_statistics(docs, id_col, text_col), "quality")
    return judge(stats, fit(stats, labels, label_rows, price))


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_rows: int = 20_000,
              price: float = 20.0) -> DataFrame:
    """``docs`` without the documents that ``quality_verdicts`` rejects. The verdict hangs on the text alone, so rows are
    filtered where they are read and no text moves. All labelled rows set the threshold, and they are found among the
    statistics of all documents, which are taken once before."""
    model = fit(staged(document_statistics(docs, id_col, text_col), "quality"), labels, label_rows, price)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        s = pd.DataFrame([statistics(t) for t in texts], columns=COUNTS + EXTRA)
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
        return pd.Series(~failed.to_numpy(bool) & shared.value.keep(features(s)))

    return docs.where(keep(F.col(text_col)))
