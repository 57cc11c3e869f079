"""Mixing to target weights with soft domain membership.

A classifier trained on the labelled table gives every document a posterior over domains. The document's rate, how
often it should be taken, is fitted so that expected token totals per domain meet their targets:

    minimise  1/2 sum_k (A x - t)_k^2 / (m_k T) + ridge/2 * sum_d n_d (x_d - 1)^2   over x >= l,   A[k, d] = n_d p_k(d)

with l_d = 1 for documents labelled good or with their largest posterior on good, so that none of them is lost, and 0 for
others, n_d tokens of document d, T tokens in all and m_k = (A 1)_k those of domain k, so that errors count relative to a
domain's size; steps of 1 / (1 + ridge) are then safe for any posteriors. Accelerated projected gradient in the metric of the token counts
needs one number per domain from each pass over the documents; a document's rate follows from its posterior and those
numbers, so nothing about single documents ever reaches the driver. From where the gradient steps end, Newton steps on the
dual problem, which has one variable per domain, go on to the optimality conditions.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F

from .common import pieces, release, some_labels, staged
from .substring_dedup import Words

DOMAINS = ["good", "poor", "toxic"]
TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}
FOLD = bytes(32 if c in b".,;:!?" else c for c in bytes(range(256)).lower())


def _bytes(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(chars, np.uint8))


BLANKS, SYMBOLS, CAPITALS = _bytes(b" \t\n\x0b\x0c\r"), _bytes(b"#*$%&|<>!"), _bytes(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def domain(quality, toxic):
    """Index of the domain that a label names."""
    return F.when(toxic == 1, 2.0).when(quality == 0, 1.0).when(quality == 1, 0.0)


def key_of(text_col: str):
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


class Features:
    """Of many texts: which hashed words occur in each (``text``, ``word``, without repeats), ``shares`` of symbols, capitals and
    distinct words, and the number of ``tokens`` between blanks."""

    def __init__(self, texts: list[str | None], width: int):
        raw = [(t or "").encode() for t in texts]
        size = np.array([len(t) + 1 for t in raw])
        of = np.repeat(np.arange(len(raw)), size)
        given = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        add = lambda hit: np.bincount(of[hit], minlength=len(raw))
        length = np.maximum(add((given & 0xC0) != 0x80) - 1, 1)
        inside = ~BLANKS[given]
        self.tokens = add(inside & np.concatenate([[True], ~inside[:-1]]))
        words = Words([t.translate(FOLD) for t in raw])
        at = np.arange(len(words.starts) - 1)
        text = np.repeat(np.arange(len(raw)), words.counts)
        h = words.hashes(at, at + 1) if len(at) else np.zeros(0, np.uint64)
        pairs = np.unique(text.astype(np.int64) * width + (h % np.uint64(width)).astype(np.int64))
        self.text, self.word = pairs // width, pairs % width
        distinct = np.bincount(self.text, minlength=len(raw)) / np.maximum(words.counts, 1)
        self.shares = np.stack([10 * add(SYMBOLS[given]) / length, 5 * add(CAPITALS[given]) / length, distinct], axis=1)


def fitted_classifier(train: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (one row per domain) and intercepts from the labelled rows (__label, __text)."""
    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        for batch in batches:
            for part in pieces(batch):
                f = Features(part.column(1).to_pylist(), width)
                lists = np.split(f.word, np.cumsum(np.bincount(f.text, minlength=part.num_rows))[:-1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int32())),
                                                  pa.array(f.shares.tolist(), pa.list_(pa.float64()))], ["__label", "words", "shares"])

    vector = F.udf(lambda words, shares: Vectors.sparse(
        width + 3, [*words, width, width + 1, width + 2], [*[1.0] * len(words), *shares]), VectorUDT())
    rows = train.select("__label", "__text").mapInArrow(look, "__label double, words array<int>, shares array<double>")
    model = LogisticRegression(featuresCol="__features", labelCol="__label", family="multinomial", regParam=0.0001,
                               standardization=False, maxIter=40).fit(rows.select("__label", vector("words", "shares").alias("__features")))
    return model.coefficientMatrix.toArray(), model.interceptVector.toArray()


def posteriors(rows: DataFrame, labels: DataFrame, id_col: str, text_col: str, given: DataFrame | None = None,
               label_rows: int = 10_000, width: int = 1 << 15) -> DataFrame:
    """``rows`` as ``__id``, ``__key`` (digest of the text), ``tokens`` and ``p``, the posterior over DOMAINS.

    The classifier is fitted on at most ``label_rows`` labelled rows of ``given`` (of ``rows`` if there is none), chosen by a hash
    of their ids. A domain without labelled rows gets no weight; with less than two domains in the labels every document is
    wholly of the one that is there, of the first if there is none."""
    known = some_labels(labels, F.max(domain(F.col("quality"), F.col("toxic"))), label_rows)
    train = (rows if given is None else given).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        known, F.col("__id") == F.col("doc_id")).drop("doc_id").dropDuplicates(["__id"])
    train = staged(train, "labelled")
    seen = sorted(int(r["__label"]) for r in train.select("__label").distinct().collect())
    base = rows.select(F.col(id_col).alias("__id"), key_of(text_col).alias("__key"), F.col(text_col).alias("__text"))
    if len(seen) < 2:
        only = (seen or [0])[0]
        weights, bias = np.zeros((len(DOMAINS), width + 3)), np.where(np.arange(len(DOMAINS)) == only, 0.0, -np.inf)
    else:
        weights, bias = fitted_classifier(train, width)
    words, shares = np.ascontiguousarray(weights[:, :width].T), weights[:, width:].T

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        for batch in batches:
            for part in pieces(batch):
                f = Features(part.column(2).to_pylist(), width)
                score = f.shares @ shares + bias
                for k in range(score.shape[1]):
                    score[:, k] += np.bincount(f.text, weights=words[f.word, k], minlength=part.num_rows)
                odds = np.exp(score - score.max(1, keepdims=True))
                p = np.zeros((part.num_rows, len(DOMAINS)))
                p[:, :odds.shape[1]] = odds / odds.sum(1, keepdims=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(f.tokens, pa.int64()),
                                                  pa.array(p.tolist(), pa.list_(pa.float64()))], ["__id", "__key", "tokens", "p"])

    kind = rows.schema[id_col].dataType.simpleString()
    return base.mapInArrow(judge, f"__id {kind}, __key string, tokens long, p array<double>")


def step(x: np.ndarray, y: np.ndarray, p: np.ndarray, pull: np.ndarray, rate: float, ridge: float, momentum: float, least=0.0):
    """One accelerated projected-gradient step from the point y; x is the point before."""
    new = np.maximum(least, y - rate * (p @ pull + ridge * (y - 1)))
    return new, new + momentum * (new - x)


def replay(p: np.ndarray, pulls: list[np.ndarray], rate: float, ridge: float, least=0.0) -> tuple[np.ndarray, np.ndarray]:
    """Rates and look-ahead points of documents with posteriors p after all ``pulls``."""
    x = y = np.ones(len(p))
    for k, pull in enumerate(pulls):
        x, y = step(x, y, p, pull, rate, ridge, k / (k + 3), least)
    return x, y


def best_rates(p: np.ndarray, dual: np.ndarray, ridge: float, least=0.0) -> np.ndarray:
    """The rates that are optimal when a token of domain k costs dual_k."""
    return np.maximum(least, 1 - p @ dual / ridge)


def newton(soft: DataFrame, dual: np.ndarray, goal: np.ndarray, share: np.ndarray, total: int, ridge: float,
           tolerance: float, rounds: int = 100) -> np.ndarray:
    """The costs per domain at the optimum, by damped Newton steps on the dual problem from ``dual``. One pass over the
    documents weighs all lengths of a step that are tried."""
    size, lengths = len(DOMAINS), 0.5 ** np.arange(12)
    width = 1 + size + size * size

    def look(tried: np.ndarray) -> np.ndarray:
        def add(batches: Iterator) -> Iterator:
            import pyarrow as pa

            part = np.zeros((len(tried), width))
            for batch in batches:
                n, p, least = batch.column(0).to_numpy() / total, _matrix(batch.column(1)), batch.column(2).to_numpy()
                for k, at in enumerate(tried):
                    x = best_rates(p, at, ridge, least)
                    bent = (p * (n * (x > least))[:, None]).T @ p / ridge
                    part[k] += np.concatenate([[n @ (ridge / 2 * (x - 1) ** 2 + (p @ at) * x)], (n * x) @ p, bent.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(part.size, dtype=np.int32)), pa.array(part.ravel())], ["k", "v"])

        got = soft.select("tokens", "p", "least").mapInArrow(add, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(len(tried) * width)
        out[[r["k"] for r in got]] = [r["v"] for r in got]
        return out.reshape(len(tried), width)

    tried = np.array([dual])
    for _ in range(rounds):
        seen = look(tried)
        values = [share @ at ** 2 / 2 + goal @ at - v[0] for at, v in zip(tried, seen)]
        k = int(np.argmin(values))
        dual, now, bent = tried[k], seen[k, 1:1 + size], seen[k, 1 + size:].reshape(size, size)
        slope = np.where(share > 0, share * dual + goal - now, 0.0)
        if (np.abs(slope) <= tolerance * goal).all():
            missed = np.where(share > 0, now / np.maximum(goal, 1e-12) - 1, 0.0)
            if np.abs(missed).max() > 0.01:
                logging.getLogger(__name__).warning("targets not met: expected tokens are off by %s of the target", {
                    d: round(float(v), 4) for d, v in zip(DOMAINS, missed)})
            return dual
        move = np.linalg.solve(bent + np.diag(np.where(share > 0, share, 1.0)), -slope)
        tried = dual + np.concatenate([lengths, [0.0]])[:, None] * move
    raise RuntimeError(f"rates not settled: tokens per domain {now.tolist()}, targets {goal.tolist()}, slope {slope.tolist()}")


def fit_rates(soft: DataFrame, targets: dict[str, float], epochs: float, ridge: float = 0.001, rounds: int = 30,
              tolerance: float = 1e-4) -> DataFrame:
    """``soft`` (stored; tokens, p, ...) with ``rate``, which is at least ``least`` if there is such a column.

    The rates are optimal for targets that differ by at most ``tolerance`` from the given ones, relative to them; a fit that
    does not get there raises an error. ``rounds`` gradient steps at most come near, Newton steps do the rest. What the
    posteriors do not allow to be met is logged as a warning."""
    soft = soft if "least" in soft.columns else soft.withColumn("least", F.lit(0.0))
    total = soft.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return soft.withColumn("rate", F.lit(1.0))
    weights = np.array([targets[d] for d in DOMAINS])
    goal = epochs * weights / weights.sum()
    rate, pulls, share = 1.0 / (1.0 + ridge), [], None

    def sums(given: list[np.ndarray]) -> np.ndarray:
        def add(batches: Iterator) -> Iterator:
            import pyarrow as pa

            part = np.zeros(len(DOMAINS))
            for batch in batches:
                n, p = batch.column(0).to_numpy(), _matrix(batch.column(1))
                part += (n * replay(p, given, rate, ridge, batch.column(2).to_numpy())[1]) @ p
            yield pa.RecordBatch.from_arrays([pa.array([float(v)]) for v in part], [f"s{k}" for k in range(len(DOMAINS))])

        schema = ", ".join(f"s{k} double" for k in range(len(DOMAINS)))
        row = soft.select("tokens", "p", "least").mapInArrow(add, schema).agg(*[F.sum(f"s{k}") for k in range(len(DOMAINS))]).first()
        return np.array(row, float) / total

    pull = np.zeros(len(DOMAINS))
    for _ in range(rounds):
        now = sums(pulls)
        share = now if share is None else share
        pull = np.where(share > 0, (now - goal) / np.maximum(share, 1e-12), 0.0)
        if (np.abs(now - goal)[share > 0] < tolerance * goal[share > 0]).all():
            break
        pulls.append(pull)
    share = sums([]) if share is None else share
    dual = newton(soft, pull, goal, share, total, ridge, tolerance)
    names = [f.name for f in soft.schema.fields]

    def rates(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = best_rates(_matrix(batch.column("p")), dual, ridge, batch.column("least").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(x)], [*names, "rate"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in soft.schema.fields)
    return soft.mapInArrow(rates, f"{kinds}, rate double")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(DOMAINS)) if len(column) else np.zeros((0, len(DOMAINS)))


def mix_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, epochs: float = 1.1,
              id_col: str = "doc_id", text_col: str = "text", given: DataFrame | None = None) -> DataFrame:
    """One row per document: ``__id``, ``__key`` (digest of its text), tokens, p, rate, copies.

    Documents labelled good, or with their largest posterior on good, have a rate of 1 or more. ``copies`` is the rate rounded up or down by a hash of the id, so that its mean is the rate. ``epochs`` is the wanted
    token total as a multiple of the given one. Null and empty texts have no tokens and weigh nothing in the fit; they get
    the rate of their posterior. Null ids and repeated rows are fitted like others; labels without a usable value or of
    unknown documents are left out, of several labels of an id the worst counts. Rows repeated with id and text have equal copies.
    No documents give no rows. Other columns are not read. ``given``: the table whose labelled rows the classifier is fitted on,
    where ``docs`` is what earlier stages have left of it.
    """
    soft = staged(posteriors(docs.select(id_col, text_col), labels, id_col, text_col, given), "posteriors")
    # ids of all labelled good documents, not only of those the classifier is fitted on; no text moves
    worst = F.max(domain(F.col("quality"), F.col("toxic")))
    clean = labels.where("doc_id is not null").groupBy("doc_id").agg(worst.alias("__label")).where("__label = 0").withColumn("__clean", F.lit(True))
    favoured = (F.get("p", F.lit(0)) >= F.get("p", F.lit(1))) & (F.get("p", F.lit(0)) >= F.get("p", F.lit(2)))
    soft = staged(soft.join(clean, F.col("__id") == F.col("doc_id"), "left").withColumn(
        "least", F.when(favoured | F.col("__clean"), 1.0).otherwise(0.0)).drop("doc_id", "__label", "__clean"), "bounded")
    fitted = fit_rates(soft, targets or TARGETS, epochs)
    unit = F.pmod(F.xxhash64("__id", "__key"), F.lit(1 << 40)) / float(1 << 40)
    return fitted.drop("least").withColumn("copies", F.floor(F.col("rate") + unit).cast("long"))


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every document as many times as its copies."""
    rates = mix_rates(docs, labels, id_col=id_col, text_col=text_col, **options)
    taken = rates.where("copies > 0").groupBy(F.col("__key").alias("__k"), F.col("__id").alias("__i")).agg(F.max("copies").alias("__copies"))
    rows = docs.withColumn("__key", key_of(text_col))
    return rows.join(taken, (F.col("__key") == F.col("__k")) & F.col(id_col).eqNullSafe(F.col("__i"))).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)
