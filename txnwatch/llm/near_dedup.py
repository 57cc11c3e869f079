"""Near-duplicate classes by ProbMinHash.

A document is the set of its five-word shingles, each weighted by how often it occurs; the similarity of two documents
is the probability Jaccard similarity of their weights (plain Jaccard where no shingle repeats). In a signature every
shingle is a Poisson process whose rate is its weight: each arrival falls in a random register, a register keeps the
shingle of its first arrival, and a process stops once its next arrival is later than what all registers hold. Two
registers agree with the probability that is the similarity.

Bands of registers are bucket keys. Exact copies count as one text. In each bucket one text meets all others, pairs are
screened by their signatures and then verified on all their shingles, and links are merged into classes; this is done
three times. A bucket is settled when its texts are of one class. What is left, texts near to each other but not near
enough, is compared in tiles: a task takes two tiles of a group, screens and verifies inside, and gives out only links
that join classes. So all pairs that share a bucket are settled and no list of pairs is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import normal, pieces, release, slots, staged
from .substring_dedup import Words

REGISTERS, ROWS = 140, 5
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted_shingles(texts: list[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and number of occurrences of each distinct shingle, by text and hash."""
    words = Words([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    _, text, h = words.windows(width, short=True)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    lead = np.ones(len(h), bool)
    lead[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(lead)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(n: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures of n texts, one row each; zeros for a text without shingles."""
    best = np.full((n, registers), np.inf)
    sign = np.zeros((n, registers), np.uint64)
    best_flat, sign_flat = best.ravel(), sign.ravel()
    time, state, rate = np.zeros(len(text)), shingle.copy(), weight.astype(float)
    where, worst, step = text.astype(np.int64), np.full(n, np.inf), 0
    name = shingle
    while len(where):
        step += 1
        state = state + GOLDEN
        r = _mix(state)
        u = ((r >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
        time = time - np.log(u) / rate
        slot = where * registers + (_mix(r ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best_flat, slot, time)
        won = best_flat[slot] == time
        sign_flat[slot[won]] = name[won]
        if step <= 4 or step % 8 == 0:
            open_ = np.unique(where) if step > 4 else np.arange(n)
            worst[open_] = best[open_].max(axis=1)
        live = time <= worst[where]
        if not live.all():
            where, time, state, rate, name = where[live], time[live], state[live], rate[live], name[live]
    return sign


def band_keys(sign: np.ndarray, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((sign.shape[0], sign.shape[1] // rows), np.uint64)
    for r in range(rows):
        keys = _mix((keys ^ sign[:, r::rows]) + GOLDEN)
    return _mix(keys + np.arange(1, keys.shape[1] + 1, dtype=np.uint64) * GOLDEN)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Of two sets of shingles (sorted hashes a, b) with weights x, y: the sum over common shingles i of
    1 / sum over all j of max(x_j / x_i, y_j / y_i)."""
    _, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    if len(a) == x.sum() and len(b) == y.sum():  # nothing repeats
        return len(ia) / (len(a) + len(b) - len(ia))
    x, y = x.astype(float), y.astype(float)
    cx, cy = x[ia], y[ib]
    only_x, only_y = x.sum() - cx.sum(), y.sum() - cy.sum()
    ratio, n = np.unique(np.column_stack([cx, cy]), axis=0, return_counts=True)
    each = [px / (only_x + p / q * only_y + np.maximum(cx, p / q * cy).sum()) for px, p, q in zip(ratio[:, 0], ratio[:, 0], ratio[:, 1])]
    return float(np.dot(each, n))


def _chunks(batches: Iterator, size: int = 1 << 19, rows: int = 2048) -> Iterator:
    """Parts of record batches with about ``size`` bytes of text in their last column and at most so many rows. Signing takes
    some hundred bytes of memory for each byte of text, and some thousand for each row."""
    for batch in batches:
        for piece in pieces(batch, size):
            for lo in range(0, piece.num_rows, rows):
                part = piece.slice(lo, rows)
                yield part, part.column(part.num_columns - 1).to_pylist()


def worded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, copy (digest of the lower-cased words, null without words) and those words."""
    words = F.trim(F.lower(normal(F.col(text_col))))
    return docs.select(F.col(id_col).cast("long").alias("__id"), words.alias("words")).select(
        "__id", F.when(F.col("words") != "", F.md5("words")).alias("copy"), "words")


def signed_texts(rows: DataFrame, width: int = 5) -> DataFrame:
    """``rows``: __id, copy, words. Per row: the signature in 16 bits a register, and band keys."""
    def sign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        for batch, texts in _chunks(batches):
            full = signatures(len(texts), *weighted_shingles(texts, width))
            short = (_mix(full) & np.uint64(0xFFFF)).astype("<u2")
            bands = band_keys(full).view(np.int64)
            offsets = pa.array(np.arange(len(texts) + 1) * bands.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s.tobytes() for s in short], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(bands.ravel(), pa.int64()))], ["id", "copy", "sign", "bands"])

    return rows.mapInArrow(sign, "id long, copy string, sign binary, bands array<long>")


def shingle_sets(rows: DataFrame, width: int = 5) -> DataFrame:
    """``rows``: node, words. The sorted shingle hashes and their counts as binaries."""
    def collect(batches: Iterator) -> Iterator:
        import pyarrow as pa

        release()
        for batch, texts in _chunks(batches):
            text, h, n = weighted_shingles(texts, width)
            cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                 pa.array([n[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                ["node", "hashes", "counts"])

    return rows.mapInArrow(collect, "node long, hashes binary, counts binary")


def verified(pairs: DataFrame, signs: DataFrame, sets: DataFrame, threshold: float, slack: float) -> DataFrame:
    """The ``pairs`` (a, b) whose similarity is at least ``threshold``. Pairs whose signatures agree in a share of registers
    more than ``slack`` below it are not looked at further."""
    def screen(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            left, right = ([np.frombuffer(v.as_buffer(), "<u2") for v in batch.column(c)] for c in (2, 3))
            near = [float((x == y).mean()) >= threshold - slack for x, y in zip(left, right)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            c = [[np.frombuffer(v.as_buffer(), np.uint64 if k % 2 == 0 else np.uint32) for v in batch.column(k + 2)] for k in range(4)]
            same = [probability_jaccard(*row) >= threshold - 1e-9 for row in zip(*c)]
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    side = lambda df, k, cols: df.select(F.col("node").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in cols])
    near = pairs.join(side(signs, "a", ["sign"]), "a").join(side(signs, "b", ["sign"]), "b").select(
        "a", "b", "sign_a", "sign_b").mapInArrow(screen, "a long, b long")
    full = near.join(side(sets, "a", ["hashes", "counts"]), "a").join(side(sets, "b", ["hashes", "counts"]), "b")
    return full.select("a", "b", "hashes_a", "counts_a", "hashes_b", "counts_b").mapInArrow(measure, "a long, b long")


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the classes that ``links`` (a, b) join are one; a label is one of its class's nodes."""
    name = lambda df, k: df.select(F.col("node").alias(k), F.col("label").alias(f"l{k}"))
    edges = links.join(name(labels, "a"), "a").join(name(labels, "b"), "b").where("la != lb").select("la", "lb")
    edges = staged(edges.union(edges.select("lb", "la")).distinct(), "edges")
    roots = staged(edges.groupBy(F.col("la").alias("u")).agg(F.least(F.min("lb"), F.first("la")).alias("l")), "roots")
    while True:
        near = edges.join(roots.select(F.col("u").alias("lb"), "l"), "lb").groupBy(F.col("la").alias("u")).agg(F.min("l").alias("m"))
        low = roots.join(near, "u").select("u", F.least("l", "m").alias("l"), F.col("l").alias("old"))
        # a root follows its own root at once, so chains halve
        jump = low.select(F.col("u").alias("l"), F.col("l").alias("up"))
        after = staged(low.join(jump, "l", "left").select("u", F.least(F.coalesce("up", "l"), "l").alias("l"), "old"), "roots")
        changed = after.where("l != old").limit(1).count()
        roots = after.select("u", "l")
        if not changed:
            return staged(labels.join(roots.withColumnRenamed("u", "label"), "label", "left").select(
                "node", F.coalesce("l", "label").alias("label")), "labels")


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """``keyed`` (key, node) as buckets of at least two texts, buckets of the same texts as one: key, node, degree (how many
    others the text meets in all buckets; the source of a group of near copies meets most)."""
    # sums of two hashes, whole ones, as decimals: different buckets agree in both with a probability of 2^-128
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    full = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), total(F.xxhash64("node")).alias("all"),
                                    total(F.xxhash64("node", F.lit("second"))).alias("other")).where("n > 1")
    one = full.groupBy("n", "all", "other").agg(F.min("key").alias("key"), (F.count(F.lit(1)) * (F.col("n") - 1)).alias("meets"))
    held = staged(keyed.join(one.select("key", "meets"), "key"), "shared")
    degrees = held.groupBy("node").agg(F.sum("meets").alias("degree"))
    return staged(held.select("key", "node").join(degrees, "node"), "buckets")


def tiled_links(members: DataFrame, signs: DataFrame, sets: DataFrame, threshold: float, slack: float, tile: int = 512) -> DataFrame:
    """Links (a, b) that join the classes of each group, for ``members`` (grp, node, label).

    A group is cut into tiles and every pair of tiles is one task's work: signatures screen, all shingles decide, and only
    links between classes that the task has not joined yet leave it, so at most one per text."""
    def compare(group):
        import pyarrow as pa

        node, label, side = (group.column(c).to_numpy() for c in ("node", "label", "side"))
        sign = np.vstack([np.frombuffer(v.as_buffer(), "<u2") for v in group.column("sign")])
        hashes = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("hashes")]
        counts = [np.frombuffer(v.as_buffer(), np.uint32) for v in group.column("counts")]
        first, second, found = group.column("i")[0].as_py(), group.column("j")[0].as_py(), []
        root = {int(x): int(x) for x in label}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        right = np.flatnonzero(side == second)
        for a in np.flatnonzero(side == first):
            others = right[(label[right] != label[a]) & (right > a if first == second else True)]
            near = (sign[others] == sign[a]).mean(axis=1)
            for k in np.flatnonzero(near >= threshold - slack):
                b = others[k]
                x, y = find(int(label[a])), find(int(label[b]))
                if x != y and probability_jaccard(hashes[a], counts[a], hashes[b], counts[b]) >= threshold - 1e-9:
                    root[x] = y
                    found.append((int(node[a]), int(node[b])))
        columns = list(zip(*found)) if found else [[], []]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("k")).where("k > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    dealt = members.join(sizes.select("grp", tiles.alias("tiles")), "grp").withColumn("side", own).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("grp", "node", "label", "side", F.least("side", "with").alias("i"), F.greatest("side", "with").alias("j"))
    # small rows but much work: as many tasks as the session has partitions
    full = dealt.join(signs, "node").join(sets, "node").repartition(slots(members.sparkSession), "grp", "i", "j")
    return full.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
                    slack: float = 0.15) -> DataFrame:
    """One row per document: ``__id``, copy (digest of its words), class_id (least id of its class), copy_id (least id with the same words),
    n_copies, ``kept`` (true for one row of each class).

    Words are lower-cased; a text of fewer than ``width`` words is one shingle of all its words. Texts without words,
    null ones too, are like no other: each is kept, as a class of its own. Ids are whole numbers; a row without an id
    joins a class like others and is kept only where no row of the class has an id. Of rows repeated with id and words
    one is kept. An id may stand for several texts. No documents give no rows. Other columns are not read.
    """
    rows = worded(docs, id_col, text_col)
    signed = staged(signed_texts(rows, width).withColumn("uid", F.monotonically_increasing_id()), "signed")
    texts = signed.where("copy is not null").groupBy("copy").agg(
        F.count(F.lit(1)).alias("n_copies"), F.first("sign").alias("sign"), F.first("bands").alias("bands"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first"))
    texts = staged(texts.withColumn("node", F.col("first.uid")), "texts")  # ids may be null or stand for several texts

    buckets = shared_buckets(texts.select(F.explode("bands").alias("key"), "node"))
    members = staged(buckets.select("node").distinct(), "members")
    labels = staged(members.select("node", F.col("node").alias("label")), "labels")
    signs = staged(texts.join(members, "node").select("node", "sign"), "signs")
    # from the texts again: of each member one row, found by id and words
    wanted = texts.join(members, "node", "left_semi").select(F.col("copy").alias("c"), F.col("first.id").alias("i"), "node")
    again = rows.join(wanted, (F.col("copy") == F.col("c")) & F.col("__id").eqNullSafe(F.col("i"))).select("node", "words")
    sets = staged(shingle_sets(again.dropDuplicates(["node"]), width), "sets")

    buckets = buckets.withColumn("hub", F.lit(None).cast("long"))
    for turn in range(3):
        held = buckets.join(labels, "node")
        best = F.max(F.struct("degree", "node"))
        sizes = held.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))
        # outside: texts of all classes of the bucket but the largest
        top = sizes.groupBy("key").agg(F.max(F.struct("n", "best", "label")).alias("top"), F.max("best").alias("best"),
                                       F.count(F.lit(1)).alias("k")).where("k > 1")
        top = top.select("key", F.col("top.label").alias("main"), F.col("best.node").alias("first"))
        out = sizes.join(top.select("key", "main"), "key").where("label != main").groupBy("key").agg(F.max("best").alias("out"))
        held = held.join(top, "key").join(out.select("key", F.col("out.node").alias("out")), "key")
        held = staged(held.withColumn("hub", F.coalesce("hub", "first")), "open")
        if not held.limit(1).count():
            break
        # the text of the bucket that meets most meets all its others, then twice the one outside that does
        chosen = F.col("node") == F.col("first" if turn == 0 else "out")
        meets = held.where(chosen).select("key", F.col("node").alias("x"), F.col("label").alias("lx"))
        pairs = held.select("key", "node", "label").join(meets, "key").where("label != lx").select(
            F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b")).distinct()
        links = staged(verified(staged(pairs, "pairs"), signs, sets, threshold, slack), "links")
        labels = merge(labels, links)
        # who has met all others of a bucket leaves it
        buckets = staged(held.where(~chosen).select("key", "node", "degree", "hub"), "buckets")

    # what is not of one class yet, by the text that met it first: one group instead of a bucket for every band
    mixed = buckets.join(labels, "node").groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l != h")
    rest = buckets.join(mixed.select("key"), "key").select(F.col("hub").alias("grp"), "node").distinct().join(labels, "node")
    labels = merge(labels, staged(tiled_links(staged(rest, "rest"), signs, sets, threshold, slack), "links"))

    found = texts.join(labels, "node", "left").select("copy", "n_copies", "first", F.coalesce("label", "node").alias("label"))
    best = found.groupBy("label").agg(F.min("first").alias("best"))
    judged = signed.where("copy is not null").select("uid", "id", "copy").join(found, "copy").join(best, "label").select(
        "id", "copy", F.col("best.id").alias("class_id"), F.col("first.id").alias("copy_id"), "n_copies",
        (F.col("uid") == F.col("best.uid")).alias("kept"))
    empty = signed.where("copy is null").select(
        "id", "copy", F.col("id").alias("class_id"), F.col("id").alias("copy_id"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("kept"))
    return judged.unionByName(empty).withColumnsRenamed({"id": "__id"})


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class left, and all documents without words."""
    found = staged(near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where("copy is not null"), "near")
    words = F.trim(F.lower(normal(F.col(text_col))))
    kept = found.where("kept").select(F.col("copy").alias("__c"), F.col("__id").alias("__i"))
    rows = docs.withColumn("__copy", F.when(words != "", F.md5(words)))
    left = rows.join(kept, (F.col("__copy") == F.col("__c")) & F.col(id_col).eqNullSafe(F.col("__i")), "left_semi")
    if found.groupBy("__id", "copy").count().where("count > 1").limit(1).count():
        left = left.dropDuplicates(["__copy", id_col])
    return left.unionByName(rows.where("__copy is null")).drop("__copy")
