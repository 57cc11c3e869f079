"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import exact_dedup, near_dedup, substring_dedup

from .tables import DOCS, frame, odd_rows, prose


def _spaces(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text)


def test_exact_matches_brute_force(spark):
    rows = odd_rows()
    got = exact_dedup.exact_dedup(frame(spark, rows), per_bucket=10)
    assert {"keep_id", "copies", "bucket"} <= set(got.columns)  # the input's own columns are left alone
    by = defaultdict(list)
    for i, t in rows:
        by[_spaces(t or "")].append(i)
    out = got.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "__keep_id", "__group_size", "__kept", "__sha").collect()
    assert len(out) == len(rows)
    for r in out:
        ids = by[_spaces(r["text"])]
        assert r["__keep_id"] == min((i for i in ids if i is not None), default=None)
        assert r["__group_size"] == len(ids)
        assert r["__sha"] == hashlib.sha256(_spaces(r["text"]).encode()).hexdigest()
    kept = Counter(_spaces(r["text"]) for r in out if r["__kept"])
    assert kept == Counter(set(by))


def test_ids_stay_whole_beside_null_ids(spark):
    """Ids that floating point can't hold, next to rows without an id, in few buckets."""
    rows = [((1 << 53) + 1 + 2 * k, prose(k % 40, 20)) for k in range(120)] + [(None, prose(30 + k, 20)) for k in range(20)]
    expected = {}
    for i, t in rows:
        ids = expected.setdefault(t, [])
        ids += [i] if i is not None else []
    for big in (1, 100_000):
        out = exact_dedup.exact_dedup(frame(spark, rows), big=big).collect()
        assert len(out) == len(rows)
        assert {r["text"]: r["__keep_id"] for r in out} == {t: min(v, default=None) for t, v in expected.items()}
        assert Counter(r["text"] for r in out if r["__kept"]) == Counter(set(expected))
    left = exact_dedup.drop_duplicates(frame(spark, [r for r in rows if r[0]] + [(None, prose(50, 20))]))
    assert left.columns == frame(spark, rows).columns
    assert Counter(r["text"] for r in left.collect()) == Counter(set(expected) - {prose(k, 20) for k in range(40, 50)} | {prose(50, 20)})


def test_dropping_duplicates_agrees_with_the_flags(spark):
    for rows in (odd_rows(), list({i: (i, t) for i, t in odd_rows()}.values())):
        flagged = Counter((r["doc_id"], r["text"]) for r in exact_dedup.exact_dedup(frame(spark, rows)).collect() if r["__kept"])
        got = Counter((r["doc_id"], r["text"]) for r in exact_dedup.drop_duplicates(frame(spark, rows)).collect())
        assert {_spaces(t or "") for _, t in got} == {_spaces(t or "") for _, t in flagged}
        assert len(got) == len(flagged) and sum(got.values()) == len(got)


def test_fuse_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(-(1 << 62), 1 << 62, n)
        built = exact_dedup.FuseFilter.build(np.concatenate([keys, keys[:1]]))
        assert built.contains(keys).all()
        assert built.contains(rng.integers(-(1 << 62), 1 << 62, 50_000)).mean() < 0.002
        if n >= 1000:
            assert len(built.cells) < 1.6 * n


@pytest.mark.parametrize("run", [
    lambda d: exact_dedup.exact_dedup(d), lambda d: near_dedup.near_duplicates(d), lambda d: substring_dedup.remove_repeats(d),
    lambda d: near_dedup.drop_near_duplicates(d)])
def test_no_documents(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def similarity(a: Counter, b: Counter) -> float:
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def shingles(text):
    w = (text or "").lower().encode().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def edited(text, seed, edits):
    r = random.Random(seed)
    w = text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"new{seed}x{r.randrange(1000)}"
    return " ".join(w)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(1, 1 << 62, 400).astype(np.uint64))
    for swap in (10, 60, 150):
        other = np.sort(np.concatenate([base[swap:], rng.integers(1, 1 << 62, swap).astype(np.uint64)]))
        x, y = rng.integers(1, 4, len(base)), rng.integers(1, 4, len(other))
        want = similarity(Counter(dict(zip(base.tolist(), x.tolist()))), Counter(dict(zip(other.tolist(), y.tolist()))))
        assert near_dedup.probability_jaccard(base, x, other, y) == pytest.approx(want, abs=1e-9)
        text = np.concatenate([np.zeros(len(base), int), np.ones(len(other), int)])
        signs = near_dedup.signatures(2, text, np.concatenate([base, other]), np.concatenate([x, y]), registers=2000)
        assert (signs[0] == signs[1]).mean() == pytest.approx(want, abs=0.05)


def test_near_classes_match_all_pairs(spark):
    base = [prose(100 + k, 150) for k in range(6)]
    rows = [(k, b) for k, b in enumerate(base)]
    rows += [(100 + 40 * k + j, edited(base[k], j, 1 + j % 9)) for k in range(3) for j in range(40)]  # groups of unlike nearness
    rows += [(500 + j, base[0]) for j in range(20)] + odd_rows()  # some ids stand for two texts
    docs = frame(spark, rows)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        key = b" ".join((t or "").lower().encode().split())
        if key:
            texts.setdefault(key, []).append(i)
    keys = list(texts)
    sets = [shingles(k.decode()) for k in keys]
    top = {k: k for k in range(len(keys))}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(keys)):
        for b in range(a):
            if sets[a].keys() & sets[b].keys() and len(sets[a]) < 2000 and similarity(sets[a], sets[b]) >= 0.8:
                top[find(a)] = find(b)
    want = defaultdict(set)
    for k in range(len(keys)):
        want[find(k)] |= {i for i in texts[keys[k]] if i is not None}
    found = defaultdict(set)
    for r in got:
        found[r["class_id"]].add(r["__id"])
    clear = {i for i, n in Counter(i for i, _ in set(rows)).items() if n == 1}  # ids that stand for one text
    for ids in want.values():
        if ids and ids <= clear:
            assert ids <= found[min(ids)] and not (found[min(ids)] - ids) & clear
    classes = len(want) + sum(1 for i, t in rows if not (t or "").split())
    assert sum(r["kept"] for r in got) == classes
    left = near_dedup.drop_near_duplicates(docs)
    assert left.count() == classes and left.columns == docs.columns


def brute_windows(rows, width=50):
    far = 1 << 63
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, far), far - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < (far - 1 if i is None else i):
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_substrings_match_brute_force(spark):
    passage = prose(77, 70)
    rows = odd_rows() + [(200 + k, prose(300 + k, 20) + " " + passage + "\n" + prose(400 + k, 20)) for k in range(25)]
    rows += [(300, "a " * 200), (301, "a " * 120), (302, passage + " " + passage), (None, passage)]
    got = substring_dedup.remove_repeats(frame(spark, rows), flush_bytes=3000, bucket_bytes=2000).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["__id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=key) == sorted(
        brute_windows(rows), key=key)
    for r in got:
        assert sum(s["end"] - s["first"] for s in r["intervals"]) == r["n_removed"]


def test_signing_takes_little_memory_at_once():
    """A worker signs a large batch part by part."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 400)) for _ in range(1800)]
    assert sum(map(len, texts)) > 4_000_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "words"])
    tracemalloc.start()
    rows = 0
    for part, words in near_dedup._chunks([batch]):
        rows += len(near_dedup.signatures(len(words), *near_dedup.weighted_shingles(words)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 100 << 20


def test_signing_frees_what_other_steps_left_in_the_worker(spark):
    """Token caches of a step before do not stay beside the signatures."""
    from txnwatch.llm import common

    def step(kind):
        def run(batches):
            import pyarrow as pa

            if kind == "fill":
                common.token_cache(path)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([common.token_cache.cache_info().currsize] * batch.num_rows, pa.int64())], ["n"])
        return run

    path, one = common.tokenizer(), spark.range(0, 4, 1, 1)  # one task at a time: Spark takes the idle worker again
    assert one.mapInArrow(step("fill"), "n long").first()[0] == 1
    texts = one.select(F.col("id").alias("__id"), F.lit("c").alias("copy"), F.lit("some words of a text that is long").alias("words"))
    assert near_dedup.signed_texts(texts).count() == 4
    assert {r["n"] for r in one.mapInArrow(step("look"), "n long").collect()} == {0}


def test_hashing_words_takes_memory_by_word():
    """Windows of many texts cost some bytes for each byte of text, not some numbers of eight bytes."""
    import tracemalloc

    texts = [(prose(1, 20000) + f" end{k}").encode() for k in range(20)]
    words = [t.split(b" ") for t in texts]
    tracemalloc.start()
    _, text, h = substring_dedup.Words(texts).windows(50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * sum(map(len, texts))
    windows = [b" ".join(w[k:k + 50]) for w in words for k in range(len(w) - 49)]
    assert len(h) == len(windows) and len(set(h.tolist())) == len(set(windows)) == len(set(zip(h.tolist(), windows)))


def test_many_texts_of_one_bucket_are_taken_in_parts(spark):
    """Rows without an id meet in one task, which works on about a megabyte of them at a time."""
    tails = [" ".join(f"u{k}x{j}" for j in range(5000)) for k in range(60)]
    assert sum(map(len, tails)) > 2 << 20
    passage = prose(1, 60)
    got = substring_dedup.remove_repeats(frame(spark, [(1, passage), *((None, f"{passage} {t}") for t in tails)])).collect()
    assert sorted((r["__id"] or 0, r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == sorted(
        [(1, 60, 0, passage), *((0, 5060, 60, t) for t in tails)])


def test_signing_bounds_rows_as_well_as_bytes():
    """Signatures of very short texts take far more memory than the texts."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(9000)), pa.array([f"w{k}" for k in range(8999)] + [None])], ["id", "words"])
    parts = list(near_dedup._chunks([batch, batch.slice(0, 0)]))
    assert [t for _, words in parts for t in words] == batch.column(1).to_pylist()
    assert max(part.num_rows for part, _ in parts) <= 2048


def test_mixing_frees_what_other_steps_left_in_the_worker(spark):
    """Token caches of a step before do not stay beside the features of the classifier."""
    from txnwatch.llm import common, source_mixing

    def step(kind):
        def run(batches):
            import pyarrow as pa

            if kind == "fill":
                common.token_cache(path)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([common.token_cache.cache_info().currsize] * batch.num_rows, pa.int64())], ["n"])
        return run

    path, one = common.tokenizer(), spark.range(0, 4, 1, 1)  # one task at a time: Spark takes the idle worker again
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = one.select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    soft = source_mixing.posteriors(docs, labels, "doc_id", "text")
    assert {r["n"] for r in one.mapInArrow(step("fill"), "n long").collect()} == {1}
    assert soft.count() == 4
    assert {r["n"] for r in one.mapInArrow(step("look"), "n long").collect()} == {0}
