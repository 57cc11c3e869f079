"""Whitening, token counts and phrases against plain Python."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from txnwatch.llm import phrases, queries, token_counts, whitening

from .tables import DOCS, frame, odd_rows, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# whitening

def whitened_plainly(vectors):
    """vec -> x and the reference decomposition over distinct vectors."""
    usable = [tuple(int(np.floor(256 * float(e))) for e in v) for v in vectors]
    fit = np.array(sorted(set(usable)))
    values, turn = np.linalg.eigh((fit - fit.mean(0)).T @ (fit - fit.mean(0)) / len(fit))
    return usable, fit, values[::-1], turn[:, ::-1]


def check_whitening(rows, found, top):
    usable, fit, values, turn = whitened_plainly([v for _, v in rows])
    n, sums = len(fit), fit.sum(0)
    assert len(found) == top * len(rows)
    by = {}
    for r in found:
        by.setdefault((r["__id"], r["component"]), []).append(r)
    signs = {}
    for (i, _), x in zip(rows, usable):
        for k in range(top):
            r = by[i, k + 1].pop()
            assert r["n"] == n
            assert r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9
            want = (np.array(x) - sums / n) @ turn[:, k] / np.sqrt(values[k])
            sign = signs.setdefault(k, 1 if want * r["whitened"] >= 0 else -1) if abs(want) > 1e-6 else signs.get(k, 1)
            assert r["whitened"] == pytest.approx(sign * want, abs=1e-7)


def test_whitening_matches_a_direct_decomposition(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=9) * np.arange(1, 10)).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # one vector in a third of all rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    check_whitening(rows, whitening.whiten(df).collect(), 4)


def test_odd_vectors(spark):
    kind = "vec_id long, embedding array<float>, x string, n string, component string, part string"
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(30)] + [(50, [0.5, 0.25, -0.5])] * 2 + [(None, [0.0, -0.0, 1.0])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 0.0, 0.0]), (94, [float("inf"), 0.0, 0.0]), (95, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in good + bad], kind).repartition(5)
    check_whitening(good, whitening.whiten(df).collect(), 3)
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 for r in same)
    for rows in ([], [(1, None)]):
        empty = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert empty.count() == 0 and "whitened" in empty.columns


def test_large_entries_stay_exact(spark):
    big = 2.0 ** 27
    rows = [(0, [big, 1.0]), (1, [-big + 1, 0.0]), (2, [0.0, 3.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1).collect()
    xs = [[int(e) for e in v] for _, v in rows]
    sums = [sum(c) for c in zip(*xs)]
    assert {r["__id"]: r["deviation"] for r in found} == {i: sum((3 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in enumerate(xs)}
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(spark.createDataFrame([(0, [2.0 ** 40]), (1, [0.0])], "vec_id long, embedding array<double>"), scale=1).collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=30), st.integers(1, 7))
def test_rank_one_updates_with_ties(rows, block):
    """Few values make equal eigenvalues and zero weights, which have to be deflated."""
    x = np.array(rows)
    one, other = whitening.Spectrum.empty(4), whitening.Spectrum.empty(4)
    half = len(x) // 2
    for s, part in ((one, x[:half]), (other, x[half:])):
        for k in range(0, len(part), block):
            s.add(part[k:k + block])
    one.merge(other)
    c = x - x.mean(0)
    assert one.n == len(x) and one.sums == x.sum(0).tolist()
    assert np.abs(one.basis * one.values @ one.basis.T - c.T @ c).max() < 1e-10
    assert np.abs(one.basis.T @ one.basis - np.eye(4)).max() < 1e-12


# token counts

def plain_tokens(texts):
    tokenizer, _ = token_counts.load(VOCABULARY)
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_match_the_library(spark):
    r = random.Random(9)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x1F300, 0x1F700)) + [0x10FFFF, 0x32000, 0xA7CE]
    noise = ["".join(chr(r.choice(points)) for _ in range(r.randrange(1, 60))) for _ in range(500)]
    hard = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endof<|endoftext|>text|>", "it's I'LL we've  \n\n  x\t\t", " ", "\x1c\x1d \x85", "x" * 20000,
            " " * 5000 + "y", "\r\n" * 50, "12345 6789", "ＡＢＣ ① Ⅳ"]
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(noise + hard)]
    out = token_counts.count_tokens(frame(spark, rows), VOCABULARY, limit=9).collect()
    want = Counter((i, len((t or "").encode()), n, n > 9) for (i, t), n in zip(rows, plain_tokens([t or "" for _, t in rows])))
    assert Counter(tuple(x) for x in out) == want
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS), VOCABULARY).count() == 0


def test_whole_tokens_are_not_merged():
    proved = token_counts.whole_tokens(VOCABULARY)
    assert len(proved) > 49_000 and " the" in proved
    own = token_counts.Counter(VOCABULARY, "")
    own.pieces.tokenizer = None  # would fail if asked
    assert own.count("The house, and the garden<|endoftext|>") == plain_tokens(["The house, and the garden<|endoftext|>"])[0]


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        token_counts.load(public_tokenizers.path("word_bpe_49k.json"))


# phrases

def collocations_plainly(rows, least, first):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + m])] += 1
    out = set()
    for lang, f in counts.items():
        often = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = {(p[i:i + k], f[p]) for p in often for k in range(1, len(p)) for i in range(len(p) - k + 1)}
        found = []
        for p in often:
            if (p, f[p]) in inside:
                continue
            score, k = min((Fraction(1000 * f[p] * total[lang], f[p[:k]] * f[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, le, ri) in enumerate(sorted(found)[:first], 1):
            out.add((lang, rank, p.decode(), -a, le, ri, total[lang], -s))
    return out


def phrase_rows():
    r = random.Random(3)
    words = ["the", "of", "red", "Red", "x", "é", "漢字", "tiger", "a-b", " "]
    rows = [(r.choice(["en", "de", None]), " ".join(r.choices(words, weights=range(10, 0, -1), k=r.randrange(0, 80))) + r.choice(["", ".", " , end", "\n"]))
            for _ in range(300)]
    rows += [("en", "the hot line of many copies, THE hot line\tof many")] * 150  # a third of the rows
    rows += [("en", "the hot " + " ".join(r.choices("abcdefghij", k=40))) for _ in range(60)]
    return rows + [("en", None), ("en", ""), (None, " .,;"), ("en", prose(2, 30000)), ("fr", "one")]


@pytest.mark.parametrize("per_bucket, flush", [(1_000_000, 8 << 20), (50, 3000)])
def test_phrases_match_brute_force(spark, per_bucket, flush, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLE", 1)  # every run is looked at, so that hot ones are found in a small table
    rows = phrase_rows()
    df = spark.createDataFrame([(k, t, x, "a", "b", "c", "d") for k, (x, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n string, f string, bucket string").repartition(5)
    for least, first in ((5, 2000), (40, 7)):
        got = phrases.collocations(df, least, first, per_bucket=per_bucket, flush_bytes=flush).collect()
        assert {tuple(r) for r in got} == collocations_plainly(rows, least, first)
        assert len(got) == len({tuple(r) for r in got})


def test_hot_words_are_spread(spark, monkeypatch):
    """No bucket of runs holds a word, pair or triple that a third of all runs begin with."""
    runs = phrases.cut(["en"] * 300, [f"the hot line {k} {k % 7}".encode() for k in range(300)])
    h = phrases.beginnings(runs)
    hot = [np.unique(h[0][runs.words[0] == runs.words[0][0]]), *[np.zeros(0, np.uint64)] * 3]
    for k in range(3):
        keys, n = np.unique(h[k], return_counts=True)
        hot[k] = keys[n > 100]
    bucket, own = phrases.route(runs, hot, 10)
    assert np.bincount(bucket).max() < len(bucket) / 4
    assert own.max() == 4


def test_no_words_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.collocations(frame(spark, [(1, None), (2, " , ")])).count() == 0


def test_query_columns(spark, sf_dir):
    want = {"op11_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            "op12_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            "op13_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]}
    for name, columns in want.items():
        assert queries.queries()[name](spark, sf_dir).columns == columns
