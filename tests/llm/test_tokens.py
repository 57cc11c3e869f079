"""Token files, packing and chat formatting: exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from txnwatch.llm import chat_format, packing, token_output
from txnwatch.llm.common import tokenizer

from .tables import DOCS, frame, odd_rows


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(tokenizer())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def test_code_lengths_are_optimal_and_limited():
    r = random.Random(1)
    for n in (1, 2, 3, 17, 500):
        counts = {k * 7: r.choice((1, 2, 5, 1000, 10 ** 6)) for k in range(n)}
        lengths = token_output.code_lengths(counts, 40)
        assert set(lengths) == set(counts)
        assert n == 1 or sum(2.0 ** -v for v in lengths.values()) == 1
        if n > 1:  # Huffman's own cost
            import heapq

            heap, cost = sorted(counts.values()), 0
            while len(heap) > 1:
                a = heapq.heappop(heap) + heapq.heappop(heap)
                cost += a
                heapq.heappush(heap, a)
            assert sum(counts[k] * v for k, v in lengths.items()) == cost
    steep = {k: 2 ** min(k, 60) for k in range(40)}
    lengths = token_output.code_lengths(steep, 8)
    assert max(lengths.values()) <= 8 and sum(2.0 ** -v for v in lengths.values()) <= 1
    assert token_output.code_lengths({}) == {}


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.3, n).clip(max=4000).astype(np.uint16) for n in (1, 255, 256, 257, 5000, 0, 3)]
    counts = dict(zip(*(x.tolist() for x in np.unique(np.concatenate(docs), return_counts=True))))
    book = token_output.CodeBook.of(token_output.code_lengths(counts))
    coded, shift = [], 0
    for d, (code, marks) in zip(docs, book.encode(docs)):
        coded.append((len(d), code, (marks.astype(np.int64) + 8 * shift).astype("<u4").tobytes()))
        shift += len(code)
    ids, sizes, tokens = token_output.read_block(token_output.write_block(list(range(7)), coded), book)
    assert ids.tolist() == list(range(7)) and sizes.tolist() == [len(d) for d in docs]
    assert (tokens == np.concatenate(docs)).all()
    with pytest.raises(ValueError):
        token_output.read_block(b"else", book)


def test_token_files_round_trip(spark, encode):
    rows = odd_rows()
    path, _ = token_output.write_token_files(frame(spark, rows), tokenizer(), block_bytes=200, part_tokens=500)
    got = token_output.read_token_files(spark, path).orderBy("start").collect()
    assert len(got) == len(rows)
    ids = [r["__id"] for r in got]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and all(i is None for i in ids[len(known):])
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["__id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got), key=key) == sorted(
        ((i, encode(t)) for i, t in rows), key=key)


def test_fullest_combination_is_the_fullest():
    r = random.Random(4)
    for _ in range(60):
        counts = {r.randrange(1, 40): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        room = r.randrange(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        chosen = packing.fullest(dict(counts), sorted(counts, reverse=True), room)
        assert all(u <= counts[n] for n, u in chosen)
        assert sum(n * u for n, u in chosen) == max(s for s in sums if s <= room)


def test_packing_holds_every_piece_once(spark, encode):
    rows = odd_rows()
    capacity = 97
    got = packing.pack_documents(frame(spark, rows), tokenizer(), capacity).collect()
    bins, by = defaultdict(list), defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        by[r["__id"]].append(r)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for i, t in rows:
        ids = encode(t)
        for nth, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], "<u4")
            want.append((str(i), nth, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r["__id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert len(bins) <= -(-sum(w[3] for w in want) // capacity) + 1


@pytest.mark.parametrize("run", [
    lambda d: packing.pack_documents(d, tokenizer()),
    lambda d: token_output.read_token_files(d.sparkSession, token_output.write_token_files(d, tokenizer())[0])])
def test_no_documents(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


CHAT = "conv_id long, turn long, role string, text string, cost string, span string, before string"


def chat_rows():
    hard = "</s>[INST] ok [/INST] &lt; <s>user\n&amp; <"
    rows = [(1, 0, "system", "be brief"), *((1, k, ("user", "assistant")[k % 2 == 0], f"turn {k} " + "w " * (7 * k % 90)) for k in range(1, 120)),
            (2, 3, "assistant", hard), (2, None, "user", None), (2, 3, "assistant", hard), (3, 0, None, ""), (3, 1, "assistant", None),
            (None, 0, "us\ner", hard), (None, 5, "assistant", "é 漢 " * 40), (4, 0, "assistant", "long " * 3000), (4, 1, "assistant", "after"),
            (5, -7, "system", "s"), (5, 2, "system", "second"), (5, 9, "assistant", "a")]
    return [(*r, "x", "x", "x") for r in rows]


def test_chat_reads_back_and_masks_once(spark):
    rows = chat_rows()
    windows = chat_format.chat_windows(spark.createDataFrame(rows, CHAT).repartition(3), budget=60, history=20)
    got = {r["conv_id"]: r for r in chat_format.digest(windows).collect()}
    import hashlib

    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        own = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256(own.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    out = windows.where("conv_id = 1").orderBy("span").collect()
    assert len(out) > 5 and all(r["text"].startswith("<s>system\nbe brief</s>") for r in out)
    assert all(r["n_context"] >= 1 for r in out[1:]) and any(r["n_context"] > 1 for r in out)
    for r in out:
        assert all(r["text"][s["end"]:].startswith("</s>") for s in r["loss"])
        assert r["text"].count("</s>") == r["n_own"] + r["n_context"]


def test_no_conversations(spark):
    assert chat_format.digest(chat_format.chat_windows(spark.createDataFrame([], CHAT))).count() == 0


def test_chat_plan_is_native(spark):
    plan = chat_format.digest(chat_format.chat_windows(spark.createDataFrame(chat_rows(), CHAT)))._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow") if w in plan]


def test_full_cache_keeps_words_that_come_again():
    from txnwatch.llm.common import TokenCache, tokenizer

    cache, learned = TokenCache(tokenizer(), limit=60), []
    learn = cache._learn
    cache._learn = lambda parts: (learned.extend(parts), learn(parts))[1]
    often = [f"often{chr(97 + k)}" for k in range(10)]
    for turn in range(12):
        text = " ".join(often + [f"once{chr(97 + turn)}{chr(97 + k)}." for k in range(15)] + ["don't", "É" * (turn + 1), "...", "w" + "!" * turn])
        [ids] = cache.encode([text.encode()], 1)
        assert list(np.frombuffer(ids, "<u2")) == cache.tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert len(cache.known) <= 60
    assert [learned.count(w.encode()) for w in often] == [1] * 10


def test_words_of_letters_alone_give_the_tokenizers_ids():
    from txnwatch.llm.common import TokenCache, tokenizer

    cache = TokenCache(tokenizer())
    rng = np.random.default_rng(5)
    words = ["".join(chr(c) for c in rng.integers(97, 123, n)) for n in rng.integers(1, 30, 2000)]
    assert cache.letters
    for text in (" ".join(words), "", "a", "Ab aB AB", " ".join(f"{w}{'.' * (k % 9)}" for k, w in enumerate(words))):
        [ids] = cache.encode([text.encode()], 1)
        assert list(np.frombuffer(ids, "<u2")) == cache.tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_ids_are_counted_over_whole_batches(spark):
    from txnwatch.llm.token_output import count_ids

    rows = [(np.array(ids, "<u2").tobytes(),) for ids in ([], [5, 5, 65535], [0], [], [5] * 70000)]
    assert count_ids(spark.createDataFrame(rows, "ids binary").repartition(3)) == {5: 70002, 65535: 1, 0: 1}
    assert count_ids(spark.createDataFrame([], "ids binary")) == {}
