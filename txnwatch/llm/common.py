"""Helpers the corpus operators share."""

from __future__ import annotations

import math
import uuid
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import prepare, scratch_path

# Fixed value: the white space that separates words in every contract
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Where a vocabulary that the contracts name lies; it belongs to an installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Written to the shared folder and read back: lineage ends here, and a lost executor recomputes nothing."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private(name: str) -> str:
    """A column name no input can clash with."""
    return f"__{name}_{uuid.uuid4().hex[:6]}"


def normal(text: Column) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def groups_for(rows: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / each))


def some_labels(labels: DataFrame, value, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, chosen by their hash: doc_id, ``__label``. Few enough to be broadcast, so that looking
    them up moves no text."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(value.alias("__label")).where("__label is not null")
    return F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the least number of groups worth making."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(batch, bytes_each: int = 1 << 20):
    """Row ranges of an Arrow batch or table (text in its last column) of about a megabyte each."""
    import numpy as np
    import pyarrow.compute as pc

    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False))
    cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(total // bytes_each)) + 1, [batch.num_rows]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(a, b - a)


class TokenCache:
    """Token ids of texts, as little-endian 16-bit integers.

    The tokenizer drops white space and splits at it, lowers case, and parts letters from punctuation, so a text's ids are
    those of its parts in order: of every word, lower-cased, its core and its tail of marks. A batch's distinct parts are found
    by Arrow; what the cache lacks is encoded many at a time, set apart by a control character that is a token of its own.
    Parts of letters a to z alone, which the tokenizer neither changes nor splits, go to its model at once. A text that holds
    the control character, or what could begin a special token, is encoded as it is. A full cache forgets
    what came once: forgetting costs time, never results.
    """

    MARK = "\x01"
    # marks that may stand apart at the end of a word; not the apostrophe, which may belong to a contraction
    TAIL = b"!\"#$%&()*+,-./:;=>?@[]^_`{}~|<"

    def __init__(self, path: str, limit: int = 400_000):
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.limit, self.tokenizer = limit, Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids above 65535 need wider integers than this cache keeps")
        [self.mark] = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.lower = bytes(range(256)).lower()
        self.blank, self.tail, self.alnum = (np.zeros(256, bool) for _ in range(3))
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.tail[list(self.TAIL)] = True
        self.alnum[[c for c in range(128) if chr(c).isalnum()]] = True
        letters = "".join(map(chr, range(97, 123)))
        whole = [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(letters)] == [letters]
        self.letters = whole and self.tokenizer.normalizer.normalize_str(letters) == letters
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        import numpy as np

        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, "<u2"), np.zeros(1 << 14, np.int64)  # a part's ids end where the next one's begin
        self.again = np.zeros(1 << 14, bool)  # needed by a later batch than the one that brought it

    def _make_room(self) -> None:
        """Forgets what came once; everything, should the rest take more than half of the room."""
        import numpy as np

        words, again = list(self.known), self.again[:len(self.known)]  # in the order of their numbers
        stay = np.flatnonzero(again)
        ids, ends = self.ids, self.ends[:len(words)]
        self._forget()
        if not 0 < len(stay) <= self.limit // 2:
            return
        first = np.where(stay > 0, ends[stay - 1], 0)
        n = ends[stay] - first
        total = np.concatenate([[0], np.cumsum(n)])
        self.ids, self.ends = ids[np.repeat(first - total[:-1], n) + np.arange(total[-1])], total[1:]
        self.again = np.zeros(len(stay), bool)
        self.known = dict(zip([words[k] for k in stay.tolist()], range(len(stay))))

    def _learn(self, parts: list[bytes]) -> None:
        import numpy as np

        plain = [self.letters and c.isalpha() for c in parts]  # lower-cased bytes
        parts = [c for c, p in zip(parts, plain) if p] + [c for c, p in zip(parts, plain) if not p]
        n_plain, between, first = sum(plain), f" {self.MARK} ", len(self.known)
        tokens = [[t.id for t in self.model.tokenize(c.decode("ascii"))] for c in parts[:n_plain]]
        at = begin = int(self.ends[first - 1]) if first else 0
        found = [np.fromiter(chain.from_iterable(tokens), "<u2")]
        ends = [at + np.cumsum(np.fromiter(map(len, tokens), np.int64, n_plain))]
        at += len(found[0])
        texts = [between.join([c.decode("utf-8") for c in parts[k:k + 256]]) for k in range(n_plain, len(parts), 256)]
        for code in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(code.ids, "<u2")
            marks = np.flatnonzero(ids == self.mark)
            found.append(np.delete(ids, marks))
            ends.append(at + np.append(marks - np.arange(len(marks)), len(ids) - len(marks)))
            at = int(ends[-1][-1])
        if at > len(self.ids):
            self.ids = np.resize(self.ids, 2 * at)
        self.ids[begin:at] = np.concatenate(found)
        if first + len(parts) > len(self.ends):
            self.ends, self.again = (np.resize(a, 2 * (first + len(parts))) for a in (self.ends, self.again))
        self.again[first:first + len(parts)] = False
        self.ends[first:first + len(parts)] = np.concatenate(ends)
        self.known.update(zip(parts, range(first, first + len(parts))))

    def _parts(self, raw) -> tuple:
        """Where the parts of lower-cased bytes begin, and how long they are."""
        import numpy as np

        blank = self.blank[raw]
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        cut = stop.copy()
        marked = np.flatnonzero(self.tail[raw[stop - 1]])
        for _ in range(4):  # few words end in more marks than that
            cut[marked] -= 1
            marked = marked[(cut[marked] > start[marked]) & self.tail[raw[cut[marked] - 1]]]
        if len(marked):
            core = np.where(blank | self.tail[raw], np.int32(-1), np.arange(len(raw), dtype=np.int32))
            cut[marked] = np.maximum(np.maximum.accumulate(core)[stop[marked] - 1] + 1, start[marked])
        split = (cut > start) & (cut < stop) & self.alnum[raw[np.maximum(cut - 1, 0)]]
        begin = np.repeat(start, 1 + split)
        second = np.cumsum(1 + split)[split] - 1
        begin[second] = cut[split]
        length = np.repeat(stop, 1 + split) - begin
        length[second - 1] = (cut - start)[split]
        return begin, length, blank

    def encode(self, texts: list[bytes | None], end: int) -> list[bytes]:
        """Ids of each text followed by the end id, 16 bits each."""
        import numpy as np
        import pyarrow as pa

        last = end.to_bytes(2, "little")
        texts = [t or b"" for t in texts]
        odd = {k: np.array(self.tokenizer.encode(t.decode("utf-8"), add_special_tokens=False).ids, "<u2").tobytes() + last
               for k, t in enumerate(texts) if b"\x01" in t or b"<|" in t}
        raw = np.frombuffer(b" ".join([b"" if k in odd else t for k, t in enumerate(texts)]).translate(self.lower) + b" ", np.uint8)
        begin, length, blank = self._parts(raw)
        offsets = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank].tobytes())]).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [w for w in distinct if w not in self.known]
        if self.known and len(self.known) + len(missing) > self.limit:
            self._make_room()
            missing = [w for w in distinct if w not in self.known]
        before = len(self.known)
        if missing:
            self._learn(missing)
        numbers = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        self.again[numbers[numbers < before]] = True
        slot = numbers[coded.indices.to_numpy()]
        first = np.where(slot > 0, self.ends[slot - 1], 0)
        n = self.ends[slot] - first
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(first - total[:-1], n) + np.arange(total[-1])].tobytes()
        sizes = np.array([0 if k in odd else len(t) for k, t in enumerate(texts)], np.int64)
        edges = total[np.searchsorted(begin, np.concatenate([[0], np.cumsum(sizes + 1)]))].tolist()
        return [odd[k] if k in odd else ids[2 * a:2 * b] + last for k, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]


@lru_cache(maxsize=2)
def token_cache(path: str) -> TokenCache:
    """One cache per Python worker, kept from task to task."""
    return TokenCache(path)


def release() -> None:
    """Gives back what earlier steps have left in this Python worker: token caches, and memory that allocators keep. A worker
    outlives its tasks, so without this the caches of one step lie beside the arrays of the next."""
    import ctypes

    import pyarrow as pa

    token_cache.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)
