"""Operator 9: packing by power-of-two decomposition.

A document of n ids (its text's, then id 2) is cut into floor(n / 4096) pieces of
4096 and one piece for each bit of the rest, the longest first.  Every piece is a
sequence of its own length, a power of two, so there is no padding and no
sequence crosses documents.  Sequences are numbered bucket by bucket (equal
lengths together, the longest first): a task counts its own pieces of each length
as it cuts them, and the counts per (length, input partition), prefix-summed, say
where its numbers begin.  Pieces are written once and never shuffled.

Ids come from a public tokenizer file whose rule cuts at white space, so a
text's ids are the ids of its white-space chunks in order.  A worker keeps the
ids of words it has met (a bounded number, the frequent ones) and asks the
tokenizer only for new ones: the text is never split anywhere else.  Chunks of
plain Latin letters with trailing punctuation are asked for as letters and marks,
which the tokenizer's own rule separates.

Defined cases: null text is empty; an empty text is the one id 2.  Strings of
special tokens inside a text give their ids, as the file says.  Repeated rows
each give their pieces.  Null ids are allowed.  Empty table: no rows.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, text_groups, word_blocks

LONGEST = 4096
END_ID = 2
CACHE_WORDS = 150_000   # words a worker remembers: about 30 MB
OUT_BYTES = 4 << 20
BATCH_BYTES = 2 << 20   # text looked up together

#: Letters that the tokenizer keeps in one word and lower-cases one by one, then marks it keeps apart from them.
_PLAIN = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,]*)$"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Ids of texts by white-space chunk, with a bounded memory of words."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core; a pool of threads costs 30 MB
        from tokenizers import Tokenizer
        self.tok, self.limit = Tokenizer.from_file(path), limit
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a token word
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.pool, self.used = np.empty(1 << 16, "<u4"), 0
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.place), len(words)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while n + m > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + m] = sizes
        self.used += len(ids)
        self.place.update(zip(words, range(n, n + m)))

    def _bound(self, known: int, used: int, met: int) -> None:
        """A full memory keeps what it had: words new in the last look-up go again.

        The words met first are mostly the frequent ones.  If most words of a
        look-up were new, the texts have changed and all is learned afresh.
        """
        new = len(self.place) - known
        if len(self.place) <= self.limit or known < self.limit:
            return
        if 2 * new > met:
            self._forget()
            return
        for _ in range(new):
            self.place.popitem()
        self.used = used

    def _learn(self, plain: list[str], odd: list[str]) -> None:
        """plain: letters only or marks only, one token word each, so many go through the tokenizer as one text."""
        for i in range(0, len(plain), 5000):
            part = plain[i:i + 5000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                raise ValueError("the tokenizer does not end each word with an end-of-word id")
            self._remember(part, ids, np.diff(cuts, prepend=0))
        if odd:
            got = [e.ids for e in self.tok.encode_batch_fast(odd, add_special_tokens=False)]
            self._remember(odd, np.array([i for x in got for i in x], "<u4"), np.array([len(x) for x in got]))

    def _places(self, words: pa.Array, plain: np.ndarray) -> np.ndarray:
        """Place in memory of each word; ``plain`` says which are token words of their own."""
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        first = np.zeros(len(names), bool)
        first[coded.indices.to_numpy()] = plain
        found = list(map(self.place.get, names))
        new = [i for i, at in enumerate(found) if at is None]
        self._learn([names[i] for i in new if first[i]], [names[i] for i in new if not first[i]])
        for i in new:
            found[i] = self.place[names[i]]
        return np.array(found, np.int64)[coded.indices.to_numpy()]

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's end."""
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        known = len(self.place), self.used
        parts = pc.extract_regex(chunks.dictionary, pattern=_PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        word = pc.if_else(parts.is_valid(), pc.utf8_lower(pc.struct_field(parts, "word")), chunks.dictionary)
        marks = pc.fill_null(pc.struct_field(parts, "marks"), "")
        pair = np.stack([self._places(word, plain), self._places(marks, np.ones(len(plain), bool))], axis=1)
        seg = pair[chunks.indices.to_numpy()].ravel()
        size = self.size[seg]
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        ids = self.pool[np.repeat(self.start[seg] - (after - size), size) + np.arange(total)]
        ends = np.concatenate([[0], after])[2 * split.offsets.to_numpy()[1:]]
        self._bound(*known, len(chunks.dictionary))
        return ids, ends

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text; texts are looked up together, about 2 MB at a time."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, n = [], 0
        for at, block in chain(((i, b) for i, t in enumerate(texts) for b in word_blocks(t)), [(None, b"")]):
            if held and (at is None or n + len(block) > BATCH_BYTES):
                ids, ends = self._ids(pa.array([b for _, b in held], pa.binary()).cast(pa.string()))
                for (i, _), a, b in zip(held, [0, *ends[:-1]], ends):
                    out[i].append(ids[a:b])
                held, n = [], 0
            held.append((at, block))
            n += len(block)
        return [x[0] if len(x) == 1 else np.concatenate(x or [np.empty(0, "<u4")]) for x in out]


_WORKER: dict[str, ChunkTokenizer] = {}


def worker_tokenizer(path: str) -> ChunkTokenizer:
    if path not in _WORKER:
        _WORKER[path] = ChunkTokenizer(path)
    return _WORKER[path]


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """``n`` as powers of two, none above ``longest``, falling."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _pieces(path: str, longest: int, with_ids: bool):
    names = ["doc_id", "part", "local", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seen = worker_tokenizer(path), Counter()   # of each length, in this partition
        for batch in batches:
            for at, texts in text_groups(batch.column(2), 500):
                docs, rids = (batch.column(i).slice(at, len(texts)).to_pylist() for i in (0, 1))
                rows, raw, held = [], [], 0
                for doc, rid, ids in zip(docs, rids, tok.ids(texts)):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    start = 0
                    for n in piece_lengths(len(ids), longest):
                        piece = ids[start:start + n].tobytes()
                        rows.append((doc, rid >> 33, seen[n], start, n, zlib.crc32(piece), len(ids)))
                        seen[n] += 1
                        start, held = start + n, held + len(piece) * with_ids + 48
                        if with_ids:
                            raw.append(piece)
                        if held > OUT_BYTES:
                            yield out(rows, raw)
                            rows, raw, held = [], [], 0
                if rows:
                    yield out(rows, raw)

    def out(rows, raw):
        arrays = [pa.array(c, pa.int64()) for c in zip(*rows)]
        if not with_ids:
            return pa.RecordBatch.from_arrays(arrays, names)
        values = pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int32))
        offsets = np.concatenate([[0], np.cumsum([r[4] for r in rows])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(arrays + [pa.ListArray.from_arrays(pa.array(offsets), values)], names + ["ids"])
    return run


def pack(docs: DataFrame, path: str | None = None, longest: int = LONGEST, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    schema = ("doc_id long, part long, local long, start long, length long, ids_crc32 long, doc_tokens long"
              + ", ids array<int>" * with_ids)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), "text")  # the partition is in its upper bits
    pieces = materialize(rows.mapInArrow(_pieces(path or tokenizer_path(), longest, with_ids), schema), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("length").agg(F.sum("n").alias("n"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)  # one row per length: 13
    first = sizes.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("first"))
    # written, so that its size decides how it is joined: at most 13 rows per input partition
    start = materialize(counts.join(F.broadcast(first), "length").select(
        "length", "part", (F.col("first") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("before")), "starts")
    return pieces.join(start, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("before") + F.col("local")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))
