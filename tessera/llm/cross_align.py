"""Operator 12: alignment of two tokenizers over the same bytes, by pointer jumping.

Tokenizer A (byte-level BPE) and B (SentencePiece) both cover one space plus the text.
Where tokens of both end at one byte, a group of A tokens and B tokens closes.

* Every token points to its farthest-right overlapping token: an A token to the B token
  over its last byte if that ends later, else to itself; a B token to the A token over its
  last byte.  Successors are doubled (``s = s[s]``) over all tokens of a block at once
  until nothing changes: each token then points to the terminal token of its group.
* A link is an A token and a B token whose byte ranges overlap.  An id pair counts the
  documents that hold it linked.  A document's links are stated as distinct pairs with
  multiplicity: numbers in its block's list of pairs.  The lists' counts meet per pair, the
  best count per A id is found, and the lists' resolved counts come back to their blocks.

Both tokenizers end a token at a space behind a character that is no white space (B has no
piece with a marker behind another character, A's rule starts a new word there), so a
block's texts are cut there, each distinct chunk is tokenized and aligned once, and
groups and links never cross chunks.  A pair stands once in a block's list, so no pair has
more rows than there are blocks, and an A id has at most as many pairs as B has ids.

Defined cases: null and empty texts, and texts whose A or B tokens do not give back the
space and the text (those with U+2581, which B writes as a space), have no tokens: zeros and
an empty group text.  (A chunk with it is always shorter in B, so differences of chunks never
cancel.)  Names of special tokens in a text are plain text.  Repeated rows count
each; null ids are allowed.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.chunks import coded_chunks, gather, joined, text_blocks
from tessera.llm.piece_codec import MARK, Pieces, model_path
from tessera.llm.shared import give_back, materialize

BLOCK_BYTES = 4 << 20
LOOK_UP = 8192          # chunks given to A at a time
LONG = 1000             # bytes of a chunk from which A's own library is used
OUT_BYTES = 4 << 20
_ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes array<int>, "
         "times array<int>, code int, pair long, docs long")


#: Bytes of characters below U+0250 in UTF-8.
_PLAIN = bytes([*range(0x80), *range(0xC2, 0xCA), *range(0x80, 0xC0)])


def byte_model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Character by which a byte-level vocabulary writes each byte: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def plain_chunk(chunk: bytes) -> bool:
    """Characters below U+0250 only, on whose classes all Unicode versions agree, and not long or ending in white space."""
    return len(chunk) <= LONG and chunk.translate(None, _PLAIN) == b"" and not chunk.decode()[-1].isspace()


class TwoTokenizers:
    """Both tokenizers, and the bytes of their tokens.

    Chunks of plain characters go to A joined into one text, cut by A itself at their
    leading spaces, through a faster library with the vocabulary of A's file; others one by one through A's own.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark's tasks are the parallelism
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = Pieces(piece_path)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token)
        ranks = {t: i for i, t in enumerate(self.a_bytes) if t}          # ids of merged tokens rise in the order of the merges
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        m = self.b.model
        self.b_bytes = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(MARK, " ").encode()
                        for i in range(m.get_piece_size())]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        text = np.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], object)
        self.inner, self.last_a, self.last_b = text + ",", text + "|", text + ";"

    def encode_a(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number per chunk)."""
        plain = np.array([plain_chunk(c) for c in chunks], bool)
        n = np.zeros(len(chunks), np.int64)
        ids = {}
        for at in range(0, len(chunks), LOOK_UP):
            part = np.flatnonzero(plain[at:at + LOOK_UP]) + at
            got = np.array(self.fast.encode_ordinary(b"".join(chunks[i] for i in part).decode()), np.int64)
            ends = np.cumsum([len(chunks[i]) for i in part])
            here = np.searchsorted(np.cumsum(self.a_len[got]), ends) + 1 if len(part) else ends
            n[part] = np.diff(here, prepend=0)
            odd = np.flatnonzero(~plain[at:at + LOOK_UP]) + at
            slow = [e.ids for e in self.a.encode_batch_fast([chunks[i].decode() for i in odd], add_special_tokens=False)]
            n[odd] = [len(x) for x in slow]
            ids[at] = np.empty(int(n[at:at + LOOK_UP].sum()), np.int64)
            is_plain = np.repeat(plain[at:at + LOOK_UP], n[at:at + LOOK_UP])
            ids[at][is_plain] = got
            ids[at][~is_plain] = np.fromiter(chain.from_iterable(slow), np.int64)
        return np.concatenate([*ids.values(), np.empty(0, np.int64)]), n

    def encode_b(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.b.segment(chunks)
        return np.fromiter(chain.from_iterable(got), np.int64), np.fromiter(map(len, got), np.int64, len(got))


def group_labels(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal token (number of an A token) of every A and every B token, by pointer jumping.

    Ends of tokens over the same bytes, rising; the last ends are equal.
    """
    n = len(a_end)
    over = np.searchsorted(b_end, a_end)                   # B token over the last byte of each A token
    back = np.searchsorted(a_end, b_end)                   # A token over the last byte of each B token
    succ = np.concatenate([np.where(b_end[over] > a_end, n + over, np.arange(n)), back])
    while True:
        jumped = succ[succ]
        if np.array_equal(jumped, succ):
            return succ[:n], succ[n:]
        succ = jumped


def overlaps(a_end: np.ndarray, a_len: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) with overlapping byte ranges."""
    lo = np.searchsorted(b_end, a_end - a_len, side="right")
    n = np.searchsorted(b_end, a_end) - lo + 1
    after = np.cumsum(n)
    return np.repeat(np.arange(len(a_end)), n), np.repeat(lo - (after - n), n) + np.arange(after[-1] if len(after) else 0)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _same(texts: list[bytes], tokens: list[bytes], ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which texts their tokens' bytes give back."""
    parts = [tokens[i] for i in ids.tolist()]
    if b"".join(parts) == b"".join(texts) and np.array_equal(_sums(np.fromiter(map(len, parts), np.int64, len(parts)), n), [len(t) for t in texts]):
        return np.ones(len(texts), bool)
    parts = iter(parts)
    return np.array([b"".join(islice(parts, k)) == t for t, k in zip(texts, n.tolist())], bool)


class BlockAlignment:
    """The distinct chunks of a block, aligned: counts, group texts, and links as numbers of a list of pairs."""

    def __init__(self, tok: TwoTokenizers, chunks: list[bytes]):
        (a_id, self.n_a), (b_id, self.n_b) = tok.encode_a(chunks), tok.encode_b(chunks)
        self.whole = _same(chunks, tok.a_bytes, a_id, self.n_a) & _same(chunks, tok.b_bytes, b_id, self.n_b)
        a_id, b_id = a_id[np.repeat(self.whole, self.n_a)], b_id[np.repeat(self.whole, self.n_b)]
        self.n_a, self.n_b = self.n_a * self.whole, self.n_b * self.whole
        a_end, b_end = np.cumsum(tok.a_len[a_id]), np.cumsum(tok.b_len[b_id])
        a_label, b_label = group_labels(a_end, b_end)
        a_last, b_last = (np.append(x[1:] != x[:-1], True)[:len(x)] for x in (a_label, b_label))
        a_chunk = np.repeat(np.arange(len(chunks)), self.n_a)
        self.n_groups = np.bincount(a_chunk[a_last], minlength=len(chunks))
        # tokens in the order of the groups' text: a group's A tokens, then its B tokens
        text = np.concatenate([np.where(a_last, tok.last_a[a_id], tok.inner[a_id]), np.where(b_last, tok.last_b[b_id], tok.inner[b_id])])
        order = np.argsort(2 * np.concatenate([a_label, b_label]) + (np.arange(len(text)) >= len(a_id)), kind="stable")
        parts = iter(text[order].tolist())
        self.groups = ["".join(islice(parts, k)) for k in (self.n_a + self.n_b).tolist()]
        i, j = overlaps(a_end, tok.a_len[a_id], b_end)
        self.n_links = np.bincount(a_chunk[i], minlength=len(chunks))
        self.pairs, self.links = np.unique(a_id[i] * len(tok.b_bytes) + b_id[j], return_inverse=True)
        self.first = np.cumsum(self.n_links) - self.n_links

    def linked(self, codes: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers of pairs, times, how many per document) of the documents' chunks."""
        key, n = np.unique(doc * np.int64(len(self.n_a) + 1) + codes, return_counts=True)
        d, c = np.divmod(key, len(self.n_a) + 1)
        size = self.n_links[c]
        key = np.repeat(d, size) * np.int64(len(self.pairs) + 1) + gather(self.links, self.first, self.n_links, c)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], np.repeat(n, size)[order]
        start = np.flatnonzero(np.diff(key, prepend=-1))
        d, p = np.divmod(key[start], len(self.pairs) + 1)
        times = np.add.reduceat(weight, start) if len(start) else weight
        return p, times, np.bincount(d, minlength=docs)


_WORKER: dict[tuple[str, str], TwoTokenizers] = {}


def worker_tokenizers(*paths: str) -> TwoTokenizers:
    if paths not in _WORKER:
        _WORKER[paths] = TwoTokenizers(*paths)
    return _WORKER[paths]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _rows(paths: tuple[str, str], size: int):
    names = [c.split()[0] for c in _ROWS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int64(), pa.int64()]

    def batch(columns: dict) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, block = worker_tokenizers(*paths), TaskContext.get().partitionId() << 32
        for ids, texts in text_blocks(batches, size):
            data, starts = joined(texts)
            chunks, codes, sizes = coded_chunks(data, starts, after_space=False)
            del data
            has_text = np.array([len(t) > 0 for t in texts])
            del texts
            al = BlockAlignment(tok, chunks)
            good = has_text & (_sums(~al.whole[codes], sizes) == 0)
            codes, sizes = codes[np.repeat(good, sizes)].astype(np.int64), np.where(good, sizes, 0)
            doc = np.repeat(np.arange(len(ids)), sizes)
            pairs, times, per_doc = al.linked(codes, doc, len(ids))
            found = np.bincount(pairs, minlength=len(al.pairs))
            held = np.flatnonzero(found)                     # pairs of documents without tokens are not in the list
            at = np.cumsum(found > 0) - 1
            counts = [_sums(x[codes], sizes) for x in (al.n_a, al.n_b, al.n_groups, al.n_links)]
            ends, p_ends = np.cumsum(sizes), np.cumsum(per_doc)
            a, n = 0, 0
            for b in range(len(ids) + 1):                    # documents in batches of bounded size
                if b > a and (b == len(ids) or n > OUT_BYTES):
                    s, e = (ends[a] - sizes[a], ends[b - 1]), (p_ends[a] - per_doc[a], p_ends[b - 1])
                    text = map(al.groups.__getitem__, codes[s[0]:s[1]].tolist())
                    yield batch({"block": pa.array(np.full(b - a, block)), "doc_id": pa.array(ids[a:b], pa.int64()),
                                 **{c: pa.array(x[a:b]) for c, x in zip(names[2:6], counts)},
                                 "groups": pa.array(["".join(islice(text, k))[:-1] for k in sizes[a:b].tolist()], pa.string()),
                                 "codes": _lists(at[pairs[e[0]:e[1]]], per_doc[a:b]), "times": _lists(times[e[0]:e[1]], per_doc[a:b])})
                    a, n = b, 0
                if b < len(ids):
                    n += 16 * int(counts[0][b] + counts[1][b]) + 8 * int(per_doc[b]) + 64
            for i in range(0, len(held), 1 << 16):
                part = held[i:i + (1 << 16)]
                yield batch({"block": pa.array(np.full(len(part), block)), "code": pa.array(np.arange(i, i + len(part), dtype=np.int32)),
                             "pair": pa.array(al.pairs[part]), "docs": pa.array(found[part])})
            block += 1
        give_back()
    return run


def aligned_rows(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of documents (doc_id, n_a, n_b, n_groups, n_links, groups; codes and times of their links)
    and, with ``code`` not null, of their blocks' lists (code, pair, docs)."""
    paths = (byte_path or byte_model_path(), piece_path or model_path())
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_rows(paths, block_bytes), _ROWS)


def align(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and groups: ``a1,a2|b1;a3|b2,b3``, the ids of each group in order."""
    rows = aligned_rows(docs, byte_path, piece_path)
    return rows.where(F.col("code").isNull()).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def pair_counts(lists: DataFrame, b_ids: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether no pair of its A id has more."""
    counts = lists.groupBy("pair").agg(F.sum("docs").alias("n"))
    of_a = Window.partitionBy(F.floor(F.col("pair") / F.lit(b_ids)))     # at most b_ids rows
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def _score(docs: pa.Table, lists: pa.Table) -> pa.Table:
    lists = lists.sort_by("code")
    n, best = lists["n"].to_numpy(), lists["best"].to_numpy().astype(np.int64)
    codes = docs["codes"].combine_chunks()
    sizes = np.diff(codes.offsets.to_numpy())
    codes, times = codes.flatten().to_numpy(), docs["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    return pa.table({c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                    | {"n_best": pa.array(_sums(times * best[codes] if len(codes) else times, sizes)),
                       "count_sum": pa.array(_sums(times * n[codes] if len(codes) else times, sizes)), "groups_sha256": docs["groups_sha256"]})


def alignment_report(docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    piece_path = piece_path or model_path()
    rows = aligned_rows(docs, byte_path, piece_path, block_bytes)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).when(F.col("code").isNull(), F.lit(""))
    rows = materialize(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    lists = rows.where(F.col("code").isNotNull()).select("block", "code", "pair", "docs")
    resolved = lists.join(pair_counts(lists, Pieces(piece_path).model.get_piece_size()), "pair").select(F.col("block").alias("in_block"), "code", "n", "best")
    texts = rows.where(F.col("code").isNull()).select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "codes", "times", "groups_sha256")
    return (texts.groupBy("block").cogroup(resolved.groupBy("in_block"))
            .applyInArrow(_score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
