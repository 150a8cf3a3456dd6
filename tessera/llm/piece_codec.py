"""Operator 13: SentencePiece encoding and decoding through tables of distinct chunks.

The model writes a marker (U+2581) for every space and one before the text.  None
of its pieces has a marker behind another character (checked on load), so no piece
crosses from a word into the markers before the next one, and a text's ids are the
ids of its chunks (markers, then a word) in order.

A task cuts its texts into blocks of about ``BLOCK_BYTES``.  Of a block it makes the table of
distinct chunks, in which every text is a list of positions; the library segments each
distinct chunk once and decodes its ids once; ids and decoded chunks are joined back by
position.  Nothing is shuffled or written, and a task holds one block.

The table is the block's and not the corpus's: one table for all texts, joined back to the blocks'
lists on Spark, gave the same rows but took 4.5 times the input on disk (the README has the figures).

Decoding: the library drops one leading marker and writes the others as spaces; the
ids of a chunk begin with its first marker, and byte pieces never cross it, so a
decoded text is its chunks' decoded texts joined by one space.

Defined cases: null text is empty; an empty text has the begin and end ids only and
decodes to nothing.  U+2581 in a text is a space to the model and comes back as one.
Names of control pieces in a text are plain text.  Repeated rows and null ids give a
row each.  A text longer than a block is a block of its own; a chunk may be as long
as its text.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import coded_chunks, gather, joined, text_blocks
from tessera.llm.shared import give_back

MARK = "▁"
BLOCK_BYTES = 4 << 20


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A SentencePiece model of which chunks can be segmented one by one."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("a piece has a marker behind another character: texts cannot be cut at markers")
        probe = "  a\t b \n  ﬁ½"
        if self.model.decode(self.model.encode(probe)) != probe:
            raise ValueError("the model rewrites texts: they cannot be cut before it has")
        self.mark = self.model.piece_to_id(MARK)
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()

    def segment(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk.  The library adds the first marker itself, but none to nothing."""
        got = self.model.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if len(c) > 1 else [self.mark] for c, ids in zip(chunks, got)]

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        return [t.encode() for t in self.model.decode(ids, num_threads=1)] if ids else []


_WORKER: dict[str, Pieces] = {}


def worker_pieces(path: str) -> Pieces:
    if path not in _WORKER:
        _WORKER[path] = Pieces(path)
    return _WORKER[path]


def encode_block(pieces: Pieces, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(all ids one text after the other, with begin and end ids; where each text's begin and the last end; decoded texts)."""
    data, starts = joined([t.replace(MARK.encode(), b" ") for t in texts])
    chunks, codes, sizes = coded_chunks(data, starts, after_space=True)
    has_text = np.array([len(t) > 0 for t in texts])           # the model adds no marker to nothing
    codes, sizes = codes[np.repeat(has_text, sizes)], np.where(has_text, sizes, 0)
    ids = pieces.segment(chunks)
    decoded = pieces.decode(ids)
    n = len(ids)          # the begin and end ids stand behind the chunks' ids in the pool, as positions n and n + 1
    size = np.array([len(x) for x in ids] + [1, 1], np.int64)
    pool = np.fromiter(chain.from_iterable([*ids, [pieces.begin, pieces.end]]), "<u4", int(size.sum()))
    ends = np.cumsum(sizes)
    full = np.insert(codes.astype(np.int64), np.stack([ends - sizes, ends], axis=1).ravel(), np.tile([n, n + 1], len(ends)))
    after = np.concatenate([[0], np.cumsum(size[full])])
    bounds = after[np.concatenate([[0], ends + 2 * np.arange(1, len(ends) + 1)])]
    back = map(decoded.__getitem__, codes.tolist())
    return gather(pool, np.cumsum(size) - size, size, full), bounds, [b" ".join(islice(back, k)) for k in sizes.tolist()]


def _encode(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(path)
        for doc_ids, texts in text_blocks(batches, size):
            ids, bounds, decoded = encode_block(pieces, texts)
            encoded = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(np.diff(bounds)), encoded,
                                              pa.array(decoded, pa.binary()).cast(pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
        give_back()
    return run


def encode_decode(docs: DataFrame, path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit, begin and end
    ids included) and decoded (the text that the library decodes them to)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _encode(path or model_path(), block_bytes), "doc_id long, n_tokens long, ids binary, decoded string")


def codec_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_decode(docs, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                            F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
