"""Texts as rows of space-led chunks, cut without a Python object per chunk.

Shared by the two tokenizer operators: a text gets one leading space and is cut
before runs of spaces, so every chunk starts with a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tessera.llm.shared import text_groups

SPACE = 0x20

#: UTF-8 of the characters outside ASCII that are white space to a regular expression's \\s.
_WIDE_SPACE = [0xC285, 0xC2A0, 0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each after one space, as one byte array; where each begins (and the last ends)."""
    data = np.frombuffer(b" ".join([b"", *texts]), np.uint8) if texts else np.empty(0, np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return data, starts


def chunk_starts(data: np.ndarray, starts: np.ndarray, after_space: bool) -> np.ndarray:
    """Where chunks begin: at texts, and at spaces after a byte that is no space.

    ``after_space`` False: only after a character that is no white space of any kind.
    """
    if not len(data):
        return np.empty(0, np.int64)
    cut = data == SPACE
    before = np.concatenate([[SPACE], data[:-1]])
    cut &= before != SPACE
    if not after_space:
        at = np.flatnonzero(cut & ((before < 0x21) | (before >= 0x80)))
        last = [np.where(at >= k, data[at - k], 0).astype(np.int64) for k in (1, 2, 3)]
        two, three = last[1] << 8 | last[0], last[2] << 16 | last[1] << 8 | last[0]
        cut[at[(last[0] < 0x21) | np.isin(two, _WIDE_SPACE) | np.isin(three, _WIDE_SPACE)]] = False
    cut[starts[:-1]] = True
    return np.flatnonzero(cut)


def coded_chunks(data: np.ndarray, starts: np.ndarray, after_space: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct chunks, code of every chunk, number of chunks of each text)."""
    at = chunk_starts(data, starts, after_space)
    offsets = np.concatenate([at, [len(data)]]).astype(np.int32)
    arr = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    per_text = np.diff(np.searchsorted(at, starts))
    return arr.dictionary.to_pylist(), arr.indices.to_numpy(), per_text


def text_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[bytes]]]:
    """(doc ids, texts) of the batches' columns doc_id and text, at least ``size`` bytes together; null is empty."""
    ids, held, n = [], [], 0
    for batch in batches:
        for at, texts in text_groups(batch.column(1)):
            for doc, text in zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts):
                ids.append(doc)
                held.append(text)
                n += len(text) + 1
                if n >= size:
                    yield ids, held
                    ids, held, n = [], [], 0
    if ids:
        yield ids, held


def gather(pool: np.ndarray, first: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """pool[first[c]:first[c] + size[c]] for every code c, one after the other."""
    n = size[codes]
    after = np.cumsum(n)
    total = int(after[-1]) if len(after) else 0
    return pool[np.repeat(first[codes] - (after - n), n) + np.arange(total)]
