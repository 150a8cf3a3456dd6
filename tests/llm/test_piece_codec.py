import hashlib
import random
import struct

import sentencepiece

from tessera.llm import piece_codec

ODD = [None, "", " ", "  ", " a", "a ", "a  b   c ", "\n", "a\n b\t c", "▁", "a▁b ▁ ▁▁c", "<s> x</s><unk> <0x41>", "ﬁ ½ Å Å é é", "日本語 текст 😀x",
       "a\x00b", "\x85\xa0  x", "x" * 3000, "'\"\\", "  ".join("abc"), "�", "﻿a"]


def model():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.model_path())


def brute(m, doc_id, text):
    ids = m.encode(text or "", add_bos=True, add_eos=True)
    return (doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(m.decode(ids).encode()).hexdigest())


def rows(seed=4):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß語😀▁") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [rng.choice(["", " ", "  "]) + rng.choice([" ", "  ", "\n", " \n "]).join(rng.choice(vocab) for _ in range(rng.randint(1, 500))) for _ in range(80)]
    return list(enumerate(ODD + texts)) + [(3, "same"), (3, "same"), (None, "no id"), (900, "word " * 100_000)]


def order(r):
    return (r[0] is None, r[0] or 0, r[2])


def test_report_equals_the_library(spark, docs):
    m = model()
    want = sorted((brute(m, *r) for r in rows()), key=order)
    df = docs(rows()).withColumnRenamed("lang", "chunk").withColumnRenamed("source", "block")
    assert sorted((tuple(r) for r in piece_codec.codec_report(df).collect()), key=order) == want


def test_any_block_size(spark, docs):
    m = model()
    want = sorted((brute(m, *r) for r in rows(9)), key=order)
    for size in (1, 5000):
        got = piece_codec.encode_decode(docs(rows(9)).repartition(3), block_bytes=size).collect()
        have = [(r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in got]
        assert sorted(have, key=order) == want


def test_each_chunk_of_a_block_is_segmented_once(monkeypatch):
    pieces, asked = piece_codec.Pieces(piece_codec.model_path()), []
    real = pieces.segment
    monkeypatch.setattr(pieces, "segment", lambda chunks: asked.extend(chunks) or real(chunks))
    piece_codec.encode_block(pieces, [b"the same words again"] * 500)
    assert sorted(asked) == [b" again", b" same", b" the", b" words"]


def test_more_chunks_than_in_one_call(spark, docs):
    text = " ".join(f"w{i}" for i in range(70_000))
    m = model()
    assert [tuple(r) for r in piece_codec.codec_report(docs([(1, text)])).collect()] == [brute(m, 1, text)]


def test_empty_table(spark, docs):
    assert piece_codec.codec_report(docs([])).count() == 0
