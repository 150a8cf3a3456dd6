import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import packing

ODD = ["Ábc é. <|endoftext|>x it's DON'T!! ½² №5 a.b,, ß ẞ İ x y z \x85q \x1c a\x1cb ª.º × ÷. a× . ́a. á. Á́.,",
       "", None, " \t\n ", "The the THE the. The, the.,. naïve", "日本語 текст 한국어 😀 word😀word", "x" * 5000, "1 22 333 4a a4",
       "don't can't we'll I'm 'tis", "a b c　d", "ǅ ŉ ﬁ Å Ω"]


def plain(text):
    from tokenizers import Tokenizer
    tok = plain.tok = getattr(plain, "tok", None) or Tokenizer.from_file(packing.tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids


def texts(n=60, seed=2):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghéèüñß") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    mk = lambda: rng.choice(vocab).capitalize() + rng.choice(["", "", ".", ",", "!", ".\n", "-x"])
    return ODD + [" ".join(mk() for _ in range(rng.randint(1, 3000))) for _ in range(n)]


def test_ids_equal_the_tokenizers_for_any_memory():
    sample = texts()
    want = [plain(t) for t in sample]
    for limit in (1, 50, 400_000):
        tok = packing.ChunkTokenizer(packing.tokenizer_path(), limit)
        for step in (1, 7, 100):
            got = [x.tolist() for i in range(0, len(sample), step) for x in tok.ids([(t or "").encode() for t in sample[i:i + step]])]
            assert got == want
    long = "Some words, and more. " * 400_000
    assert packing.ChunkTokenizer(packing.tokenizer_path()).ids([b"a", long.encode(), b"b"])[1].tolist() == plain(long)


def test_pieces_are_powers_of_two():
    for n in (1, 2, 3, 4095, 4096, 4097, 12345):
        got = packing.piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 4096 for x in got) and got == sorted(got, reverse=True)
        assert len([x for x in got if x < 4096]) == len({x for x in got if x < 4096})


def test_every_id_in_one_piece_and_sequences_hold_one_document(spark, docs):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, ODD[0]), (None, "null id doc"), (5000, "word " * 20_000)]
    got = packing.pack(docs(rows), with_ids=True).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 for r in got)
    by_len = {}
    for r in got:
        by_len.setdefault(r.length, []).append(r.sequence_id)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    assert all(max(v) - min(v) == len(v) - 1 for v in by_len.values())
    want = sorted((str(i), tuple(plain(t) + [2])) for i, t in rows)
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, tuple(r.ids)))
    have = []
    for (i, n), p in pieces.items():
        copies = [x for x in p if x[0] == 0]
        starts = sorted(p)
        per = len(p) // len(copies)
        for c in range(len(copies)):
            ids = sum((x[1] for x in starts[c::len(copies)]), ())
            have.append((str(i), ids))
        assert per * len(copies) == len(p)
    assert sorted(have) == want


def test_empty_table(spark, docs):
    assert packing.pack(docs([])).count() == 0


def test_extra_columns_of_the_plans_names(spark, docs):
    df = docs([(1, "some words"), (2, None)])
    clash = df.withColumns({"RID": F.lit(1), "part": F.lit(2), "local": F.lit(3), "length": F.lit("x"), "IDS": F.lit(4), "before": F.lit(5)})
    assert sorted(packing.pack(clash, with_ids=True).collect()) == sorted(packing.pack(df, with_ids=True).collect())
