import hashlib
from collections import Counter, defaultdict

from tessera.llm import cross_align as X
from tests.llm import test_piece_codec

ODD = [None, "", " ", "  ", " a", "a ", "\n", "a\n b", "a\n  b", "a \n  b", "\n\n b  c", "a\xa0 b", "a　   b", "a\x85 b", "▁", "fine and▁not fine",
       "<|endoftext|> x <s></s>", "don't we'll ' s", "日本語 текст 😀x é", "a\x00b", "x" * 2000, "1234567 12 3", "tab\t  tab", "…  … ” “"]


def encoders():
    t = X.TwoTokenizers(X.byte_model_path(), X.model_path())
    return t


def brute_tokens(t, text):
    """(A ids, B ids, groups, links) by the bytes, token by token."""
    if not text:
        return [], [], [], []
    full = b" " + text.encode()
    a, b = t.a.encode(" " + text, add_special_tokens=False).ids, t.b.model.encode(text)
    if b"".join(t.a_bytes[i] for i in a) != full or b"".join(t.b_bytes[i] for i in b) != full:
        return [], [], [], []
    spans = []
    for ids, size in ((a, t.a_len), (b, t.b_len)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + int(size[i])))
            at += int(size[i])
        spans.append(out)
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, lo, i, k = [], 0, 0, 0
    for c in cuts:
        j, m = i, k
        while j < len(a) and spans[0][j][1] <= c:
            j += 1
        while m < len(b) and spans[1][m][1] <= c:
            m += 1
        groups.append((a[i:j], b[k:m]))
        i, k = j, m
    links, k = [], 0
    for i, (s, e) in enumerate(spans[0]):
        while spans[1][k][1] <= s:
            k += 1
        m = k
        while m < len(b) and spans[1][m][0] < e:
            links.append((a[i], b[m]))
            m += 1
    return a, b, groups, links


def brute(t, rows):
    got = [(i, *brute_tokens(t, text)) for i, text in rows]
    count = Counter(p for *_, links in got for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for i, a, b, groups, links in got:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def order(r):
    return (r[0] is None, r[0] or 0, r[7])


def rows():
    base = [t for _, t in test_piece_codec.rows(8)]
    clean = [t.replace("▁", "_") if t and i % 2 else t for i, t in enumerate(base)]
    return list(enumerate(ODD + clean)) + [(3, "same row"), (3, "same row"), (None, "no id")]


def test_report_equals_brute_force(spark, docs):
    want = sorted(brute(encoders(), rows()), key=order)
    df = docs(rows()).withColumnRenamed("lang", "codes").withColumnRenamed("source", "Pair")
    for size, parts in ((1, 2), (3000, 3), (X.BLOCK_BYTES, 1)):
        got = X.alignment_report(df.repartition(parts), block_bytes=size).collect()
        assert sorted((tuple(r) for r in got), key=order) == want


def test_pointer_jumping_finds_the_groups_of_long_chains():
    import numpy as np
    a, b = np.arange(2, 2002, 2), np.append(np.arange(1, 2001, 2), 2000)       # interleaved: one group of 2,001 tokens
    la, lb = X.group_labels(a, b)
    assert set(la) == set(lb) == {len(a) - 1}
    i, j = X.overlaps(a, np.full(len(a), 2), b)
    assert list(zip(i, j)) == [(k, m) for k in range(len(a)) for m in (k, k + 1)]


def test_align_gives_the_groups(spark, docs):
    t = encoders()
    text = "An unalignable Tokenization, naïvely"
    got = X.align(docs([(1, text)])).collect()
    _, _, groups, _ = brute_tokens(t, text)
    assert [r.groups for r in got] == [";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)]


def test_empty_table(spark, docs):
    assert X.alignment_report(docs([])).count() == 0


def test_both_ways_through_tokenizer_a_agree():
    """Every character below U+0250, and U+2028 and the like beside them, in several places of a chunk."""
    t = encoders()
    chars = [chr(c) for c in [*range(1, 0x250), 0x2028, 0x3000, 0x661, 0x4E00, 0x1F600] if chr(c) != " "]
    chunks = [f" {x}".encode() for c in chars for x in (c, f"a{c}", f"{c}b", f"1{c}2", f"a{c}s", f"'{c}", f"-{c}{c}-", f"{c}\n{c}")] + [b" " + b"ab" * 5000, b" don't", b" we'll's"]
    ids, n = t.encode_a(chunks)
    want = [t.a.encode(c.decode(), add_special_tokens=False).ids for c in chunks]
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    assert sum(map(X.plain_chunk, chunks)) > len(chunks) * 0.9
