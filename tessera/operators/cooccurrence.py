"""Sums over the pairs of items that share a user, without a shuffled row per pair.

A user's n items make n (n - 1) / 2 pairs, so rows of pairs are far more than the input.
What is shuffled here are the users' lists:

1. the entries of a user become one list; a user of very many is cut into pieces, and each pair of
   pieces is a cell of its own (``sized_join``'s grid);
2. a batch of lists is dealt to blocks of items: a block gets, for each of its items i, the part of the list
   behind i as steps from item to item, in as few bytes as the numbers need (``pack``): some 2 to 4 for a pair;
3. a block's pairs are summed at once: it holds about ``BLOCK_PAIRS`` of them, whatever the input's size.
   An item of more pairs than that is dealt to several blocks by its partner.

The number of blocks follows the number of pairs, so a task's memory does not.  A caller that keeps little of the sums
can have them in parts, each of some items' pairs (``pair_sum_parts``), one after the other, so the disk does not either.

``pair_meetings`` sums the same way over the entries that an index lists, and a block keeps only the pairs that
a bound from both items' codes leaves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import PIECE_ROWS, row_salt
from tessera.session import shared_table

#: Pairs summed at once by a task, and dealt at once.
BLOCK_PAIRS = 1 << 20
DEAL_PAIRS = 1 << 22
#: Pairs of one part of ``pair_sum_parts``.
PART_PAIRS = 1 << 29

_FIELDS = ("i", "a", "len", "o", "d", "b", "fa", "fb", "xa", "xb")
_FIRST = ("i", "a", "fa", "xa")           # a value per entry; the others, but steps, have one per pair


# -- numbers in few bytes --------------------------------------------------------

def pack(a: np.ndarray, base: int | None = None) -> bytes:
    """Numbers as offsets from the least one (or ``base``) in as many bytes as the largest needs, fractions as they are;
    compressed, as a byte rarely takes all its values."""
    data = _packed(a, base)
    small = pa.compress(data, codec="zstd", asbytes=True) if len(data) > 64 else data
    return b"z" + len(data).to_bytes(8, "little") + small if len(small) + 9 < len(data) else data


def _packed(a: np.ndarray, base: int | None) -> bytes:
    kind = b"i"
    if a.dtype.kind == "f":
        if not (np.abs(a) < 2.0 ** 53).all() or (a != np.trunc(a)).any() or np.signbit(a[a == 0]).any():
            return b"f" + a.astype("<f8").tobytes()
        kind, a = b"w", a.astype("<i8")
    if not len(a):
        return kind
    a = a.astype("<i8", copy=False)
    base = int(a.min()) if base is None else base
    width = max(1, ((int(a.max()) - base).bit_length() + 7) // 8)
    offsets = a.view("<u8") - np.uint64(base & (2 ** 64 - 1))
    return kind + bytes([width]) + base.to_bytes(8, "little", signed=True) + offsets.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"z":
        data = pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), codec="zstd", asbytes=True)
    if data[:1] == b"f":
        return np.frombuffer(data, "<f8", offset=1)
    if len(data) == 1:
        return np.empty(0, "<f8" if data == b"w" else "<i8")
    width, base = data[1], int.from_bytes(data[2:10], "little", signed=True)
    planes = np.frombuffer(data, np.uint8, offset=10).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    a = (wide.view("<u8").ravel() + np.uint64(base & (2 ** 64 - 1))).view("<i8")
    return a.astype("<f8") if data[:1] == b"w" else a


def block_of(items: np.ndarray, blocks: int, salt=0) -> np.ndarray:
    """Block of each item: a mixing of all its bits."""
    h = items.astype("<i8").view("<u8") + np.asarray(salt, "<u8") * np.uint64(0x9E3779B97F4A7C15)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(blocks)).astype("<i8")


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of every range, one after the other."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


# -- dealing ---------------------------------------------------------------------

def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return np.diff(column.offsets.to_numpy()), column.flatten()


def _values(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, 1 where there is one): nulls as 0."""
    has = flat.is_valid().to_numpy(zero_copy_only=False)
    return flat.fill_null(0).to_numpy(zero_copy_only=False), has.astype("<i8")


def _rows(p, e, length, at, o):
    """A row per block of entries ``e`` = (i, a, fa, xa), in any order, with the lists behind them: places ``at`` of
    ``o`` = (j, b, fb, xb).  Codes xa, xb may be missing."""
    order = np.argsort(p, kind="stable")
    at = at[_ranges((np.cumsum(length) - length)[order], length[order])]
    p, length = p[order], length[order]
    i, a, fa, xa = (None if c is None else c[order] for c in e)
    j, b, fb, xb = (None if c is None else c[at] for c in o)
    cut = np.flatnonzero(np.diff(p, prepend=-1))
    ends, stops = np.append(cut[1:], len(p)), np.append(0, np.cumsum(length))
    whole = bool(fa.all() and fb.all())
    first = stops[:-1]                           # a list goes up from its first item, in steps
    per_entry = {"i": i, "a": a, "len": length, "o": j[first] - i, "fa": fa, "xa": xa}
    per_pair, steps = {"b": b, "fb": fb, "xb": xb}, np.delete(np.diff(j, prepend=j[:1]), first)
    out = {c: [] for c in _FIELDS}
    for s, t in zip(cut, ends):
        ps, pt = stops[s], stops[t]
        for c in _FIELDS:
            x = (steps[ps - s:pt - t] if c == "d" else per_entry[c][s:t] if c in per_entry and per_entry[c] is not None
                 else per_pair[c][ps:pt] if per_pair.get(c) is not None else None)
            out[c].append(b"" if x is None or (whole and c in ("fa", "fb")) else pack(x, 0 if c in ("xa", "xb") else None))
    return pa.RecordBatch.from_pydict({"item_i_block": pa.array(p[cut], pa.int32()), **{c: pa.array(out[c], pa.binary()) for c in _FIELDS}})


def _take(side, mask):
    """The entries of a side that the mask leaves, with the lists' lengths then."""
    cell, entry, n = side
    return cell[mask], tuple(None if c is None else c[mask] for c in entry), np.bincount(cell[mask], minlength=len(n))


def _deal(blocks: int, hot: dict[int, int], either: bool = False, part: int = 0, parts: int = 1):
    """Cells -> packed rows by block.  A cell without second lists pairs its list with itself.

    ``either``: pairs of which at least one entry is marked (``p``).  ``part``: of the items of this part alone."""
    hot_ids = np.array(sorted(hot), "<i8")
    hot_pieces = np.array([hot[x] for x in sorted(hot)], "<i8")

    def emit(e, start, length, o):
        """Entries ``e``, each with a range of ``o``."""
        if parts > 1:
            mine = block_of(e[0], parts, 1 << 31) == part
            e, start, length = tuple(None if c is None else c[mine] for c in e), start[mine], length[mine]
        bounds, i = np.cumsum(length), e[0]
        lo = 0
        while lo < len(i):
            hi = max(lo + 1, int(np.searchsorted(bounds, (bounds[lo - 1] if lo else 0) + DEAL_PAIRS, side="right")))
            s, n = start[lo:hi], length[lo:hi]
            x = tuple(None if c is None else c[lo:hi] for c in e)
            is_hot = np.isin(x[0], hot_ids) if len(hot_ids) else np.zeros(len(n), bool)
            for some in (np.flatnonzero(~is_hot & (n > 0)), np.flatnonzero(is_hot & (n > 0))):
                if not len(some):
                    continue
                at = _ranges(s[some], n[some])
                if is_hot[some[0]]:          # a row per pair: its block is the partner's as well
                    pairs = np.repeat(some, n[some])
                    pieces = hot_pieces[np.searchsorted(hot_ids, x[0][pairs])]
                    salt = block_of(o[0][at], 1 << 30) % pieces
                    yield _rows(block_of(x[0][pairs], blocks, salt + 1), tuple(None if c is None else c[pairs] for c in x), np.ones(len(pairs), "<i8"), at, o)
                else:
                    yield _rows(block_of(x[0][some], blocks), tuple(None if c is None else c[some] for c in x), n[some], at, o)
            lo = hi

    def sides(batch, second):
        """(cell, (it, r, has, x), n) in order of cell and item, and the marks."""
        n, it = _flat(batch.column("it" + second))
        r, has = _values(_flat(batch.column("r" + second))[1])
        cell = np.repeat(np.arange(len(n)), n)
        it = it.to_numpy(zero_copy_only=False)
        order = np.lexsort((it, cell))
        more = [_flat(batch.column(c + second))[1].to_numpy(zero_copy_only=False)[order] if c + second in batch.schema.names else None for c in ("x", "p")]
        return (cell[order], (it[order], r[order], has[order], more[0]), n), more[1]

    def behind(cell, it, other_cell, other_it, other_n):
        """Where each entry's larger items begin and end in the other lists (sorted by cell and item)."""
        ends = np.cumsum(other_n)
        both = np.lexsort((np.append(np.zeros(len(other_it), "i1"), np.ones(len(it), "i1")), np.append(other_it, it), np.append(other_cell, cell)))
        first = np.empty(len(both), "<i8")
        first[both] = np.cumsum(both < len(other_it))       # items of the other lists up to and with this one
        start = first[len(other_it):]
        return start, ends[cell] - start

    def meet(one, two):
        """Entries of one side with the larger items of the other."""
        (cell, e, _), (cell2, o, n2) = one, two
        yield from emit(e, *behind(cell, e[0], cell2, o[0], n2), o)

    def run(batches):
        for batch in batches:
            alone = pa.compute.is_null(batch.column("it2")).to_numpy(zero_copy_only=False)
            for mask, second in ((alone, ""), (~alone, "2")):
                if not mask.any():
                    continue
                some = batch.filter(pa.array(mask))
                one, p = sides(some, "")
                two, p2 = sides(some, second) if second else (one, p)
                for x, px, y, py in ((one, p, two, p2), (two, p2, one, p))[:2 if second else 1]:      # and the other way round
                    if either:
                        yield from meet(_take(x, px), y)
                        yield from meet(_take(x, ~px), _take(y, py))
                    else:
                        yield from meet(x, y)
    return run


# -- summing ---------------------------------------------------------------------

def _sum(combine: str, min_common: int, keep=None):
    def run(table: pa.Table) -> pa.Table:
        parts = {c: [] for c in _FIELDS}
        for row in zip(*(table.column(c).to_pylist() for c in _FIELDS)):
            n = unpack(row[2])
            pairs = int(n.sum())
            for c, data in zip(_FIELDS, row):
                if c in ("len", "o"):
                    continue
                x = np.ones(len(n) if c in _FIRST else pairs, "<i8") if data == b"" and c != "d" else unpack(data)
                if c == "d":
                    first, up = np.cumsum(n) - n, np.zeros(pairs, "<i8")
                    up[np.delete(np.arange(pairs), first)] = x
                    up = np.cumsum(up)
                    x = up + np.repeat(unpack(row[3]) - up[first], n)
                parts[c].append(np.repeat(x, n) if c in _FIRST else x)
        i, a, d, b, fa, fb = (np.concatenate(parts[c]) for c in ("i", "a", "d", "b", "fa", "fb"))
        j = i + d
        low_i, low_j = int(i.min()), int(j.min())
        span = int(j.max()) - low_j + 1
        if (int(i.max()) - low_i + 1) * span < 2 ** 63:
            order = np.argsort((i - low_i) * span + (j - low_j))
        else:
            order = np.lexsort((j, i))
        i, j, a, b, fa, fb = i[order], j[order], a[order], b[order], fa[order], fb[order]
        if combine == "product":
            v, has = a * b, fa & fb
        else:                                               # a null is left out of the least, as in SQL
            v, has = np.where(fa & fb, np.fmin(a, b), np.where(fa, a, b)), fa | fb
        first = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        n = np.diff(np.append(first, len(i)))
        total, known = np.add.reduceat(np.where(has, v, 0.0), first), np.add.reduceat(has, first)
        if keep is None:
            some = n >= min_common
        else:                                               # a code is the item's: that of the first row is every row's
            xa, xb = (np.concatenate(parts[c])[order[first]] for c in ("xa", "xb"))
            some = keep(total, n, xa, xb)
        return pa.table({"i": i[first][some], "j": j[first][some], "n": n[some].astype("<i8"),
                         "v": pa.array(total[some], mask=known[some] == 0)}).select(["i", "j", "v", "n"])
    return run


def pair_sums(entries: DataFrame, combine: str = "product", piece_rows: int = PIECE_ROWS, min_common: int = 1,
              block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Entries (k, it, r) -> ``(i < j, v, n)``: over the k that have both, the sum of the products (or of the lesser
    values: ``combine`` 'least') and the number of common rows, where that is at least ``min_common``.

    Rows without k or item make no pair; a null value makes its products null, which a sum leaves
    out.  Repeated entries are so many rows.  The entries are read twice: store them first.
    """
    if combine not in ("product", "least"):
        raise ValueError(f"combine {combine!r}: 'product' or 'least'")
    return _summed(entries.select("k", "it", "r"), _sum(combine, min_common), piece_rows, block_pairs)[0]


def pair_sum_parts(entries: DataFrame, combine: str = "product", piece_rows: int = PIECE_ROWS, min_common: int = 1,
                   block_pairs: int = BLOCK_PAIRS) -> list[DataFrame]:
    """``pair_sums`` in parts of about ``PART_PAIRS`` pairs: each has all pairs of its items i.  Whoever writes what it keeps
    of one before it reads the next has the packed lists of one part on disk."""
    if combine not in ("product", "least"):
        raise ValueError(f"combine {combine!r}: 'product' or 'least'")
    return _summed(entries.select("k", "it", "r"), _sum(combine, min_common), piece_rows, block_pairs, part_pairs=PART_PAIRS)


def pair_meetings(entries: DataFrame, keep, either: bool = False, piece_rows: int = PIECE_ROWS,
                  block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Entries (k, it, r, x) -> ``(i < j, v, n)`` as ``pair_sums`` of products, of the pairs that ``keep`` leaves.

    ``x`` is a whole number from 0, the same for all entries of an item, best of whole bytes (each is a run of its own
    in the packed rows, and those that hardly differ are compressed); ``keep(v, n, x_i, x_j)`` gets a block's pairs
    as arrays and says which stay.  ``either``: entries have a mark ``p``, and two that are both without it do not meet.
    """
    return _summed(entries.select("k", "it", "r", "x", *(["p"] if either else [])), _sum("product", 1, keep), piece_rows, block_pairs, either)[0]


def _summed(entries: DataFrame, run, piece_rows: int, block_pairs: int, either: bool = False, part_pairs: int | None = None) -> list[DataFrame]:
    spark = entries.sparkSession
    r = (entries.withColumns({"it": F.col("it").cast("long"), "r": F.col("r").cast("double")}).where("k is not null and it is not null"))
    values = [c for c in r.columns if c != "k"]
    cuts = shared_table(r.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > piece_rows)
                        .select("k", F.ceil(F.col("_n") / piece_rows).cast("int").alias("pieces")), "cut-keys")
    dealt = r.withColumn("_s", row_salt(r, 1 << 30)).join(cuts, "k", "left").withColumn("c", F.pmod("_s", F.coalesce("pieces", F.lit(1))))
    lists = shared_table(dealt.groupBy("k", "c").agg(F.collect_list(F.struct(*values)).alias("e"), F.max("pieces").alias("pieces")), "user-lists")
    # a user's pairs per entry: its number of rows, of which the pieces hold equal shares
    about = F.size("e").cast("long") * F.coalesce("pieces", F.lit(1))
    pairs = lists.agg(F.sum(F.size("e") * about)).head()[0] or 0
    parts = int(max(1, -(-pairs // (2 * part_pairs)))) if part_pairs else 1
    blocks = int(max(2, -(-pairs // (2 * block_pairs * parts))))
    hot = (lists.select(F.explode("e.it").alias("it"), about.alias("w")).groupBy("it").agg(F.sum("w").alias("w"))
           .where(F.col("w") > block_pairs).select("it", F.ceil(F.col("w") / block_pairs).cast("long").alias("pieces")))
    hot_items = {x["it"]: x["pieces"] for x in hot.collect()}     # all weights sum to ``pairs``: at most 2 x blocks items
    firsts = [F.col(f"e.{c}").alias(c) for c in values]
    seconds = [F.col(f"e.{c}").alias(f"{c}2") for c in values]
    none = [F.lit(None).cast(lists.select(x).schema[0].dataType).alias(f"{c}2") for c, x in zip(values, firsts)]
    own = lists.select(*firsts, *none)
    cells = own
    if cuts.limit(1).count():
        x = lists.where("pieces is not null").select("k", F.col("c").alias("c1"), *firsts)
        y = lists.where("pieces is not null").select("k", F.col("c").alias("c2"), *seconds)
        cells = own.unionByName(x.join(y, "k").where("c1 < c2").select(*own.columns))
    schema = "item_i_block int, " + ", ".join(f"{c} binary" for c in _FIELDS)

    def part_of(part):
        packed = cells.mapInArrow(_deal(blocks, hot_items, either, part, parts), schema)
        return packed.repartition(blocks, "item_i_block").groupBy("item_i_block").applyInArrow(run, "i long, j long, v double, n long")
    return [part_of(part) for part in range(parts)]
