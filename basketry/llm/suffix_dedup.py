"""Exact-substring dedup: suffixes sorted by prefix hashes, among the places that can repeat at all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import bounded_slices, quoted, ship_package
from basketry.session import stage

#: Bytes of a string that must not repeat, unless a caller names another length.
LENGTH = 400
#: Bytes an anchor is chosen by.
GRAM = 64
#: Texts are worked on in pieces of about so many bytes.
PIECE = 1 << 20
#: Different surroundings of one anchor that are sorted in one task; anchors with more are cut up by hash first.
SORTED = 512
#: Strings a cut has.
CUT = 16

_BASE = 0x9E3779B97F4A7C15
#: Stands for a null id in keys.
_NO_ID = -(1 << 63)
_SPAN = "k1 long, k2 long, lo long, hi long"
_ROOM = PIECE + 64 * 1024
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 to the 64."""
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(max(n, _ROOM), base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes; the hash of any piece is a difference of two, brought to one place."""
    powers, _ = _power_tables(len(data) + 1)
    hashes = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=hashes[1:])
    return hashes


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _piece_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _power_tables(len(hashes))
    return _mix((hashes[ends] - hashes[starts]) * inverse[starts])


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Cut the strings of ``length`` bytes of several texts into runs that share an anchor.

    ``data`` holds the texts side by side, ``ends`` where each ends. A string's anchor is the piece of ``GRAM`` bytes
    in it with the lowest hash, the first of equal ones: it depends on the string alone, so equal strings have it
    at the same distance. Per run: hash of the anchor's piece, hash of all bytes the run's strings cover together
    with the anchor's distance, first and last start, place of the anchor.
    """
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    hashes = prefix_hashes(data)
    n_grams = len(data) - GRAM + 1
    places = np.arange(n_grams, dtype=np.uint64)
    grams = _piece_hashes(hashes, places.astype(np.int64), places.astype(np.int64) + GRAM)
    low = np.uint64(n_grams.bit_length())
    keys = (grams >> low << low) | places
    # The least of each window, from the least so far forwards and backwards in blocks of the window's size.
    window = length - GRAM + 1
    padded = np.concatenate((keys, np.full(-n_grams % window, ~np.uint64(0)))).reshape(-1, window)
    forwards = np.minimum.accumulate(padded, 1).ravel()
    backwards = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    n = len(data) - length + 1
    least = np.minimum(backwards[:n], forwards[window - 1 : window - 1 + n])
    at = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    own_end = np.repeat(ends, np.diff(ends, prepend=0))[:n]
    starts = np.flatnonzero(np.arange(n) + length <= own_end)  # no string crosses the end of its text
    if not len(starts):
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    at = at[starts]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(starts) != 1))))
    last = np.concatenate((first[1:], [len(starts)])) - 1
    s, e, a = starts[first], starts[last], at[first]
    around = _piece_hashes(hashes, s, e + length) ^ _mix(((a - s) << 16 | (e - s)).astype(np.uint64))
    return grams[a], around, s, e, a


def _pieces(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """Texts side by side, up to ``PIECE`` bytes, longer ones cut so that every string is in one piece.

    Per piece: bytes, ends, and of each text in it: row, place in the text, length.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[start : start + PIECE + length - 1]
            if len(part) < length:
                continue
            held.append((part, (row, start, len(part))))
            size += len(part)
            if size >= PIECE:
                yield _side_by_side(held)
                held, size = [], 0
    if held:
        yield _side_by_side(held)


def _side_by_side(held: list) -> tuple:
    data = np.frombuffer(b"".join(part for part, _ in held), np.uint8)
    return data, np.cumsum([len(part) for part, _ in held]), [at for _, at in held]


def _batch(values: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], names)


def _anchor_batches(length: int):
    """``run``: first start of a run and how many more it has, in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, 2, PIECE):
                k1, k2 = part.column(0).to_numpy(), part.column(1).to_numpy()
                for data, ends, places in _pieces(part.column(2).to_pylist(), length):
                    h, c, s, e, a = anchors(data, ends, length)
                    which = np.searchsorted(ends, s, side="right")
                    begins = np.concatenate(([0], ends[:-1]))[which]
                    row = np.array([p[0] for p in places])[which]
                    at = np.array([p[1] for p in places])[which] + s - begins
                    values = [h.view(np.int64), c.view(np.int64), k1[row], k2[row], at << 16 | (e - s)]
                    yield _batch(values, ["h", "c", "k1", "k2", "run"])

    return run


def _context_batches(length: int):
    """The bytes of the wanted runs of each text."""
    names = ["g", "hot", "known", "k1", "k2", "lo", "n", "offset", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, 2, PIECE):
                out: list[list] = [[] for _ in names]
                for k1, k2, text, wanted in zip(*(part.column(i).to_pylist() for i in range(4))):
                    for w in wanted:
                        start, n = w["run"] >> 16, (w["run"] & 0xFFFF) + 1
                        data = text[start : start + n - 1 + length]
                        # All strings of a run have one anchor, so it is that of the first.
                        values = (w["h"], w["hot"], w["known"], k1, k2, start, n, _anchor_of(data, length), data)
                        for column, value in zip(out, values):
                            column.append(value)
                    if len(out[0]) >= 2000:
                        yield _contexts(out, names)
                        out = [[] for _ in names]
                if out[0]:
                    yield _contexts(out, names)

    return run


def _anchor_of(data: bytes, length: int) -> int:
    return int(anchors(np.frombuffer(data[:length], np.uint8), np.array([length]), length)[4][0])


def _contexts(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return _batch([pa.array(v, k) for v, k in zip(out, kinds)], names)


_CONTEXT = "g long, hot boolean, known boolean, k1 long, k2 long, lo long, n long, offset long, data binary"


class _Suffixes:
    """Suffixes of a buffer, compared over their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.length = length
        self.data, self.hashes = data, prefix_hashes(data)
        self.powers, _ = _power_tables(len(data) + 1)

    def _agree(self, x: np.ndarray, y: np.ndarray, size) -> np.ndarray:
        left = (self.hashes[x + size] - self.hashes[x]) * self.powers[y]
        return left == (self.hashes[y + size] - self.hashes[y]) * self.powers[x]

    def same(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Equal strings: by hash, then byte by byte, as hashes may collide."""
        found = self._agree(x, y, self.length)
        at = np.flatnonzero(found)
        reach = np.arange(self.length)
        for i in range(0, len(at), 2048):
            some = at[i : i + 2048]
            found[some] = (self.data[x[some, None] + reach] == self.data[y[some, None] + reach]).all(axis=1)
        return found

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether x sorts before y, or is equal where that counts: the common extension is found by bisection."""
        equal = self._agree(x, y, self.length)
        out = or_equal & equal
        rest = np.flatnonzero(~equal)
        x, y = x[rest], y[rest]
        low, high = np.zeros(len(rest), np.int64), np.full(len(rest), self.length, np.int64)
        while len(rest) and (high - low > 1).any():  # they agree in the first ``low`` bytes, not in ``high``
            middle = (low + high) // 2
            agree = self._agree(x, y, middle)
            low, high = np.where(agree, middle, low), np.where(agree, high, middle)
        out[rest] = self.data[x + low] < self.data[y + low]
        return out

    def sort(self, at: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mergesort of every segment of ``at``, all segments and all pairs of runs at a time."""
        at = at.copy()
        segment = np.repeat(begins, sizes)
        own = np.arange(len(at)) - segment
        size = np.repeat(sizes, sizes)
        width = 1
        while width < (sizes.max() if len(sizes) else 0):
            run = own // width
            other = run ^ 1
            low = np.minimum(other * width, size)
            high = np.minimum(low + width, size)
            moving = np.flatnonzero(high > low)  # the others have no run to merge with
            x, second = at[moving], (run[moving] & 1).astype(bool)
            lo, hi, base = low[moving].copy(), high[moving].copy(), segment[moving]
            while (open_ := np.flatnonzero(lo < hi)).size:
                middle = (lo[open_] + hi[open_]) // 2
                y = at[base[open_] + middle]
                # Of equal ones those of the first run come first, which keeps the sort stable.
                passed = self.before(y, x[open_], second[open_])
                lo[open_] = np.where(passed, middle + 1, lo[open_])
                hi[open_] = np.where(passed, hi[open_], middle)
            target = np.arange(len(at))
            target[moving] = base + np.minimum(run[moving], other[moving]) * width + (own[moving] % width) + (
                lo - low[moving]
            )
            merged = at.copy()
            merged[target] = at
            at = merged
            width *= 2
        return at


def repeated_starts(
    groups: np.ndarray,
    offsets: np.ndarray,
    counts: np.ndarray,
    texts: list[bytes],
    length: int = LENGTH,
    order_of: np.ndarray | None = None,
) -> list[np.ndarray]:
    """Which of the first ``counts`` strings of each text equal one of another text of its group.

    ``offsets``: how far behind its first string's start a text's anchor lies. Only strings with their anchor at the
    same distance can be equal, so those are sorted together and compared with their neighbours. ``order_of``: if
    given, a number for each text, and of equal strings that of the text with the least one is not marked.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1])).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, distance, group = begins[row] + step, offsets[row] - step, groups[row]
    order = np.lexsort((at, distance, group))
    group, distance = group[order], distance[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(group) != 0) | (np.diff(distance) != 0))))
    sizes = np.diff(np.concatenate((new, [len(order)])))
    keep = np.repeat(sizes > 1, sizes)
    order, sizes = order[keep], sizes[sizes > 1]
    found = np.zeros(len(row), bool)
    if len(order):
        suffixes = _Suffixes(data, length)
        firsts = np.cumsum(sizes) - sizes
        pair = np.repeat(sizes == 2, sizes)  # two need no order
        many = sizes > 2
        sorted_at = at[order]
        if many.any():
            sorted_at[~pair] = suffixes.sort(at[order][~pair], np.cumsum(sizes[many]) - sizes[many], sizes[many])
        which = np.searchsorted(begins, sorted_at, side="right") - 1
        place = np.cumsum(counts)[which] - counts[which] + sorted_at - begins[which]
        neighbours = np.setdiff1d(np.arange(len(order) - 1), firsts[1:] - 1, assume_unique=True)
        equal = neighbours[suffixes.same(sorted_at[neighbours], sorted_at[neighbours + 1])]
        found[place[equal]] = True
        found[place[equal + 1]] = True
        if order_of is not None:
            # Equal strings are neighbours; a class begins where a string differs from the one before it.
            begins_class = np.ones(len(order), bool)
            begins_class[equal + 1] = False
            rank = order_of[which]
            least = np.minimum.reduceat(rank, np.flatnonzero(begins_class))[np.cumsum(begins_class) - 1]
            found[place[rank == least]] = False
    return np.split(found, np.cumsum(counts)[:-1])


def _spans_of(found: np.ndarray, lo: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes covered by the strings that begin at the marked starts."""
    edges = np.diff(found.astype(np.int8), prepend=0, append=0)
    return lo + np.flatnonzero(edges == 1), lo + np.flatnonzero(edges == -1) - 1 + length


def _ranks(keys: list[np.ndarray]) -> np.ndarray:
    """Place of each row in the order of the keys; equal rows share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= np.diff(key[order]) != 0
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _sort_batches(length: int, keep_first: bool):
    """Groups arrive together; whole groups are sorted as soon as there are enough."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        g, n, offset = (rows.column(c).to_numpy() for c in ("g", "n", "offset"))
        order_of = None
        if keep_first:
            order_of = _ranks([rows.column(c).to_numpy() for c in ("k1", "k2", "lo")])
        marks = repeated_starts(g, offset, n, rows.column("data").to_pylist(), length, order_of)
        out: list[list] = [[], [], [], []]
        for found, known, k1, k2, lo in zip(marks, *(rows.column(c).to_pylist() for c in ("known", "k1", "k2", "lo"))):
            if not known and found.any():
                los, his = _spans_of(found, lo, length)
                for column, value in zip(out, ([k1] * len(los), [k2] * len(los), los.tolist(), his.tolist())):
                    column += value
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return _batch([pa.array(v, k) for v, k in zip(out, kinds)], ["k1", "k2", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for part in bounded_slices(batch, batch.schema.get_field_index("data"), PIECE // 4):
                rows = pa.Table.from_batches([part])
                held.append(rows)
                size += rows.nbytes
                if size < PIECE:
                    continue
                rows = pa.concat_tables(held).combine_chunks()
                g = rows.column("g").to_numpy()
                cut = int(np.searchsorted(-(g != g[-1]).astype(np.int8), 0)) if len(g) else 0
                if cut:
                    yield solve(rows.slice(0, cut))
                held, size = [rows.slice(cut)], rows.slice(cut).nbytes
        rows = pa.concat_tables(held).combine_chunks() if held else None
        if rows is not None and rows.num_rows:
            yield solve(rows)

    return run


def _cut_batches(width: int, length: int):
    """Strings of hot anchors, ``width`` at a time: hash of what all of a cut share, hash of all it covers."""
    names = ["g", "c", "known", "k1", "k2", "lo", "n", "offset", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, batch.schema.get_field_index("data")):
                rows = pa.Table.from_batches([part])
                texts = rows.column("data").to_pylist()
                lengths = np.array([len(t) for t in texts], np.int64)
                hashes = prefix_hashes(np.frombuffer(b"".join(texts), np.uint8))
                begins = np.cumsum(lengths) - lengths
                g, n, offset, lo = (rows.column(c).to_numpy() for c in ("g", "n", "offset", "lo"))
                # Strings with their anchor ``width * i`` to ``width * (i + 1) - 1`` bytes behind go to cut i.
                last = offset - n + 1
                cuts = offset // width - last // width + 1
                row = np.repeat(np.arange(len(texts)), cuts)
                i = (offset // width)[row] - (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
                start = np.maximum(0, offset[row] - (width * i + width - 1))
                end = np.minimum(n[row] - 1, offset[row] - width * i)
                anchor = begins[row] + offset[row]
                shared = _piece_hashes(hashes, anchor - width * i, anchor - width * i - width + 1 + length)
                whole = _piece_hashes(hashes, begins[row] + start, begins[row] + end + length)
                key = _mix(shared ^ _mix(g[row].view(np.uint64) + i.astype(np.uint64)))
                around = whole ^ _mix(((offset[row] - start) << 16 | (end - start)).astype(np.uint64))
                data = [texts[r][s : e + length] for r, s, e in zip(row.tolist(), start.tolist(), end.tolist())]
                values = [
                    key.view(np.int64), around.view(np.int64), rows.column("known").combine_chunks().take(pa.array(row)),
                    rows.column("k1").to_numpy()[row], rows.column("k2").to_numpy()[row], lo[row] + start,
                    end - start + 1, offset[row] - start, pa.array(data, pa.binary()),
                ]
                yield _batch(values, names)

    return run


_PART = "g long, c long, known boolean, k1 long, k2 long, lo long, n long, offset long, data binary"


def _classified(rows: DataFrame, name: str, by: str = "g", place: str = "lo") -> DataFrame:
    """Rows whose ``by`` is not alone, with ``alike``: whether all of them cover the same bytes, and ``first``: whether
    none of the group comes before it.

    The groups are written first. So the join reads both sides as plain shuffles, and adaptive execution splits
    the partition of a hot group.
    """
    where = F.struct("k1", "k2", place)
    groups = rows.groupBy(by).agg(
        F.count("*").alias("together"), F.min("c").alias("least"), F.max("c").alias("most"), F.min(where).alias("one")
    )
    some = groups.filter("together > 1").select(by, (F.col("least") == F.col("most")).alias("alike"), "one")
    found = rows.join(stage(some, name).hint("shuffle_merge"), by)
    return found.withColumn("first", where == F.col("one")).drop("one")


def repeated_spans(
    docs: DataFrame, sorted_limit: int = SORTED, length: int = LENGTH, keep_first: bool = False
) -> DataFrame:
    """``k1``, ``k2`` and the bytes ``lo`` to ``hi`` that repeated strings cover, from keys and ``data``, the bytes.

    ``sorted_limit``: surroundings of one anchor that are put into suffix order in one task. ``length``: bytes of a
    string. ``keep_first``: of equal strings, that with the least keys and place is not among them.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {length} bytes are too short for anchors of {GRAM}")
    runs = docs.mapInArrow(_anchor_batches(length), "h long, c long, k1 long, k2 long, run long")
    together = stage(_classified(runs, "anchors", "h", "run"), "runs")
    start, more = F.shiftright("run", 16), F.col("run").bitwiseAND(F.lit(0xFFFF))
    span = (start.alias("lo"), (start + more + length).alias("hi"))
    out = "alike and not first" if keep_first else "alike"
    alike = together.filter(out).select("k1", "k2", *span)

    # Anchors whose surroundings differ: the same surroundings again are one row, which only others are held against.
    # If the first of equal strings stays, that row is the first of its copies, and it is judged like one without copies.
    mixed = together.filter("not alike")
    one = F.struct("k1", "k2", "run")
    kinds = mixed.groupBy("h", "c").agg(F.count("*").alias("times"), F.min(one).alias("one"))
    kinds = stage(kinds.select("h", "c", (F.col("times") > 1).alias("known"), "one.*"), "surroundings")
    copied = kinds.filter("known").select("h", "c", one.alias("one")).hint("shuffle_merge")
    copies = mixed.select("h", "c", "k1", "k2", "run").join(copied, ["h", "c"])
    copies = (copies.filter(one != F.col("one")) if keep_first else copies).select("k1", "k2", *span)
    if keep_first:
        kinds = kinds.withColumn("known", F.lit(False))
    hot = stage(kinds.groupBy("h").count().filter(F.col("count") > sorted_limit).select("h"), "hot-anchors")
    marked = kinds.join(hot.withColumn("hot", F.lit(True)).hint("shuffle_merge"), "h", "left")
    wish = F.struct("h", "run", "known", F.coalesce("hot", F.lit(False)).alias("hot"))
    wanted = marked.groupBy("k1", "k2").agg(F.collect_list(wish).alias("wanted"))
    found = docs.join(wanted, ["k1", "k2"]).select("k1", "k2", "data", "wanted")
    contexts = stage(found.mapInArrow(_context_batches(length), _CONTEXT), "contexts")
    dealt = contexts.filter("not hot").repartition("g").sortWithinPartitions("g")
    sorted_spans = dealt.mapInArrow(_sort_batches(length, keep_first), _SPAN)

    # Hot anchors: cut by cut by hash, and what is still mixed string by string.
    whole = (F.col("lo"), (F.col("lo") + F.col("n") - 1 + length).alias("hi"))
    cuts = stage(contexts.filter("hot").mapInArrow(_cut_batches(CUT, length), _PART), "cuts")
    cuts = _classified(cuts, "cut-groups")
    strings = cuts.filter("not alike").drop("alike", "first").mapInArrow(_cut_batches(1, length), _PART).drop("data")
    strings = stage(strings, "strings")
    parts = [cuts.drop("data"), _classified(strings, "string-groups")]
    hot_spans = [rows.filter(f"{out} and not known").select("k1", "k2", *whole) for rows in parts]
    return alike.union(copies).union(sorted_spans).union(hot_spans[0]).union(hot_spans[1])


def _merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of what the spans cover."""
    runs: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if runs and lo <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], hi)
        else:
            runs.append((lo, hi))
    return runs


def _rest(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    begins, ends = [0, *[hi for _, hi in runs]], [*[lo for lo, _ in runs], len(data)]
    return b"".join(data[a:b] for a, b in zip(begins, ends))


def _remove_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in bounded_slices(batch, 1):
            texts = part.column(1).to_pylist()
            runs = [_merged(spans) for spans in part.column(2).to_pylist()]
            kept = [_rest(*pair) for pair in zip(texts, runs)]
            spans = [[{"lo": lo, "hi": hi} for lo, hi in r] for r in runs]
            values = [
                part.column(0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                pa.array([len(r) for r in runs], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ]
            yield _batch(values, ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def _keys(id_column: str, text_column: str) -> list[Column]:
    """Rows of one id with one text are alike in all that matters here, so these two tell rows apart."""
    text = F.coalesce(quoted(text_column), F.lit(""))
    return [
        F.coalesce(quoted(id_column).cast("long"), F.lit(_NO_ID).cast("long")).alias("k1"),
        F.xxhash64(text).alias("k2"),
        text.cast("binary").alias("data"),
    ]


def _with_spans(df: DataFrame, docs: DataFrame, *how) -> DataFrame:
    """``how``: as ``repeated_spans`` takes it."""
    spans = repeated_spans(docs, *how).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")
    )
    return df.join(spans, ["k1", "k2"], "left")


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", sorted_limit: int = SORTED
) -> DataFrame:
    """Remove every byte that a string of 400 bytes covers which starts anywhere else in the corpus too.

    Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``spans`` (those runs, from
    byte ``lo`` to before ``hi``) and ``kept``, the bytes that are left.

    Texts are bytes of UTF-8; strings never cross texts, and all are judged on the input. Every string has an
    anchor, its piece of the lowest hash; equal strings have equal anchors at equal distances, so only strings of
    equal anchors meet. Runs of strings with one anchor whose bytes are the same everywhere are settled by
    their hashes (128 bits). The others are put into suffix order: a mergesort whose comparisons find the common
    extension of two suffixes by bisection over prefix hashes; neighbours that agree are compared byte by byte.
    An anchor with more than ``sorted_limit`` different surroundings is cut up by hash instead, in counts that are
    combined before the shuffle, so nothing of it has to meet in one task.

    Texts are shuffled twice, once to fetch what is sorted and once to cut, and a task works on about a megabyte of
    them at a time. Null or short text: nothing is removed. Null ids stay null. Repeated rows repeat each other: all lose their strings. An empty table gives no
    rows; other columns are dropped, whatever their names.
    """
    ship_package(df.sparkSession)
    docs = df.select(*_keys(id_column, text_column))
    doc_id = F.when(F.col("k1") != _NO_ID, F.col("k1")).alias("doc_id")
    return _with_spans(docs, docs, sorted_limit).select(doc_id, "data", "spans").mapInArrow(
        _remove_batches,
        "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<lo:long,hi:long>>, kept binary",
    )


def drop_repeats(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size_column: str = "n_chars",
    sorted_limit: int = SORTED,
    length: int = LENGTH,
    keep_first: bool = False,
) -> DataFrame:
    """All rows and columns of ``df``, repeated strings taken out of the text, and its length counted anew.

    ``length``: bytes of a string, 128 at least. ``keep_first``: a string stays where it stands first, by id, then hash of the
    text, then place; without it every copy goes. Of a character that a removed run cuts, what is left goes too. A
    text that repeats itself at a short distance keeps what comes before its second copy. Rows of one id with one text
    stay alike: both keep the first copy. Other cases as in ``remove_repeats``; a text that consists of repeats is
    empty then.
    """
    ship_package(df.sparkSession)
    schema = df.schema
    at, size_at = schema.names.index(text_column), schema.names.index(size_column) if size_column in schema.names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded_slices(batch, at):
                columns = part.columns[:-1]
                texts = [(t or "").encode() for t in columns[at].to_pylist()]
                runs = [_merged(spans) for spans in part.column(len(columns)).to_pylist()]
                left = [_rest(*pair).decode("utf-8", "ignore") for pair in zip(texts, runs)]
                columns[at] = pa.array(left, columns[at].type)
                if size_at is not None:
                    columns[size_at] = pa.array([len(t) for t in left], pa.int64()).cast(columns[size_at].type)
                yield _batch(columns, schema.names)

    k1, k2, data = _keys(id_column, text_column)
    whole = df.select(F.struct(*[quoted(c) for c in schema.names]).alias("row"), k1, k2)
    joined = _with_spans(whole, df.select(k1, k2, data), sorted_limit, length, keep_first)
    return joined.select("row.*", F.col("spans").alias("spans of the row")).mapInArrow(run, schema)
