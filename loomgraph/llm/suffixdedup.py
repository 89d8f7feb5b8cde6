"""Exact substring dedup over a sparse suffix array with deep-shallow sorting.

Every byte covered by a LENGTH-byte string that also starts earlier (smaller doc_id, or same document and earlier start) goes.

1. Sampling. Of the GRAM-byte strings in each LENGTH-byte window, the one with the least hash, leftmost among equals, is the window's anchor. The choice depends
   on the window's content alone, so equal windows have equal anchors, at the same place within. Only suffixes at anchors (about one byte in 32) are sorted.
2. Classes. Anchors whose whole contexts (the windows they stand for) are equal form a class; all windows of all members but the first are repeats.
   Classes are first formed within a task, so that of a passage in many documents each task sends one row. Equality within an anchor's group is by a 64-bit BLAKE2 digest.
3. Deep-shallow sorting. Where classes share an anchor's hash, their suffixes from the anchor, and the reversed prefixes before it, are sorted: a multikey sort
   by eight-byte characters to a shallow depth, then blind tries for the groups that still share a prefix. The
   longest common prefixes of neighbours tell which windows agree at each distance from the anchor; all but the first of each are repeats.
4. An anchor hash with more than HOT classes in one task, or MANY in all, is spread: its windows are grouped by 128-bit BLAKE2 digests
   of their own instead, of which each task sends the first; minima are combined before the shuffle. So no group of unbounded size is held in a task.

Null texts count as empty. Rows without a doc_id are left out, or with without_id=True come after all others, each text a document of its own. Rows that repeat both an id and its text
count as one document and give a result each; different texts under one id are different documents, in the order of a hash of the text. Tables without rows give none. Columns
other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Documents, materialize, partitions, prepare
from loomgraph.plans.lineage import broadcast_if_small

LENGTH = 100
GRAM = 37
WINDOW = LENGTH - GRAM + 1  # 64 anchors to choose from
#: Bytes of text hashed at a time, and anchors of a task whose classes are formed at a time (about 250 bytes each while they are).
SEGMENT, TABLE = 1 << 17, 1 << 17
#: Windows of one text hashed at a time.
SLICE = 1 << 18
#: Classes of one anchor hash in one task beyond which its windows are grouped by their own hashes.
HOT = 64
#: Classes of one anchor hash in all tasks beyond which the same is done: their contexts, 163 bytes at most each, would have to meet in one task.
MANY = 1 << 14
#: Hot anchors whose windows a task holds at once.
HOT_ANCHORS = 50_000
#: Contexts that a task sorts or sends at a time, or more where one anchor hash has more.
PORTION = 1 << 14
#: Eight-byte characters of the multikey sort.
SHALLOW = 2

_rng = np.random.default_rng(20240229)
_BYTES = [_rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F]
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0 to n - 1 of the bases and of their inverses, modulo 2 ** 64."""
    if not _powers or len(_powers[0][0]) < n:
        size = 1 << max(n, SEGMENT).bit_length()
        up = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, dtype=np.uint64), dtype=np.uint64)])
        _powers[:] = [(up(b), up(pow(b, -1, 1 << 64))) for b in _BASES]
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Hashed:
    """Sums over a segment from which the hash of any of its substrings follows."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.pow = powers(self.n + 1)
        self.sums = []
        for k in range(2):
            s = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(_BYTES[k][data] * self.pow[k][0][: self.n], out=s[1:])
            self.sums.append(s)

    def raw(self, k: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[k][hi] - self.sums[k][lo]) * self.pow[k][1][lo]

    def grams(self, size: int) -> np.ndarray:
        s = self.sums[0]
        return mix((s[size:] - s[:-size]) * self.pow[0][1][: self.n + 1 - size])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """For documents laid end to end in data: anchor positions, their first and last window starts, their gram hashes, and the Hashed."""
    none = np.zeros(0, dtype=np.int64)
    hashed = Hashed(data)
    if len(data) < LENGTH:
        return none, none, none, none.view(np.uint64), hashed
    grams = hashed.grams(GRAM)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < WINDOW:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # windows that end within their document
    starts = np.concatenate([[0], ends[:-1]])
    fits = np.zeros(len(at) + 1, dtype=np.int32)
    long = ends - starts >= LENGTH
    np.add.at(fits, starts[long], 1)
    np.add.at(fits, ends[long] - LENGTH + 1, -1)
    inside = np.cumsum(fits[:-1]) > 0
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    old = np.empty(len(at), dtype=bool)
    old[-1] = True
    old[:-1] = (at[1:] != at[:-1]) | ~inside[1:]
    last = np.flatnonzero(old & inside)
    pos = at[first]
    return pos, first, last, grams[pos], hashed


def digests_of(raw: bytes, lo: np.ndarray, hi: np.ndarray, longs: int) -> np.ndarray:
    """Cryptographic digests of raw[lo:hi], as rows of so many 64-bit numbers."""
    size = 8 * longs
    return np.frombuffer(b"".join([hashlib.blake2b(raw[a:b], digest_size=size).digest() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]), dtype=np.uint64).reshape(-1, longs)


def contexts(raw: bytes, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each anchor's windows, with where it stands in them."""
    place = ((pos - lo) << 8 | (hi - lo)).astype(np.uint64)
    return digests_of(raw, lo, hi + LENGTH, 1)[:, 0] ^ place * np.uint64(0x9FB21C651E98DF25)


def runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge spans of documents that touch or overlap. Sorts."""
    if not len(doc):
        return doc, lo, hi
    o = np.lexsort((lo, doc))
    doc, lo, hi = doc[o], lo[o], hi[o]
    # documents in turn, on one axis
    which = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    wide = int(hi.max()) + 1
    far = np.maximum.accumulate(hi + which * wide)
    new = np.concatenate([[True], lo[1:] + which[1:] * wide > far[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(doc) - 1]])
    return doc[first], lo[first], far[last] - which[last] * wide


ROWS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("ext", pa.int32())])
#: ext of rows that are no anchors: a span known as repeated, from at to c; a window of a hot anchor, by its hashes h and c; word that an anchor's hash is hot.
SPAN, HASHED, BEACON = -1, -2, -3
ROWS_SQL = "h long, c long, doc_id long, at long, ext int"


def rows_of(h, c, doc, at, ext) -> Iterator[pa.RecordBatch]:
    cols = [np.asarray(h).view(np.int64), np.asarray(c).view(np.int64), doc, at, np.asarray(ext, dtype=np.int32)]
    for i in range(0, len(doc), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[i : i + 50_000])) for x in cols], schema=ROWS)


def texts_of(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of documents, as rows: one for each class in the task, and the spans that a class's other members cover."""
    held: list[tuple] = []
    count = 0

    def segment(ids: list[int], shifts: list[int], texts: list[bytes]) -> tuple | None:
        raw = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        pos, lo, hi, h, _ = anchors(np.frombuffer(raw, dtype=np.uint8), ends)
        if not len(pos):
            return None
        c = contexts(raw, pos, lo, hi)
        which = np.searchsorted(ends, lo, side="right")
        base = np.concatenate([[0], ends[:-1]])[which] - np.array(shifts, dtype=np.int64)[which]
        # hot anchors need their windows' own hashes: kept by reference until the task's classes are known
        return h, c, np.array(ids, dtype=np.int64)[which], pos - base, lo - base, hi - base, base, raw

    def flush() -> Iterator[pa.RecordBatch]:
        h, c, doc, pos, lo, hi, base = (np.concatenate([x[k] for x in held]) for k in range(7))
        part = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
        o = np.lexsort((pos, doc, c, h))
        h, c, doc, pos, lo, hi, base, part = (x[o] for x in (h, c, doc, pos, lo, hi, base, part))
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new = new_h | np.concatenate([[True], c[1:] != c[:-1]])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = ~new & ((doc != doc[first]) | (pos != pos[first]))
        d, a, b = runs(doc[again], lo[again], hi[again] + LENGTH)
        group = np.cumsum(new_h) - 1
        classes = np.bincount(group, weights=new)[group]
        hot = new & (classes > HOT)
        plain = new & ~hot
        ext = (pos - lo) << 8 | (hi - lo)
        yield from rows_of(h[plain], c[plain], doc[plain], pos[plain], ext[plain])
        yield from rows_of(mix(d.astype(np.uint64) ^ a.astype(np.uint64) << np.uint64(20)), b, d, a, np.full(len(d), SPAN))
        if hot.any():
            beacon = h[hot & new_h]
            zero = np.zeros(len(beacon), dtype=np.int64)
            yield from rows_of(beacon, zero, zero, zero, np.full(len(beacon), BEACON))
            every = np.flatnonzero(hot)
            for i in range(0, len(every), HOT_ANCHORS):
                some = every[i : i + HOT_ANCHORS]
                found = []
                for k in np.unique(part[some]):
                    at = some[part[some] == k]
                    found.append(windows(held[k][7], doc[at], lo[at], hi[at], base[at]))
                yield from first_windows(*(np.concatenate(x) for x in zip(*found, strict=True)))
        held.clear()

    ids, shifts, texts, size = [], [], [], 0

    def close() -> None:
        nonlocal ids, shifts, texts, size, count
        if texts and (got := segment(ids, shifts, texts)) is not None:
            held.append(got)
            count += len(got[0])
        ids, shifts, texts, size = [], [], [], 0

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), texts_of(batch, 1), strict=True):
            # long texts in slices that share all but one byte of a window; an anchor at a seam then has two contexts, each with its own windows
            for lo in range(0, len(t) - LENGTH + 1, SLICE):
                ids.append(i)
                shifts.append(lo)
                texts.append(t[lo : lo + SLICE + LENGTH - 1])
                size += len(texts[-1])
                if size >= SEGMENT:
                    close()
                    if count >= TABLE:
                        yield from flush()
                        count = 0
    close()
    if held:
        yield from flush()


def windows(raw: bytes, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows from lo to hi of anchors in one segment: a digest in two parts, document, start."""
    n = hi - lo + 1
    start = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    p = start + np.repeat(base, n)
    d = digests_of(raw, p, p + LENGTH, 2)
    return d[:, 0], d[:, 1], np.repeat(doc, n), start


def first_windows(a: np.ndarray, b: np.ndarray, doc: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for the first of equal windows, and the spans that the others cover."""
    o = np.lexsort((at, doc, b, a))
    a, b, doc, at = a[o], b[o], doc[o], at[o]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = ~new & ((doc != doc[first]) | (at != at[first]))
    yield from rows_of(a[new], b[new], doc[new], at[new], np.full(int(new.sum()), HASHED))
    d, x, y = runs(doc[again], at[again], at[again] + LENGTH)
    yield from rows_of(mix(d.astype(np.uint64) ^ x.astype(np.uint64) << np.uint64(20)), y, d, x, np.full(len(d), SPAN))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first, in portions that split no group, each a few batches long at least."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([np.array(c.to_pylist(), dtype=object) if pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type) else c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size < PORTION:
            continue
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if cut:
            yield [c[:cut] for c in cols]
        held, size = [[c[cut:] for c in cols]], 0
    if held:
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        if len(cols[0]):
            yield cols


def _classes(many: int = MANY):
    """Rows sorted by (h, c, doc_id, at): spans of classes' further members, the first members of classes that share an anchor hash, with the ext of anchors, and
    word of the hashes with more than so many classes. Other rows pass.

    Holds a batch and the first member of the last class, however many rows share a hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[np.ndarray] | None = None  # the first member of the class that the next batch may go on with
        count, sent = 0, False  # classes of its hash so far; whether that member has been sent
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            other = cols[4] < 0
            if other.any():
                yield from rows_of(*[x[other] for x in cols])
                cols = [x[~other] for x in cols]
            if not len(cols[0]):
                continue
            if last is not None:
                cols = [np.concatenate(x) for x in zip(last, cols, strict=True)]
            h, c, doc, at, ext = cols
            new_h = np.concatenate([[True], h[1:] != h[:-1]])
            new = new_h | np.concatenate([[True], c[1:] != c[:-1]])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            again = ~new & ((doc != doc[first]) | (at != at[first]))
            lo = at - (ext >> 8)
            d, a, b = runs(doc[again], lo[again], lo[again] + (ext[again] & 255) + LENGTH)
            yield from rows_of(np.zeros(len(d), np.int64), b, d, a, np.full(len(d), SPAN))
            starts = np.flatnonzero(new_h)
            known = np.zeros(len(starts), dtype=np.int64)  # classes counted before this batch
            old = np.zeros(len(h), dtype=bool)
            if last is not None:
                known[0], old[0] = count, sent
            total = np.add.reduceat(new.astype(np.int64), starts) + np.maximum(known - 1, 0)
            send = new & ~old & (total[np.cumsum(new_h) - 1] > 1)
            yield from rows_of(h[send], np.zeros(int(send.sum()), np.int64), doc[send], at[send], ext[send])
            hot = h[starts[(total > many) & (known <= many)]]
            zero = np.zeros(len(hot), dtype=np.int64)
            yield from rows_of(hot, zero, zero, zero, np.full(len(hot), BEACON))
            j = int(first[-1])
            last, count, sent = [x[j : j + 1] for x in cols], int(total[-1]), bool(old[j] or send[j])

    return run


def blind_trie(strings: list[bytes], depth: int) -> tuple[list[int], list[int]]:
    """Order of distinct or equal strings that share their first depth bytes, and each one's common prefix with the one before (the first: depth).

    Inner nodes hold a depth and children by the byte there, leaves lists of equal strings. A search looks at branching bytes only and
    compares once with the leaf that it ends at.
    """

    def byte(s: bytes, i: int) -> int:
        return s[i] if i < len(s) else -1

    root: list | None = None  # [depth, {byte: node}] or (index, ...)
    for k, s in enumerate(strings):
        if root is None:
            root = [-1, [k]]
            continue
        node = root
        while node[0] >= 0:
            kids = node[1]
            node = kids.get(byte(s, node[0])) or next(iter(kids.values()))
        t = strings[node[1][0]]
        if s == t:
            node[1].append(k)
            continue
        n = min(len(s), len(t))
        x = int.from_bytes(s[:n], "big") ^ int.from_bytes(t[:n], "big")
        common = n - (x.bit_length() + 7) // 8
        up, node = None, root
        while 0 <= node[0] < common:
            up, node = node, node[1][byte(s, node[0])]
        leaf = [-1, [k]]
        if node[0] == common:
            node[1][byte(s, common)] = leaf
        else:
            inner = [common, {byte(t, common): node, byte(s, common): leaf}]
            if up is None:
                root = inner
            else:
                up[1][byte(s, up[0])] = inner
    order: list[int] = []
    common = []
    todo = [(root, depth)]
    while todo:
        node, lcp = todo.pop()
        if node[0] < 0:
            order += node[1]
            common += [lcp] + [1 << 20] * (len(node[1]) - 1)
        else:
            kids = sorted(node[1].items())
            todo += [(kid, lcp if i == 0 else node[0]) for i, (_, kid) in reversed(list(enumerate(kids)))]
    return order, common


def deep_shallow(group: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings within ascending groups, and each one's common prefix with the one before it in that order (-1 at a group's start)."""
    n = len(strings)
    order, lcp = np.arange(n), np.full(n, -1, dtype=np.int64)
    wide = 8 * SHALLOW
    words = np.frombuffer(b"".join([s[:wide].ljust(wide, b"\0") for s in strings]), dtype=">u8").reshape(n, SHALLOW).astype(np.uint64)
    sizes = np.array([min(len(s), wide) for s in strings])
    open_ = group.copy()
    for w in range(SHALLOW):
        o = np.lexsort((words[order, w], open_))
        order = order[o]
        x = words[order, w]
        same = open_[1:] == open_[:-1]
        diff = x[1:] ^ x[:-1]
        split = same & (diff != 0)
        if split.any():
            # bytes in common within this word
            i = np.flatnonzero(split)
            zeros = np.zeros(len(i), dtype=np.int64)
            left = diff[i]
            for k in range(1, 8):
                zeros += left >> np.uint64(64 - 8 * k) == 0
            lcp[i + 1] = np.minimum(8 * w + zeros, np.minimum(sizes[order[i]], sizes[order[i + 1]]))
        open_ = np.concatenate([[0], np.cumsum(~same | split)])
    # the groups left, with prefixes in common: blind tries
    starts = np.flatnonzero(np.concatenate([[True], open_[1:] != open_[:-1]]))
    ends = np.concatenate([starts[1:], [n]])
    for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
        own = order[a:b]
        got, common = blind_trie([strings[i] for i in own.tolist()], 0)
        before = lcp[a]
        order[a:b] = own[got]
        lcp[a:b] = common
        lcp[a] = before
    if any(b"\0" in s for s in strings):  # padding looked like content
        for i in range(1, n):
            a, b = strings[order[i - 1]], strings[order[i]]
            if group[order[i - 1]] == group[order[i]]:
                m = min(len(a), len(b))
                x = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
                lcp[i] = m - (x.bit_length() + 7) // 8
    return order, lcp


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts (h, doc_id, at, ext, context) sorted by h: spans of windows that an earlier document or place has too."""
    for h, doc, at, ext, context in grouped(batches):
        n = len(h)
        before = (ext >> 8).astype(np.int64)  # of the anchor, to its first window's start
        least = before - (ext & 255)  # to its last window's start
        group = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
        data = context.tolist()
        sides = []
        for strings in ([s[b:] for s, b in zip(data, before.tolist(), strict=True)], [s[:b][::-1] for s, b in zip(data, before.tolist(), strict=True)]):
            order, lcp = deep_shallow(group, strings)
            sides.append((order, lcp))
        rank = np.empty(n, dtype=np.int64)
        rank[np.lexsort((at, doc))] = np.arange(n)
        (r_order, r_lcp), (l_order, l_lcp) = sides
        found_i, found_d = [], []
        for d in range(WINDOW):
            on = (least <= d) & (d <= before)
            if on.sum() < 2:
                continue
            right, left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
            right[r_order] = np.cumsum(r_lcp < LENGTH - d)
            left[l_order] = np.cumsum(l_lcp < d)
            i = np.flatnonzero(on)
            key = right[i] * (n + 1) + left[i]
            o = np.lexsort((rank[i], key))
            i, key = i[o], key[o]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            head = np.repeat(first, np.diff(np.append(first, len(i))))
            again = (doc[i] != doc[i[head]]) | (at[i] != at[i[head]])
            found_i.append(i[again])
            found_d.append(np.full(int(again.sum()), d))
        if found_i and sum(map(len, found_i)):
            i, d = np.concatenate(found_i), np.concatenate(found_d)
            p = at[i] - d
            x, a, b = runs(doc[i], p, p + LENGTH)
            yield from rows_of(np.zeros(len(x), np.int64), b, x, a, np.full(len(x), SPAN))


CONTEXTS = "h long, doc_id long, at long, ext int, context binary"


def _fetch(hot: bool):
    """Of documents with the anchors wanted of them: their contexts, or their windows by digest, of equal ones in a batch the first."""

    names = ["h", "doc_id", "at", "ext", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, wanted = batch.column(0).to_numpy(), texts_of(batch, 1), batch.column(2)
            which = np.repeat(np.arange(len(texts)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            every = wanted.flatten()
            on = every.field("hot").to_numpy(zero_copy_only=False) == hot
            h, at, ext = (every.field(c).to_numpy(zero_copy_only=False)[on] for c in ("h", "at", "ext"))
            which, lo = which[on], at - (ext >> 8)
            hi = lo + (ext & 255)
            if not hot:
                for k in range(0, len(h), PORTION):
                    part = slice(k, k + PORTION)
                    context = [texts[i][a:b] for i, a, b in zip(which[part].tolist(), lo[part].tolist(), (hi[part] + LENGTH).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(h[part]), pa.array(ids[which[part]]), pa.array(at[part]), pa.array(ext[part]), pa.array(context, pa.binary())], names=names)
                continue
            found: list[tuple] = []
            size = 0
            for i in np.unique(which).tolist():
                a, b = np.searchsorted(which, [i, i + 1])
                for k in range(a, b, PORTION):
                    part = slice(k, min(k + PORTION, b))
                    zero = np.zeros(part.stop - k, dtype=np.int64)
                    found.append(windows(texts[i], zero + ids[i], lo[part], hi[part], zero))
                    size += len(found[-1][0])
                    if size > WINDOW * PORTION:
                        yield from first_windows(*(np.concatenate(x) for x in zip(*found, strict=True)))
                        found, size = [], 0
            if found:
                yield from first_windows(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def repeated_spans(documents: Documents, many: int = MANY) -> DataFrame:
    """(number, spans): the byte spans [start, end) that repeat earlier ones, for documents that have any; spans may touch or overlap."""
    texts = documents.texts.select(F.col("number").alias("doc_id"), "text")
    spark = texts.sparkSession
    prepare(spark)
    parts = partitions(spark, 2 * documents.bytes)  # rows of anchors are about twice as large as the texts
    rows = texts.mapInArrow(_sample, ROWS_SQL)
    by_anchor = rows.repartition(parts, F.when(F.col("ext") == HASHED, F.xxhash64("h", "c")).otherwise(F.col("h")))
    found = by_anchor.sortWithinPartitions("h", "c", "doc_id", "at").mapInArrow(_classes(many), ROWS_SQL)
    found = materialize(found, "repeats")
    wanted = found.where("ext >= 0").select("h", "doc_id", "at", "ext")
    beacons = materialize(found.where(f"ext = {BEACON}").select("h").distinct(), "beacons")
    if beacons.isEmpty():
        wanted = wanted.withColumn("hot", F.lit(False))
    else:
        wanted = wanted.join(broadcast_if_small(beacons.withColumn("hot", F.lit(True))), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("h", "hot", "at", "ext")).alias("wanted"))  # those of one text
    with_text = texts.join(wanted, "doc_id").select("doc_id", "text", "wanted")
    context = with_text.mapInArrow(_fetch(False), CONTEXTS)
    by_suffix = context.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(_sorted, ROWS_SQL)
    spans = found.where(f"ext = {SPAN}").unionByName(by_suffix).select("doc_id", F.col("at").alias("start"), F.col("c").alias("end"))
    if not (beacons.isEmpty() and found.where(f"ext = {HASHED}").isEmpty()):
        of_hot = materialize(found.where(f"ext = {HASHED}").unionByName(with_text.mapInArrow(_fetch(True), ROWS_SQL)), "windows")
        spans = spans.unionByName(of_hot.where(f"ext = {SPAN}").select("doc_id", F.col("at").alias("start"), F.col("c").alias("end")))
        of_hot = of_hot.where(f"ext = {HASHED}").select("h", "c", "doc_id", "at")
        first = of_hot.groupBy("h", "c").agg(F.min(F.struct("doc_id", "at")).alias("first"))
        later = of_hot.join(first, ["h", "c"]).where(F.struct("doc_id", "at") > F.col("first"))
        spans = spans.unionByName(later.select("doc_id", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("end")))
    return spans.groupBy(F.col("doc_id").alias("number")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # the spans of one text


def merged(spans: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        b = min(b, size)
        if a >= b:
            continue
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans less the characters that they cover only in part."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _with_spans(docs: DataFrame, without_id: bool, *keep: Column) -> DataFrame:
    """(doc_id, text, spans, ...) of docs, doc_id as a long."""
    documents = Documents.of(docs, without_id, keep)
    spans = repeated_spans(documents)
    # the columns of texts in the order that repeated_spans has, so that one exchange of texts serves both
    texts = documents.texts.select(F.col("number").alias("doc_id"), *[c for c in documents.texts.columns if c != "number"])
    joined = texts.join(spans.withColumnRenamed("number", "doc_id"), "doc_id", "left")
    return joined if documents.keys is None else documents.named(joined.withColumnRenamed("doc_id", "number"), ("number", "doc_id"))


def digests(docs: DataFrame, without_id: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of docs(doc_id, text): the spans are the maximal runs of removed bytes. without_id: whether rows without a doc_id count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, count, sha = [], [], [], []
            for t, s in zip(texts_of(batch, 1), batch.column(2).to_pylist(), strict=True):
                spans = merged([(x["start"], x["end"]) for x in s or ()], len(t))
                n.append(len(t))
                gone.append(sum(b - a for a, b in spans))
                count.append(len(spans))
                sha.append(hashlib.sha256(without(t, spans)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in (n, gone, count)], pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(docs, without_id).select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(docs: DataFrame, without_id: bool = False) -> DataFrame:
    """docs with repeated spans taken out of text, whole characters only, and n_chars after that; other columns stay as they were. Rows without a doc_id go, unless without_id."""
    names = docs.columns
    others = [c for c in names if c not in ("doc_id", "text")]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row") if others else F.struct(F.lit(0).alias("_none")).alias("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, s in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if s:
                    raw = t.encode()
                    t = without(raw, whole_characters(raw, merged([(x["start"], x["end"]) for x in s], len(raw)))).decode()
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2)], names=["doc_id", "text", "_row"])

    joined = _with_spans(docs, without_id, row).select("doc_id", "text", "_row", "spans")
    done = joined.drop("spans")
    done = joined.mapInArrow(run, done.schema)
    get = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    if "n_chars" in names:
        get["n_chars"] = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return done.select(*[get.get(c, F.col(f"_row.`{c}`")).alias(c) for c in names])
