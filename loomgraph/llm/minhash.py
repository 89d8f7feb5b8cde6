"""MinHash near-dedup with odd sketches.

A document's set is that of its distinct word shingles, by 64-bit hash. Documents are linked where the Jaccard similarity of their sets reaches the
threshold; groups are the connected components of the links.

1. One pass over the texts gives each document's set size, a 128-bit BLAKE2 digest of the set, band keys of its MinHash samples, and an
   odd sketch: the parities of the samples' buckets. The popcount of two sketches' XOR estimates how many samples differ.
2. Equal sets form a class; only its smallest document goes on.
3. In each bucket of a band, every document is paired with the smallest one. Pairs whose sketches are too far apart for the
   threshold are dropped; the others are confirmed on the full sets, the nearest of each document first, and further
   ones only where they'd join two components.
4. In buckets that still hold several components, all other pairs across components are compared by sketch, in blocks of bounded size: a large component's own
   blocks meet those of others only, and sets meet those of about their size only. Documents that
   have a near sketch in another component of their block are compared there on the full sets, all at once; a star of links for each component
   found is all that leaves the block. Pairs within a component can't change the result, so no link between documents that share a bucket is lost.

With BANDS bands of ROWS samples a pair at similarity 0.8 shares no bucket with probability (1 - 0.8 ** 5) ** 32 = 3e-6. The
sketch limit lies six standard deviations beyond the threshold.

Null texts and texts without words have empty sets: linked with nothing. Rows without a doc_id are left out, or with without_id=True are documents of their own by text, which come
after all others; a group of such rows alone has no component_id. Rows that repeat both an id and its text are one document and give a result each; different texts under one
id are different documents. Tables without rows give none. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import Documents, components, materialize, partitions, prepare
from loomgraph.llm.egojoin import smallest_reachable
from loomgraph.llm.suffixdedup import Hashed, mix

BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
BITS = 1024
SEGMENT = 1 << 17
#: Longer words are hashed by a cryptographic function: sums modulo 2 ** 64 can agree for long words of a regular kind.
LONG_WORD = 64
#: About this many documents of one bucket, or shingles of their sets, are compared with as many at a time.
BLOCK, BLOCK_SHINGLES = 256, 1 << 22
#: Ids up to this number are broadcast (16 bytes each); more are joined by a shuffle.
SMALL = 20_000

_rng = np.random.default_rng(20240301)
_MUL = (_rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
_FOLD = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_ORDER = (_rng.integers(0, 1 << 63, 64, dtype=np.uint64)) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the words data[lo:hi], a bounded span of data at a time. Words beyond LONG_WORD bytes are hashed one by one."""
    out = np.empty(len(lo), dtype=np.uint64)
    i = 0
    while i < len(lo):
        j = max(i + 1, int(np.searchsorted(hi, lo[i] + 2 * SEGMENT, side="right")))
        if hi[j - 1] - lo[i] <= max(2 * SEGMENT, LONG_WORD):  # else it is one long word
            hashed = Hashed(data[lo[i] : hi[j - 1]])
            a, b = lo[i:j] - lo[i], hi[i:j] - lo[i]
            out[i:j] = mix(hashed.raw(0, a, b)) + mix(hashed.raw(1, a, b)) * np.uint64(3)
        i = j
    for i in np.flatnonzero(hi - lo > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[lo[i] : hi[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    word = ~_SPACE[data]
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    w = word_hashes(data, lo, hi)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cut = np.searchsorted(lo, ends).tolist()
    n = max(len(w) - width + 1, 0)
    whole = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        whole += w[k : k + n] * _ORDER[k]
    whole = mix(whole)
    out, at = [], 0
    for end in cut:
        words = end - at
        if words >= width:
            out.append(np.unique(whole[at : end - width + 1]))
        elif words:
            out.append(mix(np.atleast_1d((w[at:end] * _ORDER[:words]).sum(dtype=np.uint64) + np.uint64(words))))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at = end
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash samples of a set."""
    x = (s >> np.uint64(32)).astype(np.uint32)[None, :]
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, x.shape[1], 4096):
        np.minimum(out, (x[:, i : i + 4096] * _MUL + _ADD).min(1), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    x = samples.reshape(BANDS, ROWS).astype(np.uint64)
    return mix((x * _ORDER[:ROWS]).sum(1, dtype=np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64)))


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of BITS buckets over the samples, as 64-bit words."""
    buckets = mix(samples.astype(np.uint64) ^ _FOLD) >> np.uint64(54)
    odd = (np.bincount(buckets.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def most_different(threshold: float, deviations: float = 6.0) -> int:
    """The largest XOR popcount of two sketches that is still worth confirming."""
    d = SAMPLES * (1 - threshold) + deviations * math.sqrt(SAMPLES * threshold * (1 - threshold))
    return math.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * d)))


def _profile(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and size < SEGMENT:
                    size += len(texts[hi])
                    hi += 1
                sets = shingle_sets(texts[lo:hi], width)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                g = np.frombuffer(b"".join([hashlib.blake2b(s, digest_size=16).digest() for s in sets]), dtype=np.int64).reshape(-1, 2)  # sets are sorted
                g1, g2 = g[:, 0], g[:, 1]
                bands, sketches = [], []
                for s in sets:
                    if len(s):
                        samples = signature(s)
                        bands.append(band_keys(samples).view(np.int64))
                        sketches.append(odd_sketch(samples).view(np.int64))
                    else:
                        bands.append(None)
                        sketches.append(None)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(n), pa.array(np.ascontiguousarray(g1)), pa.array(np.ascontiguousarray(g2)), pa.array(bands, schema.field("bands").type), pa.array(sketches, schema.field("sketch").type)], schema=schema)
                lo = hi

    return run


PROFILE = "doc_id long, n long, g1 long, g2 long, bands array<long>, sketch array<long>"


def _confirm(width: int, percent: int):
    """Pairs (u, v, text_u, text_v) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            keep = []
            for i, (u, a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist(), strict=True)):
                if u != last:
                    last, last_set = u, shingle_sets([a or b""], width)[0]
                x, y = last_set, shingle_sets([b or b""], width)[0]
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both) and both:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], names=["u", "v"])

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows that agree in their first three columns, of sorted batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and row[:3] != held[0][:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _sides(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the left and right documents of a pair of blocks (the same ones if it is one block with itself), and which of their pairs are of two components."""
    side, comp = np.array([r[3] for r in rows]), np.array([r[5] for r in rows])
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    return left, right, comp[left][:, None] != comp[right][None, :]


def _flag(limit: int):
    """Rows (key, a, b, side, doc_id, component, sketch, bands, band) sorted by (key, a, b): those that have a near sketch in another component.

    Two documents that share an earlier band's bucket are left to that one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            left, right, apart = _sides(rows)
            if not apart.any():
                continue
            sketch = np.array([r[6] for r in rows], dtype=np.int64).view(np.uint64)
            z = np.zeros(apart.shape, dtype=np.uint16)
            for k in range(sketch.shape[1]):
                z += np.bitwise_count(sketch[left, k][:, None] ^ sketch[right, k][None, :])
            near = apart & (z <= limit)
            if near.any():
                bands = np.array([r[7] for r in rows], dtype=np.int64)
                for k in range(rows[0][8]):
                    near &= bands[left, k][:, None] != bands[right, k][None, :]
            at = np.union1d(left[near.any(1)], right[near.any(0)])
            if len(at):
                cols = list(zip(*[rows[i][:6] for i in at.tolist()], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=FLAGS.replace(" long", "").split(", "))

    return run


FLAGS = "key long, a long, b long, side long, doc_id long, component long"
#: Shingles counted at a time where sets are intersected.
COLUMNS = 4096


#: Shingles of the sets that are intersected at a time, on either side.
HELD = 400_000


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets with sets, for bounded portions of both sides at a time."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for a, b in _portions(left):
        for c, d in _portions(right):
            out[a:b, c:d] = _products(left[a:b], right[c:d])
    return out


def _portions(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, s in enumerate(sets):
        if i > lo and held + len(s) > HELD:
            yield lo, i
            lo, held = i, 0
        held += len(s)
    if lo < len(sets):
        yield lo, len(sets)


def _products(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The same as products of incidence matrices over the shingles on both sides, a few columns at a time."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(shared):
        return out
    sides = []
    for sets in (left, right):
        h, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
        on = shared[at] == h
        at, row = at[on], row[on]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], row[order], len(sets)))
    for lo in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - lo)
        both = []
        for at, row, n in sides:
            i, j = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((n, width), dtype=np.float32)
            m[row[i:j], at[i:j] - lo] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out


def _link_blocks(width: int, percent: int):
    """Rows (key, a, b, side, doc_id, component, text) sorted by (key, a, b): a star of links for each component that similar pairs across given components form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            left, right, apart = _sides(rows)
            if not apart.any():
                continue
            sets, texts, held = [], [], 0
            for r in rows:  # a bounded number of bytes at a time
                texts.append((r[6] or "").encode())
                held += len(texts[-1])
                if held >= SEGMENT:
                    sets, texts, held = sets + shingle_sets(texts, width), [], 0
            if texts:
                sets += shingle_sets(texts, width)
            both = intersections([sets[i] for i in left], [sets[i] for i in right])
            size = np.array([len(s) for s in sets])
            i, j = np.nonzero(apart & (100 * both >= percent * (size[left][:, None] + size[right][None, :] - both)))
            if not len(i):
                continue
            doc = np.array([r[4] for r in rows])
            root = smallest_reachable(left[i], right[j], doc)
            at = np.flatnonzero(root != doc)
            yield pa.RecordBatch.from_arrays([pa.array(root[at]), pa.array(doc[at])], names=["u", "v"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, without_id: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of docs(doc_id, text): component_id is the smallest doc_id of the group; kept tells whether it is the row's own."""
    documents = Documents.of(docs, without_id)
    out = documents.named(grouped(documents, width, percent), ("number", "doc_id"), ("component", "component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def grouped(documents: Documents, width: int, percent: int) -> DataFrame:
    """(number, n, component) of every row, component being the smallest number of the group."""
    texts = documents.texts.select(F.col("number").alias("doc_id"), "text")
    spark = texts.sparkSession
    prepare(spark)
    profile = materialize(texts.mapInArrow(_profile(width), PROFILE), "profiles")
    limit = most_different(percent / 100)
    classes = materialize(profile.where("n > 0").groupBy("g1", "g2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = profile.where("n > 0").join(classes.select(F.col("rep").alias("doc_id"), "g1", "g2", "n"), ["doc_id", "g1", "g2", "n"], "left_semi")
    reps = materialize((reps if documents.keys is None else reps.dropDuplicates(["doc_id"])).select("doc_id", "n", "bands", "sketch"), "reps")
    sketches = reps.select("doc_id", "sketch")
    buckets = reps.select("doc_id", "n", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.min("doc_id").alias("u"), F.max("doc_id").alias("last"), F.count("*").alias("size")).where("u < last").drop("last")
    shared = materialize(shared, "buckets")
    in_shared = materialize(buckets.join(shared, "key"), "members")  # (key, doc_id, n, band, u, size)

    def near(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(sketches.select(F.col("doc_id").alias("u"), F.col("sketch").alias("a")), "u").join(sketches.select(F.col("doc_id").alias("v"), F.col("sketch").alias("b")), "v")
        z = sum((F.bit_count(F.get("a", F.lit(i)).bitwiseXOR(F.get("b", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
        return joined.select("u", "v", z.alias("z")).where(F.col("z") <= limit)

    def texts_of(ids: DataFrame, label: str) -> DataFrame:
        ids = materialize(ids.distinct(), "ids")
        few = ids.limit(SMALL + 1).count() <= SMALL
        found = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
        return materialize(found if documents.keys is None else found.dropDuplicates(["doc_id"]), label)  # rows of one document have one text

    def confirmed(pairs: DataFrame, of: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar. The smaller document, often one of many pairs, joins last: Spark splits that join where it is skewed."""
        rows = pairs.select("u", "v").join(of.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v")
        rows = rows.join(of.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u").select("u", "v", "text_u", "text_v")
        return materialize(rows.mapInArrow(_confirm(width, percent), "u long, v long"), "links")

    def apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
        """Pairs of different components."""
        c = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
        joined = pairs.join(c("u"), "u", "left").join(c("v"), "v", "left")
        return joined.where(F.coalesce("cu", "u") != F.coalesce("cv", "v")).drop("cu", "cv")

    stars = materialize(near(in_shared.where("doc_id <> u").select("u", F.col("doc_id").alias("v")).distinct()), "stars")
    of = texts_of(stars.select(F.col("u").alias("doc_id")).unionByName(stars.select(F.col("v").alias("doc_id"))), "texts")
    best = stars.groupBy("v").agg(F.min(F.struct("z", "u")).alias("m")).select("m.u", "v")
    links = confirmed(best, of)
    comps = materialize(components(links), "components")
    more = confirmed(apart(stars.join(best, ["u", "v"], "left_anti"), comps), of)
    found = [] if more.isEmpty() else [more]
    if found:
        comps = materialize(components(links.unionByName(more)), "components")

    # buckets that hold several components: all pairs across, in blocks
    own = in_shared.where("size > 2").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    mixed = materialize(mixed, "mixed")  # a table, so that a bucket of very many documents can be split in the join
    own = materialize(own.join(mixed, "key", "left_semi").select("key", "doc_id", "n", "band", "component"), "mixed-members")
    spread = in_pairs_of_blocks(own, percent).join(reps.drop("n"), "doc_id")
    spread = spread.select("key", "a", "b", "side", "doc_id", "component", "sketch", "bands", "band")
    in_blocks = lambda df, size: df.repartition(partitions(spark, size), "key", "a", "b").sortWithinPartitions("key", "a", "b")
    spread = materialize(spread, "blocks")
    flagged = materialize(in_blocks(spread, spread.count() * 500).mapInArrow(_flag(limit), FLAGS), "flagged")  # bytes of a row
    if not flagged.isEmpty():
        of = texts_of(flagged.select("doc_id"), "texts")
        last = flagged.join(of, "doc_id").select("key", "a", "b", "side", "doc_id", "component", "text")
        found.append(materialize(in_blocks(last, documents.bytes).mapInArrow(_link_blocks(width, percent), "u long, v long"), "links"))
    if found:
        comps = materialize(components(reduce(DataFrame.unionByName, found, links)), "components")

    ids = profile.select("doc_id", "n", "g1", "g2").join(classes, ["g1", "g2", "n"], "left")
    ids = ids.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    return ids.select(F.col("doc_id").alias("number"), "n", F.coalesce("component", "rep", "doc_id").alias("component"))


def in_pairs_of_blocks(own: DataFrame, percent: int = 80) -> DataFrame:
    """(key, a, b, side, doc_id, component, band) of members own(key, doc_id, n, band, component) of buckets: each in every pair of its bucket's blocks that can hold a similar pair across components.

    Sets that are similar enough are of one level of sizes or of two neighbouring ones, and blocks are of one level. A component of a block's size or more has blocks of its own, which don't
    meet each other; the smaller ones share blocks. So a bucket of one large component and a few others takes rows in proportion to its size.
    """
    level = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent) + 1e-9)).cast("long")
    own = own.withColumn("level", level)
    blocks = lambda n, shingles: F.ceil(F.greatest(n / F.lit(BLOCK), shingles / F.lit(BLOCK_SHINGLES))).cast("long")
    sizes = own.groupBy("key", "component", "level").agg(F.count("*").alias("n"), F.sum("n").alias("shingles"))
    sizes = sizes.withColumn("large", (F.col("n") >= BLOCK) | (F.col("shingles") >= BLOCK_SHINGLES))
    groups = sizes.groupBy("key", "level", F.when(F.col("large"), F.col("component")).alias("part")).agg(blocks(F.sum("n"), F.sum("shingles")).alias("blocks"))  # part: null for the small ones
    groups = materialize(groups, "parts")
    every = groups.select(F.col("key").alias("_key"), "level", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"))
    # each block with the levels of those that it meets
    every = every.select("_key", F.struct("part", "level", "i").alias("other"), F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("_near"))
    mine = own.join(sizes.where("large").select("key", "component", "level", F.lit(True).alias("_large")), ["key", "component", "level"], "left")
    mine = mine.withColumn("part", F.when(F.col("_large"), F.col("component")))
    counts = groups.select(F.col("key").alias("_key"), F.col("level").alias("_level"), F.col("part").alias("_part"), "blocks")
    mine = mine.join(counts, (F.col("key") == F.col("_key")) & (F.col("level") == F.col("_level")) & F.col("part").eqNullSafe(F.col("_part"))).drop("_key")
    mine = mine.select("key", "level", "doc_id", "component", "band", F.struct("part", "level", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("i")).alias("home"))
    pairs = mine.join(every, (F.col("key") == F.col("_key")) & (F.col("level") == F.col("_near"))).where(F.col("home.part").isNull() | ~F.col("home.part").eqNullSafe(F.col("other.part")))
    name = lambda c: F.xxhash64(F.coalesce(F.col(f"{c}.part"), F.lit(-1)), F.col(f"{c}.part").isNull(), F.col(f"{c}.level"), F.col(f"{c}.i"))
    s, t = name("home"), name("other")
    return pairs.select("key", F.least(s, t).alias("a"), F.greatest(s, t).alias("b"), F.when(s == t, 2).when(s < t, 0).otherwise(1).cast("long").alias("side"), "doc_id", "component", "band")


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, without_id: bool = False) -> DataFrame:
    """One document of each group of near duplicates of docs, the one of the smallest doc_id; rows without a doc_id go, unless without_id."""
    names = docs.columns
    documents = Documents.of(docs, without_id, (F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),))
    kept = grouped(documents, width, percent).where("number = component").select("number").distinct()
    rows = documents.texts.select("number", "_row").join(kept, "number", "left_semi")
    if documents.keys is not None:
        rows = rows.dropDuplicates(["number"])  # copies under one id
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
