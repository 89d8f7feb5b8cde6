"""Operators on vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import egojoin, kdtree, queries


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "c", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, n_links string, rank int").repartition(3)


def brute_links(ids, x, cosine=0.95):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    on = u @ u.T >= cosine
    np.fill_diagonal(on, False)
    low = ids.copy()
    while True:
        new = np.array([min([low[i], *low[on[i]]]) for i in range(len(ids))])
        if (new == low).all():
            return {int(i): (int(n), int(c), bool(i == c)) for i, n, c in zip(ids, on.sum(1), low)}
        low = new


def clustered(seed, n=600, d=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0] + 0.08 * rng.normal(size=(n // 3, d))  # one large group
    for k in range(n // 3, n // 2, 3):
        x[k + 1 : k + 3] = x[k] + 0.05 * rng.normal(size=(2, d))
    return x.astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("block,leaf", [(1024, 256), (50, 8)])
def test_links_against_brute_force(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(egojoin, "BLOCK", block)
    monkeypatch.setattr(egojoin, "LEAF", leaf)
    x = clustered(1)
    ids = np.random.default_rng(2).permutation(len(x)).astype(np.int64)
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, zip(ids.tolist(), x))).collect()}
    assert got == brute_links(ids, x)


def test_odd_vectors_link_with_nothing(spark):
    rows = [(1, [1, 0]), (2, [2, 0]), (3, [0, 0]), (4, None), (5, [None, 1]), (6, [float("nan"), 1]), (7, [float("inf"), 0]), (8, [1, 0, 0]), (9, []), (None, [1, 0]), (10, [-1, 0]), (2, [2, 0]), (11, [1e30, 1e29]), (12, [1e-30, 0])]
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, rows, "double")).collect()}
    assert sorted(got) == list(range(1, 13))
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[12] == (3, 1, False) and got[11] == (3, 1, False)
    assert all(got[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10))
    assert egojoin.near_duplicates(table(spark, [])).count() == 0
    assert [tuple(r) for r in egojoin.near_duplicates(table(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_recursion_skips_distant_intervals(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(egojoin, "LEAF", 4)
    a = rng.normal(size=(64, 3)) * 0.01 + [1, 0, 0]
    b = rng.normal(size=(64, 3)) * 0.01 + [0, 1, 0]
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    i, _ = egojoin.join_intervals(unit(a), unit(b), unit(a)[:, :2], unit(b)[:, :2], 0.95, 0.3163, False)
    assert len(i) == 0
    i, j = egojoin.join_intervals(unit(a), unit(a), unit(a)[:, :2], unit(a)[:, :2], 0.95, 0.3163, True)
    assert len(i) == 64 * 63 // 2 and (i < j).all()


def test_first_query_on_its_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    assert {r[0]: tuple(r)[1:] for r in queries.op1_near_embeddings(spark, sf).collect()} == brute_links(ids, x)


def brute_top(ids, x, k, step):
    v = np.floor(256 * x).astype(np.int64).astype(object)
    out = set()
    for q in range(len(ids)):
        if ids[q] % step == 0:
            s = v @ v[q]
            for r, i in enumerate(sorted((i for i in range(len(ids)) if i != q), key=lambda i: (-s[i], ids[i]))[:k]):
                out.add((int(ids[q]), r + 1, int(ids[i]), int(s[i])))
    return out


@pytest.mark.parametrize("shard,leaf,queries_", [(8192, 128, 512), (70, 5, 4)])
def test_top_k_against_brute_force(spark, monkeypatch, shard, leaf, queries_):
    for name, value in (("SHARD", shard), ("LEAF", leaf), ("QUERIES", queries_)):
        monkeypatch.setattr(kdtree, name, value)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 6)), 1)  # many ties
    x[100:150] = x[7]
    ids = rng.permutation(400).astype(np.int64)
    got = kdtree.top_k(table(spark, zip(ids.tolist(), x), "double"), F.col("vec_id") % 10 == 0, 5).collect()
    assert {tuple(r) for r in got} == brute_top(ids, x, 5, 10) and len(got) == 200


def test_tree_boxes_are_tight_and_bounds_hold():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(500, 8)) * 50)
    t = kdtree.KdTree(np.arange(500), x)
    q = np.floor(rng.normal(size=(3, 8)) * 50)
    bounds = t.bounds(q)
    assert sorted(t.ids) == list(range(500))
    for n in range(len(t.first)):
        own = t.x[t.first[n] : t.last[n]]
        assert (own.min(0) == t.lo[n]).all() and (own.max(0) == t.hi[n]).all()
        assert (own @ q.T <= bounds[:, n] + 1e-9).all()
        left, right = t.kids[n]
        assert (left < 0) == (right < 0) and (left >= 0 or len(own) <= kdtree.LEAF)


def test_few_and_odd_vectors(spark):
    rows = [(0, [1, 2]), (50, [0, 0]), (3, None), (4, [None, 1]), (5, [float("nan"), 0]), (6, [1]), (100, [-1, 3]), (None, [1, 1])]
    got = {tuple(r) for r in kdtree.top_k(table(spark, rows, "double"), F.col("vec_id") % 50 == 0).collect()}
    want = {(q, r, i, s * 65536) for q, r, i, s in [(0, 1, 100, 5), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 100, 0), (100, 1, 0, 5), (100, 2, 50, 0)]}
    assert got == want
    assert kdtree.top_k(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert kdtree.top_k(table(spark, [(1, [1, 2])]), F.col("vec_id") % 50 == 0).count() == 0
    big = kdtree.top_k(table(spark, [(0, [4e6, 1]), (1, [4e6, 2]), (2, [-4e6, 0])], "double"), F.col("vec_id") % 50 == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(big, key=lambda r: r["rank"])] == [(1, (4_000_000 * 256) ** 2 + 256 * 512), (2, -((4_000_000 * 256) ** 2))]


def mixed():
    """Vectors of three dimensions under ids that interleave, as rows and as (ids, matrix) of each."""
    rng = np.random.default_rng(8)
    parts = []
    for k, (n, d) in enumerate([(60, 6), (40, 3), (20, 2)]):
        x = np.round(rng.normal(size=(n, d)), 1) + 0.05
        x[n // 2 : n // 2 + 5] = x[0]
        parts.append((np.arange(n) * 3 + k, x))
    return [(i, v) for ids, x in parts for i, v in zip(ids.tolist(), x.tolist())], parts


def test_each_dimension_is_joined(spark):
    rows, parts = mixed()
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, [*rows, (999, [1.0])], "double")).collect()}
    want = {999: (0, 999, True)}
    for ids, x in parts:
        want |= brute_links(ids, x)
    assert got == want and all(got[i][0] > 0 for ids, _ in parts for i in ids[:1].tolist())


def test_each_dimension_is_searched(spark):
    rows, parts = mixed()
    got = kdtree.top_k(table(spark, [*rows, (1000, [1.0])], "double"), F.col("vec_id") % 10 == 0, 5).collect()
    assert {tuple(r) for r in got} == set().union(*(brute_top(ids, x, 5, 10) for ids, x in parts))


def test_rows_of_the_usual_dimension_go_first(spark):
    rows = [(1, [2, 1]), (1, [1, 2]), (1, [0, 0, 1]), (2, [1, 2]), (3, [0, 0, 1]), (3, [0, 0, 2])]
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, rows, "double")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


@pytest.mark.parametrize("shard", [8192, 3])
def test_large_components_are_ranked_exactly(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD", shard)
    x = np.array([[1, 1], [1e7, 0], [2e7, 1], [3e9, -1], [-1e12, 5], [-2e12, 0], [0.5, 0.25], [9e6, 9e6], [1e7, 0], [-3e9, 7]])
    ids = np.arange(len(x)) * 10
    got = kdtree.top_k(table(spark, zip(ids.tolist(), x.tolist()), "double"), F.col("vec_id") == 0, 9).collect()
    assert {tuple(r) for r in got} == {r for r in brute_top(ids, x, 9, 10) if r[0] == 0} and len(got) == 9


@pytest.mark.parametrize("shard", [8192, 2])
def test_scores_beyond_a_long_are_still_ranked(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD", shard)
    rows = [(0, [1e20, 1]), (1, [1e20, 0]), (2, [1e150, 0]), (3, [3e20, 0]), (4, [0, 5]), (5, [-1e150, 0]), (6, [-1e20, 0]), (7, [-3e20, 0]), (8, [1e20, 0])]
    got = sorted(kdtree.top_k(table(spark, rows, "double"), F.col("vec_id") == 0, 8).collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in got] == [2, 3, 1, 8, 4, 6, 7, 5]
    assert [r.score for r in got] == [2**63 - 1] * 4 + [256 * 5 * 256] + [-(2**63)] * 3
    few = sorted(kdtree.top_k(table(spark, rows, "double"), F.col("vec_id") == 0, 2).collect(), key=lambda r: r["rank"])
    assert [r.vec_id for r in few] == [2, 3]


def rows_of_repeated_ids(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(160, 5))
    x[20:60] = x[0] + 0.05 * rng.normal(size=(40, 5))
    x[60:90] = x[1]  # copies
    x[90:100] = 3 * x[1]
    return rng.integers(0, 100, 160).astype(np.int64), x


def test_every_row_of_a_repeated_id_is_joined(spark):
    ids, x = rows_of_repeated_ids(21)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    on = (u @ u.T >= 0.95) & (ids[:, None] != ids[None, :])
    n = {int(i): int(on[ids == i].sum()) for i in ids}
    low = {int(i): int(i) for i in ids}
    while True:
        new = {i: min([low[i], *(low[int(j)] for j in ids[on[ids == i].any(0)])]) for i in low}
        if new == low:
            break
        low = new
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, zip(ids.tolist(), x), "double"), every_row=True).collect()}
    assert got == {i: (n[i], low[i], low[i] == i) for i in low}


def test_every_row_of_unique_ids_with_copies(spark):
    _, x = rows_of_repeated_ids(22)
    ids = np.random.default_rng(1).permutation(160).astype(np.int64)
    got = {r[0]: tuple(r)[1:] for r in egojoin.near_duplicates(table(spark, zip(ids.tolist(), x), "double"), every_row=True).collect()}
    want = brute_links(ids, x)
    near = np.abs(x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) - 0.95).min()
    assert near > 1e-9 and got == want


def test_every_row_of_a_repeated_id_is_searched(spark):
    rows = [(7, [1, 0]), (7, [5, 0]), (0, [1, 0]), (3, [2, 0]), (0, [0, 1]), (4, [0, 3]), (0, [9, 9])]
    got = {tuple(r) for r in kdtree.top_k(table(spark, rows, "double"), F.col("vec_id") % 50 == 0, 3).collect()}
    v = {(i, k): np.floor(256 * np.array(x)) for k, (i, x) in enumerate(rows)}
    pairs = sorted((-int(v[0, q] @ x), i) for q in (2, 4, 6) for (i, _), x in v.items() if i)
    assert got == {(0, r + 1, i, -s) for r, (s, i) in enumerate(pairs[:3])}
    one = {tuple(r) for r in kdtree.top_k(table(spark, [(0, [1, 0]), (7, [1, 0]), (7, [5, 0])], "double"), F.col("vec_id") == 0, 1).collect()}
    assert one == {(0, 1, 7, 327680)}


def test_a_tree_is_built_once_for_a_shard(monkeypatch):
    import pyarrow as pa

    built = []
    monkeypatch.setattr(kdtree, "KdTree", lambda ids, x, make=kdtree.KdTree: (built.append(len(ids)), make(ids, x))[1])
    rng = np.random.default_rng(1)
    rows = []
    for shard in range(4):
        x = np.floor(rng.normal(size=(30, 3)) * 9)
        rows.append((shard, 0, np.arange(30).tobytes(), kdtree.packed(x), None))
        rows += [(shard, 1, np.array([99, 98]).tobytes(), kdtree.packed(x[:2]), [None, None]) for _ in range(5 if shard else 0)]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["shard", "kind", "ids", "x", "least"])
    out = list(kdtree._search(5, 3)(iter([batch.slice(0, 7), batch.slice(7)])))
    assert built == [30] * 3 and len(out) == 15  # none where no query came


def test_box_bounds_prune_only_what_cannot_matter():
    rng = np.random.default_rng(6)
    x, q = np.floor(rng.normal(size=(5, 40, 8)) * 1e4), np.floor(rng.normal(size=(20, 8)) * 1e4)
    bound = kdtree.box_bounds(q, x.min(1), x.max(1))
    assert (bound >= np.einsum("qd,snd->qsn", q, x).max(2)).all()


def test_vectors_sent_are_those_near_a_block(spark):
    """Of two far groups in different blocks nothing is sent."""
    import pyarrow as pa

    axes = np.eye(3)
    x = np.array([[1.0, 0, 0]] * 130 + [[0, 1.0, 0]] * 20)
    ids, m = np.arange(150), np.ones(150, dtype=np.int64)
    block = next(iter(egojoin.Sequence(axes, 150, 7).add(ids, m, x)))
    assert [len(p) for p in (block.column(6)[0].as_py(),)] == [3]
    kinds = pa.list_(pa.struct([("b", pa.int64()), ("parts", pa.list_(pa.int32()))]))
    sent = pa.RecordBatch.from_arrays([*[block.column(i) for i in range(4)], pa.array([[{"b": 9, "parts": [2, 0]}]], kinds)], names=["block", "ids", "m", "x", "to"])
    (out,) = egojoin._parts(3)(iter([sent]))
    got, _, vectors = egojoin.unpack(*(out.column(i)[0].as_py() for i in (2, 3, 4)), 3)
    assert got.tolist() == [*range(64), *range(128, 150)] and (vectors == x[got]).all()


def test_smallest_reachable():
    rng = np.random.default_rng(12)
    for n, m in [(1, 0), (50, 20), (200, 180), (400, 900)]:
        ids = rng.permutation(n * 3)[:n].astype(np.int64)
        i, j = rng.integers(0, n, m), rng.integers(0, n, m)
        want = ids.copy()
        for _ in range(n):
            for x, y in zip(i, j):
                want[x] = want[y] = min(want[x], want[y])
            if all(want[x] == want[y] for x, y in zip(i, j)):
                break
        assert (egojoin.smallest_reachable(i, j, ids) == want).all()
    n = 100_000  # a chain in no order, which hops alone would take as many rounds for
    chain = rng.permutation(n)
    assert (egojoin.smallest_reachable(chain[:-1], chain[1:], np.arange(n) + 7) == 7).all()
