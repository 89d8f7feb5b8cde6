"""Near-duplicate and substring operators against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomgraph.llm import minhash, queries, suffixdedup
from loomgraph.llm.common import Documents, components
from loomgraph.llm.minhash import shingle_sets


def reach(nodes, links):
    low = {i: i for i in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_components(spark):
    rng = random.Random(1)
    for links in ([], [(1, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(300)], [(rng.randrange(400), rng.randrange(400)) for _ in range(350)]):
        got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
        nodes = {x for a, b in links if a != b for x in (a, b)}
        assert got == reach(nodes, [x for x in links if x[0] != x[1]])


def brute_sets(text, width):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_groups(docs, width, percent):
    sets = {i: brute_sets(t, width) for i, t in docs}
    index = {}
    links = []
    for i, s in sets.items():
        shared = Counter(j for x in s for j in index.get(x, ()))
        links += [(i, j) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
        for x in s:
            index.setdefault(x, []).append(i)
    return {i: (len(sets[i]), c) for i, c in reach(sets, links).items()}


def family(rng, n, first, words=60, edits=4):
    vocab = [f"w{k}" for k in range(500)]
    base = [rng.choice(vocab) for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = rng.choice(vocab)
        out.append((first + k, " ".join(w)))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_on_families(spark, docs_of, width):
    rng = random.Random(7)
    docs = family(rng, 120, 1000) + family(rng, 40, 100, 200, 12) + family(rng, 30, 5000, 12, 1) + [(i, f"only {i} here and nothing more {i}") for i in range(50)]
    docs += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "One"), (9004, "one"), (9005, "one two"), (9006, "ONE\ttwo"), (9007, "é x y"), (9008, "long " * 50_000), (9009, "long " * 50_001)]
    docs += [(9100 + k, "exactly the same text in all of these rows") for k in range(40)]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of(docs), width=width).collect()}
    want = brute_groups(docs, width, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_minhash_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "SMALL", 3)
    rng = random.Random(8)
    docs = family(rng, 150, 0, 60, 9)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs_of(docs), width=4).collect()}
    assert got == brute_groups(docs, 4, 80)


def test_minhash_on_the_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_minhash(spark, sf).collect()}
    assert got == brute_groups(docs, 4, 80)


def test_minhash_corner_tables(spark, docs_of):
    assert minhash.near_duplicates(docs_of([])).count() == 0
    assert minhash.near_duplicates(docs_of([(None, "a b c d e")])).count() == 0
    got = minhash.near_duplicates(docs_of([(3, "a b c d e f"), (3, "a b c d e f"), (5, "a b c d e f"), (1, None)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (3, 3), (3, 3), (5, 3)]
    kept = minhash.keep_first(docs_of([(3, "a b c d e f"), (5, "a b c d e f"), (1, None)]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and "component_id" in kept.columns


def test_shingles_are_of_the_whole_text():
    (a,) = shingle_sets([b"A b C d e"], 4)
    (b,) = shingle_sets([b"a  B\tc D\x0be"], 4)
    assert len(a) == 2 and (a == b).all()
    assert [len(s) for s in shingle_sets([b"", b"x", b"x y z", b"x y z w"], 4)] == [0, 1, 1, 1]


def test_odd_sketch_estimates(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    limit = minhash.most_different(0.8)
    for j in (0.8, 0.95):
        common = rng.integers(0, 1 << 63, int(1000 * j), dtype=np.uint64)
        own = lambda: np.concatenate([common, rng.integers(0, 1 << 63, int(1000 * (1 - j) / 2), dtype=np.uint64)])
        a, b = (minhash.odd_sketch(minhash.signature(own())) for _ in range(2))
        assert np.bitwise_count(a ^ b).sum() <= limit
    a, b = (minhash.odd_sketch(minhash.signature(rng.integers(0, 1 << 63, 500, dtype=np.uint64))) for _ in range(2))
    assert np.bitwise_count(a ^ b).sum() > limit


def brute_repeats(docs):
    seen, out = set(), {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            g = b[p : p + 100]
            if g in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(g)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out[i] = (len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


def passages(seed, n=250):
    rng = random.Random(seed)
    word = lambda k, al="abcdefgh é\0": "".join(rng.choice(al) for _ in range(k))
    ps = [word(rng.randint(60, 400)) for _ in range(8)]
    docs = []
    for i in range(n):
        t = word(rng.randint(0, 150))
        for _ in range(rng.randint(0, 4)):
            q = rng.choice(ps)
            a = rng.randint(0, len(q) // 2)
            t += q[a : a + rng.randint(50, 300)] + word(rng.randint(0, 60))
        docs.append((i * 3 % (n + 1), t))
    hot = word(140)
    docs += [(2000 + i, word(80) + hot + word(80)) for i in range(60)]
    docs += [(1000, "a" * 3000), (1001, "ab" * 1500), (1002, None), (1003, ""), (1004, "a" * 99), (1005, "a" * 100), (1006, ps[0] + ps[0]), (1007, ("xyz " * 30 + "q") * 20), (1008, word(40_000))]
    return docs


@pytest.mark.parametrize("hot", [1, 5, 64])
def test_repeats_against_brute_force(spark, docs_of, hot, monkeypatch):
    docs = passages(hot)
    monkeypatch.setattr(suffixdedup, "HOT", hot)  # local mode: the workers are forked, so the small limit is passed by hand below
    df = docs_of(docs, 4)
    got = {r[0]: tuple(r)[1:] for r in suffixdedup.digests(df).collect()}
    assert got == brute_repeats(docs)


def test_sampling_with_small_limits_in_process(monkeypatch):
    """The task functions with limits that force hot anchors and many flushes, run in this process."""
    import pyarrow as pa

    monkeypatch.setattr(suffixdedup, "HOT", 3)
    monkeypatch.setattr(suffixdedup, "TABLE", 200)
    monkeypatch.setattr(suffixdedup, "SEGMENT", 2000)
    monkeypatch.setattr(suffixdedup, "HOT_ANCHORS", 10)
    docs = passages(11, 60)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string())], names=["doc_id", "text"])
    rows = [r for b in suffixdedup._sample(iter([batch])) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert any(r[4] == suffixdedup.HASHED for r in rows) and any(r[4] == suffixdedup.BEACON for r in rows)
    text = {i: (t or "").encode() for i, t in docs}
    seen = {}
    for i in sorted(text):
        for p in range(len(text[i]) - 99):
            seen.setdefault(text[i][p : p + 100], (i, p))
    for h, c, doc, at, ext in rows:
        if ext == suffixdedup.SPAN:  # every span is covered by strings that start earlier
            for p in range(at, c - 99):
                assert seen[text[doc][p : p + 100]] < (doc, p)


def test_repeats_on_the_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r[0]: tuple(r)[1:] for r in queries.op8_suffix_dedup(spark, sf).collect()} == brute_repeats(docs)


def test_repeats_corner_tables(spark, docs_of):
    assert suffixdedup.digests(docs_of([])).count() == 0
    rng = random.Random(2)
    t = "".join(rng.choice("abcdefghij") for _ in range(300))
    got = suffixdedup.digests(docs_of([(4, t), (4, t), (None, t), (9, t)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(4, 0), (4, 0), (9, 300)]


def test_cut_keeps_whole_characters_and_columns(spark, docs_of):
    rng = random.Random(6)
    shared = "".join(rng.choice("éüñß") for _ in range(90))
    docs = [(1, "a" + shared + "b"), (2, "c" + shared + "d"), (3, None), (4, "")]
    df = docs_of(docs)
    out = suffixdedup.cut(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "a" + shared + "b" and got[2].text == "cd" and got[3].text is None and got[4].text == ""
    assert got[2].n_chars == 2 and got[2].spans == "x"


@pytest.mark.parametrize("strings", [[b"ab", b"abc", b"ab", b"", b"b"], [b"same"] * 3, [b"aaab", b"aaac", b"aab", b"b", b"aaa"], [bytes([x]) for x in (3, 1, 2, 255, 0)]])
def test_blind_trie_sorts(strings):
    order, lcp = suffixdedup.blind_trie(strings, 0)
    out = [strings[i] for i in order]
    assert out == sorted(strings)
    for a, b, n in zip(out, out[1:], lcp[1:]):
        common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == common or a == b and n >= common


def test_deep_shallow_sorts():
    import numpy as np

    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(40))) for _ in range(400)]
    group = np.sort(np.array([rng.randrange(5) for _ in strings]))
    order, lcp = suffixdedup.deep_shallow(group, strings)
    got = [(group[i], strings[i]) for i in order]
    assert got == sorted(got)
    for k in range(1, len(got)):
        if got[k][0] == got[k - 1][0]:
            a, b = got[k - 1][1], got[k][1]
            common = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert min(lcp[k], 1000) == common or a == b
        else:
            assert lcp[k] == -1
    assert F is not None


def test_long_texts_are_hashed_in_parts(monkeypatch):
    """Small slices give what large ones give."""
    rng = random.Random(12)
    texts = ["".join(rng.choice("ab É é\n1") for _ in range(rng.randrange(0, 300))).encode() for _ in range(60)] + [b""]
    whole = shingle_sets(texts, 3)
    monkeypatch.setattr(minhash, "SEGMENT", 3)
    for a, b in zip(whole, shingle_sets(texts, 3)):
        assert (a == b).all()
    monkeypatch.undo()
    a, b = shingle_sets([b"a " + b"q" * 2_000_000 + b" b c d", b"A\t" + b"Q" * 2_000_000 + b" b c d"], 4)
    assert len(a) == 2 and (a == b).all()


def test_long_documents_are_sampled_in_slices(monkeypatch):
    import pyarrow as pa

    rng = random.Random(13)
    text = "".join(rng.choice("abcd") for _ in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([text, "x" + text[2000:4000]], pa.string())], names=["doc_id", "text"])

    def windows_of(slice_):
        monkeypatch.setattr(suffixdedup, "SLICE", slice_)
        rows = [r for b in suffixdedup._sample(iter([batch])) for r in zip(*[c.to_pylist() for c in b.columns])]
        covered = set()
        for _, c, doc, at, ext in rows:
            lo = at - (ext >> 8) if ext >= 0 else at
            covered |= {(doc, p) for p in (range(lo, lo + (ext & 255) + 1) if ext >= 0 else range(at, c - 99))}
        return covered

    assert windows_of(1 << 20) == windows_of(300) == {(1, p) for p in range(4901)} | {(2, p) for p in range(1902)}


def thue_morse(n, a="ab", b="ba"):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


def test_regular_long_words_and_contexts_are_told_apart(spark, docs_of):
    """Sums modulo 2 ** 64 are equal for these whatever the base."""
    for n in (256, 512, 1024, 2048, 4096):
        a, b = shingle_sets([thue_morse(n).encode(), thue_morse(n, "ba", "ab").encode()], 4)
        assert (a != b).all(), n
    one, two = thue_morse(4096), thue_morse(4096, "ba", "ab")
    docs = [(1, f"{one} x y z"), (2, f"{two} x y z"), (3, f"{one} x y z")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(docs), width=4).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    docs = [(k, w * 300 + t) for k, (w, t) in enumerate([("ab", "c"), ("ba", "c"), (thue_morse(300), ""), (thue_morse(300, "ba", "ab"), "")])]
    assert {r[0]: tuple(r)[1:] for r in suffixdedup.digests(docs_of(docs)).collect()} == brute_repeats(docs)


def test_rows_that_share_an_id_or_have_none(spark, docs_of):
    rng = random.Random(31)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b, c = prose(60), prose(60), prose(60)
    rows = [(1, a), (2, a), (2, b), (None, c), (None, a), (5, c + " tail"), (2, a), (None, None), (None, prose(40)), (2**63 - 1, b)]
    out = suffixdedup.digests(docs_of(rows), without_id=True).collect()
    assert len(out) == len(rows)
    gone = sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_removed) for r in out)
    size = lambda t: len(t.encode())
    # the first of each text is whole; b under id 2 has nothing in common with a; c comes after its copy with an id
    want = [(1, a, 0), (2, a, size(a)), (2, a, size(a)), (2, b, 0), (5, c + " tail", 0), (2**63 - 1, b, size(b)), (None, c, size(c)), (None, a, size(a)), (None, "", 0), (None, rows[8][1], 0)]
    assert gone == sorted(((i is None, i or 0), size(t), n) for i, t, n in want)
    texts = sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in suffixdedup.cut(docs_of(rows), without_id=True).collect())
    assert texts == sorted(((i is None, i or 0), "" if n else t) for i, t, n in want)
    assert suffixdedup.cut(docs_of(rows)).count() == 6

    near = minhash.near_duplicates(docs_of(rows), without_id=True).collect()
    assert len(near) == len(rows)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near)
    assert found == sorted([(False, 1, 56, 1, True), (False, 2, 56, 1, False), (False, 2, 56, 1, False), (False, 2, 56, 2, True), (True, 0, 56, 5, False), (True, 0, 56, 1, False), (False, 5, 57, 5, True), (True, 0, 0, 0, True), (True, 0, 36, 0, True), (False, 2**63 - 1, 56, 2, False)])
    kept = minhash.keep_first(docs_of(rows), without_id=True)
    assert kept.columns == docs_of(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(False, 1, a), (False, 2, b), (False, 5, c + " tail"), (True, 0, ""), (True, 0, rows[8][1])])


def test_numbers_keep_the_order_of_ids(spark, docs_of):
    rows = [(5, "x"), (-7, "y"), (5, "x"), (5, "z"), (None, "q"), (None, "r"), (0, None), (9, "")]
    d = Documents.of(docs_of(rows), True)
    keys = d.keys.orderBy("number").collect()
    assert [r.number for r in keys] == list(range(7)) and [r.doc_id for r in keys] == [-7, 0, 5, 5, 9, None, None] and d.bytes == 6
    assert sorted(r.number for r in d.texts.collect()) == [0, 1, 2, 2, 3, 4, 5, 6] or len({r.number for r in d.texts.collect()}) == 7
    plain = Documents.of(docs_of([(3, "ab"), (4, None)]))
    assert plain.keys is None and plain.bytes == 2 and sorted(r.number for r in plain.texts.collect()) == [3, 4]
    assert Documents.of(docs_of([])).bytes == 0


def test_classes_across_batches():
    """However rows are cut into batches, the same members, spans and hot hashes come out."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted((rng.randrange(6) ** 2 // 4, rng.randrange(1, 9), rng.randrange(40), rng.randrange(20, 520), rng.choice([0, 5 << 8 | 5, 9 << 8 | 9])) for _ in range(300))
    rows += [(99, 1, 1, 200, 0), (100, 1, 2, 200, 0), (100, 1, 3, 200, 0), (101, 1, 1, 300, 0), (101, 2, 1, 400, 0)]
    firsts = {}
    for r in rows:
        firsts.setdefault(r[:2], r)
    classes = Counter(h for h, _ in firsts)
    want_hot = sorted(h for h, n in classes.items() if n > 4)
    want_firsts = sorted((h, d, a, e) for (h, _), (_, _, d, a, e) in firsts.items() if classes[h] > 1)
    want_cover = set()
    for r in rows:
        f = firsts[r[:2]]
        if (r[2], r[3]) != (f[2], f[3]):
            lo = r[3] - (r[4] >> 8)
            want_cover |= {(r[2], p) for p in range(lo, lo + (r[4] & 255) + 100)}
    for size in (1, 2, 7, 50, 1000):
        cols = [np.array(c, dtype=np.int64) for c in zip(*rows)]
        batches = [b for i in range(0, len(rows), size) for b in suffixdedup.rows_of(*[c[i : i + size] for c in cols])]
        out = [r for b in suffixdedup._classes(4)(iter([*batches, *suffixdedup.rows_of(*[np.array([x]) for x in (7, 8, 9, 10, suffixdedup.HASHED)])])) for r in zip(*[c.to_pylist() for c in b.columns])]
        assert sorted(h for h, *_, e in out if e == suffixdedup.BEACON) == want_hot
        assert sorted((h, d, a, e) for h, _, d, a, e in out if e >= 0) == want_firsts
        assert {(d, p) for _, c, d, a, e in out if e == suffixdedup.SPAN for p in range(a, c)} == want_cover
        assert [r for r in out if r[4] == suffixdedup.HASHED] == [(7, 8, 9, 10, suffixdedup.HASHED)]
    assert pa is not None


def test_a_hash_that_is_hot_in_no_task_alone(spark, docs_of):
    """More than HOT different contexts of one anchor, a few in each partition."""
    rng = random.Random(17)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    hot = word(99)
    docs = [(i, word(70) + hot + word(70)) for i in range(150)]
    docs += [(200 + i, docs[i][1][30:] + word(20)) for i in range(0, 150, 7)]
    want = brute_repeats(docs)
    for many in (3, suffixdedup.MANY):
        found = suffixdedup.repeated_spans(Documents.of(docs_of(docs, 24)), many).collect()
        spans = {r.number: suffixdedup.merged([tuple(x) for x in r.spans], 10**9) for r in found}
        assert {i: (sum(b - a for a, b in spans.get(i, [])), len(spans.get(i, []))) for i, _ in docs} == {i: (n, k) for i, (_, n, k, _) in want.items()}
    assert sum(r[1] for r in want.values()) > 0


@pytest.mark.parametrize("block", [4, 20])
def test_large_components_have_blocks_of_their_own(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    rows = [(key, doc, rng.choice([1, 1, 1, 2, 3, doc]), 10) for key in (7, 8) for doc in range(60)]
    own = spark.createDataFrame([(k, d, 10, 0, c) for k, d, c, _ in rows], "key long, doc_id long, n long, band int, component long")
    placed = {}
    for r in minhash.in_pairs_of_blocks(own).collect():
        placed.setdefault((r.key, r.a, r.b), []).append(r)
    component = {(k, d): c for k, d, c, _ in rows}
    met = set()
    for (key, a, b), members in placed.items():
        assert all(m.component == component[key, m.doc_id] for m in members)
        assert all((m.side == 2) == (a == b) for m in members)
        left, right = [m.doc_id for m in members if m.side != 1], [m.doc_id for m in members if m.side != 0]
        met |= {(key, min(x, y), max(x, y)) for x in left for y in right if component[key, x] != component[key, y]}
    every = {(key, x, y) for key in (7, 8) for x in range(60) for y in range(x + 1, 60) if component[key, x] != component[key, y]}
    assert met == every
    # of different sizes, those pairs meet that can be similar enough
    sized = spark.createDataFrame([(1, d, 5 + d, 0, d) for d in range(60)], "key long, doc_id long, n long, band int, component long")
    placed, met = {}, set()
    for r in minhash.in_pairs_of_blocks(sized).collect():
        placed.setdefault((r.a, r.b), []).append(r)
    for members in placed.values():
        met |= {(min(x.doc_id, y.doc_id), max(x.doc_id, y.doc_id)) for x in members if x.side != 1 for y in members if y.side != 0 and x.doc_id != y.doc_id}
    assert met >= {(x, y) for x in range(60) for y in range(x + 1, 60) if 100 * (5 + x) >= 80 * (5 + y)} and len(met) < 60 * 59 // 2 * 0.7
    large = spark.createDataFrame([(1, d, 10, 0, 0 if d < 1000 else d) for d in range(1003)], "key long, doc_id long, n long, band int, component long")
    assert minhash.in_pairs_of_blocks(large).count() == 1000 + 3 * (1000 // block + 1)


@pytest.mark.parametrize("given,kept", [("64m", False), ("2m", True), ("1 KiB", True), ("2147483647", False), ("4194304b", True), ("1g", False)])
def test_batches_are_bounded_however_their_size_is_written(given, kept):
    from types import SimpleNamespace

    from loomgraph.llm import common

    conf = {"spark.sql.execution.arrow.maxBytesPerBatch": given}
    session = SimpleNamespace(conf=SimpleNamespace(get=conf.get, set=conf.__setitem__), sparkContext=SimpleNamespace(_loomgraph_shipped=True))
    common.prepare(session)
    assert conf["spark.sql.execution.arrow.maxBytesPerBatch"] == (given if kept else str(common.ARROW_BYTES))


def test_components_of_a_long_path(spark):
    """More rounds than any fixed number would be needed if a round merged neighbours alone."""
    links = [(i, i + 1) for i in range(3000)]
    assert {r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()} == {0}
