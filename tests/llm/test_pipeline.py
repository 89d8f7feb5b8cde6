"""The pipeline stage by stage."""

import random
import re
import zlib

import corpus_pipeline as cp
import numpy as np
from loomgraph.llm import queries, secrets
from loomgraph.llm.common import materialize

from .test_dedup import brute_groups


def test_stages_on_a_table(spark, sf):
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), name)
        assert docs.columns == first.columns, name
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3] == counts[4] > 0
    pieces = cp.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert sorted(map(tuple, cp.run(spark, sf).collect())) == sorted(map(tuple, pieces))


def test_planted_cases(spark, docs_of):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(3))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, twin = prose(60), prose(100)
    docs = [(1, prose(50)), (2, twin), (3, twin), (4, twin + " " + word()), (5, prose(30) + " " + passage + " " + prose(30)), (6, prose(30) + " " + passage + " " + prose(30)), (7, None), (8, "1 2 3"), (9, prose(20) + " password=abcdefghijklmnop " + prose(20))]
    table = docs_of(docs).selectExpr("doc_id", "text", "CASE WHEN doc_id < 7 THEN 'en' END AS lang", "source", "n_chars", "spans")
    stages = dict(cp.STAGES)
    one = stages["language_id"](spark, table, "")
    assert sorted(r.doc_id for r in one.collect()) == [1, 2, 3, 4, 5, 6, 9]
    two = stages["near_dedup"](spark, one, "")
    assert sorted(r.doc_id for r in two.collect()) == [1, 2, 5, 6, 9]
    three = {r.doc_id: r.text for r in stages["suffix_dedup"](spark, two, "").collect()}
    assert passage in three[5] and passage not in three[6] and three[1] == docs[0][1]
    four = {r.doc_id: r.text for r in stages["secrets"](spark, two, "").collect()}
    assert "abcdefghijklmnop" not in four[9] and "[SECRET]" in four[9] and four[1] == docs[0][1]


def test_empty_table(spark, docs_of):
    docs = docs_of([]).selectExpr("doc_id", "text", "cast(lang AS string) AS lang", "source", "n_chars")
    for _, stage in cp.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0


def plain_cut(docs):
    """Texts without 100-byte strings that start earlier, whole characters only."""
    seen, out = set(), {}
    for i, t in sorted(docs.items()):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            g = b[p : p + 100]
            if g in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(g)
        kept, at = "", 0
        for c in t:
            n = len(c.encode())
            kept += "" if all(gone[at : at + n]) else c
            at += n
        out[i] = kept
    return out


def plain_mask(text):
    spans = []
    for r in secrets.RULES:
        for m in re.finditer(r.pattern, text):
            if len(m[r.group]) >= r.least:
                spans.append((m.start() + (len(m[1]) if r.border else 0), m.end()))
    out, at = "", 0
    for s, e in sorted(spans):
        if s >= at:
            out += text[at:s] + secrets.MASK
        at = max(at, e)
    return out + text[at:]


def test_the_whole_against_plain_stages(spark, sf):
    """Every stage written plainly, one after the other, for every row of a table."""
    from tokenizers import Tokenizer

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if any(map(str.isalpha, r.text or ""))}
    docs = {i: docs[i] for i, (_, c) in brute_groups(list(docs.items()), 5, 80).items() if i == c}
    docs = {i: plain_mask(t) for i, t in plain_cut(docs).items()}
    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    ids = {i: np.array([*lib.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for i, t in docs.items()}
    pieces = cp.run(spark, sf).collect()
    found, windows = {}, {}
    for p in pieces:
        assert zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids[p.doc_id])
        found.setdefault(p.doc_id, []).append((p.start, p.length))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, own in ids.items():
        at = 0
        for start, length in sorted(found.pop(i)):
            assert start == at
            at += length
        assert at == len(own)
    assert not found
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 1024


def test_odd_rows_at_every_stage(spark, docs_of):
    """Rows without text or id, repeated rows, rows that share an id, a very long text, at each stage by itself."""
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choice("aeioubcdfgh") for _ in range(5)) for _ in range(n))
    a, b, long = prose(50), prose(50), prose(40_000)
    rows = [(1, a), (1, a), (2, a), (2, b), (None, prose(30)), (None, None), (3, None), (4, ""), (5, long), (6, "x")]
    table = docs_of(rows)
    one, two, three, four = (stage(spark, table, "") for _, stage in cp.STAGES[:-1])
    ids = lambda df: sorted((-1 if r.doc_id is None else r.doc_id) for r in df.collect())
    assert ids(one) == [-1, 1, 1, 2, 2, 5, 6]
    assert ids(two) == [-1, -1, 1, 2, 3, 4, 5, 6]  # copies of a go, those of empty sets are linked with nothing
    assert ids(three) == ids(four) == sorted(-1 if i is None else i for i, _ in rows)
    assert {r.text for r in three.where("doc_id = 5").collect()} == {long}
    assert all(df.columns == table.columns for df in (one, two, three, four))
    packed = cp.STAGES[-1][1](spark, table, "").collect()
    assert sum(r.length for r in packed) == sum(r.doc_tokens for r in packed if r.start == 0) and len([r for r in packed if r.start == 0]) == len(rows)
