"""Packing, BPE and token counts against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomgraph.llm import bpe, packing, queries, tokencount

BYTE, WORD, PIECE = (queries.tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
CORNERS = ["", " ", "\n", "a", "The cat's <|endoftext|> sat.  \t\n", "ΑΣ Σας İstanbul é́ é", "x" * 7000, " " * 6000 + "b", "a<s></s><unk><0x0A>▁▁ b", "中文字 😀\x00\x1c\x85 z", "don't we'll I'VE", "<|startoftext|><|endoftext|>", "ab " * 3000]
texts = st.text(alphabet=st.sampled_from(list("  \n\tabcthe.,<>|'sİΣſéü0①中ก😀\x1c\x85▁²")), max_size=60)


@pytest.fixture(scope="module")
def libs():
    import sentencepiece
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_word_bpe_is_the_library_s(libs, text):
    own, lib = bpe.word_bpe(WORD), libs[1]
    ids = lib.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_counts_at_every_prefix_are_the_library_s(libs, text):
    own, lib = tokencount.prefix_counts(PIECE), libs[2]
    assert own.count(text) == len(lib.encode(text))
    assert own.prefix_table(text).tolist() == [len(lib.encode(text[:i])) for i in range(len(text) + 1)]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_byte_level_ids_are_the_library_s(libs, text):
    assert packing.encoder(BYTE)(text).tolist() == libs[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", CORNERS)
def test_corner_texts(libs, text):
    assert packing.encoder(BYTE)(text).tolist() == libs[0].encode(text, add_special_tokens=False).ids
    assert bpe.word_bpe(WORD).encode(text) == libs[1].encode(text, add_special_tokens=False).ids
    assert tokencount.prefix_counts(PIECE).count(text) == len(libs[2].encode(text))


def test_small_caches_change_nothing(libs):
    own = bpe.WordBpe(WORD, kept=3)
    count = tokencount.PrefixCounts(PIECE, kept=3)
    text = "one two three four five one two three four five " * 3
    assert own.encode(text) == libs[1].encode(text, add_special_tokens=False).ids
    assert count.count(text) == len(libs[2].encode(text))


def test_truncation_to_a_budget(spark, docs_of, libs):
    text = "Some words, then more words.\nAnd a line  with  spaces."
    got = {r.doc_id: r.text for r in tokencount.truncate(docs_of([(1, text), (2, None), (3, "")]), PIECE, 7).collect()}
    assert got[2] is None and got[3] == ""
    assert text.startswith(got[1]) and len(libs[2].encode(got[1])) <= 7 < len(libs[2].encode(text[: len(got[1]) + 1]))
    table = {r.doc_id: r.counts for r in tokencount.prefix_counts_of(docs_of([(1, "ab"), (2, None)]), PIECE).collect()}
    assert table == {1: [0, len(libs[2].encode("a")), len(libs[2].encode("ab"))], 2: [0]}


def test_queries_on_whole_tables(spark, sf, libs):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op9_bpe(spark, sf).collect()}
    counts = {r.doc_id: r for r in queries.op10_token_counts(spark, sf).collect()}
    assert set(got) == set(counts) == set(docs)
    for i, t in docs.items():
        ids = libs[1].encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(libs[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()
        n = len(libs[2].encode(t))
        assert (counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) == (len(t.encode()), n, n > 4096)


def check_packing(rows, docs, lib, size=1024):
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append([*lib.encode(t or "", add_special_tokens=False).ids, 0])
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        if len(want[i]) > 1:  # rows repeated under one id
            assert sum(p.length for p in pieces) == sum(map(len, want[i]))
            continue
        ids, at = want[i][0], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    total = sum(r.length for r in rows)
    return len(by_seq) * size / total if total else 1


def test_packing_a_table(spark, sf, libs):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check_packing(queries.op6_packing(spark, sf).collect(), docs, libs[0]) < 1.01


def test_packing_corner_rows(spark, docs_of, libs):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["ab", "the", "of", "qu"]) for _ in range(rng.randrange(0, 90)))) for i in range(300)] + [(400, None), (401, ""), (402, "word " * 9000), (403, "twice"), (403, "twice")]
    assert check_packing(packing.pack(docs_of(docs, 40), BYTE).collect(), docs, libs[0]) < 1.05
    assert packing.pack(docs_of([]), BYTE).count() == 0


def test_leftovers_merge_in_levels(spark, docs_of, libs, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    docs = [(i, "some words here " * (i % 7)) for i in range(60)]
    check_packing(packing.pack(docs_of(docs, 30), BYTE, size=64, most_open=2).collect(), docs, libs[0], 64)


def test_row_wise_operators_on_corner_tables(spark, docs_of):
    rows = [(1, None), (None, "a b"), (2, ""), (3, "x" * 100_000), (4, "same"), (4, "same")]
    for f, path in ((bpe.digests, WORD), (tokencount.count_tokens, PIECE), (bpe.encode_decode, WORD)):
        assert f(docs_of(rows), path).count() == 6
        assert f(docs_of([]), path).count() == 0
    by = {r.doc_id: r for r in bpe.digests(docs_of(rows), WORD).collect()}
    assert by[1].n_tokens == by[2].n_tokens == 0 and by[1].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_both_byte_level_libraries_agree_on_every_code_point():
    """Texts go to one or the other by the length of their unbroken runs; the ids are the same either way."""
    own = packing.encoder(BYTE)
    assert own.fast is not None
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 4000):
        chars = [chr(c) for c in points[lo : lo + 4000]]
        for text in ("".join(chars), " ".join(chars), "".join(f"a{c}1{c}{c}'s {c}\n" for c in chars)):
            assert own.fast.encode(text, allowed_special="all") == own.slow.encode(text, add_special_tokens=False).ids


def plain_pack(docs, size, most_open, least_cut):
    """The online part of packing, written plainly: (pieces of finished windows, pieces of those left open), a window as a list of (doc, start, length)."""
    done, open_ = [], []
    room = lambda w: size - sum(x[2] for x in w)
    for doc, n in docs:
        at = 0
        while n - at >= size:
            done.append([(doc, at, size)])
            at += size
        while at < n:
            fitting = [w for w in open_ if room(w) >= n - at]
            if fitting:
                w = min(fitting, key=room)
                w.append((doc, at, n - at))
                at = n
                if not room(w):
                    open_.remove(w)
                    done.append(w)
            elif len(open_) < most_open:
                open_.append([])
            else:
                w = min(open_, key=room)
                if room(w) >= least_cut:
                    gap = room(w)
                    w.append((doc, at, gap))
                    at += gap
                open_ = [x for x in open_ if x is not w]
                done.append(w)
    return done, open_


@pytest.mark.parametrize("most_open,least_cut", [(32, 16), (3, 1), (1, 64)])
def test_windows_are_those_of_a_plain_packer(most_open, least_cut):
    rng = random.Random(most_open)
    docs = [(k, rng.choice([rng.randint(1, 40), rng.randint(1, 300), 256, 700])) for k in range(400)]
    w = packing.Windows(0, 256, most_open, least_cut)
    for doc, n in docs:
        w.add(doc, np.arange(n, dtype="<u4"))
    found = {}
    for doc, start, length, crc, total, sequence, offset, _ in w.rows:
        assert crc == zlib.crc32(np.arange(start, start + length, dtype="<u4").tobytes()) and total == dict(docs)[doc]
        found.setdefault(sequence, []).append((offset, doc, start, length))
    done, left = plain_pack(docs, 256, most_open, least_cut)
    assert sorted([x[1:] for x in sorted(f)] for f in found.values()) == sorted(done)
    assert sorted([(d, s, len(i)) for d, s, i, _, _ in x[2]] for x in w.open) == sorted(left)


def test_files_of_other_kinds_are_refused(tmp_path):
    import json

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = json.load(open(WORD, encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()
    (tmp_path / "w.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="another kind"):
        bpe.WordBpe(str(tmp_path / "w.json"))
    m = pb.ModelProto.FromString(sentencepiece.SentencePieceProcessor(model_file=PIECE).serialized_model_proto())
    m.normalizer_spec.add_dummy_prefix = False
    with pytest.raises(ValueError, match="another kind"):
        tokencount.check_kind(m.SerializeToString(), PIECE)
