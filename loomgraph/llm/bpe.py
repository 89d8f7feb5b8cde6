"""BPE encoding by a priority queue of merge ranks over a doubly linked symbol list; decoding by concatenating vocabulary strings.

Covers tokenizer files whose text is normalised by NFC, white space to a space and lower case, split by the pattern below and
mapped to byte stand-ins, with a word-end suffix. White space always ends a word, so encodings are kept by white-space
separated chunk, in a table of bounded size for each worker.

Null texts count as empty: no tokens. Rows are judged one by one, so repeated rows give repeated results, and empty tables none.
Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import prepare
from loomgraph.llm.packing import byte_chars

WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks kept by a worker, about 200 bytes each.
KEPT_CHUNKS = 700_000
#: str.split() takes these for white space, the split pattern doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")
_LOW = (1 << 32) - 1


#: fixed values: the only normalisation, splitting and merging that is covered
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def check_kind(spec: dict, path: str) -> None:
    """Raise if a tokenizer file isn't of the kind that this module covers."""
    found = (spec["model"]["type"], (spec["normalizer"] or {}).get("normalizers"), (spec["pre_tokenizer"] or {}).get("pretokenizers"), spec.get("decoder"))
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
    if found != ("BPE", NORMALIZERS, SPLITTERS, None) or not plain or spec["model"].get("byte_fallback") or spec["model"].get("ignore_merges"):
        raise ValueError(f"a tokenizer file of another kind: {path}")


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, kept: int = KEPT_CHUNKS):
        spec = json.load(open(path, encoding="utf-8"))
        check_kind(spec, path)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.strings = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.gate = os.path.commonprefix(list(self.special))  # a text without it has no special token
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank.setdefault(self.vocab[a] << 20 | self.vocab[b], r)
            self.made.append(self.vocab[a + b])
        stand_in = {b: c for c, b in byte_chars().items()}
        self.byte_id = [self.vocab.get(stand_in[b], -1) for b in range(256)]
        self.last_id = [self.vocab.get(stand_in[b] + self.suffix, -1) for b in range(256)]
        self.words = regex.compile(WORDS)
        self.spaces = regex.compile(r"\s+")
        self.kept = kept
        self.chunks: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge a word's symbols, lowest rank first and leftmost among equals. Queue entries whose pair has changed since are skipped."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank, made = self.rank.get, self.made
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            r = rank(symbols[i] << 20 | symbols[i + 1])
            if r is not None:
                queue.append(r << 32 | i)
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            e = pop(queue)
            i, r = e & _LOW, e >> 32
            j = right[i]
            if symbols[i] < 0 or j == n or rank(symbols[i] << 20 | symbols[j]) != r:
                continue  # stale
            new = symbols[i] = made[r]
            symbols[j] = -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                q = rank(new << 20 | symbols[k])
                if q is not None:
                    push(queue, q << 32 | i)
            p = left[i]
            if p >= 0:
                q = rank(symbols[p] << 20 | new)
                if q is not None:
                    push(queue, q << 32 | p)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        raw = word.encode()
        symbols = [self.byte_id[b] for b in raw]
        symbols[-1] = self.last_id[raw[-1]]
        return self.merge([s for s in symbols if s >= 0])

    def chunk(self, chunk: str) -> bytes:
        """The ids of a chunk without white space, as little-endian unsigned 32-bit integers; kept for the next time, as are those of its words."""
        if len(self.chunks) >= self.kept:
            self.chunks.clear()
        words = self.words.findall(chunk)
        if len(words) == 1:
            out = np.array(self.word(words[0]), dtype="<u4").tobytes()
        else:  # a word by itself is a chunk with the same ids
            out = b"".join([self.chunks.get(w) or self.chunk(w) for w in words])
        self.chunks[chunk] = out
        return out

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # characters are lowered one by one: no final sigma
        return text.lower()

    def encode_bytes(self, text: str) -> bytes:
        """Ids of the whole text; the special tokens' strings inside it give their ids."""
        if self.cut is not None and self.gate in text and len(parts := self.cut.split(text)) > 1:
            return b"".join(np.uint32(self.special[p]).astype("<u4").tobytes() if p in self.special else self._plain(p) for p in parts if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        text = self.normal(text)
        chunks = text.split() if ODD_SPACE.search(text) is None else [c for c in self.spaces.split(text) if c]
        found = list(map(self.chunks.get, chunks))
        if None in found:
            for i, f in enumerate(found):
                if f is None:
                    found[i] = self.chunks.get(chunks[i]) or self.chunk(chunks[i])
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: vocabulary strings are concatenated with a space between."""
        return " ".join(map(self.strings.__getitem__, ids))


_loaded: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _run(path: str, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            n, ids_sha, text_sha, ids_all, decoded = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                raw = bpe.encode_bytes(text or "")
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                back = bpe.decode(ids)
                n.append(len(ids))
                if whole:
                    ids_all.append(ids)
                    decoded.append(back)
                else:
                    ids_sha.append(hashlib.sha256(raw).hexdigest())
                    text_sha.append(hashlib.sha256(back.encode()).hexdigest())
            if whole:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids_all, pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) of docs(doc_id, text)."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_run(tokenizer, True), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode_decode() with ids and text digested where they arise, so that they don't pass between processes."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_run(tokenizer, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
