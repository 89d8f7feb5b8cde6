"""Packing token sequences: bounded-space online best fit, with leftovers merged afterwards.

Every partition keeps a fixed number of open windows. A document's tokens first fill whole windows of their own; its
remainder goes to the open window that it fits most tightly. Where it fits none and no further window may be opened, the fullest window is topped
up with the head of the remainder (if its gap is worth a cut) and emitted. Windows still open at a partition's end are
leftovers; their pieces are packed anew in a tree of bounded fan-in, so that no task sees more than FAN_IN * OPEN_WINDOWS windows.

Null or empty texts become the separator alone. Tables without rows give no rows. Repeated rows are packed once each.
Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import materialize, prepare

WINDOW = 1024
OPEN_WINDOWS = 32
#: A gap of fewer tokens is padded, not filled by cutting another document.
LEAST_CUT = 16
FAN_IN = 64
SEPARATOR = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts with an unbroken run of this many characters go to the slower library, whose work on one run is bounded.
LONG_RUN = 5000

_encoders: dict[str, object] = {}


def byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelEncoder:
    """Ids of a byte-level BPE file. Uses the rank-based library where the file's merges are in the order of their ids, else the file's own library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.fast = None
        spec = json.load(open(path, encoding="utf-8"))
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        chars, vocab = byte_chars(), model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        simple = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec["added_tokens"])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        in_order = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        kind = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and spec["normalizer"] is None
        if simple and in_order and kind and not model.get("ignore_merges"):
            import tiktoken

            ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and (len(text) < LONG_RUN or max(map(len, text.split()), default=0) < LONG_RUN and not _long_space(text)):
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _long_space(text: str) -> bool:
    """Whether white space runs on for LONG_RUN characters."""
    import re

    return re.search(r"\s{%d}" % LONG_RUN, text) is not None


def encoder(path: str) -> ByteLevelEncoder:
    if path not in _encoders:
        _encoders[path] = ByteLevelEncoder(path)
    return _encoders[path]


class Windows:
    """The open windows of one partition, and the rows of those emitted."""

    def __init__(self, first_id: int, size: int, most_open: int, least_cut: int):
        self.size, self.most_open, self.least_cut = size, most_open, least_cut
        self.next_id = first_id
        self.open: list[list] = []  # [used, sequence id, pieces as (doc_id, start, ids, doc_tokens, offset)]
        self.rows: list[tuple] = []

    def start(self) -> list:
        w = [0, self.next_id, []]
        self.next_id += 1
        return w

    def put(self, w: list, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        w[2].append((doc_id, start, ids, total, w[0]))
        w[0] += len(ids)

    def emit(self, w: list, leftover: bool = False) -> None:
        for doc_id, start, ids, total, offset in w[2]:
            raw = ids.tobytes()
            self.rows.append((doc_id, start, len(ids), zlib.crc32(raw), total, w[1], offset, raw if leftover else None))

    def add(self, doc_id, ids: np.ndarray, start: int = 0, total: int | None = None) -> None:
        """Place the tokens of a document from start on; total: how many it has in all."""
        at, n, total = 0, len(ids), len(ids) if total is None else total
        while n - at >= self.size:
            w = self.start()
            self.put(w, doc_id, start + at, ids[at : at + self.size], total)
            self.emit(w)
            at += self.size
        while at < n:
            rest = ids[at:]
            fits = [w for w in self.open if self.size - w[0] >= len(rest)]
            if fits:
                w = max(fits, key=lambda x: x[0])
                self.put(w, doc_id, start + at, rest, total)
                at = n
                if w[0] == self.size:
                    self.open.remove(w)
                    self.emit(w)
            elif len(self.open) < self.most_open:
                self.open.append(self.start())
            else:
                w = max(self.open, key=lambda x: x[0])
                if (gap := self.size - w[0]) >= self.least_cut:
                    self.put(w, doc_id, start + at, rest[:gap], total)
                    at += gap
                self.open.remove(w)
                self.emit(w)

    def close(self, leftover: bool) -> None:
        """Emit all open windows."""
        for w in self.open:
            self.emit(w, leftover)
        self.open = []


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
#: ids: those of pieces in leftover windows, null for others.
LEFT = f"{PIECES}, ids binary"


def _pack(path: str, size: int, most_open: int, least_cut: int):
    kinds = [pa.int64()] * 7 + [pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(path)
        windows = Windows(TaskContext.get().partitionId() << 32, size, most_open, least_cut)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                windows.add(doc_id, np.append(encode(text or ""), np.uint32(SEPARATOR)).astype("<u4"))
            if windows.rows:
                yield table(windows.rows)
                windows.rows = []
        windows.close(leftover=True)
        if windows.rows:
            yield table(windows.rows)

    return run


def _merge(level: int, size: int, most_open: int, least_cut: int, last: bool):
    """Pack the pieces of a group's leftover windows anew, those of the fullest windows first. In the last group, what is left at the end fills one window after the other."""

    def run(key, pdf):
        import pandas as pd

        first = (level << 58) + (int(key[0]) << 24)
        pdf = pdf.assign(_used=pdf.groupby("sequence_id")["length"].transform("sum")).sort_values(["_used", "sequence_id", "offset"], ascending=[False, True, True], kind="stable")
        windows = Windows(first, size, most_open, least_cut)

        def pour(pieces) -> None:
            for doc_id, start, raw, total in pieces:
                windows.add(doc_id, np.frombuffer(raw, dtype="<u4"), int(start), int(total))

        ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
        pour(zip(ids, pdf["start"], pdf["ids"], pdf["doc_tokens"], strict=True))
        if last:
            left = [(d, s, i.tobytes(), t) for w in sorted(windows.open, key=lambda w: -w[0]) for d, s, i, t, _ in w[2]]
            windows.open, windows.most_open, windows.least_cut = [], 1, 1
            pour(left)
        windows.close(leftover=not last)
        out = pd.DataFrame(windows.rows, columns=NAMES)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = WINDOW, most_open: int = OPEN_WINDOWS, least_cut: int = LEAST_CUT) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of docs(doc_id, text), each document closed by SEPARATOR."""
    spark = docs.sparkSession
    prepare(spark)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pack(tokenizer, size, most_open, least_cut), LEFT)
    pieces = materialize(pieces, "pieces")  # a few dozen bytes a document; only tokens of leftover windows are stored
    done = [pieces.where("ids IS NULL").drop("ids")]
    rest = pieces.where("ids IS NOT NULL").withColumn("_group", F.shiftright("sequence_id", 32))
    groups, level = (rest.agg(F.max("_group")).first()[0] or 0), 0
    while True:
        groups, level = groups // FAN_IN, level + 1
        by_group = rest.withColumn("_group", F.floor(F.col("_group") / FAN_IN).cast("long")).groupBy("_group")
        merged = by_group.applyInPandas(_merge(level, size, most_open, least_cut, groups == 0), LEFT)
        merged = materialize(merged, "leftovers")
        done.append(merged.where("ids IS NULL").drop("ids"))
        if not groups:
            break
        rest = merged.where("ids IS NOT NULL").withColumn("_group", F.shiftright(F.col("sequence_id").bitwiseAND(F.lit((1 << 58) - 1)), 24))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
