"""Token counts by prefix dynamic programming, for BPE models of pieces with byte fallback.

Of every prefix of a chunk the last token of its encoding is found from those of shorter prefixes: it is the one vocabulary
piece t ending there that the encoding of the rest, ending in s, may be followed by, that is, for which no merge across the
seam of s and t comes before those that make s and t. One more token than for the rest is the count. So a text's counts at all its
prefixes are known after one pass, and where to cut it for a budget needs no further encoding.

Texts are cut into chunks where no piece reaches across: before a space mark that follows another character, and around line
ends. Chunk totals are kept in a table of bounded size for each worker.

Null texts count as empty: no tokens. Rows are judged one by one, so repeated rows give repeated results, and empty tables none.
Columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import prepare

MARK = "▁"
#: Chunks kept by a worker, about 130 bytes each, and judged seams, about 150.
KEPT_CHUNKS, KEPT_SEAMS = 1_000_000, 400_000
#: Prefixes of this many characters are kept with their counts and last tokens, as words share them.
HEAD, KEPT_HEADS = 7, 60_000
_NEVER = 1 << 60


def check_kind(raw: bytes, path: str) -> None:
    """Raise if a model isn't of the kind that this module covers: BPE, text kept as it is but for the space marks, no pieces defined by its user."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto.FromString(raw)
    n, kinds = m.normalizer_spec, {p.type for p in m.pieces}
    plain = n.name == "identity" and not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
    if m.trainer_spec.model_type != pb.TrainerSpec.BPE or not plain or m.trainer_spec.treat_whitespace_as_suffix or pb.ModelProto.SentencePiece.USER_DEFINED in kinds:
        raise ValueError(f"a model of another kind: {path}")


class PrefixCounts:
    """Counts of one sentencepiece BPE model file (no normalisation but the space mark before the text and for spaces)."""

    def __init__(self, path: str, kept: int = KEPT_CHUNKS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        check_kind(sp.serialized_model_proto(), path)
        self.rank: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i)):
                self.rank[sp.id_to_piece(i)] = round(-sp.get_score(i))
        if any(a != MARK for p in self.rank for a, b in zip(p, p[1:], strict=False) if b == MARK) or any("\n" in p for p in self.rank):
            raise ValueError("pieces of this model reach across words or lines")
        self.longest = max(map(len, self.rank))
        #: The longest piece that ends in given two characters.
        self.reach: dict[str, int] = {}
        for p in self.rank:
            self.reach[p[-2:]] = max(self.reach.get(p[-2:], 1), len(p))
        self.heads: dict[str, tuple[list, list]] = {}
        #: Pairs of characters that stand next to each other in some piece. Between others a text can be cut.
        self.pairs = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.ends = re.compile(r"[\W_]+$")
        self.kept = kept
        self.bare: dict[str, int] = {}
        self.marked: dict[str, int] = {}  # words after a single space
        self.sides: dict[str, tuple[list, list]] = {}
        self.seams: dict[tuple[str, str], bool] = {}
        self.runs = re.compile(" +[^ ]*|[^ ]+")

    def edges(self, piece: str) -> tuple[list, list]:
        """The symbols at a piece's left and right edge while it is made, each with the rank of the merge that ends it."""
        found = self.sides.get(piece)
        if found is not None:
            return found
        symbols = list(piece)
        lefts, rights = [], []
        while len(symbols) > 1:
            best = min(((self.rank[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in self.rank), default=None)
            if best is None:
                break  # a piece that merging never makes
            r, i = best
            if i == 0:
                lefts.append((symbols[0], r))
            if i == len(symbols) - 2:
                rights.append((symbols[-1], r))
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        whole = len(symbols) == 1
        out = self.sides[piece] = ([*lefts, (piece, _NEVER)], [*rights, (piece, _NEVER)]) if whole else ([], [])
        return out

    def joined(self, a: str, b: str) -> bool:
        """Whether pieces a and b stay apart when their characters are encoded together."""
        key = (a, b)
        out = self.seams.get(key)
        if out is None:
            rights, lefts, rank = self.edges(a)[1], self.edges(b)[0], self.rank.get
            out = bool(rights and lefts)
            for x, end_x in rights:
                for y, end_y in lefts:
                    r = rank(x + y)
                    # of equal ranks the leftmost goes first
                    if r is not None and r < end_x and r <= end_y:
                        out = False
                        break
                if not out:
                    break
            if len(self.seams) >= KEPT_SEAMS:
                self.seams.clear()
            self.seams[key] = out
        return out

    def chunk(self, s: str) -> list[int]:
        """Token counts at all prefixes of a chunk, from the empty one."""
        head = s[:HEAD]
        known = self.heads.get(head)
        if known is None:
            counts, last = [0], [None]
            self._extend(head, counts, last)
            if len(self.heads) >= KEPT_HEADS:
                self.heads.clear()
            self.heads[head] = (counts, last)
        else:
            counts, last = known
        if len(s) > HEAD:
            counts, last = counts.copy(), last.copy()
            self._extend(s, counts, last)
        return counts

    def _extend(self, s: str, counts: list[int], last: list[str | None]) -> None:
        """Carry counts and last tokens on from the prefixes that have them to all of s."""
        rank, reach, seams = self.rank, self.reach.get, self.seams.get
        for i in range(len(counts), len(s) + 1):
            far = reach(s[i - 2 : i], 1) if i > 1 else 1
            for j in range(i - far if i > far else 0, i):
                t = s[j:i]
                if t in rank:
                    before = last[j]
                    if before is None:
                        fits = self.edges(t)[0]
                    else:
                        fits = seams((before, t))
                        if fits is None:
                            fits = self.joined(before, t)
                    if fits:
                        counts.append(counts[j] + 1)
                        last.append(t)
                        break
            else:
                counts.append(counts[-1] + len(s[i - 1].encode()))  # as bytes
                last.append(None)

    def total(self, chunk: str, table: dict[str, int], before: str = "") -> int:
        """Tokens of before + chunk, kept in table under chunk."""
        out = table.get(chunk)
        if out is None:
            end = self.ends.search(chunk)
            if end is not None and end.start() and chunk[end.start() - 1 : end.start() + 1] not in self.pairs:
                # punctuation after a word, which no piece joins to it
                out = self.total(chunk[: end.start()], table, before) + self.total(chunk[end.start() :], self.bare)
            else:
                out = self.chunk(before + chunk)[-1]
            if len(table) >= self.kept:
                table.clear()
            table[chunk] = out
        return out

    def pieces(self, text: str) -> Iterator[str]:
        """The chunks of a text, line ends apart, with the mark for spaces."""
        if not text:
            return
        first = True
        for line in text.replace(MARK, " ").split("\n"):
            if not first:
                yield "\n"
            line = " " + line if first else line
            for c in self.runs.findall(line):
                yield c.replace(" ", MARK)
            first = False

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        lines = (" " + text).split("\n")
        n = len(lines) - 1
        if "  " in text or text[0] == " ":
            return n + sum(self.total(c.replace(" ", MARK), self.bare) for line in lines for c in self.runs.findall(line))
        for line in lines:
            head, *words = line.split(" ")
            if head:
                n += self.total(head, self.bare)
            found = list(map(self.marked.get, words))
            if None in found:
                found = [self.total(w, self.marked, MARK) if f is None else f for f, w in zip(found, words, strict=True)]
            n += sum(found)
        return n

    def prefix_table(self, text: str) -> np.ndarray:
        """Token counts at every prefix of text, by characters: entry i is that of text[:i]."""
        out = np.zeros(len(text) + 1, dtype=np.int64)
        at = base = 0
        for k, c in enumerate(self.pieces(text)):
            counts = [0, 1] if c == "\n" else self.chunk(c)
            values = np.array(counts[1:], dtype=np.int64) + base
            if k == 0:
                values = values[1:]  # the mark before the text is no character of it
            out[at + 1 : at + 1 + len(values)] = values
            at += len(values)
            base += counts[-1]
        return out

    def cut(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most budget tokens."""
        return int(np.flatnonzero(self.prefix_table(text) <= budget)[-1])


_loaded: dict[str, PrefixCounts] = {}


def prefix_counts(path: str) -> PrefixCounts:
    if path not in _loaded:
        _loaded[path] = PrefixCounts(path)
    return _loaded[path]


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(path)
        for batch in batches:
            n = [counter.count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(2)], names=["doc_id", "n_tokens", "n_bytes"])

    return run


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, n_bytes) of docs(doc_id, text)."""
    prepare(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", size.alias("n_bytes")).mapInArrow(_run(model), "doc_id long, n_tokens long, n_bytes long")


def prefix_counts_of(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, counts): the token count at every prefix of the text, from the empty one."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(model)
        for batch in batches:
            for i, t in enumerate(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([counter.prefix_table(t or "")], pa.list_(pa.int64()))], names=["doc_id", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, counts array<long>")


def truncate(docs: DataFrame, model: str, budget: int) -> DataFrame:
    """(doc_id, text) with each text cut to its longest prefix of at most budget tokens."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_counts(model)
        for batch in batches:
            texts = [None if t is None else t[: counter.cut(t, budget)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string")
