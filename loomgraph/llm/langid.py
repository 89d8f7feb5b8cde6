"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams of lower-cased words (FEATURES buckets), counted over all training
rows. A document is taken as a mixture: expectation-maximisation estimates each language's proportion from the trigram
likelihoods of its whole text. Among the nested sets of its m most probable languages the one of highest likelihood, less
PENALTY / 2 * log(trigrams) for each language beyond the first, is selected; the prediction is the largest share in it.

A text that is null or has no letter is `und` with score 0; so is every text where no language was learned. Rows are judged one by one: repeated rows
give repeated results, and a table without rows none. A null doc_id counts as the empty string for the training split.
Columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.llm.common import prepare

FEATURES = 4096
ROUNDS, SET_ROUNDS = 8, 5
PENALTY = 6.0
#: Languages below this share in the first estimate are not tried as further members of a set.
LEAST_SHARE = 0.02
#: The model is broadcast: 16 KB a language, so 128 MB at most. More languages than are written in the world are refused.
MOST_LANGUAGES = 8192
SMOOTHING = 0.5
#: Bytes of text hashed at a time.
SLICE = 1 << 20
UNKNOWN = "und"

_TO = np.full(256, 32, dtype=np.uint8)
_TO[65:91] = np.arange(97, 123)
_TO[97:123] = np.arange(97, 123)
_TO[128:] = np.arange(128, 256)


def histogram(texts: pa.Array) -> np.ndarray:
    """Counts of the hashed trigrams of each text, centred at every letter byte; a null text has none."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])  # offset 0
    n = len(texts)
    out = np.zeros(n * FEATURES, dtype=np.float32)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: n + 1] if n else np.zeros(1, np.int64)
    size = int(offsets[-1])
    if not size:
        return out.reshape(n, FEATURES)
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[:size]
    edges = np.zeros(size + 1, dtype=bool)  # where a text begins
    edges[offsets] = True
    for lo in range(0, size, SLICE):  # long texts in slices, each with a byte more at both ends
        hi = min(lo + SLICE, size)
        a, z = max(lo - 2, 0), min(hi + 1, size)
        b = _TO[raw[a:z]]
        upper = (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[:-1] == 0xC3)  # capitals of Latin-1
        b[1:] += upper.astype(np.uint8) << 5
        before, after = np.full(len(b), 32, dtype=np.uint8), np.full(len(b), 32, dtype=np.uint8)
        before[1:], after[:-1] = b[:-1], b[1:]
        before[edges[a:z]] = 32
        after[edges[a + 1 : z + 1]] = 32
        own = slice(lo - a, hi - a)
        b, before, after = b[own], before[own], after[own]
        h = before.astype(np.uint32) << 16
        h |= b.astype(np.uint32) << 8
        h |= after
        h *= np.uint32(2654435761)
        h >>= np.uint32(20)
        first = int(np.searchsorted(offsets, lo, side="right")) - 1
        last = int(np.searchsorted(offsets, hi, side="left"))
        lengths = np.diff(np.clip(offsets[first : last + 1], lo, hi))
        doc = np.repeat(np.arange(last - first, dtype=np.int64) * FEATURES, lengths)
        counts = np.bincount((doc + h)[b != 32], minlength=(last - first) * FEATURES)
        out[first * FEATURES : last * FEATURES] += counts
    return out.reshape(n, FEATURES)


def mixture(counts: np.ndarray, p: np.ndarray, shares: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares after so many rounds of expectation-maximisation, and the log-likelihood of the counts. Languages with share 0 stay out."""
    n = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(rounds):
        shares = shares * ((counts / np.maximum(shares @ p, 1e-30)) @ p.T) / n
        shares /= np.maximum(shares.sum(1, keepdims=True), 1e-30)
    return shares, np.einsum("df,df->d", counts, np.log(np.maximum(shares @ p, 1e-30)))


def infer(counts: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of counts, the shares in the selected language set, and the confidence in its largest."""
    docs, k = len(counts), len(p)
    n = counts.sum(1)
    single = counts @ np.log(p).T
    best = single.argmax(1)
    value = single[np.arange(docs), best].astype(np.float64)
    chosen = np.zeros((docs, k), dtype=np.float32)
    chosen[np.arange(docs), best] = 1
    if k > 1:
        first, _ = mixture(counts, p, np.full((docs, k), 1 / k, dtype=np.float32), ROUNDS)
        order = np.argsort(-first, axis=1, kind="stable")
        rank = np.argsort(order, axis=1, kind="stable")
        for m in range(2, k + 1):
            todo = np.flatnonzero(np.take_along_axis(first, order[:, m - 1 : m], 1)[:, 0] >= LEAST_SHARE)
            if not len(todo):
                break
            start = np.where(rank[todo] < m, first[todo], 0)
            got, ll = mixture(counts[todo], p, (start / start.sum(1, keepdims=True)).astype(np.float32), SET_ROUNDS)
            ll = ll - PENALTY / 2 * (m - 1) * np.log(np.maximum(n[todo], 2))
            better = ll > value[todo]
            chosen[todo[better]], value[todo[better]] = got[better], ll[better]
    # trigrams depend on each other: their evidence counts by the root of their number
    z = (single - single.max(1, keepdims=True)) / np.sqrt(np.maximum(n, 1))[:, None]
    odds = np.exp(z)
    odds /= odds.sum(1, keepdims=True)
    top = chosen.argmax(1)
    rows = np.arange(docs)
    return chosen, np.clip(chosen[rows, top] * odds[rows, top], 0, 1)


class LanguageModel:
    """languages in alphabetical order, and the probability of each feature in each."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p


def is_held_out(doc_id: str = "doc_id") -> Column:
    """The rows that training leaves out: crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame) -> LanguageModel:
    """Count features over all rows of docs(doc_id, text, lang) that have a language and aren't held out."""
    spark = docs.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                h, langs = histogram(part.column(0)), np.array(part.column(1).to_pylist(), dtype=object)
                for lang in set(langs):
                    sums[lang] = sums.get(lang, 0) + h[langs == lang].sum(0, dtype=np.float64)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(s[at].astype(np.int64))], names=["lang", "feature", "n"])

    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out()).select("text", "lang")
    found = rows.mapInArrow(run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    sums = found.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("feature", "n"))).alias("n"))
    got = {r["lang"]: r["n"] for r in sums.limit(MOST_LANGUAGES + 1).collect()}  # at most FEATURES entries a language
    if len(got) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    p = np.full((len(got), FEATURES), SMOOTHING)
    for i, lang in enumerate(sorted(got)):
        for f, n in got[lang].items():
            p[i, f] += n
    return LanguageModel(sorted(got), (p / p.sum(1, keepdims=True)).astype(np.float32))


RESULTS = ("lang_pred", "score", "languages", "shares")


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",), names: tuple[str, ...] = RESULTS) -> DataFrame:
    """The columns keep of docs(text, ...), then, under the given names, the prediction, its score, the selected set of languages (largest share first) and their shares."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.p))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    kinds = (T.StringType(), T.DoubleType(), T.ArrayType(T.StringType()), T.ArrayType(T.DoubleType()))
    fields = [*rows.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]]
    names = tuple(f.name for f in fields)
    at = keep.index("text") if "text" in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, p = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 250):
                part = batch.slice(lo, 250)
                texts = part.column(at)
                counts = histogram(texts)
                known = counts.sum(1) > 0
                for i in np.flatnonzero(known & (counts.sum(1) < 40)):  # bytes beyond ASCII may be no letters
                    known[i] = any(map(str.isalpha, texts[int(i)].as_py()))
                for i in np.flatnonzero(known & (counts.sum(1) >= 40)):
                    s = texts[int(i)].as_py()
                    known[i] = any(map(str.isalpha, s[:200])) or any(map(str.isalpha, s))
                pred, score, sets, parts = [UNKNOWN] * len(counts), np.zeros(len(counts)), [[] for _ in counts], [[] for _ in counts]
                if languages and known.any():
                    rows = np.flatnonzero(known)
                    chosen, conf = infer(counts[rows], p)
                    for i, c, s in zip(rows.tolist(), chosen, conf.tolist(), strict=True):
                        order = [j for j in np.argsort(-c, kind="stable").tolist() if c[j] > 0]
                        pred[i], score[i] = languages[order[0]], s
                        sets[i], parts[i] = [languages[j] for j in order], [float(c[j]) for j in order]
                out = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *out], names=names)

    if "text" not in keep:
        rows = docs.select(*[F.col(f"`{c}`") for c in keep], "text")
    return rows.mapInArrow(run, T.StructType(fields))


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs without those whose language is unknown. Where no language was learned, those with a letter stay."""
    if not model.languages:
        model = LanguageModel(["any"], np.full((1, FEATURES), 1 / FEATURES, dtype=np.float32))
    names = tuple(docs.columns)
    own = tuple(f"_langid_{i}_{'_'.join(names)}" for i in range(4))  # no column has such a name
    return predict(docs, model, names, own).where(F.col(f"`{own[0]}`") != UNKNOWN).select(*[F.col(f"`{c}`") for c in names])
