"""The queries of this subpackage, by name, and their SQL where SQL can express them. Each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import bpe, egojoin, kdtree, langid, minhash, packing, secrets, suffixdedup, tokencount, urlfilter
from loomgraph.llm.common import shared_dir


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ledger_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the ledger of a folder's texts is kept, in the shared folder: a later run over the same one scans what it doesn't know."""
    return f"{shared_dir(spark)}/loomgraph/secret-ledger/{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"


def op1_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.95, every_row=True)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    judged = langid.predict(docs.withColumn("held_out", langid.is_held_out()), langid.train(docs), keep=("doc_id", "held_out"))
    return judged.select("doc_id", "held_out", "lang_pred", "score", "languages", "shares")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(documents(spark, sf_dir), at=ledger_path(spark, sf_dir))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=4, percent=80, without_id=True)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(documents(spark, sf_dir), without_id=True)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_near_embeddings, op2_url_filter, op3_language_id, op4_secrets, op5_top_k, op6_packing, op7_minhash, op8_suffix_dedup, op9_bpe, op10_token_counts)}
_REACH = """reach AS (SELECT id, id AS c FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.c),
groups AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""
_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: coalesce(NOT isfinite(x::DOUBLE), true)))"

OP1_SQL = f"""WITH RECURSIVE nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings WHERE vec_id IS NOT NULL),
v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS x FROM embeddings WHERE {_USABLE} AND list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.id <> q.id AND list_inner_product(p.x, q.x) / sqrt(list_inner_product(p.x, p.x) * list_inner_product(q.x, q.x)) >= 0.95),
{_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.a = groups.id) AS n_links, component_id, id = component_id AS kept FROM groups"""

OP5_SQL = f"""WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings WHERE {_USABLE}),
scored AS (SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.id % 50 = 0 AND q.id <> c.id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

OP7_SQL = f"""WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
sizes AS (SELECT id, count(*) AS n FROM s GROUP BY id),
shared AS (SELECT p.id AS a, q.id AS b, count(*) AS n FROM s p JOIN s q ON p.g = q.g AND p.id <> q.id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
{_REACH}
SELECT groups.id AS doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, component_id, groups.id = component_id AS kept FROM groups LEFT JOIN sizes ON sizes.id = groups.id"""

OP8_SQL = """WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, p, md5_number(b[p + 1:p + 100]) AS g FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 99)) AS p FROM t)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
marked AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM later),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM marked),
runs AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM numbered GROUP BY doc_id, r),
cuts AS (SELECT doc_id, list(s ORDER BY s) AS s, list(e ORDER BY s) AS e, count(*) AS n, sum(e - s)::BIGINT AS gone FROM runs GROUP BY doc_id)
SELECT t.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN n IS NULL THEN b ELSE unhex(array_to_string(list_transform(range(1, n + 2), lambda i: hex(b[(CASE WHEN i = 1 THEN 1 ELSE e[i - 1] + 1 END):(CASE WHEN i > n THEN octet_length(b) ELSE s[i] END)])), '')) END) AS kept_sha256
FROM t LEFT JOIN cuts USING (doc_id)"""

#: What remains needs tokenizer libraries or fitted mixtures; tests compare those with the libraries and plain versions.
ORACLES: dict[str, str] = {"op1_near_embeddings": OP1_SQL, "op2_url_filter": urlfilter.oracle(), "op4_secrets": secrets.oracle(), "op5_top_k": OP5_SQL, "op7_minhash": OP7_SQL, "op8_suffix_dedup": OP8_SQL}
