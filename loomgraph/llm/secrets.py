"""Secret scanning with an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its content (sha256). The ledger holds one row per (blob, rule version) that was scanned, with
its findings, an empty array for a clean blob. A run scans each unseen pair once, whatever number of paths or versions have the blob, and joins the findings back to all of them.
secrets() and redact() keep their ledger as a table: at a given path it is read first and the scanned pairs are appended, so that the next run over the same or
a grown table scans only what is new. (update() alone gives the pairs with findings, and all of them with clean=True.)

Every rule's pattern is matched in time linear in the text: no pattern can start again within a run of characters that it has just failed to match.
Null texts count as empty. Repeated rows give repeated results, tables without rows none. Spans are in code points, end exclusive.
Columns other than those named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.llm.common import materialize


@dataclass(frozen=True)
class Rule:
    """kind; a pattern; the group whose length counts and the least such length; whether it belongs to the base; text without which nothing matches; whether group 1 is a border before the span."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True
    needs: str = ""
    border: bool = False


#: Base rules, in the order that breaks ties, then the method's own.
RULES = (
    Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", needs="AKIA"),  # a run of these characters is taken whole, so the length can stand in the pattern
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", base=False, needs="PRIVATE KEY-----"),
    # only where a run of these characters begins: else a run that holds its first letters many times would be read as many times
    Rule("jwt", r"(^|[^A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", base=False, needs="eyJ", border=True),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{30,}", base=False, needs="gh"),
    Rule("bearer", r"Bearer [A-Za-z0-9+/_.=-]{20,}", base=False, needs="Bearer "),
)
MASK = "[SECRET]"


#: To be raised where scan() gives something else for the same rules.
SCANNER = 2


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr((SCANNER, rules)).encode()).hexdigest()[:16]


def address(text: Column) -> Column:
    """The content address of a text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, clean: bool = False) -> DataFrame:
    """Findings (blob, spans) of blobs(blob, text) that have any; with clean also of the others, whose spans are empty. spans: array of (start, end, rank of kind, kind), in order.

    A rule's matches and the gaps between them come from the regular expression engine; positions are running sums of their lengths.
    """
    text = F.col("text")

    def of(k: int, rule: Rule) -> Column:
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        sized = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
        length = lambda a: F.transform(a, lambda s: F.length(s))
        border = length(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(1))) if rule.border else F.transform(found, lambda _: F.lit(0))
        cut = F.arrays_zip(length(F.split(text, rule.pattern, -1)).alias("gap"), length(found).alias("size"), length(sized).alias("counts"), border.alias("border"))
        rows = F.transform(F.slice(cut, 1, F.size(found)), lambda x, i: F.struct(F.lit(k).alias("rank"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["counts"].alias("counts"), x["border"].alias("border")))
        none = F.array().cast("array<struct<rank: int, i: int, gap: int, size: int, counts: int, border: int>>")  # so that a text that can't match is searched once at most
        may = F.contains(text, F.lit(rule.needs)) if rule.needs else text.rlike(rule.pattern)
        return F.when(may, F.when(F.size(found) > 0, rows).otherwise(none)).otherwise(none)

    each = F.flatten(F.array(*[of(k, r) for k, r in enumerate(rules)]))
    rows = blobs.select("blob", each.alias("m"))
    rows = rows.select("blob", F.inline_outer("m")) if clean else rows.where(F.size("m") > 0).select("blob", F.inline("m"))
    so_far = Window.partitionBy("blob", "rank").orderBy("i")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("gap").over(so_far) + F.coalesce(F.sum("size").over(before), F.lit(0))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("rank") + 1)
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("rank") + 1)
    rows = rows.withColumn("start", start)
    long_enough = F.col("counts") >= least
    if not clean:
        rows = rows.where(long_enough)
    span = F.struct((F.col("start") + F.col("border")).alias("start"), (F.col("start") + F.col("size")).alias("end"), F.col("rank"), kind.alias("kind"))
    if clean:
        span = F.when(long_enough, span)  # nulls aren't collected
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(span)).alias("spans"))  # the spans of one text


def update(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, clean: bool = False, only_new: bool = False) -> DataFrame:
    """The ledger (blob, rule_version, spans) after scanning what versions(text) holds and ledger doesn't have for this rule version; only_new: the new pairs alone.

    With clean, every scanned pair gets a row, one without findings an empty array. Without it those are scanned again by a later run.
    """
    version = rule_version(rules)
    marked = scan(unseen(versions, ledger, rules), rules, clean).select("blob", F.lit(version).alias("rule_version"), "spans")
    return marked if ledger is None or only_new else ledger.unionByName(marked)


def unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The blobs (blob, text) of versions(text) that ledger doesn't have for this rule version, each once."""
    blobs = versions.select(address(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text"))
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == rule_version(rules)).select("blob"), "blob", "left_anti")
    return blobs.groupBy("blob").agg(F.first("text").alias("text"))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """paths(doc_id, text) by doc_id with the spans that the ledger has for its blob, under this rule version; none: an empty array."""
    found = ledger.where(F.col("rule_version") == rule_version(rules)).select("blob", "spans")
    at = paths.select("doc_id", address(F.col("text")).alias("blob"))
    none = F.array().cast(found.schema["spans"].dataType)
    return at.join(found, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_<kind> of base kinds, base_sha256, spans as text) of findings()."""
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = [r.kind for r in rules if r.base]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in base]
    kept = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(text(kept), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def ledger_of(docs: DataFrame, at: str | None = None, rules: tuple[Rule, ...] = RULES, known: DataFrame | None = None) -> DataFrame:
    """The ledger, as a table, after scanning what docs(text) holds and neither known nor the table at the path has. The new pairs are appended there.

    Runs that append at the same time may scan a pair twice; readers take it once. A run that fails leaves no part of its pairs.
    """
    spark = docs.sparkSession
    stored = read_ledger(spark, at) if at else None
    if known is not None and stored is not None:
        stored = stored.unionByName(known)
    before = known if stored is None else stored
    if at is None:  # a table: then a content that very many paths have can be split where its findings are joined back
        return materialize(update(docs, before, rules, clean=True), "ledger")
    fresh = update(docs, before, rules, clean=True, only_new=True)
    fresh.write.parquet(f"{at.rstrip('/')}/run-{uuid.uuid4().hex}")
    every = read_ledger(spark, at)
    return every if known is None else every.unionByName(known)


def read_ledger(spark: SparkSession, at: str) -> DataFrame | None:
    """The rows that finished runs have left at a path, pairs that two runs scanned at the same time once; None if there are none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    done = [s.getPath().getParent().toString() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "run-*/_SUCCESS"))]
    if not done:
        return None
    rows = spark.read.schema(LEDGER).parquet(*sorted(done))
    return rows if len(done) == 1 else rows.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))


LEDGER = "blob binary, rule_version string, spans array<struct<start: bigint, end: bigint, rank: int, kind: string>>"


def secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, at: str | None = None) -> DataFrame:
    """digest() of docs(doc_id, text). ledger: what is known; at: where a ledger is kept between runs."""
    return digest(findings(docs, ledger_of(docs, at, rules, ledger), rules), rules)


def redact(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, at: str | None = None) -> DataFrame:
    """docs with MASK for every span of text, and n_chars after that; all other rows and columns as they were."""
    names = docs.columns
    ledger = ledger_of(docs, at, rules, ledger)
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), address(F.col("text")).alias("_blob"))
    joined = rows.join(covers(ledger, rules), "_blob", "left")
    # the characters as an array, made once: parts of a string or of bytes would be sought from its start each time
    joined = joined.select("*", F.when(F.size("_covers") > 0, F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0))).alias("_chars"))
    chars, none = F.col("_chars"), F.lit(0).cast("long")
    part = lambda a, n: F.array_join(F.slice(chars, (a + 1).cast("int"), n.cast("int")), "")
    s = F.col("_covers")
    before = lambda i: F.when(i > 0, F.get(s, i - 1)["end"]).otherwise(none)
    # a cover that starts where the one before ends has nothing before it
    pieces = F.transform(s, lambda x, i: F.concat(part(before(i), x["start"] - before(i)), F.lit(MASK)))
    tail = F.element_at(s, -1)["end"]
    new = F.when(F.size(s) > 0, F.concat(F.array_join(pieces, ""), part(tail, F.size(chars) - tail))).otherwise(F.col("text"))
    out = joined.withColumn("text", new)
    get = {c: F.col(f"_row.`{c}`") for c in names} | {"text": F.col("text")}
    if "n_chars" in names:
        get["n_chars"] = F.when(F.size(s) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(get["n_chars"])
    return out.select(*[get[c].alias(c) for c in names])


def covers(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(_blob, _covers) of blobs with findings: their spans in order, those that overlap as one. One pass over each blob's spans."""
    found = ledger.where((F.col("rule_version") == rule_version(rules)) & (F.size("spans") > 0)).select(F.col("blob").alias("_blob"), F.inline("spans"))
    in_order = Window.partitionBy("_blob").orderBy("start", "rank")
    far = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("_new", F.when(far > F.col("start"), 0).otherwise(1))
    found = found.withColumn("_cover", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = found.groupBy("_blob", "_cover").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy("_blob").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_covers"))


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The digest in DuckDB's SQL."""
    each = []
    for k, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        each.append(f"""SELECT doc_id, {k} AS rank, '{r.kind}' AS kind, {r.base} AS base, i, {r.least} AS least, length(gaps[i]) AS gap, length(found[i]) AS size, length(sized[i]) AS counts, {'length(borders[i])' if r.border else '0'} AS border
        FROM (SELECT doc_id, unnest(range(1, len(found) + 1)) AS i, found, sized, gaps, borders FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS found,
          regexp_extract_all(text, '{p}', {r.group}) AS sized, regexp_extract_all(text, '{p}', {1 if r.border else 0}) AS borders, string_split_regex(text, '{p}') AS gaps FROM texts))""")
    base = [r.kind for r in rules if r.base]
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({' UNION ALL '.join(each)}),
    placed AS (SELECT *, sum(gap) OVER w + sum(size) OVER w - size AS s FROM found WINDOW w AS (PARTITION BY doc_id, rank ORDER BY i)),
    spans AS (SELECT doc_id, rank, kind, base, (s + border)::BIGINT AS s, kind || ':' || (s + border)::BIGINT || ':' || (s + size)::BIGINT AS t FROM placed WHERE counts >= least),
    told AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)},
      string_agg(t, ',' ORDER BY s, rank) FILTER (base) AS b, string_agg(t, ',' ORDER BY s, rank) AS a FROM spans GROUP BY doc_id)
    SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0)::BIGINT AS n_{k}' for k in base)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
    FROM documents d LEFT JOIN told USING (doc_id)
    """
