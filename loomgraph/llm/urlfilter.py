"""URL filters: host and path rules first, then logistic regression on hashed character n-grams of host and path.

The regression is fitted on the driver to a small labelled table of URLs (at most MOST_LABELS rows; by default those of url_labels.tsv beside this file,
of which a quarter, chosen by crc32, is held out to measure accuracy), and its weights and its bias are
rounded to integers, so that a score is an exact integer sum in any order. Scoring is one DataFrame expression:
n-grams by array functions, buckets by md5, weights from a constant array of BUCKETS integers. No shuffle, no Python on the executors.

A null url, or one without `://`, has an empty host and path and no rule; its verdict is the model's for empty strings.
Rules are looked up by the host and each domain above it, in one map: any number of them is one expression. Of rules equally long the smaller text wins.
Rows are judged one by one, so repeated rows give repeated results. Columns other than page_id and url are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from functools import cache
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
GRAM = 3
SCALE = 1_000_000
MOST_LABELS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (action, host, path); a rule's text is host + path.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

LABELS = Path(__file__).with_name("url_labels.tsv")


@cache
def labelled(held_out: bool, path: str = str(LABELS)) -> tuple[tuple[str, int], ...]:
    """(url, 1 to block) of a file of lines `label TAB url`: the quarter that is held out, or the others."""
    rows = [line.split("\t") for line in Path(path).read_text(encoding="utf-8").splitlines() if line]
    return tuple((url, int(y)) for y, url in rows if (zlib.crc32(url.encode()) % 4 == 0) == held_out)


def default_labels() -> tuple[tuple[str, int], ...]:
    """The labelled table that the regression is fitted to."""
    return labelled(held_out=False)


def parts_of(url: str | None) -> tuple[str, str]:
    """Host and path of one URL, on the driver."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(str.maketrans(UPPER, LOWER)), re.match(r"[^?#]*", rest[len(host) :])[0]


def grams_of(host: str, path: str) -> list[int]:
    """Buckets of the n-grams of one host and path, on the driver."""
    found = [k + s[i : i + GRAM] for k, s in (("h", f"^{host}$"), ("p", f"^{path}$")) for i in range(len(s) - GRAM + 1)]
    return [int(hashlib.md5(g.encode()).hexdigest()[:3], 16) for g in found]


@cache
def fit(labels: tuple[tuple[str, int], ...], rounds: int = 400, rate: float = 60.0, decay: float = 1e-5) -> tuple[tuple[int, ...], int]:
    """Weights and bias, times SCALE, by full-batch gradient descent on the share of each bucket among a URL's n-grams."""
    if len(labels) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labelled URLs")
    rows = [np.unique(grams_of(*parts_of(url)), return_counts=True) for url, _ in labels]
    row = np.repeat(np.arange(len(rows)), [len(k) for k, _ in rows])
    bucket = np.concatenate([k for k, _ in rows] or [np.zeros(0)]).astype(np.int64)
    share = np.concatenate([n / n.sum() for _, n in rows if len(n)] or [np.zeros(0)])
    y = np.array([y for _, y in labels], dtype=np.float64)
    w, bias, seen, n = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS, dtype=bool), max(len(rows), 1)
    seen[bucket] = True
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-bias - np.bincount(row, w[bucket] * share, len(rows)))) - y
        w -= rate * (np.bincount(bucket, e[row] * share, BUCKETS) / n + decay * w) * seen
        bias -= float(e.sum()) / n
    return tuple(round(float(x) * SCALE) for x in w), round(bias * SCALE)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def letters(s: Column) -> Column:
    """A text's characters between marks of its ends."""
    return F.regexp_extract_all(F.concat(F.lit("^"), s, F.lit("$")), F.lit(r"(?s)(.)"), 1)


def grams(kind: str, chars: Column) -> Column:
    """Buckets of the n-grams of a column of letters(); linear in its length, if that is a column of a projection of its own."""
    each = lambda i: F.conv(F.substring(F.md5(F.concat(F.lit(kind), *[F.get(chars, i + d) for d in range(GRAM)])), 1, 3), 16, 10).cast("int")
    return F.when(F.size(chars) >= GRAM, F.transform(F.sequence(F.lit(0), F.size(chars) - GRAM), each)).otherwise(F.array().cast("array<int>"))


def judge(pages: DataFrame, labels: tuple[tuple[str, int], ...] | None = None, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, margin) of pages(page_id, url). margin: the model's score times the number of n-grams; above 0 is to block."""
    weights, bias = fit(tuple(labels) if labels is not None else default_labels())
    host, path = host_and_path(F.col("url"))
    p = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    p = p.select("*", letters(F.col("host")).alias("_h"), letters(F.col("path")).alias("_p"), F.array_min(_fitting(rules)).alias("_rule"))
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    margin = F.aggregate(F.concat(grams("h", F.col("_h")), grams("p", F.col("_p"))), F.lit(0).cast("long"), lambda s, g: s + F.get(table, g) + F.lit(bias).cast("long"))
    out = p.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.action").alias("_by_rule"), margin.alias("margin"))
    verdict = F.coalesce("_by_rule", F.when(F.col("margin") > 0, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "margin")


def _fitting(rules) -> Column:
    """The rules that fit host and path, as (less their length, rule, action): the least one wins."""
    by_host: dict[str, list[dict]] = {}
    for action, h, x in rules:
        by_host.setdefault(h, []).append({"size": -len(h + x), "rule": h + x, "action": action, "path": x})
    known = F.from_json(F.lit(json.dumps(by_host)), "map<string, array<struct<size: int, rule: string, action: string, path: string>>>")
    parts = F.split("host", r"\.")
    domains = F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))
    found = F.flatten(F.filter(F.transform(domains, lambda d: F.try_element_at(known, d)), lambda r: r.isNotNull()))
    return F.filter(found, lambda r: F.col("path").startswith(r["path"]))


def oracle() -> str:
    """The same in DuckDB's SQL, for the default rules and labels."""
    weights, bias = fit(default_labels())
    longest = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    when = lambda value: "CASE " + " ".join(f"WHEN (host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}') THEN '{value(r)}'" for r in longest) + " END"
    gram = lambda k, c: f"list_transform(range(1, length({c}) + 3 - {GRAM - 1}), lambda i: ('0x' || substr(md5('{k}' || substr('^' || {c} || '$', i, {GRAM})), 1, 3))::INT)"
    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM cut),
    parts AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM hosts),
    grams AS (SELECT *, list_concat({gram('h', 'host')}, {gram('p', 'path')}) AS g FROM parts),
    weights AS (SELECT [{','.join(map(str, weights))}]::BIGINT[] AS w),
    scored AS (SELECT page_id, host, path, {when(lambda r: r[1] + r[2])} AS rule, {when(lambda r: r[0])} AS by_rule,
        coalesce(list_sum(list_transform(g, lambda b: w[b + 1] + {bias})), 0)::BIGINT AS margin FROM grams, weights)
    SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN margin > 0 THEN 'block' ELSE 'allow' END) AS verdict, margin FROM scored
    """
