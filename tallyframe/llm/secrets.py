"""Secret scans over a ledger of blobs.

Every version of a path is addressed by the SHA-256 of its content. A ledger table keeps what has
been scanned, by blob and rule version, with the findings; only unseen pairs are scanned, each content
once, and findings are joined back to all paths that hold the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table, written
from tallyframe.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A pattern; its matches are left to right without overlap, and short ones are dropped.

    ``group`` is what has to have ``least`` characters. A changed rule gets another ``version``, and
    is then run again over all blobs.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1


# The base rules in their order, then formats that issuers of keys have published.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private", r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

PAIR = "kind string, version int"
SPAN = "start int, place int, kind string, end int"
LEDGER = f"blob string, scanned array<struct<{PAIR}>>, spans array<struct<{SPAN}, version int>>"


def spans_of(text: str, rules: list[tuple[int, Rule, re.Pattern]]) -> list[dict]:
    """Code point spans of the rules' matches in a text."""
    return [
        {"start": m.start(), "place": place, "kind": rule.kind, "end": m.end(), "version": rule.version}
        for place, rule, pattern in rules
        for m in pattern.finditer(text)
        if len(m[rule.group]) >= rule.least
    ]


def scan(versions: DataFrame, path: list[str], content: str, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings for every row of ``versions``: the columns of ``path``, ``blob``, and ``spans`` (start,
    place of the rule, kind, end; in code points, end exclusive; sorted by start, then rule).

    ``ledger`` is a Parquet table in shared storage; it is made when missing, and appended to. A second
    call scans only contents and rule versions that are new. Null content counts as empty. Repeated rows
    and equal contents share a blob; a content is scanned once, or once in each task where rows that repeat its path
    and content too lie in several. Null paths are kept. An empty table gives no rows.
    """
    spark = versions.sparkSession
    blob = F.sha2(F.coalesce(F.col("content"), F.lit("")).cast("binary"), 256)
    held = versions.select(F.struct(*[versions[c] for c in path]).alias("path"), versions[content].alias("content"))
    paths = written(held.select("path", blob.alias("blob")), "secret-paths")
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)

    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = _ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"))
    unseen = (
        # One path of each blob stands for it; equal contents meet as digests, not as texts.
        paths.groupBy("blob").agg(F.min("path").alias("path"))
        .join(seen, "blob", "left")
        .select("blob", "path", F.array_except(wanted, F.coalesce("scanned", F.array().cast(f"array<struct<{PAIR}>>"))).alias("todo"))
        .where(F.size("todo") > 0)
    )
    same = F.col("path").eqNullSafe(F.col("of_path")) & (blob == F.col("of_blob"))
    texts = held.join(unseen.select(F.col("path").alias("of_path"), F.col("blob").alias("of_blob"), "todo"), same, "inner")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {(r.kind, r.version): (k, r, re.compile(r.pattern, re.ASCII)) for k, r in enumerate(rules)}
        met = set()
        for batch in batches:
            # Rows that repeat path and content meet in one task, unless it is split for their number.
            names = batch.column("blob").to_pylist()
            new = [i for i, name in enumerate(names) if name not in met and not met.add(name)]
            blobs, todo, texts = (batch.column(c).take(pa.array(new, pa.int64())) for c in ("blob", "todo", "content"))
            spans, done = [], todo.to_pylist()
            for pairs, text in zip(done, texts, strict=True):
                chosen = [ready[p["kind"], p["version"]] for p in pairs]
                spans.append(spans_of(text.as_py() or "", chosen))
            yield pa.RecordBatch.from_arrays([blobs, todo, pa.array(spans, SPANS)], ["blob", "scanned", "spans"])

    found = texts.select(F.col("of_blob").alias("blob"), "todo", "content").mapInArrow(find, LEDGER)
    found.write.mode("append").parquet(ledger)
    spans = F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans"))))
    current = F.filter("spans", lambda s: F.array_contains(wanted, F.struct(s["kind"].alias("kind"), s["version"].alias("version"))))
    findings = (
        _ledger(spark, ledger).select("blob", current.alias("spans")).where(F.size("spans") > 0).groupBy("blob").agg(spans.alias("spans"))
    )
    return paths.join(findings, "blob", "left").select(
        "path.*", "blob", F.coalesce("spans", F.array().cast(f"array<struct<{SPAN}, version int>>")).alias("spans")
    )


SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("place", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("version", pa.int32())])
)


def _ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def joined(spans):
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"], "text", scratch_path(spark, "secret-ledger"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["place"] < len(BASE_RULES))
    return found.select(
        "doc_id", *[count(r.kind) for r in BASE_RULES],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def spans_sql(kinds: list[tuple[str, str, int, str]]) -> str:
    """SQL for ``docs(rid, t)``: ``found(rid, place, kind, s, e, m)`` of all kinds; each is (kind, pattern,
    group, condition on m, the group's text). Matches and the texts between them give the positions."""
    parts = [
        f"""SELECT rid, {place} AS place, '{kind}' AS kind, e - length(w) AS s, e, m FROM (
              SELECT rid, w, m, sum(length(g) + length(w)) OVER (PARTITION BY rid ORDER BY i) AS e FROM (
                SELECT rid, unnest(regexp_extract_all(t, '{p}')) AS w, unnest(regexp_extract_all(t, '{p}', {group})) AS m,
                       unnest(string_split_regex(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS g,
                       generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i FROM docs WHERE regexp_matches(t, '{p}')))
            WHERE {condition}"""
        for place, (kind, pattern, group, condition) in enumerate(kinds)
        for p in [pattern.replace("'", "''")]
    ]
    return " UNION ALL ".join(parts)


_KINDS = [
    ("assign", BASE_RULES[0].pattern, 2, "length(m) >= 8"),
    ("access", "AKIA[A-Z0-9]+", 0, "length(m) >= 16"),
    ("hex", "[0-9a-f]+", 0, "length(m) >= 32"),
] + [(r.kind, r.pattern, 0, "true") for r in MORE_RULES]

OP2_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({spans_sql(_KINDS)}),
marks AS (SELECT *, kind || ':' || s::BIGINT || ':' || e::BIGINT AS mark FROM found),
digest AS (
  SELECT rid, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
    count(*) FILTER (WHERE place = 2) AS n_hex, string_agg(mark, ',' ORDER BY s, place) FILTER (WHERE place < 3) AS base,
    string_agg(mark, ',' ORDER BY s, place) AS spans
  FROM marks GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN digest USING (rid)
"""
