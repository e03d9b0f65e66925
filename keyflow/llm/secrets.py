"""Secret scan with an incremental blob ledger.

Texts are content-addressed: a blob is the SHA-256 of a text, however many paths and versions hold it. Only pairs of
blob and rule version that the ledger has not seen are scanned, each blob once, and findings are joined back to all
paths. Copies meet in map-side aggregation, so a blob with any number of copies costs one row for each task.

A finding is (start, kind number, end) in code points, end exclusive. Null texts are empty. Each row of the input
gets a row, repeated ones too; other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import Scratch, table

_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"

#: Kind: pattern, and the pattern that a match has to have as well. Base kinds come first; their order is fixed.
KINDS = {
    "assign": (_KEYWORD + "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "[A-Za-z0-9+/_.=-]{6,}$"),
    "access": ("AKIA[A-Z0-9]+", ".{20,}"),
    "hex": ("[0-9a-f]+", ".{24,}"),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", ""),
    "jwt": ("eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", ""),
    "forge": ("gh[pousr]_[A-Za-z0-9]{30,}", ""),
}
BASE = ("assign", "access", "hex")
#: What a text with a finding of that kind has anywhere; other texts need no further look.
LIKELY = {"assign": _KEYWORD + "[\"']?\\x20*[:=]", "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}
#: Changes with any pattern, so that what was scanned by other rules counts as unseen.
RULE_VERSION = zlib.crc32(repr((KINDS, LIKELY)).encode())
SPAN = "array<struct<start: int, kind: int, end: int>>"


def _value_fits(kind: str, match: str) -> str:
    """SQL that tells whether a match is kept."""
    if kind == "assign":  # the value alone is measured; it starts behind the first : or = and what may follow that
        return f"length(regexp_extract({match}, r'{_raw(KINDS[kind][0])}', 2)) >= 6"
    least = {"access": 20, "hex": 24}.get(kind, 0)
    return f"length({match}) >= {least}"


def _raw(pattern: str) -> str:
    return pattern.replace("'", "\\x27")


def spans(text: str, kind: str) -> Column:
    """Leftmost non-overlapping matches of a kind in a column as (start, kind number, end).

    The text is cut into (gap, match) pairs by one pattern anchored where the last match ended; lengths add up to places.
    """
    pattern, number = _raw(KINDS[kind][0]), list(KINDS).index(kind)
    cut = f"(?s)\\G(.*?)({pattern})"
    pieces = f"zip_with(regexp_extract_all({text}, r'{cut}', 1), regexp_extract_all({text}, r'{cut}', 2), (g, m) -> named_struct('g', g, 'm', m))"
    walk = (
        f"aggregate({pieces}, named_struct('at', 0, 'out', cast(array() as {SPAN})), (a, x) -> named_struct('at', a.at + length(x.g) + length(x.m), 'out', "
        f"if({_value_fits(kind, 'x.m')}, array_append(a.out, named_struct('start', a.at + length(x.g), 'kind', {number}, 'end', a.at + length(x.g) + length(x.m))), a.out)), a -> a.out)"
    )
    likely = _raw(LIKELY.get(kind, KINDS[kind][0]))
    return F.expr(f"if({text} rlike r'{likely}', {walk}, cast(array() as {SPAN}))")


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """blobs: blob, text. Rows (blob, rule_version, findings), findings sorted by start, then kind."""
    found = blobs
    for kind in KINDS:
        found = found.withColumn(f"__{kind}", spans("text", kind))
    return found.select("blob", F.lit(RULE_VERSION).alias("rule_version"), F.array_sort(F.concat(*[F.col(f"__{k}") for k in KINDS])).alias("findings"))


def address(paths: DataFrame) -> DataFrame:
    """paths (path, text) as path, blob, text."""
    text = F.coalesce("text", F.lit(""))
    return paths.select("path", F.sha2(text, 256).alias("blob"), text.alias("text"))


def scan_unseen(paths: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """What the ledger (blob, rule_version, findings) lacks: each unseen blob of ``paths``, scanned once."""
    rows = address(paths).select("blob", "text")
    if seen is not None:
        rows = rows.join(seen.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct(), "blob", "left_anti")
    return scan_blobs(rows.groupBy("blob").agg(F.first("text").alias("text")))


def findings_by_path(paths: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every row of paths with its blob's findings; only blobs that have some take part in the join."""
    some = ledger.where((F.col("rule_version") == RULE_VERSION) & (F.size("findings") > 0)).select("blob", "findings")
    rows = address(paths).select("path", "blob")
    return rows.join(some, "blob", "left").select("path", "blob", F.coalesce("findings", F.expr(f"cast(array() as {SPAN})")).alias("findings"))


def extended(ledger: DataFrame | None, paths: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The ledger with what a scan of these paths adds to it; only that is scanned and stored, as a table ``name``."""
    new = scratch.write(scan_unseen(paths, ledger), name)
    return new if ledger is None else ledger.unionByName(new)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments: a first state of the corpus, of the rows with even ids, then the state with all rows."""
    paths, scratch = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text"), Scratch(spark, "secret-ledger")
    ledger = extended(None, paths.where(F.pmod("path", F.lit(2)) == 0), scratch, "first")
    rows = findings_by_path(paths, extended(ledger, paths, scratch, "second"))
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    said = f"x -> concat(get({names}, x.kind), ':', x.start, ':', x.end)"
    count = {k: F.expr(f"size(filter(findings, x -> x.kind = {list(KINDS).index(k)}))").cast("long").alias(f"n_{k}") for k in BASE}
    return rows.select(
        F.col("path").alias("doc_id"),
        *count.values(),
        F.sha2(F.expr(f"array_join(transform(filter(findings, x -> x.kind < {len(BASE)}), {said}), ',')"), 256).alias("base_sha256"),
        F.expr(f"array_join(transform(findings, {said}), ',')").alias("spans"),
        "blob",
    )


def _oracle() -> str:
    parts = []
    for n, (kind, (pattern, _)) in enumerate(KINDS.items()):
        pattern = pattern.replace("'", "\\x27")
        cut = f"(?s)(.*?)({pattern}|\\z)"
        fits = f"length(regexp_extract(m, '{pattern}', 2)) >= 6" if kind == "assign" else f"length(m) >= {dict(access=20, hex=24).get(kind, 1)}"
        parts.append(
            f"select doc_id, {n} as kind, '{kind}' as name, start, start + length(m) as stop from (select doc_id, i, m, (sum(length(g) + length(m)) over (partition by doc_id order by i) - length(m))::bigint as start from "
            f"(select doc_id, unnest(range(len(ms))) as i, unnest(gs) as g, unnest(ms) as m from (select doc_id, regexp_extract_all(text, '{cut}', 1) as gs, regexp_extract_all(text, '{cut}', 2) as ms from d))) where m <> '' and {fits}"
        )
    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
f as ({' union all '.join(parts)}),
a as (select doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access, count(*) filter (where kind = 2) as n_hex,
  string_agg(name || ':' || start || ':' || stop, ',' order by start, kind) filter (where kind < 3) as base, string_agg(name || ':' || start || ':' || stop, ',' order by start, kind) as spans from f group by doc_id)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, sha256(text) as blob from d left join a using (doc_id)"""


QUERIES = {"op7_secret_scan": op7_secret_scan}
ORACLES = {"op7_secret_scan": _oracle()}
