"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document; the ledger keeps its measurements and one bit for each failed rule.
A policy is a named, versioned set of rules, so applying or changing one is integer arithmetic on the ledger and
never reads a text again. Ablations are bitwise aggregates over it.

Null texts have no words. A text without words fails ``few_words`` only. Repeated rows are judged one by one; other
columns pass through the ledger where asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm.common import table

WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

#: Bit of a rule: its place here, for good; new rules are added at the end. The expression is true where a row fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
    "symbols": "10 * n_symbols > 2 * n_words and n_symbols > 5",
    "repeated_lines": "n_lines > 1 and 100 * n_dup_lines > 30 * n_lines",
    "many_words": "n_words > 1000000",
}
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE_POLICY = Policy("base", 1, BASE)
DEFAULT_POLICY = Policy("default", 1, (*BASE, "word_length", "symbols", "repeated_lines"))


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """docs (doc_id, text, and ``keep``) with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    w = WINDOW
    words = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("__text")).withColumn("__words", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)))
    lines = words.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09\x0A\x0B\x0C\x0D]")))
    # equal windows have equal hashes: only texts whose hashes repeat have their windows compared as strings
    hashed = lines.withColumn("__hashes", F.expr(f"if(size(__words) < {w}, array(), transform(sequence(1, size(__words) - {w - 1}), i -> xxhash64(slice(__words, i, {w}))))"))
    keyed = hashed.withColumn(
        "__keyed",
        F.when(
            F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
            F.expr(f"array_sort(transform(sequence(1, size(__words) - {w - 1}), i -> named_struct('k', array_join(slice(__words, i, {w}), ' '), 'i', i)))"),
        ),
    )
    starts = keyed.withColumn(
        "__starts",
        F.expr("array_sort(transform(filter(__keyed, (x, j) -> x.k = get(__keyed, j - 1).k or x.k = get(__keyed, j + 1).k), x -> x.i))"),
    )
    covered = F.expr(f"aggregate(__starts, named_struct('n', 0L, 'to', 0), (a, i) -> named_struct('n', a.n + least({w}, i + {w} - a.to), 'to', i + {w}), a -> a.n)")
    return starts.select(
        "doc_id",
        *keep,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """The measurements and ``fail_bits``, the sum of 1 << bit over the failed rules."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(docs, *keep).withColumn("fail_bits", total)


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def kept(docs: DataFrame, policy: Policy, *keep: str) -> DataFrame:
    """Rows of the ledger that pass the policy.

    The row number keeps Spark from pushing the filter below the measurements, where each rule would compute its own.
    """
    rows = ledger(docs, *keep).withColumn("__row", F.monotonically_increasing_id())
    return rows.where(passes(policy) & (F.col("__row") >= 0)).drop("__row")


def apply_policies(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """The ledger with a boolean ``<name>_v<version>`` for each policy."""
    return rows.withColumns({f"{p.name}_v{p.version}": passes(p) for p in policies})


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """A row for each rule of the policy: how many rows fail it, fail it alone, and would be kept without it.

    One pass: rows are first counted by their bits, of which there are at most 2 ** rules.
    """
    by_bits = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(RULES).index(r)).cast("long").alias("bit")) for r in policy.rules])).alias("r")
    return (
        by_bits.select("bits", "n", rules)
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_fail_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes(BASE_POLICY)).alias("base_failed"), passes(DEFAULT_POLICY).alias("kept"), "fail_bits"
    )


def _oracle() -> str:
    bits = " + ".join(f"(case when {rule} then {1 << i} else 0 end)" for i, rule in enumerate(RULES.values()))
    return f"""
with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
win as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as k from d, unnest(range(1, len(words) - 6)) as t(i)),
dup as (select doc_id, i, count(*) over (partition by doc_id, k) as n from win),
cov as (select doc_id, count(distinct i + j) as n from dup, range(8) as t(j) where n > 1 group by doc_id),
lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d),
m as (select d.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
  (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::bigint as n_symbols, len(lines)::bigint as n_lines,
  (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from d join lines using (doc_id) left join cov using (doc_id)),
l as (select *, ({bits})::bigint as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {BASE_POLICY.mask}) <> 0 as base_failed,
  (fail_bits & {DEFAULT_POLICY.mask}) = 0 as kept, fail_bits from l"""


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES = {"op5_quality_rules": _oracle()}
