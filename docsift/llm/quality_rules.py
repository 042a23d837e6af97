"""Operator 10: quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document; the ledger keeps the measurements
and one integer whose bit k says that rule k failed.  Policies are versioned
sets of rules: applying one is a bitwise AND, and what each rule does alone,
or what dropping it would let through, is an aggregation of the masks with
no text read again.

All measurements are functions of one row, so nothing is shuffled but the
ablation's few groups.  Repeated 8-word windows are found by sorting window
hashes (64 bits) with their places, in rows that have a repeat at all.

Cases: null text is the empty text (0 words, fails); a text shorter than 8
words has no window; equal rows get equal results; an empty table gives an
empty ledger; further columns are kept, those of the ledger begin with
``n_``, ``word_`` or ``rule_`` and replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import documents
from docsift.llm.native import let, whole, words

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")

#: name -> failure condition over the measurements; the position is the bit
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "shouting": "10 * n_upper > 5 * word_chars",
    "exclaims": "10 * n_marks > 4 * n_words",
    "dup_lines": "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines",
    "short_words": "10 * word_chars < 15 * n_words",
    "long_words": "word_chars > 40 * n_words",
}
#: policies by version: the rules that reject a document
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeats"),
    "v1": ("few_words", "repeats", "symbols", "shouting"),
    "v2": ("few_words", "repeats", "symbols", "shouting", "exclaims", "dup_lines", "short_words", "long_words"),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(version: str) -> int:
    return sum(bit(r) for r in POLICIES[version])


def repeat_words(ws: Column) -> Column:
    """Words inside 8-word windows that occur at least twice in the text."""
    def of_windows(win: Column) -> Column:
        placed = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            same = lambda x, k: F.get(s, k)["h"] == x["h"]
            return F.filter(s, lambda x, k: F.coalesce((k > 0) & same(x, F.greatest(k - 1, F.lit(0))), F.lit(False))
                            | F.coalesce(same(x, k + 1), F.lit(False)))

        def covered(at: Column) -> Column:
            step = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
            return F.aggregate(step, F.lit(0), lambda a, x: a + x)

        heavy = let(placed, lambda s: let(F.array_sort(F.transform(twins(s), lambda x: x["i"])), covered))
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(heavy)

    def of_hashes(h: Column) -> Column:
        win = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return let(win, of_windows)

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) < WINDOW, F.lit(0)).otherwise(let(hashes, of_hashes))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, the measurements and ``rule_bits``."""
    left = [c for c in docs.columns if c not in (*MEASURES, "rule_bits")]
    t = whole(text)
    kept_of = lambda cls: F.length(F.regexp_replace(t, cls, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    a = docs.withColumn("_ws", words(t)).withColumn("_lines", lines)
    a = a.select(
        *left,
        F.size("_ws").cast("long").alias("n_words"),
        F.length(F.array_join("_ws", "")).cast("long").alias("word_chars"),
        kept_of(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_ws")).cast("long").alias("n_repeat_words"),
        kept_of(r"[^A-Z]+").cast("long").alias("n_upper"),
        kept_of(r"[^!?]+").cast("long").alias("n_marks"))
    bits = sum((F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)) for k, cond in enumerate(RULES.values())), F.lit(0))
    return a.withColumn("rule_bits", bits.cast("int"))


def apply_policy(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` under a policy version."""
    fails = lambda v: F.col("rule_bits").bitwiseAND(F.lit(policy_mask(v))) != 0
    return led.withColumn("base_failed", fails("base")).withColumn("kept", ~fails("base") & ~fails(version))


def ablation(led: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and those that fail nothing
    else (they would come back without the rule).  Masks are counted first."""
    masks = (led.select(F.col("rule_bits").bitwiseAND(F.lit(policy_mask(version))).alias("m"))
             .groupBy("m").agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).alias("bit")) for r in POLICIES[version]])
    x = masks.withColumn("r", F.explode(rules))
    hit = F.col("m").bitwiseAND(F.col("r.bit")) != 0
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = apply_policy(ledger(documents(spark, sf_dir, "doc_id", "text")))
    return a.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "rule_bits")


def oracle() -> str:
    bits = " + ".join(f"(case when {c} then {1 << k} else 0 end)" for k, c in enumerate(RULES.values()))
    return rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
win as (select doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') as g
        from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w)),
dup as (select doc_id, g from win group by doc_id, g having count(*) > 1),
cov as (select doc_id, count(distinct p) as n_repeat_words from (
        select win.doc_id, unnest(range(i, i + 8)) as p from win join dup using (doc_id, g)) group by doc_id),
m as (select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(ls) as n_lines,
        len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
        length(regexp_replace(t, '[^A-Z]+', '', 'g')) as n_upper, length(regexp_replace(t, '[^!?]+', '', 'g')) as n_marks
        from w left join cov using (doc_id)),
b as (select *, cast({bits} as integer) as rule_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (rule_bits & {policy_mask("base")}) <> 0 as base_failed,
       (rule_bits & {policy_mask("base") | policy_mask(CURRENT)}) = 0 as kept, rule_bits from b"""
