"""Operator 11: fill-in-the-middle transformation by counted-quantifier patterns.

A text is a run of units (white space and the word after it; or white space
at the end).  ``regexp_count`` gives their number n; two cut points drawn from
the document's id make the pattern of that row,

    \\A (unit{a}+) (unit{b-a}+) (rest) \\z

whose groups are prefix, middle and suffix, so one match both cuts the text
and writes it in its new order (``regexp_replace`` with the groups in the
replacement).  All counted groups are possessive: a unit is matched once and
never given back, so matching is linear and needs no stack for long texts.
Everything is a column expression of the scan; nothing is shuffled.

Cases: null text is the empty text; a null id is drawn for as an empty one;
texts of any length are cut whole; a text that is empty or holds one of the
marks stays plain; rows of one id are cut alike (ties, repeated rows); an
empty table gives no rows; other columns stay, and those with the names of
the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import documents

SPACE = r"\x20\x09-\x0D"
UNIT = rf"(?:[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: order of the parts after the marks, by form
ORDER = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
#: and how they are found again: pattern and order of the text
BACK = {"psm": (rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2"),
        "spm": (rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")}
RESULTS = ("n", "form", "output", "prefix_chars", "middle_chars")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 42,
              fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """Adds ``n`` (units), ``form`` (plain, psm or spm), ``output``, and the
    code points of prefix and middle (null if plain)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(doc_id), seed)
    plain = (body == "") | body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE) | (h3 % 100 >= fim_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    counted = docs.select(*(c for c in docs.columns if c not in RESULTS), body.alias("output"),
                          F.regexp_count(body, F.lit(UNIT)).cast("long").alias("n"), form.alias("form"))
    a, b = F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))
    pattern = F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a.cast("string"), F.lit(rf"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(r"}+)(.*)\z"))
    order = F.when(F.col("form") == "spm", ORDER["spm"]).otherwise(ORDER["psm"])
    cut = counted.withColumn("output", F.when(F.col("form") == "plain", F.col("output"))
                             .otherwise(F.regexp_replace("output", pattern, order)))
    # The marks occur once each: no text with a mark is cut, and a mark shares no end with another.
    at = {m: F.instr("output", m).cast("long") for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - 4).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - 3)
    middle = F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - 2)
    return cut.withColumns({"prefix_chars": prefix, "middle_chars": middle.cast("long")})


def restore(output: Column, form: Column) -> Column:
    """The text that was transformed, from the output and its form."""
    return F.when(form == "psm", F.regexp_replace(output, *BACK["psm"])) \
            .when(form == "spm", F.regexp_replace(output, *BACK["spm"])).otherwise(output)


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha256(F.col("output")).alias("output_sha256"),
        sha256(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def oracle() -> str:
    """The same rows in DuckDB, from lists of units."""
    h = [f"('0x' || substr(d, {8 * k + 1}, 8))::BIGINT" for k in range(4)]
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
u AS (SELECT doc_id, body, regexp_extract_all(body, '[{SPACE}]*[^{SPACE}]+|[{SPACE}]+') AS units,
        {h[0]} AS h1, {h[1]} AS h2, {h[2]} AS h3, {h[3]} AS h4 FROM t),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
        CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM p"""
