"""Text expressions: cleaning, tokens, sentences, paragraphs, articles.

Every function takes and returns a ``Column`` built from Spark SQL
built-ins, so it stays inside whole-stage code generation and can be
repeated in plain SQL for the oracle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (the contract of SURVEY §2.4 / §2.4.1).
TOKEN_PATTERN = r"[^\s]+"                      # a token = a run of non-space
TERM_PATTERN = r"[\p{L}\p{N}]+"                # a term = letters/digits, any script
SENTENCE_PATTERN = r"[^.!?]*[.!?]+|[^.!?]+$"   # sentence = text up to a stop run
PARAGRAPH_PATTERN = r"\n+"
ARTICLE_PATTERN = r"(?s)<article>(.*?)</article>"
HEADING_SPLIT = r"(?i)(?=<h[1-6])"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(col, newline: str = "drop") -> Column:
    """Delete line breaks (or turn them into spaces), then `` ?\\.`` -> ``.``."""
    rep = "" if newline == "drop" else " "
    return F.regexp_replace(F.regexp_replace(_c(col), "\n", rep), r" ?\.", ".")


def tokens(col) -> Column:
    """Whitespace tokens, in order (array<string>)."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), 0)


def token_count(col) -> Column:
    """Number of whitespace tokens; 0 for blank text, null for null."""
    return F.size(tokens(col))


def terms(col) -> Column:
    """Lower-cased letter/digit runs: the unit of hashing and overlap."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TERM_PATTERN), 0)


def sentences(col) -> Column:
    """Sentence units; concatenated they give back the input."""
    return F.regexp_extract_all(_c(col), F.lit(SENTENCE_PATTERN), 0)


def paragraphs(col) -> Column:
    """Non-blank paragraphs split at line-break runs."""
    return F.filter(F.split(_c(col), PARAGRAPH_PATTERN), lambda p: F.trim(p) != "")


def truncate_tokens(col, n: int) -> Column:
    """The first ``n`` tokens joined by one space."""
    return F.array_join(F.slice(tokens(col), 1, n), " ")


def article(col) -> Column:
    """Inner HTML of the first ``<article>`` element, trimmed; null if absent or blank."""
    inner = F.regexp_extract(_c(col), ARTICLE_PATTERN, 1)
    return F.when(_c(col).isNull(), F.lit(None)).otherwise(F.nullif(F.trim(inner), F.lit("")))


def heading_sections(col) -> Column:
    """HTML cut in front of every ``<h1>``..``<h6>`` (look-ahead keeps the tag)."""
    return F.filter(F.split(_c(col), HEADING_SPLIT), lambda s: F.trim(s) != "")


def strip_tags(col) -> Column:
    """Drop tags and collapse white space (for turning HTML into plain text)."""
    no_code = F.regexp_replace(F.regexp_replace(_c(col), r"(?is)<script\b.*?</script>", " "),
                               r"(?is)<style\b.*?</style>", " ")
    no_tags = F.regexp_replace(no_code, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(no_tags, r"\s+", " "))


def token_count_with(col, tokenizer) -> Column:
    """TXT-5 with an injected tokenizer ``f(list[str]) -> list[int]`` (token
    counts), run once per Arrow batch; null text gives null."""
    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        vals = texts.to_pylist()
        idx = [i for i, v in enumerate(vals) if v is not None]
        got = tokenizer([vals[i] for i in idx]) if idx else []
        out = [None] * len(vals)
        for i, n in zip(idx, got):
            out[i] = int(n)
        return pa.array(out, type=pa.int32())

    return count(_c(col))
