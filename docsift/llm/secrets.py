"""Operator 3: secret scans by a trigram inverted index (DataFrame functions only).

From each rule's regular expression a Boolean trigram query is derived: the
sets of trigrams of which every match must contain at least one set whole.
The index holds, for the trigrams that some rule's query names, the
documents whose lower-cased text has them (postings); a query intersects the
postings per document and the surviving (document, rule) candidates are
verified with the expression itself.  A rule without a mandatory trigram
(any run of hex digits, say) is verified on every document.

Spans are in code points, end exclusive, leftmost and non-overlapping per
rule.  Native splits around the matches give the places: a match starts
where the pieces and matches before it end.

Cases: null text is the empty text (no spans); repeated rows and ids keep
their rows, as documents meet their candidates by a hash of id and text
(a clash of hashes only means that one more rule is verified); text of any
length is scanned whole; an empty table gives an empty result; further
columns are kept, ``secret_*`` columns are the operator's own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import documents, stage
from docsift.llm.native import let, whole


@dataclass(frozen=True)
class Rule:
    """``pattern`` is leftmost non-overlapping; a match counts if ``group`` has
    at least ``least`` characters, others are consumed and dropped."""
    kind: str
    pattern: str
    group: int
    least: int


#: The three base kinds, in their order.
BASE = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: what the scan adds to them
EXTRA = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 24),
    Rule("chat", r"xox[abprs]-[0-9A-Za-z-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30),
    Rule("cloud", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("pay", r"[rs]k_live_[0-9a-zA-Z]+", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
)
RULES = (*BASE, *EXTRA)

#: a set of exact strings larger than this is replaced by its trigrams (keeps queries small)
EXACT = 64


# ---------------------------------------------------------------- trigram queries

def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of trigrams (lower case) that must all occur;
    None if some match may hold no trigram for sure."""
    done, exact = _walk(_parser.parse(pattern))
    out = _join(done, _grams(exact)) if exact is not None else done
    out = [s for s in out if not any(o < s for o in out)]
    return None if any(not s for s in out) else list(dict.fromkeys(out))


def _grams(strings: Iterable[str]) -> list[frozenset[str]]:
    return list(dict.fromkeys(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _join(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    return list(dict.fromkeys(x | y for x, y in itertools.product(a, b)))


def _walk(nodes) -> tuple[list[frozenset[str]], list[str] | None]:
    """(trigram alternatives so far, the strings that end here exactly or None)."""
    done: list[frozenset[str]] = [frozenset()]
    run: list[str] | None = [""]

    def close():
        nonlocal done, run
        if run is not None:
            done = _join(done, _grams(run))
        run = None

    for op, arg in nodes:
        sub_done, sub = _node(op, arg)
        if sub is None or sub_done != [frozenset()]:
            close()
            done = _join(done, sub_done)
            run = sub
        elif run is not None and len(run) * len(sub) <= EXACT:
            run = list(dict.fromkeys(x + y for x in run for y in sub))
        else:
            close()
            run = sub
    return done, run


def _node(op, arg) -> tuple[list[frozenset[str]], list[str] | None]:
    free = [frozenset()]
    if op is K.LITERAL:
        return free, [chr(arg).lower()]
    if op is K.IN:
        if all(o is K.LITERAL for o, _ in arg):
            return free, list(dict.fromkeys(chr(c).lower() for _, c in arg))
        return free, None
    if op is K.SUBPATTERN:
        return _walk(arg[-1])
    if op is K.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(e is not None and d == free for d, e in parts):
            return free, list(dict.fromkeys(x for _, e in parts for x in e))
        return list(dict.fromkeys(s for d, e in parts for s in (_join(d, _grams(e)) if e is not None else d))), None
    if op in (K.MAX_REPEAT, K.MIN_REPEAT):
        low, high, body = arg
        d, e = _walk(body)
        if (low, high) == (0, 1) and e is not None and d == free:
            return free, ["", *e]
        if low == 0:
            return free, None
        return (_join(d, _grams(e)) if e is not None else d), None
    return free, None


# ---------------------------------------------------------------- index and candidates

def doc_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), whole())


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: (trigram, key) for the named trigrams, every document read whole."""
    low = docs.select(doc_key().alias("key"), F.lower(whole()).alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("key", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): indices of the rules whose query the postings of a document meet.

    Postings come together per key as bit sets (partial aggregation first);
    a conjunction is met if its bits are all there.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    names = sorted({t for q in queries if q for s in q for t in s})
    place = {t: (i // 62, i % 62) for i, t in enumerate(names)}
    n = max((p for p, _ in place.values()), default=0) + 1
    slot = F.create_map(*[F.lit(x) for t, (p, b) in place.items() for x in (t, p * 62 + b)])
    at = F.element_at(slot, F.col("trigram"))
    sets = [F.bit_or(F.when(F.floor(F.col("_at") / 62) == p, F.expr("shiftleft(1L, cast(_at % 62 as int))")).otherwise(F.lit(0).cast("long"))).alias(f"m{p}")
            for p in range(n)]
    have = index.withColumn("_at", at).groupBy("key").agg(*sets)

    def met(conj: frozenset[str]) -> Column:
        need = [0] * n
        for t in conj:
            need[place[t][0]] |= 1 << place[t][1]
        return F.expr(" and ".join(f"(m{p} & {m}L) = {m}L" for p, m in enumerate(need) if m))

    hits = []
    for k, q in enumerate(queries):
        if q:
            any_of = met(q[0])
            for c in q[1:]:
                any_of = any_of | met(c)
            hits.append(F.when(any_of, F.lit(k)))
    return have.select("key", F.array_compact(F.array(*hits)).alias("rules")).where(F.size("rules") > 0)


# ---------------------------------------------------------------- verification

def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, ord, kind, end>> of one rule's matches that count."""
    pattern = F.lit(rule.pattern)
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x))

    def spans(rows: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>").alias("out"))

        def step(acc, x):
            s = acc["at"] + x["gap"]
            e = s + x["hit"]
            item = F.array(F.struct(s.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), e.alias("end")))
            return F.struct(e.alias("at"), F.when(x["size"] >= rule.least, F.concat(acc["out"], item)).otherwise(acc["out"]).alias("out"))
        return F.aggregate(rows, start, step, lambda acc: acc["out"])

    rows = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), sizes.alias("size")), lambda x: x["hit"].isNotNull())
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    return F.when(F.regexp_like(text, pattern), let(rows, spans)).otherwise(none)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` and ``secret_spans``, sorted by start, then rule."""
    queries = [trigram_query(r.pattern) for r in rules]
    names = sorted({t for q in queries if q for s in q for t in s})
    d = docs.select(*[c for c in docs.columns if not c.startswith("secret_")])
    if names:
        index = stage(postings(d, names), "trigrams")
        cand = candidates(index, rules)
        d = d.withColumn("_key", doc_key()).join(cand.select(F.col("key").alias("_key"), F.col("rules").alias("_rules")), "_key", "left")
    else:
        d = d.withColumn("_rules", F.array().cast("array<int>"))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    parts = []
    for k, (r, q) in enumerate(zip(rules, queries, strict=True)):
        s = rule_spans(whole(), r, k)
        parts.append(s if q is None else F.when(F.array_contains(F.coalesce("_rules", F.array().cast("array<int>")), F.lit(k)), s).otherwise(none))
    return d.withColumn("secret_spans", F.array_sort(F.concat(*parts))).drop("_key", "_rules")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(scanned: DataFrame) -> DataFrame:
    """The columns of the scanned documents, each span's text replaced by
    ``[kind]`` (overlapping spans: the first one's) and null text left null."""
    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        head = F.substr(F.col("_t"), acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], head, F.lit("["), x["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))
    fold = F.aggregate("secret_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substr(F.col("_t"), acc["at"] + 1, F.lit(2**31 - 1))))
    keep = [c for c in scanned.columns if not c.startswith("secret_")]
    d = scanned.withColumn("_t", whole())
    return d.withColumn("text", F.when(F.size("secret_spans") == 0, F.col("text")).otherwise(fold)).select(*keep)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("secret_spans")
    base = F.filter(s, lambda x: x["ord"] < len(BASE))
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    return scan(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(s).alias("spans"))


def oracle() -> str:
    q = lambda p: p.replace("'", "''")
    one = []
    for k, r in enumerate(RULES):
        p = q(r.pattern)
        one.append(f"""select id, '{r.kind}' as kind, {k} as ord, st as s, st + hit as e from (
  select id, hit, size, coalesce(sum(gap + hit) over (partition by id order by i rows between unbounded preceding and 1 preceding), 0) + gap as st from (
    select id, unnest(range(1, len(h) + 1)) as i, unnest(list_transform(h, lambda x: length(x))) as hit, unnest(list_transform(g, lambda x: length(x))) as size,
           unnest(list_transform(p[1:len(h)], lambda x: length(x))) as gap
    from (select id, regexp_extract_all(t, '{p}') as h, regexp_extract_all(t, '{p}', {r.group}) as g, regexp_split_to_array(t, '{p}') as p from d))) where size >= {r.least}""")
    spans = " union all ".join(one)
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE)
    listed = lambda cond: f"coalesce(string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, ord) filter ({cond}), '')"
    return f"""with d as (select doc_id as id, coalesce(text, '') as t from documents), sp as ({spans}),
a as (select id, {counts}, {listed(f'ord < {len(BASE)}')} as base, {listed('true')} as spans from sp group by id)
select d.id as doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join a using (id)"""
