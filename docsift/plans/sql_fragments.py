"""Plain-SQL twins of the column functions, for the DuckDB oracle.

Each helper returns an SQL expression string over the given column
expression.  They restate the contract of ``docsift.functions`` and
``docsift.operators.chunking`` in a second engine; they are used only by
``oracle_sql()`` and the tests.
"""

from __future__ import annotations

TOK = r"'[^\s]+'"
TERM = r"'[\p{L}\p{N}]+'"
SENT = r"'[^.!?]*[.!?]+|[^.!?]+$'"
UNIT_T = "STRUCT(s VARCHAR, t INTEGER)"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {TOK})"


def ntok(x: str) -> str:
    return f"len({tokens(x)})"


def terms(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {TERM})"


def clean(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, chr(10), '', 'g'), ' ?\.', '.', 'g')"


def sentences(x: str) -> str:
    return f"regexp_extract_all({x}, {SENT})"


def units(x: str, size: int) -> str:
    n = ntok("u")
    return (
        f"flatten(list_transform({sentences(x)}, lambda u: CASE "
        f"WHEN {n} = 0 THEN []::{UNIT_T}[] "
        f"WHEN {n} <= {size} THEN [{{'s': u, 't': {n}::INTEGER}}] "
        f"ELSE list_transform(range(0, ceil({n} / {size})::BIGINT), lambda i: "
        f"{{'s': array_to_string(list_slice({tokens('u')}, i * {size} + 1, i * {size} + {size}), ' '), "
        f"'t': least({size}, {n} - i * {size})::INTEGER}}) END))"
    )


def pack(units_sql: str, size: int, overlap: int) -> str:
    join_cur = "array_to_string(list_transform(acc.cur, lambda x: x.s), '')"
    if overlap > 0:
        w = ("list_reduce(list_reverse(acc.cur), lambda w, x: CASE WHEN NOT w.stop AND w.sum + x.t <= "
             f"{overlap} THEN {{'cnt': w.cnt + 1, 'sum': w.sum + x.t, 'stop': false}} "
             "ELSE {'cnt': w.cnt, 'sum': w.sum, 'stop': true} END, "
             "{'cnt': 0, 'sum': 0, 'stop': false})")
        keep = f"(CASE WHEN ({w}).sum + u.t <= {size} THEN ({w}).cnt ELSE 0 END)"
        keep_sum = f"(CASE WHEN ({w}).sum + u.t <= {size} THEN ({w}).sum ELSE 0 END)"
        suffix = (f"(CASE WHEN {keep} > 0 THEN list_slice(acc.cur, len(acc.cur) - {keep} + 1, len(acc.cur)) "
                  f"ELSE []::{UNIT_T}[] END)")
    else:
        keep_sum = "0"
        suffix = f"[]::{UNIT_T}[]"
    step = (f"lambda acc, u: CASE WHEN acc.n > 0 AND acc.n + u.t > {size} THEN "
            f"{{'out': list_append(acc.out, {join_cur}), 'cur': list_concat({suffix}, [u]), "
            f"'n': {keep_sum} + u.t}} "
            f"ELSE {{'out': acc.out, 'cur': list_append(acc.cur, u), 'n': acc.n + u.t}} END")
    init = f"{{'out': []::VARCHAR[], 'cur': []::{UNIT_T}[], 'n': 0}}"
    return f"list_reduce({units_sql}, {step}, {init})"


def finish(r: str) -> str:
    """Close a ``pack`` state: emit the chunk still being filled."""
    return (f"CASE WHEN len({r}.cur) > 0 THEN list_append({r}.out, "
            f"array_to_string(list_transform({r}.cur, lambda x: x.s), '')) ELSE {r}.out END")


def chunk_rows(src: str, id_cols: str, text_col: str, size: int, overlap: int) -> str:
    """(id_cols..., chunk_no, content) rows of the sentence chunker."""
    state = pack(units(text_col, size), size, overlap)
    return f"""(SELECT {id_cols}, (generate_subscripts(ch, 1) - 1)::INTEGER AS chunk_no, unnest(ch) AS content
        FROM (SELECT {id_cols}, {finish('r')} AS ch
              FROM (SELECT {id_cols}, {state} AS r FROM {src})))"""


def chunk_window(x: str, size: int, overlap: int) -> str:
    n = ntok(x)
    return (f"CASE WHEN {n} > 0 THEN list_transform(range(0, greatest({n} - {overlap} - 1, 0) + 1, "
            f"{size - overlap}), lambda i: array_to_string(list_slice({tokens(x)}, i + 1, i + {size}), ' ')) "
            f"ELSE []::VARCHAR[] END")


def postings(src: str, id_col: str, text_col: str, dim: int) -> str:
    """(id, bucket, weight) signed hashed term counts, weight <> 0."""
    return f"""(SELECT id, bucket, sum(sgn)::INTEGER AS weight FROM (
        SELECT id, (('0x' || substr(m, 1, 8))::BIGINT % {dim})::INTEGER AS bucket,
               CASE WHEN (('0x' || substr(m, 9, 1))::INTEGER % 2) = 1 THEN -1 ELSE 1 END AS sgn
        FROM (SELECT {id_col} AS id, md5(unnest({terms(text_col)})) AS m FROM {src}))
        GROUP BY id, bucket HAVING sum(sgn) <> 0)"""


def text_topk(q_src: str, q_id: str, q_text: str, c_src: str, c_id: str, c_text: str,
              dim: int, k: int) -> str:
    """(query_id, cand id, score, rank) exact cosine top-k on hashed terms."""
    return f"""(WITH qp AS {postings(q_src, q_id, q_text, dim)},
         cp AS {postings(c_src, c_id, c_text, dim)},
         qn AS (SELECT id, sqrt(sum(weight * weight)::DOUBLE) AS nrm FROM qp GROUP BY id),
         cn AS (SELECT id, sqrt(sum(weight * weight)::DOUBLE) AS nrm FROM cp GROUP BY id),
         d AS (SELECT qp.id AS qid, cp.id AS cid, sum(qp.weight * cp.weight)::DOUBLE AS dot
               FROM qp JOIN cp USING (bucket) GROUP BY qp.id, cp.id),
         s AS (SELECT d.qid, d.cid, round(d.dot / (qn.nrm * cn.nrm), 6) AS score
               FROM d JOIN qn ON d.qid = qn.id JOIN cn ON d.cid = cn.id)
    SELECT qid AS query_id, cid, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid)::INTEGER AS rank FROM s)
    WHERE rank <= {k})"""


def render(template: str, **fields: str) -> str:
    """SQL twin of ``operators.chat.render``: literal pieces and fields joined by ``||``."""
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", template):
        if m.start() > pos:
            parts.append("'" + template[pos:m.start()].replace("'", "''") + "'")
        parts.append(f"coalesce(({fields[m.group(1)]})::VARCHAR, '')")
        pos = m.end()
    if pos < len(template):
        parts.append("'" + template[pos:].replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def extractive_answer(q: str, ctx: str) -> str:
    best = (f"list_max(list_transform({sentences(ctx)}, lambda s, i: {{'score': "
            f"len(list_intersect(list_distinct({terms('s')}), list_distinct({terms(q)}))), "
            f"'neg_pos': -i, 's': s}}))")
    return f"coalesce(CASE WHEN ({best}).score > 0 THEN trim(({best}).s) ELSE '' END, '')"


def history_text(h: str) -> str:
    return f"array_to_string(list_transform({h}, lambda x: x.role || ': ' || x.content), chr(10))"


def rewrite(q: str, h: str) -> str:
    users = f"list_transform(list_filter({h}, lambda x: x.role = 'user'), lambda x: x.content)"
    return f"CASE WHEN len({users}) > 0 THEN array_to_string(list_append({users}, {q}), ' ') ELSE {q} END"


MESSAGES_CTE = """m AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'content': text} ORDER BY turn) AS msgs
  FROM conversations GROUP BY conv_id),
h AS (SELECT conv_id, msgs, msgs[len(msgs)].content AS question,
             list_slice(msgs, 1, len(msgs) - 1) AS hist FROM m)"""


def lexicon_cte(min_share: float) -> str:
    return f"""lex AS (SELECT term FROM (SELECT DISTINCT doc_id, unnest(list_distinct({terms('text')})) AS term
                              FROM documents) GROUP BY term HAVING count(*) >= {min_share} * (SELECT count(*) FROM documents))"""


def verdict_cte(threshold: float) -> str:
    return f"""qt AS (SELECT DISTINCT conv_id, unnest(list_distinct({terms('question')})) AS term FROM h),
share AS (SELECT qt.conv_id, avg(CASE WHEN lex.term IS NULL THEN 0 ELSE 1 END) AS lex_share
          FROM qt LEFT JOIN lex USING (term) GROUP BY qt.conv_id),
j AS (SELECT h.*, share.lex_share,
             CASE WHEN coalesce(share.lex_share, 0) >= {threshold} THEN 'yes' ELSE 'no' END AS verdict
      FROM h LEFT JOIN share USING (conv_id))"""


def semantic(x: str, threshold: float, size: int) -> str:
    """SQL twin of ``chunking.chunk_semantic_col`` (state before finishing)."""
    us = f"list_transform({units(x, size)}, lambda u: {{'s': u.s, 't': u.t, 'tt': list_distinct({terms('u.s')})}})"
    sim = ("CASE WHEN sqrt((len(acc.prev) * len(u.tt))::DOUBLE) > 0 THEN "
           "len(list_intersect(acc.prev, u.tt)) / sqrt((len(acc.prev) * len(u.tt))::DOUBLE) ELSE 0.0 END")
    step = (f"lambda acc, u: CASE WHEN acc.n > 0 AND (({sim}) < {threshold} OR acc.n + u.t > {size}) "
            "THEN {'out': list_append(acc.out, acc.cur), 'cur': u.s, 'n': u.t, 'prev': u.tt} "
            "ELSE {'out': acc.out, 'cur': acc.cur || u.s, 'n': acc.n + u.t, 'prev': u.tt} END")
    init = "{'out': []::VARCHAR[], 'cur': '', 'n': 0, 'prev': []::VARCHAR[]}"
    return f"list_reduce({us}, {step}, {init})"
