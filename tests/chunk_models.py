"""Plain statements of the chunk contracts, one text at a time."""


def chunks(text: str | None, size: int, overlap: int) -> list:
    """Sentence chunks of a text."""
    import re
    if text is None:
        return None
    # Java's \s is ASCII white space (Python's is Unicode-wide): spelled out
    tok = re.compile("[^ \\t\\n\\x0b\\f\\r]+")
    units = []
    for s in re.findall(r"[^.!?]*[.!?]+|[^.!?]+$", text):
        toks = tok.findall(s)
        n = len(toks)
        if n == 0:
            continue
        if n <= size:
            units.append((s, n))
        else:
            for i in range(0, n, size):
                part = toks[i:i + size]
                units.append((" ".join(part), len(part)))
    out, cur, n = [], [], 0
    for s, t in units:
        if n > 0 and n + t > size:
            out.append("".join(u for u, _ in cur))
            keep, ks = 0, 0
            for _, ut in reversed(cur):
                if ks + ut <= overlap:
                    keep += 1
                    ks += ut
                else:
                    break
            if ks + t > size:
                keep, ks = 0, 0
            cur = (cur[len(cur) - keep:] if keep else []) + [(s, t)]
            n = ks + t
        else:
            cur.append((s, t))
            n += t
    if cur:
        out.append("".join(u for u, _ in cur))
    return out


def semantic(text: str | None, threshold: float, size: int) -> list:
    """Semantic chunks of a text."""
    import math
    import re

    import regex
    if text is None:
        return None
    tok = re.compile("[^ \\t\\n\\x0b\\f\\r]+")
    term = regex.compile(r"[\p{L}\p{N}]+")
    units = []
    for s in re.findall(r"[^.!?]*[.!?]+|[^.!?]+$", text):
        toks = tok.findall(s)
        n = len(toks)
        if n == 0:
            continue
        pieces = [(s, n)] if n <= size else [(" ".join(toks[i:i + size]), len(toks[i:i + size]))
                                             for i in range(0, n, size)]
        for p, t in pieces:
            units.append((p, t, list(dict.fromkeys(term.findall(p.lower())))))
    out, cur, n, prev = [], "", 0, []
    for s, t, tt in units:
        den = math.sqrt(len(prev) * len(tt))
        sim = len(set(prev) & set(tt)) / den if den > 0 else 0.0
        if n > 0 and (sim < threshold or n + t > size):
            out.append(cur)
            cur, n = s, t
        else:
            cur, n = cur + s, n + t
        prev = tt
    if n > 0:
        out.append(cur)
    return out
