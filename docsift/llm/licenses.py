"""Operator 5: licence scans by a trained paragraph classifier.

A paragraph is a run of lines with a letter or digit.  Scored are its lines
and, for every template, all windows of the template's length in it that hold
at least ``CONFIRM`` of the template's distinct words and of its distinct
pairs of neighbouring words, so wrapped notices and notices inside long lines
are met at any place.  Features are hashed word 1- and 2-grams (case folded,
edge punctuation and digits dropped, each at most once, scaled to unit
length); a multinomial logistic regression gives a probability to every
licence family and to the class *unknown*.  Training rows are the templates
below, whole and with words left out, and, as unknown, at most
``UNKNOWN_ROWS`` lines of at most ``UNKNOWN_DOCS`` distinct texts (documented
bounds; the smallest hashes) that hold no word of a notice; the temperature of the probabilities is fitted on rows left out.  A line's
likeliest family, or the family of a window's template, is found if it is
likelier than ``ACCEPT`` and confirmed by ``CONFIRM``; of finds that overlap
the likeliest stays, and all else is unknown.

Cases: null and empty texts have no paragraphs and no licence; lines of
punctuation alone end a paragraph; a very long line is scored whole and in
windows; equal rows get equal results; an empty table gives an empty result
(and a model from the templates alone); further columns are kept by ``scan``,
``license_*`` columns are the operator's own.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import Texts, chunks, documents, mix, with_fields
from docsift.llm.native import whole

#: Short notices of public licences, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Distributed under the terms of the GNU Lesser General Public License",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "mpl": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Released under CC0 1.0 Universal, public domain dedication.",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without written permission of the publisher.",
        "Copyright. All rights reserved.",
    ),
}
FAMILIES = tuple(TEMPLATES)
NOTICE_WORDS = ("licen", "copyright", "rights reserved", "redistribut")
#: bytes of letters and digits; a line without one ends a paragraph
SOLID = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
DIMS = 1 << 14
UNKNOWN_DOCS, UNKNOWN_ROWS = 400, 6_000
ACCEPT, CONFIRM = 0.5, 0.6


def plain_words(text: str) -> list[str]:
    """Words of a paragraph, case folded, without digits and edge punctuation."""
    out = []
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        w = re.sub(r"[0-9]", "", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)).strip(".,;:!?()[]\"'/-")
        if w:
            out.append(w)
    return out


def paragraphs(t: Texts):
    """Bytes made plain for hashing, and spans: first byte, end byte and document of each line."""
    brk = np.flatnonzero(t.buf == 10)
    start = np.unique(np.concatenate([t.off[:-1], brk + 1]))
    start = start[start < len(t.buf)]
    end = np.concatenate([start[1:], [len(t.buf)]]) if len(start) else start
    return start, end, np.searchsorted(t.off, start, "right") - 1


def plain_spans(t: Texts):
    """First byte, end byte and hash of the words of ``plain_words``."""
    s, e, _ = t.words()
    # digits and edge punctuation go: trim ends, and hash the rest without digits folded
    edge = np.zeros(256, bool)
    edge[list(b".,;:!?()[]\"'/-0123456789")] = True
    kept = np.flatnonzero(~edge[t.buf])
    lo, hi = np.searchsorted(kept, s), np.searchsorted(kept, e)
    ok = lo < hi
    s, e = kept[lo[ok]], kept[hi[ok] - 1] + 1
    return s, e, t.hashes(s, e)


def grams(t: Texts):
    """(code, row) of the distinct 1- and 2-grams of all lines; rows count the lines."""
    s, _, h = plain_spans(t)
    start, end, doc = paragraphs(t)
    row = np.searchsorted(start, s, "right") - 1
    code, row = coded(h, row)
    return code, row, start, end, doc


def coded(h: np.ndarray, row: np.ndarray):
    """(code, row) of the distinct 1- and 2-grams of words ``h`` within rows."""
    pair = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    same = row[:-1] == row[1:] if len(h) > 1 else np.zeros(0, bool)
    code = np.concatenate([h, pair[same]]) % np.uint64(DIMS)
    rows = np.concatenate([row, row[:-1][same] if len(h) > 1 else row[:0]])
    key = np.unique(rows.astype(np.int64) * DIMS + code.astype(np.int64))
    return key % DIMS, key // DIMS


class Model:
    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.weights, self.bias, self.temperature = weights, bias, temperature

    def logits(self, code, row, n):
        size = np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
        out = np.zeros((n, len(self.bias)))
        if len(row):
            cut = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[cut]] = np.add.reduceat(self.weights[code], cut)
        return out / size[:, None] + self.bias

    def probabilities(self, code, row, n):
        z = self.logits(code, row, n) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def one_text(rows: list[str]) -> Texts:
    raw = [r.replace("\n", " ").encode("utf-8") for r in rows]
    return Texts(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def train(unknown: list[str]) -> Model:
    """Full-batch gradient steps on the templates, their shortened forms and ``unknown``."""
    rows, y = [], []
    for k, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            w = text.split()
            forms = [text] + [" ".join(w[:i] + w[i + 1:]) for i in range(len(w))] + [" ".join(w[:max(3, len(w) - c)]) for c in range(1, 4)]
            rows += forms
            y += [k] * len(forms)
    # words of every template shuffled together name no family
    bag = sorted({w for f in TEMPLATES.values() for t in f for w in t.split()})
    mixed = [" ".join(bag[(i * 37 + j * 101) % len(bag)] for j in range(8)) for i in range(200)]
    rows += [*unknown, *mixed]
    y += [len(FAMILIES)] * (len(unknown) + len(mixed))
    y = np.array(y)
    t = one_text(rows)
    code, row, start, _, doc = grams(t)
    row = doc[row]
    n, classes = len(rows), len(FAMILIES) + 1
    held = np.arange(n) % 5 == 0
    weight = 1.0 / np.bincount(y, minlength=classes)[y]
    weight[held] = 0
    weight *= classes / max(weight.sum(), 1e-9) / classes
    m = Model(np.zeros((DIMS, classes)), np.zeros(classes), 1.0)
    size = np.sqrt(np.maximum(1, np.bincount(row, minlength=n)))
    hot = np.eye(classes)[y]
    step, speed, bspeed = 40.0, 0.0, 0.0
    for _ in range(300):
        err = (m.probabilities(code, row, n) - hot) * weight[:, None]
        scaled = (err / size[:, None])[row]
        g = np.stack([np.bincount(code, scaled[:, c], DIMS) for c in range(classes)], 1) + 1e-5 * m.weights
        speed, bspeed = 0.9 * speed - step * g, 0.9 * bspeed - step * err.sum(0)
        m.weights, m.bias = m.weights + speed, m.bias + bspeed * 0.1
    z = m.logits(code, row, n)[held]
    best = (np.inf, 1.0)
    for temp in np.geomspace(0.25, 8, 21):
        q = z / temp
        q = q - q.max(1, keepdims=True)
        loss = -(q[np.arange(len(q)), y[held]] - np.log(np.exp(q).sum(1))).mean()
        best = min(best, (float(loss), float(temp)))
    m.temperature = best[1]
    return m


def fit(docs: DataFrame, bound: int = UNKNOWN_DOCS) -> Model:
    """A model from the templates and lines of at most ``bound`` distinct texts, chosen by hash."""
    low = F.lower(whole())
    clean = docs.where(~F.greatest(*[F.contains(low, F.lit(w)) for w in NOTICE_WORDS]))
    clean = clean.select(whole().alias("t"), F.xxhash64(whole()).alias("h"))
    chosen = F.broadcast(clean.select("h").distinct().orderBy("h").limit(bound))             # bound longs; texts stay where they are
    rows = clean.join(chosen, "h").groupBy("h").agg(F.min("t").alias("t")).toLocalIterator()
    lines = {x for r in rows for x in r.t.split("\n") if plain_words(x)}
    return train(sorted(lines, key=lambda x: (zlib.crc32(x.encode()), x))[:UNKNOWN_ROWS])


TEMPLATE_WORDS = {f: [frozenset(plain_words(t)) for t in ts] for f, ts in TEMPLATES.items()}


def confirmed(family: str, line: str) -> bool:
    words = set(plain_words(line))
    return any(len(t & words) >= CONFIRM * len(t) for t in TEMPLATE_WORDS[family])


class Forms:
    """The templates as hashes of words."""

    def __init__(self):
        self.family, self.words, self.pairs, self.length = [], [], [], []
        for k, family in enumerate(FAMILIES):
            for text in TEMPLATES[family]:
                h = plain_spans(one_text([text]))[2].tolist()
                self.family.append(k)
                self.words.append(frozenset(h))
                self.pairs.append(frozenset(zip(h, h[1:], strict=False)))
                self.length.append(len(h))
        self.known = np.array(sorted(set().union(*self.words)), np.uint64)
        self.of = np.array([[w in t for w in self.known.tolist()] for t in self.words])


def windows(h: np.ndarray, stop: np.ndarray, forms: Forms):
    """(first, end, family) of the confirmed windows over words ``h``, cut to the
    template's words; ``stop`` is the end of a word's paragraph."""
    at = np.minimum(np.searchsorted(forms.known, h), len(forms.known) - 1)
    hit = forms.known[at] == h
    where = np.arange(len(h))
    found = set()
    for k, size in enumerate(forms.length):
        mine = hit & forms.of[k][at]
        sums = np.concatenate([[0], np.cumsum(mine)])
        end = np.minimum(where + size, stop)
        words, pairs = forms.words[k], forms.pairs[k]
        for i in np.flatnonzero(mine & (sums[end] - sums[:-1] >= CONFIRM * len(words))).tolist():
            w = h[i:end[i]].tolist()
            if len(words.intersection(w)) >= CONFIRM * len(words) and len(pairs.intersection(zip(w, w[1:], strict=False))) >= CONFIRM * len(pairs):
                last = i + int(np.flatnonzero(mine[i:end[i]])[-1])
                found.add((i, last + 1, forms.family[k]))
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def finds(t: Texts, m: Model, forms: Forms):
    """(document, family, first line, last line) of what is found, and per line
    its document, whether it has a word, and the largest family probability."""
    s, _, h = plain_spans(t)
    start, end, doc = paragraphs(t)
    row = np.searchsorted(start, s, "right") - 1
    code, rows = coded(h, row)
    p = m.probabilities(code, rows, len(start))
    filled = np.bincount(row, minlength=len(start)) > 0
    top = p[:, :-1].argmax(1) if len(start) else np.zeros(0, int)
    chance = np.where(filled, p[np.arange(len(start)), top], 0.0)
    # candidates: (probability, first word, end word, family)
    first, after = np.searchsorted(row, np.arange(len(start))), np.searchsorted(row, np.arange(len(start)), "right")
    hits = [(float(chance[i]), int(first[i]), int(after[i]), int(top[i])) for i in np.flatnonzero(chance > ACCEPT)
            if confirmed(FAMILIES[top[i]], t.buf[start[i]:end[i]].tobytes().decode("utf-8", "replace"))]
    # a paragraph goes on while lines of one document have a letter or digit
    solid = np.concatenate([[0], np.cumsum(SOLID[t.buf])])
    text = solid[end] > solid[start]
    fresh = ~text | (np.diff(doc, prepend=-1) != 0) | np.concatenate([[True], ~text[:-1]])[:len(text)]
    part = np.cumsum(fresh)[row] if len(row) else row
    w = windows(h, np.searchsorted(part, part, "right"), forms)
    if len(w):
        sizes = w[:, 1] - w[:, 0]
        of = np.repeat(np.arange(len(w)), sizes)
        place = np.repeat(w[:, 0] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(of))
        q = m.probabilities(*coded(h[place], of), len(w))[np.arange(len(w)), w[:, 2]]
        np.maximum.at(chance, row[w[:, 0]], q)
        hits += [(float(q[i]), *map(int, w[i])) for i in np.flatnonzero(q > ACCEPT)]
    out, taken = [], {}
    for _, i, j, f in sorted(hits, key=lambda x: (-round(x[0], 9), x[1], -x[2], x[3])):
        if all(taken.get(k, f) == f for k in range(i, j)):
            taken.update(dict.fromkeys(range(i, j), f))
            out.append((doc[row[i]], f, row[i], row[j - 1]))
    return out, doc, filled, chance


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``license_lines`` (lines with a part of
    what was found), ``license_families`` (sorted, comma-joined), ``license_lines_all``
    (lines with a word) and ``license_best`` (largest family probability)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # DIMS x families weights
    forms = Forms()
    keep = [c for c in docs.columns if not c.startswith("license_")]
    src = docs.select(*keep, whole().alias("_text"))

    def run(batches):
        m = shipped.value
        for b in batches:
            found, families, lines, best = [], [], [], []
            for _, t in chunks(b.column("_text"), 1 << 20):
                got, doc, filled, chance = finds(t, m, forms)
                per = [set() for _ in range(t.n)]
                held = np.zeros(len(doc), bool)
                for d, f, i, j in got:
                    per[d].add(FAMILIES[f])
                    held[i:j + 1] = True
                count = np.bincount(doc[held & filled], minlength=t.n)
                most = np.zeros(t.n)
                np.maximum.at(most, doc, chance)
                found.append(count)
                families += [",".join(sorted(x)) for x in per]
                lines.append(np.bincount(doc[filled], minlength=t.n))
                best.append(most)
            cat = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), cat(found, pa.int64()), pa.array(families, pa.string()), cat(lines, pa.int64()), cat(best, pa.float64())],
                [*keep, "license_lines", "license_families", "license_lines_all", "license_best"])
    return src.mapInArrow(run, with_fields(docs.select(*keep), "license_lines long, license_families string, license_lines_all long, license_best double"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return scan(docs, fit(docs)).select("doc_id", F.col("license_lines_all").alias("n_lines"), F.col("license_lines").alias("n_license"),
                                        F.col("license_families").alias("families"), F.round("license_best", 6).alias("best"))
