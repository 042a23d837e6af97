import re

import pytest

from docsift.llm import licenses as L


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return L.fit(docs)


def test_families_of_the_corpus(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kinds = {"mit": r"^Released under the MIT License", "apache": r"^Licensed under the Apache License", "gpl": r"^This work is licensed under the GNU General",
             "cc": r"^Licensed under CC BY", "proprietary": r"All rights reserved"}
    for r in L.scan(docs, model).collect():
        want = sorted(k for k, p in kinds.items() if re.search(p, r.text or "", re.M))
        assert r.license_families == ",".join(want), r.doc_id
        assert (r.license_lines > 0) == bool(want)


def test_unlike_paragraphs_are_unknown(spark, model):
    rows = [(1, None), (2, ""), (3, "\n\n \n"), (4, "the license of a driver was under the bridge"), (5, "public permission software License Version MIT"),
            (6, "word " * 50_000), (7, "text above\nReleased under the MIT License.\n\nLicensed under CC BY-NC 4.0."), (7, "x"), (None, "x")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, license_best string")
    got = [(r.doc_id, r.license_families) for r in L.scan(df, model).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(i, "cc,mit" if t and "MIT License." in t else "") for i, t in rows]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(df, L.fit(df)).collect() == []


WRAPPED = {
    "gpl": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "lgpl": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "mit": """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction""",
}


def test_wrapped_headers_and_notices_inside_long_lines(spark, model):
    prose = "the river was under the bridge and many people of the town came to see it in the evening " * 12
    rows = []
    for k, text in WRAPPED.items():
        rows += [(k, text), (k, f"some text above\n\n{text}\n\nand below"), (k, "".join(f" * {x}\n" for x in text.split("\n"))),
                 (k, prose + text.replace("\n", " ") + " " + prose)]
    rows += [("", prose), ("", "Redistribution and use in\n\nsource and binary\n\nforms, with or\n\nwithout modification"), ("", prose + "it was released under the label of the band " + prose),
             ("apache,gpl", prose + WRAPPED["gpl"].replace("\n", " ") + " " + prose + WRAPPED["apache"].replace("\n", " "))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, want string, text string")
    wrong = [(r.want, r.license_families, r.text[:200]) for r in L.scan(df, model).collect() if r.want != r.license_families]
    assert not wrong


def test_near_families_tags_and_long_edges(spark, model):
    rows = [("isc", "Licensed under the ISC License."), ("mit", "Licensed under the MIT License."), ("mit", "SPDX-License-Identifier: MIT"),
            ("isc", "// SPDX-License-Identifier: ISC"), ("gpl", "# SPDX-License-Identifier: GPL-2.0-only"), ("apache", "SPDX-License-Identifier: Apache-2.0"),
            ("agpl", "This program is licensed under the GNU Affero General Public License, version 3."),
            ("gpl", "This program is licensed under the GNU General Public License, version 3."),
            ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
            ("mit", "-" * 40 + "Released under the MIT License." + "-" * 40)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, want string, text string")
    wrong = [(r.want, r.license_families, r.text) for r in L.scan(df, model).collect() if r.want != r.license_families]
    assert not wrong


def test_edges_are_stripped_by_runs():
    text = "----------MIT 0123456789abc0123456789 ((((((((((x)))))))))) ........... é"
    t = L.one_text([text])
    s, e, _ = L.plain_spans(t)
    assert [t.buf[a:b].tobytes().decode().lower() for a, b in zip(s, e, strict=True)] == L.plain_words(text)
