"""Benchmark passages against brute force, licence findings."""

import random
import re

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL

import __spark_entry__ as E
from maskweave.llm import decontaminate, licenses


def smith_waterman(a, b):
    prev, best = [0] * (len(b) + 1), 0
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(max(0, prev[j] + (2 if x == y else -1), prev[j + 1] - 1, now[j] - 1))
        best = max(best, max(now))
        prev = now
    return best


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_align_like_plain_smith_waterman():
    rnd = random.Random(2)
    pairs = [([rnd.randrange(6) for _ in range(rnd.randrange(1, 12))], [rnd.randrange(6) for _ in range(rnd.randrange(1, 25))])
             for _ in range(60)]
    score, _ = decontaminate.align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert score.tolist() == [smith_waterman(a, b) for a, b in pairs]


def test_matches_brute_force(spark):
    rnd = random.Random(4)

    def text(n):
        return [f"w{int(rnd.paretovariate(0.7))}" for _ in range(n)]

    items = [(k, text(rnd.randrange(12, 40))) for k in range(12)]
    docs, planted = [], set()
    for k in range(80):
        w = text(rnd.randrange(20, 200))
        if k % 4 == 0:  # a copy with edits
            copy = list(items[k % 12][1])
            for _ in range(rnd.randrange(0, len(copy) // 6 + 1)):
                copy[rnd.randrange(len(copy))] = "edited"
            if k % 8 == 0:
                copy.insert(5, "inserted")
            w[10:10] = copy
            planted.add((k, k % 12))
        docs.append((k, " ".join(w).upper()))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.score, 9) for r in decontaminate.matches(d, i).collect()}
    want = {}
    for a, t in docs:
        for b, w in items:
            share = smith_waterman(w, words(t)) / (2 * len(w))
            if share >= 0.5:
                want[a, b] = round(share, 9)
    # besides the planted copies only chance runs of frequent words reach 0.5
    assert planted <= got.keys() and got.items() <= want.items() and len(want) - len(got) < 6


def test_edited_copies_at_several_rates(spark):
    """Every ``every``-th word of a copy is replaced, dropped or follows a new
    one; what plain alignment finds must be found."""
    rnd = random.Random(9)
    base = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(100).collect()]
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    vocabulary = [w for t in base for w in words(t)]
    docs, planted = [], []
    for every in (3, 4, 6, 10):
        for item, w in items:
            copy = []
            for k, x in enumerate(w):
                edit = rnd.randrange(3) if rnd.randrange(every) == 0 else None
                copy += [x] if edit is None else [[rnd.choice(vocabulary)], [], [x, rnd.choice(vocabulary)]][edit]
            planted.append((len(docs), item, every, smith_waterman(w, copy) / (2 * len(w)) >= 0.5))
            docs.append((len(docs), " ".join(rnd.choices(vocabulary, k=40) + copy + rnd.choices(vocabulary, k=40))))
    docs += [(1000 + k, t) for k, t in enumerate(base)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(d, i).collect()}
    for every in (3, 4, 6, 10):
        due = [(doc, item) for doc, item, e, aligns in planted if e == every and aligns]
        assert len(due) > 10 and sum(x in got for x in due) >= 0.98 * len(due)


def test_seeds_do_not_depend_on_the_size_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    items = docs.where("doc_id % 9 = 0").selectExpr("doc_id as item_id", "text")
    many = docs
    for _ in range(3):
        many = many.union(many)
    (one,), (eight,) = ([b.value for b in decontaminate.blocks(d, items)] for d in (docs, many))
    assert len(one.seed) > 1000 and (one.seed == eight.seed).all() and (one.pos == eight.pos).all()


def test_dense_seeds_are_handled_in_parts(monkeypatch):
    rnd = random.Random(3)
    names = [f"n{k}" for k in range(30)]
    block = decontaminate.Block(list(range(60)), [" ".join(rnd.choices(names, k=12)) for _ in range(60)], [1] * 60)
    block.choose(np.ones(len(block.vocabulary), np.int64), 10**9, decontaminate.RATE)
    column = pa.array([" ".join(rnd.choices(names, k=400)), None, " ".join(rnd.choices(names, k=90)), ""])
    whole = sorted(decontaminate._best(decontaminate._find(block, column, 0.4)).items())
    monkeypatch.setattr(decontaminate, "HELD_HITS", 500)
    key, _, _ = block.seeded(*next(decontaminate.word_slices(column))[2:])
    assert len(list(block.hits(key))) > 5
    assert sorted(decontaminate._best(decontaminate._find(block, column, 0.4)).items()) == whole != []


def test_decontaminate_edges(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "a b"),
                                   (1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    rows = [(1, None, 0.1), (2, "", 0.1), (3, "so alpha Beta gamma delta epsilon zeta so", 0.1), (3, "a b", 0.1),
            (None, "alpha beta gamma delta epsilon zeta", 0.1), (5, "word " * 60_000 + "alpha beta gamma delta epsilon", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    assert found == {(3, 1), (None, 1), (5, 1)}
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and sorted((r.doc_id, r.text) for r in clean.where("text is not null").collect()) == [
        (2, ""), (3, "a b")]
    assert decontaminate.matches(docs.limit(0), items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == len(rows)


def test_blocks_of_items_give_the_same(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    many = list(decontaminate.blocks(docs, items, block_words=300))
    assert len(many) > 1
    assert sorted(x for b in many for x in b.value.ids) == sorted(r.item_id for r in items.collect())
    assert whole


MIT = """// Permission is hereby granted, free of charge, to any person obtaining a copy of
// this software and associated documentation files (the "Software"), to deal
// in the Software without restriction.
//
// The above copyright notice and this permission notice shall be included in all
// copies or substantial portions of the Software.
//
// THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""


def test_repeated_items_are_held_once_and_blocks_are_bounded(spark):
    text = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, text)] * 300 + [(k, f"{text} item{k}") for k in range(2, 40)],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(7, f"before {text} after")], "doc_id long, text string")
    held = [b.value for b in decontaminate.blocks(docs, items, block_words=60)]
    assert sum(len(b.ids) for b in held) == 39 and all(len(b.words) <= 60 for b in held)
    rows = decontaminate.matches(docs, items).where("item_id = 1").collect()
    assert len(rows) == 300 and len(set(rows)) == 1


def test_license_rules():
    def names(t):
        return [(f[0], f[1]) for f in licenses.findings(t)]

    assert names(MIT) == [("MIT", None)]
    begin, end = list(licenses.findings("Before.\n" + MIT))[0][5:]
    assert "Permission" in ("Before.\n" + MIT)[begin:end] and "Before" not in ("Before.\n" + MIT)[begin:end]
    assert names("Licensed under the Apache License, Version 2.0.") == [("Apache", "2.0")]
    assert names("x\nLicensed under CC BY-NC-SA 4.0") == [("CC-BY-NC-SA", "4.0")]
    assert names("SPDX-License-Identifier: MIT") == [("mit", None)]
    assert names("Released under the 3-Clause BSD licence.") == [("BSD-3-Clause", None)]
    assert names("The above copyright notice and this permission notice shall be included in all copies or "
                 "substantial portions of the Software.") == [("unmatched", None)]
    assert names("He has a driving license. Permission was given.") == []
    assert names("") == []


def test_license_query_finds_every_line(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    lines = {"MIT": r"Released under the MIT License\.", "Apache": r"Licensed under the Apache License, Version [\d.]+\d",
             "GPL": r"licensed under the GNU General Public License, version \d", "CC-BY-NC": r"Licensed under CC BY-NC [\d.]+\d"}
    want = sorted((d.doc_id, k) for d in docs for k, p in lines.items() for _ in re.findall(p, d.text or ""))
    got = E.queries()["op3_license_scan"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.license) for r in got) == want


def test_license_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Released under the MIT License.", "x"),
                                (3, "Released under the MIT License.", "x"),
                                (None, "y " * 100_000 + ". Released under the MIT License.", "x")],
                               "doc_id long, text string, license string")
    assert sorted(((r.doc_id, r.license) for r in licenses.scan(df).collect()), key=str) == [(3, "MIT"), (3, "MIT"), (None, "MIT")]
    assert licenses.scan(df.limit(0)).count() == 0


SAMPLES = {
    "title-mit": "The MIT License (MIT)", "title": "Apache License Version 2.0, January 2004",
    "field": "License: Apache 2.0", "name-uses": "This project uses the MIT license",
    "spdx": "SPDX-License-Identifier: MIT", "name-mit": "Released under the MIT License",
    "name-apache": "Provided under the Apache License v2.0", "name-gpl": "Released under the GPL v3",
    "name-lgpl": "Distributed under the GNU LGPL version 2.1 or later", "name-agpl": "Available under AGPLv3",
    "name-mpl": "Subject to the Mozilla Public License 2.0", "name-bsd": "Licensed under the BSD 2-clause license",
    "name-cc": "Released under CC BY-SA 4.0",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted",
    "as-is": "This software is provided as\n# is", "bsd-grant": "Redistribution and use in source and binary forms, "
    "with or without modification, are permitted", "bsd-source": "Redistributions of source code must retain the "
    "above copyright notice", "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice",
    "bsd-names": "Neither the name of X may be used to endorse or promote products",
    "no-liability": "In no event shall X be liable for any loss",
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at x",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the "
                    "License is distributed on an AS IS BASIS",
    "apache-limits": "See the License for the specific language governing permissions and limitations under the License",
    "gpl-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License; either version 2 of the License",
    "gpl-hope": "This program is distributed in the hope that it will be useful",
    "gpl-more": "See the GNU General Public License for more details",
    "gpl-copy": "You should have received a copy of the GNU General Public License",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at x",
    "unlicense": "This is free and unencumbered software released into the public\n domain",
    "public-domain": "This file is in the public\ndomain",
}


def test_every_license_sentence_is_found_by_the_scan(spark):
    assert set(SAMPLES) == set(licenses.SENTENCES)
    df = spark.createDataFrame(list(enumerate(f"{t}." for t in SAMPLES.values())), "doc_id long, text string")
    assert {r.doc_id: r.sentences for r in licenses.scan(df).collect()} == {i: [n] for i, n in enumerate(SAMPLES)}


def test_license_titles_fields_and_statements():
    def names(t):
        return [(f[0], f[1]) for f in licenses.findings(t)]

    assert names("MIT License") == names("License: MIT") == names("This project uses the MIT license.") == [("MIT", None)]
    assert names("# The MIT License\n\nCopyright (c) A\n\n" + MIT) == [("MIT", None)]
    assert names("Eclipse Public License v2.0") == [("EPL", "2.0")] and names("license: GPLv3") == [("GPL", "3")]
    assert names("It uses the ISC license and text is released under CC BY 4.0.") == [("ISC", None), ("CC-BY", "4.0")]
    assert names("The license of a driver expired.") == names("He uses the license plate.") == []


def test_license_names_inside_sentences():
    def names(t):
        return [(f[0], f[1]) for f in licenses.findings(t)]

    assert names("This is released under the MIT License and may be copied.") == [("MIT", None)]
    assert names("Released under the GPL v3 (see LICENSE).") == [("GPL", "3")]
    assert names("Code released under the MIT License and text released under CC BY 4.0.") == [
        ("MIT", None), ("CC-BY", "4.0")]
    header = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
              "compliance with the License. You may obtain a copy of the License at x.")
    (found,) = licenses.findings(header)
    assert found[:3] == ("Apache", "2.0", ["name-apache", "apache-use", "apache-copy"])
    assert names("This program is free software;\nyou can redistribute it and/or modify it under the terms of the "
                 "GNU General Public License;\neither version 2 of the License, or later.") == [("GPL", "2")]
