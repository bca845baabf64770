"""Decontamination, quality rules and licence scan against brute force."""

import random

import numpy as np
import pytest
from compare import differences, duck
from conftest import ODD
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tillstar.llm import decontaminate, licences, quality, sql
from tillstar.llm.common import alnum_words


def brute(words, items, width):
    windows = {}
    for item, text in items:
        own = alnum_words(text)
        for k in range(max(1, len(own) - width + 1) if own else 0):
            windows.setdefault(tuple(own[k : k + width]), set()).add(item)
    hit, found = set(), set()
    for n in {len(w) for w in windows}:
        for k in range(len(words) - n + 1):
            if (window := tuple(words[k : k + n])) in windows:
                hit |= set(range(k, k + n))
                found |= windows[window]
    return sorted(hit), sorted(found)


@pytest.mark.parametrize("seed", range(25))
def test_fm_index_finds_every_occurrence(seed):
    draw = random.Random(seed)
    width, names = draw.choice([2, 3, 4]), [f"w{i}" for i in range(draw.choice([1, 2, 5, 12]))]

    def words(n):
        return [draw.choice(names) for _ in range(n)]

    items = [(str(i), " ".join(words(draw.choice([0, 1, 3, 9])))) for i in range(4)]
    texts = [[w.encode() for w in words(n) + ["zz"] + words(n)] for n in (0, 1, 7, 60)]
    found = decontaminate.occurrences(texts, decontaminate.Phrases(items, width))
    for k, text in enumerate(texts):
        starts, ends, own = found.get(k, (np.zeros(0, int), np.zeros(0, int), []))
        covered = [w for s, e in zip(starts, ends, strict=True) for w in range(s, e)]
        assert (covered, own) == brute(text, items, width)


def benchmark(spark, items):
    kind = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(items, kind)


def test_blocks_give_the_same_as_one(spark, docs):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(draw.choice(words) for _ in range(12))) for i in range(20)]
    items += [(None, "w1 w2"), (30, None), (31, ""), (32, "W3"), (0, "w5 w5 w5")]
    pairs = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(40)))) for i in range(40)]
    table, tests = docs(pairs + ODD), benchmark(spark, items)
    whole = decontaminate.contaminated(table, tests, window=4)
    parts = decontaminate.contaminated(table, tests, window=4, block=60)
    assert "score" in whole.columns and whole.columns.count("spans") == 1
    key = lambda r: (str(r.doc_id), str(r.text))
    one, two = sorted(whole.collect(), key=key), sorted(parts.collect(), key=key)
    assert one == two and len(one) == len(pairs + ODD)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # all blocks in one pass
    passes = decontaminate.contaminated(table, tests, window=4, block=60, sent=1500)
    assert sorted(passes.collect(), key=key) == one
    cleaned = decontaminate.contaminated(table, tests, window=4, block=60, sent=1500, clean=True)
    texts = {(str(r.doc_id), str(r.text)) for r in decontaminate.remove_spans(whole).collect()}
    assert {(str(r.doc_id), str(r.text)) for r in cleaned.collect()} == texts
    named = [(str(i), t) for i, t in items if i is not None]
    for r in one:
        hit, found = brute(alnum_words(r.text), named, 4)
        assert (r.n_hit, r.items, r.contaminated) == (len(hit), found, bool(hit))


def test_blocks_are_cut_by_tasks_and_sent_in_bounded_lists(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(40)]
    tests = benchmark(spark, items + items)  # repeated rows count once
    packed = decontaminate.blocks(tests, "item_id", "text", 4, 400)
    made = [decontaminate._loaded(r.key, bytes(r.phrases)) for r in packed.collect()]
    assert len(made) > 10 and sum(len(p.size) for p in made) == 40 * 27
    assert sorted(n for p in made for n in p.names) == sorted(str(i) for i, _ in items)
    most = 3 * max(len(r.phrases) for r in packed.collect())
    lists = list(decontaminate.rounds(packed, most))
    assert 1 < len(lists) < len(made)
    assert all(sum(len(payload) for _, payload in one) <= most for one in lists)
    assert list(decontaminate.rounds(packed.limit(0), most)) == [[]]


def test_spans_are_cut_out(spark, docs):
    items = [(1, "the secret answer is forty two and nothing else at all")]
    text = "Before: The SECRET answer -- is forty-two, and nothing else AT ALL! After."
    made = decontaminate.contaminated(docs([(1, text), (2, None), (3, "clean")]), benchmark(spark, items))
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(made).collect()}
    assert cut == {1: "Before: ! After.", 2: None, 3: "clean"}


def test_empty_sides(spark, docs):
    assert decontaminate.contaminated(docs([]), benchmark(spark, [(1, "a")])).count() == 0
    rows = decontaminate.contaminated(docs(ODD), benchmark(spark, [])).collect()
    assert len(rows) == len(ODD) and not any(r.contaminated for r in rows)


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_sql(name, spark, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    assert differences(df, duck(sf_dir), entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(sql.oracle_sql()) - {"op13_main_text"}))  # of pages
def test_odd_documents_match_sql(name, spark, docs, tmp_path):
    folder = str(tmp_path)
    pairs = [(i, t) for i, t in ODD if t is None or "\x00" not in t]
    pairs = [p for p in pairs if p[0] is not None]  # SQL's least id of a group is never null
    odd = docs(pairs).withColumn("lang", F.when(F.col("doc_id") > 5, "en"))
    odd.write.parquet(f"{folder}/documents.parquet")
    benchmark(spark, [(1, "a b c d"), (2, "word"), (3, None)]).write.parquet(f"{folder}/benchmark.parquet")
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = entry.queries()[name](spark, folder)
    assert differences(df, con, entry.oracle_sql()[name]) == []


def test_order_of_rules_changes_nothing(docs):
    texts = ["good words here and there. " * 3 + " ".join(f"w{i}" for i in range(80)), "SHOUT! " * 60, "a|b # $ % " * 30]
    table = docs([(i, t) for i, t in enumerate(texts)] + ODD)
    order = quality.cascade(table)
    assert sorted(order) == sorted(quality.RULES)
    key = lambda r: (str(r.doc_id), str(r.text))
    one = sorted(quality.quality(table, order=order).collect(), key=key)
    two = sorted(quality.quality(table, order=order[::-1]).collect(), key=key)
    assert one == two and len(one) == len(texts) + len(ODD)
    with pytest.raises(ValueError):
        quality.quality(table, order=order[1:])


def test_cascade_of_nothing(docs):
    assert quality.cascade(docs([])) == list(quality.RULES)
    assert quality.quality(docs([])).count() == 0


def test_labels_agree_with_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = entry.queries()["op7_quality"](spark, sf_dir).join(labels, "doc_id").collect()
    low = [r for r in rows if r.quality == 0]
    assert low and not any(r.kept for r in low)


def licence_rows(docs, pairs, **more):
    return {r.doc_id: r for r in licences.licences(docs(pairs), **more).collect()}


def test_base_phrases(docs):
    rows = licence_rows(docs, [
        (1, "x MIT-License, mit license; Apache\nLicense general public license"),
        (2, "mit licenses"), (3, None), (4, ""),
    ])
    r = rows[1]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (10, 4, 1, 7)
    assert r.base_labels == "apache,gpl,mit"
    for k in (2, 3, 4):
        assert (rows[k].n_base, rows[k].first_word, rows[k].base_labels) == (0, None, "")


def brute_base(text):
    words = alnum_words(text)
    places = []
    for phrase, label in licences.BASE.items():
        own = alnum_words(phrase)
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return sorted(places)


def test_base_places_match_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = entry.queries()["op8_licences"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        places = brute_base(texts[r.doc_id])
        assert r.n_base == len(places)
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_templates_give_labels_and_spans(docs):
    notice = licences.TEMPLATES["bsd"][0]
    broken = notice.replace("binary forms", "binary XXX forms")
    rows = licence_rows(docs, [(1, f"one two {notice} three"), (2, broken), (3, notice[:40])])
    assert rows[1].labels == "bsd" and rows[1].score == 1.0
    span = rows[1].spans[0]
    assert (span.start, span.end, span.label) == (2, 2 + len(alnum_words(notice)), "bsd")
    assert rows[2].labels == "bsd" and rows[2].score < 1.01
    assert rows[3].labels == "" and 0 < rows[3].score < 0.8


def test_matching_statistics_match_brute_force():
    draw = random.Random(1)
    for _ in range(200):
        texts = [[draw.randrange(3) for _ in range(draw.randrange(1, 12))] for _ in range(3)]
        query = [draw.randrange(4) for _ in range(20)]
        automaton = licences.Automaton(texts)

        def inside(part):
            return [(n, e) for n, t in enumerate(texts) for e in range(len(part), len(t) + 1) if t[e - len(part) : e] == part]

        want = []
        for end in range(1, len(query) + 1):
            size = max(n for n in range(end + 1) if n == 0 or inside(query[end - n : end]))
            grows = end < len(query) and size and inside(query[end - size : end + 1])
            if size >= 2 and not grows:
                want.append((end, size, sorted(inside(query[end - size : end]))))
        got = [(e, n, sorted(automaton.ends[s])) for e, n, s in automaton.matches(query, 2)]
        assert got == want


def test_empty_licence_table(docs):
    assert licences.licences(docs([])).count() == 0


def test_chain_outlives_many_wrong_matches():
    wrong = [(11, 14, 100 * k, 100 * k + 3) for k in range(1, 20)]
    made = licences.chains(sorted([(0, 10, 0, 10), *wrong, (11, 20, 11, 20), (21, 30, 21, 30)]))
    assert (0, 30, 28) in made and len(made) == 20


@pytest.mark.parametrize("text, labels", [
    ("Licensed under CC BY-SA 3.0", "cc-by-sa"), ("Licensed under CC BY 3.0.", "cc-by"),
    ("Creative Commons Attribution-ShareAlike 3.0", "cc-by-sa"), ("CC BY-NC-SA 4.0", "cc-by-nc-sa"),
    ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa"),
    ("https://creativecommons.org/licenses/by-nd/2.0/", "cc-by-nd"), ("CC0 1.0 Universal", "cc0"),
    ("subject to the Mozilla Public License, Version 1.1", "mpl"), ("nothing of this kind", ""),
])
def test_versions_and_variants(docs, text, labels):
    row = licence_rows(docs, [(1, f"See here: {text} and so on")])[1]
    assert (row.labels, row.base_labels) == (labels, "")


def test_every_template_gives_its_label_alone():
    scanner = licences.Scanner(licences.TEMPLATES, licences.BASE)
    assert {"boost", "cc0", "epl", "lgpl", "unlicense", "zlib"} <= set(licences.TEMPLATES)
    for label, texts in licences.TEMPLATES.items():
        for text in texts:
            spans = licences.labelled(scanner.scan(alnum_words(f"before {text} after"))[1])
            assert {s[2] for s in spans} == {label}, text[:80]


def test_parts_of_texts_give_labels(docs):
    parts = []
    for label in ("apache", "mit", "mpl", "isc", "zlib", "unlicense"):
        words = max(licences.TEMPLATES[label], key=len).split()
        some = words[len(words) // 3 :][:60]
        parts.append((label, " ".join(some[:25] + ["edited"] + some[26:])))
    rows = licence_rows(docs, [(k, text) for k, (_, text) in enumerate(parts)])
    for k, (label, text) in enumerate(parts):
        assert label in rows[k].labels.split(","), text


HEADERS = [
    ("lgpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU Lesser General Public License as published by the Free Software Foundation; either "
     "version 2.1 of the License, or (at your option) any later version. This library is distributed "
     "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
     "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public "
     "License for more details."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Affero General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version. This program is distributed in "
     "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License "
     "for more details."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 "
     "of the License, or (at your option) any later version."),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation; either version 2 "
     "of the License, or (at your option) any later version."),
    ("apache", "Licensed under the Apache Software License 2.0"), ("apache", "Apache-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
     "file except in compliance with the License."),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"), ("gpl", "GPL-2.0-only"),
    ("lgpl", "LGPL-2.1-or-later"), ("agpl", "AGPL-3.0-only"), ("gpl", "GNU GPL v3"),
    ("bsd", "Released under the 3-clause New BSD License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met:"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction"),
    ("mit", "The MIT License (MIT)"),
    *[(f"cc-{kind}", f"Licensed under CC {kind.upper()} {v}") for v in ("2.0", "3.0", "4.0")
      for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")],
    ("", "This work is licensed under a CC license"), ("", "Licensed under CC"),
]


@pytest.mark.parametrize("label, text", HEADERS)
def test_headers_give_their_label_and_no_wrong_one(label, text):
    # the words of the base phrase stand in the names of its kin
    kin = {"gpl"} if label in ("lgpl", "agpl") and "general public" in text.lower() else set()
    for around in ("{}", "# Some file of ours.\n# {}\n# It does things by itself.\nimport os"):
        made = licences.found([around.format(text)], licences.TEMPLATES, licences.BASE, True)
        labels = set(filter(None, made[5].to_pylist()[0].split(",")))
        assert labels == ({label} if label else set()) | kin
        spans = {s["label"] for s in made[7].to_pylist()[0]}
        assert spans == ({label} if label else set())
