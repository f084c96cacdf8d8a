"""Cases that text operators once left out."""

import random
from collections import Counter

import pytest

from tessella.llm import decontaminate, license, line_dedup, near_dup, registry

MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.'
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products."
APACHE = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0'
GPL = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation."
NOTICES = [
    ("Words.\nLicensed under the Apache License, Version 2.0.\nWords", "A1", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "G1", "GPL-3.0"),
    (MIT, "M2 M3", "MIT-text"),
    (BSD, "B1 B2", "BSD-3-Clause"),
    (APACHE, "A1 A2 A3", "Apache-2.0-header"),
    (GPL, "G2 G3", "GPL-3.0-notice"),
    ("All rights reserved, all rights reserved. All\n\nrights reserved", "R1 R1", "proprietary"),
    ("Overall rights reserved; licensed under the Apache License, version 2.01", "", ""),
]


def test_licence_notices(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r.doc_id: (r.n_sentences, r.sentence_ids, r.licenses) for r in license.recognise(docs).collect()}
    assert got == {i: (len(k.split()), k, n) for i, (_, k, n) in enumerate(NOTICES)}


def brute(w, x, percent=80):
    """The similarity and first word of the best window of w for the item x, if it is similar enough."""
    k = min(5, len(x))
    bags = lambda t: Counter(zip(*(t[j:] for j in range(k)), strict=False))
    a, best = bags(x), None
    for o in range(max(1, len(w) - len(x) + 1)):
        b = bags(w[o : o + len(x)])
        c, n = (a & b).total(), (a | b).total()
        if 100 * c >= percent * n and (best is None or c / n > best[0]):
            best = (c / n, o)
    return best


def test_reordered_leaks(spark):
    r = random.Random(3)
    new = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    items = {1: new(50), 2: new(60), 3: "one two three four five one two three four five six".split(), 4: new(3), 5: new(45)}
    docs = {
        1: new(70) + items[1][25:] + items[1][:25] + new(70),
        2: new(9) + items[2][40:] + items[2][:20] + items[2][20:40] + new(30),
        3: new(4) + items[3] * 3,
        4: items[4] + new(2),
        5: items[5][:42],
        6: items[5][:20] + items[1][:30],
        7: new(30) + items[5][15:30] + items[5][:15] + items[5][30:],
        8: items[2][:30] + new(3) + items[2][30:],
    }
    table = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], f"{name} long, text string")
    for percent in (80, 50):
        want = {(d, k): b for d, w in docs.items() for k, x in items.items() if (b := brute(w, x, percent))}
        got = {(x.doc_id, x.item_id): (x.similarity, x.first_word) for x in decontaminate.leaks(table(docs, "doc_id"), table(items, "item_id"), percent=percent, radius=64).collect()}
        assert got == want
    plain = {(x.doc_id, x.item_id) for x in decontaminate.leaks(table(docs, "doc_id"), table(items, "item_id")).collect()}
    assert {(1, 1), (2, 2)} <= plain


def test_short_lines(spark, tmp_path):
    rows = [(1, "Ja.\n\nAll rights reserved.\nab"), (2, "Ja.\nAll rights reserve.\nNe."), (3, "Ja.\nac\nAll rights reserved.\n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line): (r.class_id, r.class_line, r.n_links, r.kept) for r in registry.QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()}
    want = {(1, 0): (1, 0, 0, True), (1, 2): (1, 2, 1, True), (1, 3): (1, 3, 0, True), (2, 0): (1, 0, 0, False), (2, 1): (1, 2, 1, False), (2, 2): (2, 2, 0, True), (3, 0): (1, 0, 0, False), (3, 1): (3, 1, 0, True), (3, 2): (1, 2, 1, False), (3, 3): (3, 3, 0, True)}
    assert got == want
    texts = lambda n: {r.doc_id: r.text for r in line_dedup.without_repeated_lines(df, min_chars=n).collect()}
    assert texts(24) == dict(rows)
    assert texts(4) == {1: rows[0][1], 2: "Ja.\nNe.", 3: "Ja.\nac\n "}


def test_null_ids(spark):
    words = [f"w{k}" for k in range(40)]
    line = " ".join(words)
    a, b, c = (" ".join([*words, *more]) for more in (["x"], ["y"], []))
    table = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    # Documents 1 and 2 are only linked by way of the null row's text.
    base = [f"v{k}" for k in range(100)]
    near = [(1, " ".join(base)), (None, " ".join(base[9:] + [f"e{k}" for k in range(9)])), (2, " ".join(base[18:] + [f"e{k}" for k in range(18)])), (None, "quite another text of some words")]
    got = {r.doc_id: r.component_id for r in near_dup.similar_sets(table(near), percent=80).where("doc_id IS NOT NULL").collect()}
    assert got == {1: 1, 2: 1}
    # The first holder of a line is a row with a null id.
    got = {(r.doc_id, r.kept): r.n_links for r in line_dedup.line_classes(table([(None, a), (1, a), (2, b)])).collect()}
    assert got == {(None, True): 1, (1, False): 1, (2, False): 1}
    items = spark.createDataFrame([(7, c)], "item_id long, text string")
    docs = table([(None, f"lead in {line} lead out"), (None, "a clean text"), (3, "a clean text"), (3, line)])
    assert {(r.doc_id, r.item_id, r.first_word) for r in decontaminate.leaks(docs, items).collect()} == {(None, 7, 2), (3, 7, 0)}
    assert sorted(map(repr, map(tuple, decontaminate.without_leaks(docs, items).collect()))) == ["(3, 'a clean text')", "(None, 'a clean text')"]


def test_driver_forgets_queries_that_are_done(spark, monkeypatch):
    import weakref

    from tessella.llm import common, near_dup

    class Stop(Exception):
        pass

    def stop(session):
        raise Stop

    df = spark.range(3)
    df.me = df
    seen = weakref.ref(df)
    del df
    common.forget(spark)
    assert seen() is None
    monkeypatch.setattr(near_dup, "forget", stop)  # after the first round of trees already
    with pytest.raises(Stop):
        near_dup.similar_sets(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string"))


def test_pipeline_relieves_the_executors(spark, monkeypatch):
    import corpus_pipeline
    from tessella.llm import common

    collected = lambda: sum(b.getCollectionCount() for b in spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans() if "Old" in b.getName())
    before = collected()
    common.relieve(spark)  # here the executor is the driver's JVM
    assert collected() > before
    seen = []
    monkeypatch.setattr(corpus_pipeline, "relieve", lambda s: seen.append("stage"))
    monkeypatch.setattr(common, "relieve", lambda s: seen.append("write"))
    monkeypatch.setattr(corpus_pipeline, "RELIEF_SECONDS", 0)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g")], "doc_id long, text string")
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name != "decontaminate":  # needs a benchmark beside the documents
                seen.clear()
                stage(spark, docs, "")
                assert seen[0] == seen[-1] == "stage" and len(seen) >= 2
                assert ("write" in seen) == (name in ("line_dedup", "near_dedup"))
    finally:
        spark.conf.unset(common.RELIEF_KEY)
    common.stored(docs, f"{common.shared_dir(spark)}/alone")
    assert seen[-1] == "stage"  # lone queries are left as they were
