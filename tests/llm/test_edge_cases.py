"""Ties, limits, dense groups, awkward rows and whole queries against the contracts' words."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_text_operators import AWKWARD, UPPER, WORD, groups, shingles
from test_whole_jobs import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tessella.llm import bpe, common, decontaminate, language_model, license, line_dedup, near_dup, pii, quality, registry, token_file, url_filter

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_word_table_begins_anew(monkeypatch):
    want = library(token_file.VOCABULARY)
    for many, size in ((10, 1 << 30), (10**6, 900)):
        monkeypatch.setattr(token_file, "REMEMBERED", many)
        monkeypatch.setattr(token_file, "REMEMBERED_BYTES", size)
        machine = token_file.Encoder(public_tokenizers.path(token_file.VOCABULARY))
        for texts in (["a b c d"], ["a e f g h i j k l"], ["a", "", "zz a b q r s t u v w x y z", "b"], ["a b c d"]):
            ids, number = machine.encode(texts)
            each = [want.encode(t, add_special_tokens=False).ids for t in texts]
            assert ids.tolist() == [i for x in each for i in x] and number.tolist() == [len(x) for x in each]


def test_token_file_of_awkward_rows(spark, tmp_path):
    rows = [(i, t) for i, t in AWKWARD] + [(10, "long " * 40_000), (11, "y" * 300_000)]
    df = spark.createDataFrame([(t, 1, i) for i, t in rows], "text string, lengths int, doc_id long").repartition(3)
    token_file.write(df, f"file://{tmp_path}/a")
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_file.read(spark, f"file://{tmp_path}/a").collect()), key=lambda r: r[1])
    machine, start, want = library(token_file.VOCABULARY), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*machine.encode(t or "", add_special_tokens=False).ids, token_file.END_ID], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def test_long_runs_of_digits():
    began = time.perf_counter()
    assert pii.base_spans("1" * 1_000_000) == [] and pii.base_spans("1." * 500_000)[0] == (0, 1, 7)
    assert time.perf_counter() - began < 20


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for place, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text):
            d = [int(c) for c in re.sub(r"\D", "", m[0])][::-1]
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and sum(c if k % 2 == 0 else c // 5 + 2 * c % 10 for k, c in enumerate(d)) % 10 == 0,
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((m.start(), place, kind, m.end()))
    return sorted(out)


def test_pii_query(spark):
    texts = documents(spark)
    got = {r.doc_id: r for r in registry.QUERIES["op3_pii"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        spans, r = base_spans(t), got[i]
        n = Counter(kind for _, _, kind, _ in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in PATTERNS)
        joined = [f"{kind}:{s}:{e}" for s, _, kind, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        every = [x for x in r.spans.split(",") if x]
        assert [x for x in every if not x.startswith("secret")] == joined and len(every) == len(joined) + r.n_secret == r.n_spans
        assert all(t[int(x.split(":")[1]) : int(x.split(":")[2])].strip() for x in every)


def test_field_finds_secrets_it_never_saw(spark):
    """Forms that the training table does not make, and clean texts."""
    r = random.Random(11)
    rows, want = [], {}
    for i in range(200):
        words = [r.choice(("lorem", "ipsum", "dolor", "sit", "Amet,", "12", "3.", "über")) for _ in range(30)]
        if i % 2:
            value = "".join(r.choice("0123456789abcdefABCDEF") for _ in range(r.randint(18, 40)))
            words[15:15] = r.choice(([f"token={value}"], ["password:", value], ["secret", "=", f"'{value}'"], [f"api_key={value};"]))
            want[i] = value
        rows.append((i, " ".join(words)))
    got = {x.doc_id: x for x in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = {i for i, x in got.items() if x.n_secret}
    found = {i for i in hit & set(want) for s in got[i].spans.split(",") if s.startswith("secret") and want[i] in rows[i][1][int(s.split(":")[1]) : int(s.split(":")[2])]}
    assert len(found) >= 0.9 * len(want) and len(hit - set(want)) <= 2


def test_bpe_query(spark):
    texts, want = documents(spark), library(bpe.VOCABULARY)
    for r in registry.QUERIES["op6_bpe"](spark, SF).collect():
        ids = want.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(want.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_url_ties_and_awkward_rows(spark):
    rules = (("block", "a.org", "/x/"), ("allow", "org", "/x/yy"), ("allow", "a.org", "/x/"), ("block", "org", "/"))
    urls = [None, "", "no scheme", "http://A.org/x/yy", "http://b.a.org/x/q?z=1", "http://a.org/", "http://net", "x://é/casino/1", "http://a.org/x/y", "http://a.org/x/y"]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, host_rules=rules).collect()}
    assert got == {
        0: ("", "", None, "allow"),
        1: ("", "", None, "allow"),
        2: ("", "", None, "allow"),
        3: ("a.org", "/x/yy", "a.org/x/", "block"),  # org/x/yy is as long, and listed later
        4: ("b.a.org", "/x/q", "a.org/x/", "block"),
        5: ("a.org", "/", "org/", "block"),
        6: ("net", "", None, "allow"),
        7: ("é", "/casino/1", None, "block"),
        8: ("a.org", "/x/y", "a.org/x/", "block"),
        9: ("a.org", "/x/y", "a.org/x/", "block"),
    }
    assert url_filter.judge(df.where("false")).count() == 0


def test_more_licences(spark):
    notices = {
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "This Source Code Form is subject to the terms of the Mozilla\n * Public License, v. 2.0. If a copy of the MPL was not distributed": "MPL-2.0",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES": "ISC",
        "Redistribution and use in source and binary forms, with or without modification, are permitted:\n1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above copyright notice.": "BSD-2-Clause",
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software": "Unlicense",
        "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License": "AGPL-3.0-notice",
        "licensed under CC BY-SA 4.0; some licensed under CC BY 4.0": "CC-BY-SA-4.0,CC-BY-4.0",
        "a boost of the public": "",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(notices)], "doc_id long, text string")
    assert [r.licenses for r in license.recognise(df).orderBy("doc_id").collect()] == list(notices.values())


def test_own_licence_tables(spark):
    own = dict(sentences=(("Don't sell; it's ours", "Q1"), ("say 'please'", "Q2")), rules=(("O'Brien", " Q1 Q2 "), ("O'Brien-short", " Q1 ")), implied=(("O'Brien", "O'Brien-short"),))
    df = spark.createDataFrame([(1, "Don't sell: it's ours. Say 'please'."), (2, "don't sell it's ours"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in license.recognise(df, **own).collect()}
    assert got == {1: ("Q1 Q2", "O'Brien"), 2: ("Q1", "O'Brien-short"), 3: ("", ""), 4: ("", "")}
    assert license.recognise(df.where("false")).count() == 0


def test_repeated_words_by_their_words(spark):
    r, rows = random.Random(2), []
    for i in range(40):
        w = [r.choice(("a", "b", "c", "dd", f"x{r.randrange(30)}")) for _ in range(r.randint(0, 300))]
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.n_repeat_words for x in quality.features(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        w = t.split()
        where = defaultdict(list)
        for k in range(len(w) - 2):
            where[tuple(w[k : k + 3])].append(k)
        assert got[i] == len({p for ks in where.values() if len(ks) > 1 for k in ks for p in (k, k + 1, k + 2)})


def test_large_counts_and_few_maps(spark, tmp_path, monkeypatch):
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << 60, 500, dtype=np.uint64))
    counts = r.integers(1, 9, len(keys)).astype(np.uint64)
    counts[[0, 7, len(keys) - 1]] = [(1 << 32) - 1, 1 << 32, 1 << 50]
    monkeypatch.setattr(language_model, "HELD_MAPS", 2)
    for k in range(5):
        language_model._save(f"{tmp_path}/pairs", str(k), language_model.pair_arrays(keys[k::5], counts[k::5]))
    maps = language_model._Maps(str(tmp_path))
    for k in (0, 1, 2, 3, 4, 0, 5):
        got = language_model.Pairs(maps.get(f"pairs/{k}"))
        assert got.count(keys).tolist() == [int(c) if i % 5 == k else 0 for i, c in enumerate(counts)] and len(maps.held) <= 2
    with pytest.raises(ValueError, match="different words"):
        monkeypatch.setattr(language_model, "MOST_WORDS", 2)
        language_model.fit(spark.createDataFrame([("a b c d",)], "text string"))


def test_scores_of_awkward_rows(spark):
    df = spark.createDataFrame([(t, i, True) for i, t in AWKWARD], "text string, doc_id long, held_out boolean")
    end = object()
    seqs = [[*WORD.findall((t or "").translate(UPPER)), end] for _, t in AWKWARD]
    counts = Counter(w for s in seqs for w in s)
    total, size = sum(counts.values()), len(counts)
    want = sorted((str(i), len(s), total, round(sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in s), 6)) for (i, _), s in zip(AWKWARD, seqs, strict=True))
    got = sorted((str(r.doc_id), r.n_tokens, r.train_tokens, round(r.base_score, 6)) for r in language_model.score(df, language_model.fit(df)).collect())
    assert got == want
    scored = language_model.score(df.where("false"), language_model.fit(df))
    assert scored.collect() == []
    assert all(math.isfinite(r.score) and r.score < 0 for r in language_model.score(df, language_model.fit(df)).collect())


def test_components_in_one_task_and_in_rounds(spark, tmp_path, monkeypatch):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1400)] + [(None, 1), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = groups({x for p in real for x in p}, real)
    for most in (1 << 18, 0):
        monkeypatch.setattr(common, "ONE_TASK_LINKS", most)
        assert {x.id: x.root for x in common.components(df, f"file://{tmp_path}/{most}").collect()} == want
        assert common.components(df.where("a = 7"), f"file://{tmp_path}/none{most}").count() == 0


def near_lines(lines):
    """All pairs of lines within two edits."""
    by_size = defaultdict(list)
    for x in lines:
        by_size[len(x)].append(x)
    pairs = [(x, y) for n, xs in by_size.items() for m in (n, n + 1, n + 2) for x in xs for y in by_size.get(m, ()) if n < m or x < y]
    point = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    close = np.concatenate([line_dedup.edit_distances([point(x) for x, _ in pairs[k : k + 20_000]], [point(y) for _, y in pairs[k : k + 20_000]], 2) <= 2 for k in range(0, len(pairs), 20_000)]) if pairs else []
    return [p for p, c in zip(pairs, close, strict=True) if c]


def test_lines_of_one_key(spark):
    """700 lines that share a segment, most of them near each other, and 300 that share it and are not."""
    r = random.Random(9)
    base = "all of these lines begin with the same words and then"
    lines = {base + "".join(r.choice("abcdefgh") for _ in range(3)) + " end so" for _ in range(600)}
    lines |= {base + "".join(r.choice("ijkl") for _ in range(3)) + " end s" for _ in range(300)}
    lines |= {base + "".join(chr(r.randrange(0x100, 0x180)) for _ in range(10)) for _ in range(300)}
    lines = sorted(lines)
    rows = [(i, "\n".join(lines[i::7])) for i in range(7)] + [(7, lines[0]), (None, lines[1])]
    df = spark.createDataFrame([(t, i, 3, 4) for i, t in rows], "text string, doc_id long, lid int, line int")
    linked = near_lines(lines)
    cls, degree = groups(lines, linked), Counter(x for p in linked for x in p)
    first = {}
    for i, k, x in sorted((i if i is not None else -1, k, x) for i, t in rows for k, x in enumerate(t.split("\n"))):
        first.setdefault(cls[x], (i if i >= 0 else None, k))
    assert len(linked) > 15_000
    at = {(i, k): x for i, t in rows for k, x in enumerate(t.split("\n"))}
    got = {(x.doc_id, x.line): (x.class_id, x.class_line, x.n_links) for x in line_dedup.line_classes(df).collect()}
    assert got == {p: (*first[cls[x]], degree[x]) for p, x in at.items()}
    kept = {x.doc_id: x.text for x in line_dedup.without_repeated_lines(df).collect()}
    left = {i: [x for k, x in enumerate(t.split("\n")) if first[cls[x]] == (i, k)] for i, t in rows}
    assert kept == {i: "\n".join(x) for i, x in left.items() if x}


def test_line_tables_without_lines(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("", 2, "b"), ("\n\n", 3, "c")], "text string, doc_id long, h string")
    assert line_dedup.line_classes(df, least=1).collect() == [] == line_dedup.line_classes(df.where("false"), least=1).collect()
    assert sorted(map(repr, line_dedup.without_repeated_lines(df).collect())) == sorted(map(repr, df.collect()))
    assert line_dedup.without_repeated_lines(df.where("false")).collect() == []


def pairs_of(sets, percent):
    where = defaultdict(list)
    for i, x in sets.items():
        for g in x:
            where[g].append(i)
    both = Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    return [(a, b) for (a, b), c in both.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]


def test_recall_in_large_nodes(spark, monkeypatch):
    """Pairs near the threshold in a corpus whose texts share much, with nodes that must branch to the last depth."""
    monkeypatch.setattr(near_dup, "SMALL_NODE", 3)
    r, rows = random.Random(6), {}
    common_words = [f"c{k}" for k in range(40)]
    for i in range(0, 500, 2):
        own = [f"w{i}_{k}" for k in range(30)]
        x = common_words + own
        y = list(x)
        for k in r.sample(range(42, 68), 2):
            y[k] = f"v{i}_{k}"
        rows[i], rows[i + 1] = " ".join(x), " ".join(y)
    sets = {i: shingles(t, 3) for i, t in rows.items()}
    linked = pairs_of(sets, 80)
    got = {x.doc_id: x.component_id for x in near_dup.similar_sets(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), width=3, percent=80).collect()}
    assert len(linked) > 150
    assert sum(got[a] == got[b] for a, b in linked) >= 0.99 * len(linked)
    want = groups(sets, linked)
    assert all(want[a] == want[b] for a, b in enumerate(got[i] for i in range(500)) if got[a] == b)


def test_one_row_of_each_group_stays(spark):
    t = " ".join(f"w{k}" for k in range(50))
    rows = [(1, t), (1, t), (1, t + " x"), (1, "quite another text"), (2, t + " y"), (None, t), (None, None), (3, ""), (4, "quite another text")]
    df = spark.createDataFrame([(x, i, 5) for i, x in rows], "text string, doc_id long, copy int")
    left = near_dup.without_near_duplicates(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    near = [x for x in got if x[1] and x[1].startswith("w0")]
    assert len(near) == 1 and near[0][0] == 1
    assert [x for x in got if x not in near] == sorted([(1, "quite another text"), (3, ""), (None, None)], key=repr)


def test_recall_of_fingerprints(spark):
    """Edited items in longer documents: the share that brute force finds and the radius finds too."""
    r = random.Random(8)
    items = {k: [f"w{r.randrange(10**6)}" for _ in range(r.randint(30, 90))] for k in range(40)}
    docs = {}
    for i in range(400):
        x = list(items[i % 40])
        for _ in range(r.randint(0, 3)):
            p = r.randrange(len(x))
            x[p : p + r.randint(0, 2)] = [f"v{r.randrange(10**6)}" for _ in range(r.randint(0, 2))]
        docs[i] = [f"u{r.randrange(10**6)}" for _ in range(r.randint(0, 60))] + x + [f"u{r.randrange(10**6)}" for _ in range(r.randint(0, 60))]
    table = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], f"{name} long, text string")
    want = {(i, i % 40) for i, w in docs.items() if brute(w, items[i % 40])}
    got = {(x.doc_id, x.item_id) for x in decontaminate.leaks(table(docs, "doc_id"), table(items, "item_id")).collect()}
    assert len(want) > 150 and got <= want and len(got) >= 0.99 * len(want)


def test_items_that_share_an_id(spark):
    words = lambda s: " ".join(f"{s}{k}" for k in range(30))
    items = spark.createDataFrame([(1, words("a")), (1, words("b")), (None, words("c")), (2, None), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, words("a")), (2, words("b")), (3, words("c")), (4, words("d")), (5, None)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()} == {(1, 1), (2, 1), (3, None)}
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect()) == [4, 5]
    assert decontaminate.leaks(docs.where("false"), items).collect() == [] == decontaminate.leaks(docs, items.where("false")).collect()


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.features(docs).where("kept").collect()}  # test_sql holds these verdicts against SQL
    texts = {i: t for i, t in documents(spark).items() if i in good}
    at = {(i, k): x for i, t in texts.items() for k, x in enumerate(t.split("\n")) if x}
    lines = sorted(set(at.values()))
    cls = groups(lines, [p for p in near_lines([x for x in lines if len(x) >= 10])])
    first = {}
    for p in sorted(at):
        first.setdefault(cls[at[p]], p)
    texts = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if len(x) < line_dedup.MIN_CHARS or first[cls[x]] == (i, k)) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if WORD.search(t)}
    sets = {i: shingles(t, 5) for i, t in texts.items()}
    leader = groups(sets, pairs_of(sets, 80))
    texts = {i: t for i, t in texts.items() if leader[i] == i}
    items = [WORD.findall((r.text or "").translate(UPPER)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in items]

    def leaks(t):
        w = WORD.findall(t.lower())
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return any(g & own and brute(w, x) for x, g in zip(items, grams, strict=True))

    texts = {i: t for i, t in texts.items() if not leaks(t)}
    encode, want = library(bpe.VOCABULARY), {}
    for i, t in texts.items():
        ids = encode.encode(t, add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()} == want


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_awkward_rows(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in [*AWKWARD, (20, " ".join("abcdefghij"[k // 10] + "klmnopqrst"[k % 10] + "ova" for k in range(90)))]], "doc_id long, text string, lang string, source string, n_chars int")
    rows = rows.select(*(rows[f.name].cast(f.dataType) for f in docs.schema.fields))
    got = stage(spark, rows, SF).collect()
    assert 20 in {r.doc_id for r in got} and len(got) <= rows.count()
    assert stage(spark, rows.where("false"), SF).collect() == []
