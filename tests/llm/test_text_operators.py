"""The text operators against brute force, the public libraries and DuckDB, on small tables with awkward rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessella.llm import bpe, decontaminate, language_model, license, line_dedup, near_dup, pii, quality, registry, token_file, url_filter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Null, empty, blank, short, repeated and odd rows; n_words, kept and text2 clash with names the operators use.
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "é ß 漢字 😀 İ"), (6, "a b c d e f " * 30), (6, "a b c d e f " * 30), (7, "x" * 5000), (None, "no id here"), (8, "password=5ad0749aeeb4fff3e7 mail a.b@c.example.org 10.0.0.256 1.2.3.4 +1 (829) 555-9504"), (9, "<|endoftext|> Licensed under CC BY-NC 4.0.")]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, 1, True, "z") for i, t in AWKWARD], "doc_id long, text string, n_words int, kept boolean, id string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    got = registry.QUERIES[name](spark, SF)
    want = c.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("run", [quality.features, license.recognise, pii.find, bpe.round_trip, near_dup.similar_sets])
def test_awkward_rows_and_empty_tables(spark, awkward, run):
    got = run(awkward)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(i) for i, _ in AWKWARD)
    assert run(awkward.where("false")).collect() == []


def test_quality_repeats_and_pipeline_filter(awkward):
    r = {x.doc_id: x for x in quality.features(awkward).collect()}
    assert (r[6].n_words, r[6].n_repeat_words, r[6].base_failed, r[6].kept) == (180, 180, True, False)
    assert (r[1].n_words, r[1].base_failed) == (0, True)
    assert quality.keep_good(awkward).columns == awkward.columns


def test_pii(spark, awkward, texts):
    r = {x.doc_id: x for x in pii.find(awkward).collect()}
    assert (r[8].n_email, r[8].n_ip, r[8].n_phone, r[8].n_secret) == (1, 1, 1, 1)
    naive = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    odd = ["a@b@c.d e@f.g.h", "1.2.3.4.5.6.7.8 0300.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112", "+49 (30) 12345-678 ++1 2 3", "@.@x.y"]
    for t in [*texts.values(), *odd]:
        want = []
        for kind, p in naive.items():
            for m in re.finditer(p, t):
                d = re.sub(r"\D", "", m[0])
                luhn = lambda d: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
                if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                    want.append((m.start(), pii.KINDS.index(kind), m.end()))
        assert pii.base_spans(t) == sorted(want)


def test_field_held_out_and_viterbi():
    field = pii.default_field()
    right = total = 0
    for text, y in pii.labelled_table(150, seed=99):
        buf = np.frombuffer(text.encode(), np.uint8)
        codes = pii.shapes(buf, *pii.token_bounds(buf, np.array([0, len(buf)])))
        row = np.zeros(len(codes), int)
        got = field.decode(codes, row)
        s = field.emissions(codes, row)
        best, back = s[0], []
        for k in range(1, len(s)):
            p = best[:, None] + field.moves
            back.append(p.argmax(axis=0))
            best = p.max(axis=0) + s[k]
        path = [int(best.argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert path[::-1] == got.tolist()
        right, total = right + int((got == np.array(y)).sum()), total + len(y)
    assert right / total > 0.98


def test_bpe_is_the_library(texts):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    machine, r = bpe.automaton(), random.Random(3)
    some = ["".join(r.choice("aab  eth\n\t 1é'sßñ<|>\x1c\x85\xa0漢😀İ—.,!$") for _ in range(r.randint(0, 30))) for _ in range(3000)]
    for t in [*texts.values(), *some, *("a" * n for n in range(40)), "<|endoftext|>x<|endoftext|>", *(t or "" for _, t in AWKWARD)]:
        ids = library.encode(t, add_special_tokens=False).ids
        n, joined, labels = machine.digest(t)
        assert machine.encode(t) == ids and joined == ",".join(map(str, ids)) and n == len(ids)
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False) == labels.decode()


def test_token_file(spark, awkward, texts, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path(token_file.VOCABULARY))
    got = {r.doc_id: r for r in registry.QUERIES["op8_token_file"](spark, SF).collect()}
    start = 0
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    token_file.write(awkward, f"file://{tmp_path}/a")
    assert token_file.read(spark, f"file://{tmp_path}/a").count() == len(AWKWARD)
    token_file.write(awkward.where("false"), f"file://{tmp_path}/b")
    assert token_file.read(spark, f"file://{tmp_path}/b").count() == 0
    x = np.random.default_rng(0).integers(0, 2**32, 1000, dtype=np.uint32)
    assert (token_file.Blocks(token_file.pack(x)).read() == x).all() and (token_file.Blocks(token_file.pack(x)).read(2, 3) == x[256:384]).all()


def test_globs():
    globs, r = ("*ab*", "a?c", "x*y*z", "*.q", "", "long" * 30 + "*"), random.Random(1)
    words = ["".join(r.choice("abcxyzq.") for _ in range(r.randint(0, 8))) for _ in range(500)] + ["long" * 31]
    want = [any(re.fullmatch(re.escape(g).replace(r"\*", ".*").replace(r"\?", "."), w) for g in globs) for w in words]
    assert url_filter.GlobMachine(globs).matches([w.encode() for w in words]).tolist() == want


def test_language_model(spark, awkward):
    train = ["a b a b c", "a b", "c c a", "b", "", "a c b a b"] * 3 + ["d a e"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string").repartition(3)
    model = language_model.fit(df)
    end = object()
    seqs = [[*t.split(), end] for t in train]
    uni, big = Counter(w for s in seqs for w in s), Counter(p for s in seqs for p in zip([end, *s], s, strict=False))
    before, total = Counter(w for _, w in big), sum(uni.values())
    d, e = (language_model.discounts_of([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]) for c in (big, before))
    size, types = len(uni), len(big)
    cut = lambda c, d: d[min(c, 3) - 1] if c else 0
    left = sum(cut(c, e) for c in before.values()) / types
    lower = lambda w: (before[w] - cut(before[w], e)) / types + left / (size + 1)
    history = Counter()
    for (h, _), c in big.items():
        history[h] += c
    kept = {h: sum(cut(c, d) for (g, _), c in big.items() if g == h) / history[h] for h in history}
    p = lambda h, w: (big[h, w] - cut(big[h, w], d)) / history[h] + kept[h] * lower(w) if h in history else lower(w)
    test = [(1, "a b c"), (2, "zz a"), (3, None), (4, "A  b\n")]
    for r in language_model.score(spark.createDataFrame(test, "doc_id long, text string"), model).collect():
        s = [*(dict(test)[r.doc_id] or "").lower().split(), end]
        assert r.score == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip([end, *s], s, strict=False)))
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 1) / (total + size + 1)) for w in s))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(s), sum(uni[w] > 0 for w in s), total)
    assert sum(p("a", w) for w in uni) + kept["a"] * left / (size + 1) == pytest.approx(1)
    assert language_model.score(awkward, language_model.fit(awkward.where("false"))).count() == len(AWKWARD)


def shingles(text, k):
    w = WORD.findall(text.translate(UPPER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, documents, texts, width, percent):
    r, base = random.Random(5), [f"w{k}" for k in range(60)]
    more = dict(texts)
    for i in range(60):  # a dense group around the threshold
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(60)] = f"v{r.randrange(9)}"
        more[10_000 + i] = " ".join(w)
    df = spark.createDataFrame(list(more.items()), "doc_id long, text string").repartition(4)
    s = {i: shingles(t, width) for i, t in more.items()}
    where = defaultdict(list)
    for i, x in s.items():
        for g in x:
            where[g].append(i)
    both = Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    want = groups(s, [(a, b) for (a, b), c in both.items() if 100 * c >= percent * (len(s[a]) + len(s[b]) - c)])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.similar_sets(df, width=width, percent=percent).collect()}
    assert got == {i: (len(s[i]), want[i], want[i] == i) for i in s}


def edits(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def test_line_classes(spark):
    r, rows = random.Random(0), []
    for i in range(60):
        lines = []
        for _ in range(3):
            t = list(f"the quick brown fox jumps over the dog number {r.randrange(12)}" + " é" * r.randrange(3))
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = r.choice("xyz")
            lines.append("".join(t))
        rows.append((i, "\n".join([*lines, "", "short"])))
    rows += [(None, None), (400, ""), (401, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    at = {(i, k): x for i, t in rows for k, x in enumerate((t or "").split("\n")) if len(x) >= line_dedup.MIN_CHARS}
    lines = sorted(set(at.values()))
    linked = [(a, b) for k, b in enumerate(lines) for a in lines[:k] if abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2]
    cls, degree, first = groups(lines, linked), Counter(x for p in linked for x in p), {}
    for k in sorted(at):
        first.setdefault(cls[at[k]], k)
    got = {(r.doc_id, r.line): (r.class_id, r.class_line, r.n_links, r.kept) for r in line_dedup.line_classes(df).collect()}
    assert got == {k: (*first[cls[x]], degree[x], first[cls[x]] == k) for k, x in at.items()}
    left = line_dedup.without_repeated_lines(df)
    assert left.columns == df.columns and [r.text for r in left.where("doc_id = 401").collect()] == ["\nshort"] and left.where("doc_id = 400").count() == 1


def test_edit_distances():
    r, xs, ys = random.Random(1), [], []
    for _ in range(400):
        x = [r.choice("abc") for _ in range(r.randint(0, 40))]
        y = list(x)
        for _ in range(r.randint(0, 5)):
            y[r.randint(0, len(y)) : r.randint(0, len(y))] = r.choice(("", "a", "b"))
        xs.append("".join(x))
        ys.append("".join(y))
    points = lambda ts: [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in ts]
    for most in (0, 1, 2, 5):
        assert line_dedup.edit_distances(points(xs), points(ys), most).tolist() == [min(edits(x, y), most + 1) for x, y in zip(xs, ys, strict=True)]


def test_decontaminate(spark, documents, texts, awkward):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in registry.QUERIES["op5_decontaminate"](spark, SF).collect()}
    want = set()
    for i, t in texts.items():
        w = t.lower().split()
        for k, item in items.items():
            x = item.lower().split()
            a = Counter(zip(*(x[j:] for j in range(5)), strict=False))
            if not any(g in a for g in zip(*(w[j:] for j in range(5)), strict=False)):
                continue
            for o in range(max(1, len(w) - len(x) + 1)):
                b = Counter(zip(*(w[o : o + len(x)][j:] for j in range(5)), strict=False))
                if 100 * (a & b).total() >= 80 * (a | b).total():
                    want.add((i, k))
    assert got == want
    assert decontaminate.without_leaks(awkward, spark.createDataFrame([(1, None), (2, "one"), (3, "")], "item_id long, text string")).where("doc_id = 4").count() == 0
    assert decontaminate.leaks(documents, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
    final = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id: r for r in final.collect()}
    assert 0 < len(kept) < len(texts) and set(kept) <= set(texts) and all(r.intact for r in kept.values())
    assert hashlib.sha256(b"").hexdigest() not in {r.decoded_sha256 for r in kept.values()}
