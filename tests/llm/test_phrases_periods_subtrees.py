"""Phrases, periodic runs and repeated windows against brute-force versions, and on edge cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lagloom.llm import periods, phrases, queries, subtrees
from lagloom.llm.words import rolled
from test_operators import COLUMNS, EDGE, SF

CLASH = ["ord", "tid", "check", "live", "marks", "runs", "kept", "key", "phrase", "a", "n", "rank", "score", "_w", "_g", "_a", "_p", "first", "_hash"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, COLUMNS).select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


# 11 -----------------------------------------------------------------------------------------------------------------
def plain_phrases(rows, top=2000, support=30, cover=80):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    counts[lang][tuple(w[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        longer = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        ranked = []
        for p, a in found.items():
            if 100 * longer[p] < cover * a:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def collocations(df, **more):
    return sorted(tuple(r) for r in phrases.collocations(df, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases(docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert collocations(docs) == plain_phrases(rows)
    assert collocations(docs, support=5, top=40) == plain_phrases(rows, support=5, top=40)


def test_phrases_with_ties_and_separators(spark):
    rng = random.Random(3)
    parts = ["a", "B", "c", "d.", "e\tf", "É", "x\n", "g\x0bh", "i\x00j", "c"]
    rows = [(i, rng.choice([None, "en", "de", ""]), " ".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    expected = plain_phrases([(lang if lang is None else lang or "", t) for _, lang, t in rows if lang != ""], support=4, top=30)
    assert collocations(df.where("lang is null or lang <> ''"), support=4, top=30) == expected


def test_border_failures_start_further_passes(spark):
    """A phrase that the sample misses wholly is found by expansion."""
    rows = [(i, "en", "rare words stand here") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    outside = df.where(F.pmod(F.xxhash64("doc_id"), F.lit(phrases.RATE)) != 0)
    n = outside.count()
    keys, failures = phrases._closed(phrases._read(outside), n, phrases.RATE, phrases.LOWERED)
    assert keys.count() == 10 and failures == [4, 6]
    assert [r[2] for r in collocations(outside, support=n)] == ["rare words stand here"]


def test_a_full_filter_only_costs_rows(spark, docs, monkeypatch):
    expected = collocations(docs)
    monkeypatch.setattr(phrases, "_filter", lambda keys: [b"\xff" * phrases.BLOCK] if keys.count() else None)
    assert collocations(docs) == expected


def test_no_task_holds_two_python_workers(docs, monkeypatch):
    """Keys of a filter come from a table: made by a Python step they would chain two of them in a task."""
    plans, plain = [], phrases._filter
    monkeypatch.setattr(phrases, "_filter", lambda keys: plans.append(keys._jdf.queryExecution().toString()) or plain(keys))
    assert collocations(docs) and len(plans) >= 3
    assert not any("InArrow" in p for p in plans)


def test_a_task_that_counts_stays_small(spark, docs, monkeypatch):
    """7 million places, more than a task holds at once, all counted in less than 100 MB besides its input."""
    words = np.array([f"w{i}" for i in range(50_000)])[np.random.default_rng(11).integers(0, 50_000, (6000, 300))]
    texts = pa.array([" ".join(w) for w in words.tolist()])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6000)), texts, pa.array(["en"] * 6000)], ["doc_id", "text", "lang"])
    scans, none = [], spark.createDataFrame([], "key long, both long")
    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "mapInArrow", lambda self, f, schema: scans.append(f) or none)
        phrases._count(docs, [[b"\xff" * phrases.BLOCK]], range(1, phrases.LONGEST + 1))
    places = 0
    tracemalloc.start()
    try:
        for out in scans[0](iter([batch])):
            places += int((out.column("both").to_numpy() >> phrases.OWNER_BITS).sum())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert places == 6000 * (300 + 299 + 298 + 297) > 2 * phrases.BUFFER
    assert peak < 100e6


def test_phrases_edge(edge, empty):
    assert collocations(empty) == [] and collocations(edge) == plain_phrases([(r[2], r[1]) for r in EDGE])


# 12 -----------------------------------------------------------------------------------------------------------------
def plain_runs(w, least=12):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            begin = k
            while k + q < n and w[k] == w[k + q]:
                k += 1
            if k + q - begin >= max(least, 2 * q) and k > begin:
                found.setdefault((begin, k + q), q)
            k += 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng, kind, k, n):
    if kind == 0:
        return [rng.randrange(k) for _ in range(n)]
    if kind == 1:
        return ([rng.randrange(k) for _ in range(rng.randrange(1, 40))] * 100)[:n]
    if kind == 2:
        w = []
        while len(w) < n:
            w += [rng.randrange(k) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 30)
        return (w + w)[: 2 * n]
    if kind == 3:
        return ([0, 1] * rng.randrange(1, 60) + [0]) * rng.randrange(1, 4)
    if kind == 4:
        root = [0, 1] * rng.randrange(1, 8) + [0]
        return (root * rng.randrange(1, 20) + [rng.randrange(3)]) * rng.randrange(1, 5)
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    w = b[:n]
    for _ in range(rng.randrange(3)):
        if w:
            w[rng.randrange(len(w))] = rng.randrange(3)
    return w


def test_runs_of_many_shapes():
    """Random, periodic, nested, Fibonacci words, and squares of highly periodic halves, several texts at once."""
    rng = random.Random(12)
    for _ in range(150):
        texts = [some_words(rng, rng.randrange(6), rng.choice([1, 2, 3, 5, 50]), rng.choice([0, 5, 30, 100, 300])) for _ in range(rng.randrange(1, 5))]
        assert periods.find_runs(texts) == [plain_runs(w) for w in texts]


def plain_planted(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    return w


def plain_run_row(doc_id, text):
    w = plain_planted(doc_id, text)
    runs = plain_runs(w)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = min(((-n, a, q) for a, n, q in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *top, *(hashlib.sha256(s.encode()).hexdigest() for s in (lines, kept)))


def run_rows(monkeypatch, df):
    monkeypatch.setattr(queries, "table", lambda *_: df)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in queries.op12_periodic_runs(df.sparkSession, "").select(*names).collect()), key=str)


def test_periodic_runs(docs, monkeypatch):
    short = docs.where("n_chars < 20000")
    assert run_rows(monkeypatch, short) == sorted((plain_run_row(r.doc_id, r.text) for r in short.collect()), key=str)


def test_periodic_runs_edge(edge, empty, monkeypatch):
    got = {r[0]: r for r in run_rows(monkeypatch, edge)}
    assert len(run_rows(monkeypatch, edge)) == len(EDGE) and run_rows(monkeypatch, empty) == []
    assert got[4][1:6] == (1, 0, 40_000, 1, 40_000_000)
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1] == (1, 0, None, None, None, None, nothing, nothing) and got[2][1:] == got[1][1:]
    for r in EDGE:
        if r[0] not in (4, 5):
            assert got[r[0]] == plain_run_row(r[0], r[1])


# 13 -----------------------------------------------------------------------------------------------------------------
def plain_windows(rows, size=50):
    last, first = 1 << 63, {}
    texts = [(last if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, last), i)
    out = []
    for (i, w), (doc_id, _) in zip(texts, rows, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated(df, **more):
    out = subtrees.without_repeats(df, **more).collect()
    for r in out:
        assert r.n_removed == sum(s.end - s.start for s in r.spans) and r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out), key=str)


@pytest.mark.parametrize("hot", [2048, 3])
def test_repeated_windows(docs, hot):
    assert repeated(docs, hot=hot) == plain_windows([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("hot", [2048, 5])
def test_repeated_windows_of_few_words(spark, hot):
    """Five words only, periodic texts, ids missing and repeated, copies cut out of other texts with changes."""
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        if rng.random() < 0.3 and rows:
            w = (rng.choice(rows)[1] or "").split(" ")
            a = rng.randrange(len(w))
            w = [rng.choice("abc") if rng.random() < 0.01 else x for x in w[a : a + rng.randrange(1, 200)]]
            text = " ".join([rng.choice("abc") for _ in range(rng.randrange(60))] + w)
        elif rng.random() < 0.1:
            text = " ".join(["x", "y"] * rng.randrange(200))
        else:
            text = " ".join(rng.choice(["a", "b", "c", "dd", "é"]) for _ in range(rng.randrange(300)))
        rows.append((rng.choice([None, rng.randrange(150), rng.randrange(150)]), text if rng.random() > 0.02 else None))
    assert repeated(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot) == plain_windows(rows)


def test_repeated_windows_edge(edge, empty):
    assert repeated(edge) == plain_windows([(r[0], r[1]) for r in EDGE])
    assert repeated(empty) == []


def test_subtrees_of_one_prefix():
    """Contexts that share a prefix, several of them the same on one side only."""
    rng = random.Random(8)
    core = [b"c%d" % i for i in range(50)]
    contexts, left = [], []
    for _ in range(120):
        behind = rng.randrange(43)
        before = [b"p%d" % i for i in range(42)][42 - behind :] if rng.random() < 0.7 else [rng.choice([b"u", b"v"]) for _ in range(behind)]
        after = core[: max(50 - behind, 8)] + [rng.choice([b"x", b"y"]) for _ in range(rng.randrange(42))]
        windows = len(before) + len(after) - 49
        contexts.append(b" ".join(before + after))
        left.append(behind)
        assert windows >= 1
    orders = np.array([rng.randrange(40) for _ in contexts])
    got = subtrees.repeated_windows(contexts, np.array(left), orders)
    words = [c.split(b" ") for c in contexts]
    first = {}
    for w, p, o in zip(words, left, orders, strict=True):
        for k in range(max(0, 0), min(p, len(w) - 50) + 1):
            key = p - k, tuple(w[k : k + 50])
            first[key] = min(first.get(key, o), o)
    for i, (w, p, o) in enumerate(zip(words, left, orders, strict=True)):
        for k in range(min(p, len(w) - 50) + 1):
            if p - k < 43:
                assert got[i, k] == (first[p - k, tuple(w[k : k + 50])] < o)


def test_rolled_hashes_tell_equal_stretches():
    h = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], dtype=np.uint64)
    for size in range(1, 10):
        r = rolled(h, size)
        assert len(r) == len(h) - size + 1
        for i in range(len(r)):
            for j in range(len(r)):
                assert (r[i] == r[j]) == np.array_equal(h[i : i + size], h[j : j + size])
