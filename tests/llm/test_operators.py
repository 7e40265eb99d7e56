"""Every operator against a brute-force version, on a small table and on its edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
import zstandard
from pyspark.sql import functions as F

from lagloom.llm import editprint, language, licenses, mixing, packing, pii, queries, repeats, simhash, tokens, topk

SF = "/root/testdata/sf0.001"
LONG = "word " * 40_000
EDGE = [
    (1, None, "en", "s", 0), (2, "", None, None, None), (3, "Te Xt", "en", "s", 5), (3, "Te Xt", "en", "s", 5), (4, LONG, "fr", "s", 1),
    (5, LONG, "fr", "s", 1), (None, "no id here at all", None, "s", 3), (6, "12 34 !!", "en", "s", 8), (7, "\x00\t\n\x85 é 😀", "en", None, 8),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


@pytest.fixture(scope="module")
def edge(spark):
    clash = ["fp", "part", "key", "_key", "_spans", "score", "rejected", "rank", "_tokens", "_posterior", "_row", "_copies", "dup", "places"]
    df = spark.createDataFrame(EDGE, COLUMNS)
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clash)))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


# 1 ------------------------------------------------------------------------------------------------------------------
def plain_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """prints: (id, fingerprint); smallest id reachable over links of three bits."""
    low = {i: i for i, _ in prints}
    while True:
        new = {i: min(low[j] for j, q in prints if (p ^ q).bit_count() <= 3) for i, p in prints}
        if new == low:
            return low
        low = new


def test_simhash_groups(docs, rows):
    prints = [(i, plain_simhash(t)) for i, t in rows]
    expected = {i: (f"{p:016x}", c) for (i, p), c in zip(prints, plain_groups(prints).values(), strict=True)}
    assert by_id(simhash.near_groups(docs), "fingerprint", "component_id") == expected


def test_simhash_edge(edge, empty):
    out = simhash.near_groups(edge).collect()
    assert len(out) == len(EDGE)
    assert {r.component_id for r in out if r.doc_id in (1, 2)} == {1}
    assert {r.fingerprint for r in out if r.doc_id in (1, 2)} == {"0" * 16}
    assert simhash.near_groups(empty).count() == 0


def test_bit_sliced_distances_are_exact():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.concatenate([base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4, 5)])
    fps = np.concatenate([base, near])
    ends = np.repeat([100, len(fps)], [100, len(fps) - 100])
    found = {(int(i), int(j)) for a, b in simhash.near_words(fps, ends, pairs=37) for i, j in zip(a, b, strict=True)}
    assert found == {(i, j) for i in range(len(fps)) for j in range(i + 1, ends[i]) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}


def test_simhash_links_in_tiles(spark):
    rng = random.Random(1)
    fps = list({(7 << 60 | sum(1 << rng.randrange(30) for _ in range(4))) - (1 << 63) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    low = plain_groups([(f, f & (1 << 64) - 1) for f in fps])
    from lagloom.llm.common import components

    got = {r.node: r.root for r in components(simhash.links(df, chunk=20)).collect()}
    assert {f: got.get(f, f) for f in fps} == low


# 2 ------------------------------------------------------------------------------------------------------------------
def test_mixing_meets_its_targets(spark, docs):
    labels = mixing.label_domains(spark.read.parquet(f"{SF}/labels.parquet"))
    out = mixing.mixing_rates(docs, labels, mixing.SHARES).toPandas()
    assert len(out) == docs.count() and (out.rate >= 0).all()
    assert np.allclose(out[[c for c in out if c.startswith("p_")]].sum(axis=1), 1)
    totals = {d: (out[f"p_{d}"] * out.rate * out.n_tokens).sum() for d in mixing.SHARES}
    for d, share in mixing.SHARES.items():
        assert abs(totals[d] / sum(totals.values()) - share) < 1e-3
    assert ((out.copies - out.rate).abs() < 1).all()


def test_rates_are_least_squares(spark):
    """Against projected gradient descent in numpy, with rates that hit zero."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 60)
    n = rng.integers(1, 400, 60)
    df = spark.createDataFrame([(int(t), [float(x) for x in r]) for t, r in zip(n, p, strict=True)], "_tokens long, _posterior array<double>")
    rates = mixing.fit_rates(df, ["a", "b", "c"], {"a": 0.6, "b": 0.3, "c": 0.1})
    r = np.array([x.r for x in df.select(rates.of(F.col("_posterior"), F.col("_tokens")).alias("r")).collect()])
    assert (r >= 0).all() and np.abs((p * n[:, None]).T @ r - np.array(rates.targets)).max() < 1e-4 * sum(rates.targets)


def test_words_of_a_scarce_domain_count():
    """One document in 200 is toxic and only two words tell it, each in half of them."""
    rng = random.Random(14)
    features, domains = [], []
    for i in range(2000):
        toxic = i % 200 == 0
        features.append(sorted({*(rng.randrange(100) for _ in range(30)), *([200 + i // 200 % 2] if toxic else [])}))
        domains.append("toxic" if toxic else "plain")
    model = mixing.fit(features, domains)
    assert (model.weights[[200, 201], 1] > 0).all()
    p = model.posteriors(features)[:, model.domains.index("toxic")]
    told = np.array(domains) == "toxic"
    assert p[told].mean() > 2 * p[~told].mean()


def test_mixing_edge(spark, edge, empty):
    labels = spark.createDataFrame([(3, "x"), (4, "y"), (None, "x"), (9, None)], "doc_id long, domain string")
    out = mixing.mixing_rates(edge, labels, {"x": 0.5, "y": 0.5})
    assert out.count() == len(EDGE)
    assert mixing.mix(edge, labels, {"x": 1.0, "y": 1.0}).columns == edge.columns
    none = labels.limit(0)
    assert [r.rate for r in mixing.mixing_rates(edge, none, {"x": 1.0}).collect()] == [1.0] * len(EDGE)
    assert mixing.mix(edge, none, {"x": 1.0}).count() == len(EDGE)
    assert mixing.mixing_rates(empty, labels, {"x": 1.0}).count() == 0


# 3 ------------------------------------------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert ((out.score >= 0) & (out.score <= 1)).all() and out.rejected.mean() < 0.01


def test_language_edge(edge, empty):
    out = {(r.doc_id, r.lang_pred) for r in language.languages(edge).collect()}
    assert {(1, "und"), (2, "und"), (6, "und")} <= out
    assert {p for i, p in out if i in (3, 4, 5, 7, None)} <= {"en", "fr"}
    assert language.languages(empty).count() == 0
    assert {r.lang_pred for r in language.identify(edge, {}).collect()} == {"und"}
    assert language.with_known_language(edge, language.learn(edge)).columns == edge.columns


# 4 ------------------------------------------------------------------------------------------------------------------
def plain_repeats(rows):
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for p in range(len((text or "").encode()) - 49):
            first.setdefault((text.encode())[p : p + 50], i)
    out = []
    for i, text in rows:
        value = (text or "").encode()
        gone = np.zeros(len(value), dtype=bool)
        for p in range(len(value) - 49):
            if i is not None and first[value[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(value, dtype=np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(value), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeats_of(df):
    return sorted((tuple(r) for r in repeats.without_repeats(df).drop("kept").collect()), key=str)


def test_repeats(docs, rows):
    assert repeats_of(docs) == plain_repeats(rows)


@pytest.mark.parametrize("block", [1500, 1 << 20])
def test_repeats_of_few_letters(spark, monkeypatch, block):
    rng, rows = random.Random(5), []
    for i in range(250):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(180)))
        text = "ab" * rng.randrange(150) if i % 3 == 0 else text
        text = rng.choice(rows)[1] + text + rng.choice(rows)[1] if i % 7 == 0 and rows else text
        rows.append((i // 2 if i % 10 == 0 else i, "é" * rng.randrange(80) + text if i % 11 == 0 else text))
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "CHUNK", 64)
    assert repeats_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain_repeats(rows)


def test_repeats_edge(edge, empty):
    assert repeats_of(edge) == plain_repeats([(r[0], r[1]) for r in EDGE])
    assert repeats.without_repeats(empty).count() == 0


def shared_passage(n):
    rng = random.Random(11)
    own = lambda: "".join(rng.choice("abcdefgh ") for _ in range(40))
    passage = "".join(rng.choice("ijklmnop ") for _ in range(90))
    return [(i, own() + passage + own()) for i in range(n)]


def test_hot_anchors_go_string_by_string(spark, monkeypatch):
    """A passage in all documents has anchors at its edges whose contexts differ: no part gets one of them whole."""
    monkeypatch.setattr(repeats, "SAMPLED", 1)
    monkeypatch.setattr(repeats, "HOT", 60)
    rows = [*shared_passage(120), (7, "x" + shared_passage(3)[2][1]), (None, shared_passage(1)[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hot = repeats.hot_anchors(df)
    assert len(hot) > 0
    assert repeats_of(df) == plain_repeats(rows)
    values = [t.encode() for i, t in rows if i is not None]
    text, h, _, _ = repeats.anchors(*repeats._joined(values))
    places = [[int(k) for k in range(int((text == t).sum()))] for t in range(len(values))]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(len(values)), pa.int64()), "dup": pa.array([0] * len(values), pa.int32()),
        "text": pa.array([v.decode() for v in values]), "places": pa.array(places, pa.list_(pa.int64())),
    })
    whole, spread = {}, set()
    for out in repeats._send_contexts(16, hot)(iter([batch])):
        for r in out.to_pylist():
            if r["hash"] is not None:
                for short in np.frombuffer(zstandard.ZstdDecompressor().decompress(r["hash"]), "<u4").tolist():
                    whole[r["part"], short] = whole.get((r["part"], short), 0) + 1
            elif r["bytes"] is not None:
                spread.add(r["part"])
    assert max(whole.values()) < 60 and len(spread) == 16


def test_run_index_leads_back_through_its_texts():
    values = [b"banana bandana bandanas", b"bandanas and banana bandana", b"\x00\xff\x00" * 5]
    index = repeats.RunIndex(values, np.array([3, 1, 2]), length=8)
    assert len(index.heads) < index.rows
    got = {(int(t), int(s)): int(d) for a, b, c in index.stream() for t, s, d in zip(a, b, c, strict=True)}
    strings = {(t, p): v[p : p + 8] for t, v in enumerate(values) for p in range(len(v) - 7)}
    low = {}
    for (t, _), s in strings.items():
        low[s] = min(low.get(s, 9), [3, 1, 2][t])
    assert got == {k: low[s] for k, s in strings.items()}


# 5 ------------------------------------------------------------------------------------------------------------------
def test_licences(docs, rows):
    out = by_id(licenses.license_scan(docs), "n_words", "n_base", "first_word", "last_word", "base_labels")
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        at = [(p, label) for phrase, label in licenses.BASE.items() for p in range(len(words)) if tuple(w.encode() for w in words[p : p + len(phrase)]) == phrase]
        starts = [p for p, _ in at]
        assert out[i] == (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))


def test_templates(spark, edge, empty):
    full = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
            " files (the \"Software\"), to deal in the Software without restriction")
    texts = [
        full, full.replace("free", "for free"), full + ", including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software", "Released under the terms of the MIT License.", "Licensed under CC BY-NC 4.0.",
        "Neither the name of Acme Ltd nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission", "x mit license apache license mit license",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.license_scan(df).collect()}
    assert [out[i].labels for i in range(7)] == ["mit-text", "", "mit-text", "mit", "cc-by-nc", "bsd-3-clause", "apache,mit"]
    assert [(s.start, s.end) for s in out[2].spans] == [(0, out[2].n_words)]
    assert (out[6].n_base, out[6].first_word, out[6].last_word) == (3, 1, 5) and all(0 <= r.score <= 1 for r in out.values())
    assert licenses.license_scan(edge).where("n_words = 0 and first_word is null and labels = ''").count() == 2
    assert licenses.license_scan(empty).count() == 0


def test_automata_accept_what_a_regexp_accepts():
    template = "a [b [c] {1-2}] d {0-1} a"
    machine = licenses.compile_template("t", "a", template)
    same = re.compile(r"a( b( c)?( \w){1,2})? d( \w)? a")
    rng = random.Random(4)
    for _ in range(3000):
        words = [rng.choice("abcdx") for _ in range(rng.randrange(9))]
        lengths = [n for n in range(len(words) + 1) if same.fullmatch(" ".join(words[:n]))]
        assert machine.ends([w.encode() for w in words], 0) == (max(lengths) if lengths else None)


# 6 ------------------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_file(queries.VOCABULARY))
    return lambda text: library.encode(text, add_special_tokens=False).ids


def check_packing(out, rows, encode):
    want = []
    for i, text in rows:
        ids = np.array([*encode(text or ""), 2], dtype="<u4")
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, out[columns].astype(object).where(out[columns].notna(), None).to_numpy()), key=str) == sorted(want, key=str)
    by = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (by.length.sum() <= 1024).all()
    ordered = out.sort_values(["sequence_id", "offset"])
    assert (ordered.offset == by.length.cumsum() - ordered.length).all()


def test_packing(docs, rows, encode):
    out = packing.packed_sequences(docs, *map(queries.tokenizer_file, (queries.VOCABULARY, queries.RANKS))).toPandas()
    check_packing(out, rows, encode)
    assert out.sequence_id.nunique() <= 1.03 * -(-out.length.sum() // 1024) + 1


def test_packing_in_rounds(spark):
    rng = random.Random(6)
    items = spark.createDataFrame([(i, 0, 0, rng.randrange(1, 1025), 0) for i in range(4000)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = packing.pack(items, shard=500).toPandas()
    assert len(out) == 4000 and (out.groupby("sequence_id").length.sum() <= 1024).all()
    assert out.sequence_id.nunique() <= 1.03 * -(-out.length.sum() // 1024) + 1


def test_packing_edge(edge, empty, encode):
    out = packing.packed_sequences(edge, *map(queries.tokenizer_file, (queries.VOCABULARY, queries.RANKS))).toPandas()
    out["doc_id"] = out["doc_id"].astype("Int64")
    check_packing(out, [(r[0], r[1]) for r in EDGE], encode)
    assert packing.packed_sequences(empty, queries.tokenizer_file(queries.VOCABULARY)).count() == 0


# 7 ------------------------------------------------------------------------------------------------------------------
def plain_top(rows, k):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in kept:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in kept if i != q and len(w) == len(v))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def test_top_k(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == plain_top([(r.vec_id, list(r.embedding)) for r in df.collect()], 20)


def test_top_k_in_blocks_with_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "SAMPLE", 50)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3) / 8] if i % 3 else [0.5, 0.5, 0.5]) for i in range(400)]
    rows += [(400, None), (420, [1.0, None, 0.0]), (440, [float("nan"), 0.0, 0.0]), (460, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (480, [])]
    rows += [(500, [1.0, 2.0]), (501, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == plain_top(rows, 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# 8 ------------------------------------------------------------------------------------------------------------------
def test_token_counts(docs, rows, edge, empty, encode):
    out = by_id(tokens.token_counts(docs, queries.tokenizer_file(queries.VOCABULARY)), "n_bytes", "n_tokens", "over_limit")
    for i, text in rows:
        n = len(encode(text))
        assert out[i] == (len(text.encode()), n, n > 1024)
    got = sorted((r.doc_id or 0, r.n_tokens) for r in tokens.token_counts(edge, queries.tokenizer_file(queries.VOCABULARY)).collect())
    assert got == sorted((i or 0, len(encode(t or ""))) for i, t, *_ in EDGE)
    assert tokens.token_counts(empty, queries.tokenizer_file(queries.VOCABULARY)).count() == 0


def test_token_counts_of_odd_texts(encode):
    merger = tokens.Merger(queries.tokenizer_file(queries.VOCABULARY))
    rng = random.Random(7)
    odd = ["a<|endoftext|>b <|endoftext|>", "don't  stop\n\n x", "日本語 テスト", "\x1c\x85  a", "क़̀ ꟎", "a" * 5000, " " * 900, "😀é" * 30, "²½ x²"]
    odd += ["".join(rng.choice("ab 'st\n1é　.😀") for _ in range(60)) for _ in range(400)]
    assert merger.count(odd) == [len(encode(t)) for t in odd]
    tokens_fast = packing.Encoder(*map(queries.tokenizer_file, (queries.VOCABULARY, queries.RANKS)))
    assert all(list(tokens_fast(t)) == encode(t) for t in odd)


# 9 ------------------------------------------------------------------------------------------------------------------
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])) % 10 == 0
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), list(PATTERNS).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_private_data(docs, rows):
    out = by_id(pii.private_data(docs), "base_sha256", "spans")
    for i, text in rows:
        assert out[i][0] == hashlib.sha256(",".join(plain_spans(text)).encode()).hexdigest()


def test_private_patterns():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@1-0+ 9(4é4539") for _ in range(rng.randrange(60)))
        assert [f"{k}:{a}:{b}" for a, b, k in pii.base_spans(text)] == plain_spans(text)
    assert pii.base_spans("a" * 300_000 + "1" * 300_000) == []


def test_disclosing_terms_are_sanitised(spark):
    rng = random.Random(9)
    words = ["the", "of", "and", "river", "stone", "table", "green", "paper"]
    filler = lambda: " ".join(rng.choice(words) for _ in range(12))
    texts = [f"{filler()} zorblatt writes from zed@example.com {filler()}" for _ in range(6)]
    texts += [f"{filler()} zorblatt {filler()}", *(filler() for _ in range(200))]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    spans = {i: s for i, (s,) in by_id(pii.private_data(df), "spans").items()}
    at = texts[6].index("zorblatt")
    assert spans[6] == f"key:{at}:{at + 8}" and all(spans[i] == "" for i in range(7, len(texts)))
    clean = by_id(pii.sanitise(df), "text", "n_chars")
    assert all("zorblatt" not in t and "zed@" not in t and len(t) == n for t, n in clean.values())
    assert "[EMAIL]" in clean[0][0]


def test_a_row_without_id_beside_id_minus_one(spark):
    """Both share a text with a disclosed term; every row comes out once, with its spans."""
    rng = random.Random(9)
    filler = lambda: " ".join(rng.choice(["the", "of", "and", "river", "stone", "table"]) for _ in range(12))
    texts = [f"{filler()} zorblatt writes from zed@example.com {filler()}" for _ in range(6)] + [filler() for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (-1, texts[0]), (None, texts[0])]
    out = pii.private_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert len({r.spans for r in out if r.doc_id in (None, -1, 0)}) == 1 and "key:" in next(r.spans for r in out if r.doc_id == -1)


def test_tokens_without_labels_are_those_with_labels(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["", " a b", "a b ", None, "a\tb\x0bc\x85d", "x"])], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "good"), (2, "plain"), (5, "good")], "doc_id long, domain string")
    without, given = (mixing.mixing_rates(docs, some, mixing.SHARES) for some in (labels.limit(0), labels))
    assert by_id(without, "n_tokens") == by_id(given, "n_tokens") == {i: (n,) for i, n in enumerate([0, 2, 2, 0, 3, 1])}
    assert without.columns == ["doc_id", "n_tokens", "domain", *(f"p_{d}" for d in sorted(mixing.SHARES)), "rate", "copies"]


def test_private_edge(edge, empty):
    out = pii.private_data(edge)
    assert out.count() == len(EDGE) and out.where(F.col("base_sha256") == hashlib.sha256(b"").hexdigest()).count() == len(EDGE)
    assert pii.private_data(empty).count() == 0 and pii.sanitise(empty).count() == 0
    clean = pii.sanitise(edge)
    assert clean.columns == edge.columns and clean.count() == len(EDGE) and clean.where("text is null").count() == 1


# 10 -----------------------------------------------------------------------------------------------------------------
def plain_print(text):
    """One walk, step by step."""
    table, codes = editprint.bit_table(), [ord(c) for c in text] + [0, 0]
    classes = [(c * 40503 >> 4) % 255 + 1 for c in codes[: len(text)]] + [0, 0]
    steps, at, path = max(1, 2 * len(text)), 0, []
    for j in range(steps):
        path.append(at)
        at += table[j % 4096][classes[at]]
    out = ""
    for records in editprint.sample_steps(steps):
        p = path[max(r for r in records if r < steps)]
        x = 0 if classes[p] == 0 else codes[p] * 0x9E3779B1 + codes[p + 1] * 0x85EBCA6B
        x = (x ^ (x >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
        out += "0123456789abcdef"[(x ^ (x >> 12)) >> 7 & 15]
    return out


def like(a, b):
    return max(0.0, (sum(x == y for x, y in zip(a, b, strict=True)) / len(a) - 1 / 16) / (15 / 16))


def check_prints(df, rows):
    got = {r.doc_id: r for r in editprint.edit_prints(df).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b, c = map(plain_print, (text, new, after))
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(new.encode()).hexdigest(), a, b)
        assert r.near_edited == pytest.approx(like(a, b)) and r.near_next == pytest.approx(like(a, c))


def test_edit_prints(docs, rows):
    some = rows[::7]
    check_prints(docs.where(F.col("doc_id").isin([i for i, _ in some])), some)


def test_edit_prints_tell_likeness(docs):
    out = editprint.edit_prints(docs).toPandas()
    assert 0.4 < out.near_edited.median() < 0.6 and out.near_next.median() < 0.05


def test_edit_prints_edge(edge, empty, spark):
    out = editprint.edit_prints(edge).collect()
    assert len(out) == len(EDGE) and len({r.fingerprint for r in out if r.doc_id in (4, 5)}) == 1
    assert editprint.edit_prints(empty).count() == 0
    one = editprint.edit_prints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"abab").hexdigest())


def test_edit_distance_and_classes(spark):
    rng = random.Random(10)

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(15))) for _ in range(2))
        assert editprint.edit_distance(a, b) == slow(a, b)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(4)]
    texts = [*base, *(b[:300] + "XYZ" + b[305:] for b in base), base[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = {i: c for i, (c,) in by_id(editprint.near_copies(df, editprint.edit_prints(df)), "class_id").items()}
    assert classes == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0, 5: 1, 6: 2, 7: 3, 8: 0}


def plain_classes(rows):
    """Texts linked if prints share a band, are alike and the texts are within the edit distance; smallest id reachable."""
    prints = [plain_print(t) for _, t in rows]
    width = editprint.SLOTS // editprint.BANDS
    links = []
    for i in range(len(rows)):
        for j in range(i):
            (_, s), (_, t), a, b = rows[i], rows[j], prints[i], prints[j]
            banded = any(a[k : k + width] == b[k : k + width] for k in range(0, editprint.SLOTS, width))
            if banded and like(a, b) >= editprint.SAME and editprint.edit_distance(s, t) <= (1 - editprint.SAME) * max(len(s), len(t)):
                links.append((i, j))
    low = [i for i, _ in rows]
    while True:
        before = list(low)
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
        if low == before:
            return {i: c for (i, _), c in zip(rows, low, strict=True)}


def test_failed_pairs_do_not_cut_classes(spark, monkeypatch):
    """Prints all alike, texts of three kinds: most pairs fail, and every class must come out whole."""
    monkeypatch.setattr(editprint, "walk_prints", lambda values, table: np.full((len(values), editprint.SLOTS), 7, dtype=np.uint8))
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(3)]
    rows = [(i, base[i % 3][:50] + f"{i:04d}" + base[i % 3][54:]) for i in range(60)]
    df = spark.createDataFrame([*rows, (70, rows[4][1]), (None, rows[5][1])], "doc_id long, text string")
    for chunk in (16, 2048):
        got = by_id(editprint.near_copies(df, chunk=chunk), "class_id")
        assert got == {**{i: (i % 3,) for i, _ in rows}, 70: (1,), None: (2,)}


def test_near_copies_are_those_of_all_candidates(spark):
    rng = random.Random(13)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(5, 200))) if i % 6 == 0 else rows[-1][1]
        for _ in range(rng.randrange(4) if i % 6 else 0):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("xyz") * rng.randrange(3) + text[at + 1 :]
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {i: c for i, (c,) in by_id(editprint.near_copies(df, chunk=8), "class_id").items()} == plain_classes(rows)


def test_near_copies_edge(edge, empty):
    out = editprint.near_copies(edge).collect()
    assert len(out) == len(EDGE) and {r.class_id for r in out if r.doc_id in (4, 5)} == {4}
    assert editprint.near_copies(empty).count() == 0


def test_letters():
    assert language.letters("Ab1²_c’É") == "ab c é" and regex.search(r"\p{L}", "½²") is None
