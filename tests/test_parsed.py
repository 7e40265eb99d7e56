import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from lagloom.operators import parsed as D
from lagloom.operators import spans as S

SPAN = "doc_id long, text string, a string, a_off int, pronoun string, p_off int, b string, b_off int, url string"
TOKEN = "doc_id long, tok int, char_off int, text string, dep string, head_tok int, sent int"


def span_of(text, a, p, b, doc=1, url="x" * 29):
    return (doc, text, a, text.index(a), p, text.index(f" {p} ") + 1, b, text.index(b), url)


def tokens_of(text, deps, doc=1, heads=None):
    out, off = [], 0
    for i, w in enumerate(text.split(" ")):
        out.append((doc, i, off, w, deps[i % len(deps)], heads[i] if heads else 0, 0))
        off += len(w) + 1
    return out


def test_sentence_features_by_slices(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("ab.; é") for _ in range(30))
        rows.append((i, text, "a", rng.randrange(30), "p", rng.randrange(30), "b", rng.randrange(30), ""))
    df = spark.createDataFrame(rows, SPAN)
    f = S.sentence_features()
    for r in df.select("*", *[c.alias(n) for n, c in f.items()]).collect():
        a, b, p, t = r.a_off, r.b_off, r.p_off, r.text
        ends = lambda x, y: any(m in t[x:max(x, y)] for m in ".;")
        assert r.all_in_one_sent == int("." not in t[min(a, b, p) : max(a, b, p)])
        assert r.pronoun_in_next_sent == int(ends(max(a, b), p) and a < p and b < p)
        assert r.b_in_next_sent == int(ends(max(a, p), b) and a < b and p < b)
        assert r.pronoun_in_prev_sent == int(ends(p, min(a, b)) and p < a and p < b)
        assert r.a_in_prev_sent == int(ends(a, min(p, b)) and a < b and a < p)


def test_names_skip_compounds_but_pronouns_do_not(spark):
    text = "Ann Lee saw her and Bob"
    spans = spark.createDataFrame([span_of(text, "Ann", "her", "Bob")], SPAN)
    toks = spark.createDataFrame(tokens_of(text, ["compound", "punct", "nsubj", "poss", "cc", "compound"]), TOKEN)
    got = D.syntactic_onehot(toks, spans).first().asDict()
    assert got["a_nsubj"] == 1 and got["p_poss"] == 1
    # B's only token is a compound at the end of the text: nothing to skip to.
    assert sum(v for k, v in got.items() if k != "doc_id") == 2 and len(got) == 30


def test_tree_depth_of_a_long_chain(spark):
    n = 75
    toks = [(1, i, i, "w", "x", max(i - 1, 0), 0) for i in range(n)] + [(2, i, i, "w", "x", i, 0) for i in range(3)]
    wanted = spark.createDataFrame([(1, "a", n - 1, 0), (1, "b", 5, 0), (1, "p", 0, 0), (2, "a", 1, 0)], "doc_id long, role string, tok int, sent int")
    got = {(r.doc_id, r.role): (r.depth, r.root) for r in D.tree_depths(spark.createDataFrame(toks, TOKEN), wanted).collect()}
    assert got == {(1, "a"): (n - 1, 0), (1, "b"): (5, 0), (1, "p"): (0, 0), (2, "a"): (0, 1)}


def test_nearest_preceding_across_runs(spark, monkeypatch):
    monkeypatch.setattr(D, "RUN", 4)
    text = " ".join(["abc"] * 20)
    spans = spark.createDataFrame([(1, text, "a", 0, "p", 41, "b", 79, "")], SPAN)
    toks = spark.createDataFrame(tokens_of(text, ["x"]), TOKEN)
    got = {r.role: (r.tok, r.char_off) for r in D.nearest_preceding(toks, spans).collect()}
    assert got == {"a": (0, 0), "p": (10, 40), "b": (19, 76)}


def test_one_document_may_hold_nearly_all_tokens(spark, monkeypatch):
    monkeypatch.setattr(D, "RUN", 64)
    text = "Ann " + "w " * 3000 + "x her y Bob."
    small = "Ann x her y Bob."
    spans = spark.createDataFrame([span_of(text, "Ann", "her", "Bob", 1), span_of(small, "Ann", "her", "Bob", 2)], SPAN)
    rows = tokens_of(text, ["compound"], 1)
    rows = [(*r[:4], "nsubj" if r[3] in ("x", "her") else r[4], *r[5:]) for r in rows]
    toks = spark.createDataFrame(rows + tokens_of(small, ["dobj"], 2), TOKEN)
    got = {r.doc_id: r for r in D.syntactic_onehot(toks, spans).collect()}
    assert got[1].a_nsubj == 1 and got[1].p_nsubj == 1 and got[1].b_nsubj == 0
    assert got[2].a_dobj == 1 and got[2].p_dobj == 1 and got[2].b_dobj == 1


MENTION = "doc_id long, m int, text string, cluster_id int, head_score double"


def mention_rows(spark):
    texts = ["Ann Lee", "she", "Bob", "Lee", "Ann", "he"]
    return spark.createDataFrame([(1, i, t, [0, 0, 1, 2, 2, 1][i], float(i)) for i, t in enumerate(texts)], MENTION)


def span_rows(spark, a="Ann Lee", p="she", b="Bob"):
    return spark.createDataFrame([(1, f"{a} {p} {b}", a, 0, p, 0, b, 0, "")], SPAN)


def test_cluster_membership(spark):
    got = D.cluster_membership(mention_rows(spark), span_rows(spark)).first()
    assert (got.in_cluster_a, got.in_cluster_b) == (1, 0)
    got = D.cluster_membership(mention_rows(spark), span_rows(spark, p="zz")).first()
    assert (got.in_cluster_a, got.in_cluster_b) == (0, 0)


def test_cluster_membership_by_parts_stops_at_first_hit(spark):
    parts = D.cluster_membership_by_parts(mention_rows(spark), span_rows(spark, p="Ann")).first()
    # Cluster 2 holds the pronoun text, "Lee" and "Ann": every word of A.
    assert (parts.parts_a, parts.parts_b, parts.parts_neither) == (1, 0, 0)
    none = D.cluster_membership_by_parts(mention_rows(spark), span_rows(spark, p="Lee", a="Zed", b="Yo")).first()
    assert (none.parts_a, none.parts_b, none.parts_neither) == (0, 0, 1)


def test_mention_pairs_and_antecedents(spark):
    ante = spark.createDataFrame([(1, 1, 0, 2.5), (1, 2, 1, 1.0), (1, 2, 0, 3.0), (1, 1, 2, -4.0), (1, 4, 1, 9.0)], "doc_id long, m int, ant int, score double")
    got = D.join_mention_pairs(mention_rows(spark), ante, span_rows(spark)).first()
    assert (got.p_a, got.p_b, got.a_p, got.b_p) == (2.5, 0.0, 0.0, 1.0)
    hit = D.antecedent_match(mention_rows(spark), ante, span_rows(spark)).first()
    # The pronoun's best antecedent is A; B's best is A, not the pronoun.
    assert (hit.ante_a, hit.ante_b, hit.ante_neither) == (1, 0, 0)


def test_head_scores_fall_back_to_words(spark):
    words = spark.createDataFrame([(1, 0, "Lee", 0, 4.0), (1, 1, "Lee", 0, 9.0), (1, 2, "Ann", 0, 1.0), (1, 3, "she", 0, 7.0)], MENTION)
    got = D.mention_head_score(words, span_rows(spark)).first()
    assert (got.a_score, got.b_score, got.p_score) == (2.5, 0.0, 7.0)


def test_coref_name_match_prefers_a(spark):
    heads = spark.createDataFrame([(1, "LEE")], "doc_id long, coref string")
    got = D.coref_name_match(heads, span_rows(spark, b="Lee Bob")).first()
    assert (got.coref, got.coref_a, got.coref_b) == ("ann lee", 1, 0)
    other = D.coref_name_match(heads.where("false"), span_rows(spark)).first()
    assert (other.coref, other.coref_a, other.coref_b) == (None, 0, 0)


def test_entities_other_than_the_names(spark):
    ents = spark.createDataFrame([(1, "Bob", "PERSON"), (1, "Zoe", "PERSON"), (1, "Zoe", "PERSON"), (1, "Acme", "ORG")], "doc_id long, ent_text string, label string")
    assert D.other_person_entities(ents, span_rows(spark)).first().named_ent == 2
    assert D.other_person_entities(ents.where("false"), span_rows(spark)).first().named_ent == 0


def test_sieve_and_its_prefixes(spark):
    df = spark.createDataFrame([(1, None, "B", "A"), (2, "A", None, "B"), (3, None, None, "B")], "id int, x string, y string, z string")
    c = {n: F.col(n) for n in "xyz"}
    assert [r[0] for r in df.orderBy("id").select(D.heuristic_sieve(list(c.values()))).collect()] == ["B", "A", "B"]
    got = {(r.id, r.pass_name): r.answer for r in D.sieve_prefixes(df, c, ["id"]).collect()}
    assert got[1, "z"] == "A" and got[1, "y"] == "B" and got[2, "y"] == "B" and got[2, "x"] == "A" and len(got) == 9


def rewrite(text, vocab):
    """Star by star over the text, each run of letters and stars looked up by pattern."""
    letters = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ*")
    for star in re.finditer(r"\*", text):
        i = j = star.start()
        while i >= 0 and text[i] in letters:
            i -= 1
        i += 1
        while j < len(text) and text[j] in letters:
            j += 1
        term = text[i:j]
        if j - i < 4 or term.count("*") >= len(term) - 1:
            continue
        hits = fnmatch.filter(vocab, term.replace("*", "?"))
        if hits:
            text = text[:i] + hits[0] + text[j:]
    return text


@pytest.mark.parametrize("seed", [1, 2])
def test_starred_text_equals_star_by_star_rewriting(spark, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abc") for _ in range(rng.randrange(3, 7))) for _ in range(60)] + ["cafés"]
    texts = []
    for i in range(30):
        words = [list(rng.choice(vocab)) for _ in range(12)]
        for w in words:
            for k in range(len(w)):
                if rng.random() < 0.3:
                    w[k] = "*"
        texts.append((i, rng.choice([" ", ", ", "\n"]).join("".join(w) for w in words)))
    terms = spark.createDataFrame([(i, t) for i, t in enumerate(vocab)], "ord int, term string")
    got = D.normalise_starred_text(spark.createDataFrame(texts, "doc_id int, text string"), terms)
    assert {r.doc_id: r.text for r in got.collect()} == {i: rewrite(t, vocab) for i, t in texts}


def test_a_cycle_of_heads_has_no_depth(spark):
    from lagloom.operators.parsed import tree_depths

    tokens = spark.createDataFrame([(1, 0, 0, 1), (1, 0, 1, 0), (1, 1, 2, 2), (1, 1, 3, 2), (1, 1, 4, 3)], "doc_id int, sent int, tok int, head_tok int")
    wanted = spark.createDataFrame([(1, "a", 0, 0), (1, "b", 4, 1), (1, "p", 2, 1)], "doc_id int, role string, tok int, sent int")
    assert {(r.role, r.depth, r.root) for r in tree_depths(tokens, wanted).collect()} == {("a", None, None), ("b", 2, 2), ("p", 0, 2)}


def test_wildcard_with_very_long_terms_and_many_alike(spark):
    """A term of 20,000 letters, and 100,000 terms that share length, first and last letter."""
    long = "a" + "bc" * 9_999 + "z"
    alike = spark.range(100_000).select(F.concat(F.lit("a"), F.lpad(F.conv("id", 10, 26), 5, "0"), F.lit("z")).alias("term"))
    vocab = alike.unionByName(spark.createDataFrame([(long,)], "term string")).withColumn("ord", F.col("term"))
    stars = spark.createDataFrame([("a0000**",), ("*0000**",), ("a***0*z",), (long.replace("b", "*"),), ("a******",), ("b***0*z",)], "star string")
    got = {r.star: r.term for r in D.join_wildcard(stars, vocab).collect()}
    assert got == {
        "a0000**": "a00000z", "*0000**": "a00000z", "a***0*z": "a00000z", "a******": "a00000z", long.replace("b", "*"): long,
    }


def test_depths_read_all_words_once(spark, monkeypatch):
    from lagloom.operators import parsed

    words = spark.createDataFrame(
        [(d, t, 3 * t, max(0, t - 1), 0) for d in range(3) for t in range(9)], "doc_id long, tok int, char_off long, head_tok int, sent long"
    )
    text = "ab " * 9
    spans = spark.createDataFrame([(d, text, 24, 3, 12) for d in range(3)], "doc_id long, text string, a_off int, b_off int, p_off int")
    spans = spans.withColumns({"a": F.lit("ab"), "b": F.lit("ab"), "pronoun": F.lit("ab")})
    cut, real = [], parsed.cut_lineage
    monkeypatch.setattr(parsed, "cut_lineage", lambda df: cut.append(df) or real(df))
    got = parsed.deptree_features(words, spans).collect()
    assert {(r.doc_id, r.a_rank, r.b_rank, r.p_rank) for r in got} == {(d, 0.8, 0.1, 0.4) for d in range(3)}
    # nothing but the first table reads the words themselves
    plans = [df._jdf.queryExecution().analyzed().toString() for df in cut]
    assert "LogicalRDD" in plans[0] and cut[0].columns == ["doc_id", "tok", "char_off", "head_tok", "sent"]
