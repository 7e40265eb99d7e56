"""Queries over span records, parsed documents and starred text."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagloom.functions import text as T
from lagloom.operators import events as E
from lagloom.operators import parsed as D
from lagloom.operators import spans as S
from lagloom.plans import fixtures as X
from lagloom.plans.registry import ORACLES, query


def _features(spark, d, columns: dict):
    return X.spans(spark, d).select("doc_id", *[c.alias(n) for n, c in columns.items()])


@query(
    "span_position_features",
    """SELECT doc_id, CAST(a_off < p_off AS INT) AS a_then_pronoun, CAST(b_off < p_off AS INT) AS b_then_pronoun,
              CAST(p_off < a_off AND p_off < b_off AS INT) AS pronoun_first, CAST(p_off > a_off AND p_off > b_off AS INT) AS pronoun_last,
              abs(p_off - a_off) AS a_dist, abs(p_off - b_off) AS b_dist FROM spans""",
)
def span_position_features(spark, d):
    return _features(spark, d, S.position_features())


def _between(x: str, y: str) -> str:
    part = f"substr(text, {x} + 1, greatest({y} - {x}, 0))"
    return f"(contains({part}, '.') OR contains({part}, ';'))"


@query(
    "span_sentence_features",
    f"""SELECT doc_id,
          CAST(NOT contains(substr(text, least(a_off, b_off, p_off) + 1, greatest(a_off, b_off, p_off) - least(a_off, b_off, p_off)), '.') AS INT) AS all_in_one_sent,
          CAST({_between('greatest(a_off, b_off)', 'p_off')} AND a_off < p_off AND b_off < p_off AS INT) AS pronoun_in_next_sent,
          CAST({_between('greatest(a_off, p_off)', 'b_off')} AND a_off < b_off AND p_off < b_off AS INT) AS b_in_next_sent,
          CAST({_between('p_off', 'least(a_off, b_off)')} AND p_off < a_off AND p_off < b_off AS INT) AS pronoun_in_prev_sent,
          CAST({_between('a_off', 'least(p_off, b_off)')} AND a_off < b_off AND a_off < p_off AS INT) AS a_in_prev_sent
        FROM spans""",
)
def span_sentence_features(spark, d):
    return _features(spark, d, S.sentence_features())


def _count(n: str) -> str:
    return (
        f"CASE WHEN {n} = '' THEN length(text) + 1 ELSE (length(text) - length(replace(text, {n}, ''))) // length({n}) END"
    )


@query("span_frequency_features", f"SELECT doc_id, {_count('a')} AS freq_a, {_count('b')} AS freq_b FROM spans")
def span_frequency_features(spark, d):
    return _features(spark, d, S.frequency_features())


@query(
    "substring_count",
    "SELECT doc_id, len(string_split(text, 'en')) - 1 AS n FROM documents",
)
def substring_count(spark, d):
    return X.read(spark, d, "documents").select("doc_id", T.substring_count(F.col("text"), F.lit("en")).alias("n"))


_TITLE = "replace(lower(substr(url, 30)), '_', ' ')"


@query(
    "span_url_features",
    f"SELECT doc_id, CAST(contains({_TITLE}, lower(a)) AS INT) AS a_in_url, CAST(contains({_TITLE}, lower(b)) AS INT) AS b_in_url FROM spans",
)
def span_url_features(spark, d):
    return _features(spark, d, S.url_features())


@query("url_title", f"SELECT page_id, {_TITLE} AS title FROM pages")
def url_title(spark, d):
    return X.read(spark, d, "pages").select("page_id", T.url_title(F.col("url")).alias("title"))


@query(
    "title_class",
    f"SELECT doc_id, CASE WHEN contains({_TITLE}, lower(a)) THEN 0 WHEN contains({_TITLE}, lower(b)) THEN 1 ELSE 2 END AS in_title FROM spans",
)
def title_class(spark, d):
    return _features(spark, d, {"in_title": T.title_class(F.col("a"), F.col("b"), F.col("url"))})


_LOW = "least(p_off, a_off, b_off)"
_HIGH = "greatest(p_off + length(pronoun), a_off + length(a), b_off + length(b))"


@query(
    "span_extents",
    f"""SELECT doc_id, p_off + length(pronoun) AS p_end, a_off + length(a) AS a_end, b_off + length(b) AS b_end,
               {_LOW} AS section_min, {_HIGH} AS section_max, abs(p_off - a_off) AS a_dist, abs(p_off - b_off) AS b_dist FROM spans""",
)
def span_extents(spark, d):
    return _features(spark, d, S.extents())


_LEFT = f"(CASE WHEN contains(left(text, {_LOW}), '.') THEN {_LOW} - strpos(reverse(left(text, {_LOW})), '.') ELSE -1 END)"
_RIGHT = f"(CASE WHEN contains(substr(text, {_HIGH} + 1), '.') THEN {_HIGH} + strpos(substr(text, {_HIGH} + 1), '.') - 1 ELSE -1 END)"


@query("find_left_right", f"SELECT doc_id, {_LEFT} AS l, {_RIGHT} AS r FROM spans")
def find_left_right(spark, d):
    e = S.extents()
    return _features(
        spark, d,
        {"l": T.last_before(F.col("text"), ".", e["section_min"]), "r": T.first_from(F.col("text"), ".", e["section_max"])},
    )


@query(
    "snippet_around_spans",
    f"""SELECT doc_id, substr(text, l + 2, greatest(CASE WHEN r >= 0 THEN r ELSE length(text) END - l - 1, 0)) AS snippet,
               substr(text, l + 2, greatest(CASE WHEN r >= 0 THEN r ELSE length(text) - 1 END - l - 1, 0)) AS compat
        FROM (SELECT doc_id, text, {_LEFT} AS l, {_RIGHT} AS r FROM spans)""",
)
def snippet_around_spans(spark, d):
    return _features(spark, d, {"snippet": S.snippet(), "compat": S.snippet(compat=True)})


@query("char_slice", "SELECT doc_id, substr(text, a_off + 1, greatest(b_off - a_off, 0)) AS part FROM spans")
def char_slice(spark, d):
    return _features(spark, d, {"part": T.char_slice(F.col("text"), F.col("a_off"), F.col("b_off"))})


@query("name_in_text", "SELECT doc_id, CAST(contains(text, lower(a)) AS INT) AS a_in, CAST(contains(text, lower(b)) AS INT) AS b_in FROM spans")
def name_in_text(spark, d):
    return _features(
        spark, d,
        {"a_in": T.name_in_text(F.col("a"), F.col("text")), "b_in": T.name_in_text(F.col("b"), F.col("text"))},
    )


@query(
    "pronoun_flags",
    """SELECT doc_id, CAST(pron IN ('he', 'his', 'him') AS INT) AS male, CAST(pron IN ('he', 'she') AS INT) AS subj,
              CAST(pron IN ('him', 'her') AS INT) AS obj, CAST(pron IN ('his', 'hers') AS INT) AS poss FROM spans""",
)
def pronoun_flags(spark, d):
    return _features(spark, d, T.pronoun_flags(F.col("pron")))


@query("gender_of_pronoun", "SELECT doc_id, CASE WHEN pron IN ('he', 'his', 'him') THEN 'M' ELSE 'F' END AS gender FROM spans")
def gender_of_pronoun(spark, d):
    return _features(spark, d, {"gender": T.gender_of_pronoun(F.upper("pron"))})


@query(
    "parse_bool_text",
    """SELECT id, a_coref AS a, CASE WHEN id % 3 <> 0 THEN b_coref END AS b FROM gold""",
)
def parse_bool_text(spark, d):
    a = F.upper(F.col("a_coref").cast("string"))
    b = F.when(F.col("id") % 3 == 0, "unknown").otherwise(F.initcap(F.col("b_coref").cast("string")))
    return X.gold(spark, d).select("id", T.parse_bool_text(a).alias("a"), T.parse_bool_text(b).alias("b"))


@query("strip_stars", "SELECT doc_id, replace(text, '*', '') AS text FROM starred")
def strip_stars(spark, d):
    return X.starred(spark, d).select("doc_id", T.strip_stars(F.col("text")).alias("text"))


@query(
    "ratio_scale",
    "SELECT doc_id, round(a_off / length(text), 6) AS a_rel, round(b_off / length(text), 6) AS b_rel, round(p_off / length(text), 6) AS p_rel FROM spans",
)
def ratio_scale(spark, d):
    return _features(spark, d, {n: F.round(c, 6) for n, c in S.ratio_features().items()})


_ANON = """
    SELECT doc_id, list_reduce(list_prepend(CASE WHEN b = '' THEN t ELSE replace(t, b, 'subjecttwo') END, string_split(b, ' ')),
                               lambda x, y: CASE WHEN y = '' THEN x ELSE replace(x, y, 'subjecttwo') END) AS text
    FROM (SELECT doc_id, b, list_reduce(list_prepend(CASE WHEN a = '' THEN text ELSE replace(text, a, 'subjectone') END, string_split(a, ' ')),
                               lambda x, y: CASE WHEN y = '' THEN x ELSE replace(x, y, 'subjectone') END) AS t FROM spans)"""


@query("anonymise_names", _ANON)
def anonymise_names(spark, d):
    return _features(spark, d, {"text": S.anonymised()})


# --- parsed documents ----------------------------------------------------------------------------

@query(
    "possessive_count",
    "SELECT doc_id, count(*) FILTER (text = 'de' AND dep = 'poss') AS n_short, count(*) FILTER (text = 'und' AND dep = 'poss') AS n_und, "
    "count(*) FILTER (text = 'the' AND dep = 'poss') AS n_the FROM tokens GROUP BY doc_id",
)
def possessive_count(spark, d):
    return D.possessive_count(X.tokens(spark, d), {"n_short": "de", "n_und": "und", "n_the": "the"})


_ROLES = """
    roles AS (SELECT doc_id, 'a' AS role, a AS name, a_off AS off FROM spans
              UNION ALL SELECT doc_id, 'b', b, b_off FROM spans UNION ALL SELECT doc_id, 'p', pronoun, p_off FROM spans)"""


@query(
    "join_nearest_preceding",
    f"""WITH {_ROLES} SELECT r.doc_id, r.role, arg_max(t.tok, t.char_off) AS tok, max(t.char_off) AS char_off
        FROM roles r JOIN tokens t ON t.doc_id = r.doc_id AND t.char_off <= r.off + 3 GROUP BY 1, 2""",
)
def join_nearest_preceding(spark, d):
    inside = X.spans(spark, d).withColumns({f"{r}_off": F.col(f"{r}_off") + 3 for r in ("a", "b", "p")})
    return D.nearest_preceding(X.tokens(spark, d), inside)


_SYN = [(r, x) for r in ("a", "b") for x in D.NAME_DEPS] + [("p", x) for x in D.PRONOUN_DEPS]


@query(
    "syntactic_onehot",
    f"""WITH {_ROLES},
        starts AS (SELECT r.doc_id, r.role, t.tok AS start FROM roles r JOIN tokens t ON t.doc_id = r.doc_id AND t.char_off = r.off),
        deps AS (SELECT s.doc_id, s.role, arg_min(t.dep, t.tok) AS dep FROM starts s JOIN tokens t ON t.doc_id = s.doc_id
                 AND ((s.role = 'p' AND t.tok = s.start) OR (s.role <> 'p' AND t.tok >= s.start AND t.dep NOT IN ('compound', 'punct')))
                 GROUP BY 1, 2)
        SELECT sp.doc_id, """
    + ", ".join(f"count(*) FILTER (x.role = '{r}' AND x.dep = '{dep}') AS {r}_{dep}" for r, dep in _SYN)
    + " FROM spans sp LEFT JOIN deps x ON x.doc_id = sp.doc_id GROUP BY sp.doc_id",
)
def syntactic_onehot(spark, d):
    return D.syntactic_onehot(X.tokens(spark, d), X.spans(spark, d))


_DEPTHS = f"""
    WITH RECURSIVE {_ROLES.strip()},
    starts AS MATERIALIZED (SELECT r.doc_id, r.role, r.off, t.tok, t.sent FROM roles r JOIN tokens t ON t.doc_id = r.doc_id AND t.char_off = r.off),
    near AS MATERIALIZED (SELECT t.doc_id, t.tok, t.head_tok FROM tokens t
                          WHERE (t.doc_id, t.sent) IN (SELECT (doc_id, sent) FROM starts)),
    climb(doc_id, role, tok, head_tok, depth) AS (
        SELECT s.doc_id, s.role, n.tok, n.head_tok, 0 FROM starts s JOIN near n ON n.doc_id = s.doc_id AND n.tok = s.tok
        UNION ALL
        SELECT c.doc_id, c.role, n.tok, n.head_tok, c.depth + 1 FROM climb c
        JOIN near n ON n.doc_id = c.doc_id AND n.tok = c.head_tok WHERE c.tok <> c.head_tok),
    ranks AS (SELECT doc_id, role, max(depth) AS depth FROM climb GROUP BY 1, 2),
    counts AS (SELECT doc_id, max(sent) + 1 AS n FROM tokens GROUP BY 1)"""


@query(
    "deptree_features",
    f"""{_DEPTHS}
    SELECT sp.doc_id, round(sp.a_off / length(sp.text), 6) AS a_rel, round(sp.b_off / length(sp.text), 6) AS b_rel,
           round(sp.p_off / length(sp.text), 6) AS p_rel,
           round(max(s.sent) FILTER (s.role = 'a') / max(c.n), 6) AS a_sent, round(max(s.sent) FILTER (s.role = 'b') / max(c.n), 6) AS b_sent,
           round(max(s.sent) FILTER (s.role = 'p') / max(c.n), 6) AS p_sent,
           max(r.depth) FILTER (s.role = 'a') / 10 AS a_rank, max(r.depth) FILTER (s.role = 'b') / 10 AS b_rank,
           max(r.depth) FILTER (s.role = 'p') / 10 AS p_rank
    FROM spans sp JOIN starts s ON s.doc_id = sp.doc_id JOIN ranks r ON r.doc_id = s.doc_id AND r.role = s.role
    JOIN counts c ON c.doc_id = sp.doc_id GROUP BY sp.doc_id, sp.a_off, sp.b_off, sp.p_off, sp.text""",
)
def deptree_features(spark, d):
    rows = D.deptree_features(X.tokens(spark, d), X.spans(spark, d))
    return rows.select("doc_id", *[F.round(c, 6).alias(c) for c in rows.columns if c != "doc_id"])


@query(
    "other_person_entities",
    """SELECT s.doc_id, count(*) FILTER (e.label = 'PERSON' AND e.ent_text <> s.a AND e.ent_text <> s.b) AS named_ent
       FROM spans s LEFT JOIN entities e ON e.doc_id = s.doc_id GROUP BY s.doc_id""",
)
def other_person_entities(spark, d):
    return D.other_person_entities(X.entities(spark, d), X.spans(spark, d))


_HEADS = """
    own AS (SELECT m.doc_id, arg_min(m.cluster_id, m.m) AS cluster_id FROM mentions m WHERE m.tok = 5 GROUP BY m.doc_id),
    heads AS (SELECT m.doc_id, arg_min(m.text, m.m) AS coref FROM mentions m JOIN own o ON o.doc_id = m.doc_id AND o.cluster_id = m.cluster_id GROUP BY m.doc_id),
    named AS (SELECT s.doc_id, lower(s.a) AS a, lower(s.b) AS b, lower(h.coref) AS c FROM spans s LEFT JOIN heads h ON h.doc_id = s.doc_id),
    matched AS (SELECT *, CASE WHEN c = '' THEN c WHEN contains(a, c) OR contains(c, a) THEN a
                               WHEN contains(b, c) OR contains(c, b) THEN b ELSE c END AS coref FROM named)"""


def _heads(spark, d):
    at = X.tokens(spark, d).where("tok = 5").select("doc_id", "tok")
    return D.pronoun_cluster_heads(X.mentions(spark, d), at)


@query(
    "coref_name_match",
    f"""WITH {_HEADS} SELECT doc_id, coref, coalesce(CAST(coref = a AS INT), 0) AS coref_a, coalesce(CAST(coref = b AS INT), 0) AS coref_b FROM matched""",
)
def coref_name_match(spark, d):
    return D.coref_name_match(_heads(spark, d), X.spans(spark, d))


@query(
    "cluster_membership",
    """WITH c AS (SELECT m.doc_id, m.cluster_id, bool_or(m.text = s.pronoun) AS p, bool_or(m.text = s.a) AS a, bool_or(m.text = s.b) AS b
                  FROM mentions m JOIN spans s ON s.doc_id = m.doc_id GROUP BY 1, 2)
       SELECT s.doc_id, coalesce(max(CAST(c.p AND c.a AS INT)), 0) AS in_cluster_a, coalesce(max(CAST(c.p AND c.b AS INT)), 0) AS in_cluster_b
       FROM spans s LEFT JOIN c ON c.doc_id = s.doc_id GROUP BY s.doc_id""",
)
def cluster_membership(spark, d):
    return D.cluster_membership(X.mentions(spark, d), X.spans(spark, d))


@query(
    "cluster_membership_by_parts",
    r"""WITH c AS (SELECT doc_id, cluster_id, list(DISTINCT text) AS texts FROM mentions GROUP BY 1, 2),
        h AS (SELECT s.doc_id, c.cluster_id,
                     CAST(list_contains(texts, s.a) OR list_has_all(texts, list_filter(regexp_split_to_array(s.a, '\s+'), lambda w: w <> '')) AS INT) AS a,
                     CAST(list_contains(texts, s.b) OR list_has_all(texts, list_filter(regexp_split_to_array(s.b, '\s+'), lambda w: w <> '')) AS INT) AS b
              FROM spans s JOIN c ON c.doc_id = s.doc_id WHERE list_contains(texts, s.pronoun)),
        best AS (SELECT doc_id, arg_min(a, cluster_id) AS a, arg_min(b, cluster_id) AS b FROM h WHERE a = 1 OR b = 1 GROUP BY doc_id)
        SELECT s.doc_id, coalesce(best.a, 0) AS parts_a, coalesce(best.b, 0) AS parts_b,
               greatest(1 - coalesce(best.a, 0) - coalesce(best.b, 0), 0) AS parts_neither
        FROM spans s LEFT JOIN best ON best.doc_id = s.doc_id""",
)
def cluster_membership_by_parts(spark, d):
    return D.cluster_membership_by_parts(X.mentions(spark, d), X.spans(spark, d))


@query(
    "antecedent_match",
    f"""WITH {_ROLES},
        firsts AS (SELECT r.doc_id, r.role, min(m.m) AS m FROM roles r JOIN mentions m ON m.doc_id = r.doc_id AND m.text = r.name GROUP BY 1, 2),
        pick AS (SELECT doc_id, m, arg_max(ant, score * 1000000 - ant) AS ant FROM antecedents WHERE score > 0 GROUP BY 1, 2),
        linked AS (SELECT f.doc_id, f.role, coalesce(n.text, '') AS t FROM firsts f LEFT JOIN pick p ON p.doc_id = f.doc_id AND p.m = f.m
                   LEFT JOIN mentions n ON n.doc_id = p.doc_id AND n.m = p.ant),
        wide AS (SELECT doc_id, max(t) FILTER (role = 'a') AS ta, max(t) FILTER (role = 'b') AS tb, max(t) FILTER (role = 'p') AS tp FROM linked GROUP BY 1),
        f AS (SELECT s.doc_id, coalesce(CAST(ta IS NOT NULL AND tp IS NOT NULL AND (ta = s.pronoun OR tp = s.a) AS INT), 0) AS ante_a,
                     coalesce(CAST(tb IS NOT NULL AND tp IS NOT NULL AND (tb = s.pronoun OR tp = s.b) AS INT), 0) AS ante_b
              FROM spans s LEFT JOIN wide w ON w.doc_id = s.doc_id)
        SELECT *, greatest(1 - ante_a - ante_b, 0) AS ante_neither FROM f""",
)
def antecedent_match(spark, d):
    return D.antecedent_match(X.mentions(spark, d), X.antecedents(spark, d), X.spans(spark, d))


@query(
    "join_mention_pairs",
    f"""WITH {_ROLES},
        named AS (SELECT m.doc_id, m.m, r.role FROM mentions m JOIN roles r ON r.doc_id = m.doc_id AND r.name = m.text),
        scored AS (SELECT x.doc_id, f.role AS fr, t.role AS tr, x.score FROM antecedents x
                   JOIN named f ON f.doc_id = x.doc_id AND f.m = x.m JOIN named t ON t.doc_id = x.doc_id AND t.m = x.ant WHERE x.score > 0)
        SELECT s.doc_id, coalesce(max(score) FILTER (fr = 'p' AND tr = 'a'), 0) AS p_a, coalesce(max(score) FILTER (fr = 'p' AND tr = 'b'), 0) AS p_b,
               coalesce(max(score) FILTER (fr = 'a' AND tr = 'p'), 0) AS a_p, coalesce(max(score) FILTER (fr = 'b' AND tr = 'p'), 0) AS b_p
        FROM spans s LEFT JOIN scored c ON c.doc_id = s.doc_id GROUP BY s.doc_id""",
)
def join_mention_pairs(spark, d):
    return D.join_mention_pairs(X.mentions(spark, d), X.antecedents(spark, d), X.spans(spark, d))


@query(
    "mention_head_score",
    rf"""WITH {_ROLES},
        firsts AS (SELECT doc_id, text, arg_min(head_score, m) AS score FROM mentions GROUP BY 1, 2),
        full_s AS (SELECT r.doc_id, r.role, f.score FROM roles r JOIN firsts f ON f.doc_id = r.doc_id AND f.text = r.name),
        parts AS (SELECT doc_id, role, unnest(regexp_split_to_array(name, '\s+')) AS w FROM roles),
        part_s AS (SELECT p.doc_id, p.role, avg(f.score) AS score FROM parts p JOIN firsts f ON f.doc_id = p.doc_id AND f.text = p.w WHERE p.w <> '' GROUP BY 1, 2),
        s AS (SELECT r.doc_id, r.role, coalesce(x.score, y.score, 0) AS score FROM roles r LEFT JOIN full_s x ON x.doc_id = r.doc_id AND x.role = r.role
              LEFT JOIN part_s y ON y.doc_id = r.doc_id AND y.role = r.role)
        SELECT doc_id, round(max(score) FILTER (role = 'a'), 6) AS a_score, round(max(score) FILTER (role = 'b'), 6) AS b_score,
               round(max(score) FILTER (role = 'p'), 6) AS p_score FROM s GROUP BY doc_id""",
)
def mention_head_score(spark, d):
    rows = D.mention_head_score(X.mentions(spark, d), X.spans(spark, d))
    return rows.select("doc_id", *[F.round(c, 6).alias(c) for c in rows.columns if c != "doc_id"])


# --- ordered fallback ------------------------------------------------------------------------------

def _choices() -> dict:
    url = S.url_features()
    return {
        "url_title": D.url_choice(url["a_in_url"], url["b_in_url"]),
        "same_sentence": F.when(S.sentence_features()["all_in_one_sent"] == 1, "A"),
        "token_distance": D.token_distance_choice(),
    }


_CHOICES = f"""
    picks AS (SELECT doc_id,
        CASE WHEN contains({_TITLE}, lower(a)) AND NOT contains({_TITLE}, lower(b)) THEN 'A'
             WHEN contains({_TITLE}, lower(b)) AND NOT contains({_TITLE}, lower(a)) THEN 'B' END AS c1,
        CASE WHEN NOT contains(substr(text, least(a_off, b_off, p_off) + 1, greatest(a_off, b_off, p_off) - least(a_off, b_off, p_off)), '.') THEN 'A' END AS c2,
        CASE WHEN abs(p_off - a_off) <= abs(p_off - b_off) THEN 'A' ELSE 'B' END AS c3 FROM spans)"""


@query("heuristic_sieve", f"WITH {_CHOICES} SELECT doc_id, coalesce(c1, c2, c3) AS answer FROM picks")
def heuristic_sieve(spark, d):
    return _features(spark, d, {"answer": D.heuristic_sieve(list(_choices().values()))})


@query(
    "sieve_score_board",
    f"""WITH {_CHOICES},
        runs AS (SELECT doc_id, 'url_title' AS pass_name, coalesce(c1, c2, c3) AS answer FROM picks
                 UNION ALL SELECT doc_id, 'same_sentence', coalesce(c2, c3) FROM picks UNION ALL SELECT doc_id, 'token_distance', c3 FROM picks),
        t AS (SELECT r.pass_name, g.a_coref AS gold, r.answer = 'A' AS sys FROM gold g JOIN runs r ON r.doc_id = g.id
              UNION ALL SELECT r.pass_name, g.b_coref, r.answer = 'B' FROM gold g JOIN runs r ON r.doc_id = g.id)
        SELECT pass_name, count(*) FILTER (gold AND sys) AS tp, count(*) FILTER (NOT gold AND sys) AS fp,
               count(*) FILTER (NOT gold AND NOT sys) AS tn, count(*) FILTER (gold AND NOT sys) AS fn FROM t GROUP BY pass_name""",
)
def sieve_score_board(spark, d):
    from lagloom.operators.metrics import confusion_tallies

    runs = D.sieve_prefixes(X.spans(spark, d), _choices(), ["doc_id"])
    gold = X.gold(spark, d).select(F.col("id").alias("doc_id"), "a_coref", "b_coref")
    joined = gold.join(runs, "doc_id")
    flags = F.array(
        F.struct(F.col("a_coref").alias("gold"), (F.col("answer") == "A").alias("system")),
        F.struct(F.col("b_coref").alias("gold"), (F.col("answer") == "B").alias("system")),
    )
    return joined.select("pass_name", F.inline(flags)).groupBy("pass_name").agg(*confusion_tallies())


# --- starred text ----------------------------------------------------------------------------------

_WILD = r"""
    runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z*]*\*[A-Za-z*]*')) AS star FROM starred),
    stars AS (SELECT DISTINCT star FROM runs WHERE length(star) >= 4 AND length(star) - length(replace(star, '*', '')) < length(star) - 1),
    fit AS (SELECT s.star, min(v.term) AS term FROM stars s JOIN vocab_terms v ON length(v.term) = length(s.star)
            AND v.term LIKE replace(s.star, '*', '_') GROUP BY s.star)"""


def _vocab(spark, d):
    return X.vocab_terms(spark, d).select("term", F.col("term").alias("ord"))


@query("join_wildcard", f"WITH {_WILD} SELECT star, term FROM fit")
def join_wildcard(spark, d):
    return D.join_wildcard(D.starred_terms(X.starred(spark, d)), _vocab(spark, d))


@query(
    "normalise_starred_text",
    rf"""WITH {_WILD},
        pieces AS (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS w
                   FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z*]+|[^A-Za-z*]+') AS p FROM starred))
        SELECT p.doc_id, string_agg(coalesce(f.term, p.w), '' ORDER BY p.i) AS text FROM pieces p LEFT JOIN fit f ON f.star = p.w GROUP BY p.doc_id""",
)
def normalise_starred_text(spark, d):
    return D.normalise_starred_text(X.starred(spark, d), _vocab(spark, d))


# The feature groups next to each other: parts with a query of their own are checked by that query's SQL.
_PARTS = (
    "span_url_features", "span_position_features", "span_sentence_features", "span_frequency_features", "coref_name_match",
    "syntactic_onehot", "deptree_features", "other_person_entities", "cluster_membership", "join_mention_pairs",
    "cluster_membership_by_parts", "heuristic_sieve",
)


@query(
    "feature_assembly",
    "SELECT s.doc_id, COLUMNS(* EXCLUDE (doc_id, coref, parts_neither, answer, id, label)), "
    "CAST(answer = 'A' AS INT) AS gap_a, CAST(answer = 'B' AS INT) AS gap_b FROM (SELECT doc_id FROM spans) s "
    + " ".join(f"LEFT JOIN ({ORACLES[name]}) {name} USING (doc_id)" for name in _PARTS)
    + " LEFT JOIN predictions ON predictions.id = s.doc_id",
)
def feature_assembly(spark, d):
    """69 columns: 56 of the text and its parse, 13 of other systems (clusters and scores 6, sieve 2, parts 2, probabilities 3)."""
    spans, mentions, tokens = X.spans(spark, d), X.mentions(spark, d), X.tokens(spark, d)
    answer = D.heuristic_sieve(list(_choices().values()))
    row_local = {
        **S.url_features(), **S.position_features(), **S.sentence_features(), **S.frequency_features(),
        "gap_a": (answer == "A").cast("int"), "gap_b": (answer == "B").cast("int"),
    }
    depths = D.deptree_features(tokens, spans)
    return D.assemble(
        spans.select("doc_id", *[c.alias(n) for n, c in row_local.items()]),
        [
            D.coref_name_match(_heads(spark, d), spans).drop("coref"),
            D.syntactic_onehot(tokens, spans),
            depths.select("doc_id", *[F.round(c, 6).alias(c) for c in depths.columns if c != "doc_id"]),
            D.other_person_entities(X.entities(spark, d), spans),
            D.cluster_membership(mentions, spans),
            D.join_mention_pairs(mentions, X.antecedents(spark, d), spans),
            D.cluster_membership_by_parts(mentions, spans).drop("parts_neither"),
            X.predictions(spark, d).select(F.col("id").alias("doc_id"), "p0", "p1", "p2"),
        ],
    )


@query(
    "scan_vocab_ordinals",
    "SELECT term, row_number() OVER (ORDER BY term) - 1 AS ord FROM vocab_terms",
)
def scan_vocab_ordinals(spark, d):
    return E.dense_codes(X.vocab_terms(spark, d), "term", "ord")
