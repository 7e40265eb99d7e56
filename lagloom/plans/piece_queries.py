"""Queries over word pieces and compressed pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagloom.operators import wordpieces as W
from lagloom.operators.compression import pair_compression_distance as ncd
from lagloom.plans import fixtures as X
from lagloom.plans.registry import query
from lagloom.plans.source_queries import _folder
from lagloom.sources import scans

SPECIAL = [W.UNKNOWN, W.CLS, W.SEP, W.MASK]
CHARS = list("abcdefghijklmnopqrstuvwxyz0123456789.,;:!?-'\"()")
LENGTH = 64


def vocab(spark, d):
    """Marker pieces, characters, benchmark words and their last three letters as continuations."""
    words = X.read(spark, d, "benchmark").select(
        F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")
    ).where("w <> ''")
    from_words = words.select(
        F.explode(F.array("w", F.concat(F.lit("##"), F.right("w", F.lit(3))))).alias("term")
    )
    fixed = SPECIAL + CHARS + [f"##{c}" for c in CHARS if c.isalnum()]
    base = spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in fixed])).alias("term"))
    return from_words.unionByName(base).distinct()


def _q(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


_FIXED = ", ".join(f"({_q(t)})" for t in SPECIAL + CHARS + [f"##{c}" for c in CHARS if c.isalnum()])
_SPLIT = r"""list_filter(regexp_split_to_array(regexp_replace(regexp_replace({t}, '[\t\n\r\p{{Zs}}]', ' ', 'g'), '[\p{{Cc}}\p{{Cf}}\x{{FFFD}}]', '', 'g'), ' +'),
             lambda w: w <> '' AND NOT regexp_full_match(w, '\p{{Mn}}+'))"""


def _dictionary(words: str) -> str:
    """Tables from distinct words to lists of pieces, for the words given as a query."""
    return rf"""
    bw AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM benchmark),
    vocab AS (SELECT w AS term FROM bw WHERE w <> '' UNION SELECT '##' || right(w, 3) FROM bw WHERE w <> ''
              UNION SELECT * FROM (VALUES {_FIXED}) f(t)),
    dw AS MATERIALIZED (SELECT DISTINCT word FROM ({words})),
    wp AS MATERIALIZED (SELECT word, generate_subscripts(p, 1) AS i, unnest(p) AS part FROM (
           SELECT word, list_filter(string_split(regexp_replace(strip_accents(lower(word)), '([!-/:-@\[-`{{-~]|\pP)', ' \1 ', 'g'), ' '), lambda x: x <> '') AS p FROM dw)),
    parts AS MATERIALIZED (SELECT DISTINCT part FROM wp),
    spots AS (SELECT part, s.range AS s, n.range AS n, CASE WHEN s.range > 0 THEN '##' ELSE '' END || substr(part, s.range + 1, n.range) AS term
              FROM parts, range(0, length(part)) s, range(1, length(part) - s.range + 1) n WHERE length(part) <= 200),
    hits AS MATERIALIZED (SELECT part, s, max(n) AS n FROM spots JOIN vocab USING (term) GROUP BY part, s),
    walk(part, pos, pieces) AS (
        SELECT part, CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) FROM parts
        UNION ALL
        SELECT w.part, w.pos + h.n, list_append(w.pieces, CASE WHEN w.pos > 0 THEN '##' ELSE '' END || substr(w.part, w.pos + 1, h.n))
        FROM walk w JOIN hits h ON h.part = w.part AND h.s = w.pos),
    done AS MATERIALIZED (SELECT p.part, coalesce(w.pieces, ['[UNK]']) AS pieces FROM parts p
                          LEFT JOIN walk w ON w.part = p.part AND w.pos = length(p.part)),
    dict AS MATERIALIZED (SELECT wp.word, flatten(list(done.pieces ORDER BY wp.i)) AS pieces FROM wp JOIN done USING (part) GROUP BY wp.word)"""


_CORPUS = f"SELECT unnest({_SPLIT.format(t='text')}) AS word FROM documents"


@query(
    "token_dictionary",
    f"""WITH RECURSIVE {_dictionary(_CORPUS).strip()},
        n AS (SELECT word, count(*) AS n FROM ({_CORPUS}) GROUP BY word)
        SELECT piece, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest(dict.pieces) AS piece, n.n FROM n JOIN dict USING (word)) GROUP BY piece""",
)
def token_dictionary(spark, d):
    return W.token_dictionary(X.read(spark, d, "documents"), vocab(spark, d))


_CUT = f"""
    cut AS MATERIALIZED (SELECT doc_id, role, {_SPLIT.format(t="replace(left(text, o), '*', '')")} AS wb,
                   CASE WHEN role = 'p' THEN {_SPLIT.format(t='substr(text, o + 1, length(name))')} ELSE [] END AS wt,
                   {_SPLIT.format(t="replace(substr(text, o + length(name) + 1), '*', '')")} AS wa
            FROM (SELECT doc_id, text, 'p' AS role, p_off AS o, pronoun AS name FROM spans UNION ALL SELECT doc_id, text, 'a', a_off, a FROM spans
                  UNION ALL SELECT doc_id, text, 'b', b_off, b FROM spans))"""
_CUT_WORDS = "SELECT unnest(list_concat(list_concat(wb, wt), wa)) AS word FROM cut"
_WINDOW = f"""{_CUT.strip()},
    {_dictionary(_CUT_WORDS).strip()},
    flat AS (SELECT doc_id, role, k, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM (
                SELECT doc_id, role, 0 AS k, wb AS ws FROM cut UNION ALL SELECT doc_id, role, 1, wt FROM cut UNION ALL SELECT doc_id, role, 2, wa FROM cut)),
    sides AS (SELECT doc_id, role, k, flatten(list(dict.pieces ORDER BY i)) AS p FROM flat JOIN dict USING (word) GROUP BY 1, 2, 3),
    whole AS (SELECT c.doc_id, c.role, len(coalesce(b.p, [])) AS t,
                     list_concat(list_concat(coalesce(b.p, []), CASE WHEN c.role = 'p' THEN coalesce(m.p, []) ELSE ['[MASK]'] END), coalesce(a.p, [])) AS p
              FROM cut c LEFT JOIN sides b ON b.doc_id = c.doc_id AND b.role = c.role AND b.k = 0
              LEFT JOIN sides m ON m.doc_id = c.doc_id AND m.role = c.role AND m.k = 1
              LEFT JOIN sides a ON a.doc_id = c.doc_id AND a.role = c.role AND a.k = 2),
    begun AS (SELECT *, CASE WHEN len(p) > {LENGTH - 2} THEN least(greatest(t - {(LENGTH - 2) // 2}, 0), len(p) - {LENGTH - 2}) ELSE 0 END AS s0 FROM whole),
    placed AS (SELECT *, CASE WHEN len(p) > {LENGTH - 2} THEN coalesce(list_max(list_filter(range(0, s0 + 1),
                    lambda q: NOT starts_with(p[q + 1], '#') OR q <= t + 1 - {LENGTH - 2})), 0) ELSE 0 END AS s FROM begun),
    framed AS (SELECT doc_id, role, CAST(t - s + 1 AS INT) AS target,
                      list_concat(list_concat(['[CLS]'], p[s + 1:s + {LENGTH - 2}]), ['[SEP]']) AS tokens FROM placed)"""


@query(
    "token_window",
    f"""WITH RECURSIVE {_WINDOW} SELECT doc_id, role, target, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INT) AS n_mask FROM framed""",
)
def token_window(spark, d):
    rows = W.token_window(X.spans(spark, d), vocab(spark, d), LENGTH)
    n_mask = F.size(F.filter("mask", lambda m: m == 1))
    return rows.select("doc_id", "role", "target", F.array_join("tokens", " ").alias("tokens"), n_mask.alias("n_mask"))


@query(
    "token_ids",
    f"""WITH RECURSIVE {_WINDOW},
        nums AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS ord FROM vocab),
        pos AS (SELECT doc_id, role, generate_subscripts(tokens, 1) AS i, unnest(tokens) AS term FROM framed)
        SELECT doc_id, role, string_agg(CAST(ord AS VARCHAR), ' ' ORDER BY i) || repeat(' 0', {LENGTH} - CAST(count(*) AS INT)) AS ids
        FROM pos JOIN nums USING (term) GROUP BY doc_id, role""",
)
def token_ids(spark, d):
    path = _folder(spark, "pieces")
    vocab(spark, d).orderBy("term").write.text(path)
    terms = scans.scan_vocab(spark, path, filtered=False)
    rows = W.token_window(X.spans(spark, d), terms, LENGTH)
    ids = W.token_ids(rows, ["doc_id", "role"], terms, LENGTH)
    return ids.select("doc_id", "role", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


@query("pair_compression_distance")
def pair_compression_distance(spark, d):
    """Every conversation turn with the one after it."""
    turns = X.read(spark, d, "conversations")

    def key(turn):
        return F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))

    texts = turns.select(key(F.col("turn")).alias("id"), "text")
    pairs = turns.select(key(F.col("turn")).alias("left"), key(F.col("turn") + 1).alias("right"))
    rows = ncd(texts, pairs)
    return rows.select("left", "right", F.round("distance", 6).alias("distance"))
