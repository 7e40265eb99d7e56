"""The registered queries of this package, each applied to its whole table.

SQL stands beside those of phrases and repeated windows. Fingerprints, tokenizers, compression, runs and the trained models
have no SQL form that ends; they are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagloom.llm import editprint, language, licenses, mixing, packing, periods, phrases, pii, repeats, simhash, subtrees, tokens, topk
from lagloom.llm.common import table

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_mix_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), labelled, mixing.SHARES)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"), tokenizer_file(VOCABULARY), tokenizer_file(RANKS))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_file(VOCABULARY))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_data(table(spark, sf_dir, "documents"))


def op10_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edit_prints(table(spark, sf_dir, "documents"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.near_copies(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic end put into the text of some, as a hash h of the id says; rows without id stay as they are.

    Where h ends in 0, the n words from a on become the first p of these over and over: a = g % n, p = 1 + (n - a) / (3 + g % 8),
    g = h / 10, divisions rounded down.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size("_w").cast("long"), F.col("_g")
    a = F.col("_a")
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    changed = F.transform("_w", lambda w, i: F.when(i < a, w).otherwise(F.get("_w", (a + (i - a) % F.col("_p")).cast("int"))))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, split).alias("_w"), F.floor(h / 10).alias("_g"))
    rows = rows.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", p)
    return rows.select("doc_id", F.when(n > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periods.periodic_runs(with_periodic_ends(table(spark, sf_dir, "documents")))
    # longest first, then by start and period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    length = -best["less"]
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), length.alias("length"), best["period"].alias("period"),
        (F.lit(1000).cast("long") * length).alias("_thousand"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    ).withColumn("exponent_milli", F.expr("_thousand div period")).drop("_thousand")


def op13_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtrees.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_mix_to_target_weights, op3_language_id, op4_repeated_passages, op5_license_scan,
        op6_best_fit_packing, op7_exact_top_k, op8_token_counts, op9_private_data, op10_edit_fingerprints,
        op10_near_copies, op11_phrase_collocations, op12_periodic_runs, op13_repeated_windows,
    )
}

_WORDS = r"""list_filter(regexp_split_to_array({text}, '{by}'), lambda x: x <> '')"""
ORACLES: dict[str, str] = {
    "op11_phrase_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        words AS (SELECT lang, {_WORDS.format(text="piece", by=r"[ \t]+")} AS w FROM pieces),
        grams AS (
            SELECT lang, len, array_to_string(list_slice(w, i, i + len - 1), ' ') AS phrase FROM (
                SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS len))),
        f AS (SELECT lang, len, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
        total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
        cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE len > 1),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:len], ' ') AS tail
            FROM (SELECT *, unnest(range(1, len)) AS k FROM cand) c),
        scored AS (
            SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
            FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_phrases AS (
            SELECT lang, a, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
                SELECT lang, a, w, n, unnest(range(1, len - n + 2)) AS i FROM (SELECT *, unnest(range(2, len)) AS n FROM cand))),
        longer AS (SELECT lang, phrase, max(a) AS a FROM inner_phrases GROUP BY lang, phrase),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
            WHERE o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
    "op13_repeated_windows": rf"""
        WITH words AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')", by=r"[\x20\x09-\x0D]+")} AS w FROM documents),
        begins AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words),
        windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS x FROM begins),
        firsts AS (SELECT x, min(doc_id) AS low FROM windows GROUP BY x),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN firsts USING (x) WHERE low < doc_id),
        listed AS (SELECT doc_id, list(i) AS dead FROM gone GROUP BY doc_id),
        kept AS (
            SELECT doc_id, w, list_filter(w, lambda x, i: dead IS NULL OR NOT list_contains(dead, i)) AS k FROM words LEFT JOIN listed USING (doc_id))
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(k))::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""",
}
