"""Features from parsed documents, whose tokens, entities, mentions and antecedents are tables.

``tokens(doc_id, tok, char_off, text, dep, head_tok, sent)``, ``entities(doc_id, ent_text, label)``,
``mentions(doc_id, m, text, cluster_id, head_score)``, ``antecedents(doc_id, m, ant, score)``.

A document may hold any share of the token rows, so no join has the document alone as its key.
Tokens meet the spans per run of ``RUN`` tokens: a span row is repeated once per run its document
can have, a run is at most ``RUN`` tokens, and partial aggregates bring the runs together. Other
joins use a token index or a text inside the document, reduced to one row per key beforehand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.functions.arrays import let
from lagloom.operators.lookup import lookup
from lagloom.operators.spans import span_rows
from lagloom.session import cut_lineage, discard

# Dependency labels skipped in a name, and the 29 encoded (span, label) pairs.
SKIPPED_DEPS = ("compound", "punct")
NAME_DEPS = (
    "dobj", "poss", "nsubj", "pobj", "appos", "attr", "conj", "nsubjpass", "dative", "nmod", "npadvmod",
)
PRONOUN_DEPS = ("dobj", "poss", "nsubj", "pobj", "attr", "nsubjpass", "dative")


RUN = 4096


def _against_spans(tokens: DataFrame, spans: DataFrame, index: str, columns: list[str | Column]) -> DataFrame:
    """Each token beside ``columns`` of its document's span row.

    A document cannot have more tokens than characters plus one, which bounds its runs.
    """
    runs = F.sequence(F.lit(0), F.floor(F.length("text") / RUN).cast("int"))
    wide = spans.select("doc_id", *columns, F.explode(runs).alias("_run"))
    cut = tokens.withColumn("_run", F.floor(F.col(index) / RUN).cast("int"))
    return cut.join(wide, ["doc_id", "_run"]).drop("_run")


def _per_doc(spans: DataFrame, features: DataFrame, fills: dict) -> DataFrame:
    """Left join of per-document features, with their values where a document has none."""
    return spans.select("doc_id").join(features, "doc_id", "left").na.fill(fills)


def possessive_count(tokens: DataFrame, placeholders: dict[str, str]) -> DataFrame:
    """Per document, tokens equal to a placeholder with dependency ``poss``."""
    return tokens.groupBy("doc_id").agg(
        *[
            F.count_if((F.col("text") == word) & (F.col("dep") == "poss")).alias(out)
            for out, word in placeholders.items()
        ]
    )


def nearest_preceding(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """As-of lookup: the token with the greatest offset not after each span's offset."""
    roles = ("a", "b", "p")
    joined = _against_spans(tokens.select("doc_id", "tok", "char_off"), spans, "tok", [f"{r}_off" for r in roles])

    def last(r: str) -> Column:
        return F.max(F.when(F.col("char_off") <= F.col(f"{r}_off"), F.struct("char_off", "tok"))).alias(r)

    wide = joined.groupBy("doc_id").agg(*[last(r) for r in roles])
    rows = F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("t")) for r in roles])
    return wide.select("doc_id", F.inline(rows)).where("t is not null").select(
        "doc_id", "role", "t.tok", "t.char_off"
    )


def span_tokens(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """The token starting exactly at each span's offset: ``doc_id, role`` and the token's columns."""
    at = span_rows(spans).select("doc_id", "role", F.col("off").alias("char_off"))
    return tokens.join(at, ["doc_id", "char_off"])


def syntactic_onehot(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """29 flags: the dependency label of each span's token; names skip compounds and punctuation.

    Position and label travel as one number, so the search is an integer minimum.
    """
    labels = sorted(set(NAME_DEPS + PRONOUN_DEPS))
    number = F.lit(0)
    for k, x in enumerate(labels):
        number = F.when(F.col("dep") == x, k + 1).otherwise(number)
    roles = ("a", "b", "p")
    slim = tokens.select("doc_id", "tok", "char_off", "dep")
    starts = _against_spans(slim, spans, "tok", [f"{r}_off" for r in roles]).groupBy("doc_id").agg(
        *[F.max(F.when(F.col("char_off") == F.col(f"{r}_off"), F.col("tok"))).alias(f"{r}_tok") for r in roles]
    )
    begun = spans.select("doc_id", "text").join(starts, "doc_id")
    packed = F.col("tok").cast("long") * 64 + number
    useful = ~F.col("dep").isin(*SKIPPED_DEPS)

    def first(r: str) -> Column:
        at = F.col(f"{r}_tok")
        hit = (F.col("tok") == at) if r == "p" else (F.col("tok") >= at) & useful
        return (F.min(F.when(hit, packed)) % 64).alias(r)

    found = _against_spans(slim.drop("char_off"), begun, "tok", [f"{r}_tok" for r in roles]).groupBy("doc_id").agg(
        *[first(r) for r in roles]
    )
    flags = [(r, x) for r in ("a", "b") for x in NAME_DEPS] + [("p", x) for x in PRONOUN_DEPS]
    table = found.select(
        "doc_id",
        *[F.coalesce((F.col(r) == labels.index(x) + 1).cast("int"), F.lit(0)).alias(f"{r}_{x}") for r, x in flags],
    )
    return _per_doc(spans, table, {f"{r}_{x}": 0 for r, x in flags})


def tree_depths(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """Steps from each wanted token up to its root: ``doc_id, role, tok, depth, root``.

    Pointer doubling over the wanted tokens' sentences: after k joins a pointer has moved 2**k
    steps, so their number grows with the logarithm of the depth and no depth is cut off. A token
    that leads into a cycle of heads has no root: depth and root are NULL.
    ``(doc_id, tok)`` is unique, so no join key is hot.
    """
    def doubled(jump: DataFrame) -> DataFrame:
        upper = jump.select("doc_id", F.col("tok").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_d"))
        return jump.join(upper, ["doc_id", "up"]).select(
            "doc_id", "tok", F.col("_up").alias("up"), (F.col("depth") + F.col("_d")).alias("depth"),
            (F.col("_d") > 0).alias("_moved"),
        )

    near = wanted.select("doc_id", "sent").distinct()
    step = (F.col("head_tok") != F.col("tok")).cast("int")
    jump = cut_lineage(
        tokens.join(near, ["doc_id", "sent"], "left_semi").select(
            "doc_id", "tok", F.col("head_tok").alias("up"), step.alias("depth")
        )
    )
    longest = tokens.groupBy("doc_id", "sent").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    moving, steps = True, 1
    while moving and steps < 4 * longest:  # one round past the longest sentence: what moves then is on a cycle
        last, jump = jump, cut_lineage(doubled(doubled(jump)))
        discard(last)
        moving, steps = jump.where("_moved").limit(1).count() > 0, 4 * steps
    ends = F.when(~F.col("_moved"), F.col("depth")).alias("depth"), F.when(~F.col("_moved"), F.col("up")).alias("root")
    return wanted.select("doc_id", "role", "tok").join(
        jump.select("doc_id", "tok", *ends), ["doc_id", "tok"]
    )


def deptree_features(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Relative offset, sentence index over sentence count, and depth / 10, for a, b and p."""
    # read four times: one table of numbers, without texts, instead of four passes over all words
    tokens = cut_lineage(tokens.select("doc_id", "tok", "char_off", "head_tok", "sent"))
    wanted = cut_lineage(span_tokens(tokens, spans).select("doc_id", "role", "tok", "sent"))
    depths = tree_depths(tokens, wanted)
    sentences = tokens.groupBy("doc_id").agg((F.max("sent") + 1).alias("_n"))
    picked = wanted.join(depths.select("doc_id", "role", "depth"), ["doc_id", "role"]).groupBy("doc_id").agg(
        *[
            F.max(F.when(F.col("role") == r, F.col(c))).alias(f"_{r}_{c}")
            for r in ("a", "b", "p")
            for c in ("sent", "depth")
        ]
    )
    length = F.length("text").cast("double")
    return (
        spans.join(sentences, "doc_id").join(picked, "doc_id")
        .select(
            "doc_id",
            *[F.try_divide(F.col(f"{r}_off").cast("double"), length).alias(f"{r}_rel") for r in ("a", "b", "p")],
            *[(F.col(f"_{r}_sent") / F.col("_n").cast("double")).alias(f"{r}_sent") for r in ("a", "b", "p")],
            *[(F.col(f"_{r}_depth") / F.lit(10.0)).alias(f"{r}_rank") for r in ("a", "b", "p")],
        )
    )


def other_person_entities(entities: DataFrame, spans: DataFrame) -> DataFrame:
    """PERSON entities whose text is neither name."""
    texts = entities.where(F.col("label") == "PERSON").groupBy("doc_id", "ent_text").agg(
        F.count(F.lit(1)).alias("n")
    )
    names = spans.select("doc_id", F.explode(F.array_distinct(F.array("a", "b"))).alias("ent_text"))
    counts = texts.join(names, ["doc_id", "ent_text"], "left_anti").groupBy("doc_id").agg(
        F.sum("n").alias("named_ent")
    )
    return _per_doc(spans, counts, {"named_ent": 0})


def coref_name_match(heads: DataFrame, spans: DataFrame) -> DataFrame:
    """``heads(doc_id, coref)``: the first mention of the pronoun's cluster.

    The mention counts as A, else as B, when either is part of the other.
    """
    coref, a, b = F.lower("coref"), F.lower("a"), F.lower("b")
    matched = F.when((F.col("coref") == ""), coref).when(
        F.contains(a, coref) | F.contains(coref, a), a
    ).when(F.contains(b, coref) | F.contains(coref, b), b).otherwise(coref)
    return spans.select("doc_id", "a", "b").join(heads, "doc_id", "left").select(
        "doc_id", matched.alias("coref"),
        F.coalesce((matched == a).cast("int"), F.lit(0)).alias("coref_a"),
        F.coalesce((matched == b).cast("int"), F.lit(0)).alias("coref_b"),
    )


def pronoun_cluster_heads(mentions: DataFrame, tokens_at: DataFrame) -> DataFrame:
    """First mention text of the cluster of the mention at the pronoun: ``doc_id, coref``.

    ``tokens_at(doc_id, tok)``: the pronoun's token; ``mentions`` carry ``tok``.
    """
    cluster = mentions.join(tokens_at, ["doc_id", "tok"]).groupBy("doc_id").agg(
        F.min_by("cluster_id", "m").alias("cluster_id")
    )
    heads = mentions.groupBy("doc_id", "cluster_id").agg(F.min_by("text", "m").alias("coref"))
    return heads.join(cluster, ["doc_id", "cluster_id"]).select("doc_id", "coref")


def cluster_membership(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """1 where some cluster holds both the pronoun and the name.

    Texts are made distinct per cluster on the map side; no pair of mentions is formed.
    """
    present = mentions.select("doc_id", "text", "cluster_id").distinct()
    roles = span_rows(spans).select("doc_id", "role", F.col("name").alias("text"))
    clusters = present.join(roles, ["doc_id", "text"]).groupBy("doc_id", "cluster_id").agg(
        *[F.bool_or(F.col("role") == r).alias(r) for r in ("a", "b", "p")]
    )
    hits = clusters.groupBy("doc_id").agg(
        F.max((F.col("p") & F.col("a")).cast("int")).alias("in_cluster_a"),
        F.max((F.col("p") & F.col("b")).cast("int")).alias("in_cluster_b"),
    )
    return _per_doc(spans, hits, {"in_cluster_a": 0, "in_cluster_b": 0})


def cluster_membership_by_parts(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """As above, or every word of the name is a mention of the cluster; first cluster that hits.

    Clusters are taken in order of their id. The third flag is 1 when neither name was found.
    """
    def parts(name: str) -> Column:
        return F.array_distinct(F.filter(F.split(F.col(name), r"\s+"), lambda w: w != ""))

    wanted = spans.select("doc_id", "a", "b", "pronoun", parts("a").alias("_pa"), parts("b").alias("_pb"))
    # One row per text that matters in a document: its three spans and the words of its names.
    keys = wanted.select(
        "doc_id",
        F.explode(F.array_distinct(F.concat(F.array("a", "b", "pronoun"), "_pa", "_pb"))).alias("text"),
    )
    # Distinct before the join, so a repeated text is no hot key; the sets hold only span texts.
    present = mentions.select("doc_id", "text", "cluster_id").distinct().join(keys, ["doc_id", "text"])
    clusters = present.groupBy("doc_id", "cluster_id").agg(F.collect_set("text").alias("_texts"))
    joined = clusters.join(wanted, "doc_id").where(F.array_contains("_texts", F.col("pronoun")))

    def hit(name: str, words: str) -> Column:
        whole = F.array_contains("_texts", F.col(name))
        return (whole | (F.size(F.array_except(words, "_texts")) == 0)).cast("int")

    scored = joined.select("doc_id", "cluster_id", hit("a", "_pa").alias("a"), hit("b", "_pb").alias("b"))
    best = scored.where("a = 1 or b = 1").groupBy("doc_id").agg(
        F.min_by(F.struct("a", "b"), "cluster_id").alias("f")
    ).select("doc_id", F.col("f.a").alias("parts_a"), F.col("f.b").alias("parts_b"))
    return _per_doc(spans, best, {"parts_a": 0, "parts_b": 0}).withColumn(
        "parts_neither", F.greatest(1 - F.col("parts_a") - F.col("parts_b"), F.lit(0))
    )


def _mention_roles(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """Mentions equal to a span's text: ``doc_id, m, role``."""
    texts = span_rows(spans).select("doc_id", "role", F.col("name").alias("text"))
    return mentions.select("doc_id", "m", "text").join(texts, ["doc_id", "text"]).select("doc_id", "m", "role")


def antecedent_match(mentions: DataFrame, antecedents: DataFrame, spans: DataFrame) -> DataFrame:
    """First mention of the pronoun and of each name; a hit if one's best antecedent is the other.

    The best antecedent has the highest score above 0, the smallest index on ties.
    """
    firsts = _mention_roles(mentions, spans).groupBy("doc_id", "role").agg(F.min("m").alias("m"))
    best = (
        antecedents.where("score > 0")
        .groupBy("doc_id", "m")
        .agg(F.max_by("ant", F.struct(F.col("score"), -F.col("ant"))).alias("ant"))
    )
    names = mentions.select("doc_id", F.col("m").alias("ant"), F.col("text").alias("ant_text"))
    linked = (
        firsts.join(best, ["doc_id", "m"], "left")
        .join(names, ["doc_id", "ant"], "left")
        .groupBy("doc_id")
        .agg(
            *[
                F.max(F.when(F.col("role") == r, F.coalesce("ant_text", F.lit("")))).alias(f"_{r}")
                for r in ("a", "b", "p")
            ]
        )
    )

    def hit(role: str) -> Column:
        name = F.col(role)
        both = F.col(f"_{role}").isNotNull() & F.col("_p").isNotNull()
        return (both & ((F.col(f"_{role}") == F.col("pronoun")) | (F.col("_p") == name))).cast("int")

    rows = spans.select("doc_id", "a", "b", "pronoun").join(linked, "doc_id", "left")
    return rows.select("doc_id", hit("a").alias("ante_a"), hit("b").alias("ante_b")).withColumn(
        "ante_neither", F.greatest(1 - F.col("ante_a") - F.col("ante_b"), F.lit(0))
    )


def join_mention_pairs(mentions: DataFrame, antecedents: DataFrame, spans: DataFrame) -> DataFrame:
    """Highest positive score from pronoun to name mentions and back; 0 where there is none.

    Goes along the antecedent rows, so mentions of a document are never paired with each other.
    """
    roles = _mention_roles(mentions, spans)
    left = roles.withColumnRenamed("role", "from_role")
    right = roles.select("doc_id", F.col("m").alias("ant"), F.col("role").alias("to_role"))
    scored = antecedents.where("score > 0").join(left, ["doc_id", "m"]).join(right, ["doc_id", "ant"])
    wanted = {"p_a": ("p", "a"), "p_b": ("p", "b"), "a_p": ("a", "p"), "b_p": ("b", "p")}
    table = scored.groupBy("doc_id").agg(
        *[
            F.max(F.when((F.col("from_role") == x) & (F.col("to_role") == y), F.col("score"))).alias(out)
            for out, (x, y) in wanted.items()
        ]
    )
    return _per_doc(spans, table, {out: 0.0 for out in wanted})


def mention_head_score(words: DataFrame, spans: DataFrame) -> DataFrame:
    """``words(doc_id, m, text, head_score)``: score of each span's text, else the mean over its
    words that occur, else 0. The first occurrence of a text counts."""
    first = words.groupBy("doc_id", "text").agg(F.min_by("head_score", "m").alias("score"))
    named = span_rows(spans)
    whole = named.select("doc_id", "role", F.col("name").alias("text"), F.lit(True).alias("whole"))
    parts = named.select("doc_id", "role", F.explode(F.split("name", r"\s+")).alias("text"), F.lit(False).alias("whole"))
    scores = (
        whole.unionByName(parts.where("text <> ''"))
        .join(first, ["doc_id", "text"])
        .groupBy("doc_id", "role")
        .agg(
            F.max(F.when(F.col("whole"), F.col("score"))).alias("w"),
            F.avg(F.when(~F.col("whole"), F.col("score"))).alias("p"),
        )
    )
    table = scores.groupBy("doc_id").agg(
        *[F.max(F.when(F.col("role") == r, F.coalesce("w", "p"))).alias(f"{r}_score") for r in ("a", "b", "p")]
    )
    return _per_doc(spans, table, {f"{r}_score": 0.0 for r in ("a", "b", "p")})


# --- ordered fallback -------------------------------------------------------------------------

def heuristic_sieve(candidates: list[Column]) -> Column:
    """The first candidate that decides; most precise first."""
    return F.coalesce(*candidates)


def sieve_prefixes(rows: DataFrame, candidates: dict[str, Column], keep: list[str]) -> DataFrame:
    """The sieve's answer as passes are added, from the last candidate towards the first.

    Long form ``keep..., pass_name, answer``, one row per pass.
    """
    names = list(candidates)
    passes = [
        F.struct(F.lit(names[i]).alias("pass_name"), heuristic_sieve(list(candidates.values())[i:]).alias("answer"))
        for i in range(len(names))
    ]
    return rows.select(*keep, F.inline(F.array(*passes)))


def token_distance_choice() -> Column:
    """The name starting closer to the pronoun; A on ties."""
    a, b = F.abs(F.col("p_off") - F.col("a_off")), F.abs(F.col("p_off") - F.col("b_off"))
    return F.when(a <= b, "A").otherwise("B")


def url_choice(a_in_url: Column, b_in_url: Column) -> Column:
    """The name in the page title when exactly one is."""
    return F.when((a_in_url == 1) & (b_in_url == 0), "A").when((b_in_url == 1) & (a_in_url == 0), "B")


# --- starred text -----------------------------------------------------------------------------

def starred_terms(texts: DataFrame) -> DataFrame:
    """Distinct runs of letters and stars worth looking up."""
    return _starred_runs(texts).select("star").distinct()


def _starred_runs(texts: DataFrame) -> DataFrame:
    """``doc_id, star``, once per document: four characters or more, at least two of them letters."""
    runs = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z*]*\*[A-Za-z*]*"), F.lit(0)))
    stars = F.length("star") - F.length(F.replace("star", F.lit("*"), F.lit("")))
    return texts.select("doc_id", F.explode(runs).alias("star")).where(
        (F.length("star") >= 4) & (stars < F.length("star") - 1)
    )


def join_wildcard(stars: DataFrame, vocab: DataFrame) -> DataFrame:
    """``star, term``: the first vocabulary term (by ``ord``) of equal length with '*' for any letter.

    A term is offered once per mask (places of the stars) that occurs at its length, with its own
    letters starred there, so the match is equality of the whole text. The runs are written out:
    if few they are sent to the offers, if many both sides are shuffled, and a hot length or run can be split.
    """
    asked = cut_lineage(stars.select("star").distinct())
    masks = asked.select(
        F.regexp_replace("star", "[^*]", ".").alias("mask"), F.length("star").alias("n")
    ).distinct()
    letters = F.zip_with(
        F.split("term", ""), F.split("mask", ""), lambda c, m: F.when(m == "*", m).otherwise(c)
    )
    offered = vocab.select("term", "ord", F.length("term").alias("n")).join(masks, "n").select(
        F.array_join(letters, "").alias("star"), "term", "ord"
    )
    return offered.join(asked, "star", "left_semi").groupBy("star").agg(F.min_by("term", "ord").alias("term"))


def normalise_starred_text(texts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Rewrite every starred run that matches a vocabulary term. ``texts``: ``doc_id, text``.

    The runs are written out once, looked up once per distinct run, and a document gets only its
    own replacements back.
    """
    used = cut_lineage(_starred_runs(texts))
    found = join_wildcard(used.select("star").distinct(), vocab)
    swaps = lookup(used, found, "star", "inner", measure=True).groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("star", "term"))).alias("_swap")
    )
    pieces = F.regexp_extract_all("text", F.lit(r"(?s)[A-Za-z*]+|[^A-Za-z*]+"), F.lit(0))
    rewritten = F.array_join(
        F.transform(
            pieces,
            lambda w: F.when(F.contains(w, F.lit("*")), F.coalesce(F.try_element_at("_swap", w), w)).otherwise(w),
        ),
        "",
    )
    return texts.join(swaps, "doc_id", "left").select(
        "doc_id", F.when(F.col("_swap").isNull(), F.col("text")).otherwise(rewritten).alias("text")
    )


def assemble(base: DataFrame, tables: list[DataFrame], on: str = "doc_id") -> DataFrame:
    """All feature tables next to each other on the row key; each has one row per key."""
    return reduce(lambda x, t: x.join(t, on, "left"), tables, base)
