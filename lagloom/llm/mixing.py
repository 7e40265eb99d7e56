"""Mixing documents to target weights with soft membership in domains.

A softmax regression, fitted on a bounded sample of a labelled table, gives every document a posterior over domains. With
a_d = posterior times tokens as the column of document d, rates r >= 0 are sought whose expected token totals A r meet
the targets t. Projected gradient descent on the squared error, measured in the metric of (A A')^-1 over the documents
with a rate above zero so that a step of one is right, starts at equal rates:

    r <- max(0, r + a_d . y),    y = (A A')^-1 (t - A r)

Each step is one aggregate over the documents; only the domain totals, one number per domain, come to the driver, and
a rate is computed in its row from the list of steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from lagloom.llm.common import fresh, raw, slices
from lagloom.session import cut_lineage

SAMPLE = 4000  # labelled documents the classifier is fitted on, at most
FEATURES = 1 << 15
RARE = 5  # a feature needs so many documents of one domain to get a weight
HELD = 1 << 17  # words whose features a task keeps
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Features:
    """Hashed features of a text: its distinct words without punctuation, and the punctuation that follows words."""

    def __init__(self) -> None:
        self.held: dict[bytes, tuple[int, ...]] = {}

    def of(self, token: bytes) -> tuple[int, ...]:
        bare = token.strip(PUNCTUATION)
        tail = token[len(token.rstrip(PUNCTUATION)) :]
        return tuple(xxhash.xxh32_intdigest(x, seed) % FEATURES for seed, x in ((1, bare), (2, tail)) if x)

    def __call__(self, text: bytes) -> tuple[int, list[int]]:
        """Number of words, distinct features."""
        words = text.translate(LOWER).split()
        if len(self.held) > HELD:
            self.held.clear()
        out: set[int] = set()
        for token in set(words):
            own = self.held.get(token)
            if own is None:
                own = self.held[token] = self.of(token)
            out.update(own)
        return len(words), sorted(out)


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # features x domains
    bias: np.ndarray

    def posteriors(self, features: list[list[int]]) -> np.ndarray:
        counts = np.array([len(f) for f in features], dtype=np.int64)
        flat = np.fromiter((i for f in features for i in f), dtype=np.int64, count=int(counts.sum()))
        owner = np.repeat(np.arange(len(features)), counts)
        logits = np.stack([np.bincount(owner, self.weights[flat, k], minlength=len(features)) for k in range(len(self.domains))], axis=1)
        logits = logits + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def fit(features: list[list[int]], domains: list[str], steps: int = 80, ridge: float = 0.3) -> Classifier:
    """Softmax regression by full-batch adaptive gradient steps."""
    names = sorted(set(domains))
    model = Classifier(names, np.zeros((FEATURES, len(names))), np.zeros(len(names)))
    if len(names) < 2:
        return model
    target = np.eye(len(names))[[names.index(d) for d in domains]]
    counts = np.array([len(f) for f in features], dtype=np.int64)
    flat = np.fromiter((i for f in features for i in f), dtype=np.int64, count=int(counts.sum()))
    owner = np.repeat(np.arange(len(features)), counts)
    domain = target.argmax(axis=1)[owner]
    within = np.stack([np.bincount(flat[domain == k], minlength=FEATURES) for k in range(len(names))])
    common = np.flatnonzero(within.max(axis=0) >= RARE)
    column = np.full(FEATURES, -1, dtype=np.int64)
    column[common] = np.arange(len(common))
    use = column[flat] >= 0
    row, at = owner[use], column[flat[use]]  # the ones of a documents x features matrix
    weights, seen = np.zeros((len(common), len(names))), np.full((len(common), len(names)), 1e-8)
    bias, seen_bias = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(steps):
        logits = np.stack([np.bincount(row, w[at], minlength=len(features)) for w in weights.T], axis=1) + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - target) / len(features)
        slope = np.stack([np.bincount(at, e[row], minlength=len(common)) for e in error.T], axis=1).astype(float)
        slope += ridge * weights / len(features) ** 0.5
        seen += slope**2
        weights -= 0.1 * slope / np.sqrt(seen)
        own = error.sum(axis=0)
        seen_bias += own**2
        bias -= 0.1 * own / np.sqrt(seen_bias)
    model.weights[common] = weights
    return Classifier(names, model.weights, bias)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features = Features()
    for batch in slices(batches, "text", 2 << 20):
        found = [features(t)[1] for t in raw(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("domain"), pa.array(found, pa.list_(pa.int64()))], ["domain", "features"])


def fit_domains(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Classifier of ``labelled`` (doc_id, domain), fitted on at most ``sample`` of its documents.

    The sample is drawn by a hash of the id. Rows without id, domain or text give nothing.
    """
    known = labelled.where("doc_id is not null and domain is not null").select("doc_id", "domain").distinct()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    n = known.count()
    few = known.where(draw < 1.5 * sample / max(n, 1)).orderBy(draw, "doc_id", "domain").limit(sample)
    # at most ``sample`` short rows
    joined = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(few), "doc_id")
    rows = joined.select("domain", "text").mapInArrow(_counted, "domain string, features array<long>").collect()
    rows = sorted(rows, key=lambda r: (r.domain, r.features))
    return fit([list(r.features) for r in rows], [r.domain for r in rows])


def with_posteriors(docs: DataFrame, model: Classifier, tokens: str = "_tokens", posterior: str = "_posterior") -> DataFrame:
    """``docs`` with ``tokens`` (words) and ``posterior``; a text without words has 0 tokens and the domains' base rates."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, "text", 2 << 20):
            found = [features(t or b"") for t in raw(batch.column("text"))]
            p = model.posteriors([f for _, f in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([n for n, _ in found], pa.int64()), pa.array(list(p), pa.list_(pa.float64()))], [*names, tokens, posterior]
            )

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(tokens, LongType()), StructField(posterior, ArrayType(DoubleType()))]))


@dataclass
class Rates:
    """Start and steps of the descent; ``of`` is the rate as an expression on a row."""

    start: float
    steps: list[list[float]]
    totals: list[float]  # expected tokens per domain at these rates
    targets: list[float]

    def of(self, posterior: Column, tokens: Column) -> Column:
        a = F.transform(posterior, lambda p: p * tokens)
        if not self.steps:
            return F.lit(self.start)
        steps = F.array(*(F.array(*map(F.lit, y)) for y in self.steps))
        dot = lambda y: F.aggregate(F.zip_with(a, y, lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
        return F.aggregate(steps, F.lit(self.start), lambda r, y: F.greatest(F.lit(0.0), r + dot(y)))


def fit_rates(members: DataFrame, domains: list[str], shares: dict[str, float], most: int = 30, close: float = 1e-6) -> Rates:
    """Rates for ``members`` (_tokens, _posterior) whose expected totals follow ``shares``.

    The total is what the documents hold, so the rates of a scarce domain rise above one. Domains missing in ``shares`` get none.
    """
    k = len(domains)
    part = [F.col("_posterior")[i] * F.col("_tokens") for i in range(k)]
    sums = [F.sum(p).alias(f"s{i}") for i, p in enumerate(part)]
    first = members.agg(*sums).first()
    have = np.array([first[f"s{i}"] or 0.0 for i in range(k)])
    share = np.array([max(0.0, shares.get(d, 0.0)) for d in domains])
    if have.sum() <= 0 or share.sum() <= 0:
        return Rates(1.0, [], have.tolist(), have.tolist())
    share = share / share.sum()
    total = float(have.sum())
    target = share * total
    out = Rates(1.0, [], [], target.tolist())
    while True:
        rated = members.withColumn("_rate", out.of(F.col("_posterior"), F.col("_tokens")))
        moving = [F.sum(F.when(F.col("_rate") > 0, part[i] * part[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]
        row = rated.agg(*(F.sum(p * F.col("_rate")).alias(f"s{i}") for i, p in enumerate(part)), *moving).first()
        out.totals = [row[f"s{i}"] or 0.0 for i in range(k)]
        miss = target - np.array(out.totals)
        if len(out.steps) >= most or np.abs(miss).max() <= close * total:
            return out
        gram = np.array([[row[f"g{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
        out.steps.append((np.linalg.pinv(gram) @ miss).tolist())


def copies(rate: Column, *key: str) -> Column:
    """Whole copies with the rate as mean: rounded up or down by a hash of ``key``."""
    draw = F.pmod(F.xxhash64(*key, F.lit(13)), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(rate + draw).cast("long")


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labels table: toxic, good (of quality) and plain; a row without quality has none."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")
    return labels.select("doc_id", domain.alias("domain"))


SHARES = {"good": 0.85, "plain": 0.1, "toxic": 0.05}


def mixing_rates(docs: DataFrame, labelled: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(doc_id, n_tokens, domain, one p_<domain> per domain, rate, copies) for every row of ``docs``.

    ``domain`` is the likeliest one. Without labels there is one domain less than needed to mix: every rate is 1,
    domain and posteriors are null. Repeated rows have the same rate each; null and empty texts have no tokens and the starting rate.
    """
    model = fit_domains(docs, labelled)
    plain = docs.select("doc_id", "text")
    if not model.domains:
        tokens = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")).cast("long")
        none = F.lit(None).cast("double")
        return plain.select(
            "doc_id", tokens.alias("n_tokens"), F.lit(None).cast("string").alias("domain"), *(none.alias(f"p_{d}") for d in sorted(shares)),
            F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"),
        )
    members = cut_lineage(with_posteriors(plain, model).select("doc_id", "_tokens", "_posterior"))
    rate = fit_rates(members, model.domains, shares).of(F.col("_posterior"), F.col("_tokens"))
    names = F.array(*map(F.lit, model.domains))
    return members.withColumn("rate", rate).select(
        "doc_id", F.col("_tokens").alias("n_tokens"),
        F.element_at(names, F.array_position("_posterior", F.array_max("_posterior")).cast("int")).alias("domain"),
        *(F.col("_posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)),
        "rate", copies(F.col("rate"), "doc_id", "_tokens").alias("copies"),
    )


def mix(docs: DataFrame, labelled: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Rows of ``docs``, each as often as its rate says; columns stay as they are."""
    model = fit_domains(docs, labelled)
    if not model.domains:
        return docs
    members = cut_lineage(with_posteriors(docs.select("text"), model).select("_tokens", "_posterior"))
    rates = fit_rates(members, model.domains, shares)
    names = docs.columns
    tokens, posterior, times, copy = (fresh(c, names) for c in ("_tokens", "_posterior", "_copies", "_copy"))
    # posteriors are found anew beside the rows: cheaper than moving texts to a join; each text goes to Python once
    scored = with_posteriors(docs, model, tokens, posterior)
    rated = scored.withColumn(times, copies(rates.of(F.col(posterior), F.col(tokens)), "doc_id", tokens)).where(F.col(times) > 0)
    return rated.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(names)
