"""Dense networks with one hidden layer, cross-validated: all seeds and folds are stepped in one scan a round.

A round starts from the same weights everywhere. Each task takes its rows in chunks of at most ``chunk`` rows, walks each chunk
``passes`` times in mini-batches by adaptive gradient steps, all networks side by side, and sends one vector per network;
the mean of these vectors, weighted by rows, starts the next round. A table of one chunk is therefore plain mini-batch descent.
The scan of a round also adds up every network's loss on the fold it does not learn from, at the weights it started with. A network
whose loss has not improved for ``patience`` passes stops, and keeps the weights of its best round.

The driver holds weights, whose size the settings bound, never rows. Batches are drawn by hashes of seed, round and chunk, so a
task that runs again draws the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from lagloom.operators import blend
from lagloom.session import cut_lineage, discard

EPSILON, KEEP = 1e-3, 0.99  # of the normalisation: added to the variance, share of the old running mean
MOMENTS = (0.9, 0.999)


@dataclass(frozen=True)
class Settings:
    """``batch`` rows are drawn at once, of which a network learns from those outside its fold. ``ridge`` weighs the squares of
    the output weights, ``drop`` is the share of hidden values left out in a step."""

    hidden: int = 37
    drop: float = 0.6
    rate: float = 0.001
    ridge: float = 0.1
    batch: int = 40
    epochs: int = 1000
    patience: int = 100
    passes: int = 10
    chunk: int = 4096
    classes: int = 3


@dataclass
class Network:
    seed: int
    fold: int
    weights: np.ndarray
    best: np.ndarray = field(default=None)
    loss: float = float("inf")
    best_epoch: int = 0
    epoch: int = 0
    stopped: bool = False

    def judge(self, loss: float | None, patience: int) -> None:
        """Take the loss of the held fold at the present weights; without held rows the last weights are the best."""
        if loss is None or loss < self.loss:
            self.best, self.best_epoch = self.weights, self.epoch
            self.loss = self.loss if loss is None else loss
        elif not loss < float("inf") or self.epoch - self.best_epoch >= patience:
            self.stopped = True


class Shapes:
    """Names the parts of a vector: weights, running statistics, and the two moments of every weight."""

    def __init__(self, width: int, hidden: int, classes: int) -> None:
        own = {"w1": (width, hidden), "b1": (hidden,), "scale": (hidden,), "shift": (hidden,), "w2": (hidden, classes), "b2": (classes,)}
        self.learned = list(own)
        self.parts = own | {"mean": (hidden,), "var": (hidden,)} | {f"{m}_{k}": s for m in ("first", "second") for k, s in own.items()} | {"steps": ()}
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights whose spread follows the sizes of both layers, from the seed alone."""
        draw, out = np.random.default_rng(seed), {k: np.zeros(s) for k, s in self.parts.items()}
        for name in ("w1", "w2"):
            limit = (6 / sum(self.parts[name])) ** 0.5
            out[name] = draw.uniform(-limit, limit, self.parts[name])
        out["scale"] += 1
        out["var"] += 1
        return np.concatenate([out[k].ravel() for k in self.parts])

    def split(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """Views on the parts of several vectors, one network a row."""
        out, at = {}, 0
        for name, shape in self.parts.items():
            n = int(np.prod(shape))
            out[name] = vectors[:, at : at + n].reshape(len(vectors), *shape)
            at += n
        return out


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def predict(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """networks x rows x classes, with the running statistics and every hidden value."""
    z = np.matmul(x, p["w1"]) + p["b1"][:, None]
    z = (z - p["mean"][:, None]) / np.sqrt(p["var"][:, None] + EPSILON) * p["scale"][:, None] + p["shift"][:, None]
    return softmax(np.matmul(np.maximum(z, 0), p["w2"]) + p["b2"][:, None])


def gradients(
    p: dict[str, np.ndarray], x: np.ndarray, target: np.ndarray, mask: np.ndarray, keep: np.ndarray, ridge: float
) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Gradients of the mean loss over the rows that ``mask`` (networks x rows) keeps; mean and variance of the hidden sums."""
    share = (mask / np.maximum(mask.sum(axis=1, keepdims=True), 1))[:, :, None]
    z = np.matmul(x, p["w1"]) + p["b1"][:, None]
    mean = (share * z).sum(axis=1)
    var = (share * (z - mean[:, None]) ** 2).sum(axis=1)
    spread = np.sqrt(var + EPSILON)[:, None]
    bare = (z - mean[:, None]) / spread
    y = bare * p["scale"][:, None] + p["shift"][:, None]
    hidden = np.maximum(y, 0) * keep
    error = (softmax(np.matmul(hidden, p["w2"]) + p["b2"][:, None]) - target) * share
    back = np.matmul(error, p["w2"].transpose(0, 2, 1)) * keep * (y > 0)
    scaled = back * p["scale"][:, None]
    inner = (scaled - share * scaled.sum(axis=1, keepdims=True) - share * bare * (scaled * bare).sum(axis=1, keepdims=True)) / spread
    out = {
        "w1": np.matmul(x.T, inner), "b1": inner.sum(axis=1), "scale": (back * bare).sum(axis=1), "shift": back.sum(axis=1),
        "w2": np.matmul(hidden.transpose(0, 2, 1), error) + 2 * ridge * p["w2"], "b2": error.sum(axis=1),
    }
    return out, mean, var


def descend(vectors: np.ndarray, shapes: Shapes, x: np.ndarray, label: np.ndarray, learns: np.ndarray, s: Settings, draw: np.random.Generator) -> None:
    """``passes`` walks over a chunk; ``learns`` (networks x rows) says which network learns from which row."""
    p = shapes.split(vectors)
    target = np.eye(s.classes)[label]
    for _ in range(s.passes):
        order = draw.permutation(len(x))
        for at in range(0, len(x), s.batch):
            rows = order[at : at + s.batch]
            mask = learns[:, rows].astype(float)
            some = mask.any(axis=1)
            keep = (draw.random((len(vectors), len(rows), s.hidden)) >= s.drop) / (1 - s.drop)
            slopes, mean, var = gradients(p, x[rows], target[rows], mask, keep, s.ridge)
            p["steps"] += some
            for name, new in (("mean", mean), ("var", var)):
                p[name][some] = KEEP * p[name][some] + (1 - KEEP) * new[some]
            count = np.maximum(p["steps"], 1)
            for name, slope in slopes.items():
                shaped = (-1,) + (1,) * (slope.ndim - 1)
                first, second = p[f"first_{name}"], p[f"second_{name}"]
                first[some] = MOMENTS[0] * first[some] + (1 - MOMENTS[0]) * slope[some]
                second[some] = MOMENTS[1] * second[some] + (1 - MOMENTS[1]) * slope[some] ** 2
                level = (1 - MOMENTS[0] ** count).reshape(shaped), (1 - MOMENTS[1] ** count).reshape(shaped)
                step = s.rate * (first / level[0]) / (np.sqrt(second / level[1]) + 1e-7)
                p[name][some] -= step[some]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows of a task in tables of ``most`` rows, the last may be shorter."""
    held, n = [], 0
    for batch in batches:
        while len(batch):
            part = batch.slice(0, most - n)
            batch = batch.slice(len(part))
            held.append(part)
            n += len(part)
            if n == most:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _round(rows: DataFrame, nets: list[Network], at: dict[int, int], width: int, shapes: Shapes, s: Settings, number: int) -> dict[int, tuple]:
    """By network: rows learned from, mean of the new vectors, rows held, sum of their losses at the old vectors."""
    start = np.stack([n.weights for n in nets])
    columns, folds = [at[n.seed] for n in nets], np.array([n.fold for n in nets])
    schema = "net int, vector array<double>, n double, held long, loss double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, s.chunk):
            x = _matrix(table.column("x").combine_chunks(), width)
            label = table.column("label").to_numpy()
            fold = _matrix(table.column("folds").combine_chunks(), len(at))[:, columns].T
            held = fold == folds[:, None]
            right = np.take_along_axis(predict(shapes.split(start), x), np.broadcast_to(label[None, :, None], (len(nets), len(x), 1)), axis=2)[:, :, 0]
            loss = (-np.log(np.clip(right, 1e-15, 1)) * held).sum(axis=1)
            vectors = start.copy()
            first = int(abs(x[0]).sum() * 1e6) % (1 << 31)
            descend(vectors, shapes, x, label, ~held, s, np.random.default_rng([number, len(x), first]))
            learned = (~held).sum(axis=1).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(nets), dtype=np.int32)), pa.array(list(vectors), pa.list_(pa.float64())), pa.array(learned),
                 pa.array(held.sum(axis=1)), pa.array(loss)],
                ["net", "vector", "n", "held", "loss"],
            )

    # a chunk with nothing to learn from keeps the old vector; a hair of weight lets a network that never learns have a mean
    sent = rows.mapInArrow(run, schema).withColumn("vector", array_to_vector("vector"))
    mean = Summarizer.mean(F.col("vector"), F.greatest("n", F.lit(1e-9)))
    got = sent.groupBy("net").agg(mean.alias("vector"), F.sum("held").alias("held"), F.sum("loss").alias("loss"))
    return {r.net: (r.vector.toArray(), r.held, r.loss) for r in got.collect()}


def fit(rows: DataFrame, width: int, folds: int, seeds: tuple[int, ...], s: Settings) -> list[Network]:
    """Networks of all seeds and folds on ``rows`` (x, label, folds: one fold per seed, all without nulls)."""
    shapes, at = Shapes(width, s.hidden, s.classes), {seed: i for i, seed in enumerate(seeds)}
    nets = [Network(seed, k, shapes.start(seed)) for seed in seeds for k in range(folds)]
    for number in range(-(-s.epochs // s.passes) + 1):
        active = [n for n in nets if not n.stopped]
        if not active:
            break
        got = _round(rows, active, at, width, shapes, s, number)
        for i, net in enumerate(active):
            if i not in got:  # no rows at all
                net.judge(None, s.patience)
                net.stopped = True
                continue
            vector, held, loss = got[i]
            net.judge(loss / held if held else None, s.patience)
            if not net.stopped and net.epoch < s.epochs:
                net.weights, net.epoch = vector, net.epoch + s.passes
    return nets


def _scored(df: DataFrame, nets: list[Network], width: int, s: Settings, seeds: tuple[int, ...] | None) -> DataFrame:
    """A row per row and network: of the network's own fold if ``seeds`` names the columns of ``folds``, else of all."""
    shapes = Shapes(width, s.hidden, s.classes)
    best = np.stack([n.best for n in nets])
    kept = [(n.seed, n.fold, n.best_epoch, n.epoch, n.loss if np.isfinite(n.loss) else None) for n in nets]
    names = ["id", "seed", "fold", "best_epoch", "last_epoch", "fold_loss", *(f"p{i}" for i in range(s.classes))]
    ints = [StructField(c, IntegerType()) for c in names[1:5]]
    schema = StructType([df.schema["id"], *ints, *(StructField(c, DoubleType()) for c in names[5:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, s.chunk):
            x = _matrix(table.column("x").combine_chunks(), width)
            p = predict(shapes.split(best), x)
            fold = _matrix(table.column("folds").combine_chunks(), len(seeds)) if seeds else None
            for i, (seed, k, *more) in enumerate(kept):
                own = np.arange(len(x)) if seeds is None else np.flatnonzero(fold[:, seeds.index(seed)] == k)
                ids = table.column("id").take(pa.array(own)).combine_chunks()
                fixed = [pa.array([v] * len(own), t) for v, t in zip((seed, k, *more), [pa.int32()] * 4 + [pa.float64()], strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *fixed, *(pa.array(p[i, own, c]) for c in range(s.classes))], names)

    return df.mapInArrow(run, schema)


def mlp_classifier_cv(
    train: DataFrame, test: DataFrame, width: int, label: str = "label", folds: int = 5, seeds: tuple[int, ...] = (1, 6003, 10000007),
    settings: Settings | None = None,
) -> DataFrame:
    """``part, id, seed, fold, best_epoch, last_epoch, fold_loss, p0..`` of a network per seed and fold.

    ``part`` is 'oof' for the held-out rows of a fold and 'test' for the test rows. ``features`` is a vector of ``width`` numbers; a
    row without it, or holding NaN, is neither learned from nor scored, nor is a training row without label. ``best_epoch`` is the pass
    whose weights are kept, ``last_epoch`` the pass the network stopped at. A fold without rows keeps the last weights.
    """
    s = settings or Settings()
    x = vector_to_array("features").alias("x")
    whole = lambda df: df.where((F.size("x") == width) & ~F.exists("x", F.isnan))
    assigned = F.array(*(blend.kfold_assign(F.col("id"), folds, seed) for seed in seeds)).alias("folds")
    known = train.where(F.col("features").isNotNull() & F.col(label).isNotNull() & F.col("id").isNotNull())
    rows = cut_lineage(whole(known.select("id", x, F.col(label).cast("int").alias("label"), assigned)))
    n = rows.count()
    dealt = cut_lineage(rows.repartition(max(1, -(-n // s.chunk)), F.xxhash64("id")).sortWithinPartitions(F.xxhash64("id"), "label", "x"))
    discard(rows)
    nets = fit(dealt.select("x", "label", "folds"), width, folds, seeds, s)
    oof = _scored(dealt.select("id", "x", "folds"), nets, width, s, seeds)
    asked = _scored(whole(test.where("features is not null").select("id", x)), nets, width, s, None)
    return oof.select(F.lit("oof").alias("part"), "*").unionByName(asked.select(F.lit("test").alias("part"), "*"))
