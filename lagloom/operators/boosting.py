"""Second-order boosted trees on binned columns, any number of models in one scan a round.

Features are cut once into at most BINS bins at approximate percentiles, and rows are kept in blocks, column by column. A round grows
one tree per model, or one per class under the softmax loss. Where the bins of a tree's columns have at most COMBINED combinations,
one scan adds the gradients and curvatures of the rows per combination, and the whole tree grows from these sums in one task.
Other trees grow level by level: each task adds per (tree, node, feature, bin), running sums over the bins give
the gain of every split, and one row per open node, its best split, comes to the driver. The number of the tree is a key of both
aggregates, so folds, repeats and a whole parameter grid share their scans as far as their sums fit in a task (HELD cells).
The driver holds the trees and the cuts, whose size the settings bound, never rows.

Margins are those of the trees since they were last written; every KEEP rounds they are written with the blocks to the shared folder.
Samples of rows and columns come from hashes of the row's id and of (seed, model, round), so a repeated task draws the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from lagloom.operators import blend, metrics
from lagloom.session import cut_lineage, discard, widen, without_leftovers

BINS, KEEP = 256, 10
DENSE = 1 << 20  # cells of one tree that a task adds up before it sends them
COMBINED = 1 << 18  # combinations of bins up to which a tree grows from one scan
HELD = 1 << 21  # cells that a task adds up in one scan, of all trees
PIECE = 1 << 16  # cells of a tree that are sent and added up together
BLOCK, BLOCK_BYTES = 1 << 16, 4 << 20  # rows and bytes of a block at most
TOGETHER = 80  # features whose cuts are found in one scan
TABLE = 1 << 22  # places of the tables by which rows find their leaves, of all trees
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """``rate`` shrinks a tree, ``child`` is the least curvature of a child, ``penalty`` what a split must gain, ``ridge`` is added
    to the curvature of a node. ``rows`` and ``columns`` are sampled per tree, ``level_columns`` of these per level."""

    loss: str = "logistic"
    rounds: int = 500
    depth: int = 9
    rate: float = 0.05
    child: float = 1.0
    penalty: float = 0.7
    ridge: float = 1.0
    rows: float = 0.85
    columns: float = 0.6
    level_columns: float = 1.0
    classes: int = 1
    seed: int = 1122


# Settings of the published fits, the first and the second stage, the regression, and the joint classifier.
BINARY = Settings()
FIRST = Settings(rate=0.009, rounds=1500, depth=13, child=0.40, rows=0.95, columns=0.65, penalty=0.77)
SECOND = Settings(rate=0.009, rounds=1000, depth=6, child=0.57, rows=0.75, columns=0.60, penalty=0.93)
REGRESSION = Settings(
    "squared", rate=0.01, rounds=1800, depth=5, child=10, penalty=1.5, ridge=0, rows=0.7, columns=0.055, level_columns=0.4, seed=7
)
JOINT = Settings("softmax", rate=0.1, rounds=100, depth=3, child=0, penalty=0, ridge=0, rows=1, columns=1, classes=3, seed=33)


@dataclass
class Model:
    """``target`` is null where a row takes no part in the fit: a class number, 0 or 1, or a value, as the loss says. With
    ``holdout``, a share and the number of a repeat, the rows of that ``holdout_split`` take no part either."""

    settings: Settings
    target: Column
    holdout: tuple[float, int] | None = None


@dataclass
class Tree:
    """Nodes in the order they were made; the children of a node stand side by side. ``feature`` is -1 at a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    opened: int = 0  # nodes from here on were made by the last level

    def walk(self, node: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row below the node it has reached; ``bins`` by (feature, row)."""
        feature, cut, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        flat, n = bins.reshape(-1), len(node)
        moving = np.flatnonzero(feature[node] >= 0)
        while len(moving):
            at = node[moving]
            node[moving] = left[at] + (flat[feature[at] * n + moving] > cut[at])
            moving = moving[feature[node[moving]] >= 0]
        return node

    def split(self, node: int, feature: int, cut: int, gain: float, values: tuple[float, float]) -> None:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, cut, len(self.feature), gain
        for value in values:
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
            self.value.append(value)
            self.gain.append(0.0)

    def prune(self, penalty: float) -> None:
        """From the bottom up, take back splits between leaves that gain less than the penalty."""
        for node in reversed(range(len(self.feature))):
            if self.feature[node] >= 0 and self.gain[node] < penalty:
                a = self.left[node]
                if self.feature[a] < 0 and self.feature[a + 1] < 0:
                    self.feature[node] = -1


class Finder:
    """Finds the leaf of every row of a tree.

    A bin matters only by the cuts of the tree below it, so the first levels, as many as ``limit`` allows, are one table over the
    combinations of these; the levels below are walked.
    """

    def __init__(self, tree: Tree, limit: int) -> None:
        depth = [0] + [-1] * (len(tree.feature) - 1)  # -1: below a split taken back
        for node, f in enumerate(tree.feature):
            if f >= 0 and depth[node] >= 0:
                depth[tree.left[node]] = depth[tree.left[node] + 1] = depth[node] + 1
        self.tree, self.value, bottom = tree, np.array(tree.value), max(depth)
        for top in range(bottom, -1, -1):
            used: dict[int, set[int]] = {}
            for node, f in enumerate(tree.feature):
                if f >= 0 and 0 <= depth[node] < top:
                    used.setdefault(f, set()).add(tree.bin[node])
            size = int(np.prod([len(c) + 1 for c in used.values()], dtype=object))
            if size <= limit:
                break
        self.whole, self.places = top == bottom, []
        seen = np.zeros((max(used, default=0) + 1, size), dtype=np.int64)
        step = size
        for f, cuts in used.items():
            own = np.array(sorted(cuts))
            step //= len(own) + 1
            self.places.append((f, np.searchsorted(own, np.arange(BINS), side="left") * step))
            seen[f] = np.append(own, BINS)[np.arange(size) // step % (len(own) + 1)]
        short = tree if self.whole else Tree([f if 0 <= d < top else -1 for f, d in zip(tree.feature, depth, strict=True)], tree.bin, tree.left)
        self.nodes = short.walk(np.zeros(size, dtype=np.int64), seen)
        self.values = self.value[self.nodes]

    def _place(self, bins: np.ndarray) -> np.ndarray | None:
        total = None
        for f, lut in self.places:
            own = np.take(lut, bins[f])
            total = own if total is None else np.add(total, own, out=total)
        return total

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        place = self._place(bins)
        node = np.full(bins.shape[1], self.nodes[0]) if place is None else np.take(self.nodes, place)
        return node if self.whole else self.tree.walk(node, bins)

    def scores(self, bins: np.ndarray) -> np.ndarray | float:
        if not self.whole:
            return self.value[self.leaves(bins)]
        place = self._place(bins)
        return self.values[0] if place is None else np.take(self.values, place)


def _finders(slots: list[list[Tree]], rows: int) -> list[list[Finder]]:
    """Finders of all trees, their tables no larger than the rows make worth while."""
    limit = min(TABLE // max(1, sum(len(t) for t in slots)), 4 * rows, 1 << 17)
    return [[Finder(t, limit) for t in trees] for trees in slots]


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A column of equally long lists, nulls as NaN."""
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(len(column), -1)


def _coded(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: how many cuts lie below it. NaN counts as above every cut."""
    if not cuts:
        return np.zeros((len(values), 0), dtype=np.uint8)
    return np.stack([np.searchsorted(c, values[:, i], side="left").astype(np.uint8) for i, c in enumerate(cuts)], axis=1)


def gradients(loss: str, margins: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives by (row, tree of the model)."""
    if loss == "squared":
        return margins - target[:, None], np.ones_like(margins)
    if loss == "logistic":
        p = 1.0 / (1.0 + np.exp(-margins))
        return p - target[:, None], p * (1.0 - p)
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    k = margins.shape[1]
    # Newton's step for k classes that share one scale
    return p - (target[:, None] == np.arange(k)), p * (1.0 - p) * k / max(k - 1, 1)


def _slots(models: list[Settings]) -> list[tuple[int, int]]:
    return [(m, k) for m, s in enumerate(models) for k in range(s.classes)]


def _drawn(key: np.ndarray, share: float, *parts: int) -> np.ndarray:
    """True for about ``share`` of the keys, differently for other parts."""
    if share >= 1:
        return np.ones(len(key), dtype=bool)
    salt = np.random.default_rng(parts).integers(0, 1 << 63, dtype=np.uint64)
    x = (key ^ salt) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.float64) < share * 2**32


def _picked(count: int, share: float, *parts: int) -> np.ndarray:
    """About ``share`` of ``count`` columns, one at least."""
    return np.sort(np.random.default_rng(parts).permutation(count)[: max(1, int(round(share * count)))])


def find_cuts(df: DataFrame, features: str, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of every element of ``features``, at most ``bins`` - 1: one aggregate over the rows as they are, none exploded."""
    shares = F.array(*[F.lit(k / (bins - 1)) for k in range(1, bins)])
    value = lambda i: F.when(~F.isnan(F.get(features, F.lit(i))), F.get(features, F.lit(i)))

    def cuts(row: Row, i: int) -> np.ndarray:
        return np.zeros(1) if row[f"low{i}"] is None else np.unique([row[f"low{i}"], *row[f"cuts{i}"]])[: bins - 1]

    found: list[np.ndarray] = []
    head = df.select(F.size(features)).first()
    width = max(0, (head[0] or 0) if head else 0)  # the first row's; the same scan tells whether there are wider ones
    while True:
        places = range(len(found), min(width, len(found) + TOGETHER))
        parts = [(F.percentile_approx(value(i), shares, 10_000).alias(f"cuts{i}"), F.min(value(i)).alias(f"low{i}")) for i in places]
        row = df.agg(F.max(F.size(features)).alias("width"), *[c for pair in parts for c in pair]).first()
        found += [cuts(row, i) for i in places]
        width = row.width or 0
        if len(found) >= width:
            return found


BLOCKS = "mark long, n int, which binary, starts binary, key binary, bins binary, base binary, taken binary, targets binary, margins binary"


class Block:
    """Some rows, column by column. Targets are one value per row and a bit per (target, row) where they differ in nothing
    but what they leave out, else a value per (target, row); ``which`` is the target of each model."""

    def __init__(self, row: dict) -> None:
        self.row, self.n = row, row["n"]
        get = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.which, self.starts = get("which", np.int32), get("starts", np.float64)
        self.key, self.bins = get("key", np.uint64), get("bins", np.uint8).reshape(-1, self.n)
        self.margins = get("margins", np.float64).reshape(-1, self.n) if row["margins"] is not None else None

    def target(self, model: int) -> tuple[np.ndarray, np.ndarray]:
        """Which rows have a target, and the target of all rows."""
        u = self.which[model]
        if self.row["targets"] is not None:
            own = np.frombuffer(self.row["targets"], dtype=np.float64).reshape(-1, self.n)[u]
            return ~np.isnan(own), own
        bits = np.frombuffer(self.row["taken"], dtype=np.uint8).reshape(-1, (self.n + 7) // 8)[u]
        return np.unpackbits(bits, count=self.n).view(bool), np.frombuffer(self.row["base"], dtype=np.float64)

    def margin(self, slot: int, finders: list[Finder]) -> np.ndarray:
        out = np.full(self.n, self.starts[slot]) if self.margins is None else self.margins[slot].copy()
        for f in finders:
            out += f.scores(self.bins)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block({c: batch.column(c)[i].as_py() if c in ("mark", "n") else batch.column(c)[i].as_buffer() for c in batch.schema.names})


def _block_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"mark": pa.int64(), "n": pa.int32()}
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in names], names)


def binned(df: DataFrame, features: str, models: list[Model], cuts: list[np.ndarray], starts: list[float]) -> DataFrame:
    """The rows that take part in a fit, as blocks: key, bins, targets and first margins."""
    columns = list({id(m.target): m.target for m in models}.values())
    places = {id(t): i for i, t in enumerate(columns)}
    distinct = list(dict.fromkeys((places[id(m.target)], m.holdout) for m in models))
    which = np.array([distinct.index((places[id(m.target)], m.holdout)) for m in models], dtype=np.int32).tobytes()
    sources = [i for i, _ in distinct]
    shares: dict[float, list[int]] = {}
    for _, held in distinct:
        if held and held[1] not in shares.setdefault(held[0], []):
            shares[held[0]].append(held[1])
    size = max(1, min(BLOCK, BLOCK_BYTES // (16 + len(cuts) + 8 * len(distinct) + 8 * len(starts))))

    def block(key: np.ndarray, bins: np.ndarray, targets: np.ndarray) -> pa.RecordBatch:
        taken = ~np.isnan(targets)
        base = np.fmax.reduce(targets, axis=0)
        alike = bool(((targets == base) | ~taken).all())
        return _block_rows([{
            "mark": int(key[0].view(np.int64)), "n": len(key), "which": which, "starts": np.array(starts).tobytes(), "key": key.tobytes(),
            "bins": np.ascontiguousarray(bins).tobytes(), "base": base.tobytes() if alike else None,
            "taken": np.packbits(taken, axis=1).tobytes() if alike else None, "targets": None if alike else targets.tobytes(), "margins": None,
        }])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            if batch.column("x").null_count:
                batch = batch.filter(pc.is_valid(batch.column("x")))
            if not batch.num_rows:
                continue
            targets = _matrix(batch.column("targets"), np.float64).T[sources]
            for share, repeats in shares.items():
                out = dict(zip(repeats, blend.holdout_rows(batch.column("id"), share, repeats), strict=True))
                for row, (_, kept) in zip(targets, distinct, strict=True):
                    if kept and kept[0] == share:
                        row[out[kept[1]]] = np.nan
            bins = _coded(_matrix(batch.column("x"), np.float64), cuts).T
            key = batch.column("key").to_numpy().view(np.uint64)
            at = np.flatnonzero(~np.isnan(targets).all(axis=0))
            held.append((key[at], bins[:, at], targets[:, at]))
            count += len(at)
            while count >= size:
                parts = [np.concatenate(p, axis=-1) for p in zip(*held, strict=True)]
                yield block(*(np.ascontiguousarray(p[..., :size]) for p in parts))
                held, count = [tuple(p[..., size:] for p in parts)], count - size
        if count:
            yield block(*(np.ascontiguousarray(np.concatenate(p, axis=-1)) for p in zip(*held, strict=True)))

    # rows without a target go in ``code``: a filter here would compute the targets twice
    targets = F.array(*[t.cast("double") for t in columns])
    ids = [F.col("id").cast("string").alias("id")] if shares else []
    rows = df.select(F.xxhash64("id").alias("key"), targets.alias("targets"), F.col(features).alias("x"), *ids)
    return rows.mapInArrow(code, BLOCKS)


def _tasks(rows: DataFrame) -> DataFrame:
    """The blocks in few tasks a core: each task sends sums of up to all cells, however few rows it has."""
    return rows.coalesce(max(2, 2 * rows.sparkSession.sparkContext.defaultParallelism))


def _spread_cells(columns: np.ndarray, widths: list[int], whole: bool) -> tuple[int, list[int]]:
    """Cells of the columns in a node, and the step or the first cell of each: combinations of bins, or bins side by side."""
    own = [widths[c] for c in columns]
    if whole:
        steps = [int(np.prod(own[i + 1 :], dtype=object)) for i in range(len(own))]
        return int(np.prod(own, dtype=object)), steps
    return sum(own), np.cumsum([0, *own[:-1]]).tolist()


def level_sums(
    rows: DataFrame, models: list[Settings], pending: list[list[Tree]], growing: list[Tree | None], columns: list[np.ndarray], round_: int = 0,
    whole: bool = False, widths: list[int] | None = None,
) -> DataFrame:
    """(tree, node, feature, bin, g, h, n): sums over the sampled rows of every open node, one scan for all trees.

    ``pending`` are the trees not yet in the margins, ``growing`` the tree of this round, None where there is none. ``widths`` has
    the number of bins of each feature. ``whole``: sums by combination of the bins of all columns, as feature -1 of the root.
    """
    slots = _slots(models)
    widths = widths or [BINS] * (1 + max(int(c) for own in columns for c in own))
    layout = [_spread_cells(c, widths, whole) for c in columns]
    nodes = [0 if t is None else 1 if whole else len(t.feature) - t.opened for t in growing]
    sizes = [count * cells for count, (cells, _) in zip(nodes, layout, strict=True)]
    packed = "tree int, piece int, at binary, g binary, h binary, n binary"

    def sent(slot: int, places: np.ndarray, sums: list[np.ndarray]) -> pa.RecordBatch:
        """``places``: those cells that are not empty, in order."""
        edges = np.searchsorted(places, np.arange(0, sizes[slot] + PIECE, PIECE))
        out = [
            (slot, i, (places[a:b] - i * PIECE).astype(np.int32).tobytes(), *(x[a:b].astype(k).tobytes() for x, k in zip(sums, (np.float64, np.float64, np.int32), strict=True)))
            for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if a < b
        ]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["tree", "piece", "at", "g", "h", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        finders: list[list[Finder]] | None = None
        for block in _blocks(batches):
            if finders is None:
                busy = {m for (m, _), t in zip(slots, growing, strict=True) if t is not None}
                finders = _finders([p if m in busy else [] for p, (m, _) in zip(pending, slots, strict=True)], block.n)
                places = [] if whole else _finders([[t] if t is not None else [] for t in growing], block.n)
            joint: dict[tuple[int, ...], np.ndarray] = {}
            for m, s in enumerate(models):
                own = [i for i, (model, _) in enumerate(slots) if model == m]
                if all(growing[i] is None for i in own):
                    continue
                has, target = block.target(m)
                at = np.flatnonzero(has & _drawn(block.key, s.rows, s.seed, m, round_))
                if not len(at):
                    continue
                margins = np.stack([block.margin(i, finders[i])[at] for i in own], axis=1)
                gs, hs = gradients(s.loss, margins, target[at])
                for slot, g, h in zip(own, gs.T, hs.T, strict=True):
                    tree = growing[slot]
                    if tree is None:
                        continue
                    cells, steps = layout[slot]
                    g, h = np.ascontiguousarray(g), np.ascontiguousarray(h)
                    if whole:
                        names = tuple(columns[slot].tolist())
                        if names not in joint:
                            joint[names] = sum(block.bins[c].astype(np.int64) * step for c, step in zip(names, steps, strict=True))
                        found = [joint[names][at]]
                    else:
                        node = places[slot][0].leaves(block.bins)[at] - tree.opened
                        live = np.flatnonzero(node >= 0)
                        base, g, h, rows_ = node[live] * cells, g[live], h[live], at[live]
                        found = [base + (step + block.bins[c][rows_].astype(np.int64)) for c, step in zip(columns[slot].tolist(), steps, strict=True)]
                    dense = sizes[slot] <= DENSE
                    if dense:
                        total = held.setdefault(slot, [np.zeros(sizes[slot]) for _ in range(3)])
                    for cell in found:
                        if dense and len(cell) * 4 < sizes[slot]:
                            for kept, w in zip(total, (g, h, 1.0), strict=True):
                                np.add.at(kept, cell, w)
                        elif dense:
                            for kept, w in zip(total, (g, h, None), strict=True):
                                kept += np.bincount(cell, w, minlength=sizes[slot])
                        elif len(cell):
                            # a tree with many cells sends those of its rows at once
                            filled, cell = np.unique(cell, return_inverse=True)
                            yield sent(slot, filled, [np.bincount(cell, w) for w in (g, h, None)])
        for slot, total in held.items():
            filled = np.flatnonzero(total[2])
            if len(filled):
                yield sent(slot, filled, [t[filled] for t in total])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, (slot, piece) in enumerate(zip(batch.column("tree").to_pylist(), batch.column("piece").to_pylist(), strict=True)):
                total = held.setdefault((slot, piece), np.zeros((3, min(PIECE, sizes[slot] - piece * PIECE))))
                get = lambda c, kind, i=i, batch=batch: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind)
                at = get("at", np.int32)  # each cell once
                for kept, c, kind in zip(total, "ghn", (np.float64, np.float64, np.int32), strict=True):
                    kept[at] += get(c, kind)
        for (slot, piece), total in held.items():
            at = np.flatnonzero(total[2])
            cell, own = at + piece * PIECE, columns[slot]
            if whole:
                node, feature, bin_ = np.zeros(len(at)), np.full(len(at), -1), cell
            else:
                cells, first = layout[slot]
                node, rest = np.divmod(cell, cells)
                which = np.searchsorted(first, rest, side="right") - 1
                node, feature, bin_ = node + growing[slot].opened, own[which], rest - np.array(first)[which]
            ints = [np.full(len(at), slot), node, feature, bin_]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c.astype(np.int32)) for c in ints), pa.array(total[0, at]), pa.array(total[1, at]), pa.array(total[2, at].astype(np.int64))],
                ["tree", "node", "feature", "bin", "g", "h", "n"],
            )

    parts = _tasks(rows).mapInArrow(add, packed).repartition("tree", "piece")
    return parts.mapInArrow(together, "tree int, node int, feature int, bin int, g double, h double, n long")


def _value(s: Settings, g: float, h: float) -> float:
    return -s.rate * g / (h + s.ridge) if h + s.ridge > 0 else 0.0


def _weight(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.divide(g * g, h, out=np.zeros_like(g), where=h != 0)


def grown_tree(s: Settings, columns: np.ndarray, levels: list[np.ndarray], widths: list[int], cell: np.ndarray, sums: list[np.ndarray]) -> Tree:
    """A tree from the sums (g, h, n) by combination of the bins of its columns; ``levels`` has the columns of each level."""
    _, steps = _spread_cells(columns, widths, True)
    bins = {c: cell // step % widths[c] for c, step in zip(columns.tolist(), steps, strict=True)}
    tree, node = Tree(), np.zeros(len(cell), dtype=np.int64)
    for own in levels[: s.depth] if len(cell) else ():
        live = np.flatnonzero(node >= tree.opened)
        count, size = len(tree.feature) - tree.opened, len(tree.feature)
        best: list[tuple | None] = [None] * count
        for c in own.tolist():
            at = (node[live] - tree.opened) * widths[c] + bins[c][live]
            g, h, n = (np.bincount(at, x[live], minlength=count * widths[c]).reshape(count, -1) for x in sums)
            gl, hl, nl = (np.cumsum(x, axis=1) for x in (g, h, n))
            gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
            gain = _weight(gl, hl + s.ridge) + _weight(gt - gl, ht - hl + s.ridge) - _weight(gt, ht + s.ridge)
            allowed = (n > 0) & (nl < nt) & (hl >= s.child) & (ht - hl >= s.child)
            score = np.where(allowed, np.round(gain, 9), -1.0)
            first = score.argmax(axis=1)
            for i, b in enumerate(first.tolist()):
                if nt[i, 0] and (best[i] is None or score[i, b] > best[i][0]):
                    best[i] = (float(score[i, b]), c, b, *(float(x) for x in (gl[i, b], hl[i, b], gt[i, 0], ht[i, 0])))
        _split(tree, s, [(i + tree.opened, *b) for i, b in enumerate(best) if b is not None])
        tree.opened = size
        if len(tree.feature) == size:
            break
        feature, cut, left = np.array(tree.feature), np.array(tree.bin), np.array(tree.left)
        for c in own.tolist():
            move = live[feature[node[live]] == c]
            at = node[move]
            node[move] = left[at] + (bins[c][move] > cut[at])
            live = live[node[live] < size]
    return tree


def _split(tree: Tree, s: Settings, best: list[tuple]) -> None:
    """Open nodes by their best splits: (node, gain, feature, bin, g and h on the left, g and h of the node)."""
    for node, gain, feature, bin_, gl, hl, g, h in best:
        if node == 0:
            tree.value[0] = _value(s, g, h)
        if gain > LEAST_GAIN:
            tree.split(node, feature, bin_, gain, (_value(s, gl, hl), _value(s, g - gl, h - hl)))


def grown_trees(sums: DataFrame, models: list[Settings], columns: list[np.ndarray], levels: list[list[np.ndarray]], widths: list[int]) -> DataFrame:
    """The trees of ``level_sums`` by combinations, one row each."""
    slots = _slots(models)

    def grow(table: pa.Table) -> pa.Table:
        slot = table.column("tree")[0].as_py()
        order = np.argsort(table.column("bin").to_numpy())
        cell, g, h, n = (table.column(c).to_numpy()[order] for c in ("bin", "g", "h", "n"))
        tree = grown_tree(models[slots[slot][0]], columns[slot], levels[slot], widths, cell.astype(np.int64), [g, h, n.astype(np.float64)])
        ints, floats = pa.list_(pa.int32()), pa.list_(pa.float64())
        return pa.table({
            "tree": pa.array([slot], pa.int32()), "feature": pa.array([tree.feature], ints), "bin": pa.array([tree.bin], ints),
            "left": pa.array([tree.left], ints), "value": pa.array([tree.value], floats), "gain": pa.array([tree.gain], floats),
        })

    return sums.groupBy("tree").applyInArrow(grow, "tree int, feature array<int>, bin array<int>, left array<int>, value array<double>, gain array<double>")


def best_splits(sums: DataFrame, models: list[Settings]) -> DataFrame:
    """The best split of every open node: ``tree, node, best`` with its gain, negative where no split is allowed."""
    slots = _slots(models)

    def own(name: str) -> Column:
        values = [float(getattr(models[m], name)) for m, _ in slots]
        return F.lit(values[0]) if len(set(values)) == 1 else F.get(F.lit(np.array(values)), F.col("tree"))

    ridge, child = own("ridge"), own("child")
    per = Window.partitionBy("tree", "node", "feature")
    running = per.orderBy("bin")
    weight = lambda g, h: F.coalesce(F.try_divide(g * g, h + ridge), F.lit(0.0))
    rows = sums.select(
        "tree", "node", "feature", "bin", F.sum("g").over(running).alias("gl"), F.sum("h").over(running).alias("hl"),
        F.sum("g").over(per).alias("g"), F.sum("h").over(per).alias("h"), F.sum("n").over(running).alias("nl"), F.sum("n").over(per).alias("n"),
    )
    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = weight(F.col("gl"), F.col("hl")) + weight(gr, hr) - weight(F.col("g"), F.col("h"))
    allowed = (F.col("nl") < F.col("n")) & (F.col("hl") >= child) & (hr >= child)
    # rounded, so that sums added in another order choose alike; then the first feature and the first bin
    score = F.when(allowed, F.round(gain, 9)).otherwise(-1.0)
    best = F.max(F.struct(score.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl", "g", "h"))
    return rows.groupBy("tree", "node").agg(best.alias("best"))


@dataclass
class Ensemble:
    settings: list[Settings]
    cuts: list[np.ndarray]
    starts: list[float]
    trees: list[list[Tree]]

    def margins(self, df: DataFrame, features: str, out: str = "margins", fold: str | None = None, folds: int = 1) -> DataFrame:
        """``df`` with one margin per tree slot: per model, or per class of a softmax model. Reads rows once, moves none.

        With ``fold``, the column of a number below ``folds``, only those of every ``folds``-th slot from that number on.
        """
        sent = df.sparkSession.sparkContext.broadcast((self.cuts, self.starts, self.trees))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cuts, starts, slots = sent.value
            finders = None
            for batch in batches:
                if batch.num_rows:
                    own = batch.column(features)
                    if own.null_count:  # a row without features counts as one of missing values
                        own = pa.array([v if v is not None else [None] * len(cuts) for v in own.to_pylist()], pa.list_(pa.float64()))
                    bins = np.ascontiguousarray(_coded(_matrix(own, np.float64), cuts).T)
                    finders = finders or _finders(slots, batch.num_rows)
                    total = np.zeros((len(starts) // folds, batch.num_rows))
                    held = batch.column(fold).to_numpy() if fold else np.zeros(batch.num_rows)
                    for k in range(folds):
                        at = np.flatnonzero(held == k)
                        mine = bins[:, at] if fold else bins
                        for row, slot in enumerate(range(k, len(starts), folds) if len(at) else ()):
                            total[row, at] = starts[slot] + sum(tree.scores(mine) for tree in finders[slot])
                    total = total.T
                    ends = np.arange(0, total.size + 1, max(1, total.shape[1]), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(total.reshape(-1)))], [*batch.schema.names, out]
                    )

        return df.mapInArrow(score, StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))]))

    def weights(self, model: int = 0) -> list[float]:
        """Share of each feature in the gains of the model's splits."""
        total = np.zeros(len(self.cuts))
        for (m, _), trees in zip(_slots(self.settings), self.trees, strict=True):
            for tree in trees if m == model else ():
                for f, gain in zip(tree.feature, tree.gain, strict=True):
                    if f >= 0:
                        total[f] += gain
        return (total / (total.sum() or 1.0)).tolist()


def first_margins(rows: DataFrame, models: list[Model]) -> list[float]:
    """First margins: even odds, a half for values, the logarithm of the class shares under softmax."""
    out: list[float] = []
    for m in models:
        s = m.settings
        if s.loss != "softmax":
            out.append(0.5 if s.loss == "squared" else 0.0)
            continue
        counts = rows.agg(*[F.count_if(m.target == k).alias(f"n{k}") for k in range(s.classes)]).first()
        total = sum(counts) or 1
        out += [float(np.log(max(n, 1e-9) / total)) for n in counts]
    return out


def _shared(slots: list[int], cells: list[int]) -> list[list[int]]:
    """The slots in groups whose cells a task can hold."""
    groups: list[list[int]] = []
    room = 0
    for i in slots:
        own = min(cells[i], DENSE)
        if not groups or own > room:
            groups.append([])
            room = HELD
        groups[-1].append(i)
        room -= own
    return groups


def fit(df: DataFrame, features: str, models: list[Model], bins: int = BINS) -> Ensemble:
    """Fit all ``models`` on the rows of ``df`` (``id``, ``features`` as array<double>) side by side."""
    settings = [m.settings for m in models]
    slots = _slots(settings)
    cuts, starts = find_cuts(df, features, bins), first_margins(df, models)
    # few bytes, read once a round or level: spread over all tasks
    rows = cut_lineage(widen(binned(df, features, models, cuts, starts), "mark"))
    done: list[list[Tree]] = [[] for _ in slots]
    pending: list[list[Tree]] = [[] for _ in slots]
    width, widths = len(cuts), [len(c) + 1 for c in cuts]
    for round_ in range(max(s.rounds for s in settings) if width else 0):
        growing: list[Tree | None] = [Tree() if round_ < settings[m].rounds else None for m, _ in slots]
        chosen = [_picked(width, settings[m].columns, settings[m].seed, m, k, round_) for m, k in slots]
        levels = [
            [c[_picked(len(c), settings[m].level_columns, settings[m].seed, m, k, round_, level)] for level in range(settings[m].depth)]
            for c, (m, k) in zip(chosen, slots, strict=True)
        ]
        only = lambda group, trees: [t if i in group else None for i, t in enumerate(trees)]
        cells = [_spread_cells(c, widths, True)[0] for c in chosen]
        grown = list(growing)
        joint = [i for i, t in enumerate(growing) if t is not None and cells[i] <= min(COMBINED, DENSE)]
        for group in _shared(joint, cells):
            sums = level_sums(rows, settings, pending, only(group, growing), chosen, round_, True, widths)
            with without_leftovers(df.sparkSession):
                made = grown_trees(sums, settings, chosen, levels, widths).collect()
            for r in made:
                grown[r.tree] = Tree(r.feature, r.bin, r.left, r.value, r.gain)
        growing = [None if i in joint else t for i, t in enumerate(growing)]
        for level in range(max(s.depth for s in settings)):
            growing = [t if t is not None and level < settings[m].depth else None for t, (m, _) in zip(growing, slots, strict=True)]
            if all(t is None for t in growing):
                break
            columns = [own[min(level, len(own) - 1)] if own else c for own, c in zip(levels, chosen, strict=True)]
            sizes = [len(t.feature) if t is not None else 0 for t in growing]
            cells = [(n - t.opened) * _spread_cells(c, widths, False)[0] if t is not None else 0 for n, t, c in zip(sizes, growing, columns, strict=True)]
            found = []
            for group in _shared([i for i, t in enumerate(growing) if t is not None], cells):
                sums = level_sums(rows, settings, pending, only(group, growing), columns, round_, False, widths)
                with without_leftovers(df.sparkSession):
                    found += best_splits(sums, settings).collect()
            for r in sorted(found, key=lambda r: (r.tree, r.node)):
                b = r.best
                _split(growing[r.tree], settings[slots[r.tree][0]], [(r.node, b.gain, -b.f, -b.b, b.gl, b.hl, b.g, b.h)])
            for i, tree in enumerate(growing):
                if tree is not None:
                    tree.opened = sizes[i]
                    if len(tree.feature) == sizes[i]:
                        growing[i] = None
        for i, tree in enumerate(grown):
            if tree is not None:
                tree.prune(settings[slots[i][0]].penalty)
                done[i].append(tree)
                pending[i].append(tree)
        if (round_ + 1) % KEEP == 0:
            last, rows = rows, cut_lineage(_advanced(rows, pending))
            discard(last)
            pending = [[] for _ in slots]
    discard(rows)
    return Ensemble(settings, cuts, starts, done)


def _advanced(rows: DataFrame, pending: list[list[Tree]]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = None
        for block in _blocks(batches):
            finders = finders or _finders(pending, block.n)
            margins = np.stack([block.margin(slot, trees) for slot, trees in enumerate(finders)])
            yield _block_rows([{c: v.to_pybytes() if isinstance(v, pa.Buffer) else v for c, v in block.row.items()} | {"margins": margins.tobytes()}])

    return rows.mapInArrow(add, BLOCKS)


# --- what is made of fits -------------------------------------------------------------------------------

def _margin(i: Column | int) -> Column:
    return F.get("margins", F.lit(i) if isinstance(i, int) else i)


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def softmax(margins: list[Column]) -> list[Column]:
    """Probabilities of the classes; they add up to one as they are."""
    top = F.greatest(*margins)
    parts = [F.exp(m - top) for m in margins]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def grid_fold_scores(
    df: DataFrame, label: str, grid: list[Settings], folds: int = 10, seed: int = 1122, features: str = "x"
) -> DataFrame:
    """``point, fold, score, n``: log loss of every grid point on every fold, all fitted in the same scans."""
    rows = df.withColumn("_fold", blend.kfold_assign(F.col("id"), folds, seed))
    targets = [F.when(F.col("_fold") != k, F.col(label)) for k in range(folds)]  # shared by the grid points
    models = [Model(s, t) for s in grid for t in targets]
    # a row is scored by the models that did not see it: one per grid point
    scored = fit(rows, features, models).margins(rows.select("_fold", label, features), features, fold="_fold", folds=folds)
    long = scored.select(F.col("_fold").alias("fold"), F.col(label).cast("int").alias("y"), F.posexplode("margins").alias("point", "m"))
    p = sigmoid(F.col("m"))
    return long.groupBy("point", "fold").agg(metrics.log_loss(F.col("y"), [1.0 - p, p]).alias("score"), F.count(F.lit(1)).alias("n"))


def cv_fold_scores(df: DataFrame, label: str, settings: Settings = BINARY, folds: int = 10, seed: int = 1122, features: str = "x") -> DataFrame:
    """``fold, score, n`` of one setting."""
    return grid_fold_scores(df, label, [settings], folds, seed, features).select("fold", "score", "n")


def grid_search(
    df: DataFrame, label: str, base: Settings, grid: dict[str, list], folds: int = 10, seed: int = 1122, features: str = "x"
) -> DataFrame:
    """Mean score over the folds of every combination of the values in ``grid``: the values and ``score``."""
    names = sorted(grid)
    points = list(product(*[grid[n] for n in names]))
    scores = grid_fold_scores(df, label, [replace(base, **dict(zip(names, p, strict=True))) for p in points], folds, seed, features)
    values = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, p, strict=True)]) for p in points])
    return scores.groupBy("point").agg(F.avg("score").alias("score")).select(F.get(values, F.col("point")).alias("v"), "score").select("v.*", "score")


def two_stage_classifier(
    train: DataFrame, test: DataFrame, label: str = "label", first: Settings = FIRST, second: Settings = SECOND, features: str = "x"
) -> DataFrame:
    """Is it positive; is a positive one level 1: ``id, predict_0, predict_1, predict_2``. Both stages grow in the same scans."""
    y = F.col(label)
    models = [Model(first, (y > 0).cast("int")), Model(second, F.when(y > 0, (y == 1).cast("int")))]
    scored = fit(train, features, models).margins(test.select("id", features), features)
    v = blend.two_stage_combine(sigmoid(_margin(0)), sigmoid(_margin(1)))
    return scored.select("id", *[c.alias(f"predict_{i}") for i, c in enumerate(v)])


def bagged_regression(
    train: DataFrame, test: DataFrame, target: str, repeats: int = 20, holdout: float = 0.001, settings: Settings = REGRESSION, features: str = "x"
) -> DataFrame:
    """log1p target, one fit per repeat without its held-out rows, mean of the expm1 predictions: ``id, target``."""
    y = F.log1p(F.col(target).cast("double"))
    scored = fit(train, features, [Model(settings, y, (holdout, r)) for r in range(repeats)]).margins(test.select("id", features), features)
    total = F.aggregate(F.transform("margins", F.expm1), F.lit(0.0), lambda s, x: s + x)
    return scored.select("id", (total / repeats).alias("target"))


def joint_multiclass(
    train: DataFrame, test: DataFrame, label: str = "label", settings: Settings = JOINT, features: str = "x"
) -> DataFrame:
    """One tree per class and round on the gradients of the joint softmax: ``id, p0, p1, ..``."""
    scored = fit(train, features, [Model(settings, F.col(label))]).margins(test.select("id", features), features)
    p = softmax([_margin(k) for k in range(settings.classes)])
    return scored.select("id", *[c.alias(f"p{k}") for k, c in enumerate(p)])


def feature_importances(train: DataFrame, names: list[str], label: str, settings: Settings = JOINT, features: str = "x") -> DataFrame:
    """``feature, weight``: share of each feature in the gains of all splits."""
    weights = fit(train, features, [Model(settings, F.col(label))]).weights()
    return train.sparkSession.createDataFrame(list(zip(names, weights, strict=True)), "feature string, weight double")
