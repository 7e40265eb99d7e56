"""Fingerprints that keep edit distance: random-walk embedding, sampled.

A walk reads a text with a pointer: at step j it writes the character under the pointer and moves on by a random bit that
depends on j and on that character only. Texts share the bits, so after an edit two walks fall in step again, and the
edit distance of the texts becomes a Hamming distance of what was written. A fingerprint samples SLOTS steps of the
walk, four bits of what stands there for each; the sampled steps depend on the text's length alone, and for lengths
L1 < L2 each slot picks the same step with probability L1 / L2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.common import components, slices, texts, tiled
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage

SLOTS = 128
CYCLE, CLASSES = 4096, 256  # the table of bits: steps before it repeats, character classes
BATCH = 2_000_000  # characters walked at once
BANDS, SAME = 16, 0.8  # bands of eight slots; least likeness of near copies


def bit_table() -> np.ndarray:
    table = np.random.default_rng(20).integers(0, 2, (CYCLE, CLASSES), dtype=np.int64)
    table[:, 0] = 0  # the class of the end: the walk stays there
    return table


def sample_steps(longest: int) -> list[np.ndarray]:
    """For every slot the steps at which its choice changes as texts grow: the records of a random order of all steps."""
    rng = np.random.default_rng(21)
    draws = rng.random((SLOTS, 96))
    out = []
    for own in draws:
        steps, at = [0], 0
        for u in own:
            at = int((at + 1) / max(u, 1e-12))
            if at >= longest:
                break
            steps.append(at)
        out.append(np.array(steps, dtype=np.int64))
    return out


def walk_prints(values: list[str], table: np.ndarray) -> np.ndarray:
    """SLOTS four-bit symbols of each text."""
    n = np.array([len(v) for v in values], dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    codes = np.frombuffer("".join(values[i] + "\0\0" for i in order).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    sizes = n[order]
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    classes = (codes * 40503 >> 4) % (CLASSES - 1) + 1
    classes[starts + sizes] = 0
    steps = np.maximum(2 * sizes, 1)
    records = sample_steps(int(steps.max(initial=1)))
    # (step, text, slot) sorted by step
    picked = np.stack([r[np.searchsorted(r, steps, side="left") - 1] for r in records], axis=1)
    by_step = np.argsort(picked, axis=None, kind="stable")
    when = picked.ravel()[by_step]
    where = np.empty(picked.size, dtype=np.int64)
    bounds = np.searchsorted(when, np.arange(int(steps.max(initial=1)) + 1)) if len(when) else np.zeros(2, dtype=np.int64)
    active = np.searchsorted(-steps, -np.arange(int(steps.max(initial=1))), side="left")  # texts with more steps than j
    bounds, active, at, upto = bounds.tolist(), active.tolist(), starts.copy(), -1
    for j, count in enumerate(active):
        lo, hi = bounds[j], bounds[j + 1]
        if hi > lo:
            where[by_step[lo:hi]] = at[by_step[lo:hi] // SLOTS]
        if count != upto:
            view, upto = at[:count], count
        view += table[j % CYCLE].take(classes.take(view))
    end = classes[where] == 0
    pair = codes[where] * 0x9E3779B1 + codes[np.minimum(where + 1, len(codes) - 1)] * 0x85EBCA6B
    pair[end] = 0
    pair = (pair ^ (pair >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
    symbols = ((pair ^ (pair >> 12)) >> 7 & 15).astype(np.uint8).reshape(len(values), SLOTS)
    out = np.empty_like(symbols)
    out[order] = symbols
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal symbols beyond the sixteenth that chance gives."""
    return np.clip(((a == b).mean(axis=-1) - 1 / 16) / (15 / 16), 0.0, 1.0)


def _hex(symbols: np.ndarray) -> list[str]:
    return ["".join(map("0123456789abcdef".__getitem__, row)) for row in symbols.tolist()]


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, own: list[str], following: list[str], table: np.ndarray) -> list[pa.Array]:
    new = [edited(a, b) for a, b in zip(own, following, strict=True)]
    chained = own[1:] == following[:-1]
    first = walk_prints([*own, following[-1]] if chained else [*own, *following], table)
    a, after = first[: len(own)], first[1:] if chained else first[len(own) :]
    b = walk_prints(new, table)
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in new]),
        pa.array(_hex(a)), pa.array(_hex(b)), pa.array(likeness(a, b)), pa.array(likeness(a, after)),
    ]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by id; the first and the last text of the task leave as ``edge`` (0 and 1), the last without results."""
    table = bit_table()
    names = [*NAMES, "edge", "text"]

    def edge(doc_id: int | None, text: str, which: int) -> pa.RecordBatch:
        empty = [pa.array([None], t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), *empty, pa.array([which], pa.int32()), pa.array([text])], names)

    held: tuple | None = None
    for batch in slices(batches, "text", BATCH):
        ids, own = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        if held is None:
            yield edge(ids[0], own[0], 0)
        else:
            ids, own = [held[0], *ids], [held[1], *own]
        held = ids[-1], own[-1]
        if len(own) > 1:
            found = _rows(ids[:-1], own[:-1], own[1:], table)
            none = [pa.nulls(len(own) - 1, pa.int32()), pa.nulls(len(own) - 1, pa.string())]
            yield pa.RecordBatch.from_arrays([*found, *none], names)
    if held is not None:
        yield edge(*held, 1)


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = bit_table()
    for batch in slices(batches, "text", BATCH):
        yield pa.RecordBatch.from_arrays(
            _rows(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("next").to_pylist(), table), NAMES
        )


def edit_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the text edited with the next document, and their likeness; see NAMES.

    Documents follow one another by doc_id (nulls first), rows of one id by text; the first follows the last. Rows are
    sorted by range, so a task sees its neighbours; only a task's first and last text, two rows per task, are ordered
    over all tasks. A null text counts as empty; equal texts have equal fingerprints; an empty table gives no rows.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    table = cut_lineage(ordered.mapInArrow(_stream, f"{SCHEMA}, edge int, text string"))
    edges = table.where("edge is not null").select("doc_id", "text", "edge")
    # two rows per task: every last text is followed by the first of the next task, the last of all by the very first
    line = Window.orderBy(F.col("doc_id").asc_nulls_first(), "edge_order", "text")
    told = edges.withColumn("edge_order", F.lit(0) + F.col("edge")).withColumn("next", F.lead("text").over(line))
    very_first = F.first("text").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lasts = told.withColumn("next", F.coalesce("next", very_first)).where("edge = 1").select("doc_id", "text", "next")
    return table.where("edge is null").select(NAMES).unionByName(lasts.mapInArrow(_last_rows, SCHEMA))


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements between two texts; columns of the table as bits of one integer."""
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rises, falls, distance = full, 0, len(a)
    for c in b:
        equal = places.get(c, 0)
        across = (((equal & rises) + rises) ^ rises) | equal | falls
        up, down = falls | (full & ~(across | rises)), rises & across
        distance += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, (down << 1) & full
        vertical = equal | falls
        rises, falls = down | (full & ~(vertical | up)), up & vertical
    return distance


def text_node(text: Column) -> Column:
    """Name of a text: 16 bytes of its SHA-256."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def own_prints(docs: DataFrame) -> DataFrame:
    """(doc_id, node, fingerprint) of every row, ``node`` the name of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bit_table()
        for batch in slices(batches, "text", BATCH):
            prints = pa.array(_hex(walk_prints(batch.column("text").to_pylist(), table)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), prints], ["doc_id", "node", "fingerprint"])

    named = texts(docs).select("doc_id", text_node(F.col("text")).alias("node"), "text")
    return named.mapInArrow(run, "doc_id long, node binary, fingerprint string")


def forest(symbols: np.ndarray, label: np.ndarray, tried: list[set[int]]) -> list[tuple[int, int]]:
    """Pairs with likeness SAME or more that were not tried, as few as connect the labels such pairs connect."""
    label, pairs = label.copy(), []
    for i in range(len(symbols) - 1):
        near = (likeness(symbols[i], symbols[i + 1 :]) >= SAME) & (label[i + 1 :] != label[i])
        near[[j - i - 1 for j in tried[i]]] = False
        js = i + 1 + np.flatnonzero(near)
        if len(js):
            js = js[np.unique(label[js], return_index=True)[1]]
            pairs += [(i, j) for j in js.tolist()]
            label[np.isin(label, label[js])] = label[i]
    return pairs


def _offers(forests: int):
    """Pairs of each tile for verification: ``forests`` forests without a pair in common, none of the pairs that failed.

    Rows come sorted by (key, tile): texts with the root they are linked to so far, and failed pairs (node, other).
    """

    def found(key: int, tile: int, rows: list[tuple]) -> pa.RecordBatch | None:
        own = sorted({r for r in rows if r[1] is None}, key=lambda r: r[0])
        at = {r[0]: i for i, r in enumerate(own)}
        symbols = np.array([[int(c, 16) for c in r[2]] for r in own], dtype=np.uint8)
        roots: dict[bytes, int] = {}
        label = np.array([roots.setdefault(r[3], len(roots)) for r in own])
        tried: list[set[int]] = [set() for _ in own]
        for a, b in {(r[0], r[1]) for r in rows if r[1] is not None}:
            tried[min(at[a], at[b])].add(max(at[a], at[b]))
        pairs: list[tuple[int, int]] = []
        for _ in range(forests):
            more = forest(symbols, label, tried)
            if not more:
                break
            pairs += more
            for i, j in more:
                tried[i].add(j)
        if not pairs:
            return None
        a, b = ([own[p[side]][0] for p in pairs] for side in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array([key] * len(a), pa.int64()), pa.array([tile] * len(a), pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
            ["key", "tile", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "tile", "node", "other", "fingerprint", "root"))
            for key, tile, *row in zip(*columns, strict=True):
                if (key, tile) != at:
                    if len(rows) > 1 and (out := found(*at, rows)):
                        yield out
                    at, rows = (key, tile), []
                rows.append(tuple(row))
        if len(rows) > 1 and (out := found(*at, rows)):
            yield out

    return run


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for s, t in zip(batch.column("a_text").to_pylist(), batch.column("b_text").to_pylist(), strict=True):
            most = (1 - SAME) * max(len(s), len(t))
            good.append(abs(len(s) - len(t)) <= most and edit_distance(s, t) <= most)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], ["a", "b", "good"])


def near_copies(docs: DataFrame, prints: DataFrame | None = None, chunk: int = 2048) -> DataFrame:
    """(doc_id, class_id): texts joined by chains of pairs whose edit distance is at most 1 - SAME of the longer one.

    Candidates agree in a band of SLOTS / BANDS sampled symbols and in SAME of all. A tile offers forests of its
    candidates, these are verified on the texts, and a tile with a pair that failed offers pairs not tried between texts
    not yet linked, twice as many forests each round, until none is left: classes are those of all verified candidates.
    Equal texts are one; different texts with equal prints are verified like others. ``prints``, if given, are rows of
    ``own_prints(docs)``; those of ``edit_prints`` do not name their text and are found anew. class_id is the smallest
    doc_id of the class, null if none of its rows has one.
    """
    if prints is None or "node" not in prints.columns:
        prints = own_prints(docs)
    prints = cut_lineage(prints)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = prints.groupBy("node").agg(F.min("fingerprint").alias("fingerprint"))
    width = SLOTS // BANDS
    bands = F.array(*(F.xxhash64(F.lit(b), F.substring("fingerprint", b * width + 1, width)) for b in range(BANDS)))
    keyed = nodes.select("node", F.explode(bands).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("several")).where("several > 1").select("key")
    meeting = cut_lineage(lookup(keyed, shared, "key", "inner").select("key", "node"))
    tiles = cut_lineage(lookup(tiled(meeting, "node", chunk), nodes, "node", "inner").select("key", "tile", "node", "fingerprint"))
    whole = texts(docs).select(text_node(F.col("text")).alias("node"), "text")
    links = failed = groups = None
    forests = 1
    while True:
        if groups is None:
            rooted = tiles.withColumn("root", F.col("node"))
        else:
            rooted = lookup(tiles, groups, "node").withColumn("root", F.coalesce("root", "node"))
        rows = rooted.withColumn("other", F.lit(None).cast("binary"))
        if failed is not None:
            rows = rows.unionByName(failed.select("key", "tile", F.col("a").alias("node"), F.col("b").alias("other")), allowMissingColumns=True)
        dealt = rows.repartition(n, "key", "tile").sortWithinPartitions("key", "tile")
        offered = cut_lineage(dealt.mapInArrow(_offers(forests), "key long, tile long, a binary, b binary"))
        pairs = offered.select("a", "b").distinct()
        needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        read = cut_lineage(whole.join(needed, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")))
        for side in ("a", "b"):
            pairs = lookup(pairs, read.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text")), side, "inner")
        judged = cut_lineage(pairs.select("a", "b", "a_text", "b_text").repartition(n, "a", "b").mapInArrow(_judged, "a binary, b binary, good boolean"))
        good = judged.where("good").select("a", "b")
        links = good if links is None else links.unionByName(good)
        groups = components(links)
        bad = cut_lineage(offered.join(judged.where("not good").select("a", "b"), ["a", "b"], "left_semi"))
        if bad.isEmpty():
            break
        failed = bad if failed is None else failed.unionByName(bad)
        tiles = cut_lineage(tiles.join(bad.select("key", "tile").distinct(), ["key", "tile"], "left_semi"))
        failed = cut_lineage(failed.join(bad.select("key", "tile").distinct(), ["key", "tile"], "left_semi"))
        forests *= 2
    named = lookup(prints.select("doc_id", "node"), groups, "node").select("doc_id", F.coalesce("root", "node").alias("root"))
    return lookup(named, named.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")
