"""Near-duplicate texts by SimHash, compared bit plane by bit plane.

Fingerprints are reduced to distinct ones first, so a group of exact copies, however large, is one row. Two
fingerprints at three or fewer differing bits agree on one of four 16-bit blocks and, of the other 48 bits, on one
of four 12-bit parts: sixteen keys of 28 bits find every link. Rows of a key are laid out vertically, plane p
holding bit p of 64 fingerprints in a word. One query fingerprint updates 64 distances with two carry-save counters
and a word of "over" flags; a (query, block) pair whose flags are all set is abandoned. Links of a task leave as
stars, never as all pairs, and a key with many fingerprints is cut into tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.llm.common import components, raw, slices, star, texts, tiled
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage

SEED = 42
RADIUS = 3  # what two counter bits can hold, and what the sixteen keys find
BLOCK, PARTS = 16, 4
CHUNK = 8192  # fingerprints of one key in one task: two of these meet in a tile
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(values: list[bytes], size: int = 3) -> np.ndarray:
    """64-bit fingerprints of UTF-8 texts; no word: zero."""
    digest, join = xxhash.xxh64_digest, b" ".join
    parts, counts = [], []
    for value in values:
        words = value.translate(LOWER).split()
        if len(words) < size:
            grams = [join(words)] if words else []
        else:
            grams = map(join, zip(*(words[i:] for i in range(size)), strict=False))
        own = [digest(g, SEED) for g in grams]
        parts += own
        counts.append(len(own))
    counts = np.array(counts, dtype=np.int64)
    out = np.zeros(len(values), dtype=np.uint64)
    if not parts:
        return out
    hashes = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, 8)
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    ends = starts + counts[full]
    for row, a, b in zip(full, starts, ends, strict=True):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(a, b, 1 << 16):
            bits = np.unpackbits(hashes[at : min(b, at + (1 << 16))], axis=1)
            ones += bits.sum(axis=0, dtype=np.uint32)
        out[row] = np.packbits(2 * ones > b - a).view(">u8")[0]
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        found = simhash(raw(batch.column("text"))).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``; fp as a signed long."""
    return texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


def near_words(fps: np.ndarray, ends: np.ndarray, pairs: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j < ends[i], whose fingerprints differ in at most three bits.

    ``fps`` is sorted into runs, ``ends[i]`` the end of the run of i.
    """
    n = len(fps)
    words = -(-n // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[:n] = fps
    planes = np.empty((64, words), dtype=np.uint64)
    for p in range(64):
        planes[p] = np.packbits(((padded >> np.uint64(p)) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8")
    rows = np.flatnonzero(ends > np.arange(n) + 1)
    first = (rows + 1) // 64
    count = (ends[rows] - 1) // 64 - first + 1
    upto = np.cumsum(count)
    for lo in range(0, int(upto[-1]) if len(upto) else 0, pairs):
        flat = np.arange(lo, min(lo + pairs, int(upto[-1])))
        at = np.searchsorted(upto, flat, side="right")
        q, w = rows[at], first[at] + flat - (upto[at] - count[at])
        low = np.clip(q + 1 - 64 * w, 0, 63).astype(np.uint64)
        high = np.clip(ends[q] - 64 * w, 1, 64).astype(np.uint64)
        over = ~((FULL << low) & (FULL >> (np.uint64(64) - high)))
        own, one, two = fps[q], np.zeros_like(over), np.zeros_like(over)
        for p in range(64):
            differ = planes[p, w] ^ (np.uint64(0) - ((own >> np.uint64(p)) & np.uint64(1)))
            carry = one & differ
            one ^= differ
            over |= two & carry
            two ^= carry
            if p >= 7 and p % 4 == 3:
                alive = over != FULL
                if not alive.all():
                    q, w, own, over, one, two = (x[alive] for x in (q, w, own, over, one, two))
                    if not len(q):
                        break
        if len(q):
            bits = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(bits)
            yield q[row], 64 * w[row] + bit


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of links among rows sorted by (key, tile); the last run waits for the next batch."""
    def found(key: np.ndarray, tile: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
        sizes = np.diff(np.r_[new, len(key)])
        ends = np.repeat(new + sizes, sizes)
        keep = np.repeat(sizes, sizes) > 1
        if not keep.any():
            return
        moved = np.cumsum(keep)
        fp, ends = fp[keep], moved[ends[keep] - 1]
        for i, j in near_words(fp, ends):
            node, root = star(fp[i].view(np.int64), fp[j].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    held = [np.empty(0, np.int64)] * 3
    for batch in batches:
        rows = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("key", "tile", "fp"), strict=True)]
        if not len(rows[0]):
            continue
        other = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
        last = int(other[-1]) + 1 if len(other) else 0
        held = [x[last:] for x in rows]
        if last:
            yield from found(rows[0][:last], rows[1][:last], rows[2][:last].view(np.uint64))
    if len(held[0]):
        yield from found(held[0], held[1], np.ascontiguousarray(held[2]).view(np.uint64))


def _keys(fp: Column) -> Column:
    """The sixteen keys: table number, a 16-bit block, a 12-bit part of the other bits."""
    out = []
    for b in range(4):
        block = F.shiftrightunsigned(fp, BLOCK * b).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << BLOCK * b) - 1))
        high = F.shiftrightunsigned(F.shiftrightunsigned(fp, BLOCK * b), BLOCK) if b < 3 else F.lit(0).cast("long")
        rest = F.shiftleft(high, BLOCK * b).bitwiseOR(low)
        for s in range(PARTS):
            part = F.shiftrightunsigned(rest, 12 * s).bitwiseAND(F.lit(0xFFF))
            out.append(F.lit((b * PARTS + s) << 28).cast("long").bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(part))
    return F.array(*out)


def links(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that join every pair of ``distinct.fp`` at three or fewer bits, directly or by a chain of links."""
    keyed = distinct.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    return tiled(keyed, "fp", chunk).mapInArrow(_links, "a long, b long")


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id): groups of texts linked at three or fewer differing bits.

    A null or wordless text has fingerprint zero and is linked like any other; repeated rows stay and share a group.
    A null doc_id takes part but never names a group (null if its group has no other). An empty table gives no rows,
    other columns are not read.
    """
    fps = cut_lineage(fingerprints(docs))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = components(links(distinct))
    lows = lookup(groups.withColumnRenamed("node", "fp"), distinct, "fp", "inner")
    named = lows.groupBy("root").agg(F.min("low").alias("group_low"))
    linked = lookup(lows.select("fp", "root"), named, "root", "inner").select("fp", "group_low")
    ids = lookup(distinct, linked, "fp").select("fp", F.coalesce("group_low", "low").alias("component_id"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return lookup(fps, ids, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")
