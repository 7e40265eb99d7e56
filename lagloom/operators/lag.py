"""Rows that are shifted copies of one another.

Row X continues row Y by ``s`` positions when X's values without the last ``s`` equal Y's values
without the first ``s``; Y's group-0 cell at ``s - 2`` is then X's target.

Slices are compared through two independent 64-bit hashes, so a key costs 16 bytes in a shuffle
however long the slice is. ``verify_pairs`` compares the arrays themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lagloom.functions import arrays as A
from lagloom.session import cut_lineage

KEY = ["h1", "h2"]
SLICES = 1 << 23  # groups of rows that are matched at a time, one group of every row at least


def _hashes(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(7), value).alias("h2")


def _reach(weights: Column, need: int) -> Column:
    """Length of the shortest prefix whose weights sum to at least ``need``; NULL if none does."""
    first = F.struct(F.lit(0).alias("t"), F.lit(0).alias("m"))
    return F.aggregate(
        weights,
        first,
        lambda s, w: F.when(s["t"] >= need, s).otherwise(
            F.struct((s["t"] + w).alias("t"), (s["m"] + 1).alias("m"))
        ),
        lambda s: F.when(s["t"] >= need, s["m"]),
    )


# --- first match per group and shift --------------------------------------------------------

def lag_keys(
    panel: DataFrame, positions: int, target_back: int = 2, nonzero_min: int = 2, keep: tuple[str, ...] = ("id",)
) -> DataFrame:
    """Per row, group and shift: target, both change counts and both keys as joined text.

    ``suffix`` is the row seen as an earlier one, ``prefix`` the row seen as a later one. A key is
    '' when it has too few changes; the suffix also, and then the target is -1, without a positive
    target. Changes compare with the cell before, also the one just outside the slice.
    """
    # Each value is written once a row; a key is a part of that text. What is done per shift is compiled.
    def running(items: Column) -> Column:
        zero = F.array(F.lit(0))
        return F.aggregate(items, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    text = F.transform("v", lambda x: F.coalesce(F.concat(x.cast("string"), F.lit("_")), F.lit("")))
    change = F.transform("v", lambda x, i: ((x > 0) & (x != F.coalesce(F.get("v", i - 1), F.lit(-1).cast("long")))).cast("int"))
    rows = panel.select(*keep, F.get("series", F.lit(0)).alias("_first"), F.posexplode("series").alias("grp", "v"))
    rows = rows.withColumns({"_text": text, "_changes": running(F.transform(change, lambda x: F.coalesce(x, F.lit(0))))})
    rows = rows.withColumns({"_ends": running(F.transform("_text", F.length)), "_text": F.array_join("_text", "")})
    shifts = F.explode(F.sequence(F.lit(2), F.lit(positions - 3)) if positions >= 5 else F.array().cast("array<int>"))
    rows = rows.select(*keep, "grp", "_first", "_text", "_ends", "_changes", shifts.alias("shift"))

    def at(name: str, place: Column) -> Column:
        return F.get(name, F.least(place, F.size(name) - 1))

    s, n = F.col("shift"), F.lit(positions)
    target = F.get("_first", s - target_back)
    rows = rows.select(
        *keep, "grp", "shift", target.alias("_target"), "_text", at("_ends", s).alias("_from"), at("_ends", n - s).alias("_to"),
        at("_ends", n).alias("_end"), (F.get("_changes", F.size("_changes") - 1) - at("_changes", s)).alias("suffix_nz"),
        at("_changes", n - s).alias("prefix_nz"),
    )
    suffix_ok, prefix_ok = (F.col("suffix_nz") >= nonzero_min) & (F.col("_target") > 0), F.col("prefix_nz") >= nonzero_min
    return rows.select(
        *keep, "grp", "shift", F.when(suffix_ok, F.col("_target")).otherwise(F.lit(-1).cast("long")).alias("target"),
        "suffix_nz", "prefix_nz",
        F.when(suffix_ok, F.substring("_text", F.col("_from") + 1, F.col("_end") - F.col("_from") - 1)).otherwise("").alias("suffix_key"),
        F.when(prefix_ok, F.substring("_text", F.lit(1), F.col("_to") - 1)).otherwise("").alias("prefix_key"),
    )


def lag_match_first(
    panel: DataFrame, positions: int, target_back: int = 2, nonzero_min: int = 2
) -> DataFrame:
    """Every later row with the first earlier row, in file order, that has its key.

    Train rows match train rows and other rows match other rows; fake rows outside the train part
    take no part. Blank keys are dropped inside the row, before anything is hashed or shuffled.
    ``row_pos`` is unique. The build side keeps numbers only, so it is a hash aggregate.
    Result: ``child_id, parent_id, is_train, grp, shift, target, nz``.

    A key is a slice without the zeros at its end. Slices of one shift are equally long, so they are equal when these are; and
    a later row asks once for all shifts that differ by such zeros only. The groups are matched a few at a time, each
    time into a table, so that their shuffles do not lie on the disk together.
    """
    kept = panel.where(F.col("is_train") | ~F.col("is_fake")).select("id", "is_train", "row_pos", "series")
    kept = cut_lineage(kept)
    size = kept.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("series")).alias("groups")).first()
    groups, step = size.groups or 0, max(1, SLICES // max(1, size.n))
    if groups <= step:
        return _first_matches(kept, positions, target_back, nonzero_min)
    parts = [
        cut_lineage(_first_matches(kept, positions, target_back, nonzero_min, first, step)) for first in range(0, groups, step)
    ]
    return reduce(DataFrame.unionByName, parts)


def _first_matches(
    kept: DataFrame, positions: int, target_back: int, nonzero_min: int, first: int = 0, step: int | None = None
) -> DataFrame:
    """``lag_match_first`` of ``step`` groups from ``first`` on, all without it."""
    target = F.get("series", F.lit(0)).alias("first")
    rows = kept.select("id", "is_train", "row_pos", target, F.posexplode("series").alias("grp", "v")).where("v is not null")
    if step is not None:
        rows = rows.where((F.col("grp") >= first) & (F.col("grp") < first + step))
    kind = rows.schema

    def field(name: str, like: str) -> StructField:
        return StructField(name, kind[like].dataType)

    def named(types: str) -> list[StructField]:
        return [StructField(n, LongType() if t == "long" else IntegerType()) for n, t in (x.split() for x in types.split(", "))]

    def batches(make, names: list[str]):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                if part.num_rows:
                    at, own, made = make(part)
                    yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(at)) for c in own), *map(pa.array, made)], names)

        return run

    def earlier(part: pa.RecordBatch):
        slices = Slices(part, positions)
        row, s, h1, h2, nz = slices.suffixes(target_back, nonzero_min)
        return row, ("id", "row_pos"), (h1, h2, s.astype(np.int32), slices.first[row, s - target_back], nz.astype(np.int32))

    def later(part: pa.RecordBatch):
        row, low, high, h1, h2 = Slices(part, positions).prefixes(nonzero_min)
        return row, ("id", "is_train", "grp"), (h1, h2, low.astype(np.int32), high.astype(np.int32))

    offered = StructType([field("id", "id"), field("row_pos", "row_pos"), *named("h1 long, h2 long, shift int, target long, nz int")])
    asked = StructType([field("child_id", "id"), field("is_train", "is_train"), field("grp", "grp"), *named("h1 long, h2 long, low int, high int")])
    build = (
        rows.mapInArrow(batches(earlier, offered.names), offered)
        .groupBy(*KEY, "shift")
        .agg(
            F.min_by("id", "row_pos").alias("parent_id"),
            F.min_by("target", "row_pos").alias("target"),
            F.min_by("nz", "row_pos").alias("nz"),
        )
    )
    probe = rows.mapInArrow(batches(later, asked.names), asked)
    # at most one row of a key for each shift; the aggregate is not partitioned by the key alone, so both sides get an exchange
    return probe.join(build, KEY).where((F.col("shift") >= F.col("low")) & (F.col("shift") <= F.col("high"))).select(
        "child_id", "parent_id", "is_train", "grp", "shift", "target", "nz"
    )


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# odd multipliers of the two hashes, and what a value is mixed with
_BASES = ((0xD6E8FEB86659FD93, 0x2545F4914F6CDD1D), (0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_ABSENT = (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)  # codes of a null and of a place the row does not have


class Slices:
    """All prefixes and suffixes of a batch of rows (id, is_train, row_pos, first, grp, v) by two 64-bit hashes.

    A hash adds the mixed values other than zero, each times a power of an odd number that tells how far it is from the start
    of the slice. So the hashes of all slices are running sums, and zeros at the end of a slice change nothing.
    """

    def __init__(self, batch: pa.RecordBatch, positions: int) -> None:
        self.n = positions
        v, absent = _table(batch.column("v"), positions)
        first, none = _table(batch.column("first"), positions)
        self.first = np.where(none > 0, 0, first)  # neither is a target
        before = np.concatenate([np.full((len(v), 1), -1), np.where(absent > 0, -1, v)[:, :-1]], axis=1)
        changes = (absent == 0) & (v > 0) & (v != before)
        self.changes = np.concatenate([np.zeros((len(v), 1), dtype=np.int64), np.cumsum(changes, axis=1)], axis=1)
        self.filled = (absent > 0) | (v != 0)
        train = batch.column("is_train").cast(pa.int8()).fill_null(2).to_numpy()
        self.part = batch.column("grp").to_numpy().astype(np.uint64) * np.uint64(4) + train.astype(np.uint64)
        code = np.where(absent == 0, v, 0).view(np.uint64)
        self.sums = []
        for base, salt in _BASES:
            own = _mixed(code ^ np.uint64(salt))
            for k, x in enumerate(_ABSENT):
                own[absent == k + 1] = x ^ salt
            own[~self.filled] = 0
            power = np.array([pow(base, i, 1 << 64) for i in range(positions)], dtype=np.uint64)
            running = np.cumsum(own * power, axis=1, dtype=np.uint64)
            self.sums.append(np.concatenate([np.zeros((len(v), 1), dtype=np.uint64), running], axis=1))

    def _hashes(self, row: np.ndarray, sums: list[np.ndarray]) -> list[np.ndarray]:
        return [_mixed(x ^ _mixed(self.part[row] ^ np.uint64(salt))).view(np.int64) for x, (_, salt) in zip(sums, _BASES, strict=True)]

    def suffixes(self, target_back: int, nonzero_min: int) -> tuple:
        """(row, shift, hashes, changes) of the suffixes with a target and enough changes."""
        shifts = np.arange(max(2, target_back), self.n - 2)
        changes = self.changes[:, -1:] - self.changes[:, shifts]
        row, at = np.nonzero((changes >= nonzero_min) & (self.first[:, shifts - target_back] > 0))
        s = shifts[at]
        sums = []
        for (base, _), x in zip(_BASES, self.sums, strict=True):
            back = np.array([pow(base, -i, 1 << 64) for i in range(self.n)], dtype=np.uint64)
            sums.append((x[row, -1] - x[row, s]) * back[s])
        return row, s, *self._hashes(row, sums), changes[row, at]

    def prefixes(self, nonzero_min: int) -> tuple:
        """(row, lowest shift, highest shift, hashes) of the prefixes with enough changes; one row for those that differ by zeros at the end."""
        shifts = np.arange(2, self.n - 2)
        ends = self.n - shifts
        count = np.cumsum(self.filled, axis=1)[:, ends - 1]  # of values other than zero: alike if the prefixes differ by zeros
        row, at = np.nonzero(self.changes[:, ends] >= nonzero_min)
        own = count[row, at]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (own[1:] != own[:-1])
        begun = np.flatnonzero(new)
        last = np.append(begun[1:], len(row))[: len(begun)] - 1
        row, low, high = row[begun], shifts[at[begun]], shifts[at[last]]
        return row, low, high, *self._hashes(row, [x[row, self.n - low] for x in self.sums])


def _table(column: pa.Array, positions: int) -> tuple[np.ndarray, np.ndarray]:
    """Values as (row, position), and where there is none: 1 for a null, 2 where the row has no such position."""
    flat, lengths = column.flatten(), np.diff(column.offsets.to_numpy())
    if not column.null_count and not flat.null_count and (lengths == positions).all():
        return flat.to_numpy().astype(np.int64).reshape(-1, positions), np.zeros((len(column), positions), dtype=np.int8)
    values, absent = np.zeros((len(column), positions), dtype=np.int64), np.full((len(column), positions), 2, dtype=np.int8)
    for i, own in enumerate(column.to_pylist()):
        own = (own or [])[:positions]
        values[i, : len(own)] = [x or 0 for x in own]
        absent[i, : len(own)] = [x is None for x in own]
    return values, absent


def lag_match_best(matches: DataFrame) -> DataFrame:
    """Per later row the match with most changes, then smallest shift, then earliest group."""
    best = F.max_by(
        F.struct("target", "nz", "grp", "shift", "parent_id"),
        F.struct(F.col("nz"), -F.col("shift"), -F.col("grp")),
    )
    return matches.groupBy("child_id", "is_train").agg(best.alias("b")).select(
        "child_id", "is_train",
        F.col("b.target").alias("found_target"), F.col("b.nz").alias("found_len"),
        F.col("b.grp").alias("round_num"), F.col("b.shift").alias("shift"),
    )


def lag_link_edges(matches: DataFrame) -> DataFrame:
    """One edge per pair; the last group's last shift wins."""
    return matches.groupBy("parent_id", "child_id").agg(
        F.max_by("shift", F.struct("grp", "shift")).alias("shift")
    )


def lag_match_quality(best: DataFrame, targets: DataFrame) -> DataFrame:
    """Matched, right and wrong counts over the train rows. ``targets``: ``id, target``."""
    known = best.where("is_train").join(targets, F.col("child_id") == F.col("id"))
    good = F.col("found_target") == F.rint(F.col("target").cast("double")).cast("long")
    return known.agg(
        F.count(F.lit(1)).alias("matched"), F.count_if(good).alias("good"), F.count_if(~good).alias("bad"),
    ).withColumn("ratio", F.try_divide(F.col("good").cast("double"), F.col("matched").cast("double")))


# --- unique match over all groups ------------------------------------------------------------

def lag_match_tuple(
    panel: DataFrame,
    positions: int,
    max_offset: int,
    part: str = "is_train",
    long_min: int = 3,
    long_from: int = 38,
    first_group_to: int = 19,
) -> DataFrame:
    """Rows whose whole prefix equals exactly one whole suffix: ``part, pass, offset, child_id,
    parent_id, pred``.

    Pass 0 compares all groups for offsets 2..``max_offset``, pass 1 only group 0 for offsets up to
    ``first_group_to``. A key that repeats on either side is dropped. The first group counts twice
    in the non-zero threshold, which is ``long_min`` from offset ``long_from`` on and in pass 1,
    else 1.

    Both sides of every offset leave one scan and meet in one aggregate, so there is one shuffle
    and no join, and a key shared by a third of the rows shrinks on the map side.
    """
    first = F.get("series", F.lit(0))
    weighted = F.transform(
        first,
        lambda v, p: F.aggregate(
            "series", (v > 0).cast("int"), lambda s, g: s + (F.get(g, p) > 0).cast("int")
        ),
    )
    rows = panel.select(
        "id", part, "series", first.alias("_first"), weighted.alias("_all"),
        F.transform(first, lambda v: (v > 0).cast("int") * 2).alias("_own"),
    ).select(
        "id", part, "series", "_first",
        _reach("_all", 1).alias("_any"), _reach("_all", long_min).alias("_many"), _reach("_own", long_min).alias("_own"),
    )
    n = F.lit(positions)

    def sides(number: int, data: Column, need) -> list[Column]:
        def record(o: Column, slices: Column, is_child: bool) -> Column:
            return A.let(
                slices,
                lambda a: F.struct(
                    F.lit(number).alias("pass"), o.alias("offset"), *_hashes(a),
                    F.lit(is_child).alias("is_child"), F.get("_first", o - 2).alias("pred"),
                ),
            )

        last = max_offset if number == 0 else first_group_to
        offsets = F.sequence(F.lit(2), F.lit(last))
        later = F.transform(
            F.filter(offsets, lambda o: n - o >= need(o)),
            lambda o: record(o, F.transform(data, lambda g: F.slice(g, F.lit(1), n - o)), True),
        )
        earlier = F.transform(
            F.filter(offsets, lambda o: F.get("_first", o - 2) != 0),
            lambda o: record(o, F.transform(data, lambda g: F.slice(g, o + 1, n - o)), False),
        )
        return [later, earlier]

    records = F.concat(
        *sides(0, F.col("series"), lambda o: F.when(o >= long_from, F.col("_many")).otherwise(F.col("_any"))),
        *sides(1, F.array("_first"), lambda o: F.col("_own")),
    )
    child, parent = F.col("is_child"), ~F.col("is_child")
    return (
        rows.select("id", part, F.inline(records))
        .groupBy(part, "pass", "offset", *KEY)
        .agg(
            F.count_if(child).alias("_children"), F.count_if(parent).alias("_parents"),
            F.min(F.when(child, F.col("id"))).alias("child_id"),
            F.min(F.when(parent, F.col("id"))).alias("parent_id"),
            F.min(F.when(parent, F.col("pred"))).alias("pred"),
        )
        .where("_children = 1 and _parents = 1")
        .select(part, "pass", "offset", "child_id", "parent_id", "pred")
    )


def lag_match_cascade(matches: DataFrame, part: str = "is_train") -> DataFrame:
    """First prediction per row over the passes and offsets in order."""
    return matches.groupBy("child_id", part).agg(
        F.min_by("pred", F.struct("pass", "offset")).alias("pred"),
        F.min(F.struct("pass", "offset")).alias("at"),
    ).select("child_id", part, "pred", "at.pass", "at.offset")


def lag_match_per_offset(matches: DataFrame, part: str = "is_train") -> DataFrame:
    """Prediction per row and offset; the later pass overrides."""
    return matches.groupBy("child_id", part, "offset").agg(F.max_by("pred", "pass").alias("pred"))


def lag_offset_sweep(
    matches: DataFrame, targets: DataFrame, lowest: int = 35, highest: int = 39
) -> DataFrame:
    """Predicted and right train rows per largest offset allowed in pass 0."""
    first = F.when(F.col("pass") == 0, F.greatest(F.col("offset"), F.lit(lowest))).otherwise(lowest)
    best = (
        matches.where("is_train")
        .select("child_id", "pass", "offset", "pred", F.explode(F.sequence(first, F.lit(highest))).alias("max_offset"))
        .groupBy("max_offset", "child_id")
        .agg(F.min_by("pred", F.struct("pass", "offset")).alias("pred"))
    )
    return (
        best.join(targets, F.col("child_id") == F.col("id"))
        .groupBy("max_offset")
        .agg(F.count(F.lit(1)).alias("predicted"), F.count_if(F.col("pred") == F.col("target")).alias("good"))
    )


def verify_pairs(matches: DataFrame, panel: DataFrame, positions: int, shift: str = "shift") -> DataFrame:
    """Keep the pairs whose slices are equal value by value.

    ``grp`` limits the comparison to one group where the matches carry it.
    """
    child = panel.select(F.col("id").alias("child_id"), F.col("series").alias("_child"))
    parent = panel.select(F.col("id").alias("parent_id"), F.col("series").alias("_parent"))
    pairs = matches.join(child, "child_id").join(parent, "parent_id")
    if "grp" in matches.columns:
        left, right = F.array(F.get("_child", F.col("grp"))), F.array(F.get("_parent", F.col("grp")))
    elif "pass" in matches.columns:
        only = F.col("pass") == 1
        left = F.when(only, F.slice("_child", 1, 1)).otherwise(F.col("_child"))
        right = F.when(only, F.slice("_parent", 1, 1)).otherwise(F.col("_parent"))
    else:
        left, right = F.col("_child"), F.col("_parent")
    s = F.col(shift)
    same = F.transform(left, lambda g: F.slice(g, F.lit(1), F.lit(positions) - s)) == F.transform(
        right, lambda g: F.slice(g, s + 1, F.lit(positions) - s)
    )
    return pairs.where(same).drop("_child", "_parent")


def join_unique_keys(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    """Inner join of the rows whose key occurs once on each side.

    Every column but the key is kept; both sides are reduced before they meet.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return drop_all_duplicates(left, keys).join(drop_all_duplicates(right, keys), keys)


def drop_all_duplicates(df: DataFrame, on: list[str] | str) -> DataFrame:
    """Only the rows whose key occurs once. Map-side counts, no window."""
    keys = [on] if isinstance(on, str) else list(on)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.groupBy(*keys).count().where("count = 1").drop("count")
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
        .where("_n = 1")
        .select(*keys, "_row.*")
    )
