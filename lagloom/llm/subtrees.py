"""Passages of LENGTH words repeated from earlier documents, found in prefix-partitioned suffix trees.

Only suffixes that begin at sampled places are indexed. A window of LENGTH words samples the place among its first
SPAN whose GRAM words have the smallest hash, so equal windows sample the same place, some 2 in 44 places are sampled, and
a window is told by its sampled suffix and the words on its left.

1. Equal texts are one, with the smallest id; the other copies of a text of LENGTH words are repeats as a whole. The distinct
   texts are written once, dealt by the hash of the text.
2. The prefixes of GRAM words of all sampled suffixes are counted, and those of one hash in 32 at every place. One of a single
   text has no inner node below it: no window that samples it is found elsewhere, nor, for the one hash in 32, any window
   over it. Prefixes of up to HOT suffixes make groups of that size. A more frequent prefix is
   lengthened: each of its windows is a prefix of LENGTH words with a group of its own, which a task names once however often
   it saw it, so that a passage of half the corpus sends one row per task and word.
3. A group's suffixes are sorted, their subtree being the order and the depths of the inner nodes between neighbours, and so
   are the words on their left. A window with l words on the left is repeated where an inner node of depth LENGTH - l on the right
   and one of depth l on the left hold the same suffixes: the smallest document of these keeps it.
4. Repeated windows return to their texts and are joined to maximal runs.

Everything is decided on words, never on their hashes, but for texts (two 64-bit hashes) and windows of frequent prefixes (two
more). Nothing is capped: HOT chooses the way only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.common import raw, slices, texts
from lagloom.llm.words import Hashes, bucketed, first_least, rolled
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage

LENGTH, GRAM = 50, 8
SPAN = LENGTH - GRAM + 1
HOT = 2048  # suffixes of a group at most
SEEN = 1 << 18  # contexts, windows and texts that a task remembers
SLICE = 2 << 20  # bytes of texts looked at together
TOGETHER = 1 << 14  # suffixes sorted together, in whole groups
CONTEXT, MARK, WINDOW = 0, 1, 2  # kinds of rows between the passes
LAST = (1 << 63) - 1
NO_GRAM = np.uint64((1 << 64) - 1)
LOW = np.uint64((1 << 64) // 32)  # prefixes with a hash below are counted wherever they stand


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, tid, check, text): rows without id count as the last, a text is named by two hashes."""
    return texts(docs).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("ord"), F.xxhash64("text").alias("tid"),
        F.xxhash64(F.lit(1), "text").alias("check"), "text",
    )


def _distinct(named: DataFrame) -> DataFrame:
    """One row (tid, check, ord, text) per text with its smallest id; a task sends a text once, however many copies it has."""
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            rows, blank = [], []
            columns = [batch.column(c).to_pylist() for c in ("tid", "check", "ord")]
            for i, (tid, check, order) in enumerate(zip(*columns, strict=True)):
                known = seen.get((tid, check))
                if known is None or order < known:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[tid, check] = order
                    rows.append(i)
                    blank.append(known is not None)
            out = batch.take(pa.array(rows, pa.int64()))
            text = pa.compute.if_else(pa.array(blank, pa.bool_()), pa.scalar(None, out.column("text").type), out.column("text"))
            yield pa.RecordBatch.from_arrays([*(out.column(c) for c in ("tid", "check", "ord")), text], ["tid", "check", "ord", "text"])

    sent = named.select("tid", "check", "ord", "text").mapInArrow(once, "tid long, check long, ord long, text string")
    n = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartition(n, "tid").groupBy("tid", "check").agg(F.min("ord").alias("ord"), F.first("text", ignorenulls=True).alias("text"))
    return bucketed(dealt, "tid")


class _Slice:
    """Words of some texts in a row, their windows and sampled places."""

    def __init__(self, column: pa.Array, hashes: Hashes) -> None:
        self.words: list[bytes] = []
        sizes = []
        for text in raw(column):
            own = text.split()
            self.words += own
            sizes.append(len(own))
        self.first = np.cumsum([0, *sizes])
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        n = len(self.words)
        self.hashes = hashes.of(self.words)
        self.grams = rolled(self.hashes, GRAM)
        self.grams[self.doc[: len(self.grams)] != self.doc[GRAM - 1 :][: len(self.grams)]] = NO_GRAM
        self.at = first_least(self.grams, SPAN)
        count = max(n - LENGTH + 1, 0)
        self.whole = self.doc[:count] == self.doc[LENGTH - 1 :][:count]  # windows that stay in their text
        low = np.flatnonzero(self.grams < LOW)
        self.sampled = np.union1d(self.at[self.whole], low[np.diff(self.first)[self.doc[low]] >= LENGTH])


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, gram, n) of every text: prefixes of its sampled suffixes and how many of these it has."""
    hashes = Hashes()
    for batch in slices(batches, "text", SLICE):
        part = _Slice(batch.column("text"), hashes)
        doc, gram = part.doc[part.sampled], part.grams[part.sampled]
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])][: len(doc)])
        n = np.diff(np.r_[new, len(doc)])
        tid = batch.column("tid").take(pa.array(doc[new]))
        yield pa.RecordBatch.from_arrays([tid, pa.array(gram[new].view(np.int64)), pa.array(n, pa.int64())], ["tid", "gram", "n"])


SENT = pa.schema([
    ("kind", pa.int8()), ("route", pa.int64()), ("name", pa.int64()), ("tid", pa.int64()), ("check", pa.int64()), ("ord", pa.int64()),
    ("left", pa.int32()), ("n", pa.int32()), ("places", pa.list_(pa.int32())), ("context", pa.binary()),
])
SENT_TYPE = (
    "kind byte, route long, name long, tid long, check long, ord long, left int, n int, places array<int>, context binary"
)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled suffixes with a prefix found elsewhere, with the words around them that its windows cover.

    A row has the places in its text where its ``n`` windows begin. What this task saw in a smaller document is marked.
    """
    hashes, seen = Hashes(), {}
    for batch in slices(batches, "text", SLICE):
        part = _Slice(batch.column("text"), hashes)
        lists = batch.column("live")
        grams = lists.flatten().field("gram").to_numpy(zero_copy_only=False).view(np.uint64)
        hot = np.unique(grams[lists.flatten().field("hot").to_numpy(zero_copy_only=False)])
        dead = np.zeros(len(part.grams) + 1, dtype=np.int64)
        single = part.sampled[~np.isin(part.grams[part.sampled], grams)]
        dead[single[part.grams[single] < LOW] + 1] = 1
        dead, count = np.cumsum(dead), len(part.at)
        lone = np.zeros(len(part.grams), dtype=bool)
        lone[single] = True
        alive = np.flatnonzero(part.whole & (dead[SPAN : SPAN + count] == dead[:count]) & ~lone[part.at])
        if not len(alive):
            continue
        at = part.at[alive]
        cuts = np.flatnonzero(np.r_[True, (alive[1:] != alive[:-1] + 1) | (at[1:] != at[:-1])])
        starts, ends, at = alive[cuts], alive[np.r_[cuts[1:], len(alive)] - 1] + 1, at[cuts]
        is_hot = np.isin(part.grams[at], hot)
        if is_hot.any():
            whole = rolled(part.hashes, LENGTH)
            names = [w.view(np.int64) for w in (whole, rolled(part.hashes * np.uint64(3) ^ np.uint64(LENGTH), LENGTH))]
        ids = {c: batch.column(c).to_pylist() for c in ("tid", "check", "ord")}
        rows: list[tuple] = []
        runs = zip(starts.tolist(), ends.tolist(), at.tolist(), part.doc[starts].tolist(), is_hot.tolist(), strict=True)
        own: dict = {}
        last = -1

        def flush(doc: int) -> None:
            name = [ids[c][doc] for c in ("tid", "check", "ord")]
            for key, (kind, route, second, left, n, context, places) in own.items():
                if len(seen) >= SEEN:
                    seen.clear()
                seen[key] = min(seen.get(key, LAST), name[2])
                rows.append((kind, route, second, *name, left, n, places, context))
            own.clear()

        for a, b, p, doc, frequent in runs:
            if doc != last:
                if last >= 0:
                    flush(last)
                last, order = doc, ids["ord"][doc]
                tid, check, first = ids["tid"][doc], ids["check"][doc], int(part.first[doc])
            if frequent:
                found = [((r, s), i, WINDOW, r, s, 0, 1, None) for i, r, s in zip(range(a, b), *(n[a:b].tolist() for n in names), strict=True)]
            else:
                context = b" ".join(part.words[a : b + LENGTH - 1])
                key = xxhash.xxh3_128_digest(context, p - a)
                found = [(key, a, CONTEXT, int(part.grams[p].view(np.int64)), 0, p - a, b - a, context)]
            for key, i, kind, route, second, left, n, context in found:
                if seen.get(key, LAST) < order:
                    rows.append((MARK, tid, 0, tid, check, order, 0, n, [i - first], None))
                else:
                    own.setdefault(key, (kind, route, second, left, n, context, []))[-1].append(i - first)
        flush(last)
        for i in range(0, len(rows), 1 << 15):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[i : i + (1 << 15)], strict=True), SENT.types, strict=True)], schema=SENT
            )


def _depths(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A tree of equally long strings of codes: their order, and the depth of the inner node between neighbours."""
    order = np.argsort(np.ascontiguousarray(strings.astype(">u4")).view(f"S{4 * strings.shape[1]}").ravel(), kind="stable")
    same = strings[order[1:]] == strings[order[:-1]]
    return order, np.where(same.all(axis=1), strings.shape[1], same.argmin(axis=1))


def _nodes(order: np.ndarray, depths: np.ndarray, depth: int) -> np.ndarray:
    """For every string the number of the node, or leaf, that it hangs from at ``depth``."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(np.r_[False, depths < depth])
    return out


def repeated_windows(contexts: list[bytes], left: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Which windows of each context are found in one with a smaller order: flags by (context, window).

    ``left`` is the number of words before the sampled place. Contexts of several prefixes may come together.
    """
    sizes = np.array([c.count(b" ") + 1 for c in contexts])
    first = np.cumsum(sizes) - sizes
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known) + 1) for w in b" ".join(contexts).split(b" ")), dtype=np.uint32)
    codes = np.r_[codes, np.zeros(1, dtype=np.uint32)]

    def strings(begin: np.ndarray, step: int, width: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        at = begin[:, None] + step * np.arange(width)
        return codes[np.where((at >= low[:, None]) & (at < high[:, None]), at, len(codes) - 1)]

    right = _depths(strings(first + left, 1, LENGTH, first, first + sizes))
    back = _depths(strings(first + left - 1, -1, SPAN - 1, first, first + sizes))
    windows = sizes - LENGTH + 1
    out = np.zeros((len(contexts), SPAN), dtype=bool)
    for behind in range(SPAN):
        own = np.flatnonzero((behind <= left) & (behind > left - windows))
        if len(own) < 2:
            continue
        node = _nodes(*right, LENGTH - behind)[own] * len(contexts) + _nodes(*back, behind)[own]
        by = np.lexsort((orders[own], node))
        node, own = node[by], own[by]
        new = np.r_[True, node[1:] != node[:-1]]
        least = orders[own][new][np.cumsum(new) - 1]
        later = own[orders[own] > least]
        out[later, left[later] - behind] = True
    return out


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tid, check, at, n): ``n`` repeated windows from word ``at`` on. Rows come sorted by route."""
    names = ["tid", "check", "at", "n"]
    held: list[dict] = []

    def solve(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        out = []
        least: dict[tuple[int, int], int] = {}
        trees = []
        for r in rows:
            if r["kind"] == WINDOW:
                key = r["route"], r["name"]
                least[key] = min(least.get(key, LAST), r["ord"])
            elif r["kind"] == CONTEXT:
                trees.append(r)
        for r in rows:
            if r["kind"] == MARK or (r["kind"] == WINDOW and r["ord"] > least[r["route"], r["name"]]):
                out += [(r["tid"], r["check"], at, r["n"]) for at in r["places"]]
        if trees:
            left, orders = (np.array([r[c] for r in trees], dtype=np.int64) for c in ("left", "ord"))
            found = repeated_windows([r["context"] for r in trees], left, orders)
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            (row, begin), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
            for i, a, b in zip(row.tolist(), begin.tolist(), end.tolist(), strict=True):
                out += [(trees[i]["tid"], trees[i]["check"], at + a, b - a) for at in trees[i]["places"]]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    for batch in batches:
        for i in range(0, batch.num_rows, 1 << 12):
            held += batch.slice(i, 1 << 12).to_pylist()
            if len(held) >= TOGETHER:
                # whole groups: the last route may go on
                cut = len(held)
                while cut and held[cut - 1]["route"] == held[-1]["route"]:
                    cut -= 1
                if cut:
                    yield from solve(held[:cut])
                    held = held[cut:]
    if held:
        yield from solve(held)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of every text, and the maximal runs of removed words."""
    for batch in slices(batches, "text", SLICE):
        rows = []
        columns = [batch.column("check").to_pylist(), raw(batch.column("text")), batch.column("marks").to_pylist()]
        for check, text, marks in zip(*columns, strict=True):
            words, spans = text.split(), []
            own = [(m["at"], m["n"]) for m in marks or () if m["check"] == check]
            if own:
                at, n = np.array(own).T
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + n + LENGTH - 1, -1)
                gone = np.r_[False, np.cumsum(edge)[:-1] > 0, False]
                bounds = np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2).tolist()
                spans = [{"start": a, "end": b} for a, b in bounds]
                left = [words[a:b] for a, b in zip([0, *(b for _, b in bounds)], [*(a for a, _ in bounds), len(words)], strict=True)]
                kept = b" ".join(w for part in left for w in part)
            else:
                kept = b" ".join(words)
            removed = sum(s["end"] - s["start"] for s in spans)
            rows.append((len(words), removed, spans, kept, hashlib.sha256(kept).hexdigest()))
        own = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int64(), SPANS, pa.binary(), pa.string()], strict=True)]
        own[3] = own[3].cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("tid"), batch.column("check"), batch.column("ord"), *own],
            ["tid", "check", "first", "n_words", "n_removed", "spans", "kept", "kept_sha256"],
        )


def without_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept, kept_sha256) for every row of ``docs``.

    A word goes if a window of LENGTH words over it also begins in a document with a smaller id; windows are judged on the
    texts as they came. ``spans`` are the maximal runs of removed words, end exclusive; ``kept`` the others joined by a space.
    Null texts have no words. Rows of one id do not remove one another's words; rows without id count as the last and as
    one id: they lose what any document with an id has, and nothing to one another.
    """
    named = _named(docs)
    table = _distinct(named)
    samples = cut_lineage(table.select("tid", "text").mapInArrow(_samples, "tid long, gram long, n long"))
    live = samples.groupBy("gram").agg(F.min("tid").alias("low"), F.max("tid").alias("high"), F.sum("n").alias("total"))
    live = live.where("low <> high").select("gram", (F.col("total") > hot).alias("hot"))
    # a text has at most one prefix per word, so a list is no larger than its text
    own = lookup(samples.select("tid", "gram"), live, "gram", "inner").groupBy("tid").agg(F.collect_list(F.struct("gram", "hot")).alias("live"))
    sent = table.join(own, "tid").select("tid", "check", "ord", "text", "live").mapInArrow(_suffixes, SENT_TYPE)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = sent.repartition(n, "route").sortWithinPartitions("route").mapInArrow(_marks, "tid long, check long, at long, n long")
    lists = marks.groupBy("tid").agg(F.collect_list(F.struct("check", "at", "n")).alias("marks"))
    result = table.join(lists, "tid", "left").select("tid", "check", "ord", "text", "marks").mapInArrow(
        _kept, "tid long, check long, first long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string, kept_sha256 string"
    )
    rows = lookup(named.select("doc_id", "ord", "tid", "check"), result, ["tid", "check"])
    copy = (F.col("ord") > F.col("first")) & (F.col("n_words") >= LENGTH)
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.array(F.struct(zero.alias("start"), F.col("n_words").alias("end")))).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
