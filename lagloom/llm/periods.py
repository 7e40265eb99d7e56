"""Periodic runs of words: maximal stretches that repeat with a period of at most half their length.

A run of smallest period q has the same words at i and i + q, in a context as long as fits into one period. At the
scale t, a power of two, the string synchronising set holds the places i where the smallest hash among the stretches of t
words that begin at i .. i + t is the first or the last of these. It depends on the 2t words from i on only, and every t
places in a row hold one of its places unless the 3t - 1 words from the first on have a period of t / 3 at most; such
stretches take no part in the minimum. So a run with 3t <= q < 6t has a place of the set with its 2t words inside the first
period, and the same place a period on: pairs of equal contexts 3t to 6t places apart propose all periods. A context
recurs after more than t / 3 places only, so a place has at most 18 partners.

Runs of periods below 6 are detected by themselves, comparing every word with the one q places on. What the sets omit is
runs whose first period is itself highly periodic, with some p of at most t / 3. Their halves lie in two runs of period p that
touch, with a break between; the break and the phase of the second leave periods q of one class modulo p, and these are proposed.

Proposals are extended word by word, so hashes never decide. Of runs over one stretch that with the smallest period counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lagloom.llm.common import raw, slices, texts
from lagloom.llm.words import A, B, mix

LEAST = 12  # words of a run
SMALL = 6  # periods below are compared directly
SLICE = 1 << 20
NEVER = np.uint64((1 << 64) - 1)
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _extend(codes: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """Where the stretch around ``at`` begins and ends in which every word equals the one ``q`` on. Ends of texts are unique."""
    low, high, step = at, at, 16
    while True:
        a, b = codes[high : high + step], codes[high + q : high + q + step]
        off = np.flatnonzero(a[: len(b)] != b)
        if len(off):
            high += int(off[0])
            break
        high, step = high + step, step * 2
    step = 16
    while True:
        begin = max(low - step, 0)
        off = np.flatnonzero(codes[begin:low] != codes[begin + q : low + q])
        if len(off):
            return begin + int(off[-1]) + 1, high
        low, step = begin, step * 2


class _Found:
    """Runs (begin, end) of the joined texts with their smallest period."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.period: dict[tuple[int, int], int] = {}
        self.by_period: dict[int, list[tuple[int, int]]] = {}

    def add(self, begin: int, end: int, q: int) -> None:
        # a run of period 1 or 2 counts as highly periodic before it is long enough to be reported
        if end - begin < max(2 * q, {1: 4, 2: 8}.get(q, LEAST)):
            return
        known = self.period.get((begin, end))
        if known is None or q < known:
            if known is not None:
                self.by_period[known].remove((begin, end))
            self.period[begin, end] = q
            self.by_period.setdefault(q, []).append((begin, end))

    def propose(self, places: np.ndarray, periods: np.ndarray) -> None:
        """Extend each place with the period named for it, once per run."""
        order = np.lexsort((places, periods))
        last, upto = 0, 0
        for at, q in zip(places[order].tolist(), periods[order].tolist(), strict=True):
            if q == last and at < upto:
                continue
            begin, end = _extend(self.codes, at, q)
            last, upto = q, end
            if end > at:
                self.add(begin, end + q, q)

    def small(self, q: int) -> None:
        """All runs of a small period, by comparing every word with the one ``q`` on."""
        same = np.flatnonzero(self.codes[:-q] == self.codes[q:])
        if len(same):
            cuts = np.flatnonzero(np.r_[True, same[1:] != same[:-1] + 1])
            begins, ends = same[cuts], same[np.r_[cuts[1:], len(same)] - 1] + 1
            long = ends - begins >= max(q, {1: 3, 2: 6}.get(q, LEAST - q))
            for begin, end in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
                self.add(begin, end + q, q)

    def highly_periodic(self, t: int, size: int) -> np.ndarray | None:
        """Flags of the places where ``t`` words of a period of at most t / 3 begin, or None if there are none."""
        edge = None
        for q, runs in self.by_period.items():
            if 3 * q <= t:
                for begin, end in runs:
                    if end - begin >= t:
                        edge = np.zeros(size + 1, dtype=np.int32) if edge is None else edge
                        edge[begin] += 1
                        edge[end - t + 1] -= 1
        return None if edge is None else np.cumsum(edge[:-1]) > 0

    def omitted(self, t: int) -> None:
        """Runs of a period from 3t to 6t whose period is itself periodic, proposed by two runs that touch."""
        for p in [p for p in self.by_period if 2 <= p <= t // 3]:
            runs = sorted(r for r in self.by_period[p] if r[1] - r[0] >= 3 * t)
            for (_, end), (begin, last) in zip(runs, runs[1:], strict=False):
                if not end - p < begin <= end:
                    continue
                root = self.codes[begin : begin + p]
                phase = [x for x in range(end - 2 * p + 1, end - p + 1) if np.array_equal(self.codes[x : x + p], root)]
                if phase:
                    first = begin - phase[0]
                    periods = np.arange(first + -(-(3 * t - first) // p) * p, min(6 * t, last - begin + 1), p)
                    periods = periods[end - periods >= 0]
                    self.propose(end - periods, periods)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` values from every place on; the last places see fewer."""
    out, step = values.copy(), 1
    while step * 2 <= width:
        np.minimum(out[:-step], out[step:], out=out[:-step])
        step *= 2
    rest = width - step
    if rest:
        np.minimum(out[:-rest], out[rest:], out=out[:-rest])
    return out


def find_runs(texts_words: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of LEAST words or more, by start, then period, for each list of words."""
    known: dict = {}
    sizes = np.array([len(w) for w in texts_words], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes  # a place before every text, and one after the last, is like no other
    codes = -np.arange(1, int(sizes.sum()) + len(sizes) + 2, dtype=np.int64)
    for at, words in zip(first.tolist(), texts_words, strict=True):
        codes[at : at + len(words)] = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    found = _Found(codes)
    for q in range(1, SMALL):
        if len(codes) > q:
            found.small(q)

    doc = np.repeat(np.arange(len(sizes)), sizes + 1)
    room = np.repeat(first + sizes, sizes + 1) - np.arange(len(doc))  # words up to the end of the text
    place = np.arange(len(doc))
    hashes = codes[:-1].view(np.uint64) * A
    hashes ^= hashes >> np.uint64(31)
    hashes *= B
    t = 1
    while len(place):
        # stretches of 2t words; a scale looks at texts that have room for two periods
        longer = hashes.copy()
        longer[:-t] = mix(hashes[:-t], hashes[t:])
        hashes, t = longer, t * 2
        keep = sizes[doc] >= 6 * t
        place, doc, room, hashes = place[keep], doc[keep], room[keep], hashes[keep]
        if not len(place):
            break
        contexts = hashes.copy()
        contexts[:-t] = mix(hashes[:-t], hashes[t:])
        values = hashes
        periodic = found.highly_periodic(t, len(codes))
        if periodic is not None:
            values = np.where(periodic[place], NEVER, hashes)
        least = _least(values, t + 1)
        chosen = np.flatnonzero((room >= 2 * t) & (least < NEVER))
        chosen = chosen[(values[chosen] == least[chosen]) | (values[chosen + t] == least[chosen])]
        order = np.argsort(contexts[chosen], kind="stable")
        context, at = contexts[chosen][order], place[chosen][order]
        k, pairs = 1, []
        while k < len(at):
            gap = at[k:] - at[:-k]
            near = (context[k:] == context[:-k]) & (gap < 6 * t)
            if not near.any():
                break
            take = near & (gap >= 3 * t)
            pairs.append((at[:-k][take], gap[take]))
            k += 1
        if pairs:
            found.propose(*(np.concatenate(c) for c in zip(*pairs, strict=True)))
        found.omitted(t)

    out: list[list] = [[] for _ in texts_words]
    for (begin, end), q in found.period.items():
        if end - begin >= LEAST:
            i = int(np.searchsorted(first, begin, side="right")) - 1
            out[i].append((begin - int(first[i]), end - begin, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, kept) for every row of ``docs``.

    ``runs`` are (start, length, period) in words, by start, then period; ``kept`` the words that no run holds after its first
    period, joined by a space. A null or empty text has no words and no runs. Rows do not depend on one another.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = [t.split() for t in raw(batch.column("text"))]
            runs = find_runs(words)
            kept = []
            for own, found in zip(words, runs, strict=True):
                if found:
                    gone = np.zeros(len(own), dtype=bool)
                    for start, length, period in found:
                        gone[start + period : start + length] = True
                    own = [own[i] for i in np.flatnonzero(~gone).tolist()]
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[{"start": a, "length": n, "period": q} for a, n, q in r] for r in runs], RUNS),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "kept"],
            )

    return texts(docs).mapInArrow(scan, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")
