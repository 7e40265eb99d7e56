"""Passages repeated from earlier documents, removed byte by byte.

Every string of LENGTH bytes has an anchor, the place among its 24-byte words whose hash is smallest, so equal strings
share it. Three passes over the documents, dealt out once by id, use this:

1. Anchors, of each task those of the smallest document, meet by hash (32 bits of it and the part); those that occur in two documents go back to theirs.
2. Around each of these a document sends its context, the bytes of all strings that have the anchor. Within a task a
   context seen before, in a smaller document, is marked at once, so a copy is sent once per task.
3. Contexts of an anchor meet in a block. The block's suffixes are ordered, its Burrows-Wheeler transform is kept as runs
   with a sample at the end of each, and every context is streamed backwards through the runs. The row of a string of
   LENGTH bytes names the interval of equal strings, and the interval the smallest document.

Marks return to their documents and are joined to maximal runs there. A hot anchor, one of HOT contexts or more as a sample
of the documents tells beforehand, is not sent whole: its strings go one by one, each to the part its content names, those
a task saw before in a smaller document as a mark. The sample decides the way only; a hot anchor it misses is split in its
task, bucket by bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.common import raw, slices, texts

LENGTH, GRAM = 50, 24
SPAN = LENGTH - GRAM + 1  # grams of a string
CHUNK, POSITION = 1 << 17, 18  # strings hashed at once, and bits that hold a place among them
SLICE = 4 << 20  # bytes of texts looked at together
BLOCK = 1 << 20  # bytes of contexts indexed together
SEEN = 1 << 17  # contexts a task remembers
HOT, SAMPLED = 1 << 14, 16  # contexts of an anchor that goes string by string, estimated from one document in so many


def anchors(buf: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor of texts laid end to end: its text, hash, first and last start of the strings that have it."""
    none = np.empty(0, dtype=np.int64)
    n = len(buf) - length + 1
    if n < 1:
        return none, none.astype(np.uint64), none, none
    data = np.concatenate([buf, np.zeros(8, dtype=np.uint8)]).tobytes()
    hashes, chosen = np.empty(len(buf) - GRAM + 1, dtype=np.uint64), np.empty(n, dtype=np.int64)
    mask = np.uint64((1 << POSITION) - 1)
    for lo in range(0, n, CHUNK):
        strings = min(CHUNK, n - lo)
        grams = strings + SPAN - 1
        word = np.ndarray(shape=(grams + 16,), dtype="<u8", buffer=data, offset=lo, strides=(1,)).astype(np.uint64)
        h = word[:grams] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h += word[8 : 8 + grams]
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h += word[16 : 16 + grams]
        h *= np.uint64(0x165667B19E3779F9)
        h ^= h >> np.uint64(32)
        hashes[lo : lo + grams] = h
        key = (h & ~mask) | np.arange(grams, dtype=np.uint64)  # of equal hashes the leftmost
        width = 1
        while width * 2 <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < SPAN:
            key = np.minimum(key[: len(key) - (SPAN - width)], key[SPAN - width :])
        chosen[lo : lo + strings] = (key & mask).astype(np.int64) + lo
    fits = np.ones(len(buf), dtype=bool)
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        fits[max(a, b - length + 1) : b] = False
    new = np.r_[True, chosen[1:] != chosen[:-1]] & fits[:n]
    new[1:] |= fits[1:n] & ~fits[: n - 1]
    last = np.r_[new[1:] | ~fits[1:n], True] & fits[:n]
    first = np.flatnonzero(new)
    return np.searchsorted(ends, first, side="right"), hashes[chosen[first]], first, np.flatnonzero(last)


def _joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), dtype=np.uint8), np.cumsum([len(v) for v in values])


def _ordinals(text: np.ndarray) -> np.ndarray:
    """Number of each anchor within its text."""
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    return np.arange(len(text)) - np.repeat(first, np.diff(np.r_[first, len(text)]))


def _blob(squeeze: zstandard.ZstdCompressor, *arrays: np.ndarray | bytes) -> list[bytes]:
    return [squeeze.compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()) for a in arrays]


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences, which compress better; the cumulative sum gives the values back."""
    return np.diff(values, prepend=0)


def _by_part(part: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by part, then by ``more``; (part, from, to)."""
    order = np.lexsort((*more[::-1], part))
    sorted_part = part[order]
    cut = np.flatnonzero(np.r_[True, sorted_part[1:] != sorted_part[:-1]]) if len(part) else np.empty(0, np.int64)
    return order, [(int(sorted_part[a]), int(a), int(b)) for a, b in zip(cut, np.r_[cut[1:], len(part)], strict=True)]


#: A document within its id: rows that share an id are told apart by ``dup``; a place is dup << 40 | number.
DUP = 40
LOW = (1 << DUP) - 1


def _named(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows where ``column`` is not null. Left to Python: a filter would reach the scan of one pass and part its exchange
    from that of the others."""
    for batch in batches:
        yield batch.filter(batch.column(column).is_valid())


def _send_anchors(parts: int):
    names = ["part", "hash", "doc", "place", "known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in slices(_named(batches, "doc_id"), "text", SLICE):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            dup = batch.column("dup").to_numpy(zero_copy_only=False).astype(np.int64)
            text, h, _, _ = anchors(*_joined(raw(batch.column("text"))))
            if not len(text):
                continue
            doc, place = ids[text], _ordinals(text) | dup[text] << DUP
            # an anchor in several documents of the slice is known to be repeated: its smallest document speaks for all
            order = np.lexsort((doc, h))
            h, doc, place = h[order], doc[order], place[order]
            new = np.r_[True, h[1:] != h[:-1]]
            group = np.cumsum(new) - 1
            low = doc[new][group]
            spread = np.zeros(int(group[-1]) + 1, dtype=bool)
            spread[group[doc != low]] = True
            known = spread[group]
            speaks = doc == low
            part = np.where(speaks, (h % np.uint64(parts)).astype(np.int64), np.abs(doc * 31 + place) % parts)
            flag = np.where(speaks, known, 2).astype(np.uint8)
            order, cuts = _by_part(part, doc, place)
            short, doc, place, flag = (h[order] >> np.uint64(32)).astype("<u4"), doc[order], place[order], flag[order]
            rows = [(p, *_blob(squeeze, short[a:b][flag[a:b] < 2], _steps(doc[a:b]), _steps(place[a:b]), flag[a:b])) for p, a, b in cuts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 4, strict=True)], names
            )

    return run


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose anchor stands in two documents, part by part; rows come sorted by part."""
    expand = zstandard.ZstdDecompressor()

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = [[np.frombuffer(expand.decompress(r[i]), kind) for r in rows] for i, kind in enumerate(("<u4", "<i8", "<i8", "u1"))]
        key, flag = np.concatenate(columns[0]), np.concatenate(columns[3])
        doc, place = (np.concatenate([np.cumsum(x) for x in columns[i]]) for i in (1, 2))
        told = flag >= 2
        keep_doc, keep_place = [doc[told]], [place[told]]
        doc, place, flag = doc[~told], place[~told], flag[~told]
        if len(key):
            order = np.argsort(key, kind="stable")
            key, doc, place, flag = key[order], doc[order], place[order], flag[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            several = (np.maximum.reduceat(doc, new) != np.minimum.reduceat(doc, new)) | (np.maximum.reduceat(flag, new) > 0)
            hit = np.repeat(several, np.diff(np.r_[new, len(key)]))
            keep_doc.append(doc[hit])
            keep_place.append(place[hit])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keep_doc)), pa.array(np.concatenate(keep_place))], ["doc_id", "place"])

    yield from _per_part(batches, ["hash", "doc", "place", "known"], found)


def _per_part(batches: Iterator[pa.RecordBatch], names: list[str], found) -> Iterator[pa.RecordBatch]:
    part, rows = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        for own, *values in zip(batch.column("part").to_pylist(), *columns, strict=True):
            if own != part and rows:
                yield from found(rows)
                rows = []
            part = own
            rows.append(tuple(values))
    if rows:
        yield from found(rows)


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n): per anchor of a slice how many contexts differ."""
    for batch in slices(batches, "text", SLICE):
        buf, ends = _joined(raw(batch.column("text")))
        _, h, first, last = anchors(buf, ends)
        own, at, count = np.unique(h, return_inverse=True, return_counts=True)
        data, several = buf.tobytes(), np.flatnonzero(count[at] > 1)
        count[:] = 1
        differ = {(k, data[a : b + LENGTH]) for k, a, b in zip(at[several].tolist(), first[several].tolist(), last[several].tolist(), strict=True)}
        count += np.maximum(np.bincount(np.array([k for k, _ in differ], dtype=np.int64), minlength=len(own)) - 1, 0)
        yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(count.astype(np.int64))], ["hash", "n"])


def hot_anchors(docs: DataFrame) -> np.ndarray:
    """Hashes of anchors with some HOT contexts or more; there are at most as many as bytes / HOT."""
    some = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SAMPLED)) == 0))
    counts = some.mapInArrow(_count_contexts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") * SAMPLED >= HOT).select("hash").collect()
    return np.sort(np.array([r.hash for r in hot], dtype=np.int64).view(np.uint64))


def _send_contexts(parts: int, hot: np.ndarray):
    """Contexts of repeated anchors, one per task and content, and marks of those seen before in a smaller document; of
    ``hot`` anchors the strings, likewise."""
    names = ["part", "hash", "doc", "place", "size", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=6)
        seen: dict[bytes, int] = {}
        seen_strings: dict[bytes, int] = {}
        for batch in slices(_named(batches, "places"), "text", SLICE):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            dup = batch.column("dup").to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column("places")
            owner = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            places = lists.flatten().to_numpy(zero_copy_only=False)
            mine = places >> DUP == dup[owner]
            wanted = np.unique(owner[mine] << 32 | places[mine] & LOW)
            values = raw(batch.column("text"))
            buf, ends = _joined(values)
            text, h, first, last = anchors(buf, ends)
            if not len(text) or not len(wanted):
                continue
            number = text << 32 | _ordinals(text)
            chosen = np.flatnonzero(np.isin(number, wanted, assume_unique=True))
            data, starts = buf.tobytes(), ends - np.array([len(v) for v in values])
            if len(seen) > SEEN:
                seen.clear()
            sent, strings, marks = [], [], []
            whole = ~np.isin(h[chosen], hot)
            for i, t, a, b, keep in zip(chosen.tolist(), text[chosen].tolist(), first[chosen].tolist(), last[chosen].tolist(), whole.tolist(), strict=True):
                context = data[a : b + LENGTH]
                doc = int(ids[t])
                low = seen.setdefault(context, doc)
                place = a - int(starts[t]) | int(dup[t]) << DUP
                if low < doc:
                    marks.append((doc, place, b - a + LENGTH))
                elif keep:
                    sent.append((i, doc, place, context))
                else:
                    if len(seen_strings) > SEEN:
                        seen_strings.clear()
                    since = None  # where a run of strings seen before begins
                    for k in range(b - a + 1):
                        string = context[k : k + LENGTH]
                        if seen_strings.setdefault(string, doc) < doc:
                            since = k if since is None else since
                            continue
                        strings.append((string, doc, place + k))
                        if since is not None:
                            marks.append((doc, place + since, k - 1 - since + LENGTH))
                            since = None
                    if since is not None:
                        marks.append((doc, place + since, b - a - since + LENGTH))
            if sent:
                h_sent = h[np.array([s[0] for s in sent])]
                part = (h_sent % np.uint64(parts)).astype(np.int64)
                order, cuts = _by_part(part, np.arange(len(part)))
                rows = []
                for p, a, b in cuts:
                    own = [sent[i] for i in order[a:b].tolist()]
                    rows.append((p, *_blob(squeeze, (h_sent[order[a:b]] >> np.uint64(32)).astype("<u4"), _steps(np.array([s[1] for s in own])), _steps(np.array([s[2] for s in own])),
                                           np.array([len(s[3]) for s in own], dtype=np.int32), b"".join(s[3] for s in own))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 5, strict=True)], names
                )
            if strings:
                part = np.array([xxhash.xxh64_intdigest(s[0]) % parts for s in strings], dtype=np.int64)
                order, cuts = _by_part(part, np.arange(len(part)))
                rows = []
                for p, a, b in cuts:
                    content, doc, place = zip(*(strings[i] for i in order[a:b].tolist()), strict=True)
                    doc, place, content = _blob(squeeze, _steps(np.array(doc, dtype=np.int64)), _steps(np.array(place, dtype=np.int64)), b"".join(content))
                    rows.append((p, None, doc, place, None, content))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 5, strict=True)], names
                )
            if marks:
                # marks that need no index ride along; they are dealt by document
                doc, place, size = (np.array(c, dtype=np.int64) for c in zip(*marks, strict=True))
                order, cuts = _by_part(np.abs(doc) % parts, doc, place)
                rows = [(p, None, *_blob(squeeze, _steps(doc[order[a:b]]), _steps(place[order[a:b]]), size[order[a:b]].astype(np.int32)), None) for p, a, b in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 5, strict=True)], names
                )

    return run


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of distinct texts, each ended by a mark below all bytes.

    ``length`` is seven or more, the bytes ranked at first. Per run: first row, symbol, the row its first row leads back to, and the place of the suffix at its last row. Rows
    whose suffixes agree in LENGTH bytes form intervals; of these the first row and the smallest document are kept.
    """

    def __init__(self, values: list[bytes], docs: np.ndarray, length: int = LENGTH):
        sizes = np.array([len(v) for v in values], dtype=np.int64)
        buf = np.frombuffer(b"\0".join([*values, b""]), dtype=np.uint8)
        n = len(buf)
        ends = np.cumsum(sizes + 1) - 1  # places of the marks
        self.ends = ends
        symbol = buf.astype(np.int64) + 1
        symbol[ends] = 0
        left = np.repeat(ends, sizes + 1) - np.arange(n)  # bytes to the mark
        rank, width = symbol, 1
        packed = np.zeros(n, dtype=np.int64)
        for k in range(7):
            packed <<= 9
            packed[: n - k] += np.where(left[: n - k] >= k, rank[k:], 0)
        rank, width = np.unique(packed, return_inverse=True)[1], 7
        equal = None
        longest = int(sizes.max()) + 1
        while True:
            if equal is None and width * 2 >= length:
                step = length - width
                ahead = np.zeros(n, dtype=np.int64)
                ahead[: n - step] = np.where(left[: n - step] >= step, rank[step:] + 1, 0)
                equal = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
            if width >= longest or int(rank.max()) == n - 1:
                break
            ahead = np.zeros(n, dtype=np.int64)
            ahead[: n - width] = np.where(left[: n - width] >= width, rank[width:] + 1, 0)
            rank = np.unique(rank * (n + 1) + ahead, return_inverse=True)[1]
            width *= 2
        if equal is None:
            equal = rank
        order = np.argsort(rank, kind="stable")
        before = symbol[order - 1]  # what stands before a text is the mark of the one before it
        head = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.heads, self.symbols = head, before[head]
        size = np.diff(np.r_[head, n])
        by_symbol = np.argsort(self.symbols, kind="stable")
        self.back = np.empty(len(head), dtype=np.int64)
        self.back[by_symbol] = np.cumsum(size[by_symbol]) - size[by_symbol]
        self.samples = order[np.r_[head[1:], n] - 1]
        same = equal[order]
        self.interval = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
        owner = np.repeat(np.arange(len(values)), sizes + 1)
        self.smallest = np.minimum.reduceat(docs[owner[order]], self.interval)
        self.sizes, self.length, self.rows = sizes, length, n

    def lead_back(self, row: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.heads, row, side="right") - 1
        return self.back[run] + row - self.heads[run]

    def end_rows(self) -> np.ndarray:
        """Rows of the marks: suffixes of one symbol, ordered by place, come first."""
        return np.arange(len(self.sizes))

    def stream(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All texts backwards at once: (text, start, smallest document that has the string starting there)."""
        text, row, start = np.arange(len(self.sizes)), self.end_rows(), self.sizes.copy()
        while len(text):
            start = start - 1
            row = self.lead_back(row)
            matched = self.sizes[text] - start  # bytes matched so far; only those of LENGTH or more name an interval
            long = np.flatnonzero(matched >= self.length)
            if len(long):
                yield text[long], start[long], self.smallest[np.searchsorted(self.interval, row[long], side="right") - 1]
            go = start > 0
            text, row, start = text[go], row[go], start[go]


def mark(
    h: np.ndarray, values: list[bytes], docs: np.ndarray, places: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, place, size) of the parts of contexts that repeat a string of a smaller document.

    Equal contexts are one text of the index; one that differs from no other of its anchor needs no search.
    """
    number: dict[bytes, int] = {}
    kind = np.array([number.setdefault(v, len(number)) for v in values], dtype=np.int64)
    low = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(low, kind, docs)
    texts_by_kind = list(number)
    anchor = np.zeros(len(number), dtype=h.dtype)
    anchor[kind] = h
    _, group, size = np.unique(anchor, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(size[group] > 1)
    text = start = small = np.empty(0, dtype=np.int64)
    if len(mixed):
        index = RunIndex([texts_by_kind[i] for i in mixed.tolist()], low[mixed], length)
        text, start, small = (np.concatenate(x) for x in zip(*index.stream(), strict=True))
        text = mixed[text]
    # a context in a document above the smallest one that has it is repeated as a whole; in that one, where marked
    hit = small < low[text]
    order = np.lexsort((start[hit], text[hit]))
    text, start = text[hit][order], start[hit][order]
    new = np.r_[True, (text[1:] != text[:-1]) | (start[1:] > start[:-1] + 1)] if len(text) else np.empty(0, bool)
    last = np.r_[new[1:], True] if len(text) else new
    run_text, run_from, run_to = text[new], start[new], start[last] + length
    whole = np.flatnonzero(docs > low[kind])
    own = np.flatnonzero(docs == low[kind])
    first = np.searchsorted(run_text, kind[own], side="left")
    count = np.searchsorted(run_text, kind[own], side="right") - first
    which = np.repeat(own, count)
    run = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    return (
        np.concatenate([docs[whole], docs[which]]), np.concatenate([places[whole], places[which] + run_from[run]]),
        np.concatenate([sizes[whole], run_to[run] - run_from[run]]),
    )


def blocks(h: np.ndarray, docs: np.ndarray, places: np.ndarray, values: list[bytes]) -> Iterator[tuple]:
    """Contexts in blocks that keep an anchor together; one too large for a block goes string by string, by content."""
    order = np.argsort(h, kind="stable")
    cut = np.r_[np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]]), len(h)]
    held: list[int] = []
    size = 0
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        own = order[a:b].tolist()
        if len(own) == 1:
            continue  # its anchor's hash was shared, not its document
        weight = sum(len(values[i]) for i in own)
        if weight > BLOCK:
            count = np.array([len(values[i]) - LENGTH + 1 for i in own])
            owner = np.repeat(np.array(own), count)
            start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            content = np.fromiter(
                (xxhash.xxh64_intdigest(values[i][k : k + LENGTH]) for i in own for k in range(len(values[i]) - LENGTH + 1)), np.uint64, len(owner)
            )
            bucket = content % np.uint64(1 + weight * 8 // BLOCK)
            by_bucket = np.argsort(bucket, kind="stable")
            for part in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1):
                strings = [values[i][k : k + LENGTH] for i, k in zip(owner[part].tolist(), start[part].tolist(), strict=True)]
                yield content[part], strings, docs[owner[part]], places[owner[part]] + start[part]
            continue
        if size + weight > BLOCK and held:
            yield h[held], [values[i] for i in held], docs[held], places[held]
            held, size = [], 0
        held += own
        size += weight
    if held:
        yield h[held], [values[i] for i in held], docs[held], places[held]


def repeated_strings(content: bytes, docs: np.ndarray) -> np.ndarray:
    """Which of the strings of LENGTH bytes laid end to end stand in a smaller document too."""
    ended = np.ones((len(docs), LENGTH + 1), dtype=np.uint8)  # a last byte that is not zero keeps zeros before it
    ended[:, :LENGTH] = np.frombuffer(content, dtype=np.uint8).reshape(-1, LENGTH)
    kind = np.unique(ended.view(f"S{LENGTH + 1}").ravel(), return_inverse=True)[1]
    low = np.full(len(docs), np.iinfo(np.int64).max)
    np.minimum.at(low, kind, docs)
    return np.flatnonzero(docs > low[kind])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()

    def batch_of(doc: np.ndarray, place: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place), pa.array(size.astype(np.int64))], ["doc_id", "place", "size"])

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        hs, docs, places, values = [], [], [], []
        strings = []
        for h, doc, place, size, content in rows:
            doc, place = (np.cumsum(np.frombuffer(expand.decompress(x), "<i8")) for x in (doc, place))
            if size is None:
                strings.append((doc, place, expand.decompress(content)))
                continue
            sizes = np.frombuffer(expand.decompress(size), "<i4")
            if h is None:
                yield batch_of(doc, place, sizes)
                continue
            hs.append(np.frombuffer(expand.decompress(h), "<u4"))
            docs.append(doc)
            places.append(place)
            data, at = expand.decompress(content), 0
            for n in sizes.tolist():
                values.append(data[at : at + n])
                at += n
        if values:
            for block in blocks(np.concatenate(hs), np.concatenate(docs), np.concatenate(places), values):
                yield batch_of(*mark(*block))
        if strings:
            doc, place = (np.concatenate([s[i] for s in strings]) for i in (0, 1))
            hit = repeated_strings(b"".join(s[2] for s in strings), doc)
            yield batch_of(doc[hit], place[hit], np.full(len(hit), LENGTH))

    yield from _per_part(batches, ["hash", "doc", "place", "size", "bytes"], found)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of every text without the marked bytes."""
    for batch in batches:
        lists, rows = batch.column("marks"), []
        dups = batch.column("dup").to_pylist()
        flat = lists.flatten()
        place, size = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        bounds = np.r_[0, np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))]
        for i, value in enumerate(raw(batch.column("text"))):
            a, b = int(bounds[i]), int(bounds[i + 1])
            removed = spans = 0
            kept = value
            if b > a:
                own = place[a:b] >> DUP == dups[i]
                begin = place[a:b][own] & LOW
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], (begin + size[a:b][own])[order]
                if len(begin):
                    reach = np.maximum.accumulate(end)
                    new = np.r_[True, begin[1:] > reach[:-1]]
                    lows, highs = begin[new], reach[np.r_[new[1:], True]]
                    removed, spans = int((highs - lows).sum()), len(lows)
                    kept = b"".join(value[x:y] for x, y in zip([0, *highs.tolist()], [*lows.tolist(), len(value)], strict=True))
            rows.append((len(value), removed, spans, kept))
        n, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``; kept holds the bytes left.

    A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller doc_id, both in the input.
    Matches never cross texts. Rows that share a doc_id are no earlier than one another; a row without doc_id is neither
    removed from nor removes. Null, empty and short texts stay as they are; an empty table gives no rows.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts(docs).repartition(n, "doc_id")
    dealt = dealt.withColumn("dup", F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1)
    blob = "hash binary, doc binary, place binary"
    sent = dealt.mapInArrow(_send_anchors(n), f"part int, {blob}, known binary")
    repeated = sent.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_repeated_anchors, "doc_id long, place long")
    places = repeated.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    hot = hot_anchors(texts(docs))
    contexts = dealt.join(places, "doc_id", "left").mapInArrow(_send_contexts(n, hot), f"part int, {blob}, size binary, bytes binary")
    marks = contexts.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_marks, "doc_id long, place long, size long")
    grouped = marks.groupBy("doc_id").agg(F.collect_list(F.struct("place", "size")).alias("marks"))
    return dealt.join(grouped, "doc_id", "left").select("doc_id", "text", "dup", "marks").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
