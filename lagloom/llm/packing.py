"""Packing of tokenised documents into sequences by the sum-of-squares rule.

A document longer than a sequence is cut so that all pieces but the first are full; what is left to pack is one piece
per document. An open bin is known by its gap alone. A piece goes where the sum, over all gaps, of the squared number
of open bins with that gap becomes smallest, which keeps the gaps diverse and lets most bins be filled to the last
token. Every task packs a shard of pieces so, and ends by packing its open bins and some of its filled ones anew, the
longest piece first. Pieces of bins still open go on to fewer shards, round by round, until one shard, of bounded
size, is left.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.common import slices, texts
from lagloom.session import cut_lineage

LENGTH, END = 1024, 2
SHARD = 1 << 16  # pieces of one task, about
REOPEN = 0.3  # share of the filled bins that the last step of a shard may open again
#: Characters that every edition of the pre-token pattern classes alike.
SURE = re.compile("[^\t\n\r -~¡-¬®-ɏЀ-џ‐-‧€]")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids as the tokenizers library gives them for ``path``.

    ``ranks``, the same vocabulary as a rank file, speeds up texts whose characters are classed alike by both libraries
    and that hold no special string; all others go through the tokenizers library.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or SURE.search(text) or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def pieces(docs: DataFrame, path: str, ranks: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``; the ids of a null text are the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path, ranks)
        for batch in slices(batches, "text", 1 << 20):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.array([*encode(text), end], dtype="<u4")
                head = len(ids) % length or min(len(ids), length)
                cuts = [0, *range(head, len(ids) + 1, length)]
                rows += [(doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each length, and the gap every bin is left with."""
    count = np.zeros(size + 1, dtype=np.int64)  # open bins by gap; gap 0 is never counted
    bins: list[list[int]] = [[] for _ in range(size + 1)]
    gaps: list[int] = []
    where, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i, n in enumerate(lengths.tolist()):
        best, gap = 0, size
        if n < size:
            # change of the sum, halved and less one, if the piece goes into a bin with gap n, n + 1, ... size - 1
            change = count[: size - n] - count[n:size]
            change[0] -= 1  # a filled bin counts no more
            change = np.where(count[n:size] > 0, change, size * len(lengths) + 1)
            at = int(change.argmin())
            if change[at] <= count[size - n] - 1 or count[n] > 0:
                best, gap = 1, n + at
        if best:
            b = bins[gap].pop()
            count[gap] -= 1
        else:
            b = len(gaps)
            gaps.append(size)
        where[i], offset[i] = b, size - gap
        gap -= n
        gaps[b] = gap
        if gap:
            bins[gap].append(b)
            count[gap] += 1
    return where, offset, np.array(gaps, dtype=np.int64)


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``sum_of_squares``: the longest first, each into the smallest gap that holds it."""
    bins: list[list[int]] = [[] for _ in range(size + 1)]
    open_gaps: list[int] = []
    gaps: list[int] = []
    where, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect.bisect_left(open_gaps, n)
        if at < len(open_gaps):
            gap = open_gaps[at]
            b = bins[gap].pop()
            if not bins[gap]:
                del open_gaps[at]
        else:
            gap, b = size, len(gaps)
            gaps.append(size)
        where[i], offset[i] = b, size - gap
        gap -= n
        gaps[b] = gap
        if gap:
            if not bins[gap]:
                bisect.insort(open_gaps, gap)
            bins[gap].append(b)
    return where, offset, np.array(gaps, dtype=np.int64)


def pack_shard(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of squares for all pieces; then the bins left open, and of the filled ones those with the shortest pieces,
    are packed anew from the longest piece down, if that takes fewer bins."""
    where, offset, gaps = sum_of_squares(lengths, size)
    if not (gaps > 0).any():
        return where, offset, gaps
    shortest = np.full(len(gaps), size + 1, dtype=np.int64)
    np.minimum.at(shortest, where, lengths)
    full = np.flatnonzero((gaps == 0) & (shortest < size))
    again = gaps > 0
    again[full[np.argsort(shortest[full], kind="stable")[: int(len(full) * REOPEN)]]] = True
    rest = again[where]
    w, o, g = best_fit_decreasing(lengths[rest], size)
    if len(g) > again.sum():
        return where, offset, gaps
    kept = np.cumsum(~again) - 1
    new_where = np.where(rest, 0, kept[where])
    new_where[rest] = w + int((~again).sum())
    offset[rest] = o
    return new_where, offset, np.concatenate([gaps[~again], g])


def pack(items: DataFrame, size: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """``items`` with sequence_id and offset; needs doc_id, piece, start, length and ids_crc32.

    Full pieces are sequences of their own. The shards of a round are drawn by a hash of the piece, so that each has
    the lengths of the whole; only bins with a gap pass their pieces on. A round that has one shard is the last, and so is
    one that leaves more than half of its pieces in bins with a gap.
    """
    spark = items.sparkSession
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long"
    names = [c.split()[0] for c in columns.split(", ")]

    def packed(number: int, last: bool):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["order", "doc_id", "piece", "start", "length", "ids_crc32"], kind="stable")
            where, offset, gaps = pack_shard(group["length"].to_numpy(), size)
            done = (gaps[where] == 0) | last
            return group[names].assign(
                sequence_id=(number << 56) + (int(key[0]) << 24) + where, offset=offset, done=done,
            )

        return run

    done: list[DataFrame] = []
    left, n, number = items.select(*names), items.count(), 0
    while True:
        shards = max(1, -(-n // shard))
        placed = cut_lineage(
            left.withColumn("order", F.xxhash64("doc_id", "piece", F.lit(number)))
            .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(number + 1000)), F.lit(shards)))
            .groupBy("shard").applyInPandas(packed(number, shards == 1), f"{columns}, sequence_id long, offset long, done boolean")
        )
        open_pieces = 0 if shards == 1 else placed.where("not done").count()
        if 2 * open_pieces > n:  # most lengths leave gaps whatever they are packed with: another round would not help
            shards = 1
        done.append((placed if shards == 1 else placed.where("done")).drop("done"))
        if shards == 1 or not open_pieces:
            break
        left, n, number = placed.where("not done").select(*names), open_pieces, number + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def packed_sequences(docs: DataFrame, path: str, ranks: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of ``docs``.

    Every document has at least its end id, so a null or empty text is a piece of one token. Repeated rows are packed
    as often as they occur. An empty table gives no rows; other columns are not read.
    """
    return pack(cut_lineage(pieces(docs, path, ranks)))
