"""Frequent phrases of a corpus and their cohesion, by Toivonen's sampling.

1. A sample of the documents, one in RATE, proposes phrases: those of 1 to LONGEST words counted there LOWERED times.
2. A full pass counts the proposals and their negative border, the phrases not proposed whose parts without the last and
   without the first word both are, and every word.
3. A border phrase with the support is a failure: it may have frequent phrases above it that nobody counted. The frequent
   phrases then take the place of the proposals and an expansion pass counts their border. To it, phrases that it is about to count
   are known too, so it goes on to every size, and the border is closed after it: every part of a frequent phrase is
   frequent, so either counted before or counted by it. Without failures there is no such pass.

A last pass spells the frequent phrases, each in the texts of one of 2 ** OWNER_BITS shares, the least that holds it.

Tasks know the proposals by a Bloom filter, sized by their number and at most FILTER bytes. What it lets through besides is
counted too, so it costs rows, never results, also where proposals outgrow it. Phrases are counted by 64-bit hashes: among a
billion different ones two share a hash with a chance of some 3 %, and would be counted together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.common import raw, slices, texts
from lagloom.llm.words import A, B, mix
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage, discard

SUPPORT, LONGEST, COVER = 30, 4, 80  # least count, words of a phrase, percent of a count that a longer phrase takes over
RATE, LOWERED = 16, 2  # one document in RATE is sampled; a proposal has LOWERED counts there
FILTER, BLOCK = 1 << 27, 1 << 16  # most bytes of a filter, bytes of it made together
BUFFER, HELD = 3 << 20, 1 << 19  # hashes that a task holds before it counts them; phrases that it remembers having spelled
OWNER_BITS = 8
RANGE_BITS = 3  # first bits of a hash: a task sorts and counts the hashes it holds range by range
SLICE = 1 << 19

UPPER = bytes(range(65, 91))
PLAIN = bytes.maketrans(UPPER + b"\t.,;:!?\x0b\x0c\r", UPPER.lower() + b" " + b"\n" * 9)


class _Bits:
    """A Bloom filter of two probes; without bits everything passes."""

    def __init__(self, bits: bytes) -> None:
        self.bits = np.frombuffer(bits, dtype=np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for probe in _probes(keys, len(self.bits) * 8):
            out &= (self.bits[probe >> 3] >> (probe & 7).astype(np.uint8)) & 1 == 1
        return out


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of every key among ``bits``, a power of two."""
    mask = np.uint64(bits - 1)
    return (keys & mask).astype(np.int64), ((keys * A >> np.uint64(20)) & mask).astype(np.int64)


def _filter(keys: DataFrame) -> list[bytes] | None:
    """Bits of the keys in blocks: 16 to 32 bits a key, up to FILTER bytes in all. None if there is no key.

    With a column ``owner``, of the keys mixed with it. They are mixed here: a Python step before this one would have every
    task hold two Python workers, and the executor keeps them.
    """
    count = keys.count()
    if not count:
        return None
    size = min(max(BLOCK, 1 << (2 * count - 1).bit_length()), FILTER)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [c.to_numpy().view(np.uint64) for c in batch.columns]
            probes = np.concatenate(_probes(mix(*parts) if len(parts) > 1 else parts[0], size * 8))
            yield pa.RecordBatch.from_arrays([pa.array(probes // (BLOCK * 8)), pa.array(probes % (BLOCK * 8))], ["block", "bit"])

    def block(table: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK * 8, dtype=np.uint8)
        bits[table.column("bit").to_numpy()] = 1
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([packed], pa.binary())})

    named = keys.select("key", *(c for c in keys.columns if c == "owner"))
    rows = named.mapInArrow(places, "block long, bit long").groupBy("block").applyInArrow(block, "block long, bits binary").toArrow()
    made = dict(zip(rows.column("block").to_pylist(), rows.column("bits").to_pylist(), strict=True))
    return [made.get(i, bytes(BLOCK)) for i in range(size // BLOCK)]


class _Slice:
    """Words of some texts as places in their joined bytes, by text and piece."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        texts_ = raw(batch.column("text"))
        self.langs: list[str] = batch.column("lang").to_pylist()
        self.bytes = b"\n".join([*texts_, b""]).translate(PLAIN)
        data = np.frombuffer(self.bytes, dtype=np.uint8)
        line = data == 10
        gap = np.r_[True, line | (data == 32)]
        bounds = np.flatnonzero(gap[1:] != gap[:-1])
        self.begin, self.end = bounds[::2], bounds[1::2]  # the last byte is a gap
        self.piece = np.searchsorted(np.flatnonzero(line), self.begin)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts_], dtype=np.int64))
        self.row = np.searchsorted(ends, self.begin, side="right")
        self.sizes = np.bincount(self.row, minlength=len(texts_))
        self.owner = np.array([xxhash.xxh3_64_intdigest(t) & ((1 << OWNER_BITS) - 1) for t in texts_], dtype=np.int64)

    def words(self, seed: int) -> np.ndarray:
        """Hash of every word with its language: a polynomial of its bytes, as a difference of running sums."""
        if not len(self.begin):
            return np.zeros(0, dtype=np.uint64)
        table = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        data = np.frombuffer(self.bytes, dtype=np.uint8)
        up, down = _powers(len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(table[data] * up, out=sums[1:])
        own = (sums[self.end] - sums[self.begin]) * down[self.begin]
        known = {lang: xxhash.xxh64_intdigest(lang.encode(), seed) for lang in set(self.langs)}
        return mix(own, np.array([known[lang] for lang in self.langs], dtype=np.uint64)[self.row])

    def phrases(self, seed: int = 0) -> list[np.ndarray]:
        """Hashes of the phrases of 1, 2, .. LONGEST words from every word on, whether of one piece or not."""
        words = self.words(seed)
        out = [words]
        for size in range(2, LONGEST + 1):
            out.append(mix(out[-1][:-1], words[size - 1 :]) if len(words) >= size else words[:0])
        return out

    def inside(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each place on are of one piece."""
        count = max(len(self.piece) - size + 1, 0)
        return self.piece[:count] == self.piece[size - 1 :][:count]

    def spell(self, at: int, size: int) -> bytes:
        return b" ".join([self.bytes[a:b] for a, b in zip(self.begin[at : at + size].tolist(), self.end[at : at + size].tolist(), strict=True)])


_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64, kept for the next texts."""
    if not _POWERS or len(_POWERS[0]) < size:
        inverse = pow(int(B), -1, 1 << 64)
        _POWERS[:] = [
            np.multiply.accumulate(np.r_[np.ones(1, dtype=np.uint64), np.full(size - 1, base, dtype=np.uint64)]) for base in (B, np.uint64(inverse))
        ]
    return _POWERS[0][:size], _POWERS[1][:size]


def _offered(
    part: _Slice, hashes: list[np.ndarray], bits: _Bits, before: list[np.ndarray] | None = None, words_only: bool = False
) -> list[np.ndarray]:
    """By size: places of the phrases whose two parts are known and that no pass ``before`` offered.

    Known is what the filter holds; if there was a pass before, what this one is about to count is known as well.
    """
    known = bits.has(hashes[0])
    words, out = known, [np.ones(len(known), dtype=bool)]
    for size in range(2, LONGEST + 1):
        own = known[:-1] & (words[size - 1 :] if words_only else known[1:]) & part.inside(size)
        new = own if before is None else own & ~before[size - 1]
        out.append(new)
        known = own
        if not words_only and size < LONGEST:
            known = new.copy() if before is not None else np.zeros(len(own), dtype=bool)
            at = np.flatnonzero(own & ~known)
            known[at] = bits.has(hashes[size - 1][at])
    return out


def _count(docs: DataFrame, bits: list[list[bytes]], sizes: range, words_only: bool = False) -> DataFrame:
    """(key, n, owner): counts of the phrases of these sizes that the last filter offers and no filter before it did.

    ``owner`` is the least share of the texts, of 2 ** OWNER_BITS shares by their content, that holds the phrase.
    """
    sent = [docs.sparkSession.sparkContext.broadcast(b"".join(b)) for b in bits]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [_Bits(b.value) for b in sent]
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for low in range(1 << RANGE_BITS if held else 0):
                own = [k >> np.uint64(64 - RANGE_BITS) == low for k, _ in held]
                keys, owner = (np.concatenate([c[at] for c, at in zip(cs, own, strict=True)]) for cs in zip(*held, strict=True))
                order = np.argsort(keys)
                keys, owner = keys[order], owner[order]
                new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
                n, keys = np.diff(np.r_[new, len(keys)]), keys[new].view(np.int64)
                owner = np.minimum.reduceat(owner, new) if len(new) else owner
                both = n << OWNER_BITS | owner
                for i in range(0, len(keys), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)]) for c in (keys, both)], ["key", "both"])
            held.clear()

        for batch in slices(batches, "text", SLICE):
            part = _Slice(batch)
            hashes = part.phrases()
            places = [np.ones(len(hashes[0]), dtype=bool)]
            if filters:
                places = None
                for bits in filters:
                    places = _offered(part, hashes, bits, places, words_only)
            for size in sizes:
                at = np.flatnonzero(places[size - 1])
                held.append((hashes[size - 1][at], part.owner[part.row[at]].astype(np.uint8)))
            if sum(len(k) for k, _ in held) >= BUFFER:
                yield from flush()
        yield from flush()

    # a key comes a few times from a task, so nothing is added before the exchange
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = F.col("both")
    return docs.mapInArrow(scan, "key long, both long").repartition(parts, "key").groupBy("key").agg(
        F.sum(F.shiftright(both, OWNER_BITS)).alias("n"), F.min(both.bitwiseAND((1 << OWNER_BITS) - 1)).alias("owner")
    )


def _read(docs: DataFrame) -> DataFrame:
    return texts(docs.withColumn("lang", F.coalesce(F.col("lang").cast("string"), F.lit("und"))), "lang")


def _proposed(rows: DataFrame, rate: int, lowered: int) -> DataFrame:
    """Hashes of the phrases found ``lowered`` times in the sample."""
    sample = rows.where(F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text"))), F.lit(rate)) == 0)
    words = cut_lineage(_count(sample, [], range(1, 2)).where(F.col("n") >= lowered).select("key"))
    bits = _filter(words)
    if bits is None:
        return words
    longer = _count(sample, [bits], range(2, LONGEST + 1), words_only=True).where(F.col("n") >= lowered).select("key")
    return cut_lineage(words.unionByName(longer))


def _closed(rows: DataFrame, support: int, rate: int, lowered: int) -> tuple[DataFrame, list[int]]:
    """(key, n, owner) of all frequent phrases, and how many of them each full pass found that were not proposed to it."""
    proposed = _proposed(rows, rate, lowered)
    first = _filter(proposed) or [bytes(BLOCK)]
    counted = cut_lineage(_count(rows, [first], range(1, LONGEST + 1)).where(F.col("n") >= support))
    failures = [counted.join(proposed, "key", "left_anti").count()]
    discard(proposed)
    if failures[0]:
        # phrases that this pass counts are known to it, so it reaches every size and leaves no border open
        more = cut_lineage(_count(rows, [first, _filter(counted.select("key"))], range(2, LONGEST + 1)).where(F.col("n") >= support))
        failures.append(more.count())
        counted = counted.unionByName(more)
    return counted, failures


def _spelled(rows: DataFrame, bits: list[bytes]) -> DataFrame:
    """(key, lang, phrase, n): the words of the phrases that a text owns, as the filter tells; and n words in all per language.

    Only texts of the owning share spell a phrase, a task once, so few rows come for a phrase however frequent it is.
    """
    sent = rows.sparkSession.sparkContext.broadcast(b"".join(bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, total = _Bits(sent.value), set(), {}
        for batch in slices(batches, "text", SLICE):
            part = _Slice(batch)
            found = []
            for size, keys in enumerate(part.phrases(), 1):
                at = np.flatnonzero(part.inside(size))
                at = at[known.has(mix(keys[at], part.owner[part.row[at]].view(np.uint64)))]
                own, first = np.unique(keys[at], return_index=True)
                for key, i in zip(own.view(np.int64).tolist(), at[first].tolist(), strict=True):
                    if key not in seen:
                        seen.add(key)
                        found.append((key, part.langs[part.row[i]], part.spell(i, size)))
            if len(seen) >= HELD:
                seen.clear()
            if found:
                key, lang, phrase = zip(*found, strict=True)
                columns = [pa.array(key, pa.int64()), pa.array(lang, pa.string()), pa.array(phrase, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(key), pa.int64())], ["key", "lang", "phrase", "n"])
            for lang, n in zip(part.langs, part.sizes.tolist(), strict=True):
                total[lang] = total.get(lang, 0) + n
        if total:
            none = [pa.nulls(len(total), t) for t in (pa.int64(), pa.string())]
            langs, n = pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([none[0], langs, none[1], n], ["key", "lang", "phrase", "n"])

    return rows.mapInArrow(scan, "key long, lang string, phrase string, n long").groupBy("key", "lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, rate: int = RATE, lowered: int = LOWERED) -> DataFrame:
    """(lang, phrase, a) of all phrases of 1 to LONGEST words found ``support`` times in a language, written out.

    A row with a null phrase has the number of words of its language. Texts are lower-cased (A-Z) and cut into pieces at
    ``.,;:!?`` and line ends, pieces into words at spaces and tabs; a phrase lies inside a piece, and overlapping places
    count. A null text has no words, a null language is ``und``.
    """
    rows = _read(docs)
    counted, _ = _closed(rows, support, rate, lowered)
    bits = _filter(counted.select("key", "owner")) or [bytes(BLOCK)]
    counts = counted.select("key", F.col("n").alias("a"))
    spelled = lookup(_spelled(rows, bits), counts, "key").select("lang", "phrase", F.coalesce("a", "n").alias("a"))
    return cut_lineage(spelled.where("a is not null"))


def collocations(
    docs: DataFrame, top: int = 2000, support: int = SUPPORT, cover: int = COVER, rate: int = RATE, lowered: int = LOWERED
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` most cohesive phrases of 2 words or more of each language.

    Of the cuts of a phrase into a first part (l) and a rest (r) the one with the smallest floor(2,000,000 a / (l + r)) counts, the
    earliest of equal ones. A phrase is left out if a longer one around it has ``cover`` percent of its count or more.
    Ranked by score, then count, both descending, then phrase in byte order.
    """
    known = frequent_phrases(docs, support, rate, lowered)
    found = known.where("phrase is not null").withColumn("w", F.split("phrase", " "))
    long = found.where(F.size("w") > 1)
    joined = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cut, size = F.col("k"), F.size("w")
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), cut).alias("head"), joined(cut + 1, size - cut).alias("tail")
    )
    part = lambda name, n: found.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    sides = lookup(lookup(cuts, part("head", "l"), ["lang", "head"], "inner"), part("tail", "r"), ["lang", "tail"], "inner")
    # 38 digits hold any product of a 64-bit count
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.floor(F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    best = sides.select("lang", "phrase", "a", F.struct(score.cast("long").alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min("cut").alias("cut")
    )
    lengths = F.sequence(F.lit(2), size - 1)
    inner = F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    around = long.where(F.size("w") > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = lookup(best, most, ["lang", "phrase"]).where(
        F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * wide("longer") < F.lit(cover).cast("decimal(3,0)") * wide("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = known.where("phrase is null").select("lang", F.col("a").alias("n"))
    return lookup(ranked, totals, "lang", measure=True).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
