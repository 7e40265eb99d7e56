"""Personal data, and the terms of a corpus that give it away.

Patterns find e-mail addresses, IP addresses, card and phone numbers; each value is a protected entity. A term is a word
within WINDOW words of one. Counted over distinct contexts of the whole corpus (copies of a text count once), with
n_et contexts that hold term and entity, n_t that hold the term, n_e that hold the entity and N words in all, the term
discloses the share

    pmi(t, e) / -log2 p(e)  =  (log2(n_et / n_t) - log2(n_e / N)) / log2(N / n_e)

of the entity's information. A term above the threshold is sanitised wherever it stands: generalised to its kind if it
reveals several entities, removed if it reveals one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagloom.llm.common import fresh, slices, texts
from lagloom.operators.lookup import lookup
from lagloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
WINDOW, SUPPORT, SHARE, LEAST = 8, 3, 0.9, 3  # words on each side, contexts, threshold, letters of a term
HELD = 1 << 18  # places a task holds back
FILTER_BITS = 23  # size of the filter that carries candidate terms to the corpus: 1 MB, whatever their number
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPAN_TYPE = "array<struct<kind:string,start:long,end:long>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits, so runs are tried at their first digit only
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds in code points, by start, then in the order of KINDS."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append((start, done, "email"))
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "replace")) - (1 << 63)


def _words(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[str, int, int]]:
    """Lower-case words outside the spans."""
    out, at, upto = [], 0, 0
    ordered = sorted((a, b) for a, b, _ in spans)
    for m in WORD.finditer(text):
        while at < len(ordered) and ordered[at][0] < m.end():
            upto = max(upto, ordered[at][1])
            at += 1
        if m.start() >= upto:
            out.append((m.group().lower(), m.start(), m.end()))
    return out


def _context(words: list[tuple[str, int, int]], low: int, high: int) -> int:
    return _hash(" ".join(w for w, _, _ in words[max(0, low) : high]))


def _text_key(text: str) -> Column:
    """Key of a text that copies share, found without Python: a stage then needs one Python worker a task."""
    return F.xxhash64(text)


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("text_key", _text_key("text"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of every text, and (entity, term, context) around them."""
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("context", pa.int64())]))
    for batch in slices(batches, "text", 2 << 20):
        found, around, sizes = [], [], []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            rows = []
            if spans:
                words = _words(text, spans)
                starts = np.array([w[1] for w in words], dtype=np.int64)
                for a, b, kind in spans:
                    entity = _hash(f"{kind}:{text[a:b].lower()}")
                    at, after = np.searchsorted(starts, [a, b]).tolist()
                    context = _context(words, at - WINDOW, after + WINDOW)
                    terms = {w for w, _, _ in words[max(0, at - WINDOW) : after + WINDOW] if len(w) >= LEAST}
                    rows += [{"entity": entity, "term": _hash(w), "context": context} for w in sorted(terms)]
            found.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            around.append(rows)
            sizes.append(text.count(" ") + 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(found, SPANS), pa.array(around, near), pa.array(sizes, pa.int64())],
            ["doc_id", "text_key", "spans", "near", "words"],
        )


def _filter(terms: DataFrame) -> bytes:
    """Bits set at the terms' hashes: one megabyte for any number of terms."""
    slot = F.pmod(F.col("term"), F.lit(1 << FILTER_BITS))
    words = terms.select((slot / 64).cast("int").alias("at"), F.expr("shiftleft(1L, cast(pmod(term, 64L) as int))").alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    for r in rows:
        out[r.at] = r.bits
    return out.tobytes() if rows else b""


def disclosing_terms(
    docs: DataFrame, scanned: DataFrame, support: int = SUPPORT, share: float = SHARE, window: int = WINDOW
) -> tuple[DataFrame, DataFrame] | None:
    """Terms that disclose more than ``share`` of an entity seen with them in ``support`` contexts, and their places.

    Returns (term, entities) and (doc_id, text_key, term, start, end), or None if no term has the support.
    """
    near = scanned.select(F.inline("near"))
    joint = cut_lineage(near.distinct().groupBy("entity", "term").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support))
    carried = _filter(joint.select("term").distinct())
    if not carried:
        return None

    # a term above this many contexts discloses too little of any entity: n_t <= n_et * (N / n_e) ** (1 - share)
    total = float(scanned.agg(F.sum("words")).first()[0] or 1)
    most = int(joint.agg(F.max("n_et")).first()[0] * total ** (1 - share))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of the candidate terms; of one that passes ``most`` contexts in this task, a row that says so."""
        bits = np.frombuffer(carried, dtype=np.int64)
        held: dict[int, tuple[set, list]] = {}
        passed: set[int] = set()
        names = ["doc_id", "text_key", "term", "context", "start", "end"]

        def flush() -> Iterator[pa.RecordBatch]:
            todo: list[tuple] = []
            for term in list(held):
                todo += held.pop(term)[1]
                if len(todo) > 10_000 or not held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*todo, strict=True)], names)
                    todo = []

        known: dict[str, int | None] = {}
        for batch in slices(batches, "text", 2 << 20):
            for doc_id, text, key in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "text_key")), strict=True):
                words = _words(text, base_spans(text))
                if len(known) > 1 << 17:
                    known.clear()
                for i, (word, a, b) in enumerate(words):
                    if len(word) < LEAST:
                        continue
                    if word not in known:
                        term = _hash(word)
                        slot = term % (1 << FILTER_BITS)
                        known[word] = term if int(bits[slot >> 6]) >> (slot & 63) & 1 and term not in passed else None
                    term = known[word]
                    if term is None:
                        continue
                    contexts, rows = held.setdefault(term, (set(), []))
                    context = _context(words, i - window, i + window + 1)
                    contexts.add(context)
                    rows.append((doc_id, key, term, context, a, b))
                    if len(contexts) > most:
                        passed.add(term)
                        known[word] = None
                        del held[term]
            if sum(len(rows) for _, rows in held.values()) > HELD:
                yield from flush()  # counting goes on over all tasks; a task only saves rows that cannot matter
        held.update((term, (set(), [(None, None, term, None, None, None)])) for term in passed)
        yield from flush()

    places = cut_lineage(_keyed(docs).mapInArrow(occurrences, "doc_id long, text_key long, term long, context long, start long, end long"))
    # contexts are counted, not places, so copies of a text count once
    counted = places.select("term", "context").distinct().groupBy("term")
    n_t = counted.agg(F.count("context").alias("n_t"), F.max(F.col("context").isNull()).alias("passed")).where("not passed").drop("passed")
    n_e = near.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    known = lookup(lookup(joint, n_t, "term", "inner"), n_e, "entity", "inner")
    bits = F.log2(F.lit(total) / F.col("n_e"))
    disclosed = (bits + F.log2(F.least(F.lit(1.0), F.col("n_et") / F.col("n_t")))) / bits
    terms = known.where((bits > 0) & (disclosed > share)).groupBy("term").agg(F.count("*").alias("entities"))
    return terms, places


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, term_spans) per row of ``docs``; text_key is a hash of the text.

    Spans are in code points, end exclusive. Repeated rows have the same spans each. A null or empty text has none.
    """
    scanned = cut_lineage(_keyed(docs).mapInArrow(
        _scan, f"doc_id long, text_key long, spans {SPAN_TYPE}, near array<struct<entity:long,term:long,context:long>>, words long"
    ))
    found = disclosing_terms(docs, scanned)
    rows = scanned.select("doc_id", "text_key", "spans")
    if found is None:
        return rows.withColumn("term_spans", F.array().cast(SPAN_TYPE))
    terms, places = found
    kind = F.when(F.col("entities") > 1, "term").otherwise("key")
    own = lookup(places.where("context is not null"), terms, "term", "inner", measure=True).select(
        "doc_id", "text_key", F.struct(kind.alias("kind"), "start", "end").alias("span")
    )
    grouped = own.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("span")).alias("term_spans"))
    # a missing id is a key of its own, not that of any number
    keys = lambda df: df.withColumn("doc_key", F.coalesce("doc_id", F.lit(-1))).withColumn("no_id", F.col("doc_id").isNull())
    keyed = cut_lineage(keys(grouped).drop("doc_id"))
    return (
        keys(rows).join(keyed, ["doc_key", "no_id", "text_key"], "left")
        .select("doc_id", "text_key", "spans", F.coalesce("term_spans", F.array().cast(SPAN_TYPE)).alias("term_spans"))
    )


def private_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``.

    A null or empty text has no spans and the digest of an empty string. Texts of any length are read whole.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, more in zip(batch.column("spans").to_pylist(), batch.column("term_spans").to_pylist(), strict=True):
                kinds = [s["kind"] for s in base]
                both = sorted(base + more, key=lambda s: (s["start"], (*KINDS, "key", "term").index(s["kind"]), s["end"]))
                joined = [",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in part) for part in (base, both)]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(joined[0].encode()).hexdigest(), joined[1]))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return find(docs).select("doc_id", "spans", "term_spans").mapInArrow(digest, schema)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced: base kinds and generalised terms by their kind in brackets, keys by nothing.

    n_chars, where there is one, follows the new text; a null text stays null and every row stays.
    """
    names = docs.columns
    key_name, spans_name = fresh("_key", names), fresh("_spans", names)
    found = find(docs).where("size(spans) > 0 or size(term_spans) > 0")
    keyed = found.select(F.col("text_key").alias(key_name), F.array_sort(F.concat("spans", "term_spans")).alias(spans_name))
    spans = cut_lineage(keyed.groupBy(key_name).agg(F.first(spans_name).alias(spans_name)))
    target = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            out = []
            for text, own in zip(batch.column("text").to_pylist(), batch.column(spans_name).to_pylist(), strict=True):
                if text is not None and own:
                    parts, at = [], 0
                    for s in sorted(own, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= at:
                            parts += [text[at : s["start"]], "" if s["kind"] == "key" else f"[{s['kind'].upper()}]"]
                        at = max(at, s["end"])
                    text = "".join([*parts, text[at:]])
                out.append(text)
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(out, batch.column("text").type)
            if "n_chars" in columns:
                sizes = [None if t is None else len(t) for t in out]
                columns["n_chars"] = pa.array(sizes, pa.int64()).cast(batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    keys = F.when(F.col("text").isNotNull(), _text_key("text"))
    return docs.withColumn(key_name, keys).join(spans, key_name, "left").select(*names, spans_name).mapInArrow(replace, target)
