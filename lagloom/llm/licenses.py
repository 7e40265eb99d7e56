"""License texts and notices found by templates with optional and replaceable regions.

A template is wording with two kinds of mark-up: ``[ ... ]`` may be left out, ``{a-b}`` stands for a to b words of any
kind. It compiles to a position automaton over words whose states are bits of one integer: the successors of every
position are a mask, and a word keeps the positions that spell it (or any word). A stretch of a text is accepted when
its mandatory words match exactly, in order, and nothing stands between them that the template does not allow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from lagloom.llm.common import raw, slices, texts

#: A-Z lower, every ASCII sign that is no letter or digit a space; bytes of other characters stay.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
BASE = {(b"mit", b"license"): "mit", (b"apache", b"license"): "apache", (b"general", b"public", b"license"): "gpl"}

#: Label, a mandatory word that gates the search, template.
TEMPLATES = (
    ("mit", "mit", "under the [terms of the] mit license"),
    ("mit-text", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"
     " and associated documentation files the software to deal in the software without restriction [including without"
     " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software]"),
    ("isc-text", "permission", "permission to use copy modify and [or] distribute this software for any purpose with or without"
     " fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-text", "redistribution", "redistribution and use in source and binary forms with or without modification are"
     " permitted provided that the following conditions are met"),
    ("bsd-3-clause", "endorse", "[neither the] name of {1-12} [nor the names of its contributors] may [not] be used to endorse or"
     " promote products derived from this software without specific prior written permission"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0"),
    ("gpl-2.0", "gnu", "[{1-3} is] licensed under the gnu general public license version 2"),
    ("gpl-3.0", "gnu", "licensed under the gnu general public license version 3"),
    ("gpl-text", "redistribute", "is free software you can redistribute it and or modify it under the terms of the gnu"
     " {0-2} general public license as published by the free software foundation"),
    ("lgpl", "lesser", "gnu lesser general public license [version {1-2}]"),
    ("mpl-2.0", "mozilla", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "cc", "licensed under cc by {1-1} 0"),
    ("cc-by-nc", "cc", "licensed under cc by nc {1-1} 0"),
    ("cc-by-sa", "cc", "licensed under cc by sa {1-1} 0"),
    ("spdx", "spdx", "spdx license identifier {1-3}"),
)


@dataclass
class Automaton:
    """Bit i of a state is position i of the template: the word there has just been read."""

    label: str
    gate: bytes
    first: int
    last: int
    follow: list[int]
    reads: dict[bytes, int]
    any_word: int

    def ends(self, words: list[bytes], start: int) -> int | None:
        """End of the longest accepted stretch that starts at ``start``."""
        state, best, at = self.first, None, start
        while at < len(words):
            state &= self.reads.get(words[at], 0) | self.any_word
            if not state:
                break
            at += 1
            if state & self.last:
                best = at
            reached = 0
            while state:
                low = state & -state
                reached |= self.follow[low.bit_length() - 1]
                state ^= low
            state = reached
        return best

    def starts(self, words: list[bytes]) -> Iterator[int]:
        if self.first & self.any_word:
            yield from range(len(words))
        else:
            yield from (i for i, w in enumerate(words) if self.reads.get(w, 0) & self.first)


def compile_template(label: str, gate: str, template: str) -> Automaton:
    """Position automaton of a template: first, last and successor sets, built from left to right."""
    symbols: list[bytes | None] = []

    def sequence(tokens: list[str]) -> tuple[int, int, bool, list[tuple[int, int]]]:
        """first, last, may be empty, (last, first) pairs that follow one another; eats up to a closing bracket."""
        first = last = 0
        empty, links = True, []
        while tokens and tokens[0] != "]":
            token = tokens.pop(0)
            if token == "[":
                f, e, _, more = sequence(tokens)
                tokens.pop(0)
                parts = [(f, e, True, more)]
            elif gap := re.fullmatch(r"\{(\d+)-(\d+)\}", token):
                low, high = map(int, gap.groups())
                parts = []
                for n in range(high):
                    symbols.append(None)
                    bit = 1 << (len(symbols) - 1)
                    parts.append((bit, bit, n >= low, []))
            else:
                symbols.append(token.encode())
                bit = 1 << (len(symbols) - 1)
                parts = [(bit, bit, False, [])]
            for f, e, skip, more in parts:
                links += [*more, (last, f)]
                first |= f if empty else 0
                last = last | e if skip else e
                empty = empty and skip
        return first, last, empty, links

    first, last, _, links = sequence(re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", template))
    follow = [0] * len(symbols)
    for ends, begins in links:
        for i in range(len(symbols)):
            if ends >> i & 1:
                follow[i] |= begins
    reads: dict[bytes, int] = {}
    any_word = 0
    for i, symbol in enumerate(symbols):
        if symbol is None:
            any_word |= 1 << i
        else:
            reads[symbol] = reads.get(symbol, 0) | 1 << i
    return Automaton(label, gate.encode(), first, last, follow, reads, any_word)


def scan(text: bytes, automata: list[Automaton]) -> tuple:
    """One text: n_words, base starts, base labels, (label, start, end) of accepted stretches, share of words in any."""
    bare = text.translate(WORDS)
    words = bare.split()
    starts, named, spans, covered = [], set(), [], []
    if b"license" in bare:
        for i, word in enumerate(words):
            if word == b"license":
                for phrase, label in BASE.items():
                    at = i - len(phrase) + 1
                    if at >= 0 and tuple(words[at : i + 1]) == phrase:
                        starts.append(at)
                        named.add(label)
                        covered.append((at, i + 1))
    present: set[bytes] | None = None
    for machine in automata:
        if machine.gate in bare:
            present = present if present is not None else set(words)
            if machine.gate in present:
                upto = 0
                for start in machine.starts(words):
                    if start >= upto and (end := machine.ends(words, start)):
                        spans.append((machine.label, start, end))
                        upto = end
    covered += [(a, b) for _, a, b in spans]
    inside, upto = 0, 0
    for a, b in sorted(covered):
        inside += max(0, b - max(a, upto))
        upto = max(upto, b)
    return len(words), starts, named, spans, inside / len(words) if words else 0.0


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row of ``docs``.

    ``spans`` lists the accepted stretches as (label, start, end) in words. ``score`` is the share of the words inside
    a base phrase or an accepted stretch. A null or empty text has no words, no labels and score 0; first_word and
    last_word are null without a base phrase. Texts are read whole, whatever their length; repeated rows are judged alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [compile_template(*t) for t in TEMPLATES]
        for batch in slices(batches, "text", 2 << 20):
            out = []
            for text in raw(batch.column("text")):
                n, starts, named, spans, share = scan(text, automata)
                both = ",".join(sorted(named | {s[0] for s in spans}))
                out.append((n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(named)), both, share,
                            [{"label": a, "start": b, "end": c} for a, b, c in spans]))
            columns = list(zip(*out, strict=True)) or [()] * 8
            long, span = pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            kinds = [long, long, long, long, pa.string(), pa.string(), pa.float64(), span]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, spans array<struct<label:string,start:long,end:long>>",
    )
