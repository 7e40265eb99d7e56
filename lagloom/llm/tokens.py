"""Token counts of a byte-level pair encoding, merged for many pre-tokens at once.

Distinct pre-tokens are held as one ragged array of symbols. In each round every sequence finds its lowest-ranked
adjacent pair and replaces all its occurrences; a pair made of the new symbol ranks higher, so this equals merging one
at a time. Sequences without a pair are done, and the symbols left are their tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lagloom.llm.common import slices, texts

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class no edition of Unicode has changed; texts with others are split by the library itself.
ODD = re.compile("[^\t\n\r -~¡-¬®-ɏЀ-џ‐-‧€]")
HELD = 1 << 17  # pre-tokens whose counts a task keeps
LIMIT = 1024


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    hidden = {c: chr(256 + i) for i, c in enumerate(c for c in range(256) if c not in set(shown))}
    return [hidden.get(c, chr(c)) for c in range(256)]


class Merger:
    """Ranks of symbol pairs as sorted arrays, and the counts of pre-tokens seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], dtype=np.int64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.bytes = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        self.special = sorted((t["content"] for t in spec.get("added_tokens", []) if not t.get("normalized")), key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.split = regex.compile(PATTERN).findall
        self.counts: dict[str, int] = {}
        self.library = None

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each byte string."""
        out = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), out)
        none = np.int64(len(self.made))
        while len(symbols) > 1:
            keys = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[at] == keys) & (owner[:-1] == owner[1:]), self.order[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            size = np.diff(np.r_[starts, len(owner)])
            hit = (rank == np.repeat(lowest, size)) & (rank < none)
            if not hit.any():
                break
            # of pairs that overlap, as in "aaa", every second one from the left
            index = np.arange(len(hit))
            fresh = hit & ~np.r_[False, hit[:-1]]
            hit &= (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
            symbols = np.where(hit, self.made[np.minimum(rank, none - 1)], symbols)
            gone = np.r_[False, hit[:-1]]
            out -= np.bincount(owner[gone], minlength=len(out))
            active = np.repeat(lowest < none, size) & ~gone
            symbols, owner = symbols[active], owner[active]
        return out

    def pretokens(self, text: str) -> list[str]:
        if not ODD.search(text):
            return self.split(text)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def count(self, batch: list[str]) -> list[int]:
        """Tokens of each text; special strings count one each and part the text."""
        if len(self.counts) > HELD:
            self.counts.clear()
        parts = []
        for text in batch:
            if self.cut and any(s in text for s in self.special):
                pieces = self.cut.split(text)
                parts.append((len(pieces) - 1, [w for p in pieces for w in self.pretokens(p)]))
            else:
                parts.append((0, self.pretokens(text)))
        new = sorted({w for _, words in parts for w in words}.difference(self.counts))
        if new:
            self.counts.update(zip(new, self.merged([w.encode() for w in new]).tolist(), strict=True))
        return [extra + sum(map(self.counts.__getitem__, words)) for extra, words in parts]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``, by the byte-level vocabulary at ``path``.

    ``path`` is read on the workers. A null or empty text has no tokens; repeated rows count alike; a text of any
    length is counted whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(path)
        for batch in slices(batches, "text", 1 << 20):
            column = batch.column("text")
            counts = np.array(merger.count(column.to_pylist()), dtype=np.int64)
            sizes = pa.compute.binary_length(column).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(counts), pa.array(counts > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
