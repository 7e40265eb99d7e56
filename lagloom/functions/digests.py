"""MD5 of many texts side by side, for draws that need several digests of a row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_TURNS = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).reshape(-1).astype(np.uint32)
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint64).astype(np.uint32)
_PLACES = [[i, (5 * i + 1) % 16, (3 * i + 5) % 16, (7 * i) % 16][i // 16] % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ROWS = 8192  # texts worked on at a time, so that their words stay in the cache


def _rounds(state: list[np.ndarray], words: np.ndarray) -> list[np.ndarray]:
    a, b, c, d = state
    for i in range(64):
        if i < 16:
            f = d ^ (b & (c ^ d))
        elif i < 32:
            f = c ^ (d & (b ^ c))
        elif i < 48:
            f = b ^ c ^ d
        else:
            f = c ^ (b | ~d)
        f += a
        f += _SINES[i]
        f += words[_PLACES[i]]
        turn = _TURNS[i]
        high = f >> (np.uint32(32) - turn)
        f <<= turn
        f |= high
        f += b
        a, b, c, d = d, f, b, c
    return [x + y for x, y in zip(state, (a, b, c, d), strict=True)]


def leading(texts: pa.Array, suffixes: list[str]) -> np.ndarray:
    """First 32 bits of the MD5 of every text with every suffix, as (suffix, text). A null text is empty."""
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    lengths = np.diff(np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset))
    starts = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts), offset=8 * texts.offset)
    held = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    if texts.null_count:
        lengths = np.where(texts.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    out = np.empty((len(suffixes), len(texts)), dtype=np.uint32)
    alike: dict[int, list[int]] = {}  # suffixes of one length are worked on together
    for k, suffix in enumerate(suffixes):
        alike.setdefault(len(suffix.encode()), []).append(k)
    for length in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == length)
        for more, own in alike.items():
            full, step = length + more, max(1, _ROWS // len(own))
            size = (full + 8) // 64 * 64 + 64
            pad = b"\x80" + bytes(size - full - 9) + (8 * full).to_bytes(8, "little")
            tails = np.frombuffer(b"".join(suffixes[k].encode() + pad for k in own), dtype=np.uint8).reshape(len(own), 1, -1)
            for first in range(0, len(same), step):
                at = same[first : first + step]
                text = np.empty((len(own), len(at), size), dtype=np.uint8)
                text[:, :, :length] = held[starts[at][:, None] + np.arange(length)]
                text[:, :, length:] = tails
                words = np.ascontiguousarray(text.reshape(-1, size).view("<u4").T)
                state = [np.full(words.shape[1], x, dtype=np.uint32) for x in _START]
                for block in range(0, len(words), 16):
                    state = _rounds(state, words[block : block + 16])
                out[np.ix_(own, at)] = state[0].byteswap().reshape(len(own), len(at))
    return out
