"""Words as 64-bit hashes, computed by whole-array steps over many texts at once.

A word is a run of bytes other than space and \\x09-\\x0D, which is `[^\\x20\\x09-\\x0D]+` on
the characters, as UTF-8 never uses those bytes inside a character.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 4 * 2**20
"""Texts are hashed in groups of about this size, so memory follows the longest text only."""
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SHORT = 48
_PRIME = np.uint64(0x100000001B3)
_BASIS = np.uint64(0xCBF29CE484222325)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread each value over all 64 bits (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * _GOLD
    return h ^ (h >> np.uint64(32))


def pieces(batch: pa.RecordBatch, packed: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch (null: empty) in groups: index of the first row, and the bytes.

    `packed`: they come as `packed_texts` has made them.
    """
    start, group, size = 0, [], 0
    for i, text in enumerate(batch.column("text").cast(pa.binary())):
        text = text.as_py() or b""
        if packed and text:
            text = zlib.decompress(text)
        if group and size + len(text) > PIECE_BYTES:
            yield start, group
            start, group, size = i, [], 0
        group.append(text)
        size += len(text)
    if group:
        yield start, group


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows with `text` compressed, for texts that have to be shuffled whole."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        made = [zlib.compress(text.as_py() or b"", 4) for text in batch.column(at).cast(pa.binary())]
        columns = batch.columns
        columns[at] = pa.array(made, pa.binary())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words start (one more entry at the end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gap = _SPACE[data]
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(before & ~gap), np.flatnonzero(~before & gap)
    if len(ends) < len(starts):  # cannot be: the last byte is a space
        raise AssertionError("a word without an end")
    length = ends - starts
    capped = np.minimum(length, _SHORT + 1).astype(np.int16)
    order = np.argsort(-capped, kind="stable")
    longer = len(capped) - np.cumsum(np.bincount(capped, minlength=_SHORT + 2))
    at = starts[order]
    h = np.full(len(at), _BASIS, np.uint64)
    for k in range(_SHORT):
        n = longer[k]
        if not n:
            break
        h[:n] = (h[:n] ^ data[at[:n] + k]) * _PRIME
    for i in range(longer[_SHORT]):
        word = data[at[i] : ends[order[i]]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    hashes = np.empty_like(h)
    hashes[order] = mix(h)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return hashes, np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; empty if there are fewer than n."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = h * _ODD + words[k : k + m]
    return mix(h)


def inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """For each gram position of the joined words: does it lie within one text?"""
    total = int(offsets[-1])
    good = np.ones(max(0, total - n + 1), bool)
    for cut in range(1, n):  # a gram that starts fewer than n words before a text's end crosses it
        at = offsets[1:-1] - cut
        good[at[(at >= 0) & (at < len(good))]] = False
    return good
