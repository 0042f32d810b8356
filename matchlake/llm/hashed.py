"""Hashed character n-grams of texts and linear scores over them, in numpy."""

from __future__ import annotations

import functools
import random
import zlib

import numpy as np
import pyarrow as pa

BUCKET_BITS = 16
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93)]


@functools.lru_cache(maxsize=2)
def code_table(letters_only: bool) -> np.ndarray:
    """Per code point its class: with ``letters_only`` the lower-cased letter, else 0 (word
    border); otherwise the character itself, white space as one, digits as one."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = ord(ch.lower()[0]) if letters_only else c
        elif not letters_only:
            table[c] = 32 if ch.isspace() else 48 if ch.isdigit() else c
    return table


def codes(text: str, letters_only: bool) -> np.ndarray:
    return code_table(letters_only)[np.frombuffer(text.encode("utf-32-le", "surrogatepass"),
                                                  np.uint32)]


def gram_hashes(edged: np.ndarray, n: int) -> np.ndarray:
    """Buckets of all n-grams of a sequence of classes."""
    count = max(0, len(edged) - n + 1)
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h = (h ^ edged[k:k + count]) * _MIX[k]
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def edged(text: str, letters_only: bool) -> np.ndarray:
    """Classes of a text with a border before and after."""
    return np.concatenate([[0], codes(text, letters_only), [0]]).astype(np.uint64)


def mean_rows(table: np.ndarray, text: str, letters_only: bool, orders: tuple[int, ...],
              block: int = 200_000) -> np.ndarray:
    """Mean of the table's rows over all n-grams of a whole text, in blocks of bounded memory."""
    classes = edged(text, letters_only)
    total, count = np.zeros(table.shape[1]), 0
    for n in orders:
        for at in range(0, len(classes) - n + 1, block):
            h = gram_hashes(classes[at:at + block + n - 1], n)
            total += table[h].sum(axis=0, dtype=np.float64)
            count += len(h)
    return total / max(1, count)


def bag(text: str, letters_only: bool, orders: tuple[int, ...], block: int = 200_000
        ) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text in ascending order and their shares of all its n-grams.

    At most 2 ** BUCKET_BITS of each, however long the text is.
    """
    classes = edged(text, letters_only)
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for n in orders:
        for at in range(0, len(classes) - n + 1, block):
            h = gram_hashes(classes[at:at + block + n - 1], n)
            counts += np.bincount(h, minlength=len(counts))
    found = np.flatnonzero(counts)
    return found.astype(np.uint16), (counts[found] / max(1, counts.sum())).astype(np.float32)


def packed(bags: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, pa.Array]:
    """Bags as two binary columns."""
    return {"buckets": pa.array([b.tobytes() for b, _ in bags], pa.binary()),
            "shares": pa.array([s.tobytes() for _, s in bags], pa.binary())}


def unpacked(buckets: bytes, shares: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(buckets, np.uint16), np.frombuffer(shares, np.float32)


def window(text: str, low: int, high: int) -> str:
    """A random stretch of a training text; its place and length follow from the text."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    n = int(low * (high / low) ** rng.random())
    at = rng.randrange(max(1, len(text) - n + 1))
    return text[at:at + n]
