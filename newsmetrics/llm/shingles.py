"""Vectorised 64-bit hashes of words and word windows.

A word's hash is a polynomial over its bytes modulo 2**64, with a random value
per byte value, then mixed; a window's hash combines its words' hashes. Texts
are worked through in blocks of about a megabyte cut at white space, so memory
follows the block and the result, not a power of the text.
"""

from __future__ import annotations

import re

import numpy as np

from newsmetrics.llm.common import ASCII_LOWER, mix

BLOCK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")
_TABLES: dict[str, np.ndarray] = {}


def tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "byte" not in _TABLES:
        rng = np.random.Generator(np.random.PCG64(20240901))
        byte = rng.integers(1, 2 ** 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        byte[[9, 10, 11, 12, 13, 32]] = 0
        _TABLES["byte"] = byte
    if len(_TABLES.get("power", ())) < size:
        base = 0x9E3779B97F4A7C15
        for name, b in (("power", base), ("inverse", pow(base, -1, 2 ** 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.multiply.accumulate(steps)
    return _TABLES["byte"], _TABLES["power"], _TABLES["inverse"]


def _block_hashes(raw: bytes) -> np.ndarray:
    byte, power, inverse = tables(max(len(raw), 1 << 12))
    value = byte[np.frombuffer(raw, np.uint8)]
    inside = value != 0
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mix(np.add.reduceat(value * power[:len(raw)], starts) * inverse[starts])


def hashes(raw: bytes) -> np.ndarray:
    """One uint64 per run of bytes other than blank, tab, LF, VT, FF and CR."""
    if len(raw) <= BLOCK:
        return _block_hashes(raw)
    parts, at = [], 0
    while at < len(raw):
        cut = SPACE.search(raw, at + BLOCK)
        end = cut.start() if cut else len(raw)
        parts.append(_block_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def word_hashes(text: str) -> np.ndarray:
    """One uint64 per word of the text with A-Z lower-cased."""
    return hashes(text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; of a shorter sequence its only one."""
    if not len(words):
        return words
    n, width = len(words), min(size, len(words))
    total = np.full(n - width + 1, width, np.uint64)
    factor = 1
    for i in range(width):
        factor = factor * 0xD6E8FEB86659FD93 % 2 ** 64
        total += words[i:n - width + 1 + i] * np.uint64(factor)
    return mix(total)
