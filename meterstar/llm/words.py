"""Words of a text and hashes of word windows, for the operators that compare texts."""

from __future__ import annotations

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)   # odd, so that it has an inverse and every word keeps all its bits
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# A random number per byte, 0 for blanks; with A-Z folded in the second table.
_BYTES = np.array([0 if b in _BLANK else xxhash.xxh3_64_intdigest(bytes([b])) for b in range(256)], np.uint64)
_FOLDED = _BYTES[list(_LOWER)]
_AT_ONCE = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse, at least ``n`` of each."""
    while len(_powers[0]) < n:
        for k, step in enumerate((_STEP, _BACK)):
            own = _powers[k]
            _powers[k] = np.concatenate([own, own * (own[-1:] * step)])
    return _powers


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and tab to carriage return."""
    return (text or "").encode().split()


def hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of a text's words; ``lower`` folds A-Z.

    All bytes of the text are weighed by powers of one step at once, added up by word, and the power at
    the word's start is taken off again, so equal words have equal hashes wherever they stand.
    """
    whole = np.frombuffer((text or "").encode(), np.uint8)
    parts, at = [], 0
    while at < len(whole):  # long texts go in parts that end with a word
        end = at + _AT_ONCE
        while end < len(whole) and _BYTES[whole[end]]:
            end += 1
        parts.append(_hashes(whole[at:end], lower))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint64), *parts])


def _hashes(data: np.ndarray, lower: bool) -> np.ndarray:
    up, down = _power_tables(len(data))
    values = (_FOLDED if lower else _BYTES)[data]
    inside = values != 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    if inside[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mixed(np.add.reduceat(values * up[:len(data)], starts) * down[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, by its first word's position; empty if there are fewer words.

    Runs are joined from runs of 1, 2, 4, ... words.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, size, step = np.zeros(len(h) + 1, np.uint64), 0, h, 1, _STEP
    while True:
        if width & size:
            length = len(h) - done - size + 1
            out = out[:length] * step + block[done:done + length]
            done += size
        if 2 * size > width:
            return mixed(out[:n] + np.uint64(width))
        block = block[:len(block) - size] * step + block[size:]
        size *= 2
        step = np.uint64(int(step) * int(step) & 0xFFFFFFFFFFFFFFFF)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one has none."""
    h = hashes(text, lower=True)
    return np.unique(windows(h, min(width, len(h)))) if len(h) else h
