"""Words of many texts at once: bounds and 64-bit hashes by array operations on their bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64)


def classes_of(space: bytes, digits: bool = False, marks: bool = False) -> np.ndarray:
    """Class of each byte value: white space, and if asked for digits and ASCII marks; the rest
    are letters."""
    table = np.full(256, LETTER, np.uint8)
    if marks:
        table[:128] = OTHER
        for a, z in ((65, 90), (97, 122)):
            table[a : z + 1] = LETTER
        table[48:58] = LETTER
    if digits:
        table[48:58] = DIGIT
    table[list(space)] = SPACE
    return table


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers = (both[0], both[1])
    return _powers


@dataclass
class Words:
    """Words in order: where they start and end in ``data``, their hashes, and the first word of
    each text (with the number of words at the end)."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, k: int) -> str:
        return self.data[self.starts[k] : self.ends[k]].decode()


def words_of(values: list[bytes], classes: np.ndarray) -> Words:
    """Words of each text: runs of bytes of one class that is not white space; a digit stands alone.

    Equal words have equal hashes; different ones share a hash with a probability of about 2^-64.
    """
    data = b"\n".join(values) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    kind = classes[raw]
    turn = np.empty(len(kind), bool)
    turn[0] = True
    turn[1:] = kind[1:] != kind[:-1]
    turn |= kind == DIGIT
    there = kind != SPACE
    starts = np.flatnonzero(turn & there)
    after = np.empty_like(turn)
    after[:-1] = turn[1:]
    after[-1] = True
    ends = np.flatnonzero(after & there) + 1
    power, inverse = _power_tables(len(raw))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[raw] * power[: len(raw)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * inverse[starts] if len(starts) else np.zeros(0, np.uint64)
        hashes = mix(hashes + (ends - starts).astype(np.uint64))
    sizes = np.fromiter(map(len, values), np.int64, len(values)) + 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, bounds))
