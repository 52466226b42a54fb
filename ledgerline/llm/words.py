"""Words, and hashes of word runs, of many texts at once.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Hashes come from sums of mixed bytes times powers of a number, modulo the prime
2**61 - 1; a run's hash is a difference of two prefix sums, moved to a common power. (Modulo a power
of two, texts made by doubling, such as Thue-Morse words and their complements, would collide.)
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
PRIME = (1 << 61) - 1
_POINT = 0x1B873593CC9E2D51 % PRIME  # where the polynomials are evaluated
_INVERSE = pow(_POINT, -1, PRIME)
_LOW, _MIDDLE = U((1 << 31) - 1), U((1 << 30) - 1)
BLOCK = 1 << 15  # values handled at a time, so that intermediate arrays stay small
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all others (a bijection)."""
    x = np.asarray(x, "uint64").copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2**64 modulo the prime."""
    x = (x & U(PRIME)) + (x >> U(61))
    return np.minimum(x, x - U(PRIME))  # below the prime, the difference wraps to a larger number


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 31 bits, since 2**61 is one."""
    a_high, a_low, b_high, b_low = a >> U(31), a & _LOW, b >> U(31), b & _LOW
    middle = a_high * b_low + a_low * b_high
    return reduced(((a_high * b_high) << U(1)) + (middle >> U(30)) + ((middle & _MIDDLE) << U(31)) + a_low * b_low)


_LETTER = reduced(mix(np.arange(1, 257, dtype="uint64") * U(0x2545F4914F6CDD1D)))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo the prime, held for later calls."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.ones(1, "uint64") if held is None else held
        while len(held) < max(n, 1 << 16):
            held = np.concatenate([held, times(held, U(pow(base, len(held), PRIME)))])
        _powers[base] = held
    return held[:n]


def prefix_sums(values: np.ndarray, letters: np.ndarray | None = None) -> np.ndarray:
    """Sums of value times power before each place, modulo the prime; one longer than ``values``.

    With ``letters``, values are places in that table.
    """
    sums, power = np.zeros(len(values) + 1, "uint64"), powers(_POINT, len(values))
    for i in range(0, len(values), BLOCK):
        part = values[i : i + BLOCK] if letters is None else letters[values[i : i + BLOCK]]
        terms = times(reduced(np.asarray(part, "uint64")), power[i : i + BLOCK])
        low, high = np.cumsum(terms & _LOW, dtype="uint64"), np.cumsum(terms >> U(31), dtype="uint64")
        own = reduced(low + (high >> U(30)) + ((high & _MIDDLE) << U(31)))
        sums[i + 1 : i + 1 + len(part)] = reduced(own + sums[i])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each run [start, end), the same for equal runs wherever they stand."""
    out, power = np.empty(len(starts), "uint64"), powers(_INVERSE, len(sums))
    for i in range(0, len(starts), BLOCK):
        a, b = starts[i : i + BLOCK], ends[i : i + BLOCK]
        out[i : i + BLOCK] = mix(times(reduced(sums[b] + (U(PRIME) - sums[a])), power[a]))
    return out


def byte_values(data: np.ndarray) -> np.ndarray:
    return _LETTER[data]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text (one more at the end).

    ``bounds`` are the byte offsets of the texts in ``data``; a word never runs into the next text.
    """
    inside = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, "uint64")
    return run_hashes(prefix_sums(data, _LETTER), starts, ends)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for every n consecutive word hashes; the caller leaves out those that cross texts."""
    out = np.zeros(max(len(words) - n + 1, 0), "uint64")
    for i in range(n):
        out = (out ^ words[i : i + len(out)]) * U(BASE)
        out ^= out >> U(29)
    return mix(out)
