"""Word, shingle and MinHash hashes of whole texts, vectorised over an Arrow batch."""

from __future__ import annotations

import numpy as np

#: White space that separates words: space and \t to \r.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240229)
#: A random value for each byte of the lower-cased text.
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the step and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, step in (("up", _STEP), ("down", _STEP_BACK)):
            _powers[name] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, step, np.uint64))), dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of every word, its end, index of each text's first word and the end). Words end with their text."""
    n = len(data)
    word = ~SPACE[data]
    begins, stops = word.copy(), word.copy()
    if n:
        begins[1:] &= ~word[:-1]
        stops[:-1] &= ~word[1:]
        first = offsets[:-1][offsets[:-1] < n]
        begins[first] = word[first]
        last = offsets[1:][offsets[1:] > 0] - 1
        stops[last] = word[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


#: Bytes that are hashed together; a longer text is hashed word group by word group.
BLOCK = 1 << 18


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word and the end)."""
    starts, ends, first = word_bounds(data, offsets)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = starts[i:j] - starts[i], ends[i:j] - starts[i]
        part = data[starts[i] : ends[j - 1]]
        up, down = _power(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * up[: len(part)], out=sums[1:])
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out, first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of `width` words; a shorter text is one run, one without words has none."""
    words, first = word_hashes(data, offsets)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    total = len(words) - width + 1
    runs = np.zeros(max(total, 0), np.uint64)
    for k in range(width if total > 0 else 0):
        runs += words[k : k + total] * factors[k]
    runs = mix(runs)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            out.append(mix(np.array([(words[a:b] * factors[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], coordinates: int, seed: int = 7) -> np.ndarray:
    """One row of minima for each (non-empty) set; the value says its coordinate too."""
    draw = np.random.default_rng(seed)
    a = draw.integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 2**63, coordinates, dtype=np.uint64)
    flat, at = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), coordinates), np.uint64)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(mix_light(flat * a[k] + b[k]), at)
    return mix(out ^ mix(np.arange(coordinates, dtype=np.uint64) + np.uint64(1)))


def mix_light(x: np.ndarray) -> np.ndarray:
    """Enough mixing for an order: high bits of a product depend on all lower ones."""
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
