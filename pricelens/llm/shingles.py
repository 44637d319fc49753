"""Word shingles of a batch of texts as 64-bit hashes, with numpy."""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (splitmix64 finish)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _spread(raw: np.ndarray, cuts: np.ndarray):
    """(word starts, is a cut, byte * factor ** place in its word); no words: None."""
    space = cuts[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return None
    first = starts if starts[0] == 0 else np.append(0, starts)
    place = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return starts, space, np.where(space, np.uint64(0), mix(LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers[place])


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def word_hashes(text: str | None, cuts: np.ndarray = SPACES) -> np.ndarray:
    """Hash of every word (bytes that are not in ``cuts``, A-Z lowered): the sum
    of byte * odd factor ** place, scrambled with the word's length."""
    raw = _bytes(text)
    with np.errstate(over="ignore"):
        got = _spread(raw, cuts) if len(raw) else None
        if got is None:
            return np.zeros(0, np.uint64)
        starts, space, scaled = got
        return mix(np.add.reduceat(scaled, starts) + np.add.reduceat((~space).astype(np.uint64), starts))


def word_and_prefix_hashes(text: str | None, lengths: tuple[int, ...], levels: int) -> np.ndarray:
    """Sorted distinct hashes of the words (cut at white space and ASCII signs)
    and of (prefix of so many bytes, at least k distinct words with it), k up
    to ``levels``."""
    raw = _bytes(text)
    with np.errstate(over="ignore"):
        got = _spread(raw, SIGNS) if len(raw) else None
        if got is None:
            return np.zeros(0, np.uint64)
        starts, space, scaled = got
        sizes = np.add.reduceat((~space).astype(np.uint64), starts)
        words, at = np.unique(mix(np.add.reduceat(scaled, starts) + sizes), return_index=True)
        starts, sizes = starts[at], sizes[at].astype(np.int64)
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(scaled, dtype=np.uint64)))
        out = [words]
        for n in lengths:
            own = starts[sizes >= n]
            prefix, count = np.unique(mix(upto[own + n] - upto[own] + np.uint64(n << 20)), return_counts=True)
            out += [mix(prefix[count >= k] + np.uint64(k)) for k in range(1, levels + 1)]
        return np.unique(np.concatenate(out))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles; a shorter text has
    its whole sequence as its one shingle, a text without words none."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h[k:len(h) - size + 1 + k])
    return np.unique(out)
