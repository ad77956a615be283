"""A suffix array in two stages, for texts of some megabytes.

Stage one directly sorts the suffixes that are smaller than their successors. Stage two goes through
the buckets of first bytes in ascending order and induces all other suffixes: one that is greater
than its successor stands in a bucket not before the successor's, in the order of the successors. As
those of a bucket come complete from earlier buckets (or from earlier ones of the same bucket, run
by run), each bucket is one array step. Order is exact in the first `depth` bytes.
"""

from __future__ import annotations

import numpy as np


def words(text: np.ndarray, depth: int) -> np.ndarray:
    """For each place the next eight bytes as a number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)]).astype(np.uint64)
    two = (padded[:-1] << np.uint64(8)) | padded[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return (four[:-4] << np.uint64(32)) | four[4:]


def smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors. In a run of equal bytes what follows the run
    decides; the end of the text counts as smallest."""
    n = len(text)
    out = np.zeros(n, bool)
    if n > 1:
        out[:-1] = text[:-1] < text[1:]
        decided = np.append(text[:-1] != text[1:], True)
        at = np.where(decided, np.arange(n), n)
        out = out[np.minimum.accumulate(at[::-1])[::-1]]
    return out


def _sorted(places: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """`places` by their first `depth` bytes: by eight bytes, and only ties that differ by the next eight."""
    order = places[np.argsort(keys[places], kind="stable")]
    first = keys[order]
    fresh = np.append(True, first[1:] != first[:-1])
    for at in range(8, depth, 8):
        where = np.flatnonzero(~fresh | np.append(~fresh[1:], False))
        if not len(where):
            break
        # Groups that have the next eight bytes in common stay as they are.
        key, inner = keys[order[where] + at], ~fresh[where]
        differs = inner & np.append(False, key[1:] != key[:-1])
        group = np.cumsum(~inner) - 1
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[differs]] = True
        chosen = mixed[group]
        where, group, key = where[chosen], group[chosen], key[chosen]
        moved = np.lexsort((key, group))
        order[where] = order[where][moved]
        group, key = group[moved], key[moved]
        fresh[where] = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))[: len(where)]
    return order


def suffix_array(text: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes; `keys` are `words(text, depth)`."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    up = smaller(text)
    direct = _sorted(np.flatnonzero(up), keys, depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([n - 1]))
    done = []

    def before(places: np.ndarray) -> np.ndarray:
        """The predecessors that are greater than their successors."""
        previous = places[places > 0] - 1
        return previous[~up[previous]]

    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            wave = before(wave)
            wave = wave[text[wave] == byte]
        bucket.append(direct[cuts[byte] : cuts[byte + 1]])
        whole = np.concatenate(bucket)
        done.append(whole)
        next_ = before(whole)
        firsts = text[next_]
        next_, firsts = next_[firsts > byte], firsts[firsts > byte]
        if len(next_):
            order = np.argsort(firsts, kind="stable")
            next_, firsts = next_[order], firsts[order]
            starts = np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1]))
            for part, first in zip(np.split(next_, starts[1:]), firsts[starts], strict=True):
                induced[first].append(part)
    return np.concatenate(done)


def same_prefix(sorted_: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Whether each place but the first in `sorted_` has its first `length` (8 or more) bytes in
    common with the one before."""
    a, b = sorted_[1:], sorted_[:-1]
    same = np.ones(len(a), bool)
    for at in [*range(0, length - 7, 8), length - 8]:
        same &= keys[a + at] == keys[b + at]
    return same
