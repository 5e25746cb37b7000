"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WIDTH = 5
SEGMENT = 1 << 19
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def _word_bytes() -> np.ndarray:
    """ASCII letters and digits, and every byte of a non-ASCII character."""
    word = np.zeros(256, dtype=bool)
    word[128:] = word[48:58] = word[97:123] = True
    return word


WORD = _word_bytes()


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (two multiply and shift steps)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


_UP, _DOWN = powers(_ODD, SEGMENT + 1), powers(_INVERSE, SEGMENT + 1)


def _segment(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """End place and hash of each word of lower-case UTF-8 bytes."""
    n = len(data)
    up, down = (_UP[:n], _DOWN) if n <= SEGMENT else (powers(_ODD, n), powers(_INVERSE, n + 1))
    word = WORD[data]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return ends, hashes


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words begin (one more at the end).

    A word is a run of letters and digits in lower case. Bytes go in segments cut between words,
    so memory stays near that of the texts.
    """
    coded = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    places = np.cumsum([0] + [len(c) + 1 for c in coded])
    data = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
    ends, hashes, at = [], [], 0
    while at < len(data):
        to = min(at + SEGMENT, len(data))
        while to < len(data) and WORD[data[to - 1]]:
            back = np.flatnonzero(~WORD[data[at:to]])
            to = at + int(back[-1]) + 1 if len(back) else min(to + SEGMENT, len(data))
        e, h = _segment(data[at:to])
        ends.append(e + at)
        hashes.append(h)
        at = to
    end = np.concatenate(ends) if ends else np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), np.searchsorted(end, places, side="right")


def shingled(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hash of each run of `width` words; `hashes` has at least that many."""
    n = len(hashes) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(_ODD) + hashes[i : i + n]
    return mixed(out)


def sequences(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The shingles of each text in order. A text of fewer words has one shingle of all of them."""
    hashes, at = words(texts)
    every = shingled(hashes, width) if len(hashes) >= width else np.zeros(0, dtype=np.uint64)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            yield every[a : b - width + 1]
        elif b > a:
            yield shingled(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    return map(np.unique, sequences(texts, width))
