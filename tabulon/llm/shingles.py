"""Hashed word shingles, vectorised over a batch of texts.

Words are runs of anything but space and TAB..CR, A-Z lower-cased. A word's hash is a
polynomial over random 64-bit values of its bytes, taken from running sums over the
whole batch; a shingle's hash is a mix of its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(0, 2 ** 64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def byte_slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most so many bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 1
    upto = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _power(sign: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base, or of its inverse modulo 2**64."""
    if len(_powers[sign]) < n:
        p = np.full(max(n, 2 * len(_powers[sign])), pow(_BASE, sign, 2 ** 64), np.uint64)
        p[0] = 1
        _powers[sign] = np.multiply.accumulate(p)
    return _powers[sign]


def mix(a: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


#: Bytes hashed at once: tables of powers are no longer.
SEGMENT = 1 << 16


def word_hashes(data: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word of a byte array; ``space`` marks the bytes
    between words."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space[data], [True])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    h = np.zeros(len(start), np.uint64)
    up, down = _power(1, SEGMENT), _power(-1, SEGMENT)
    i = 0
    while i < len(start):
        at = start[i]
        j = int(np.searchsorted(end, at + SEGMENT, "right"))
        if j <= i:  # one word longer than a segment, in parts
            for k in range(at, end[i], SEGMENT):
                part = data[k:min(k + SEGMENT, end[i])]
                turn = np.full(1, pow(_BASE, int(k - at), 2 ** 64), np.uint64)
                h[i:i + 1] += (_BYTE[part] * up[:len(part)]).sum(dtype=np.uint64, keepdims=True) * turn
            i += 1
            continue
        part = data[at:end[j - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[:len(part)], out=sums[1:])
        h[i:j] = (sums[end[i:j] - at] - sums[start[i:j] - at]) * down[start[i:j] - at]
        i = j
    return mix(h + (end - start).astype(np.uint64)), start, end


def shingle_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """For every text the sorted distinct hashes of its shingles of ``words`` words; a
    text of fewer words has one, of them all; a text without words has none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.cumsum([0] + [len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    h, start, _ = word_hashes(data)
    bound = np.searchsorted(start, offsets)
    turn = [_power(1, words + 2)[i + 1] for i in range(words)]
    n = len(h) - words + 1
    if n > 0:
        full = np.zeros(n, np.uint64)
        for i in range(words):
            full = mix(full + h[i:i + n] * turn[i])
    out = []
    for a, b in zip(bound[:-1], bound[1:]):
        if b - a >= words:
            out.append(np.unique(full[a:b - words + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                short = mix(short + h[i:i + 1] * turn[i - a])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
