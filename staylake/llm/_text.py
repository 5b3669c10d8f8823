"""Whole-text helpers over Arrow string columns: word and shingle hashes as numpy arrays.

Everything works on the UTF-8 bytes of a batch at once. A text is never cut: a text longer than
``SEGMENT`` bytes is hashed in pieces that end between words, so memory stays a small multiple of
the batch itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_DIGIT = LOWER.astype(np.uint64) + np.uint64(1)
_RAW_DIGIT = np.arange(1, 257, dtype=np.uint64)

#: Word bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows (a null row is empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply, shift) on uint64."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(max(n, SEGMENT + 1), base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT bytes that end at the end of a row or between two words."""
    lo, total = 0, len(data)
    while lo < total:
        hi = min(lo + SEGMENT, total)
        if hi < total:
            row_end = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            if row_end > lo:
                hi = row_end
            else:
                while hi < total and is_word[data[hi]]:
                    step = np.flatnonzero(~is_word[data[hi: hi + SEGMENT]])
                    hi = hi + int(step[0]) if len(step) else min(hi + SEGMENT, total)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every lower-cased (A-Z) word of every row, in order, and the number of words per row."""
    h, s, _ = word_spans(data, offsets, is_word)
    return h, np.diff(np.searchsorted(s, offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every lower-cased (A-Z) word of all rows."""
    hashes, starts, ends = [], [], []
    for lo, hi in _spans(data, offsets, is_word):
        part = data[lo:hi]
        breaks = offsets[np.searchsorted(offsets, lo, "right"): np.searchsorted(offsets, hi, "left")] - lo
        inside = is_word[part]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        before[breaks] = False
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[breaks - 1] = False
        s, e = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        up, down = _power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_DIGIT[part] * up[: len(part)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s]))
        starts.append(s + lo)
        ends.append(e + lo)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(hashes, np.uint64), join(starts, np.int64), join(ends, np.int64)


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the exact bytes of ascending, adjoining spans; memory follows SEGMENT and the longest span."""
    out, at = [], 0
    while at < len(s):
        to = max(at + 1, int(np.searchsorted(e, s[at] + SEGMENT, "right")))
        lo, hi = int(s[at]), int(e[to - 1])
        up, down = _power_tables(hi - lo + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_RAW_DIGIT[data[lo:hi]] * up[: hi - lo], out=total[1:])
        out.append(mix((total[e[at:to] - lo] - total[s[at:to] - lo]) * down[s[at:to] - lo]))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the lines of all rows (a line keeps its newline) and the number of lines per row (1 for an empty row)."""
    after = np.flatnonzero(data == 10) + 1
    row_of = np.searchsorted(offsets, after - 1, "right") - 1
    counts = np.bincount(row_of, minlength=len(offsets) - 1) + 1 if len(offsets) > 1 else np.zeros(0, np.int64)
    merged = np.sort(np.concatenate([offsets[:-1], after]), kind="stable")
    return np.append(merged, offsets[-1:]), counts


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... inside each group of the given sizes."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def shingles(h: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each row; a row of fewer words is one shingle, a row of none has none."""
    many = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    if not len(h):
        return np.zeros(0, np.uint64), many
    factor = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(n)]  # powers: no small sums of them agree
    out = np.zeros(len(h), dtype=np.uint64)
    for i in range(n):
        out[: len(h) - i] += h[i:] * factor[i]
    first = np.cumsum(counts) - counts
    for k in range(1, n):
        at = first[counts == k]
        out[at] = np.uint64(k) + sum(h[at + i] * factor[i] for i in range(k))
    return mix(out[within(counts) < np.repeat(many, counts)]), many


def distinct(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes sorted and without repeats."""
    h, ends = h.copy(), np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = h[1:] != h[:-1]
    keep[(ends - counts)[counts > 0]] = True
    row = np.repeat(np.arange(len(counts)), counts)
    return h[keep], np.bincount(row[keep], minlength=len(counts))


def row_sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each row's values (0 for an empty row), modulo 2^64 for uint64."""
    total = np.zeros(len(x) + 1, dtype=x.dtype)
    np.cumsum(x, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def set_keys(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row's set of hashes, the same for equal sets in any order."""
    return mix(row_sums(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), counts) + counts.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text (a longer text is a batch of its own)."""
    for batch in batches:
        _, offsets = utf8(column(batch, name))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
