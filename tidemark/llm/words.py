"""Words, lines and windows of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts of a batch lie one after the other in one buffer, as Arrow keeps them. A hash of any stretch
of the buffer comes from one running sum: byte i counts with R**i modulo 2**64, and the difference
of two sums is divided by R**start. All arithmetic wraps around."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Arrays over a part, and tables of powers as long as one, take up to some hundred times this.
PART_BYTES = 1 << 19
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), at least n of them."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, PART_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * PART_BYTES:  # the tables for one giant text are not kept
            _POWERS[base] = have
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums for ``stretch``; one longer than the values."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(_R, len(values))[: len(values)], out=out[1:])
    return out


def stretch(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end)."""
    value = (running[end] - running[start]) * powers(_R_INVERSE, len(running))[start]
    return mixed(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Texts:
    """Texts one after the other: text i is data[ends[i-1]:ends[i]]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position is in."""
        return np.searchsorted(self.ends, positions, side="right")

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of bytes b with member[b]; a run ends with its text."""
        inside = member[self.data]
        edge = np.empty(len(inside) + 1, dtype=bool)
        edge[0], edge[-1] = False, False
        np.logical_and(inside[1:], inside[:-1], out=edge[1:-1])
        edge[self.starts] = False
        edge[self.ends] = False
        return np.flatnonzero(inside & ~edge[:-1]), np.flatnonzero(inside & ~edge[1:]) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the lines between line feeds; a text has one line more than feeds."""
        feeds = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.starts, feeds + 1])
        ends = np.concatenate([feeds, self.ends])
        # Sorting keeps an empty text's line, whose start is the next text's start, in its place.
        return np.sort(starts, kind="stable"), np.sort(ends, kind="stable")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[slice, Texts]]:
    """The texts in groups of at most ``limit`` bytes; a longer text is a group of its own."""
    data, at = buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        own = at[first : last + 1] - at[first]
        yield slice(first, last), Texts(data[at[first] : at[last]], own[:-1], own[1:])
        first = last


def counted(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Rows per owner 0..n-1."""
    return np.bincount(owner, weights=weights, minlength=n).astype(np.int64)


def twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    found = np.zeros(len(keys), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found
