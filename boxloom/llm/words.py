"""Words of text batches as numpy arrays over UTF-8 bytes.

Separators are ASCII, so words are found on bytes.  A batch is cut into blocks
of bounded bytes first; one very long text makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_U32 = np.uint64(32)


def separators(spans: list[tuple[int, int]]) -> np.ndarray:
    """256 flags, true for bytes inside words; ``spans`` are the separating bytes, ends included."""
    flags = np.ones(256, dtype=bool)
    for first, last in spans:
        flags[first : last + 1] = False
    return flags


#: Words of ``[^\x20\x09-\x0D]+``.
BLANKS = separators([(0x20, 0x20), (0x09, 0x0D)])
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all beyond ASCII.
ALPHANUMERIC = separators([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """Some rows of a batch: ``data`` holds their bytes, row ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    _rows: np.ndarray | None = None

    @property
    def n_rows(self) -> int:
        return len(self.offsets) - 1

    @property
    def rows(self) -> np.ndarray:
        """Row of each word."""
        if self._rows is None:
            self._rows = np.repeat(np.arange(self.n_rows), np.diff(self.bounds))
        return self._rows

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def blocks(texts: pa.Array, inside: np.ndarray, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string column; NULL is an empty text.  ``bounds[i]:bounds[i + 1]`` are the words of row ``i``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    whole = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        data = whole[offsets[first] : offsets[last]]
        if lower:
            data = LOWER[data]
        yield _block(first, data, offsets[first : last + 1] - offsets[first], inside)
        first = last


def _block(first: int, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Block:
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    step = np.diff(flags)
    starts, ends = step[:-1] == 1, step[1:] == -1
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    touching = cut[(flags[cut + 1] == 1) & (flags[cut] == 1)]
    starts[touching] = True
    ends[touching - 1] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Block(first, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(block: Block, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes, eight bytes a step."""
    padded = np.concatenate([block.data, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray((len(block.data) + 1,), "<u8", padded, 0, (1,))
    length = block.ends - block.starts
    h = length.astype(np.uint64) * _ODD + np.uint64(seed)
    active, step = np.flatnonzero(length > 0), 0
    while len(active):
        left = length[active] - step
        chunk = eights[block.starts[active] + step]
        keep = np.full(len(active), ~np.uint64(0))
        short = left < 8
        keep[short] = (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        part = h[active] ^ (chunk & keep)
        part *= _MIX
        part ^= part >> _U32
        part *= _ODD
        part ^= part >> np.uint64(29)
        h[active] = part
        step += 8
        active = active[left > 8]
    return h


def power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def window_hashes(hashes: np.ndarray, length: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Rabin-Karp hash of each run of ``length`` words, built from runs of powers of two.

    Entry ``i`` is the polynomial ``sum(hashes[i + j] * base ** (length - 1 - j))`` modulo 2**64.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total, done, run, size = None, 0, hashes, 1
    while done < length:
        if length & size:
            if total is None:
                total = run[:]
            else:
                m = min(len(total), len(run) - done) if len(run) > done else 0
                total = total[:m] * power(base, size) + run[done : done + m]
            done += size
        if done < length:
            run = run[:-size] * power(base, size) + run[size:]
            size *= 2
    return total[:n]


def in_one_row(block: Block, length: int) -> np.ndarray:
    """For each possible window start of the block: whether its words are of one row."""
    n = len(block.starts) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    return block.rows[:n] == block.rows[length - 1 :]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    run, size = values, 1
    while size * 2 <= width:
        run = np.minimum(run[:-size], run[size:])
        size *= 2
    return np.minimum(run[:n], run[width - size : width - size + n])
