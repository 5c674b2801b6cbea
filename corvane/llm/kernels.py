"""Array code shared by the operators: Arrow text columns as flat bytes, words, shingles, hashes.

Everything here works on one bounded block of rows inside a task. A block holds at most
``BLOCK_BYTES`` of text, or one text if that is longer, and ``BLOCK_ROWS`` rows; no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 * 2 ** 20
COUNT_BYTES = 2 ** 20  # of text at once where all words or n-grams of a block are counted: 50 MB of arrays
BLOCK_ROWS = 4096
TOKEN_BITS = np.uint64(52)
TOKEN_MASK = np.uint64(2 ** 52 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_MASK = 2 ** 64 - 1

#: The white space of the word rule: space and \t \n \v \f \r, as bytes.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers one to one (the splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if fold:
        codes[65:91] += np.uint64(32)
    return mix((codes + np.uint64(1)) * _ODD)


BYTE_VALUES = _byte_values(False)
FOLDED_VALUES = _byte_values(True)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base modulo 2^64, and of its inverse."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, 2 ** 64)):
            out = np.ones(size, np.uint64)
            done, step = 1, base
            while done < size:  # doubling: out[done:2*done] = out[:done] * base**done
                out[done:2 * done] = out[:done] * np.uint64(step)
                done, step = 2 * done, step * step & _MASK
            both.append(out)
        _powers[size] = tuple(both)
    return _powers[size]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``values[start:end]``, equal for equal spans wherever they stand."""
    up, down = powers(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    spans = (total[ends] - total[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * _ODD)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into blocks of at most ``max_bytes`` of text, or one row."""
    max_bytes = max_bytes or BLOCK_BYTES
    for batch in batches:
        _, off = flat(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), at + BLOCK_ROWS, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word ``[^\\x20\\x09-\\x0D]+`` of the rows."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~WHITE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(off, starts, side="right") - 1
    return starts, np.flatnonzero(ends) + 1, rows


def shingles(raw: np.ndarray, off: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(token, row) of the distinct ``width``-word shingles of each row, ordered by row, then token.

    Words are compared with A-Z folded. A row with fewer words has its whole sequence as one
    shingle; a row without words has none. A token is a 52-bit hash of the words: two shingles
    of one row share a token with a chance of one in 10^7 for 20,000 words.
    """
    starts, ends, rows = word_spans(raw, off)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = span_hashes(FOLDED_VALUES[raw], starts, ends)
    n_rows = len(off) - 1
    counts = np.bincount(rows, minlength=n_rows)
    keys = mix(np.arange(1, width + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    parts = []
    if len(words) >= width:
        total = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            total += words[i:len(words) - width + 1 + i] * keys[i]
        whole = rows[:len(total)] == rows[width - 1:]
        parts.append(_packed(mix(total[whole]), rows[:len(total)][whole]))
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            total = np.full(len(short), n, np.uint64) * _ODD
            for i in range(n):
                total += words[firsts[short] + i] * keys[i]
            parts.append(_packed(mix(total), short))
    both = np.sort(np.concatenate(parts))
    both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both & TOKEN_MASK, (both >> TOKEN_BITS).astype(np.int64)


def _packed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Row number above the top ``TOKEN_BITS`` bits of the hash, so that one sort orders both."""
    return (rows.astype(np.uint64) << TOKEN_BITS) | (hashes >> (np.uint64(64) - TOKEN_BITS))


def row_bounds(owner: np.ndarray, n_rows: int) -> np.ndarray:
    """Where each row's items start in an array ordered by row, and the end of the last."""
    return np.searchsorted(owner, np.arange(n_rows + 1))


def longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def lists(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
