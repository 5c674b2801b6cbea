"""Counts over whole texts that the quality rules and the quality classifier share."""

from __future__ import annotations

import numpy as np

from corvane.llm.kernels import (BYTE_VALUES, TOKEN_BITS, WHITE, mix, span_hashes, word_spans)

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a per-byte flag or number over each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _keyed(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return rows.astype(np.uint64) << TOKEN_BITS | hashes >> (np.uint64(64) - TOKEN_BITS)


def line_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every line between line feeds; an empty row has one empty line."""
    feeds = np.flatnonzero(raw == 0x0A)
    feed_rows = np.searchsorted(off, feeds, side="right") - 1
    n = len(off) - 1
    starts = np.concatenate([off[:-1], feeds + 1])
    ends = np.concatenate([feeds, off[1:]])
    rows = np.concatenate([np.arange(n), feed_rows])
    end_rows = np.concatenate([feed_rows, np.arange(n)])
    first, last = np.lexsort((starts, rows)), np.lexsort((ends, end_rows))
    return starts[first], ends[last], rows[first]


def repeated_words(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 3) -> np.ndarray:
    """Words of each row inside a ``width``-word window that the row holds twice or more."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(n_rows, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += hashes[i:n + i] * mix(np.array([2 * i + 1], np.uint64))
    at = np.flatnonzero(rows[:n] == rows[width - 1:])
    keys = _keyed(mix(total[at]), rows[at])
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for i in range(width):
        covered[at[twice] + i] = True
    return np.bincount(rows[covered], minlength=n_rows)


def repeated_lines(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them equal to an earlier one) of each row."""
    starts, ends, rows = line_spans(raw, off)
    words = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~WHITE[raw], out=words[1:])
    full = words[ends] > words[starts]
    starts, ends, rows = starts[full], ends[full], rows[full]
    n = len(off) - 1
    lines = np.bincount(rows, minlength=n)
    if not len(starts):
        return lines, np.zeros(n, np.int64)
    keys = np.unique(_keyed(span_hashes(BYTE_VALUES[raw], starts, ends), rows))
    return lines, lines - np.bincount((keys >> TOKEN_BITS).astype(np.int64), minlength=n)


def measures(raw: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition counts of each row."""
    n = len(off) - 1
    starts, ends, rows = word_spans(raw, off)
    hashes = span_hashes(BYTE_VALUES[raw], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    lead = (raw & 0xC0) != 0x80
    lines, duplicates = repeated_lines(raw, off)
    distinct = np.unique(_keyed(hashes, rows)) if len(hashes) else np.zeros(0, np.uint64)
    return {
        "n_words": np.bincount(rows, minlength=n),
        "n_distinct": np.bincount((distinct >> TOKEN_BITS).astype(np.int64), minlength=n),
        "n_short": np.bincount(rows[ends - starts <= 2], minlength=n),
        "n_chars": per_row(lead, off),
        "word_chars": per_row(lead & ~WHITE[raw], off),
        "n_symbols": per_row(_SYMBOLS[raw], off),
        "n_lines": lines,
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated_words(hashes, rows, n),
    }
