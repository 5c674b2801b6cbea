"""Vectorised splitting of texts into the pre-tokens of a byte-level vocabulary.

The rule is the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Its matches depend on
character classes and on the neighbours of a run only, so a block of texts is cut with array
operations on its code points; tests compare the cuts with the pattern itself.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import regex

from corvane.llm.kernels import mix, span_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_SHORT, _LONG = "stmd", ("re", "ve", "ll")


@functools.cache
def classes() -> np.ndarray:
    """Class of each code point."""
    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            for c in (run.group()[0], run.group()[-1]):
                assert ord(c) < 0x110000
            table[np.array([ord(c) for c in run.group()])] = kind
    return table


@functools.cache
def code_values() -> np.ndarray:
    """A random-looking 64-bit value for each code point."""
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.cache
def unassigned() -> np.ndarray:
    """Code points without an assigned class, on which libraries of other Unicode versions may differ."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(all texts joined, their code points, where each text starts and the last ends)."""
    joined = "".join(texts)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return joined, np.frombuffer(joined.encode("utf-32-le"), "<u4"), offsets


def cuts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of the texts start, ascending; each ends where the next starts."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[codes]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | first[1:-1]
    start = change.copy()
    space = kind == SPACE
    # The last of a run of white space before other characters: a blank joins them, others stand alone.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:-1]
    start |= last
    joins = np.flatnonzero(last & (codes == 0x20)) + 1
    start[joins] = False
    # A contraction stands alone if its apostrophe starts a match.
    quote = np.flatnonzero((codes == 0x27) & start)
    if len(quote):
        ends = offsets[np.searchsorted(offsets, quote, side="right")]
        letter = [codes[np.minimum(quote + k, n - 1)] for k in (1, 2)]
        one = (quote + 1 < ends) & np.isin(letter[0], [ord(c) for c in _SHORT])
        two = np.zeros(len(quote), bool)
        for a, b in _LONG:
            two |= (letter[0] == ord(a)) & (letter[1] == ord(b))
        two &= quote + 2 < ends
        start[quote[one | two] + 1] = False
        after = np.concatenate([quote[one] + 2, quote[two] + 3])
        start[after[after < n]] = True
    return np.flatnonzero(start)


def pieces(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined text, start, end, text number, 64-bit hash) of every pre-token."""
    joined, codes, offsets = code_points(texts)
    starts = cuts(codes, offsets)
    ends = np.append(starts[1:], len(codes)).astype(np.int64)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    hashes = span_hashes(code_values()[codes], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return joined, starts, ends, owner, hashes
