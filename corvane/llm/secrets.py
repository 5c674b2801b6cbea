"""Operator 4: secret scans through a trigram index with Boolean queries derived from each regex."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm.kernels import flat
from corvane.llm.rows import batch, map_blocks, texts

_MOST = 64
Query = frozenset[frozenset[bytes]]
ANY: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long the whole match or a group must be."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.fold else 0))


#: The base kinds, in the order in which spans of equal start are listed.
BASE = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         least=6, group=2, fold=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    # The longest runs of 24 or more are the leftmost longest runs that pass.
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
#: Further kinds that the scan adds.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
)


def _exact(item) -> set[str] | None:
    """All strings that a part of a pattern matches, if they are few."""
    kind, arg = item
    if kind is op.LITERAL:
        return {chr(arg)}
    if kind is op.IN and len(arg) <= 8 and all(k is op.LITERAL for k, _ in arg):
        return {chr(c) for _, c in arg}
    if kind is op.SUBPATTERN:
        return _all_exact(arg[3])
    if kind is op.BRANCH:
        each = [_all_exact(x) for x in arg[1]]
        return None if None in each else set().union(*each)
    if kind is op.MAX_REPEAT and arg[1] <= 1:
        inner = _all_exact(arg[2])
        return inner if inner is None or arg[0] else inner | {""}
    if kind is op.AT:
        return {""}
    return None


def _all_exact(items) -> set[str] | None:
    out = {""}
    for item in items:
        more = _exact(item)
        if more is None or len(out) * len(more) > _MOST:
            return None
        out = {a + b for a in out for b in more}
    return out


def _both(a: Query, b: Query) -> Query:
    return frozenset(x | y for x in a for y in b) if len(a) * len(b) <= _MOST else a


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings, by its trigrams in lower case."""
    folded = [s.encode().lower() for s in strings]
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in folded)


def _sequence(items) -> Query:
    query, strings = ANY, {""}
    for item in items:
        more = _exact(item)
        if more is not None and len(strings) * len(more) <= _MOST:
            strings = {a + b for a in strings for b in more}
            continue
        query, strings = _both(query, _of_strings(strings)), {""}
        if more is not None:
            strings = more
            continue
        kind, arg = item
        if kind is op.SUBPATTERN:
            query = _both(query, _sequence(arg[3]))
        elif kind is op.BRANCH:
            query = _both(query, frozenset().union(*[_sequence(x) for x in arg[1]]))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] >= 1:
            query = _both(query, _sequence(arg[2]))
    return _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams (lower case) of which every match holds one whole alternative.

    An alternative without trigrams is always met; then the query says nothing and the rule scans all.
    """
    query = _sequence(parser.parse(pattern))
    return ANY if frozenset() in query else query


class Index:
    """Postings (rows of a block) of the trigrams that the rules ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.patterns = [r.compiled() for r in rules]
        grams = sorted({g for q in self.queries for x in q for g in x})
        self.slots = {g: i + 1 for i, g in enumerate(grams)}
        self._slot = np.zeros(2 ** 24, np.uint8 if len(grams) < 255 else np.uint16)
        for gram, slot in self.slots.items():
            self._slot[int.from_bytes(gram, "big")] = slot
        self._fold = np.arange(256, dtype=np.uint8)
        self._fold[65:91] += 32

    def postings(self, raw: np.ndarray, off: np.ndarray) -> dict[bytes, np.ndarray]:
        """Rows that hold each trigram; one that spans two rows is laid to the first, which does no harm."""
        low = self._fold[raw].astype(np.int32)
        codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.int32)
        slots = self._slot[codes]
        at = np.flatnonzero(slots)
        rows = np.searchsorted(off, at, side="right") - 1
        pairs = np.unique(slots[at].astype(np.int64) << 32 | rows)
        bounds = np.searchsorted(pairs >> 32, np.arange(len(self.slots) + 2))
        return {g: pairs[bounds[s]:bounds[s + 1]] & (2 ** 32 - 1) for g, s in self.slots.items()}

    def candidates(self, raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Rows that each rule must verify: those whose postings meet its query."""
        postings = self.postings(raw, off)
        every = np.flatnonzero(np.diff(off))
        out = []
        for query in self.queries:
            if query == ANY:
                out.append(every)
                continue
            met = [reduce(np.intersect1d, [postings[g] for g in sorted(x)]) for x in query]
            out.append(reduce(np.union1d, met))
        return out

    def spans(self, texts_: list[str], raw: np.ndarray, off: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) of each verified match, in order, per row; code points."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts_]
        for number, rows in enumerate(self.candidates(raw, off)):
            rule, pattern = self.rules[number], self.patterns[number]
            for row in rows.tolist():
                for m in pattern.finditer(texts_[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), number, m.end()))
        for row in found:
            row.sort()
        return found


_indexes: dict[tuple[Rule, ...], Index] = {}


def scan(docs: DataFrame, added: tuple[Rule, ...] = ADDED, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets in every whole text.

    Each task indexes its blocks of rows: the trigrams that the rules ask for get postings, a rule's
    query is answered by intersecting and uniting them, and only candidates meet the regex. Rules
    without a mandatory trigram (``hex``) read every row. Nothing is shuffled, and no index outlives
    its block, so memory is bounded by the block and a lost task is simply repeated.

    Returns ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``; one row per input row.
    A span covers the whole match. Null text: as an empty one, no spans. Repeated rows and null ids:
    kept. Other columns are not read. Empty table: empty result.
    """
    rules = (*BASE, *added)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        if rules not in _indexes:
            _indexes[rules] = Index(rules)
        column = block.column("text").fill_null("")
        raw, off = flat(column)
        found = _indexes[rules].spans(column.to_pylist(), raw, off)
        counts = [[sum(n == k for _, n, _ in row) for row in found] for k in range(len(BASE))]
        written = [[(n, f"{rules[n].kind}:{a}:{b}") for a, n, b in row] for row in found]
        base = [hashlib.sha256(",".join([s for n, s in row if n < len(BASE)]).encode()).hexdigest() for row in written]
        return batch(doc_id=block.column("doc_id"), n_assign=pa.array(counts[0], pa.int64()),
                     n_access=pa.array(counts[1], pa.int64()), n_hex=pa.array(counts[2], pa.int64()),
                     base_sha256=pa.array(base, pa.string()),
                     spans=pa.array([",".join([s for _, s in row]) for row in written], pa.string()))

    source = texts(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_blocks(source, kernel, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, "
                      "base_sha256 string, spans string")
