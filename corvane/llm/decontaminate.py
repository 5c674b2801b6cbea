"""Operator 1: benchmark decontamination by pigeonhole pieces and Myers' bit-parallel edit distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.kernels import WHITE, flat, mix
from corvane.llm.rows import batch, fresh, map_blocks, materialize, shared, texts

#: Edits allowed per byte of an item; items of fewer bytes than the second are found only unchanged, as whole words.
ERROR_RATE, LEAST_BYTES = 0.05, 20
#: Bytes of items that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 8 * 2 ** 20
_KEY = 8


def normal(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with A-Z folded and each run of white space as one blank."""
    low = raw.copy()
    upper = (low >= 65) & (low <= 90)
    low[upper] += 32
    white = WHITE[raw]
    low[white] = 0x20
    keep = ~white
    if len(raw):
        first = np.zeros(len(raw) + 1, bool)
        first[off] = True
        keep[1:] |= ~white[:-1]
        keep |= first[:-1]
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return low[keep], before[off]


def normal_bytes(text: str) -> bytes:
    raw, _ = normal(*flat(pa.array([text])))
    return raw.tobytes().strip(b" ")


def myers(pattern: bytes, text: bytes, most: int) -> tuple[int, int]:
    """(least edits of the pattern to any part of the text, where the first such part ends); edits above ``most``: most + 1."""
    m = len(pattern)
    masks: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, min(m, most + 1), 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Pieces of the items: an item with an error budget of k is cut into k + 1, one of which survives k edits."""

    def __init__(self, items: list[tuple[int | None, bytes]], rate: float = ERROR_RATE, least: int = LEAST_BYTES):
        self.items = items
        self.budget = [int(len(text) * rate) if len(text) >= least else 0 for _, text in items]
        self.whole = [len(text) < least for _, text in items]
        places: dict[bytes, list[tuple[int, int, bytes]]] = defaultdict(list)
        self.short: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text) in enumerate(items):
            parts = self.budget[n] + 1
            for i in range(parts):
                at, end = len(text) * i // parts, len(text) * (i + 1) // parts
                piece = text[at:end]
                if len(piece) < _KEY:
                    self.short[piece].append((n, at))
                else:
                    places[piece[:_KEY]].append((n, at, piece))
        self.keys = np.array(sorted(int.from_bytes(k, "big") for k in places), np.uint64)
        self.places = {int.from_bytes(k, "big"): v for k, v in places.items()}
        self.sieve = np.zeros(2 ** 22, bool)
        self.sieve[mix(self.keys) >> np.uint64(42)] = True

    def _piece_hits(self, raw: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """For (row, item): where the item would start, by each exact piece hit."""
        hits: dict[tuple[int, int], set[int]] = defaultdict(set)
        if len(raw) >= _KEY and len(self.keys):
            keys = np.zeros(len(raw) - _KEY + 1, np.uint64)
            for i in range(_KEY):
                keys = keys << np.uint64(8) | raw[i:len(keys) + i]
            at = np.flatnonzero(self.sieve[mix(keys) >> np.uint64(42)])
            found = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
            at = at[self.keys[found] == keys[at]]
            rows = np.searchsorted(off, at, side="right") - 1
            for p, row, key in zip(at.tolist(), rows.tolist(), keys[at].tolist()):
                for n, offset, piece in self.places[key]:
                    end = p + len(piece)
                    if end <= off[row + 1] and raw[p:end].tobytes() == piece:
                        hits[row, n].add(p - offset)
        if self.short:
            whole = raw.tobytes()
            for piece, owners in self.short.items():
                p = whole.find(piece)
                while p >= 0:
                    row = int(np.searchsorted(off, p, side="right")) - 1
                    if p + len(piece) <= off[row + 1]:
                        for n, offset in owners:
                            hits[row, n].add(p - offset)
                    p = whole.find(piece, p + 1)
        return hits

    def find(self, raw: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, edits, end in the normalised row) of every item within its budget; its best, then first, place."""
        out = []
        for (row, n), starts in self._piece_hits(raw, off).items():
            text, k = self.items[n][1], self.budget[n]
            best, run = None, []
            if self.whole[n]:
                first = next((p for p in sorted(starts) if _stands_alone(raw, int(off[row]), int(off[row + 1]), p, text)), None)
                if first is not None:
                    out.append((row, self.items[n][0], 0, first + len(text) - int(off[row])))
                continue
            for start in [*sorted(starts), None]:
                if run and (start is None or start - run[-1] > 2 * k + 1):  # one window per cluster of hits
                    a = max(int(off[row]), run[0] - k)
                    b = min(int(off[row + 1]), run[-1] + len(text) + k)
                    edits, end = myers(text, raw[a:b].tobytes(), k)
                    if edits <= k and (best is None or edits < best[0]):
                        best = (edits, a + end - int(off[row]))
                    run = []
                if start is not None:
                    run.append(start)
            if best:
                out.append((row, self.items[n][0], *best))
        return sorted(out, key=lambda hit: (hit[0], hit[1] is None, hit[1] or 0, *hit[2:]))


def _stands_alone(raw: np.ndarray, low: int, high: int, at: int, text: bytes) -> bool:
    """Whether ``text`` is at ``at`` inside the row and no letter or digit goes on beyond either end of it."""
    end = at + len(text)
    if at < low or end > high or raw[at:end].tobytes() != text:
        return False
    before = at > low and _wordy(int(raw[at - 1])) and _wordy(text[0])
    after = end < high and _wordy(int(raw[end])) and _wordy(text[-1])
    return not before and not after


def _wordy(byte: int) -> bool:
    """Letters, digits and every byte of a character beyond ASCII."""
    return byte >= 128 or chr(byte).isalnum()


def matchers(benchmark: DataFrame, rate: float = ERROR_RATE, least: int = LEAST_BYTES) -> Iterator[Matcher]:
    """The distinct items in passes of bounded size; each is read and built when it is asked for.

    Null items and items without a word are not looked for. Items under ``least`` bytes are looked for
    without edits and as whole words, as parts of other words would be found by chance.
    """
    own = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .dropna(subset=["text"]).dropDuplicates()
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // PASS_BYTES) or 1
    for i in range(passes):
        part = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).collect()
        items = {(r["item_id"], normal_bytes(r["text"])) for r in part}
        items = sorted(items, key=lambda item: (item[0] is None, item[0] or 0, item[1]))
        yield Matcher([x for x in items if x[1]], rate, least)


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``edits``, ``end_byte``: every benchmark item found in every whole text.

    An item is found where some part of the text is at most ``rate`` times its length away, in edits of
    bytes, after folding A-Z and runs of white space on both sides; ``end_byte`` is where the best part
    ends in the normalised text. Items under ``LEAST_BYTES`` bytes are found unchanged between word
    boundaries. The benchmark goes to the tasks in passes of bounded size; a pass reads the documents
    once and shuffles nothing, and where there are several each is written before the next is built, so
    one matcher is held at a time. Items that occur in very many rows cost one verification per row.

    Null or empty texts: no rows. Very long texts: taken whole, in a block of their own. Items with a
    text but a null id: found, reported with a null ``item_id``. Repeated rows and null ids: each row
    reports its own items. Other columns are not read. Empty tables: empty result.
    """
    source = texts(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def one(matcher) -> DataFrame:
        def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
            found = matcher.value.find(*normal(*flat(block.column("text"))))
            rows, items, edits, ends = zip(*found) if found else ((), (), (), ())
            return batch(doc_id=block.column("doc_id").take(pa.array(rows, pa.int64())),
                         item_id=pa.array(items, pa.int64()), edits=pa.array(edits, pa.int32()),
                         end_byte=pa.array(ends, pa.int64()))
        return map_blocks(source, kernel, f"doc_id {kind}, item_id bigint, edits int, end_byte bigint")
    return reduce(DataFrame.unionByName, _in_turn(docs.sparkSession, benchmark, rate, one, "leaks"))


def _in_turn(spark: SparkSession, benchmark: DataFrame, rate: float, one: Callable[[Broadcast], DataFrame],
             name: str) -> Iterator[DataFrame]:
    """What ``one`` makes of each pass; all but the last are written, and their matcher let go, before the next is built."""
    held = None
    for matcher in matchers(benchmark, rate):
        if held is not None:
            yield materialize(one(held), name)
            held.unpersist()
        held = shared(spark, matcher)
    yield one(held)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; all columns as they are.

    Null or empty texts stay, as do all rows where a table is empty; repeated rows share their fate.
    """
    body, schema, left = fresh(docs, "__body"), docs.schema, docs

    def one(matcher) -> DataFrame:
        def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
            found = matcher.value.find(*normal(*flat(block.column(body))))
            keep = np.ones(block.num_rows, bool)
            keep[[row for row, *_ in found]] = False
            return block.drop_columns([body]).filter(pa.array(keep))
        return map_blocks(left.withColumn(body, F.col(f"`{text}`").cast("string")), kernel, schema, body)
    for kept in _in_turn(docs.sparkSession, benchmark, rate, one, "clean"):
        left = kept
    return left
