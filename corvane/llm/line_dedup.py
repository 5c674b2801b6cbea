"""Operator 8: line dedup by a segment-partition edit join with banded bit-parallel verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import linking
from corvane.llm.kernels import BYTE_VALUES, WHITE, blocks, flat, longs, mix, powers, span_hashes
from corvane.llm.measures import line_spans
from corvane.llm.rows import TABLE_ENTRIES, batch, fresh, map_blocks, materialize, shared, table
from corvane.scale import fits_broadcast, lookup_join
from corvane.ship import ship

#: Edits (of bytes) between lines of one class, and the shortest line that may differ at all.
EDITS, LEAST_BYTES = 2, 24


def _lines(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, number in its row) of the lines with a word."""
    starts, ends, rows = line_spans(raw, off)
    number = np.arange(len(rows)) - np.searchsorted(rows, rows)
    words = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~WHITE[raw], out=words[1:])
    full = words[ends] > words[starts]
    return starts[full], ends[full], rows[full], number[full]


def _ids(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(BYTE_VALUES[raw], starts, ends) if len(starts) else np.zeros(0, np.uint64)


def _unseen(ids: np.ndarray, seen: set[int]) -> np.ndarray:
    out = np.zeros(len(ids), bool)
    for i, x in enumerate(ids.tolist()):
        if x not in seen:
            seen.add(x)
            out[i] = True
    return out


def segment(length: np.ndarray, i: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of segment ``i`` of ``edits + 1`` nearly equal ones of a line of ``length``; the last are longer."""
    parts = edits + 1
    size, more = length // parts, length % parts
    longer = parts - more
    start = i * size + np.maximum(i - longer, 0)
    return start, size + (i >= longer)


def probes(length: int, edits: int):
    """(partner's length less, segment, shift) of every substring that a line must look up.

    A line within ``edits`` of a partner that is ``delta`` bytes shorter holds segment ``i`` of the partner
    unchanged, moved by a shift that both the edits before it and those after it allow.
    """
    for delta in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, delta - (edits - i))
            high = min(i, delta + (edits - i))
            for shift in range(low, high + 1):
                yield delta, i, shift


def _keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, delta: int, i: int, shift: int,
          edits: int, total: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of (length, segment, substring), which lines have it) for one kind of probe."""
    length = ends - starts - delta
    at, size = segment(length, i, edits)
    at = starts + at + shift
    ok = np.flatnonzero((length >= LEAST_BYTES) & (at >= starts) & (at + size <= ends))
    at, size, length = at[ok], size[ok], length[ok]
    spans = (total[at + size] - total[at]) * down[at]
    return mix(spans ^ mix(length.astype(np.uint64) << np.uint64(8) | np.uint64(i))), ok


def _postings(source: DataFrame, edits: int, index: bool) -> DataFrame:
    """``key``, ``id`` and, for probes, ``own``: the segments of every distinct line, or those and its other probes."""
    ship(source.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for block in blocks(batches, max_bytes=2 ** 20):
            raw, off = flat(block.column("text"))
            starts, ends, _, _ = _lines(raw, off)
            ids = _ids(raw, starts, ends)
            new = _unseen(ids, seen) & (ends - starts >= LEAST_BYTES)
            starts, ends, ids = starts[new], ends[new], ids[new]
            up, down = powers(len(raw))
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(BYTE_VALUES[raw] * up[:len(raw)], out=total[1:])
            keys, names, own = [], [], []
            for delta, i, shift in probes(0, edits):
                home = delta == 0 and shift == 0
                if home or not index:
                    k, ok = _keys(raw, starts, ends, delta, i, shift, edits, total, down)
                    keys.append(k)
                    names.append(ids[ok])
                    own.append(np.full(len(k), home))
            columns = {"key": longs(np.concatenate(keys)), "id": longs(np.concatenate(names))}
            if not index:
                columns["own"] = pa.array(np.concatenate(own))
            yield batch(**columns)
    return source.select("text").mapInArrow(run, "key bigint, id bigint" + ("" if index else ", own boolean"))


def _core(a: bytes, b: bytes) -> tuple[bytes, bytes]:
    """Both lines without their common start and common end, which no least edit touches."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    differ = np.flatnonzero(x[:n] != y[:n])
    start = int(differ[0]) if len(differ) else n
    n -= start
    differ = np.flatnonzero(x[len(a) - n:][::-1] != y[len(b) - n:][::-1])
    end = int(differ[0]) if len(differ) else n
    return a[start:len(a) - end], b[start:len(b) - end]


def banded(a: bytes, b: bytes, most: int) -> bool:
    """Whether ``a`` and ``b`` are at most ``most`` edits apart.

    Only ``2 * most + 1`` diagonals can be reached. Bit j of ``state[e]`` says that the bytes of ``a`` so far
    are within e edits of the bytes of ``b`` up to diagonal j; a byte of ``a`` moves all diagonals at once,
    and the search ends with the first byte that no diagonal survives.
    """
    if abs(len(a) - len(b)) > most:
        return False
    a, b = _core(a, b)
    width = 2 * most + 1
    state = [((1 << min(most + e, len(b) + most) + 1) - 1) >> most << most for e in range(most + 1)]
    for i, c in enumerate(a):
        equal = room = 0
        for j in range(max(most - i - 1, 0), min(width, len(b) + most - i)):
            room |= 1 << j
            at = i + j - most
            if 0 <= at < len(b) and b[at] == c:
                equal |= 1 << j
        after: list[int] = []
        for e in range(most + 1):
            new = state[e] & equal
            if e:  # replace the byte, drop it, or add a byte of b
                new |= state[e - 1] | state[e - 1] >> 1 | after[e - 1] << 1
            after.append(new & room)
        state = after
        if not state[most]:
            return False
    return bool(state[most] >> (len(b) - len(a) + most) & 1)


def _texts(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id``, ``line`` of the lines that ``wanted`` (``id``) names."""
    ship(source.sparkSession)
    small = fits_broadcast(wanted, max_rows=2 * TABLE_ENTRIES)[1]
    names = shared(source.sparkSession, table(wanted, 2 * TABLE_ENTRIES)["id"] if small else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for block in blocks(batches):
            raw, off = flat(block.column("text"))
            starts, ends, _, _ = _lines(raw, off)
            ids = _ids(raw, starts, ends)
            if names.value is not None:
                keep = np.isin(ids.view(np.int64), names.value)
                starts, ends, ids = starts[keep], ends[keep], ids[keep]
            new = _unseen(ids, seen)
            whole = raw.tobytes()
            lines = [whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            yield batch(id=longs(ids[new]), line=pa.array(lines, pa.binary()))
    found = source.select("text").mapInArrow(run, "id bigint, line binary")
    if not small:
        found = found.join(wanted, "id", "left_semi")
    return found.dropDuplicates(["id"])


def line_classes(source: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """``id``, ``label`` of the lines that are linked with another line by at most ``edits`` edits.

    ``lines``: ``id`` and parity bits of every distinct line; pairs whose bits are too far apart are not verified.
    """
    bits = lines.select("id", *_LANES)

    def plausible(pairs: DataFrame) -> DataFrame:
        both = pairs.select("a", "b")
        for side in ("a", "b"):
            both = both.join(bits.toDF(side, *[f"{side}_{c}" for c in _LANES]), side)
        return both.filter(near_pairs("a_", "b_", edits)).select("a", "b")

    index = _postings(source, edits, True).groupBy("key").agg(F.min("id").alias("lo"))
    index = materialize(index, "keys")
    met = _postings(source, edits, False).join(index, "key").filter("id <> lo")

    def verify(pairs: DataFrame) -> DataFrame:
        wanted = materialize(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
                             .distinct(), "wanted")
        lines = materialize(_texts(source, wanted), "lines")
        both = pairs.select("a", "b").join(lines.select(F.col("id").alias("a"), F.col("line").alias("x")), "a") \
            .join(lines.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                keep = [banded(x, y, edits) for x, y in zip(rows.column("x").to_pylist(), rows.column("y").to_pylist())]
                yield batch(a=rows.column("a"), b=rows.column("b")).filter(pa.array(keep, pa.bool_()))
        return both.mapInArrow(run, "a bigint, b bigint")
    return linking.classes(met, verify, plausible, lambda members: members.select("id").distinct().join(bits, "id"),
                           lambda left, right: near_pairs(left, right, edits))


_LANES = [f"c{i}" for i in range(4)]
_PAIR_BITS = mix(np.arange(2 ** 16, dtype=np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(56)


def pair_parities(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """256 bits per line, in four longs: for each of 256 buckets, whether an odd number of the line's pairs of
    neighbouring bytes fall into it."""
    codes = raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]
    last = np.maximum(ends - 1, starts)
    out = []
    for lane in range(4):
        one = np.where(_PAIR_BITS >> np.uint64(6) == lane, np.uint64(1) << (_PAIR_BITS & np.uint64(63)), np.uint64(0))
        total = np.zeros(len(codes) + 1, np.uint64)
        np.bitwise_xor.accumulate(one[codes], out=total[1:])
        out.append(total[last] ^ total[starts])
    return out


def near_pairs(left: str, right: str, edits: int) -> Column:
    """Whether the bits of two lines allow for ``edits`` edits, each of which takes away two pairs and adds two at most."""
    apart = reduce(Column.__add__, [F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in _LANES])
    return apart <= 4 * edits


def row_key(key: Column, text: Column) -> Column:
    """What tells documents apart: a hash of id and text. Repeated rows are one document."""
    return F.xxhash64(F.lit(8), key, text)


def removals(docs: DataFrame, edits: int = EDITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row_key``, ``numbers``: the line numbers (from 0) to be removed from each document that loses any.

    Of every class of lines the first occurrence stays, by least id (null last), then row key, then line number.
    """
    own, body = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    source = docs.select(own.alias("doc_id"), body.alias("text"), row_key(own, body).alias("row_key"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        raw, off = flat(block.column("text"))
        starts, ends, rows, number = _lines(raw, off)
        at = pa.array(rows, pa.int64())
        bits = dict(zip(_LANES, map(longs, pair_parities(raw, starts, ends))))
        return batch(**bits, doc_id=block.column("doc_id").take(at), row_key=block.column("row_key").take(at),
                     number=pa.array(number, pa.int32()), id=longs(_ids(raw, starts, ends)))
    lines = materialize(map_blocks(source, kernel, f"{', '.join(f'{c} bigint' for c in _LANES)}, "
                                   f"doc_id {kind}, row_key bigint, number int, id bigint"), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_key", "number")
    each = lines.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n"),
                                   *[F.first(c).alias(c) for c in _LANES])
    each = materialize(each, "firsts")
    labels = line_classes(source, each, edits)
    named = each.join(labels.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left") \
        .select("id", "first", "n", F.coalesce("label", "id").alias("label"))
    named = materialize(named, "named")
    heads = named.groupBy("label").agg(F.min("first").alias("head"), F.sum("n").alias("all")).filter("all > 1")
    firsts = materialize(named.select("id", "label").join(heads, "label").select("id", "head"), "heads")
    met = lookup_join(lines.drop(*_LANES), firsts, ["id"], "inner")
    gone = met.filter((F.col("row_key") != F.col("head.row_key")) | (F.col("number") != F.col("head.number")))
    return gone.groupBy("row_key").agg(F.collect_set("number").alias("numbers"))


def dedup(docs: DataFrame, edits: int = EDITS, key: str = "doc_id", text: str = "text",
          counts: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; with ``counts``, also ``n_lines`` and ``n_removed``.

    A line is what stands between line feeds. Lines without a word always stay. Lines are of one class if
    they are equal, or at most ``edits`` byte edits apart and both of 24 bytes or more, or connected by
    such lines. Of each class the first occurrence in the table stays, all others go; what is left of a
    document is joined again by line feeds. Every row stays, if only with an empty text.

    Edit join: a line is cut into ``edits + 1`` segments, so a line within the budget holds one of them
    unchanged, close to its place. Substrings are looked up by length, segment and content; candidates
    that are not connected already are verified.

    Null text: stays null. Repeated rows (equal id and text): one document, all treated alike. Null ids:
    last in order. Other columns: kept as they are. Empty table: empty result. Lines are told apart by
    64-bit hashes.
    """
    gone = materialize(removals(docs, edits, key, text), "removed")
    name, drop = fresh(docs, "__key"), fresh(docs, "__drop")
    keyed = docs.withColumn(name, row_key(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")))
    both = keyed.join(gone.select(F.col("row_key").alias(name), F.col("numbers").alias(drop)), name, "left").drop(name)
    kept = [c for c in docs.columns if not (counts and c in ("n_lines", "n_removed"))]
    body = fresh(both, "__body")
    both = both.select(*[F.col(f"`{c}`") for c in kept if c != text], F.col(f"`{text}`").cast("string").alias(body), drop)

    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        values, drops = block.column(body).to_pylist(), block.column(drop).to_pylist()
        out, sizes = [], []
        for value, numbers in zip(values, drops):
            sizes.append(0 if value is None else value.count("\n") + 1)
            if numbers:
                skip = set(numbers)
                value = "\n".join([x for i, x in enumerate(value.split("\n")) if i not in skip])
            out.append(value)
        columns = {c: block.column(c) for c in kept if c != text} | {text: pa.array(out, pa.string())}
        columns = {c: columns[c] for c in kept}
        if counts:
            columns |= {"n_lines": pa.array(sizes, pa.int64()),
                        "n_removed": pa.array([len(set(x or ())) for x in drops], pa.int64())}
        return batch(**columns)
    kinds = {c: docs.schema[c].dataType.simpleString() for c in kept} | {text: "string"}
    if counts:
        kinds |= {"n_lines": "bigint", "n_removed": "bigint"}
    return map_blocks(both, kernel, ", ".join(f"`{c}` {k}" for c, k in kinds.items()), body)
