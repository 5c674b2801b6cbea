"""Operator 11: alignment of two tokenizers by products of token-byte incidence matrices."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.kernels import lists, longs, span_hashes
from corvane.llm.pretoken import LETTER, SPACE, classes, code_points, code_values
from corvane.llm.rows import batch, frequent, map_blocks, materialize, shared, table, texts
from corvane.ship import ship

#: Distinct stretches of text that a worker remembers between blocks; a full memory is emptied, which costs time only.
MEMORY = 2 ** 18
#: Tokens of one tokenizer that a block of encoded documents holds, or one document.
BLOCK_TOKENS = 2 ** 18
#: Bytes of text that are encoded together.
BLOCK_BYTES = 2 ** 20
#: Stretches given to the libraries at once.
STEP = 2 ** 14


@dataclass
class Csr:
    """A 0/1 matrix by compressed rows: row ``i`` has the columns ``col[ptr[i]:ptr[i + 1]]``."""

    ptr: np.ndarray
    col: np.ndarray
    width: int


def incidence(sizes: np.ndarray) -> Csr:
    """Tokens by bytes: token ``i`` covers the next ``sizes[i]`` bytes."""
    ptr = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return Csr(ptr, np.arange(ptr[-1]), int(ptr[-1]))


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.ptr) - 1), np.diff(m.ptr))
    order = slice(None) if (m.col[1:] >= m.col[:-1]).all() else np.argsort(m.col, kind="stable")
    ptr = np.concatenate([[0], np.cumsum(np.bincount(m.col, minlength=m.width))])
    return Csr(ptr, rows[order], len(m.ptr) - 1)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions ``starts[i]`` to ``starts[i] + sizes[i]`` for each i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def gustavson(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row product A·B as (row, column, number of common inner indices), ordered by row, then column.

    Each entry of a row of A brings in a row of B; equal columns of one row are added up.
    """
    owner = np.repeat(np.arange(len(a.ptr) - 1), np.diff(a.ptr))
    sizes = np.diff(b.ptr)[a.col]
    rows, cols = np.repeat(owner, sizes), b.col[ragged(b.ptr[a.col], sizes)]
    keys = rows * max(b.width, 1) + cols
    if not (keys[1:] >= keys[:-1]).all():
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    rows, cols = np.divmod(keys[first], max(b.width, 1))
    return rows, cols, np.diff(np.append(first, len(keys)))


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, common bytes) of every overlapping pair: the product of A with the transposed B."""
    return gustavson(incidence(a_sizes), transposed(incidence(b_sizes)))


def groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every A token and every B token; groups end where tokens of both end."""
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    both = np.zeros((b_ends[-1] if len(b_ends) else 0) + 1, bool)
    both[b_ends] = True
    cuts = a_ends[both[a_ends]]
    return np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)


def shared_groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every pair in one group: the product of the token-group matrices."""
    a_group, b_group = groups(a_sizes, b_sizes)
    n = int(a_group[-1]) + 1 if len(a_group) else 0
    one = [Csr(np.arange(len(g) + 1), g, n) for g in (a_group, b_group)]
    rows, cols, _ = gustavson(one[0], transposed(one[1]))
    return rows, cols


class Tokenizers:
    """Both libraries, the bytes of their entries, and what a worker remembers of them."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        with open(a_path, encoding="utf-8") as f:
            entries = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for token, at in entries.items():
            self.a_bytes[at] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        #: A piece that goes on after a blank, or holds a line feed, would join stretches; then texts are encoded whole.
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        joined = {y for p in pieces for x, y in zip(p, p[1:]) if classes()[ord(x)] == LETTER}
        self.stops = np.array([ord(c) for c in ".,;:!?" if c not in joined], np.uint32)
        self.blank, self.lead = self.b.piece_to_id("▁"), len(self.b.encode("\n"))
        self.texts = [np.array([[f"{i}{end}" for i in range(len(x))] for end in ends], object)
                      for x, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.ptr = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.counts = np.zeros((0, 2), np.int64)  # groups and links of each stretch
        self.valid = np.zeros(0, bool)
        self.written: list[str] = []

    def learn(self, keys: list[int], stretches: list[str]) -> None:
        """Encode stretches that are new to this worker and align them side by side."""
        got_a = [x.ids for x in self.a.encode_batch(stretches, add_special_tokens=False)]
        # A line feed joins no piece, so what follows it is encoded as inside a text.
        got_b = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in stretches], num_threads=1)
        got_b = [got if s[0] == " " else got[self.lead:] for s, got in zip(stretches, got_b)]
        for i in [i for i, s in enumerate(stretches) if s == " "]:
            got_b[i] = [self.blank]
        valid = self._valid(stretches, got_a, got_b)
        sizes = [np.fromiter(map(len, got), np.int64, len(got)) for got in (got_a, got_b)]
        ids = [np.fromiter(chain.from_iterable(got), np.int64, int(n.sum())) for got, n in zip((got_a, got_b), sizes)]
        a_sizes, b_sizes = self.a_sizes[ids[0]], self.b_sizes[ids[1]]
        owner = np.repeat(np.arange(len(stretches)), sizes[0])
        rows, _, _ = overlaps(a_sizes, b_sizes)
        a_group, b_group = groups(a_sizes, b_sizes)
        n = int(a_group[-1]) + 1 if len(a_group) else 0
        group_owner = owner[np.searchsorted(a_group, np.arange(n))]
        # Tokens with what follows them, A before B in each group.
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        ends = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (a_group, b_group)]
        parts = np.concatenate([table[end.astype(int), x] for table, end, x in zip(self.texts, ends, ids)])[order].tolist()
        at = np.append(0, np.cumsum(sizes[0] + sizes[1])).tolist()
        self.slots.update(zip(keys, range(len(self.written), len(self.written) + len(keys))))
        self.written += ["".join(parts[p:q]) for p, q in zip(at, at[1:])]
        for k in (0, 1):
            self.ids[k] = np.concatenate([self.ids[k], ids[k].astype(np.int32)])
            self.ptr[k] = np.concatenate([self.ptr[k], self.ptr[k][-1] + np.cumsum(sizes[k])])
        counts = [np.bincount(x, minlength=len(stretches)) for x in (group_owner, owner[rows])]
        self.counts = np.concatenate([self.counts, np.column_stack(counts)])
        self.valid = np.concatenate([self.valid, valid])

    def _valid(self, stretches: list[str], got_a: list[list[int]], got_b: list[list[int]]) -> np.ndarray:
        """Whether both vocabularies give back each stretch; the tokens of others are emptied."""
        valid = np.ones(len(stretches), bool)
        data = [s.encode() for s in stretches]
        for got, table in ((got_a, self.a_bytes), (got_b, self.b_bytes)):
            for i, (ids, want) in enumerate(zip(got, data)):
                if b"".join([table[x] for x in ids]) != want:
                    valid[i] = False
        for i in np.flatnonzero(~valid).tolist():
            got_a[i], got_b[i] = [], []
        return valid

    def cut(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of stretches that both vocabularies encode alike in their text and alone.

        Before a blank or line feed after a visible character; after a single line feed before a
        visible character; and between a letter and a stop that no piece of B has behind a letter.
        """
        start = np.zeros(len(codes), bool)
        if self.cuts and len(codes) > 1:
            space, feed = may_be_space()[codes], codes == 0x0A
            start[1:] = ((codes[1:] == 0x20) | feed[1:]) & ~space[:-1]
            start[2:] |= feed[1:-1] & ~space[:-2] & ~space[2:]
            start[1:] |= np.isin(codes[1:], self.stops) & (classes()[codes[:-1]] == LETTER)
        start[offsets[:-1]] = True
        return np.flatnonzero(start)

    def encode(self, values: list[str]) -> dict:
        """Ids, counts and written groups of a block of texts; stretches between blanks and stops are encoded once each."""
        joined, codes, offsets = code_points([" " + v for v in values])
        starts = self.cut(codes, offsets)
        ends = np.append(starts[1:], len(codes)).astype(np.int64)
        hashes = span_hashes(code_values()[codes], starts, ends)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.slots) > MEMORY:
            self.forget()
        names = keys.tolist()
        new = [i for i, k in enumerate(names) if k not in self.slots]
        for low in range(0, len(new), STEP):
            part = new[low:low + STEP]
            self.learn([names[i] for i in part], [joined[starts[first[i]]:ends[first[i]]] for i in part])
        slot = np.array([self.slots[k] for k in names], np.int64)[which]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        bounds = np.searchsorted(owner, np.arange(len(values) + 1))
        usable = np.bincount(owner[~self.valid[slot]], minlength=len(values)) == 0
        usable &= np.array([bool(v) for v in values], bool)
        kept = usable[owner]
        slot, owner = slot[kept], owner[kept]
        out = {"usable": usable}
        for name, ptr, ids in (("a", self.ptr[0], self.ids[0]), ("b", self.ptr[1], self.ids[1])):
            sizes = ptr[slot + 1] - ptr[slot]
            out[name] = ids[ragged(ptr[slot], sizes)]
            out["n_" + name] = np.bincount(owner, weights=sizes, minlength=len(values)).astype(np.int64)
        for k, name in enumerate(("n_groups", "n_links")):
            out[name] = np.bincount(owner, weights=self.counts[slot, k], minlength=len(values)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(values) + 1)).tolist()
        slot = slot.tolist()
        out["groups"] = ["".join([self.written[s] for s in slot[p:q]])[:-1] for p, q in zip(bounds, bounds[1:])]
        return out


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, others from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


@functools.cache
def may_be_space() -> np.ndarray:
    """Code points that some library may take for white space; after them no stretch is cut."""
    odd = np.array([unicodedata.category(chr(c))[0] in "ZC" for c in range(0x110000)])
    return odd | (classes() == SPACE)


@dataclass
class Sizes:
    """Bytes of every entry of both vocabularies: all that the products need."""

    a_sizes: np.ndarray
    b_sizes: np.ndarray


def sizes_of(a_path: str, b_path: str) -> Sizes:
    both = tokenizers(a_path, b_path)
    return Sizes(both.a_sizes, both.b_sizes)


@functools.lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def encode(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", packed: bool = False) -> DataFrame:
    """``doc_id``, ``a_ids``, ``b_ids``, the four counts and ``groups_sha256`` of every whole text; one pass, no shuffle.

    ``packed`` gives ids as the bytes of little-endian 16-bit numbers (32-bit ones for larger vocabularies).
    """
    def kernel(block: pa.RecordBatch) -> pa.RecordBatch:
        known = tokenizers(a_path, b_path)
        got = known.encode(block.column("text").fill_null("").to_pylist())
        sha = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(got["groups"], got["n_a"].tolist())]
        ends = {x: np.append(0, np.cumsum(got[f"n_{x}"])) for x in "ab"}
        if packed:
            kinds = {x: _packed_kind(sizes) for x, sizes in zip("ab", (known.a_sizes, known.b_sizes))}
            ids = {f"{x}_ids": _packed(got[x].astype(kinds[x]), ends[x]) for x in "ab"}
        else:
            ids = {f"{x}_ids": lists(pa.array(got[x], pa.int32()), ends[x]) for x in "ab"}
        return batch(doc_id=block.column("doc_id"), **ids, **{c: pa.array(got[c], pa.int64()) for c in _COUNTS},
                     groups_sha256=pa.array(sha, pa.string()))

    source = texts(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    ids = "binary" if packed else "array<int>"
    return map_blocks(source, kernel, f"doc_id {kind}, a_ids {ids}, b_ids {ids}, {counts}, groups_sha256 string",
                      max_bytes=BLOCK_BYTES)


def _packed_kind(sizes: np.ndarray) -> str:
    return "<u2" if len(sizes) <= 2 ** 16 else "<u4"


def _packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer((ends * ids.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(ids)])


def _ids(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Flat ids of a column that :func:`encode` made, packed or not."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), _packed_kind(sizes)).astype(np.int64)


def _encoded_blocks(batches: Iterator[pa.RecordBatch], both: Sizes) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list]]:
    """(rows, flat A ids, flat B ids, bounds of each) of bounded blocks of encoded documents."""
    for whole in batches:
        sizes = np.cumsum(whole.column("n_a").to_numpy())
        at = 0
        while at < whole.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(int(np.searchsorted(sizes, before + BLOCK_TOKENS, side="right")), at + 1)
            block = whole.slice(at, end - at)
            ids = [_ids(block.column(f"{x}_ids"), n) for x, n in zip("ab", (both.a_sizes, both.b_sizes))]
            bounds = [np.append(0, np.cumsum(block.column(f"n_{x}").to_numpy())) for x in "ab"]
            yield block, *ids, bounds
            at = end


def links(encoded: DataFrame, a_path: str, b_path: str, kind: str = "overlap") -> DataFrame:
    """``doc_id`` and arrays ``a_at``, ``b_at`` of linked token positions of each document.

    ``overlap`` links tokens with a common byte, and adds ``bytes``, their number; ``group`` links all
    tokens of one group.
    """
    ship(encoded.sparkSession)

    both = sizes_of(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, a, b, (a_off, b_off) in _encoded_blocks(batches, both):
            a_sizes, b_sizes = both.a_sizes[a], both.b_sizes[b]
            if kind == "overlap":
                i, j, common = overlaps(a_sizes, b_sizes)
            else:
                i, j = shared_groups(a_sizes, b_sizes)
            doc = np.searchsorted(a_off, i, side="right") - 1
            bounds = np.searchsorted(doc, np.arange(block.num_rows + 1))
            out = {"doc_id": block.column("doc_id"), "a_at": lists(pa.array(i - a_off[doc], pa.int32()), bounds),
                   "b_at": lists(pa.array(j - b_off[doc], pa.int32()), bounds)}
            if kind == "overlap":
                out["bytes"] = lists(pa.array(common, pa.int32()), bounds)
            yield batch(**out)

    id_kind = encoded.schema["doc_id"].dataType.simpleString()
    extra = ", bytes array<int>" if kind == "overlap" else ""
    return encoded.mapInArrow(run, f"doc_id {id_kind}, a_at array<int>, b_at array<int>{extra}")


def _document_pairs(both: Sizes, a: np.ndarray, b: np.ndarray, a_off: np.ndarray):
    """(A id << 32 | B id, number of the key's links, document) of the distinct linked id pairs of each document."""
    i, j, _ = overlaps(both.a_sizes[a], both.b_sizes[b])
    doc = np.searchsorted(a_off, i, side="right") - 1
    keys, which = np.unique(a[i] << 32 | b[j], return_inverse=True)
    each, n = np.unique(doc * len(keys) + which, return_counts=True)
    doc, at = np.divmod(each, max(len(keys), 1))
    return keys, at, n, doc


def pair_counts(encoded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair`` (A id << 32 | B id), ``n``: how many documents hold the pair linked."""
    both = sizes_of(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers.cache_clear()  # what the worker remembers of the texts is of no more use
        for _, a, b, (a_off, _) in _encoded_blocks(batches, both):
            keys, at, _, _ = _document_pairs(both, a, b, a_off)
            yield batch(pair=pa.array(keys, pa.int64()), n=pa.array(np.bincount(at, minlength=len(keys)), pa.int64()))

    ship(encoded.sparkSession)
    found = encoded.select("a_ids", "b_ids", "n_a", "n_b").mapInArrow(run, "pair bigint, n bigint")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def alignment(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """How the tokens of two tokenizers lie on each other in every whole text.

    A is a byte-level vocabulary of the ``tokenizers`` library, B a ``sentencepiece`` model. Links are the
    nonzero cells of the product of the token-byte matrix of A with that of B transposed, made row by row
    for a block of documents. Documents are encoded once and written; the pairs' document counts are
    summed map-side, the most frequent 2^20 pairs at most go to every task, rarer ones are joined.

    Returns ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is in as many documents as
    the most widespread pair of that A id), ``count_sum`` (document counts summed over links),
    ``groups_sha256``. Null or empty text, or one that either vocabulary does not give back byte for byte:
    no tokens, zeros, an empty digest. Very long texts: whole. Repeated rows: each counts as a document. Null ids: kept.
    Other columns are not read. Empty table: empty result.
    """
    both = sizes_of(a_path, b_path)
    rows = encode(docs, a_path, b_path, key, text, packed=True).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "encoded")
    counted = materialize(pair_counts(rows, a_path, b_path), "pairs")
    a_id = F.shiftright("pair", 32)
    top = counted.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))  # no more rows than A has entries
    pairs = counted.join(F.broadcast(top), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    pairs = materialize(pairs, "counted")
    cut = frequent(pairs)
    head = shared(rows.sparkSession, table(pairs.filter(F.col("n") >= cut)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = head.value
        for block, a, b, (a_off, _) in _encoded_blocks(batches, both):
            keys, at, n, doc = _document_pairs(both, a, b, a_off)
            place = np.minimum(np.searchsorted(known["pair"], keys), max(len(known["pair"]) - 1, 0))
            hit = known["pair"][place] == keys if len(known["pair"]) else np.zeros(len(keys), bool)
            count, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            count[hit], best[hit] = known["n"][place[hit]], known["best"][place[hit]]
            sums = [np.bincount(doc, weights=n * value[at], minlength=block.num_rows).astype(np.int64) for value in (count, best)]
            rare = ~hit[at]
            bounds = np.searchsorted(doc[rare], np.arange(block.num_rows + 1))
            yield batch(row=block.column("row"), head_sum=pa.array(sums[0], pa.int64()), head_best=pa.array(sums[1], pa.int64()),
                        pairs=lists(pa.array(keys[at[rare]], pa.int64()), bounds), times=lists(pa.array(n[rare], pa.int64()), bounds))

    narrow = rows.select("row", "a_ids", "b_ids", "n_a", "n_b")
    sums = materialize(narrow.mapInArrow(run, "row bigint, head_sum bigint, head_best bigint, pairs array<bigint>, "
                                         "times array<bigint>"), "sums")
    rare = sums.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
        .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("k"))
    tail = rare.join(pairs.filter(F.col("n") < cut), "pair").groupBy("row") \
        .agg(F.sum(F.col("k") * F.col("n")).alias("sum"), F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("best"))
    out = rows.drop("a_ids", "b_ids").join(sums.drop("pairs", "times"), "row").join(tail, "row", "left")
    return out.select("doc_id", *_COUNTS, (F.col("head_best") + F.coalesce("best", F.lit(0))).cast("bigint").alias("n_best"),
                      (F.col("head_sum") + F.coalesce("sum", F.lit(0))).cast("bigint").alias("count_sum"), "groups_sha256")
