"""Byte-level BPE in numpy: length-bucketed matrices, one merge per row and round."""

from __future__ import annotations

import base64
import functools
import heapq

import numpy as np

from corvane.llm.kernels import mix

MISS = np.int32(2 ** 31 - 1)
_EMPTY = np.uint64(2 ** 64 - 1)
#: Longest piece merged in matrices, whose cost grows with the square of the length.
MATRIX_BYTES = 1024
_CELLS = 4 * 2 ** 20


class Vocabulary:
    """Ranks of a byte-pair vocabulary, with a hash table over the pairs that merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        merged = np.fromiter(pairs.values(), np.int32, len(pairs))
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self._mask = np.uint64(size - 1)
        self._keys, self._merged = np.full(size, _EMPTY), np.full(size, MISS, np.int32)
        slot = mix(keys) & self._mask
        while len(keys):  # the first key of each free slot stays there, the others go one slot on
            free = self._keys[slot] == _EMPTY
            _, won = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[won]
            self._keys[slot[won]], self._merged[slot[won]] = keys[won], merged[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, merged, slot = keys[rest], merged[rest], (slot[rest] + np.uint64(1)) & self._mask

    def merge_ids(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, ``MISS`` where the pair does not merge or an id is negative."""
        real = (left >= 0) & (right >= 0)
        out = np.full(left.shape, MISS, np.int32)
        keys = left[real].astype(np.uint64) << np.uint64(32) | right[real].astype(np.uint64)
        found = np.full(len(keys), MISS, np.int32)
        slot, open_ = mix(keys) & self._mask, np.arange(len(keys))
        while len(open_):
            there = self._keys[slot]
            hit = there == keys[open_]
            found[open_[hit]] = self._merged[slot[hit]]
            on = ~hit & (there != _EMPTY)
            open_, slot = open_[on], (slot[on] + np.uint64(1)) & self._mask
        out[real] = found
        return out

    def _merge_rows(self, ids: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of a matrix padded with -1: per round each row merges its leftmost pair of least rank."""
        out: list[np.ndarray] = [None] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.merge_ids(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.full((len(ids), 0), MISS)
        while len(rows):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
            else:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), MISS)
            done = best == MISS
            if done.any():  # finished rows leave the matrix
                for i in np.flatnonzero(done):
                    out[rows[i]] = ids[i][ids[i] >= 0]
                live = ~done
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
                width = int((ids >= 0).sum(axis=1).max())
                ids, ranks = ids[:, :width], ranks[:, :width - 1]
            each = np.arange(len(rows))
            ids[each, at] = best
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols >= at[:, None] + 1), axis=1)
            cols = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None] + 1), axis=1)
            for side in (at - 1, at):  # only the two pairs beside the new symbol have changed
                ok = (side >= 0) & (side < ranks.shape[1])
                r, c = each[ok], side[ok]
                ranks[r, c] = self.merge_ids(ids[r, c], ids[r, c + 1])
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, with a heap of pairs over linked symbols."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].astype(np.int64)
        n = len(ids)
        first = self.merge_ids(ids[:-1], ids[1:])
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != MISS).tolist()]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            rank = self.pairs.get(ids[i] << 32 | ids[j]) if j < n else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece. A piece that is itself a token is that token; an empty one has no ids."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        left: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > MATRIX_BYTES:
                out[i] = self._merge_long(piece)
            elif piece:
                left.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, members in left.items():
            width = 1 << bits
            step = max(1, _CELLS // width)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                lengths = np.array([len(pieces[i]) for i in part])
                raw = np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width) < lengths[:, None]] = self.byte_ids[raw]
                for i, got in zip(part, self._merge_rows(ids)):
                    out[i] = got
        return out

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids."""
        return b"".join([self.tokens[int(i)] for i in ids])


@functools.lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """Read a file of base64 tokens and ranks, once per worker."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return Vocabulary(ranks)
