"""Byte-level BPE encoding and decoding with numpy matrices.

The distinct pieces of a slice of documents are bucketed by byte length and padded into
matrices of token ids. Every round, each row merges its leftmost pair of minimum rank:
ranks come from an open-addressing hash table over all mergeable pairs, merged rows are
compacted by one column, and rows without a mergeable pair leave the matrix. Pieces longer
than ``LONG_PIECE`` bytes merge through a heap instead, where a round per merge would be
quadratic; both give the same ids.

Defined cases: null text is empty and has no tokens; text that the vocabulary holds whole
is one token; repeated rows are kept; an empty table gives an empty result; columns other
than ``doc_id, text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .arrow import map_slices, ranges

LONG_PIECE = 1024
CELLS = 1 << 17                 # cells of a matrix of token ids; a merge round holds about ten arrays of its size
NONE = np.int64(1 << 40)        # rank of a pair that does not merge
PAD = -1


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id of their merge."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int64)
        left, self.probes = np.arange(len(keys)), 0
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            first = np.unique(slot[free], return_index=True)[1]
            take = np.flatnonzero(free)[first]
            self.keys[slot[take]] = keys[left[take]]
            self.values[slot[take]] = values[left[take]]
            rest = np.ones(len(left), dtype=bool)
            rest[take] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def as_dict(self) -> dict[int, int]:
        """All pairs, by ``a << 32 | b``."""
        used = self.keys != -1
        return dict(zip(self.keys[used].tolist(), self.values[used].tolist()))

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair (its rank), NONE where the pair does not merge or is padding."""
        keys = a.astype(np.int64) << 32 | (b.astype(np.int64) & 0xFFFFFFFF)
        out = np.full(keys.shape, NONE, dtype=np.int64)
        todo = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        flat, res = keys.ravel(), out.ravel()
        slot = self._slot(flat[todo])
        for _ in range(self.probes + 1):
            if not len(todo):
                break
            found = self.keys[slot]
            hit = found == flat[todo]
            res[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found != -1)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return res.reshape(keys.shape)


class Codec:
    """Encoder and decoder of one rank file."""

    _loaded: dict[tuple[str, str], "Codec"] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> "Codec":
        """One codec per worker process and file."""
        if (path, pattern) not in cls._loaded:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            cls._loaded[path, pattern] = cls(ranks, pattern)
        return cls._loaded[path, pattern]

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # White space is the Unicode property, which leaves out the ASCII separators U+001C to U+001F.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.pairs = PairTable(np.array(keys, dtype=np.int64), np.array(values, dtype=np.int64))
        self.pair_dict = None
        size = max(ranks.values()) + 1
        self.token_len = np.zeros(size, dtype=np.int64)
        for token, rank in ranks.items():
            self.token_len[rank] = len(token)
        self.token_start = np.cumsum(self.token_len) - self.token_len
        flat = bytearray(int(self.token_len.sum()))
        for token, rank in ranks.items():
            flat[self.token_start[rank]:self.token_start[rank] + len(token)] = token
        self.token_bytes = np.frombuffer(bytes(flat), dtype=np.uint8)

    def merge_matrix(self, ids: np.ndarray) -> list[np.ndarray]:
        """Merge every row of a padded id matrix to the end; returns the ids of each row."""
        done: list[np.ndarray | None] = [None] * len(ids)
        rows = np.arange(len(ids))
        rank = self.pairs.get(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)            # the first minimum: the leftmost pair
            best = rank[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                for r in np.flatnonzero(over):
                    done[rows[r]] = ids[r][ids[r] != PAD]
                on = ~over
                rows, ids, rank, at, best = rows[on], ids[on], rank[on], at[on], best[on]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            width = ids.shape[1]
            cols = np.arange(width - 1)
            ids[line, at] = best
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            if width == 2:
                for r in line:
                    done[rows[r]] = ids[r][ids[r] != PAD]
                break
            cols = cols[:-1]
            rank = np.take_along_axis(rank, np.minimum(cols + (cols > at[:, None]), width - 2), axis=1)
            for side in (at - 1, at):           # only the pairs beside the merge have changed
                ok = (side >= 0) & (side < width - 2)
                rank[line[ok], side[ok]] = self.pairs.get(ids[line[ok], side[ok]], ids[line[ok], side[ok] + 1])
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of pairs over a linked list of tokens."""
        if self.pair_dict is None:
            self.pair_dict = self.pairs.as_dict()
        tok = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(tok)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pair_dict.get
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := get(tok[i] << 32 | tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = r, PAD
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (s := get(r << 32 | tok[after[i]])) is not None:
                    heapq.heappush(heap, (s, i, r, tok[after[i]]))
            if before[i] >= 0 and (s := get(tok[before[i]] << 32 | r)) is not None:
                heapq.heappush(heap, (s, before[i], tok[before[i]], r))
        return np.array([t for t in tok if t != PAD], dtype=np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and the number of ids of each piece."""
        out: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], dtype=np.int64)
            elif len(p) > LONG_PIECE:
                out[i] = self.merge_long(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for bits, members in buckets.items():
            step = max(1, CELLS >> bits)
            for k in range(0, len(members), step):
                part = members[k:k + step]
                n = np.array([len(pieces[i]) for i in part])
                raw = np.frombuffer(b"".join(pieces[i] for i in part), dtype=np.uint8)
                ids = np.full((len(part), int(n.max())), PAD, dtype=np.int64)
                ids[np.repeat(np.arange(len(part)), n), ranges(np.zeros(len(n), dtype=np.int64), n)] = self.byte_id[raw]
                for i, row in zip(part, self.merge_matrix(ids)):
                    out[i] = row
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(out), np.array([len(x) for x in out], dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        known: dict[str, int] = {}
        codes, counts = [], []
        for t in texts:
            found = self.pattern.findall(t) if t else []
            counts.append(len(found))
            codes.extend([known.setdefault(p, len(known)) for p in found])
        flat, n = self.encode_pieces([p.encode("utf-8") for p in known])
        code = np.array(codes, dtype=np.int64)
        starts, lens = np.cumsum(n) - n, (n[code] if len(code) else np.zeros(0, dtype=np.int64))
        ids = flat[ranges(starts[code], lens)] if len(code) else np.zeros(0, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(lens)])
        ends = upto[np.cumsum(np.array(counts, dtype=np.int64))] if counts else np.zeros(0, dtype=np.int64)
        return ids, np.diff(np.concatenate([[0], ends]))

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Bytes of each text from the ids of all texts."""
        lens = self.token_len[ids]
        raw = self.token_bytes[ranges(self.token_start[ids], lens)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lens)])[np.cumsum(n)]
        starts = np.concatenate([[0], ends[:-1]])
        return [raw[a:b] for a, b in zip(starts, ends)]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (array of int) of every text."""

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, n = Codec.load(path, pattern).encode(b.column("text").to_pylist())
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), arrays], ["doc_id", "n_tokens", "ids"])

    return map_slices(docs.select("doc_id", "text"), step, "doc_id long, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes`` of every row of ids."""

    def run(batches):
        for b in batches:
            lists = b.column("ids")
            n = np.array([0 if x is None else len(x) for x in lists], dtype=np.int64)
            out = Codec.load(path, pattern).decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), n)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Round trip of every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    def step(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.load(path, pattern)
        ids, n = codec.encode(b.column("text").to_pylist())
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(n) * 4
        one = [hashlib.sha256(raw[e - 4 * k:e]).hexdigest() for e, k in zip(ends, n)]
        two = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, n)]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(one, pa.string()), pa.array(two, pa.string())],
                                          ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_slices(docs.select("doc_id", "text"), step,
                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
