"""SentencePiece encoding and decoding by suffix-array matching (BPE models with byte fallback).

Encoding a batch of texts:

1. Each text gets the dummy prefix, spaces become ``▁``, and it is cut into chunks where no piece
   crosses: before a ``▁`` that follows another character, and around line feeds. The batch's
   distinct unseen chunks are concatenated.
2. The concatenation is indexed by a suffix array (prefix doubling up to the longest piece).
   Every piece of the vocabulary is binary-searched in it; its range of suffixes is the list of its
   occurrences, each an edge (start, end, piece). Characters that are no piece get an edge of their
   own and are written as byte pieces later.
3. The edges are sorted by the position where they end and relaxed in that order, all chunks side by
   side. A chunk prefix has exactly one edge that ends it and stays apart, under the merge rules,
   from the last piece of what precedes it (see ``bpe``); that edge is the prefix's last piece.

Going back from each chunk's end gives its pieces: the same ids as the merge tokenizer's.
Decoding concatenates the pieces' bytes, turns ``▁`` into spaces and drops the dummy prefix.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from warband.llm.bpe import NEVER, Spines, merge_once

SPACE = "▁"
CHUNK = re.compile("▁+[^▁\n]*|[^▁\n]+|\n")
MAX_CHUNKS = 150_000        # chunks remembered per worker; beyond it the memory is emptied and filled anew
ROWS_PER_BATCH = 500        # texts taken together by one suffix array
_UNKNOWN, _CONTROL, _BYTE = 2, 3, 6   # piece types of the model format


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` ordered by their first ``depth`` symbols at least (prefix doubling)."""
    n = len(codes)
    rank, k = codes.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while k < depth:
        nxt = np.zeros(n, np.int64)
        nxt[:-k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        k *= 2
    return order


def occurrence_ranges(codes: np.ndarray, order: np.ndarray, pieces: np.ndarray, lengths: np.ndarray):
    """Binary search of all ``pieces`` (rows of codes, zero-padded) at once: for each the half-open range
    of ``order`` whose suffixes begin with it."""
    padded = np.r_[codes, np.zeros(pieces.shape[1], codes.dtype)]

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(pieces), np.int64), np.full(len(pieces), len(order), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, len(order) - 1)]
            sign = np.zeros(len(pieces), np.int8)          # suffix against piece: -1, 0 (prefix equal), 1
            for d in range(pieces.shape[1]):
                undecided = (sign == 0) & (d < lengths)
                if not undecided.any():
                    break
                a, b = padded[at + d], pieces[:, d]
                sign = np.where(undecided, np.sign(a.astype(np.int64) - b), sign)
            right = open_ & ((sign < 0) | (upper & (sign == 0)))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        return lo

    return bound(False), bound(True)


class PairTable:
    """Vectorized, remembered answers to "do tokens a and b stay apart?"."""

    def __init__(self, spines: Spines, index: dict, pair_rank: dict, size: int):
        self.size = size
        side = lambda store: self._matrix(store, index, size)
        self.right, self.right_dies = side(spines.right)
        self.left, self.left_dies = side(spines.left)
        keys = np.array([index[a] * size + index[b] for a, b in pair_rank], np.int64)
        vals = np.array(list(pair_rank.values()), np.int64)
        by = np.argsort(keys)
        self.keys, self.vals = keys[by], vals[by]
        self.known, self.known_ok = np.empty(0, np.int64), np.empty(0, bool)

    @staticmethod
    def _matrix(store: dict, index: dict, size: int):
        width = max(map(len, store.values()))
        parts, dies = np.full((size, width), -1, np.int64), np.zeros((size, width), np.int64)
        for t, spine in store.items():
            for d, (x, r) in enumerate(spine):
                parts[index[t], d], dies[index[t], d] = index[x], r
        return parts, dies

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.known, key)
        seen = np.zeros(len(key), bool)
        inside = at < len(self.known)
        seen[inside] = self.known[at[inside]] == key[inside]
        out = np.zeros(len(key), bool)
        out[seen] = self.known_ok[at[seen]]
        if not seen.all():
            new, back = np.unique(key[~seen], return_inverse=True)
            ok = self._decide(new // self.size, new % self.size)
            out[~seen] = ok[back]
            if len(self.known) > 4_000_000:
                self.known, self.known_ok = new, ok
            else:
                keys = np.r_[self.known, new]
                by = np.argsort(keys, kind="stable")
                self.known, self.known_ok = keys[by], np.r_[self.known_ok, ok][by]
        return out

    def _decide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), bool)
        for i in range(self.right.shape[1]):
            rows = np.flatnonzero(ok & (self.right[a, i] >= 0))
            if not len(rows):
                break
            for j in range(self.left.shape[1]):
                rows = rows[ok[rows] & (self.left[b[rows], j] >= 0)]
                if not len(rows):
                    break
                x, y = self.right[a[rows], i], self.left[b[rows], j]
                key = x * self.size + y
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[at] == key, self.vals[at], NEVER)
                torn = (rank < self.right_dies[a[rows], i]) & (rank <= self.left_dies[b[rows], j])
                ok[rows[torn]] = False
        return ok


def relax(n: int, start: np.ndarray, end: np.ndarray, token: np.ndarray, depth: np.ndarray, first: np.ndarray,
          pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Last token and its start for every position of the concatenated chunks.

    Edges (``start``, ``end``, ``token``) are taken in order of ``depth``, the end's distance from its
    chunk's first position; ``first`` marks edges that start a chunk.
    """
    by = np.argsort(depth, kind="stable")
    start, end, token, first = start[by], end[by], token[by], first[by]
    bounds = np.flatnonzero(np.diff(depth[by], prepend=-1, append=-1))
    last, begin = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        s, e, t = start[lo:hi], end[lo:hi], token[lo:hi]
        ok = first[lo:hi].copy()
        rest = np.flatnonzero(~ok & (last[s] >= 0))
        ok[rest] = pairs.apart(last[s[rest]], t[rest])
        last[e[ok]], begin[e[ok]] = t[ok], s[ok]
    return last, begin


class Encoder:
    """One model's tables and the chunks already encoded by this worker."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2 or model.normalizer_spec.name != "identity":
            raise ValueError("a BPE model with the identity normalizer is needed")
        self.prefix = model.normalizer_spec.add_dummy_prefix
        plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type not in (_UNKNOWN, _CONTROL, _BYTE)}
        self.byte_ids = np.array([i for i, p in enumerate(model.pieces) if p.type == _BYTE], np.int32)
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        rank = {t: -model.pieces[i].score for t, i in plain.items()}
        order = {r: k for k, r in enumerate(sorted(set(rank.values())))}
        rank = {t: order[r] for t, r in rank.items()}
        split, pair_rank = {}, {}
        of = lambda a, b: rank.get(a + b)
        for t in plain:
            if len(t) > 1:
                for k in range(1, len(t)):
                    if t[:k] in plain and t[k:] in plain:
                        pair_rank[(t[:k], t[k:])] = rank[t]
                split[t] = self._last_merge(t, of)
        # an entry that its own merges do not rebuild never appears in an encoding
        self.usable = {t: i for t, i in plain.items() if len(t) == 1 or split[t]}
        split = {t: s for t, s in split.items() if s}
        spines = Spines(split, {t: rank[t] for t in self.usable})
        spines.right[""] = spines.left[""] = [("", NEVER)]      # an unknown character merges with nothing
        index = dict(self.usable) | {"": self.unknown}
        ok = set(index)
        self.pairs = PairTable(spines, index, {p: r for p, r in pair_rank.items() if p[0] in ok and p[1] in ok}, len(model.pieces))
        self.alphabet = np.array(sorted({ord(c) for t in self.usable for c in t}), np.uint32)
        names = list(self.usable)
        self.piece_ids = np.array([self.usable[t] for t in names], np.int64)
        self.piece_len = np.array([len(t) for t in names], np.int64)
        self.depth = int(self.piece_len.max())
        self.piece_codes = np.zeros((len(names), self.depth), np.int64)
        for k, t in enumerate(names):
            self.piece_codes[k, :len(t)] = self._codes(np.array([ord(c) for c in t], np.uint32))
        single = np.zeros(len(self.alphabet) + 2, bool)
        single[self._codes(np.array([ord(t) for t in names if len(t) == 1], np.uint32))] = True
        self.single = single
        raw = [bytes([int(p.piece[1:-1], 16)]) if p.type == _BYTE else p.piece.replace(SPACE, " ").encode()
               for p in model.pieces]
        for i, p in enumerate(model.pieces):
            if p.type in (_UNKNOWN, _CONTROL):
                raw[i] = b""
        self.raw_at = np.r_[0, np.cumsum([len(r) for r in raw])]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.forget()

    @staticmethod
    def _last_merge(t: str, of):
        """(left, right) of the merge that completes ``t``, or None if its merges do not rebuild it."""
        parts = list(t)
        while len(parts) > 2:
            ranks = [(r, i) for i in range(len(parts) - 1) if (r := of(parts[i], parts[i + 1])) is not None]
            if not ranks:
                return None
            _, i = min(ranks)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(parts)

    def _codes(self, points: np.ndarray) -> np.ndarray:
        """Dense codes: 0 is kept for chunk ends, 1 for characters of no piece."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 2, 1).astype(np.int64)

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.ids, self.at = np.empty(0, np.int32), np.zeros(1, np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Encode distinct chunks and remember their ids."""
        if not chunks:
            return
        points = np.frombuffer("\0".join([*chunks, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        begins = np.cumsum(sizes + 1) - sizes - 1
        codes = self._codes(points)
        codes[begins + sizes] = 0
        order = suffix_array(codes, self.depth)
        lo, hi = occurrence_ranges(codes, order, self.piece_codes, self.piece_len)
        found = hi - lo
        which = np.repeat(np.arange(len(lo)), found)
        start = order[np.repeat(lo - np.cumsum(found) + found, found) + np.arange(found.sum())]
        token, end = self.piece_ids[which], start + self.piece_len[which]
        lone = np.flatnonzero((codes > 0) & ~self.single[codes])
        start, end = np.r_[start, lone], np.r_[end, lone + 1]
        token = np.r_[token, np.full(len(lone), self.unknown)]
        offset = np.arange(len(codes)) - np.repeat(begins, sizes + 1)     # position inside the chunk
        last, begin = relax(len(codes), start, end, token, offset[end], offset[start] == 0, self.pairs)
        on_path = np.zeros(len(codes) + 1, bool)
        at = (begins + sizes)[sizes > 0]
        stop = begins[sizes > 0]
        while len(at):
            on_path[at] = True
            at = begin[at]
            more = at > stop
            at, stop = at[more], stop[more]
        ends = np.flatnonzero(on_path)
        ids = last[ends].astype(np.int32)
        owner = np.searchsorted(begins, ends - 1, side="right") - 1
        strange = np.flatnonzero(ids == self.unknown)
        if len(strange):                                                  # byte fallback
            spelled = [chr(p).encode("utf-8", "surrogatepass") for p in points[ends[strange] - 1]]
            times = np.ones(len(ids), np.int64)
            times[strange] = list(map(len, spelled))
            ids, owner = np.repeat(ids, times), np.repeat(owner, times)
            ids[ids == self.unknown] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        counts = np.bincount(owner, minlength=len(chunks))
        for c in chunks:
            self.seen[c] = len(self.seen)
        self.at = np.r_[self.at, self.at[-1] + np.cumsum(counts)]
        self.ids = np.r_[self.ids, ids]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of each text's ids."""
        if len(self.seen) > MAX_CHUNKS:
            self.forget()
        cut, per_text = [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                found = CHUNK.findall((SPACE if self.prefix else "") + t.replace(" ", SPACE))
                per_text[k] = len(found)
                cut += found
        self.learn([c for c in dict.fromkeys(cut) if c not in self.seen])
        which = np.fromiter(map(self.seen.__getitem__, cut), np.int64, len(cut))
        lens = self.at[which + 1] - self.at[which]
        total = np.cumsum(lens)
        ids = self.ids[np.repeat(self.at[which] - total + lens, lens) + np.arange(total[-1] if len(total) else 0)]
        ends = np.r_[0, total][np.r_[0, np.cumsum(per_text)]]
        return ids, ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of consecutive id runs (run k is ``ids[ends[k]:ends[k + 1]]``)."""
        lens = self.raw_at[ids + 1] - self.raw_at[ids]
        total = np.cumsum(lens)
        data = self.raw[np.repeat(self.raw_at[ids] - total + lens, lens) + np.arange(total[-1] if len(total) else 0)].tobytes()
        cuts = np.r_[0, total][ends]
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            t = data[a:b].decode("utf-8", "replace")
            out.append(t[1:] if self.prefix and t.startswith(" ") else t)
        return out


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id column, ``token_ids`` (array<int>), ``n_tokens`` and ``round_trip`` (decoding the
    ids gives the text back; a text that itself holds ``▁`` decodes to spaces there, as the format has it).

    No shuffle. Null and empty texts give an empty array and ``round_trip`` true. Repeated rows give one
    row each; other columns are not read, whatever their names; an empty table gives an empty result.
    Memory is bounded by one batch of texts and the worker's chunk memory. ``model`` must be readable
    on every executor.
    """
    schema = f"`id` {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, round_trip boolean, token_ids array<int>"

    def run(batches):
        enc = encoder_of(model)
        for big in batches:
            for lo in range(0, big.num_rows, ROWS_PER_BATCH):
                b = big.slice(lo, ROWS_PER_BATCH)
                texts = [t or "" for t in b.column(1).to_pylist()]
                ids, ends = enc.encode(texts)
                same = [a == t for a, t in zip(enc.decode(ids, ends), texts)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.diff(ends)), pa.array(same, pa.bool_()),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))],
                    names=["id", "n_tokens", "round_trip", "token_ids"])

    return (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, schema)
            .select(F.col("id").alias(id_col), "n_tokens", "token_ids", "round_trip"))
