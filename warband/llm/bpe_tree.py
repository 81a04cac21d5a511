"""Byte-level BPE encoding and decoding by tree reduction over a rank file.

Encoded stretches form a monoid: the encoding of ``x + y`` follows from the encodings of ``x`` and ``y``
alone. A word longer than a leaf is cut in halves, both are encoded recursively, and two neighbours are
joined at their border: if the last token on the left and the first on the right stay apart, the joined
encoding is the two in a row; else a window around the border is encoded anew, and it grows on each side
whose outermost new token does not stay apart from the old token before it (or after it).

Why this is exact: two tokens stay apart when merging the bytes of the two gives just them. Take a token
sequence whose neighbours all stay apart, and suppose that merging its bytes joined parts of two neighbours
at some step, for the first time. Until then no merge crossed a border, so the merges inside these two
tokens came in the same order as in the pair alone (both choose by rank, then from the left), and the pair
would have been joined as well. So no border is ever crossed and the sequence is the encoding. Pairs inside
the old stretches and inside the new window come from encodings, so only the window's two outer borders
need to be looked at.

Decoding gathers the bytes of runs of ids and joins neighbouring runs up a tree.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

LEAF = 32                   # bytes of a leaf, encoded by plain merging
QUEUE_FROM = 256            # bytes from which merging keeps its pairs in a queue
NEVER = 1 << 60
DECODE_LEAF = 1 << 14       # ids decoded at once
WORD_BYTES = 48             # longer words are not remembered, so a worker's table is bounded in bytes too
MAX_WORDS = 200_000
MAX_PAIRS = 400_000


class TreeEncoder:
    """Encoding and decoding for one rank file (base64 token and rank per line) and one word pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"{path}: no token for the bytes {missing}")
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.sizes, self.starts = sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.findall = regex.compile(pattern).findall
        self.packed = _Packed(self)
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Plain merging: the adjacent pair of lowest rank, leftmost first, until none can be merged."""
        if len(data) >= QUEUE_FROM:
            return self._merged_by_queue(data)
        n, rank = len(data), self.ranks.get
        cuts = list(range(n + 1))                                   # parts are data[cuts[i]:cuts[i + 1]]
        ranks = [rank(data[i:i + 2], NEVER) for i in range(n - 1)]  # of each part with the next
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            del ranks[i], cuts[i + 1]
            if i:
                ranks[i - 1] = rank(data[cuts[i - 1]:cuts[i + 1]], NEVER)
            if i < len(ranks):
                ranks[i] = rank(data[cuts[i]:cuts[i + 2]], NEVER)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merged_by_queue(self, data: bytes) -> list[int]:
        """The same for long stretches: pairs wait in a queue by (rank, position), parts are linked."""
        n, get = len(data), self.ranks.get
        parts: list = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
        heapify(queue)
        while queue:
            _, i, size = heappop(queue)
            j = after[i]
            if parts[i] is None or j == n or len(parts[i]) + len(parts[j]) != size:
                continue         # one of the two has been merged otherwise since
            parts[i], parts[j] = parts[i] + parts[j], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (r := get(parts[x] + parts[y])) is not None:
                    heappush(queue, (r, x, len(parts[x]) + len(parts[y])))
        return [self.ranks[p] for p in parts if p is not None]

    def apart(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` followed by those of ``b`` are encoded as just these two tokens."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the two stretches in a row."""
        if not left or not right or self.apart(left[-1], right[0]):
            return left + right
        a, b = 1, 1              # tokens of the window on each side
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            data = b"".join([self.tokens[t] for t in left[len(left) - a:]] + [self.tokens[t] for t in right[:b]])
            window = self.merged(data)
            calm_left = a == len(left) or self.apart(left[-a - 1], window[0])
            calm_right = b == len(right) or self.apart(window[-1], right[b])
            if calm_left and calm_right:
                return left[:len(left) - a] + window + right[b:]
            a, b = a * (1 if calm_left else 2), b * (1 if calm_right else 2)

    def tree(self, data: bytes) -> list[int]:
        """The encoding of one stretch of bytes."""
        if len(data) <= LEAF:
            return self.merged(data)
        half = LEAF << ((len(data) - 1) // LEAF).bit_length() - 1    # so runs of one letter settle where halves meet
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def word(self, word: str) -> bytes:
        """Ids of one match of the pattern, as little-endian 32-bit integers. A match that is a token is that token."""
        data = word.encode()
        whole = self.ranks.get(data)
        return np.array([whole] if whole is not None else self.tree(data), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers."""
        if len(self.packed) > MAX_WORDS:
            self.packed.clear()
        return b"".join(map(self.packed.__getitem__, self.findall(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids."""
        runs = [self._gather(ids[i:i + DECODE_LEAF]) for i in range(0, len(ids), DECODE_LEAF)] or [b""]
        while len(runs) > 1:
            runs = [b"".join(runs[i:i + 2]) for i in range(0, len(runs), 2)]
        return runs[0]

    def _gather(self, ids: np.ndarray) -> bytes:
        size = self.sizes[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + size, size)
        return self.flat[at].tobytes()


class _Packed(dict):
    """Word → packed ids."""

    def __init__(self, encoder: TreeEncoder):
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.word(word)
        if len(word) <= WORD_BYTES:
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> TreeEncoder:
    return TreeEncoder(path, pattern)


def encode_texts(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Per row: ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the bytes that decoding the ids gives); with ``with_ids`` also ``ids``.

    Each match of ``pattern`` is encoded by itself; there are no special tokens. No shuffle: memory is
    bounded by one Arrow batch and the word and pair tables (``MAX_WORDS`` words of ``WORD_BYTES`` letters,
    ``MAX_PAIRS`` pairs; a full table is emptied, which changes no result). A match of any length is encoded
    in time proportional to it where borders settle. Null and empty texts give no tokens and the digest of
    no bytes. Repeated rows, null ids included, give one row each. Extra columns are not read, whatever
    their names. An empty table gives an empty result. ``ranks`` must be readable on every executor.
    """
    fields = [("id", docs.schema[id_col].dataType.simpleString()), ("n_tokens", "bigint"), ("ids_sha256", "string"),
              ("decoded_sha256", "string")] + [("ids", "array<bigint>")] * with_ids

    def run(batches):
        encoder = encoder_of(ranks, pattern)
        for b in batches:
            rows: list[list] = [[] for _ in fields[1:]]
            for i in range(b.num_rows):
                packed = encoder.encode(b.column(1)[i].as_py() or "")
                ids = np.frombuffer(packed, "<u4").astype(np.int64)
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(packed).hexdigest())
                rows[2].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    rows[3].append(ids)
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(r, t) for r, t in zip(rows, types)],
                                             names=[f for f, _ in fields])

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, ", ".join(f"`{n}` {t}" for n, t in fields))
    return out.withColumnRenamed("id", id_col)
