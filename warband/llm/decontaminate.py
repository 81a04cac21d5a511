"""Benchmark decontamination by latent semantic retrieval, then longest-common-subsequence and answer checks.

Per block of benchmark items (a block holds a bounded number of items, characters and item windows, so that the rank
of the basis is not below the windows; an item with more windows than that is a block of its own; all blocks are done):

1. Document frequencies of the block's terms over all documents. Terms in more than ``COMMON`` of the
   documents (and more than ``COMMON_DOCS``) are dropped like stop words, but every item keeps its ``KEEP_RAREST`` rarest
   terms. TF-IDF weights.
2. Passages are windows of ``WINDOW`` words, half overlapping, over every whole document. Passages
   without block terms are zero rows of the matrix and need no storing; of the others only positions
   and terms are kept, in a table that the fit reads instead of the texts.
3. Randomised SVD (Halko, Martinsson and Tropp 2011), distributed, of the passages side by side that cover every text. The
   passage matrix enters by products
   AᵀA·Q only, so the sums of its term pairs are taken once, in Spark; each product multiplies the stored pairs in
   tasks and adds up in Spark. One power step follows the sketch, and the small factor gives the latent basis.
   What reaches the driver is terms × rank, whatever the corpus size.
4. Passages and items are projected; pairs with a cosine of ``COSINE`` or more are candidates. So is every
   passage around which the document holds so many of the item's words that step 5 can accept it, by a count that
   needs no basis: of the item's rarest words that make ``COUNTED`` of its length, at least what a
   common subsequence of the accepted length cannot do without. No passage that step 5 accepts fails this count.
5. A candidate is a leak when the longest common subsequence of words of the item and the document
   around the passage covers ``SAME`` of the item, or ``PARAPHRASE`` of it while the item's answer (its last
   sentence) stands in the document word for word. The task that projects a document's passages checks its candidates
   at once, while it holds the text: neither texts nor candidates are shuffled, only leaks are.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.llm.common import row_key
from warband.session import drop_tables, materialize, scratch_scope

WINDOW, STRIDE = 64, 32
COMMON, COMMON_DOCS, KEEP_RAREST = 0.02, 50, 12
MIN_RANK, MAX_RANK, OVERSAMPLE = 128, 512, 16
COSINE, SAME, PARAPHRASE = 0.55, 0.8, 0.6
ANSWER_WORDS = 3
COUNTED = 0.6       # above 1 - PARAPHRASE, so that a leak cannot miss all counted words
BLOCK_CHARS, BLOCK_ITEMS = 8_000_000, 400
BLOCK_WINDOWS = MAX_RANK - MIN_RANK // 2
MARKED_ROWS, MARKED_CHARS = 1_000, 2_000_000     # texts whose marked terms are held at once
PAIRS_AT_ONCE = 1_024        # term pairs whose products are held at once
ROWS_AT_ONCE = 64            # windows whose product is taken together
SPAN = 16           # windows counted together at first
_SLICE = 512
SCORES_AT_ONCE = 1 << 21     # entries of windows' projections or scores held at once
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def spaced(text: str) -> bytes:
    """The lower-cased text in UTF-8 with spaces for all ASCII characters but letters and digits."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED)


def words_of(text: str) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII, in UTF-8."""
    return spaced(text).split()


def term_hits(texts: list[str], terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, position among its words (``words_of``) and index into ``terms`` of every word that is one of them, in order."""
    words = pc.ascii_split_whitespace(pa.array([spaced(t).strip() for t in texts], pa.string()))
    found = pc.index_in(words.values, value_set=terms).fill_null(-1).to_numpy().astype(np.int64)
    at, start = np.flatnonzero(found >= 0), words.offsets.to_numpy().astype(np.int64)
    doc = np.searchsorted(start, at, side="right") - 1
    return doc, at - start[doc], found[at]


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _joined(pos: list[np.ndarray], term: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position, term) arrays of lists that hold an array per document."""
    none = np.zeros(0, np.int64)
    return (np.repeat(np.arange(len(pos)), [len(p) for p in pos]), np.concatenate([none, *pos]).astype(np.int64),
            np.concatenate([none, *term]).astype(np.int64))


def answer_of(text: str) -> list[bytes]:
    """Words of the last sentence, the stretch after the last sentence mark that words precede."""
    for part in reversed(re.split(r"[.!?\n]+", text)):
        if found := words_of(part):
            return found
    return []


def places_of(a: list) -> dict:
    """The places of every word of ``a``, as bits of an integer."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    return where


def lcs_length(a: list, b: list) -> int:
    """Length of a longest common subsequence."""
    return _lcs_of_places(len(a), filter(None, map(places_of(a).get, b)))


def _lcs_of_places(n: int, places) -> int:
    """The same for ``n`` words and their places of the other side's words, a row of the table per word in one integer
    (the published bit-vector recurrence)."""
    full = (1 << n) - 1
    row = full
    for m in places:
        u = row & m
        row = (row + u | row - u) & full
    return n - row.bit_count()


def holds(words: list, part: list) -> bool:
    """``part`` stands in ``words`` without a gap."""
    n = len(part)
    return any(words[i] == part[0] and words[i:i + n] == part for i in range(len(words) - n + 1)) if n else False


class Passages:
    """Sparse rows (windows, half overlapping or side by side) of a batch of documents given as term positions."""

    def __init__(self, pos: list[np.ndarray], term: list[np.ndarray], idf: np.ndarray, overlap: bool = True):
        self._fill(*_joined(pos, term), idf, overlap)

    @classmethod
    def of(cls, doc: np.ndarray, p: np.ndarray, t: np.ndarray, idf: np.ndarray, overlap: bool = True) -> Passages:
        """The same from (document, position, term) arrays; terms beyond ``idf`` are only counted and make no passages."""
        self, kept = cls.__new__(cls), t < len(idf)
        self._fill(doc[kept], p[kept], t[kept], idf, overlap)
        return self

    def _fill(self, doc: np.ndarray, p: np.ndarray, t: np.ndarray, idf: np.ndarray, overlap: bool) -> None:
        last = p // STRIDE                              # a word lies in windows last - 1 and last
        win = np.r_[last, last - 1] if overlap else p // WINDOW
        doc, t = (np.r_[doc, doc], np.r_[t, t]) if overlap else (doc, t)
        ok = win >= 0
        wide, n = int(win.max(initial=0)) + 1, max(1, len(idf))
        cell = np.sort((doc[ok] * wide + win[ok]) * n + t[ok])
        head = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[head, len(cell)])
        row, self.term = np.divmod(cell[head], n)
        new = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        self.start = np.flatnonzero(new)
        self.doc, self.win = np.divmod(row[self.start], wide)
        self.row = np.cumsum(new) - 1
        w = (1 + np.log(np.maximum(tf, 1))) * idf[self.term]
        norm = np.sqrt(np.bincount(self.row, w * w, len(self.start)))
        self.weight = (w / norm[self.row]) if len(w) else w

    def times(self, m: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """This matrix, or its rows from ``first`` to ``last``, times a dense terms × n one: a few rows at once, as a
        dense product over the terms they hold."""
        last = len(self.start) if last is None else last
        out = np.zeros((last - first, m.shape[1]), m.dtype)
        ends = np.r_[self.start, len(self.term)]
        for lo in range(first, last, ROWS_AT_ONCE):
            hi = min(lo + ROWS_AT_ONCE, last)
            part = slice(ends[lo], ends[hi])
            terms, at = np.unique(self.term[part], return_inverse=True)
            dense = np.zeros((hi - lo, len(terms)), m.dtype)
            dense[self.row[part] - lo, at] = self.weight[part]
            np.matmul(dense, m[terms], out=out[lo - first:hi - first])
        return out

    def near(self, basis: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, item window) whose cosine in the basis is ``COSINE`` or more; ``vectors`` are the items' unit vectors there."""
        out, step = [np.zeros((2, 0), np.int64)], max(ROWS_AT_ONCE, SCORES_AT_ONCE // max(1, *vectors.shape))
        for lo in range(0, len(self.start), step):
            z = self.times(basis, lo, min(lo + step, len(self.start)))
            least = COSINE * np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-12)
            r, c = np.nonzero(z @ vectors.T >= least[:, None])
            out.append(np.stack([lo + r, c]))
        return tuple(np.concatenate(out, axis=1))

    def pair_sums(self, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries on and above the diagonal of this matrix's Gram matrix: keys ``t1 * n_terms + t2`` and sums."""
        size = np.diff(np.r_[self.start, len(self.term)])
        times = size[self.row] - (np.arange(len(self.term)) - self.start[self.row])      # with itself and what follows in its row
        i = np.repeat(np.arange(len(self.term)), times)
        j = i + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        key, back = np.unique(self.term[i] * n_terms + self.term[j], return_inverse=True)
        return key, np.bincount(back, self.weight[i] * self.weight[j], len(key))


class Counts:
    """The counted words of items: which items hold a term and how often, and the count that a leak needs."""

    def __init__(self, words: list[list[bytes]], answers: list[list[bytes]], number: dict[bytes, int]):
        held = [Counter(number[w] for w in ws if w in number) for ws in words]
        term = np.array([t for h in held for t in h], np.int64)
        by = np.argsort(term, kind="stable")
        self.start = np.searchsorted(term[by], np.arange(len(number) + 1))
        self.item = np.repeat(np.arange(len(held)), [len(h) for h in held])[by]
        self.times = np.array([n for h in held for n in h.values()], np.int64)[by]
        self.size = np.array([len(ws) for ws in words], np.int64)
        least = [next((m for m in range(n + 1) if n and m / n >= (PARAPHRASE if len(a) >= ANSWER_WORDS else SAME)), n + 1)
                 for n, a in zip(self.size.tolist(), answers)]
        # a common subsequence of this length leaves out at most size - least of the item's words
        self.need = np.maximum(1, np.array([sum(h.values()) for h in held], np.int64) - self.size + least)
        self.longest = int(self.size.max(initial=0))
        self.span = max(SPAN, -(-self.longest // 16))

    def expanded(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``term``, index into ``item``) of every item that holds the term."""
        n = self.start[term + 1] - self.start[term]
        return np.repeat(np.arange(len(term)), n), np.arange(n.sum()) + np.repeat(self.start[term] - np.cumsum(n) + n, n)

    def windows(self, pos: list[np.ndarray], term: list[np.ndarray]) -> np.ndarray:
        """Rows (document, item, window) of all windows with enough of the item's counted words around them."""
        return self.windows_of(*_joined(pos, term))

    def windows_of(self, doc: np.ndarray, p: np.ndarray, t: np.ndarray) -> np.ndarray:
        """The same from (document, position, term) arrays."""
        # a hit counts for the windows whose surroundings hold it; spans of windows are done apart
        lo = np.maximum(0, (p - WINDOW - self.longest) // STRIDE + 1) // self.span
        n = (p + self.longest) // STRIDE // self.span - lo + 1
        at = np.repeat(np.arange(len(p)), n)
        part = lo[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        by = np.lexsort((part, doc[at]))
        at, part = at[by], part[by]
        new = np.r_[True, (doc[at][1:] != doc[at][:-1]) | (part[1:] != part[:-1])] if len(at) else np.zeros(0, bool)
        first = np.r_[np.flatnonzero(new), len(at)]
        work = np.r_[0, np.cumsum((self.start[1:] - self.start[:-1])[t[at]])][first]
        out, lo = [np.zeros((0, 3), np.int64)], 0
        while lo < len(first) - 1:
            hi = min(len(first) - 1, lo + 2_048, max(lo + 1, int(np.searchsorted(work, work[lo] + 500_000))))
            rows = slice(first[lo], first[hi])
            out.append(self._counted(doc[at[rows]], p[at[rows]], t[at[rows]], part[rows], np.cumsum(new[rows]) - 1))
            lo = hi
        return np.concatenate(out)

    def _counted(self, doc: np.ndarray, p: np.ndarray, t: np.ndarray, part: np.ndarray, unit: np.ndarray) -> np.ndarray:
        items, terms = len(self.size), len(self.start) - 1
        once = _distinct(unit * terms + t)
        i, k = self.expanded(once % terms)
        total = np.bincount((once // terms)[i] * items + self.item[k], self.times[k], (unit[-1] + 1) * items)
        enough = total.reshape(-1, items) >= self.need
        i, k = self.expanded(t)
        ok = enough[unit[i], self.item[k]]
        i, k = i[ok], k[ok]
        item = self.item[k]
        lo = np.maximum((p[i] - WINDOW - self.size[item]) // STRIDE + 1, part[i] * self.span)
        hi = np.minimum((p[i] + self.size[item]) // STRIDE, (part[i] + 1) * self.span - 1)
        n = np.maximum(0, hi - lo + 1)
        at = np.repeat(np.arange(len(i)), n)
        win = lo[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        i, k, item = i[at], k[at], item[at]
        place = (unit[i] * items + item) * self.span + win - part[i] * self.span
        _, one = np.unique(place * terms + t[i], return_index=True)
        _, head, back = np.unique(place[one], return_index=True, return_inverse=True)
        head = one[head[np.bincount(back, self.times[k[one]], len(head)) >= self.need[item[one[head]]]]]
        return np.stack([doc[i[head]], item[head], win[head]], axis=1)


def _slices(batches, column: int):
    """Batches cut into slices of at most ``MARKED_ROWS`` rows and ``MARKED_CHARS`` bytes of text; a longer text is a slice."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            most = (ends[lo - 1] if lo else 0) + MARKED_CHARS
            hi = min(lo + MARKED_ROWS, max(lo + 1, int(np.searchsorted(ends, most, side="right"))))
            yield b.slice(lo, hi - lo)
            lo = hi


def _passages_of_marks(batches, idf: np.ndarray, rows: int):
    """Passages side by side of slices of stored marks."""
    for big in batches:
        for b in (big.slice(lo, rows) for lo in range(0, big.num_rows, rows)):
            doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(0)).to_numpy(zero_copy_only=False))
            yield Passages.of(doc, *(b.column(k).flatten().to_numpy().astype(np.int64) for k in range(2)), idf, overlap=False)


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of dense matrices given as (slice, data) rows, a slice at a time: every task gives one matrix, and the tasks are few."""
    def add(key, table):
        total = sum(np.frombuffer(x.as_py()) for x in table.column("data"))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    out = parts.groupBy("slice").applyInArrow(add, "slice int, data binary")
    m = np.zeros(shape)
    for r in out.collect():
        rows = np.frombuffer(r["data"]).reshape(-1, shape[1])
        m[r["slice"] * _SLICE:r["slice"] * _SLICE + len(rows)] = rows
    return m


def _sliced(m: np.ndarray):
    n = -(-len(m) // _SLICE)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int32()), pa.array([np.ascontiguousarray(m[i * _SLICE:(i + 1) * _SLICE]).tobytes() for i in range(n)], pa.binary())],
        names=["slice", "data"])


def latent_basis(marks: DataFrame, idf: np.ndarray, own: Passages) -> np.ndarray:
    """terms × rank basis of the right singular vectors of the TF-IDF matrix of all passages, the items' own
    (``own``) among them, with the weight of one document per item so that rare items are not lost."""
    n = len(idf)
    rank = min(MAX_RANK, max(MIN_RANK, len(own.start) + MIN_RANK // 2), n)
    width = min(n, rank + OVERSAMPLE)
    spark = marks.sparkSession
    share = max(1.0, marks.where(F.array_min("term") < n).count() / max(1, len(own.start)))

    def paired(batches):
        keys, sums, held = [], [], 0
        for p in _passages_of_marks(batches, idf, 2_000):
            key, total = p.pair_sums(n)
            keys.append(key)
            sums.append(total)
            held += len(key)
            if held > 1_500_000:
                key, back = np.unique(np.concatenate(keys), return_inverse=True)
                keys, sums, held = [key], [np.bincount(back, np.concatenate(sums), len(key))], 0
        if keys:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(back, np.concatenate(sums), len(key)).astype(np.float32)
            for lo in range(0, len(key), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + 50_000]), pa.array(total[lo:lo + 50_000])], names=["pair", "v"])

    pair = marks.mapInArrow(paired, "pair bigint, v float").groupBy("pair").agg(F.sum("v").alias("v"))
    gram = materialize(pair.select(F.floor(F.col("pair") / n).cast("int").alias("t1"), (F.col("pair") % n).cast("int").alias("t2"), "v")
                       .sortWithinPartitions("t1", "t2"), "term-pairs")
    key, total = own.pair_sums(n)
    mine = (key // n, key % n, share * total)

    def add(out: np.ndarray, right: np.ndarray, t1: np.ndarray, t2: np.ndarray, v: np.ndarray) -> None:
        """out += G right for the symmetric entries (t1, t2, v), t1 <= t2."""
        off = t1 != t2
        for rows, cols, x in ((t1, t2, v), (t2[off], t1[off], v[off])):
            by = np.argsort(rows, kind="stable")
            rows, cols, x = rows[by], cols[by], x[by].astype(right.dtype)
            for lo in range(0, len(rows), PAIRS_AT_ONCE):
                r = rows[lo:lo + PAIRS_AT_ONCE]
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                out[r[first]] += np.add.reduceat(right[cols[lo:lo + PAIRS_AT_ONCE]] * x[lo:lo + PAIRS_AT_ONCE, None], first, axis=0)

    def multiplied(right: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(right.astype(np.float32))
        shape = right.shape                  # all that run() takes along: the matrix itself is broadcast, once

        def run(batches):
            out = np.zeros(shape)
            for b in batches:
                add(out, shared.value, *(b.column(k).to_numpy() for k in range(3)))
            yield _sliced(out)

        # few tasks: the pairs are bounded by the terms, and each task hands on a whole terms x rank matrix
        out = summed(gram.coalesce(4).mapInArrow(run, "slice int, data binary"), shape)
        shared.destroy()
        add(out, right, *mine)
        return out

    q = np.random.default_rng(20).standard_normal((n, width))
    for _ in range(2):                       # the sketch and one power step
        q, _r = np.linalg.qr(multiplied(q))
    g = q.T @ multiplied(q)                  # (A q)ᵀ (A q)
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    return q @ vectors[:, np.argsort(-values)[:rank]]


def parts_of(rows: list[tuple]) -> list[list[tuple]]:
    """Collected items (item, text) in parts of at most ``BLOCK_WINDOWS`` windows; an item with more is a part of its own."""
    parts, held = [[]], 0
    for r in rows:
        n = len(words_of(r[1]))
        windows = -(-n // STRIDE)
        if parts[-1] and held + windows > BLOCK_WINDOWS:
            parts.append([])
            held = 0
        parts[-1].append(r)
        held += windows
    return parts


class Items:
    """A block of benchmark items with its terms numbered."""

    def __init__(self, rows: list[tuple]):
        self.ids = [r[0] for r in rows]
        self.words = [words_of(r[1]) for r in rows]
        self.answers = [answer_of(r[1]) for r in rows]
        self.number = {w: i for i, w in enumerate(sorted({w for ws in self.words for w in ws}))}


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """One row per (document row key, item): ``k1``, ``k2``, id, ``item_id``, ``lcs`` (share of the item's words), ``answer``
    (the item's last sentence stands there). See ``decontaminate`` for the cases."""
    key = ["k1", "k2"]
    # k1 and k2 are hashes of id and text: rows that repeat both are one document
    rows = docs.select(*row_key(id_col, text_col), docs[id_col].alias("id"), docs[text_col].alias("text")).where("text is not null")
    items = benchmark.select(benchmark[item_col].alias("item"), benchmark[item_text].alias("text")).where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-size[0] // BLOCK_CHARS), -(-size[1] // BLOCK_ITEMS))
    found = None
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()      # about BLOCK_ITEMS items
        for part in parts_of(sorted([tuple(r) for r in mine], key=lambda r: (r[0] is None, r[0] or 0, r[1]))):
            with scratch_scope() as tables:
                got = _block_leaks(rows, Items(part), items.schema["item"].dataType.simpleString(),
                                   docs.schema[id_col].dataType.simpleString())
            drop_tables(docs.sparkSession, [t for t in tables if not t.rsplit("/", 1)[1].startswith("leaks-")])
            found = got if found is None else found.unionByName(got)
    return found.dropDuplicates([*key, "item"]).withColumnRenamed("id", id_col).withColumnRenamed("item", "item_id")


def _block_leaks(rows: DataFrame, items: Items, item_type: str, id_type: str) -> DataFrame:
    spark = rows.sparkSession
    n_terms = len(items.number)
    known = spark.sparkContext.broadcast(pa.array(list(items.number), pa.string()))

    def counted(batches):
        total = np.zeros(n_terms + 1, np.int64)             # and, last, the texts
        for b in _slices(batches, 0):
            doc, _, term = term_hits(b.column(0).to_pylist(), known.value)
            total[:-1] += np.bincount(_distinct(doc * n_terms + term) % n_terms, minlength=n_terms)
            total[-1] += b.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    df = np.zeros(n_terms + 1)
    if n_terms:
        seen = rows.select("text").mapInArrow(counted, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
        df[seen["term"].to_numpy()] = seen["n"].to_numpy()
    known.destroy()                           # here and below: its file on every executor goes when the rows stand
    df, n_docs = df[:-1], int(df[-1])
    keep = df <= max(COMMON_DOCS, COMMON * n_docs)
    for ws in items.words:
        own = sorted({items.number[w] for w in ws}, key=lambda i: (df[i], i))
        keep[own[:KEEP_RAREST]] = True
    count = keep.copy()                       # more terms are marked where they are needed for the counts only
    for ws in items.words:
        times = Counter(items.number[w] for w in ws)
        have = 0
        for i in sorted(times, key=lambda i: (df[i], i)):
            if have >= COUNTED * len(ws):
                break
            count[i] = True
            have += times[i]
    slot = np.full(n_terms, -1)
    slot[keep] = np.arange(int(keep.sum()))
    slot[count & ~keep] = int(keep.sum()) + np.arange(int((count & ~keep).sum()))
    rare = {w: int(slot[i]) for w, i in items.number.items() if slot[i] >= 0}
    idf = np.log((1 + n_docs) / (1 + df[keep])) + 1
    rare_b = spark.sparkContext.broadcast(pa.array(sorted(rare, key=rare.get), pa.string()))

    def marked(batches):
        for b in _slices(batches, 0):
            doc, *hits = term_hits(b.column(0).to_pylist(), rare_b.value)
            offsets = pa.array(np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)] if len(doc) else [0], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in hits], names=["pos", "term"])

    marks = materialize(rows.select("text").mapInArrow(marked, "pos array<int>, term array<int>"), "term-marks")

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)

    own = [[(p, rare[w]) for p, w in enumerate(ws) if rare.get(w, len(idf)) < len(idf)] for ws in items.words]
    a = Passages([np.array([p for p, _ in o], np.int64) for o in own], [np.array([t for _, t in o], np.int64) for o in own], idf)
    basis = latent_basis(marks, idf, a) if len(idf) else np.zeros((0, 1))
    item_of, item_vectors = a.doc, unit(a.times(basis)).astype(np.float32)
    shared = spark.sparkContext.broadcast((basis.astype(np.float32), item_vectors, item_of, Counts(items.words, items.answers, rare),
                                           items.ids, items.words, items.answers))

    def candidates(texts: list[str]):
        """(text, (item, window) pairs) of every text of a slice that has candidates."""
        basis, vectors, owner, counts, *_ = shared.value
        doc, p, t = term_hits(texts, rare_b.value)
        a = Passages.of(doc, p, t, idf)
        row, c = a.near(basis, vectors)
        found = np.concatenate([counts.windows_of(doc, p, t), np.stack([a.doc[row], owner[c], a.win[row]], axis=1)])
        wide = int(found[:, 2].max(initial=0)) + 1
        of, win = np.divmod(_distinct((found[:, 0] * len(counts.size) + found[:, 1]) * wide + found[:, 2]), wide)
        doc, item = np.divmod(of, len(counts.size))
        for part in np.split(np.arange(len(doc)), np.flatnonzero(doc[1:] != doc[:-1]) + 1) if len(doc) else []:
            yield int(doc[part[0]]), zip(item[part].tolist(), win[part].tolist())

    def verified(batches):
        *_, ids, words, answers = shared.value
        places = {}
        for b in _slices(batches, 3):
            out, texts = [], b.column(3).to_pylist()
            for row, near in candidates(texts):
                ws, best = words_of(texts[row]), {}
                for n, win in near:
                    item, answer = words[n], answers[n]
                    if n not in places:
                        places[n] = places_of(item)
                    region = ws[max(0, win * STRIDE - len(item)):win * STRIDE + WINDOW + len(item)]
                    held = list(filter(None, map(places[n].get, region)))
                    if len(held) / len(item) < PARAPHRASE:          # no subsequence is longer than these words
                        continue
                    share = _lcs_of_places(len(item), held) / len(item)
                    said = len(answer) >= ANSWER_WORDS and share >= PARAPHRASE and holds(region, answer)
                    if share >= SAME or said:
                        best[n] = max(best.get(n, (0, False)), (share, said or holds(region, answer)))
                out += [(row, ids[n], *v) for n, v in best.items()]
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(3)), pa.array([o[1] for o in out], _ARROW[item_type]),
                                              pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.bool_())],
                                             names=["k1", "k2", "id", "item", "lcs", "answer"])

    leaks = materialize(rows.select("k1", "k2", "id", "text").mapInArrow(
        verified, f"k1 bigint, k2 bigint, id {id_type}, item {item_type}, lcs double, answer boolean"), "leaks")
    shared.destroy()
    rare_b.destroy()
    return leaks


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with their columns unchanged.

    Null and empty texts and texts without words hold nothing and stay. Items without words match nothing;
    items with equal texts are reported each. Rows that repeat id and text are one document. An empty
    benchmark leaves all rows; empty documents give an empty result.
    """
    gone = find_leaks(docs, benchmark, id_col, text_col).select("k1", "k2").distinct()
    keep = docs.columns
    return (docs.select(F.struct(*keep).alias("row"), *row_key(id_col, text_col)).join(gone, ["k1", "k2"], "left_anti")
            .select(*[F.col("row")[c].alias(c) for c in keep]))
