"""Exact token counts of whole texts and of every prefix of them (byte-level BPE).

A text is cut into words by the tokenizer's word pattern (tokens never cross words). For each
distinct word a dynamic program over its byte prefixes finds the last token of the encoding of
every prefix: the one vocabulary entry that ends there and stays apart from the last token of
what precedes it. So ``counts[i]``, the token count of the word's first ``i`` bytes, is exact for
every ``i``, and "how many tokens has this prefix" or "how long a prefix fits a budget" are
look-ups, with no text encoded again.

The words' tables are kept per Python worker; when the table holds ``MAX_WORDS`` entries it is
emptied and filled anew, which costs time but changes no result.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from warband.llm.bpe import Spines

MAX_WORDS = 1_000_000
MAX_PAIRS = 2_000_000
# Fixed value: the published word pattern of byte-level BPE tokenizers of this kind.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKEN_LIMIT = 1024


def _byte_letters() -> dict[str, int]:
    """Letter → byte of the byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others follow from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts of texts and of all their prefixes for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        rank, split, self.pair_rank = {}, {}, {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = map(raw, m if isinstance(m, list) else m.split(" "))
            self.pair_rank[(a, b)] = r
            if a + b not in rank:
                rank[a + b], split[a + b] = r, (a, b)
        for t in self.ids:
            rank.setdefault(t, -1)
        self.spines = Spines(split, rank)
        self.names = {i: t for t, i in self.ids.items()}
        self.longest_on = [1] * 256     # by last byte
        for t in self.ids:
            self.longest_on[t[-1]] = max(self.longest_on[t[-1]], len(t))
        special = [t["content"] for t in spec.get("added_tokens") or [] if t.get("special")]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.words = regex.compile(WORD_PATTERN)
        self.totals = _Totals(self)
        self.apart: dict[int, bool] = {}

    def prefix_counts(self, word: bytes) -> list[int]:
        """``counts[i]`` = tokens in the encoding of the first ``i`` bytes, for i in 0..len(word)."""
        known = self.ids.get
        apart, reach = self.apart, self.longest_on
        counts, last = [0], []
        for end in range(1, len(word) + 1):
            far = reach[word[end - 1]]
            start = end - far if end > far else 0
            while True:
                token = known(word[start:end])
                if token is not None:
                    if start == 0:
                        break
                    key = last[start - 1] << 20 | token
                    ok = apart.get(key)
                    if ok is None:
                        ok = self.judge(key)
                    if ok:
                        break
                start += 1
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def judge(self, key: int) -> bool:
        if len(self.apart) > MAX_PAIRS:
            self.apart.clear()
        a, b = self.names[key >> 20], self.names[key & 0xFFFFF]
        ok = self.apart[key] = self.spines.apart(a, b, self.pair_rank)
        return ok

    def parts(self, text: str):
        """The stretches between special strings, and each special string as (text, True)."""
        if self.special is None:
            yield text, False
            return
        at = 0
        for m in self.special.finditer(text):
            if m.start() > at:
                yield text[at:m.start()], False
            yield m[0], True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def spans(self, text: str) -> tuple[list[str], list[int]]:
        """The words of a text (a special string is one word) and their token counts."""
        totals, words, counts = self.totals, [], []
        if len(totals) > MAX_WORDS:
            totals.clear()
        for part, special in self.parts(text):
            if special:
                words.append(part)
                counts.append(1)
            else:
                found = self.words.findall(part)
                words += found
                counts += map(totals.__getitem__, found)
        return words, counts

    def count(self, text: str) -> int:
        if len(self.totals) > MAX_WORDS:
            self.totals.clear()
        known, words = self.totals.__getitem__, self.words.findall
        return sum(1 if special else sum(map(known, words(part))) for part, special in self.parts(text))

    def every_prefix(self, text: str) -> list[int]:
        """Tokens of ``text[:i]`` for i in 0..len(text).

        Inside a word the word's own program answers, but for two places where the pattern cuts a
        prefix otherwise than the whole: white space that ends the prefix is one word, and a
        contraction cut short is an apostrophe followed by letters.
        """
        out, base, before, base_before = [0], 0, "", 0
        for part, special in self.parts(text):
            if special:                  # its proper prefixes are ordinary text that goes on what precedes
                for i in range(1, len(part)):
                    out.append(base_before + self.totals_of_ordinary(before + part[:i]))
                base += 1
                out.append(base)
                before, base_before = "", base
                continue
            before, base_before = part, base
            done, start, space, at_space = base, 0, 0, base
            for w in self.words.findall(part):
                lead = len(w) - len(w.lstrip())
                if lead and not space:
                    at_space = done
                body = self.prefix_counts(w.encode())
                sizes = list(accumulate((len(c.encode()) for c in w), initial=0))
                contraction = w[0] == "'" and len(w) > 2
                for i in range(1, len(w) + 1):
                    if i <= lead:
                        space += 1
                        run = part[start + i - space:start + i]
                        out.append(at_space + self.prefix_counts(run.encode())[-1])
                    elif contraction and i < len(w):
                        out.append(done + self.totals_of_ordinary(w[:i]))
                    else:
                        out.append(done + body[sizes[i]])
                if lead < len(w):
                    space = 0
                done += body[-1]
                start += len(w)
            base = done
        return out

    def totals_of_ordinary(self, text: str) -> int:
        return sum(map(self.totals.__getitem__, self.words.findall(text)))

    def fitting(self, words: list[str], counts: list[int], budget: int) -> int:
        """Length in code points of the longest prefix, cut inside a word where need be, whose words
        up to the cut hold at most ``budget`` tokens."""
        ends = list(accumulate(counts))
        k = bisect_right(ends, budget)
        chars = sum(map(len, words[:k]))
        if k == len(words):
            return chars
        left = budget - (ends[k - 1] if k else 0)
        inner = self.prefix_counts(words[k].encode())
        size, best = 0, 0
        for i, c in enumerate(words[k], 1):
            size += len(c.encode())
            if inner[size] <= left:
                best = i
        return chars + best


class _Totals(dict):
    def __init__(self, counter: PrefixCounter):
        self.counter = counter

    def __missing__(self, word: str) -> int:
        n = self[word] = self.counter.prefix_counts(word.encode())[-1]
        return n


@lru_cache(maxsize=4)
def counter_of(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT, prefixes: bool = False) -> DataFrame:
    """Per row: ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars`` (code points of the longest
    prefix within ``limit`` tokens); with ``prefixes`` also ``prefix_tokens``, the count of every prefix.

    No shuffle; memory is bounded by one Arrow batch and the word table. Null and empty texts give
    zeros. Repeated rows give one row each. Extra columns are not read, whatever their names. An
    empty table gives an empty result. ``tokenizer`` must be readable on every executor.
    """
    fields = [("id", docs.schema[id_col].dataType.simpleString()), ("n_bytes", "bigint"), ("n_tokens", "bigint"),
              ("over_limit", "boolean"), ("fit_chars", "bigint")] + [("prefix_tokens", "array<int>")] * prefixes

    def run(batches):
        counter = counter_of(tokenizer)
        for b in batches:
            size, total, fit, table = [], [], [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                n = counter.count(t)
                size.append(len(t.encode()))
                total.append(n)
                fit.append(len(t) if n <= limit else counter.fitting(*counter.spans(t), limit))
                if prefixes:
                    table.append(counter.every_prefix(t))
            cols = [b.column(0), pa.array(size, pa.int64()), pa.array(total, pa.int64()),
                    pa.array([n > limit for n in total], pa.bool_()), pa.array(fit, pa.int64())]
            if prefixes:
                cols.append(pa.array(table, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=[f for f, _ in fields])

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, ", ".join(f"`{n}` {t}" for n, t in fields))
    return out.withColumnRenamed("id", id_col)
