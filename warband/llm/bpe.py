"""Byte-pair tables shared by the prefix counter and the suffix-array encoder.

Both operators rest on one property of merge tokenizers: a token sequence is the encoding of
its text exactly when every adjacent pair of tokens stays apart under the merge rules, and each
prefix of a text has exactly one such sequence. ``Spines`` decides whether a pair stays apart.

Along the border between tokens ``a`` and ``b`` lies, at any moment of merging, one part of the
right edge of ``a`` and one part of the left edge of ``b``. The pair is torn open when a merge of
two such parts ranks before both parts are taken up by a merge inside their own token (of equal
ranks the left one is done first).
"""

from __future__ import annotations

NEVER = 1 << 60


def merge_once(parts: list, rank_of) -> list:
    """Merge the best-ranked, leftmost adjacent pair until none is left (a plain simulation,
    used on single vocabulary entries to learn how each is built). ``rank_of(l, r)`` → rank or None."""
    parts = list(parts)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = rank_of(parts[i], parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Spines:
    """Border parts of every token: ``right[t]`` / ``left[t]`` list (part, rank of the merge that
    takes it up), the token itself first with rank ``NEVER``."""

    def __init__(self, split: dict, rank: dict):
        """``split[token] = (left part, right part)`` for merged tokens, ``rank[token]`` = its merge rank."""
        self.right, self.left = {}, {}
        for t in rank:
            for side, store in ((1, self.right), (0, self.left)):
                out, cur = [(t, NEVER)], t
                while cur in split:
                    nxt = split[cur][side]
                    out.append((nxt, rank[cur]))
                    cur = nxt
                store[t] = out

    def apart(self, a, b, pair_rank: dict) -> bool:
        for x, x_dies in self.right[a]:
            for y, y_dies in self.left[b]:
                r = pair_rank.get((x, y))
                if r is not None and r < x_dies and r <= y_dies:
                    return False
        return True
