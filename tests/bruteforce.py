"""Plain sequential versions of the discovery steps, row by row (no collapsing), used
only to check the distributed jobs on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

PRIME = 2 ** 31 - 1


def md5_int(s: str) -> int:
    return int(hashlib.md5(s.encode("utf-8")).hexdigest()[:8], 16)


def perms(num_perm):
    return [(1 + md5_int(f"a{i}") % (PRIME - 1), md5_int(f"b{i}") % PRIME) for i in range(num_perm)]


def shingles(actions, n):
    return ["_".join(actions[i:i + n]) for i in range(len(actions) - n + 1)]


def signature(actions, n, num_perm):
    sh = set(shingles(actions, n)) or {""}
    hs = [md5_int(s) for s in sh]
    return [min((a * h + b) % PRIME for h in hs) for a, b in perms(num_perm)]


def buckets(sig, bands, rows):
    return [(j, tuple(sig[j * rows:(j + 1) * rows])) for j in range(bands)]


def greedy_groups(keys, bucket_of):
    index = defaultdict(set)
    for k in keys:
        for b in bucket_of[k]:
            index[b].add(k)
    visited, groups = set(), []
    for k in keys:
        if k in visited:
            continue
        cand = set().union(*[index[b] for b in bucket_of[k]])
        if len(cand) > 1:
            groups.append((k, cand))
            visited |= cand
    return groups


def char_counts(text, n):
    t = re.sub(r"\s\s+", " ", text.lower())
    return Counter(t[i:i + n] for i in range(len(t) - n + 1))


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def indel(a, b):
    return 1.0 if not a and not b else 2.0 * lcs_dp(a, b) / (len(a) + len(b))


def matrix(texts, n):
    counts = [char_counts(t, n) for t in texts]
    vocab = sorted(set().union(*counts)) if counts else []
    pos = {g: i for i, g in enumerate(vocab)}
    m = np.zeros((len(texts), len(vocab)))
    for r, c in enumerate(counts):
        for g, v in c.items():
            m[r, pos[g]] = v
    return m


def cosine(m):
    nrm = np.linalg.norm(m, axis=1)
    u = np.divide(m, nrm[:, None], out=np.zeros_like(m), where=nrm[:, None] > 0)
    return u @ u.T, nrm > 0


def dbscan(m, eps, min_samples):
    sim, nz = cosine(m)
    adj = (np.round(sim, 9) >= round(1 - eps, 9)) & nz[:, None] & nz[None, :]
    core = adj.sum(axis=1) >= min_samples
    labels = [-1] * len(m)
    lab = 0
    for i in range(len(m)):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            p = stack.pop()
            if labels[p] != -1:
                continue
            labels[p] = lab
            if core[p]:
                stack.extend(q for q in np.nonzero(adj[p])[0] if labels[q] == -1)
        lab += 1
    return labels


def cohesion(texts, actions, rep_idx, n):
    m = matrix(texts, n)
    sim, _ = cosine(m)
    k = len(texts)
    ngram = float(sim[np.triu_indices(k, 1)].mean()) if k > 1 else 1.0
    rep_set, rep_text = set(actions[rep_idx]), texts[rep_idx]
    jac = float(np.mean([len(set(a) & rep_set) / len(set(a) | rep_set) for a in actions]))
    lev = float(np.mean([indel(t, rep_text) for t in texts]))
    return ngram, jac, lev


def unknown_clusters(rows, ngram_n, char_n, num_perm, bands, band_rows, eps, min_samples, min_matches):
    """rows: dicts with match_id, player_id, win, actions, sorted in walk order."""
    keys = list(range(len(rows)))
    bucket_of = {k: buckets(signature(rows[k]["actions"], ngram_n, num_perm), bands, band_rows) for k in keys}
    out = []
    for _, members in greedy_groups(keys, bucket_of):
        idx = sorted(members)
        texts = [",".join(rows[i]["actions"]) for i in idx]
        m = matrix(texts, char_n)
        labels = dbscan(m, eps, min_samples)
        for lab in sorted(set(labels) - {-1}):
            sel = [j for j, x in enumerate(labels) if x == lab]
            if len(sel) < min_samples:
                continue
            players = Counter(rows[idx[j]]["player_id"] for j in sel)
            if max(players.values()) < min_matches:
                continue
            sub = m[sel]
            c = sub.mean(axis=0)
            d = np.round(((sub - c) ** 2).sum(axis=1), 6)
            rep = int(np.argmin(d))
            ngram, jac, lev = cohesion([texts[j] for j in sel], [rows[idx[j]]["actions"] for j in sel], rep, char_n)
            wins = [rows[idx[j]]["win"] for j in sel if rows[idx[j]]["win"] is not None]
            out.append((len(sel), round(float(np.mean(wins)), 9) if wins else None, len(players),
                        round(ngram, 6), round(jac, 6), round(lev, 6)))
    return sorted(out, key=str)


def known_variation(rows, char_n):
    """rows: dicts with strategy, match_id, player_id, actions, sorted by (strategy, match, player)."""
    by = defaultdict(list)
    for r in rows:
        by[r["strategy"]].append(r)
    out = []
    for strat, rs in sorted(by.items()):
        texts = [",".join(r["actions"]) for r in rs]
        top = Counter(texts).most_common(1)[0][0]
        rep = texts.index(top)
        ngram, jac, lev = cohesion(texts, [r["actions"] for r in rs], rep, char_n)
        out.append((strat, len(rs), round(jac * 100, 6), round(ngram * 100, 6), round(lev * 100, 6)))
    return out
