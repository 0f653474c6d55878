"""Plain re-statements of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


def decontamination(texts, items, window=10):
    """Per text: n_words, n_hit, n_items, items_sha256."""
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).add(str(i))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in wins:
                    hit.update(range(j, j + n))
                    found |= wins[tuple(w[j:j + n])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def simhash(text, shingle=3):
    w = words(text, SPACED)
    sh = [" ".join(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))] if w else []
    counts = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(sh))


def groups(pairs, nodes):
    """Smallest connected node of each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_groups(rows, radius=3):
    """rows: (id, fingerprint); ids may repeat."""
    ids = np.array([i for i, _ in rows])
    fp = np.array([f for _, f in rows], dtype=np.uint64)
    pairs = []
    for k in range(len(rows)):
        near = np.bitwise_count(fp ^ fp[k]) <= radius
        pairs += [(int(ids[k]), int(i)) for i in ids[near | (ids == ids[k])]]
    return groups(pairs, {int(i) for i in ids})


def suffix_dedup(rows, window=50):
    """Per row of (id, text): n_bytes, n_removed, n_spans, kept_sha256."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - window + 1):
            w = b[k:k + window]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if first[b[k:k + window]] < i:
                gone[k:k + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rule_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = text or ""
    w = SPACED.findall(t)
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def chat_windows(turns, budget, history, turn_tokens=4):
    """Greedy windows of [(role, text)]: (first repeated, span start, span end) lists."""
    tokens = [len(SPACED.findall(t)) + turn_tokens for _, t in turns]
    sys = 1 if turns and turns[0][0] == "system" else 0
    room = max(1, budget - history - (tokens[0] if sys else 0))
    starts, used = [0], 0
    for i, n in enumerate(tokens):
        n = 0 if i < sys else n
        if used > 0 and used + n > room:
            starts.append(i)
            used = n
        else:
            used += n
    out = []
    for k, s in enumerate(starts):
        e = starts[k + 1] if k + 1 < len(starts) else len(turns)
        h, left = s, history
        while s > 0 and h > sys and tokens[h - 1] <= left:
            left -= tokens[h - 1]
            h -= 1
        out.append((list(range(sys)) + list(range(h, s)) if s else [], s, e))
    return out
