"""Plain restatements of the operators' contracts, for small inputs."""

import collections
import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    """Union of positions, named by the smallest id."""

    def __init__(self, n):
        self.up = list(range(n))

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)

    def names(self, ids):
        least = {}
        for i, x in enumerate(ids):
            if x is not None:
                r = self.find(i)
                least[r] = min(least.get(r, x), x)
        return [least.get(self.find(i)) for i in range(len(ids))]


def fingerprint(text, k=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def fingerprint_components(ids, prints, bits):
    sets = Sets(len(prints))
    a = np.array(prints, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= bits) + i + 1:
            sets.join(i, int(j))
    return sets.names(ids)


def without_repeats(texts, length):
    """(n_bytes, n_removed, n_spans, kept digest) of each text."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cosine_links(ids, vectors, least):
    """(links, component) of each vector."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if o else None
            for v, o in zip(vectors, ok)]
    sets, links = Sets(len(ids)), [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                sets.join(i, j)
    return list(zip(links, sets.names(ids)))


def repeats(text, least):
    """(words in 3-word windows found twice, characters in repeats of ``least`` words, longest such repeat)."""
    w = (text or "").encode().split()
    n, in3, inside, longest = len(w), set(), set(), 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and w[i + k] == w[j + k]:
                k += 1
            if k >= 3:
                in3.update(range(i, i + k), range(j, j + k))
            if k >= least:
                inside.update(range(i, i + k), range(j, j + k))
                longest = max(longest, k)
    return len(in3), sum(len(w[i].decode()) for i in inside), longest


def water_fill(sizes, weights=(5, 2, 1), most=3):
    """Target of each source: shares by weight, cut at ``most`` times the size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    free, rest, out = set(names), float(sum(sizes.values())), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / total for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            rest -= out[s]
            free.remove(s)
    return out


def kept_texts(texts, length):
    """Texts without the bytes of repeated windows, and without characters that a cut has split."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        parts = [t[m.start():m.end()] for m in re.finditer(rb"\0+", bytes(gone))]
        out.append("".join(p.decode("utf-8", "ignore") for p in parts))
    return out
