"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def cover(sequences: list, size: int) -> list[set[int]]:
    """Per sequence the places covered by windows whose content starts anywhere else."""
    counts = Counter(tuple(s[i : i + size]) for s in sequences for i in range(len(s) - size + 1))
    return [
        {i + j for i in range(len(s) - size + 1) if counts[tuple(s[i : i + size])] > 1 for j in range(size)} for s in sequences
    ]


def substring_dedup(rows, size):
    words = [SPACE.findall(text or "") for _, text in rows]
    out = []
    for (doc, _), own, gone in zip(rows, words, cover(words, size)):
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def suffix_dedup(rows, size):
    data = [(text or "").encode() for _, text in rows]
    out = []
    for (doc, _), own, gone in zip(rows, data, cover(data, size)):
        kept = bytes(b for i, b in enumerate(own) if i not in gone)
        runs = sum(1 for i in gone if i - 1 not in gone)
        out.append((doc, len(own), len(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, shingle=4):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = SPACE.findall(low)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=4):
    """Smallest id reachable; `prints` are (id, fingerprint)."""
    by_value = defaultdict(list)
    for doc, fp in prints:
        by_value[fp].append(doc)
    values = list(by_value)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for v, docs in by_value.items():
        ids = [d for d in docs if d is not None]
        if ids:
            least[find(v)] = min([*ids, *([least[find(v)]] if find(v) in least else [])])
    return {fp: least.get(find(fp)) for fp in values}


def near_copies(rows, shingle):
    """Smallest ids of the groups of texts that links of a shingle similarity of 0.8 or more connect."""
    sets = []
    for _, text in rows:
        words = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set())
    groups = []
    for i, own in enumerate(sets):
        near = [g for g in groups if any(own == sets[j] or 5 * len(own & sets[j]) >= 4 * len(own | sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [[i, *(j for g in near for j in g)]]
    return [min((rows[i][0] for i in g), key=lambda d: (d is None, d or 0)) for g in groups]


def tiles(text: list[str], item: list[str], least: int) -> int:
    """Item tokens covered by greedy string tiling."""
    in_text, in_item = [False] * len(text), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for p in range(len(text)):
            for q in range(len(item)):
                k = 0
                while (
                    p + k < len(text)
                    and q + k < len(item)
                    and text[p + k] == item[q + k]
                    and not in_text[p + k]
                    and not in_item[q + k]
                ):
                    k += 1
                if k > best[0] or (k == best[0] and k and (q, p) < best[1:]):
                    best = (k, q, p)
        k, q, p = best
        if k < least:
            return sum(in_item)
        for j in range(k):
            in_text[p + j] = in_item[q + j] = True
