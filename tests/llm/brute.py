"""Plain-Python versions that the operators are held against."""

from __future__ import annotations

import re
from collections import Counter


def gram_set(text, n=5):
    words = re.findall(r"\w+", (text or "").lower())
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def near_groups(docs, threshold=0.8):
    """id -> (class_id, copy_id, n_links) by comparing every pair that shares a gram."""
    sets = {i: gram_set(t) for i, t in docs}
    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    shared = Counter()
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                shared[min(a, b), max(a, b)] += 1
    links = {i: set() for i in sets}
    for (a, b), n in shared.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a].add(b)
            links[b].add(a)
    out = {}
    for i in sorted(sets):
        if i in out:
            continue
        group, todo = set(), [i]
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links[x]
        for x in group:
            same = [y for y in group if sets[y] == sets[x] and sets[x]]
            out[x] = (min(group), min(same, default=x), len(links[x]))
    return out


def shared_passages(docs, words):
    """Ids of documents that share a run of that many words with another place."""
    seen, found = {}, set()
    for i, text in docs:
        parts = (text or "").split()
        for k in range(len(parts) - words + 1):
            key = tuple(parts[k : k + words])
            if key in seen and seen[key][0] != i:
                found |= {i, seen[key][0]}
            seen.setdefault(key, (i, k))
    return found


def best_segmentation(word, scores, byte_score):
    """(tokens, score) of the best segmentation; equal scores prefer the longer last piece."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[s][0] + scores[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in scores
        ]
        if word[end - 1] not in scores:
            raw = len(word[end - 1].encode())
            options.append((best[end - 1][0] + raw * byte_score, best[end - 1][1] + raw))
        top = max(o[0] for o in options)
        best.append(next(o for o in options if o[0] == top))
    return best[-1][1], best[-1][0]
