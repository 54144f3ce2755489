"""Plain, slow versions of the operators' definitions, and small inputs."""

from __future__ import annotations

import random
import re

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").encode().lower()) if w]


def shingle_set(text, width):
    found = words(text)
    if not found:
        return set()
    return {tuple(found[i : i + width]) for i in range(max(len(found) - width + 1, 1))}


def components(nodes, links):
    low = {n: n for n in nodes}

    def top(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        low[y] = x
    return {n: top(n) for n in nodes}


def near_duplicates(texts, width, percent=80):
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    return {i: len(s) for i, s in sets.items()}, components(sets, links)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def corpus(seed=1, groups=25, size=8, length=(8, 90)):
    """Documents in groups of copies with more and more words changed, beside others, as {id: text}."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = prose(rng, rng.randint(*length))
        for k in range(rng.randint(1, size)):
            texts.append(" ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 12)) if k else 0)))
    rng.shuffle(texts)
    return dict(enumerate(texts))
