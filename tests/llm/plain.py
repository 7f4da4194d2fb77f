"""Plain Python versions of the operators, quadratic and slow, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def simhash(text, k=4):
    w = WORD.findall(lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=4):
    """Smallest index reachable, per index."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def tiles(item, doc, k):
    """Greedy string tiling as published: the longest free match again and again."""
    free_i, free_d, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and free_i[i + n] and free_d[d + n]):
                    n += 1
                if n >= k and (best is None or (-n, i, d) < best):
                    best = (-n, i, d)
        if best is None:
            return out
        n, i, d = -best[0], best[1], best[2]
        for x in range(n):
            free_i[i + x] = free_d[d + x] = False
        out.append((i, d, n))


def leaks(docs, items, k=5, threshold=0.8):
    """{(doc index, item id)}; ``docs`` texts, ``items`` (id, text)."""
    out = set()
    read = [tokens(t) for t in docs]
    for item, text in items:
        w = tokens(text)
        if len(w) < k:
            continue
        grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        for n, d in enumerate(read):
            if any(tuple(d[i:i + k]) in grams for i in range(len(d) - k + 1)):
                if sum(x[2] for x in tiles(w, d, k)) >= threshold * len(w):
                    out.add((n, item))
    return out


def targets(sizes, weights=(5, 2, 1), cap=3):
    """source -> target, shared again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        share = left / sum(w[s] for s in rest) if rest else 0
        over = {s for s in rest if cap * sizes[s] <= w[s] * share}
        if not over:
            return {s: float(cap * sizes[s]) if s in capped else w[s] * share for s in order}
        capped |= over


def mix(rows, seed="mix", **kw):
    """Copies per row of ``rows`` (id, source, size), in order."""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal, out, seen = targets(sizes, **kw), [0] * len(rows), {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][2], rows[i][0] is None, rows[i][0])):
        s = rows[i][1]
        rate = goal[s] / sizes[s] if sizes[s] else 0.0
        u = int(hashlib.md5((seed + (s or "")).encode()).hexdigest()[:4], 16) / 65536
        seen[s] = n = seen.get(s, 0) + 1
        out[i] = min(math.floor(u + n * rate) - math.floor(u + (n - 1) * rate), math.ceil(rate))
    return out


def base_spans(text):
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"""([A-Za-z0-9+/_.=-]+)""", lower(text)):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def best_fit(sizes, length):
    """Free capacities left, sorted."""
    free = []
    for n in sizes:
        fits = [f for f in free if f >= n]
        if fits:
            free[free.index(min(fits))] -= n
        else:
            free.append(length - n)
    return sorted(free)


def squeezed(text):
    return " ".join(lower(text).split())


def quote_parts(text):
    """Own lines and quoted passages (level, lines) of a message."""
    own, passages, before = [], [], 0
    for line in (text or "").split("\n"):
        m = re.match(r"(?:[ \t]*>)+[ \t]?", line)
        level = m[0].count(">") if m else 0
        if level == 0:
            own.append(line)
        elif level == before:
            passages[-1][1].append(line[m.end():])
        else:
            passages.append((level, [line[m.end():]]))
        before = level
    return own, passages


def quote_units(lines):
    whole = "\n".join(lines)
    return {squeezed(x) for x in [whole, *re.split(r"\n\s*\n", whole), *lines]} - {""}


def quotes(messages):
    """(conv, turn) -> parent, root and links of messages (conv, turn, text), each
    turn once and no introducing lines."""
    out = {}
    for conv in {c for c, _, _ in messages}:
        own = sorted((t, *quote_parts(x)) for c, t, x in messages if c == conv)
        units = {t: quote_units(o if not p else re.sub(r"\n{3,}", "\n\n", "\n".join(o)).strip("\n").split("\n"))
                 for t, o, p in own}
        texts = {t: squeezed("\n".join(o)) for t, o, _ in own}
        parent = {}
        for turn, _, passages in own:
            links, votes, seen = set(), {}, set()
            for level, lines in passages:
                hit = False
                for u in quote_units(lines):
                    at = max((t for t in units if t < turn and u in units[t]), default=None)
                    if at is not None:
                        hit = True
                        links.add((level, at))
                        if level == 1 and u not in seen:
                            seen.add(u)
                            votes[at] = votes.get(at, 0) + len(u.encode())
                whole = squeezed("\n".join(lines))
                if not hit and len(whole.split()) >= 3:
                    at = max((t for t in texts if t < turn and f" {whole} " in f" {texts[t]} "), default=None)
                    if at is not None:
                        links.add((level, at))
                        if level == 1:
                            votes[at] = votes.get(at, 0) + len(whole.encode())
            parent[turn] = max(votes, key=lambda t: (votes[t], t)) if votes else None
            out[conv, turn] = [parent[turn], None, ",".join(sorted(f"{a}:{b}" for a, b in links))]
        for turn in parent:
            root = turn
            while parent[root] is not None:
                root = parent[root]
            out[conv, turn][1] = root
    return {k: tuple(v) for k, v in out.items()}
