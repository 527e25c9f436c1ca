"""Plain versions of the corpus operators for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def normal(text):
    return SPACE.sub(" ", text or "")


def components(nodes, linked):
    """Component number of each node of ``range(nodes)``."""
    parent = list(range(nodes))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(nodes)]


def shingles(text, k):
    w = [x.encode().lower() for x in words(text)]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_groups(texts, k, percent=80):
    sets = [shingles(t, k) for t in texts]
    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                pairs.append((i, j))
    return sets, components(len(texts), pairs)


def targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Target of each source; ``sizes`` by source, None for the unnamed one."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(repeats * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > repeats * sizes[s]}
        if not over:
            return {s: repeats * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def taken(rows, seed=7):
    """Words taken of each of ``rows`` (id, source, size), ids being distinct."""
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    target, out = targets(sizes), [0] * len(rows)
    for source, total in sizes.items():
        quota = math.floor(target[source] + 0.5)
        for epoch in range(-(-quota // total) if total else 0):
            order = sorted(
                (i for i, r in enumerate(rows) if r[1] == source and r[2]),
                key=lambda i: hashlib.md5(f"{rows[i][0]}|{epoch}|{seed}".encode()).hexdigest(),
            )
            place = epoch * total
            for i in order:
                out[i] += max(0, min(place + rows[i][2], quota) - place)
                place += rows[i][2]
    return out


def recurring_lines(texts, min_documents=8, depth=3, part=4, long=50):
    """Numbers of the dropped lines of each text: every line is written out with each
    field it may have, and each of these is counted over all texts."""
    holders, lines = defaultdict(set), []
    for d, text in enumerate(texts):
        for no, line in enumerate((text or "").split("\n")):
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in words(line)]
            if not set(tokens) - {"<*>"}:
                continue
            rest = len(tokens) - depth
            width = rest // part if rest > 0 else 0
            forms = []
            if width and sum(t == "<*>" for t in tokens) <= width:
                last = len(tokens) - width
                for start in {*range(depth, last + 1, (width + 1) // 2), last}:
                    forms.append((start, *tokens[:start], *[None] * width, *tokens[start + width:]))
            lines.append((d, no, tuple(tokens), forms))
            for form in [tuple(tokens), *forms]:
                holders[form].add(d)
    out = [[] for _ in texts]
    for d, no, tokens, forms in lines:
        same = holders[tokens]
        later = len(tokens) >= long and d != min(same)
        if later or any(len(holders[f]) >= min_documents for f in [tokens, *forms]):
            out[d].append(no)
    return [sorted(x) for x in out]
