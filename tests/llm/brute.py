"""Plain versions of the corpus operators for small tables."""

import re

import xxhash


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def groups(nodes, edges):
    """{root: members} of linked nodes."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        root[find(a)] = find(b)
    out = {}
    for n in nodes:
        out.setdefault(find(n), []).append(n)
    return out


def simhash(docs, radius=2):
    """{id: (fingerprint, component)} of (id, text) rows."""
    prints = []
    for i, t in docs:
        w = words(lower(t))
        grams = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    distinct = sorted({p for _, p in prints})
    near = [(p, q) for k, p in enumerate(distinct) for q in distinct[k + 1:] if (p ^ q).bit_count() <= radius]
    out = {}
    for members in groups(distinct, near).values():
        ids = [(i, p) for i, p in prints if p in set(members)]
        out |= {i: (f"{p:016x}", min(j for j, _ in ids)) for i, p in ids}
    return out


def line_templates(line, depth=3, fixed=6):
    t = ["<*>" if re.search(r"[0-9@]", w) else w for w in words(line)]
    if not t:
        return []
    out = [("all", *t)]
    middle = depth + (len(t) - depth) // 2
    if len(t) > depth:
        if middle >= fixed:
            out.append(("left", len(t), *t[:middle]))
        if len(t) - middle + depth >= fixed:
            out.append(("right", len(t), *t[:depth], *t[middle:]))
    return out


def recurring_lines(docs, least=3):
    """(id, text, lines, dropped) of (id, text) rows."""
    order = lambda i: (i is not None, i or 0)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            for k in line_templates(line):
                holders.setdefault(k, set()).add(order(i))
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        gone = [any(len(holders[k]) >= least and order(i) != min(holders[k]) for k in line_templates(x)) for x in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), len(lines), sum(gone)))
    return out
