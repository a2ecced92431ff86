"""Plain-Python versions of what the operators return, for small inputs."""

import re

import xxhash

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def blank_words(text):
    return [w for w in BLANKS.split(text or "") if w]


def simhash(text, width=3):
    w = blank_words(lower(text))
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(n, linked):
    """Smallest index reachable from each of n items; linked(i, j)."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def repeated_spans(docs, min_words=50):
    """{(doc_id, start, end)} of maximal passages in windows that several documents (by id and text) have."""
    docs = sorted(set(docs), key=str)
    seen = {}
    for d, t in docs:
        w = blank_words(t)
        for i in range(len(w) - min_words + 1):
            seen.setdefault(tuple(w[i:i + min_words]), set()).add((d, t))
    out = set()
    for d, t in docs:
        w, end, begin = blank_words(t), None, None
        for i in range(len(w) - min_words + 1):
            if len(seen[tuple(w[i:i + min_words])]) > 1:
                if end is not None and i <= end:
                    end = i + min_words
                else:
                    if end is not None:
                        out.add((d, begin, end))
                    begin, end = i, i + min_words
        if end is not None:
            out.add((d, begin, end))
    return out


def license_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if w]


def licenses(texts, phrases, templates, rarest=3):
    """(n_words, starts, base labels, labels) of each text."""
    words = [license_words(t) for t in texts]
    vocab = {w for p, _ in phrases for w in p.split()} | {w for _, t, _ in templates for w in t.split()}
    df = {v: sum(v in set(ws) for ws in words) for v in vocab}
    out = []
    for ws in words:
        def at(phrase, ws=ws):
            p = phrase.split()
            return [i for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]

        starts = sorted(s for p, _ in phrases for s in at(p))
        base = {label for p, label in phrases if at(p)}
        more = set()
        for label, t, keys in templates:
            tw = t.split()
            once = sorted((w for w in set(tw) if tw.count(w) == 1), key=lambda w: (df[w], w))
            need = min(rarest, len(once))
            rare = [w for w in once if w in ws][:need]
            if len(rare) < need:
                continue
            agreed = set.intersection(*({i - tw.index(w) for i, x in enumerate(ws) if x == w} for w in rare))
            for s in agreed:
                if all(s + o in at(k) for k in keys for o in [next(i for i in range(len(tw)) if tw[i:i + len(k.split())] == k.split())]):
                    more.add(label)
        out.append((len(ws), starts, base, base | more))
    return out


def alnum_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def contaminated(text, item, similarity=0.8, min_words=13):
    """Whether the item, or a long enough stretch of it, stands in the text along any alignment, with few other words."""
    a, b = alnum_words(item), alnum_words(text)
    if len(a) < 5:
        return False
    for shift in range(-len(a) + 1, len(b)):
        same = [0 <= shift + i < len(b) and b[shift + i] == w for i, w in enumerate(a)]
        if sum(same) < 4:
            continue
        if sum(same) >= similarity * len(a):
            return True
        for i in range(len(a)):
            for j in range(i + min_words, len(a) + 1):
                if sum(same[i:j]) >= similarity * (j - i) - 1e-9:
                    return True
    return False


def mixed(docs, weights=(5, 2, 1), most=2):
    """Copies of each (doc_id, text, source), in order, by the definition of systematic sampling."""
    import hashlib
    import math

    size = [len(blank_words(t)) for _, t, _ in docs]
    total = {}
    for n, (_, _, s) in zip(size, docs):
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(total.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * total[s]}
        if not over:
            target |= {s: level * w[s] for s in open_}
            break
        for s in over:
            target[s] = most * total[s]
            left -= target[s]
        open_ -= over
    copies = [0] * len(docs)
    for s in order:
        own = sorted((i for i in range(len(docs)) if docs[i][2] == s), key=lambda i: (size[i], docs[i][0] is not None, docs[i][0] or 0))
        c = target[s] / total[s] if total[s] else 0.0
        u = int(hashlib.md5(f"42:{s or ''}".encode()).hexdigest()[:8], 16) / 2 ** 32
        for k, i in enumerate(own):
            copies[i] = math.floor((k + 1) * c + u) - math.floor(k * c + u)
    return copies


def merkle(rows, tampered):
    """(doc_id, leaf, subroot, root, digest of the siblings, folded root, verified) of each (doc_id, source, lang, n_chars, text)."""
    import hashlib

    def h(s):
        return hashlib.sha256(s.encode()).hexdigest()

    def leaf(r):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            folded, others = leaf((*r[:4], lower(r[4]))) if r[4] is not None and tampered(r[0]) else leaf(r), ""
            for tree, at in ((trees[g], i), (top, k)):
                for level in tree[:-1]:
                    run, place = level[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    others += "".join(run[:place] + run[place + 1:])
                    folded, at = h("".join(run[:place] + [folded] + run[place + 1:])), at // 8
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h(others), folded, folded == top[-1][0]))
    return out


def filter_steps(docs, labels):
    """(part, order, step) -> counts, by running every order over the documents (doc_id, source, text)."""
    from itertools import permutations

    first = {}
    for d, _, t in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}

    def fails(d, text):
        t = text or ""
        w = blank_words(t)
        smaller = t in first and (d is None or first[t] < d)
        return {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                                            any(c in "#$%&*|" for c in t), smaller)) if x}

    parts = {}
    for d, s, t in docs:
        parts.setdefault(s or "", []).append((d, fails(d, t)))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                                          sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}
