"""Plain versions that the operators are held against."""

import hashlib
import random
import re


def words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


NONE = 2**63 - 1


def first_documents(rows, window):
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, NONE), NONE if doc is None else doc)
    return first


def removed(rows, window):
    first, out = first_documents(rows, window), []
    for doc, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (NONE if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def spans(rows, window):
    first, out = first_documents(rows, window), set()
    for doc, text in set(rows):
        w, run = words(text), None
        for i in range(len(w) - window + 1):
            source = first[tuple(w[i:i + window])]
            if source < (NONE if doc is None else doc):
                if run and i < run[1]:
                    run = (run[0], i + window, min(run[2], source))
                else:
                    if run:
                        out.add((doc, *run))
                    run = (i, i + window, source)
        if run:
            out.add((doc, *run))
    return out


def patchwork(seed, vocabulary, documents=100):
    """Documents pasted from shared pieces, with a null text, repeated rows, a repeated id and a null id."""
    rnd = random.Random(seed)
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 120))] for _ in range(12)]
    rows = []
    for doc in range(documents):
        text = []
        for _ in range(rnd.randrange(0, 4)):
            piece = rnd.choice(base)
            at = rnd.randrange(len(piece))
            text += piece[at:at + rnd.randrange(5, 90)] + [rnd.choice(vocabulary) for _ in range(rnd.randrange(3))]
        rows.append((doc, None if doc == 7 else " \n".join(text) + rnd.choice(["", "\n", " "])))
    return rows + rows[3:6] + [(4, rows[9][1]), (None, rows[10][1])]


def components(ids, near):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if near(a, b):
                parent[find(a)] = find(b)
    least = {}
    for i in ids:
        least[find(i)] = min(least.get(find(i), i), i)
    return {i: least[find(i)] for i in ids}


def mix_targets(sizes, weights=(5, 2, 1), repeat=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > repeat * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = repeat * sizes[s]
            left -= target[s]
            free.remove(s)
    return target
