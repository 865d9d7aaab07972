"""Plain single-machine versions of the operators, for small tables."""

import hashlib

import numpy as np


def removed_bytes(docs, window):
    """{place of the row: flags of removed bytes} for rows (doc_id, text), None first, equal rows one document."""
    rows = sorted({(i is not None, i or 0, i, t or "") for i, t in docs}, key=lambda r: r[:2])
    seen, out = set(), {}
    for _, _, i, text in rows:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - window + 1):
            part = data[at : at + window]
            if part in seen:
                gone[at : at + window] = True
            seen.add(part)
        out[i, text] = gone
    return out


def removal_rows(docs, window):
    out = []
    flags = removed_bytes(docs, window)
    for i, t in docs:
        data, gone = (t or "").encode(), flags[i, t or ""]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def thinned_lines(docs, min_docs=5, min_chars=40):
    blanks = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blanks).translate(lower)
    holders = {}
    rank = lambda i: -(2**63) if i is None else i
    for i, t in docs:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(rank(i))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and rank(i) != max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def roots(nodes, links):
    """Smallest node reachable from each."""
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            top[n] = top[top[n]]
            n = top[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def vector_rows(rows, cosine=0.93):
    """(id, links, component) of rows (id, vector, label) with distinct ids."""
    good = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v, dtype=float), label)
    links = []
    ids = sorted(good)
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            (v, a), (w, b) = good[ids[x]], good[ids[y]]
            if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                links.append((ids[x], ids[y]))
    top = roots([r[0] for r in rows], links)
    count = {}
    for a, b in links:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    return [(i, count.get(i, 0), top[i]) for i, _, _ in rows]
