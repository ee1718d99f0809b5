"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def simhash(text: str | None, shingle: int = 4) -> int:
    w = SPACE_WORD.findall(ascii_lower(text or ""))
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def components(nodes, linked) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}


def simhash_groups(docs: list[tuple[int, str]], max_bits: int = 4) -> dict[int, tuple[str, int]]:
    fp = {i: simhash(t) for i, t in docs}
    ids = sorted(fp)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fp[a] ^ fp[b]).bit_count() <= max_bits]
    group = components(ids, pairs)
    return {i: (f"{fp[i]:016x}", group[i]) for i in ids}


PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str | None) -> list[str]:
    return PLAIN_WORD.findall(ascii_lower(text or ""))


def contained(docs: list[tuple], items: list[tuple], threshold: float = 0.8, n: int = 5) -> set[tuple]:
    def grams(w, k):
        return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}

    out = set()
    for item_id, item in items:
        w = plain_words(item)
        k = min(n, len(w))
        if not k:
            continue
        s = grams(w, k)
        out |= {(d, item_id) for d, text in docs if len(s & grams(plain_words(text), k)) >= threshold * len(s) - 1e-9}
    return out


def base_quality(text: str | None, window: int = 8) -> tuple:
    t = text or ""
    w = SPACE_WORD.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    spans = [tuple(w[i:i + window]) for i in range(len(w) - window + 1)]
    covered = {k for i, s in enumerate(spans) if spans.count(s) > 1 for k in range(i, i + window)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


BASE_PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def base_licenses(text: str | None) -> tuple:
    w, at = plain_words(text), []
    for label, phrase in BASE_PHRASES.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x[1] for x in at})))


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Water-filling: share the total by weight, stop at ``most`` times a source's size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        share = left / open_ if open_ else 0
        new = {s for s in names if s not in full and weight[s] * share > most * sizes[s]}
        if not new:
            return {s: most * sizes[s] if s in full else weight[s] * share for s in names}
        full |= new
