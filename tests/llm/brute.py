"""Plain single-process versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def line_dedup(docs, min_chars=20, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(list)
    for d, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(d)
    out = {}
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or d == max(holders[key(x)])]
        out[d] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def suffix_dedup(docs, width=200):
    count = Counter()
    for _, text in docs:
        b = (text or "").encode()
        count.update(b[i : i + width] for i in range(len(b) - width + 1))
    out = {}
    for d, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_dedup(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and min(len(x), len(y)) * 100 >= 85 * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= 85 * (len(x) + len(y) - n):
                    ra, rb = root(a), root(b)
                    parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(x), root(d), root(d) == d) for d, x in sets}


def decontaminate(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, text in items:
        w = word.findall((text or "").translate(LOWER))
        if w:
            for k in range(max(1, len(w) - 9)):
                windows[tuple(w[k : k + 10])].add(str(i))
    lengths = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, found = bytearray(len(w)), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit[k : k + n] = b"\1" * n
                    found |= windows[x]
        out[d] = (len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit))
    return out


def edited(docs):
    order = sorted(docs, key=lambda x: -x[0])
    out = {}
    for (d, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        n = len(text) // 3
        out[d] = (len(text), text[: len(text) - n] + after[:n])
    return out


def simhash(text):
    """128 bits, each the majority of the signed votes of all pairs of neighbouring words (of the word, where it is alone)."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    pairs = list(zip(words, words[1:], strict=False)) or [(w, "") for w in words]
    votes = [0] * 128
    for a, b in pairs:
        first = xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))
        second = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), xxhash.xxh64_intdigest(first.to_bytes(8, "little"), 42))
        for k in range(64):
            votes[k] += 1 if first >> k & 1 else -1
            votes[64 + k] += 1 if second >> k & 1 else -1
    return sum(1 << k for k in range(64) if votes[k] > 0), sum(1 << k for k in range(64) if votes[64 + k] > 0)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ("assign", "access", "hex")
    n = [sum(k == j for _, k, _ in spans) for j in range(3)]
    return (*n, sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))))
