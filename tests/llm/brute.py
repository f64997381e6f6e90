"""Plain versions of the operators, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def repeats(docs):
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 99):
            k = b[j : j + 100]
            if k in seen:
                gone[j : j + 100] = b"\x01" * 100
            seen.add(k)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(t):
    w = SPACE_WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_components(docs):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        ids[root(k)].append(i)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(docs)]


def contamination(docs, items):
    windows = {}
    for i, t in items:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        for j in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[j : j + 13]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def quality_counts(t):
    t = t or ""
    w = SPACE_WORD.findall(t)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = set()
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    base = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover), base


def ids_of(texts):
    import numpy as np
    from tokenizers import Tokenizer

    from starmill.llm.tokens import vocabulary_path

    t = Tokenizer.from_file(vocabulary_path())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for x in texts]


def crc(ids):
    return zlib.crc32(ids.tobytes())
