"""Awkward documents, and brute-force versions of what the operators define."""

from __future__ import annotations

import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, kept boolean, key_text string, fp string, score double, length long, _row_id long, _gone_text string, key_id long, _at string, _slot int, root long, `a.b` int"


def awkward(seed: int = 5) -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empties, one very long text, copies, near copies, shared passages, odd spaces."""
    r = random.Random(seed)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(r.choices(words, k=n))
    passage = prose(60)
    texts = [None, "", "   ", None, "one", "One two", "a b c", "A B C", "ÄÖ ä b  c", "x\ty\nz\x0bq\x0cr\rs", "İstanbul ſ K", "word " * 300]
    texts += [prose(r.randint(50, 200)) for _ in range(14)]
    texts += [texts[-1]] * 6 + [texts[-2].upper()] + [texts[-3] + " tail"] + [texts[-4].replace(" ", "  ", 1)]
    texts += [f"{prose(30)} {passage} {prose(20)}" for _ in range(5)] + [f"{passage} {passage}", prose(40_000)]
    texts += [f"{prose(60)}\nsame line here\nsame line here\n\n{prose(10)}", "# $ % & * | < > " * 40 + prose(20)]
    rows = [(k, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", None])) for k, t in enumerate(texts)]
    r.shuffle(rows)
    return [*rows, (None, "null id text " * 20, "en", "s1"), (None, texts[13], None, "s1"), rows[0], rows[1]]


def frame(spark, rows: list[tuple]):
    full = [(i, t, lang, src, None if t is None else len(t), 7, True, "k", "f", 0.5, 3, 1, "g", 2, "a", 4, 5, 6) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower_az(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def fingerprint(text: str | None) -> int:
    words = WORD.findall(lower_az(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows: list[tuple[int | None, int]], reach: int = 2) -> dict[int, int | None]:
    """Smallest id of each fingerprint's component."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= reach:
                parent[find(a)] = find(b)
    out = {}
    for f in fps:
        ids = [i for i, g in rows if i is not None and find(g) == find(f)]
        out[f] = min(ids) if ids else None
    return out


def removed(rows: list[tuple[int, str | None]], length: int = 20) -> dict[int, tuple[int, int, str]]:
    """id: (words, removed words, kept text)."""
    first, words = {}, {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - length + 1):
            first.setdefault(tuple(words[i][k : k + length]), (i, k))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] != (i, k):
                gone[k : k + length] = [True] * length
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out
