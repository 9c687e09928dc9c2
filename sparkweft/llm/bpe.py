"""Byte-level BPE by a segment tree over byte positions.

A pre-token's leaves are its byte positions; a leaf holds the rank of merging the part that starts there
with the next live part, and a node the smallest rank below it, leftmost on ties. A merge reads the root,
joins the two parts, and updates three leaves (the joined part, its left neighbour, the part that went)
and their ancestors: O(log n) each, so a run of n bytes without a boundary costs O(n log n), not O(n^2).

Every pre-token that is no token itself goes through such a tree. New pre-tokens of a batch of texts have their
trees side by side in arrays, by width, and each step merges once in all of them (`merge_many`); long runs, and a
pre-token on its own, have a tree of their own (`merge`).

Texts are cut into pieces at single spaces and line ends between other characters, where the pattern
always has a boundary; encoded pieces are remembered up to a bound. Other white space goes the plain way,
pre-token by pre-token. Tables of ranks are a parameter (a file's path).

Defined results: null text is empty and has no ids; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A leaf without a merge; other leaves are the rank above _AT bits of position, so the least is also the leftmost.
NONE = 1 << 60
_AT = 32
_PLACE = (1 << _AT) - 1
#: Pre-tokens of more bytes have a tree of their own; texts are learned together up to this many characters.
WIDEST, TOGETHER = 64, 2_000_000
#: White space besides the space and the line end, in any version of Unicode's tables.
OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, (9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))


def odd_space(text: str) -> bool:
    """Whether spaces and line ends are not the only white space, or do not each stand alone between other characters."""
    return not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or OTHER_SPACE.search(text) is not None


def pieces(text: str) -> tuple[str, list[str]] | None:
    """What is before the first space or line end, and the pieces after each: a space is taken off, a line end stays
    at its piece's front. None if cutting there isn't safe."""
    if odd_space(text):
        return None
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def whole(piece: str) -> str:
    """A piece as it stands in the text."""
    return piece if piece[0] == "\n" else " " + piece


class Pairs:
    """Rank of joining two tokens, for arrays of them: a table with open addressing, from all ways to split a token in two."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[a], ranks[b], r) for t, r in ranks.items() for k in range(1, len(t)) if (a := t[:k]) in ranks and (b := t[k:]) in ranks]
        left, right, self.rank = np.array(found or [(0, 0, NONE >> _AT)], np.int64).T
        self.bits = max(4, (4 * len(left) - 1).bit_length())
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        keys = left << _AT | right
        slot, left_over = self._slot(keys), np.arange(len(keys))
        while len(left_over):
            free = left_over[self.keys[slot[left_over]] < 0]
            self.keys[slot[free]], self.at[slot[free]] = keys[free], free
            # Where several wanted a slot, the last one got it (both arrays are written in the same order).
            left_over = left_over[self.keys[slot[left_over]] != keys[left_over]]
            slot[left_over] = (slot[left_over] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank above _AT bits of zeros, or NONE."""
        keys = left.astype(np.int64) << _AT | right
        slot, out, ask = self._slot(keys), np.full(len(keys), NONE, np.int64), np.arange(len(keys))
        while len(ask):
            there = self.keys[slot[ask]]
            hit = ask[there == keys[ask]]
            out[hit] = self.rank[self.at[slot[hit]]] << _AT
            ask = ask[(there >= 0) & (there != keys[ask])]
            slot[ask] = (slot[ask] + 1) & ((1 << self.bits) - 1)
        return out


def merge(part: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token, by a tree of its own: node k has the children 2k and 2k + 1, leaf i is node width + i."""
    if part in ranks:
        return [ranks[part]]
    n, get = len(part), ranks.get
    width = 1 << max(0, (n - 1).bit_length())
    after, before = list(range(1, n + 2)), list(range(-1, n))  # where the part that starts here ends; where the one that ends here starts
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        r = get(part[i : i + 2])
        if r is not None:
            tree[width + i] = r << _AT | i
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                return
            tree[k] = low

    def joined(i: int) -> int:
        """What the leaf of the part that starts at i holds."""
        j = after[i]
        r = get(part[i : after[j]]) if j < n else None
        return NONE if r is None else r << _AT | i

    while tree[1] != NONE:
        i = tree[1] & _PLACE
        gone = after[i]
        end = after[i] = after[gone]
        if end < n:
            before[end] = i
        put(gone, NONE)
        put(i, joined(i))
        if before[i] >= 0:
            put(before[i], joined(before[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[part[i : after[i]]])
        i = after[i]
    return out


def merge_many(parts: list[bytes], single: np.ndarray, pairs: Pairs) -> list[bytes]:
    """Ids (little-endian, 32 bits) of pre-tokens of at most WIDEST bytes, their trees side by side; single: the ids of the 256 bytes."""
    out = [b""] * len(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    widths = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        for at in range(0, len(rows), 1 << 14):
            own = rows[at : at + (1 << 14)]
            for row, ids in zip(own.tolist(), _merged([parts[k] for k in own], sizes[own], width, single, pairs), strict=True):
                out[row] = ids
    return out


def _merged(parts: list[bytes], n: np.ndarray, width: int, single: np.ndarray, pairs: Pairs) -> list[bytes]:
    m = len(parts)
    ids = single[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8)].astype(np.int64)
    place = np.tile(np.arange(width), m)
    size = np.repeat(n, width)
    # One position more a row, for what begins after the last byte; flat arrays, row after row.
    after, before = np.tile(np.arange(1, width + 2), m), np.tile(np.arange(-1, width), m)
    tree = np.full((m, 2 * width), NONE, np.int64)
    has_next = np.flatnonzero(place < size - 1)
    leaves = np.full(m * width, NONE, np.int64)
    leaves[has_next] = pairs(ids[has_next], ids[has_next + 1])
    tree[:, width:] = np.where(leaves < NONE, leaves | place, NONE).reshape(m, width)
    for level in range(width.bit_length() - 2, -1, -1):
        k = 1 << level
        tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
    tree, live = tree.ravel(), np.arange(m)
    while True:
        root = tree[live * (2 * width) + 1]
        live, root = live[root < NONE], root[root < NONE]
        if not len(live):
            break
        i, row, nodes, ends = root & _PLACE, live * (width + 1), live * (2 * width), n[live]
        gone = after[row + i]
        end = after[row + gone]
        after[row + i] = end
        before[row + np.minimum(end, width)] = i
        ids[live * width + i] = root >> _AT
        # The three leaves that change: the part that went, the joined one, and its left neighbour (else the joined one again).
        left = np.where(before[row + i] >= 0, before[row + i], i)
        changed = np.concatenate([i, left])
        row2, base2, ends2 = np.concatenate([row, row]), np.concatenate([live, live]) * width, np.concatenate([ends, ends])
        following = after[row2 + changed]
        can = following < ends2
        value = np.full(len(changed), NONE, np.int64)
        value[can] = pairs(ids[(base2 + changed)[can]], ids[(base2 + following)[can]])
        value[value < NONE] |= changed[value < NONE]
        nodes3 = np.concatenate([nodes, nodes, nodes])
        k = np.concatenate([gone, changed]) + width
        tree[nodes3 + k] = np.concatenate([np.full(len(gone), NONE, np.int64), value])
        for _ in range(width.bit_length() - 1):
            k >>= 1
            below = nodes3 + 2 * k
            tree[nodes3 + k] = np.minimum(tree[below], tree[below + 1])
    starts = np.zeros((m, width + 1), bool)
    starts[:, 0] = True
    after = after.reshape(m, width + 1)
    at, going = np.zeros(m, np.int64), np.arange(m)
    while len(going):
        at[going] = after[going, at[going]]
        going = going[at[going] < n[going]]
        starts[going, at[going]] = True
    kept = starts[:, :width].ravel()
    flat, counts = ids[kept].astype("<u4").tobytes(), starts[:, :width].sum(axis=1)
    edges = np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
    return [flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Memory(dict):
    """Remembers what `make` gives for the last keys: up to `most` of them, twice (younger and older)."""

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self.put(key, found)
        return found

    def put(self, key, found) -> None:
        if len(key) > self.longest:
            return
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found

    def new(self, keys) -> list:
        """Those of keys that would have to be made, and are short enough to be remembered."""
        return [k for k in set(keys).difference(self, self.older) if len(k) <= self.longest]


class Codec:
    """Encodes and decodes by a table of ranks; remembers the ids (as little-endian 32-bit numbers) of up to `most` pieces."""

    def __init__(self, path: str, pattern: str, most: int = 400_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {i: b for b, i in self.ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.find = regex.compile(pattern).findall
        self.single = np.array([self.ranks[bytes([k])] for k in range(256)], np.int64)
        self.pairs = Pairs(self.ranks)
        self.words = Memory(lambda x: np.array(merge(x.encode("utf-8"), self.ranks), "<u4").tobytes(), most)
        self.known = Memory(lambda x: self.matches(whole(x)), most)

    def matches(self, text: str) -> bytes:
        """Ids of a text, each match of the pattern by itself."""
        return b"".join(map(self.words.__getitem__, self.find(text)))

    def encode(self, text: str) -> list[int]:
        return self._ids(text, pieces(text))

    def _ids(self, text: str, cut: tuple[str, list[str]] | None) -> list[int]:
        data = self.matches(text) if cut is None else b"".join([self.matches(cut[0]), *map(self.known.__getitem__, cut[1])])
        return np.frombuffer(data, "<u4").tolist()

    def learn(self, cuts: list[tuple[str, list[str]] | None]) -> None:
        """Remembers the pieces of several texts that are new, their pre-tokens merged side by side."""
        new = self.known.new(chain.from_iterable(c[1] for c in cuts if c is not None))
        if not new:
            return
        # One after the other they are a text again, with the same boundaries.
        stood = list(map(whole, new))
        found = self.find("".join(stood))
        ends, cuts_at = np.cumsum([*map(len, found)]), np.cumsum([*map(len, stood)])
        at = np.searchsorted(ends, cuts_at)
        if len(ends) <= at[-1] or not (ends[at] == cuts_at).all():
            return  # a pattern without those boundaries: piece by piece, when they are asked for
        words, short = [], []
        for x in self.words.new(found):
            part = x.encode("utf-8")
            if part in self.ranks:
                self.words.put(x, self.ranks[part].to_bytes(4, "little"))
            elif len(part) <= WIDEST:
                words.append(x)
                short.append(part)
        for x, ids in zip(words, merge_many(short, self.single, self.pairs), strict=True):
            self.words.put(x, ids)
        get, begin = self.words.__getitem__, 0
        for x, end in zip(new, (at + 1).tolist(), strict=True):
            self.known.put(x, get(found[begin]) if end == begin + 1 else b"".join(map(get, found[begin:end])))
            begin = end

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; texts of up to TOGETHER characters in all are learned together."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars < TOGETHER):
                chars += len(texts[end])
                end += 1
            cuts = [pieces(t) for t in texts[at:end]]
            self.learn(cuts)
            yield from map(self._ids, texts[at:end], cuts)
            at = end

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One for each Python worker."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int), decoded (binary) for each row of docs."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def made(some: list[tuple]) -> pa.RecordBatch:
        one, ids, data = zip(*some, strict=True)
        return pa.record_batch({"id": pa.array(one, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(data, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            # Rows go out as soon as they hold as many bytes as are learned together.
            rows_, n = [], 0
            for one, ids in zip(b["id"].to_pylist(), c.encode_all([x or "" for x in b["text"].to_pylist()]), strict=True):
                rows_.append((one, np.array(ids, np.int32), c.decode(ids)))
                n += len(rows_[-1][2])
                if n >= TOGETHER:
                    yield made(rows_)
                    rows_, n = [], 0
            if rows_:
                yield made(rows_)

    return rows.mapInArrow(run, "id long, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: as encode(), without sending ids back to the JVM."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for ids in c.encode_all([x or "" for x in b["text"].to_pylist()]):
                n.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(c.names.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.record_batch({"id": b["id"], "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string())})

    return rows.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """rows with `decoded`: the bytes of its ids."""
    schema = rows.select("*", F.lit(b"").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            yield b.append_column("decoded", pa.array([c.decode(x.as_py() or []) for x in b[ids_col]], pa.binary()))

    return rows.mapInArrow(run, schema)
