"""Repeated passages by difference-cover anchors.

A window of 20 words that also starts earlier is removed. Positions modulo 13 in the cover {0, 1, 3, 9}
have every difference: for starts i and j, some shift d < 13 puts both i + d and j + d on the cover. So
two equal windows share an aligned anchor, the 8 words from there, which lies inside both. Hence:

1. Anchors: only cover positions are hashed (4 of 13); each task sends its sorted hashes, twice where it
   has them twice; the hashes found twice or more are stored as sorted arrays.
2. Extension: a position with such an anchor is extended to the windows around it. Their 20 words are
   hashed (64 bits, and 32 more by another multiplier); each task sends the first occurrence of each in
   its block, and the first of all is stored in sorted arrays.
3. A candidate window is removed unless it is that first occurrence; what windows cover is cut out.

A hot passage costs one value a block of a task, not one an occurrence, and no pairs are formed. Memory is
bounded by the block (about a million words, or one text) and by buckets, whose number follows the number
of map tasks (see arrays). Texts are split three times, no text is shuffled. Two hashes stand for a window, 96 bits
together: among 10^13 windows the chance that any two share them is about 10^-3.

Defined results: null text has no words; a null id comes after all others, and every row with one is a document of
its own; rows that repeat an id with the same text count as one document, so none of them is removed for the other;
rows that repeat an id with other text are different documents; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.arrays import ROWS, batch, bits_for, buckets, dealt, more_bits, redealt, together, write_bucket
from sparkweft.llm.common import shared_folder
from sparkweft.llm.words import Windows, WordHashes, split_words
from sparkweft.session import cut_lineage

LENGTH, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
BLOCK_WORDS = 1_000_000
LAST_ID = np.iinfo(np.int64).max
#: Hash, second hash, id, what tells documents of an id apart, place.
_WINDOW = ["<u8", "<u4", "<i8", "<i8", "<i4"]
_OTHER = 0xD6E8FEB86659FD93


class Block:
    """The words of some texts, one after the other, with ids, bounds and hashes."""

    def __init__(self, ids: list, keys: list[int], texts: list[str | None], hashes: WordHashes):
        self.ids, self.keys = ids, keys
        self.words = [split_words(t or "") for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.array([0, *accumulate(self.sizes.tolist())], np.int64)
        self.hashes = np.concatenate([hashes.of(w) for w in self.words]) if self.words else np.empty(0, np.uint64)

    def within(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word: its place in its text, and the places left from it to the text's end."""
        at = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.sizes)
        return at, np.repeat(self.sizes, self.sizes) - at


def blocks(batches: Iterator[pa.RecordBatch], hashes: WordHashes, most: int = BLOCK_WORDS) -> Iterator[Block]:
    ids, keys, texts, chars = [], [], [], 0
    for b in batches:
        for one, key, text in zip(b["id"], b["key"], b["text"], strict=True):
            ids.append(one.as_py())
            keys.append(key.as_py())
            texts.append(text.as_py())
            chars += len(texts[-1] or "")
            if chars >= 6 * most:
                yield Block(ids, keys, texts, hashes)
                ids, keys, texts, chars = [], [], [], 0
    if ids:
        yield Block(ids, keys, texts, hashes)


class Finder:
    """Anchors and candidate windows of a block."""

    def __init__(self, length: int, period: int, cover: tuple[int, ...]):
        self.length, self.period, self.anchor = length, period, length - period + 1
        self.on = np.zeros(period, bool)
        self.on[list(cover)] = True
        self.rolling, self.other = Windows(), Windows(_OTHER)

    def anchors(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and hashes of the anchors of texts that have a window; the prefix sums."""
        at, left = block.within(self.anchor)
        sums = self.rolling.sums(block.hashes)
        starts = np.flatnonzero(self.on[at % self.period] & (left >= self.anchor) & (at + left >= self.length))
        return starts, self.rolling.at(sums, self.anchor, starts), sums

    def windows(self, block: Block, folder: str, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, hashes and second hashes of the windows around anchors that are found twice."""
        starts, h, sums = self.anchors(block)
        order = np.argsort(h)
        ordered, twice = h[order], np.zeros(len(h), bool)
        for (known,), part in buckets(folder, "anchor", ["<u8"]).parts(ordered, bits):
            if len(known):
                k = np.minimum(np.searchsorted(known, ordered[part]), len(known) - 1)
                twice[part] = known[k] == ordered[part]
        hit = starts[order[twice]]
        # A window starts at most period - 1 words before an anchor in it, and ends within its text.
        step = np.zeros(len(block.hashes) + 1, np.int32)
        at, left = block.within(self.length)
        np.add.at(step, hit - np.minimum(at[hit], self.period - 1), 1)
        np.add.at(step, hit + 1, -1)
        found = np.flatnonzero((np.cumsum(step[:-1]) > 0) & (left >= self.length))
        other = self.other.at(self.other.sums(block.hashes), self.length, found)
        return found, self.rolling.at(sums, self.length, found), (other >> np.uint64(32)).astype(np.uint32)


def _keys(block: Block, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id (nulls last), key and place in the text of each start."""
    row = np.searchsorted(block.first, starts, side="right") - 1
    ids = np.array([LAST_ID if i is None else i for i in block.ids], np.int64)
    return ids[row], np.array(block.keys, np.int64)[row], (starts - block.first[row]).astype(np.int32)


def store_anchors(rows: DataFrame, folder: str, bits: int, length: int, period: int, cover: tuple[int, ...]) -> int:
    """Write the anchors found twice or more; returns their number."""
    more = more_bits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, hashes = Finder(length, period, cover), WordHashes()
        for block in blocks(batches, hashes):
            h = np.sort(finder.anchors(block)[1])
            if not len(h):
                continue
            first = np.concatenate([[True], h[1:] != h[:-1]])
            second = np.concatenate([[False], ~first[1:] & first[:-1]])
            h = h[first | second]
            yield batch(dealt(0, 0, (h >> np.uint64(64 - bits)).astype(np.int64), [h], more))

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h = np.sort(together(part)[0].view(np.uint64))
        same = h[1:] == h[:-1]
        twice = np.unique(h[1:][same])
        if len(twice):
            write_bucket(folder, f"anchor{int(key[0])}", [twice])
        return pd.DataFrame({"n": [len(twice)]})

    done = redealt(rows.mapInArrow(run, ROWS), more).groupBy("bucket").applyInPandas(merge, "n long")
    return done.agg(F.sum("n")).first()[0] or 0


def store_windows(rows: DataFrame, folder: str, bits: int, length: int, period: int, cover: tuple[int, ...]) -> int:
    """Write the first occurrence of each window found twice or more; returns their number."""
    more = more_bits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, hashes = Finder(length, period, cover), WordHashes()
        for block in blocks(batches, hashes):
            starts, h, c = finder.windows(block, folder, bits)
            if not len(starts):
                continue
            ids, keys, at = _keys(block, starts)
            order = np.lexsort((at, keys, ids, c, h))
            h, c, ids, keys, at = h[order], c[order], ids[order], keys[order], at[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
            # A row that repeats id, key and place is the same occurrence, not a second one.
            again = ~new[1:] & ((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] != at[:-1]))
            many = np.add.reduceat(np.concatenate([[0], again]), np.flatnonzero(new)) > 0
            h, c, ids, keys, at = h[new], c[new], ids[new], keys[new], at[new]
            yield batch(dealt(0, 0, (h >> np.uint64(64 - bits)).astype(np.int64), [h, c, ids, keys, at, many], more))

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h, c, ids, keys, at, many = (x.astype(k) for x, k in zip(together(part), [*_WINDOW, "|u1"], strict=True))
        order = np.lexsort((at, keys, ids, c, h))
        h, c, ids, keys, at, many = h[order], c[order], ids[order], keys[order], at[order], many[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        again = np.concatenate([[False], ~new[1:] & ((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (at[1:] != at[:-1]))]) | (many > 0)
        heads = np.flatnonzero(new)
        keep = heads[np.add.reduceat(again.astype(np.int64), heads) > 0]
        if len(keep):
            write_bucket(folder, f"window{int(key[0])}", [h[keep], c[keep], ids[keep], keys[keep], at[keep]])
        return pd.DataFrame({"n": [len(keep)]})

    done = redealt(rows.mapInArrow(run, ROWS), more).groupBy("bucket").applyInPandas(merge, "n long")
    return done.agg(F.sum("n")).first()[0] or 0


def repeats(block: Block, finder: Finder, folder: str, bits: int) -> np.ndarray:
    """For each word of the block: whether a window that also starts earlier covers it."""
    starts, h, c = finder.windows(block, folder, bits)
    covered = np.zeros(len(block.hashes) + 1, np.int32)
    if len(starts):
        order = np.argsort(h, kind="stable")
        starts, h, c = starts[order], h[order], c[order]
        ids, keys, at = _keys(block, starts)
        gone = np.zeros(len(h), bool)
        for (kh, kc, kd, kk, ks), part in buckets(folder, "window", _WINDOW).parts(h, bits):
            k, left = np.searchsorted(kh, h[part]), np.arange(part.start, part.stop)
            while len(left):
                there = k < len(kh)
                k, left = k[there], left[there]
                equal = kh[k] == h[left]
                k, left = k[equal], left[equal]
                found = kc[k] == c[left]
                gone[left[found]] = (kd[k[found]] != ids[left[found]]) | (kk[k[found]] != keys[left[found]]) | (ks[k[found]] != at[left[found]])
                k, left = k[~found] + 1, left[~found]
        np.add.at(covered, starts[gone], 1)
        np.add.at(covered, starts[gone] + finder.length, -1)
    return np.cumsum(covered[:-1]) > 0


def _keyed(rows: DataFrame) -> DataFrame:
    """rows with key: below zero by the text's hash for a given id, from zero on a number of its own for a null id.

    The numbers must be the same in every pass, so rows without an id, if there are any, are checkpointed with them.
    """
    by_text = F.bitwise_not(F.shiftrightunsigned(F.xxhash64("text"), 1))
    unknown = rows.filter("id is null")
    if unknown.select("id").isEmpty():
        return rows.withColumn("key", by_text)
    return rows.filter("id is not null").withColumn("key", by_text).unionByName(cut_lineage(unknown.withColumn("key", F.monotonically_increasing_id())))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER, with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 for each row, and kept_text if asked for (kept words joined by one space)."""
    if len({(a - b) % period for a in cover for b in cover}) < period or length < period:
        raise ValueError("cover must have every difference modulo period, and period must not exceed length")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = _keyed(rows)
    bits = bits_for(rows.rdd.getNumPartitions())
    folder = shared_folder(spark, "passages")
    store_anchors(rows, folder, bits, length, period, cover)
    store_windows(rows, folder, bits, length, period, cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, hashes = Finder(length, period, cover), WordHashes()
        for block in blocks(batches, hashes):
            gone = repeats(block, finder, folder, bits)
            n_gone, digests, kept_texts = [], [], []
            for words, a, b in zip(block.words, block.first[:-1], block.first[1:], strict=True):
                cut = gone[a:b]
                n = int(cut.sum())
                kept = " ".join(words if not n else [words[i] for i in np.flatnonzero(~cut)])
                n_gone.append(n)
                digests.append(hashlib.sha256(kept.encode("utf-8")).hexdigest())
                if with_text:
                    kept_texts.append(kept)
            out = {"id": pa.array(block.ids, pa.int64()), "n_words": pa.array(block.sizes), "n_removed": pa.array(n_gone, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            yield pa.record_batch(out | ({"kept_text": pa.array(kept_texts, pa.string())} if with_text else {}))

    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
