"""Best-fit packing of token sequences: local best fit, then rounds over the underfull bins.

1. Each task cuts and packs what it reads, block by block, by best fit on falling lengths.
2. Underfull bins become items: those that have room for the smallest of them (no others can be joined with anything,
   then or later). They are dealt by a hash to groups of about `group_items`, and each group is packed by best fit
   again. Groups grow fourfold, up to `most_items`, when a round joins less than a fiftieth of its items.

Rounds end when no two bins that are left fit together: after best fit of one group of all that is left, or when the
two smallest exceed a bin. Every round that starts joins something, since the smallest item fits all of its group.

No task holds more than a block or a group (of pairs of numbers), whatever the input. A bin that was put into another
carries its offset; the maps of the rounds are composed, and joined to the pieces once.

Tokens: ids of the tokenizer's file (a parameter), then `end`. A sequence longer than `size` is cut
into pieces of `size`, the first one taking what is left over.

Defined results: null text is empty (one piece of one token); texts are encoded whole; repeated rows are packed
each for itself; an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.bpe import pieces, whole
from sparkweft.llm.common import materialise

SIZE, GROUP_ITEMS, MOST_ITEMS, BLOCK = 2048, 15_000, 1_000_000, 50_000
_TOGETHER = 32  # texts whose new pieces are encoded in one call
_ROWS = 512  # rows of a batch whose texts are strings at once


#: Fixed value: where byte-level tokenizers of this family cut.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces of characters that every version of Unicode's tables has in the same class, and no added token's mark.
_PLAIN = re.compile("[ \n][!-;=-~\xa1-\xac\xae-\u024f]+")


@lru_cache(maxsize=2)
def ranked(path: str):
    """(an encoder by ranks with the same ids, bytes of each id) for a byte-level BPE file whose merges are in the order of their ids and that changes nothing before; else (None, None)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    vocab = model["vocab"]
    first = len(vocab) - len(merges) - len({t["content"] for t in spec.get("added_tokens", ())} & vocab.keys())
    if spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or first != 256 or any(vocab.get(a + b) != first + k for k, (a, b) in enumerate(merges)):
        return None, None
    # Bytes that are no printable character stand in the file as characters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    added = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
    sizes = np.zeros(max(vocab.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(b) for b in ranks]
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


class Encoder:
    """Little-endian 32-bit ids of texts by a tokenizer's file; remembers up to 2 * most encoded pieces."""

    def __init__(self, path: str, most: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.known, self.older = most, {}, {}
        self.ranked, self.sizes = ranked(path)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, texts: list[str]) -> list[bytes]:
        """As _encode; plain pieces as one text (there is a cut between them) by ranks, tokens going back to pieces by their bytes."""
        plain = [t for t in texts if _PLAIN.fullmatch(t)] if self.ranked else []
        if not plain:
            return self._encode(texts)
        ids = np.array(self.ranked.encode_ordinary("".join(plain)), np.int64)
        ends = np.cumsum([len(t.encode("utf-8")) for t in plain])
        at = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(at, ends)
        if not (at[cuts] == ends).all():
            return self._encode(texts)
        data, edges = ids.astype("<u4").tobytes(), [0, *(4 * cuts + 4).tolist()]
        found = dict(zip(plain, (data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)), strict=True))
        others = [t for t in texts if t not in found]
        found.update(zip(others, self._encode(others) if others else [], strict=True))
        return [found[t] for t in texts]

    def of(self, texts: list[str]) -> Iterator[bytes]:
        """Pieces between which the tokenizer always cuts are encoded once; odd white space goes the plain way, as whole text."""
        for at in range(0, len(texts), _TOGETHER):
            part = texts[at : at + _TOGETHER]
            cuts = [pieces(t) for t in part]
            self._learn(set(chain.from_iterable(c[1] for c in cuts if c is not None)))
            heads = iter(self._encode([t if c is None else c[0] for t, c in zip(part, cuts, strict=True)]))
            for head, c in zip(heads, cuts, strict=True):
                yield head if c is None else b"".join([head, *map(self.known.__getitem__, c[1])])

    def _learn(self, wanted: set[str]) -> None:
        """Puts all of wanted among the known; when those are many, they become the older ones first."""
        if len(self.known) > self.most:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = wanted.difference(known)
        known.update((x, older[x]) for x in missing if x in older)
        new = [x for x in missing if x not in older]
        if new:
            known.update(zip(new, self._encode_pieces([*map(whole, new)]), strict=True))

    def forget(self) -> None:
        self.known, self.older = {}, {}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int, bytes]]:
    """(id, ids of the text) of each row. The pieces go with their task: a worker that waits, or works for another stage, takes its room from the same executor."""
    enc = encoder(path)
    try:
        for b in batches:
            for part in (b.slice(k, _ROWS) for k in range(0, b.num_rows, _ROWS)):
                yield from zip(part["id"].to_pylist(), enc.of([x or "" for x in part["text"].to_pylist()]), strict=True)
    finally:
        enc.forget()
        pa.default_memory_pool().release_unused()


def cut(n: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n - (n - 1) // size * size
    yield 0, first
    for start in range(first, n, size):
        yield start, size


def best_fit(lengths: Iterable[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill: falling lengths, each into the fullest bin that takes it."""
    lengths = np.asarray(lengths, np.int64)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fills: list[int] = []
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    there = 0  # bit f: a bin with f places left
    for k in np.argsort(-lengths, kind="stable"):
        n = int(lengths[k])
        fits = there >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                there ^= 1 << free
        else:
            free, b = size, len(fills)
            fills.append(0)
        bins[k], offsets[k] = b, fills[b]
        fills[b] += n
        left = free - n
        if left:
            by_free[left].append(b)
            there |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def tokenised(docs: DataFrame, path: str, end: int = 0, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32, bin, offset, fill: the pieces as first packed within their tasks (and ids, if asked for)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end], "<u4").tobytes()
        begun, made = TaskContext.get().partitionId() << 36, 0
        block: list[list] = [[] for _ in names]

        def packed() -> pa.RecordBatch:
            nonlocal made
            bins, offsets, fills = best_fit(block[3], size)
            out = {n: pa.array(v, k) for n, v, k in zip(names, block, kinds, strict=True)}
            out |= {"bin": pa.array(bins + (begun + made)), "offset": pa.array(offsets), "fill": pa.array(fills[bins])}
            made += len(fills)
            for v in block:
                v.clear()
            return pa.record_batch(out)

        for one, ids in encoded(batches, path):
            ids += tail
            for k, (start, n) in enumerate(cut(len(ids) // 4, size)):
                part = ids[4 * start : 4 * (start + n)]
                row = (one, k, start, n, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype(np.int32)] * with_ids))
                for v, x in zip(block, row, strict=True):
                    v.append(x)
            if len(block[0]) >= BLOCK:
                yield packed()
        if block[0]:
            yield packed()

    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + ", bin long, offset long, fill long"
    return rows.mapInArrow(run, schema)


def _round(items: DataFrame, level: int, groups: int, size: int) -> DataFrame:
    """bin, into, offset, fill: underfull bins packed into others, group by group."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("bin")
        bins, offsets, fills = best_fit(part["fill"], size)
        return pd.DataFrame({"bin": part["bin"], "into": bins + ((level << 56) + (int(key[0]) << 24)), "offset": offsets, "fill": fills[bins]})

    slot = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)).alias("slot")
    return items.select("bin", "fill", slot).groupBy("slot").applyInPandas(run, "bin long, into long, offset long, fill long")


def pack(pieces: DataFrame, size: int = SIZE, group_items: int = GROUP_ITEMS, most_items: int = MOST_ITEMS) -> DataFrame:
    """pieces (as from tokenised) with sequence_id and offset after all rounds."""
    under = pieces.filter((F.col("offset") == 0) & (F.col("fill") < size)).select("bin", "fill")
    moves, level = None, 0
    while True:
        least = under.agg(F.min("fill")).first()[0]
        if least is None or 2 * least > size:
            break
        items = under.filter(F.col("fill") <= size - least)
        n = items.count()
        if n < 2:
            break
        level, groups = level + 1, -(-n // group_items)
        moved = materialise(_round(items, level, groups, size), "packed")
        step = moved.select(F.col("bin").alias("_bin"), F.col("into").alias("_into"), F.col("offset").alias("_at"))
        if moves is None:
            moves = step
        else:
            step = step.withColumnsRenamed({"_bin": "_was", "_into": "_then", "_at": "_more"})
            both = moves.join(step, F.col("_into") == F.col("_was"), "left")
            moves = materialise(both.select("_bin", F.coalesce("_then", "_into").alias("_into"), (F.col("_at") + F.coalesce("_more", F.lit(0))).alias("_at")), "moves")
        if groups == 1:
            break
        under = moved.filter("offset = 0").select(F.col("into").alias("bin"), "fill").filter(F.col("fill") < size)
        if moved.filter("offset > 0").count() * 50 < n:
            group_items = min(4 * group_items, most_items)
    placed = pieces.drop("fill").withColumnRenamed("bin", "sequence_id")
    if moves is None:
        return placed
    joined = placed.join(moves, F.col("sequence_id") == F.col("_bin"), "left")
    return joined.withColumns({"sequence_id": F.coalesce("_into", "sequence_id"), "offset": F.col("offset") + F.coalesce("_at", F.lit(0))}).drop("_bin", "_into", "_at")


def pack_documents(docs: DataFrame, path: str, end: int = 0, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", group_items: int = GROUP_ITEMS) -> DataFrame:
    """Tokenise, cut and pack; one row a piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(materialise(tokenised(docs, path, end, size, id_col, text_col), "pieces"), size, group_items).withColumnRenamed("id", id_col)
