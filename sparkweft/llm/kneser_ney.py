"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, kept as sorted hash arrays that workers map.

Tokens are words after lower-casing A-Z and an end after each text; what precedes a text's first words is that end,
order - 1 times. Counting takes two passes over the training rows, each combined within its blocks first:

1. Words: counts by 64-bit hash, in sorted arrays; a word's id is its rank, so ids are dense.
2. Grams of the highest order as ids with counts, dealt to buckets by the words that context and suffix share (by the
   context in a model of two words); where these may hold more than twice a bucket's share they are spread over several.
   Each bucket becomes a sorted array of hashes and counts, another of what its contexts are followed by once, twice
   and more, and one of the grams of the order below, which are whole there.

Then no text is read again: the distinct grams of an order give the grams of the order below (their suffixes) with the
number of words that precede them; those that are not whole in a bucket are dealt by the gram, and so on down to words.
Contexts of one word have dense arrays by ranges of ids; longer ones that are spread are gathered by the context.

p(w | u v) = (c(u v w) - D(c)) / c(u v) + (D1 N1 + D2 N2 + D3 N3) / c(u v) * p(w | v) with the counts of words that
precede in place of c below the highest order, and 1 / (V + 1) below words, so unknown words have a share and p sums to
one; after an unseen context p is that of the order below. No counts are pruned: the model grows with the corpus, and
workers see it through the page cache.

Hashes: words are told apart by 64 bits of sums over their bytes, grams by 45 bits besides their bucket. A lookup among n
different grams of a bucket is wrong in about n of 2^45 cases, and then takes another's count: less than 1 of 10^8 with
100,000 a bucket.

Defined results: null text is the end alone; without training rows every token has probability one;
null flags of training count as false; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.arrays import ROWS, batch, bits_for, buckets, dealt, more_bits, planes, redealt, together, unplanes, write_bucket
from sparkweft.llm.common import shared_folder, shuffles_given_back
from sparkweft.llm.words import SPACE_RUN, lower_az, mixed

ORDER = 3
END = xxhash.xxh64_intdigest("\n")
BLOCK_CHARS = 3_000_000
_U = np.uint64
#: What a row of counts between stages is: grams of the next order, parts of contexts, or how many grams have which count.
_GRAMS, _CONTEXTS, _CLASSES = 0, 1, 2


#: What a byte of a text counts in the hash of its word, by its place: large letters as small ones, space and \\t to \\r nothing.
_BYTES = np.array([0 if SPACE_RUN.match(chr(b)) else int(mixed(np.array([lower_az(chr(b)).encode("latin1")[0] + 1], _U))[0]) for b in range(256)], _U)
_BY_PLACE = 0x9E3779B97F4A7C15
#: Bytes whose hashes are made at once.
_AT_ONCE = 1_000_000


def hashed_texts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts (UTF-8) that stand between the edges, and tokens of each text."""
    value = _BYTES[data]
    first = value != 0
    first[1:] &= ~first[:-1]
    heads = edges[:-1][edges[:-1] < len(data)]
    first[heads] = value[heads] != 0
    starts = np.flatnonzero(first)
    sizes = np.diff(np.searchsorted(starts, edges)) + 1
    out = np.full(len(starts) + len(sizes), END, _U)
    if len(starts):
        value = value[starts[0] :]
        starts = starts - starts[0]
        at = np.arange(len(value)) - np.repeat(starts, np.diff(np.append(starts, len(value))))
        powers = np.full(int(at.max()) + 1, _BY_PLACE, _U)
        powers[0] = 1
        is_word = np.ones(len(out), bool)
        is_word[np.cumsum(sizes) - 1] = False
        out[is_word] = mixed(np.add.reduceat(value * np.multiply.accumulate(powers)[at], starts))
    return out, sizes


class WordHashes:
    """Hash of a word by itself, as hashed_texts has it."""

    def __getitem__(self, word: str) -> int:
        data = np.frombuffer(word.encode(), np.uint8)
        return int(hashed_texts(data, np.array([0, len(data)]))[0][0])


def token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows of the batches' other columns, hashes of all tokens, tokens of each text)."""
    rows, parts, size = [], [], 0
    for b in batches:
        other = b.drop_columns("text").to_pylist()
        texts = b["text"].cast(pa.large_string()).fill_null("")
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(texts):
            z = max(a + 1, int(np.searchsorted(edges, edges[a] + _AT_ONCE, "right")) - 1)
            parts.append(hashed_texts(data[edges[a] : edges[z]], edges[a : z + 1] - edges[a]))
            rows += other[a:z]
            size += int(edges[z] - edges[a])
            a = z
            if size >= BLOCK_CHARS:
                yield rows, *(np.concatenate(x) for x in zip(*parts, strict=True))
                rows, parts, size = [], [], 0
    if parts:
        yield rows, *(np.concatenate(x) for x in zip(*parts, strict=True))


def numbered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the place among them of each."""
    codes, found = pd.factorize(h)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[codes]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted; the sums of their counts; where each first stands."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts, order[heads]


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from how many types have counts 1 to 4; fixed ones where a count is missing."""
    if min(n) <= 0:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]


def discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    return c - np.array([0.0, *d])[np.minimum(c, 3)]


def gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    """64 bits for each gram (ids of its words, from the first)."""
    h = np.full(len(ids[0]), len(ids), _U)
    for x in ids:
        h = mixed((h + x.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    return h


def windows(ids: np.ndarray, sizes: np.ndarray, end: int, order: int) -> list[np.ndarray]:
    """For each token: it and the order - 1 before it in its text (from the first), ends in place of what is missing."""
    at = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = []
    for back in range(order - 1, -1, -1):
        x = np.empty_like(ids)
        x[back:], x[:back] = ids[: len(ids) - back], end
        x[at < back] = end
        out.append(x)
    return out


class Shape:
    """Where the arrays are and what all workers need to know of them: a few numbers a bucket."""

    def __init__(self, folder: str, bits: int, order: int, offsets: np.ndarray, tokens: int):
        self.folder, self.bits, self.range_bits, self.order = folder, bits, max(4, bits - 4), order
        self.offsets, self.tokens, self.more = offsets, tokens, more_bits(bits)
        self.types = int(offsets[-1])
        self.span = max(1, -(-self.types // (1 << self.range_bits)))
        #: Words whose grams share a bucket of the highest order.
        self.core_span = max(1, -(-self.types >> bits))
        self.end = -1
        #: For each order: how many grams have the counts 1 to 4 and more; discounts; sum of counts.
        self.classes = {k: [0] * 5 for k in range(1, order + 1)}
        self.discounts = {k: [0.0] * 3 for k in range(1, order + 1)}
        self.total = dict.fromkeys(range(1, order + 1), 0)

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        table = buckets(self.folder, "vocab", ["<u8", "<i8"])
        of = (hashes >> _U(64 - self.bits)).astype(np.int64)
        for (h, c), part in table.parts(hashes, self.bits):
            if len(h):
                k = np.minimum(np.searchsorted(h, hashes[part]), len(h) - 1)
                same = h[k] == hashes[part]
                ids[part] = np.where(same, k + self.offsets[of[part.start]], -1)
                counts[part] = np.where(same, c[k], 0)
        return ids, counts

    def place(self, h: np.ndarray) -> np.ndarray:
        return (h >> _U(64 - self.bits)).astype(np.int64)

    def several(self, least: np.ndarray) -> np.ndarray:
        """Buckets of the highest order that a core is spread over, if it may hold twice a bucket's share; least: the count of its rarest word, which it cannot exceed."""
        return np.minimum(1 + least * (1 << self.bits) // max(2 * self.tokens, 1), 1 << self.bits)

    def home(self, core: list[np.ndarray]) -> np.ndarray:
        """Buckets of cores that are not spread; words' ids are in the order of their hashes, so ranges of them are as even."""
        return core[0] // self.core_span if len(core) == 1 else self.place(gram_hash(core))

    def top_place(self, gram: list[np.ndarray], several: np.ndarray) -> np.ndarray:
        """Buckets of grams of the highest order: by their core, the words that context and suffix share; of two words by the first."""
        more = mixed((gram[0] if len(gram) > 2 else gram[-1]).astype(_U) * _U(_BY_PLACE) + gram[-1].astype(_U)) % several.astype(_U)
        return (self.home(core_of(gram)) + more.astype(np.int64)) & ((1 << self.bits) - 1)


def core_of(gram: list[np.ndarray]) -> list[np.ndarray]:
    return gram[1:-1] if len(gram) > 2 else gram[:-1]


def _count_words(rows: DataFrame, folder: str, bits: int, order: int) -> Shape:
    more = more_bits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, _ in token_blocks(batches):
            keys, back = numbered(h)
            n = np.bincount(back, minlength=len(keys))
            yield batch(dealt(0, 0, (keys >> _U(64 - bits)).astype(np.int64), [keys, n], more))

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        h, n = together(part)
        h, n, _ = summed(h.view(_U), n)
        write_bucket(folder, f"vocab{int(key[0])}", [h, n])
        return pd.DataFrame({"bucket": [int(key[0])], "types": [len(h)], "tokens": [int(n.sum())]})

    # Three numbers a bucket come back: at most 2**20 rows, as arrays.
    done = redealt(rows.mapInArrow(run, ROWS), more).groupBy("bucket").applyInPandas(merge, "bucket long, types long, tokens long").toArrow()
    types = np.zeros(1 << bits, np.int64)
    types[done["bucket"].to_numpy()] = done["types"].to_numpy()
    shape = Shape(folder, bits, order, np.concatenate([[0], np.cumsum(types)]), int(done["tokens"].to_numpy().sum()))
    shape.end = int(shape.words(np.array([END], _U))[0][0])
    return shape


def _followed(context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each context first stands (in an order that sorts them), and its sum of counts and numbers of grams with counts 1, 2, more."""
    order = np.argsort(context, kind="stable")
    context, n = context[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    return order[heads], [np.add.reduceat(x, heads) for x in (n, *((np.minimum(n, 3) == c).astype(np.int64) for c in (1, 2, 3)))]


def _store_small(shape: Shape, name: str, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
    """Rows with counts of which the first is the largest: a byte each, and rows with 255 or more once more in full."""
    write_bucket(shape.folder, name, [*keys, *(np.minimum(c, 255).astype(np.uint8) for c in counts)])
    big = np.flatnonzero(counts[0] >= 255)
    if len(big):
        write_bucket(shape.folder, f"big-{name}", [big, *(c[big] for c in counts)])


def _small(shape: Shape, prefix: str, bucket: int, columns: list[np.ndarray], k: np.ndarray) -> np.ndarray:
    """The counts of rows k of what _store_small stored; columns: those of the counts."""
    out = np.stack([c[k] for c in columns]).astype(np.int64)
    big = np.flatnonzero(out[0] == 255)
    if len(big):
        row, *full = buckets(shape.folder, f"big-{prefix}", ["<i8"] * (1 + len(columns)))[bucket]
        out[:, big] = np.stack([c[np.searchsorted(row, k[big])] for c in full])
    return out


def _gram_keys(h: np.ndarray) -> np.ndarray:
    """Hashes turned so that the bits of the bucket come last."""
    return (h << _U(20)) | (h >> _U(44))


def _store_grams(shape: Shape, name: str, h: np.ndarray, n: np.ndarray) -> None:
    """Six bytes a gram: 45 bits of its hash and three of its count; counts from 7 on once more in full."""
    key = _gram_keys(h)
    order = np.argsort(key)
    key, n = key[order], n[order]
    write_bucket(shape.folder, name, [(key >> _U(32)).astype(np.uint32), ((key >> _U(16) & _U(0xFFF8)) | np.minimum(n, 7).astype(_U)).astype(np.uint16)])
    many = n >= 7
    if many.any():
        write_bucket(shape.folder, f"many-{name}", [key[many], n[many]])


def _store_contexts(shape: Shape, name: str, h: np.ndarray, counts: list[np.ndarray]) -> None:
    order = np.argsort(h)
    _store_small(shape, name, [h[order]], [c[order] for c in counts])


def _classes(level: int, n: np.ndarray) -> tuple:
    return _CLASSES, -1, level, [planes(np.append(np.bincount(np.minimum(n, 5), minlength=6)[1:6], n.sum()).astype("<i8"))]


def _below(shape: Shape, level: int, ids: list[np.ndarray], n: np.ndarray) -> list[tuple]:
    """What the levels below and the contexts need of whole grams of a level below the highest, or of two words."""
    out = [_classes(level, n)]
    if level == 2:  # contexts are words, with dense arrays by ranges of ids
        at, counts = _followed(ids[0], n)
        context = ids[0][at]
        out += dealt(_CONTEXTS, 2, context // shape.span, [context, *counts], shape.more)
    else:
        hashed = gram_hash(ids[:-1])
        at, counts = _followed(hashed, n)
        out += dealt(_CONTEXTS, level, shape.place(hashed[at]), [hashed[at], *counts], shape.more)
    # Each gram is one more word before its suffix.
    suffix, count, at = summed(gram_hash(ids[1:]) if level > 2 else ids[1], np.ones(len(n), np.int64))
    of = shape.place(suffix) if level > 2 else suffix // shape.span
    return out + dealt(_GRAMS, level - 1, of, [*(x[at] for x in ids[1:]), count], shape.more)


def _merge(shape: Shape, level: int, bucket: int, part: pd.DataFrame) -> list[tuple]:
    """Grams of a bucket: stored; what the levels below and the contexts need of them comes back as rows."""
    *ids, n = together(part)
    spread = ids.pop() if level == shape.order else None
    h, n, first = summed(gram_hash(ids), n)
    ids = [x[first] for x in ids]
    _store_grams(shape, f"grams{level}-{bucket}", h, n)
    if spread is None or level == 2:
        return _below(shape, level, ids, n)
    # Where the core is not spread, both the contexts and the suffixes are whole in this bucket.
    own = spread[first] == 1
    hashed = gram_hash(ids[:-1])
    at, counts = _followed(hashed, n)
    # A context with one gram seen once is known by its own gram below, unless it is made of ends.
    seen = own[at] & ((counts[0] > 1) | (ids[-2][at] == shape.end))
    _store_contexts(shape, f"own-{bucket}", hashed[at][seen], [c[seen] for c in counts])
    rest = ~own[at]
    out = [_classes(level, n), *dealt(_CONTEXTS, level, shape.place(hashed[at][rest]), [hashed[at][rest], *(c[rest] for c in counts)], shape.more)]
    suffix, count, at = summed(gram_hash(ids[1:]), np.ones(len(n), np.int64))
    whole = own[at]
    below = [x[at] for x in ids[1:]]
    if whole.any():
        _store_grams(shape, f"inner-{bucket}", suffix[whole], count[whole])
        out += _below(shape, level - 1, [x[whole] for x in below], count[whole])
    return out + dealt(_GRAMS, level - 1, shape.place(suffix[~whole]), [*(x[~whole] for x in below), count[~whole]], shape.more)


def _gather(shape: Shape, stage: int, key: tuple, part: pd.DataFrame) -> list[tuple]:
    """What came of a bucket of one kind and level: stored, or passed on until the stage after which no more of it can come."""
    kind, bucket, level = (int(x) for x in key)
    if kind == _CLASSES:
        return [(kind, bucket, level, [planes(np.sum([unplanes(c[0], "<i8") for c in part["cols"]], axis=0))])]
    if kind == _GRAMS and level > 1:
        if stage > shape.order - level:
            return _merge(shape, level, bucket, part)
        *ids, n = together(part)
        _, n, first = summed(gram_hash(ids), n)
        return dealt(kind, level, np.full(len(n), bucket), [*(x[first] for x in ids), n], shape.more)
    given, *columns = together(part)
    given = given.view(_U) if level > 2 else given
    keys, where = np.unique(given, return_inverse=True)
    counts = [np.bincount(where, c, minlength=len(keys)).astype(np.int64) for c in columns]
    if stage < shape.order and (level < shape.order or kind == _GRAMS):
        return dealt(kind, level, np.full(len(keys), bucket), [keys, *counts], shape.more)
    if level > 2:
        _store_contexts(shape, f"contexts{level}-{bucket}", keys, counts)
        return []
    dense = np.zeros((len(counts), shape.span), np.int64)
    dense[:, keys - bucket * shape.span] = counts
    _store_small(shape, f"{'words' if kind == _GRAMS else 'after'}-{bucket}", [], list(dense))
    return [_classes(1, dense[0])] if kind == _GRAMS else []


def _count_grams(rows: DataFrame, shape: Shape) -> None:
    order = shape.order

    def frame(made: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(made, columns=["kind", "bucket", "level", "cols"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, sizes in token_blocks(batches):
            distinct, back = numbered(h)
            known, counts = shape.words(distinct)
            ids = windows(known[back], sizes, shape.end, order)
            least = core_of(windows(counts[back], sizes, int(counts[np.searchsorted(distinct, _U(END))]), order))
            codes, found = pd.factorize(gram_hash(ids))
            n, first = np.bincount(codes), np.empty(len(found), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            # Sorted by a word of the core, which then takes little room in the shuffle.
            sort = np.argsort(core_of(ids)[0][first])
            first, n = first[sort], n[sort]
            ids = [x[first] for x in ids]
            spread = shape.several(np.min([x[first] for x in least], axis=0))
            of = shape.top_place(ids, spread)
            yield batch(dealt(_GRAMS, order, of, [*ids, np.minimum(spread, 2), n], shape.more))

    gather = lambda rows, stage: redealt(rows, shape.more, _CLASSES).groupBy("kind", "bucket", "level").applyInPandas(lambda key, part: frame(_gather(shape, stage, key, part)), ROWS)
    found = rows.mapInArrow(run, ROWS)
    for stage in range(1, order + 1):
        found = gather(found, stage)
    # Each stage sums the classes of the one before, so a row for each order and few more come back.
    for r in gather(found, order + 1).collect():
        *classes, total = unplanes(bytes(r["cols"][0]), "<i8").tolist()
        level = r["level"]
        shape.classes[level], shape.total[level] = classes, total
        shape.discounts[level] = discounts(classes[:4])


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> Shape:
    """Count the rows of docs and store the model; what comes back is small and goes to workers with the task."""
    if order < 2:
        raise ValueError("the order of the model is two at the least")
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    with shuffles_given_back(docs.sparkSession):
        shape = _count_words(rows, shared_folder(docs.sparkSession, "grams"), bits_for(rows.rdd.getNumPartitions()), order)
        if shape.types:
            _count_grams(rows, shape)
    return shape


def _in_buckets(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its rows), bucket by bucket."""
    # Numbers of 16 bits are sorted by their digits.
    order = np.argsort(of.astype(np.uint16) if len(of) and of.max() < 1 << 16 else of, kind="stable")
    own = of[order]
    edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)] if len(own) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(own[a]), order[a:b]


def _contexts(shape: Shape, prefix: str, of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Sum of counts and numbers of grams with counts 1, 2, more of contexts, by their hashes and buckets."""
    out = np.zeros((4, len(keys)), np.int64)
    table = buckets(shape.folder, prefix, ["<u8"] + ["|u1"] * 4)
    for bucket, rows in _in_buckets(of):
        h, *columns = table[bucket]
        if len(h):
            k = np.minimum(np.searchsorted(h, keys[rows]), len(h) - 1)
            hit = h[k] == keys[rows]
            out[:, rows[hit]] = _small(shape, prefix, bucket, columns, k[hit])
    return out


def _gram_counts(shape: Shape, prefix: str, of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Counts of grams by their hashes and buckets."""
    out = np.zeros(len(keys), np.int64)
    keys = _gram_keys(keys)
    high, low = (keys >> _U(32)).astype(np.uint32), (keys >> _U(19) & _U(0x1FFF)).astype(np.uint16)
    table = buckets(shape.folder, prefix, ["<u4", "<u2"])
    for bucket, rows in _in_buckets(of):
        h, rest = table[bucket]
        k = np.searchsorted(h, high[rows])
        while True:  # grams that share 32 bits stand side by side
            there = np.flatnonzero(k < len(h))
            there = there[h[k[there]] == high[rows[there]]]
            rows, k = rows[there], k[there]
            if not len(rows):
                break
            found = rest[k]
            same = found >> 3 == low[rows]
            out[rows[same]] = found[same] & 7
            rows, k = rows[~same], k[~same] + 1
    big = np.flatnonzero(out == 7)
    table = buckets(shape.folder, f"many-{prefix}", ["<u8", "<i8"])
    for bucket, rows in _in_buckets(of[big]):
        h, n = table[bucket]
        # By the bits that are stored.
        out[big[rows]] = n[np.searchsorted(h >> _U(19), keys[big[rows]] >> _U(19))]
    return out


def _dense(shape: Shape, prefix: str, ids: np.ndarray, columns: int) -> np.ndarray:
    """Columns of dense arrays at the ids of known words (0 elsewhere)."""
    out = np.zeros((columns, len(ids)), np.int64)
    there = np.flatnonzero(ids >= 0)
    table = buckets(shape.folder, prefix, ["|u1"] * columns)
    for r, rows in _in_buckets(ids[there] // shape.span):
        if len(table[r][0]):
            out[:, there[rows]] = _small(shape, prefix, r, table[r], ids[there[rows]] - r * shape.span)
    return out


def token_scores(shape: Shape, h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training count, unigram base and model log10 probability of each token."""
    distinct, back = numbered(h)
    ids, counts = shape.words(distinct)
    v, n = shape.types, shape.tokens
    base = np.log10((counts + 1) / (n + v + 1))
    if not v:
        zero = np.zeros(len(h))
        return zero.astype(np.int64), base[back], zero
    preceded = _dense(shape, "words-", ids, 1)[0]
    left = sum(d * c for d, c in zip(shape.discounts[1], [*shape.classes[1][:2], sum(shape.classes[1][2:])], strict=True))
    p = ((np.maximum(discounted(preceded, shape.discounts[1]), 0) + left / (v + 1)) / shape.total[1])[back]
    after = _dense(shape, "after-", ids, 4)
    word = windows(ids[back], sizes, shape.end, shape.order)
    row = windows(back, sizes, -1, 2)[0]  # of the word before, among the distinct ones
    end_after = _dense(shape, "after-", np.array([shape.end]), 4)[:, 0]
    of_word = windows(counts[back], sizes, int(shape.words(np.array([END], _U))[1][0]), shape.order)
    known = word[-1] >= 0
    seen_below = known  # whether the gram of the order below, ending here, was seen
    for level in range(2, shape.order + 1):
        gram = word[-level:]
        known = known & (gram[0] >= 0)
        hashed, context = gram_hash(gram), gram_hash(gram[:-1])
        top = level == shape.order
        at = np.flatnonzero(known)
        some, keys = [x[at] for x in gram], hashed[at]
        if top:
            of = shape.top_place(some, shape.several(np.min([x[at] for x in core_of(of_word[-level:])], axis=0)))
            found = _gram_counts(shape, f"grams{level}-", of, keys)
        else:  # whole in the bucket of the highest order that has their core, if that is not spread
            found = np.zeros(len(at), np.int64)
            inner = np.zeros(len(at), bool)
            if level == shape.order - 1:
                inner = shape.several(np.min([x[at] for x in of_word[-level:-1]], axis=0)) == 1
                found[inner] = _gram_counts(shape, "inner-", shape.home([x[inner] for x in some[:-1]]), keys[inner])
            found[~inner] = _gram_counts(shape, f"grams{level}-", shape.place(keys[~inner]), keys[~inner])
        c = np.zeros(len(h), np.int64)
        c[at] = found
        if level == 2:
            stats = np.where(row >= 0, after[:, row], end_after[:, None])
        else:
            stats = np.zeros((4, len(h)), np.int64)
            once = np.zeros(len(h), bool)
            once[1:] = seen_below[:-1] & (word[-2][1:] != shape.end)
            there = np.flatnonzero(np.all([x >= 0 for x in gram[:-1]], axis=0))
            own = np.zeros(len(h), bool)
            if top:
                own[there] = shape.several(np.min([x[there] for x in core_of(of_word[-level:])], axis=0)) == 1
                whole = np.flatnonzero(own)
                stats[:, whole] = _contexts(shape, "own-", shape.home([x[whole] for x in core_of(gram)]), context[whole])
            rest = there[~own[there]]
            stats[:, rest] = _contexts(shape, f"contexts{level}-", shape.place(context[rest]), context[rest])
            single = once & own & (stats[0] == 0)
            stats[0, single] = stats[1, single] = 1
        total = np.maximum(stats[0], 1)
        d = shape.discounts[level]
        high = np.maximum(discounted(c, d), 0) / total
        share = (d[0] * stats[1] + d[1] * stats[2] + d[2] * stats[3]) / total
        p = np.where(stats[0] > 0, high + share * p, p)
        seen_below = c > 0
    return counts[back], base[back], np.log10(p)


def lm_scores(docs: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row, by a model of the rows in training."""
    flagged = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(in_training, F.lit(False)).alias("train"))
    shape = train(flagged.filter("train"), order=order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, h, sizes in token_blocks(batches):
            count, base, score = token_scores(shape, h, sizes)
            heads = np.cumsum(sizes) - sizes
            total = np.add.reduceat(score, heads)
            yield pa.record_batch({
                "id": pa.array([r["id"] for r in rows], pa.int64()),
                "held_out": pa.array([not r["train"] for r in rows], pa.bool_()),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), heads)),
                "train_tokens": pa.array(np.full(len(sizes), shape.tokens, np.int64)),
                "base_score": pa.array(np.add.reduceat(base, heads)),
                "score": pa.array(total),
                "perplexity": pa.array(10.0 ** (-total / sizes)),
            })

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return flagged.mapInArrow(run, schema).withColumnRenamed("id", id_col)
