"""Quality classifier by positive-unlabelled learning, with the non-negative risk and an estimated class prior.

Trusted positives are rows labelled 1 in the learning fold; the unlabelled web text is every row, whatever
its label; rows labelled 0 are not used. With z the score's logit, the logistic loss l and the class prior q, training
minimises the non-negative risk
    q E_p[l(z)] + max(0, N) + ridge / 2 |w|^2,   N = E_u[l(-z)] - q E_p[l(-z)].
As l(z) - l(-z) is linear, both q E_p[l(z)] and q E_p[l(z)] + N are convex, and so is the larger of the two. Its
minimum is that of the plain risk if N is not negative there; else N is zero at it, and with a multiplier c between 0
and 1 the gradient of q E_p[l(z)] + c N + ridge / 2 |w|^2 vanishes: Newton's method on w and c together finds it.
The ridge is `ridge` and `few` / positives on top, as few positives need more.

The prior is estimated from positives and unlabelled rows alone, by the best bin (Garg, Wu, Balakrishnan, Smola and
Lipton, 2021): first models are trained at prior one half, each on half of the positives, for both halves of SPLITS ways
to halve them, all in the same passes; of the thresholds on their scores, the one is taken where the share of unlabelled
rows above it, over the share of positives above it in the halves that were not trained on, has the least upper
confidence bound; that ratio is the prior. The shares come from histograms, which merge.

Features are shares and logarithms of a whole text (characters by class, words, repeats, lines), computed once
and stored with the flag of trusted positives: some 60 numbers a row. A Newton step is one pass over that
table; tasks send sums of products, which are added in a fixed number of slots before the driver sees them, so
training covers all rows and its cost on the driver does not grow. Language, source, id and labels are no features.

Defined results: null text is empty and has a score; a row whose id has labels that disagree is no trusted positive; null
labels do not count; without trusted positives every score is the prior (one half, if none is given); repeated rows
count and come back each time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.common import BROADCAST_BYTES, materialise
from sparkweft.llm.words import WordHashes, split_words

#: Character classes by byte; other bytes are of letters beyond ASCII.
CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r", ".,;:'\"()-", "!?", "#*$%&|<>", "@/\\_=+~^`[]{}")
_CLASS = np.full(256, len(CLASSES), np.int64)
for _k, _chars in enumerate(CLASSES):
    _CLASS[[ord(_c) for _c in _chars]] = _k
RAW = len(CLASSES) + 1 + 14
RIDGE, FEW, SLOTS, ROUNDS = 0.02, 3.0, 32, 30
WIDE = 1 + 2 * RAW
#: Ways to halve the positives: way k goes by bit k of a positive's mark less one.
SPLITS = 4
#: Bins of the logits' histogram, between -_FAR and _FAR, and the confidence of the prior's bound.
_BINS, _FAR, _DELTA = 400, 20.0, 0.1
_HASHES = WordHashes()


def raw_features(text: str) -> np.ndarray:
    """RAW numbers, most of them shares between 0 and 1."""
    out = np.zeros(RAW, np.float64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    words = split_words(text)
    k = len(CLASSES) + 1
    out[k + 1] = np.log1p(n) / 12
    if not words:
        out[k] = 1.0
        return out
    counts = np.bincount(data, minlength=256)
    out[:k] = np.bincount(_CLASS, counts, minlength=k) / n
    p = counts[counts > 0] / n
    m = len(words)
    heads, tails = [w[0] for w in words], [w[-1] for w in words]
    hashed = _HASHES.of(words)
    lines = [x for x in text.split("\n") if x]
    triples = hashed[:-2] * np.uint64(3) + hashed[1:-1] * np.uint64(5) + hashed[2:] * np.uint64(7) if m > 2 else hashed
    sizes = np.fromiter(map(len, words), np.int64, m)
    out[k + 2 :] = (
        np.log1p(m) / 10,
        min(sizes.mean() / 12, 2.0),
        min(float(sizes.std()) / 12, 2.0),
        min(float(sizes.max()) / 100, 2.0),
        len(np.unique(hashed)) / m,
        float((hashed[1:] == hashed[:-1]).mean()) if m > 1 else 0.0,
        1 - len(np.unique(triples)) / len(triples),
        1 - len(set(lines)) / max(len(lines), 1),
        min(np.log1p(m / max(len(lines), 1)) / 6, 2.0),
        sum(map(str.isalpha, heads)) / m,
        sum(map(str.isalpha, tails)) / m,
        float(-(p * np.log2(p)).sum()) / 8,
    )
    return out


def expanded(raw: np.ndarray) -> np.ndarray:
    """A constant, each number, and its square root (steep near zero)."""
    return np.concatenate([np.ones((len(raw), 1)), raw, np.sqrt(np.maximum(raw, 0))], axis=1)


def _summed(table: DataFrame, make, slots: int = SLOTS) -> np.ndarray | None:
    """Sum over all rows of what make(features, flags) gives for a batch; None if there are no rows. Flags: 0, or a mark from 1 on for positives.

    Each task sends one row, the rows meet in `slots` groups, and at most `slots` rows come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for part in (b.slice(k, 4096) for k in range(0, b.num_rows, 4096)):
                x = np.frombuffer(b"".join(part["f"].to_pylist()), "<f4").reshape(-1, RAW).astype(np.float64)
                found = make(expanded(x), np.array(part["p"].to_pylist(), np.int8))
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch({"slot": pa.array([TaskContext.get().partitionId() % slots], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"v": [np.sum([np.frombuffer(v, "<f8") for v in part["v"]], axis=0).tobytes()]})

    found = table.select("f", "p").mapInArrow(run, "slot int, v binary").groupBy("slot").applyInPandas(add, "v binary").collect()
    return np.sum([np.frombuffer(r["v"], "<f8") for r in found], axis=0) if found else None


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def half(flags: np.ndarray, way: int, which: int) -> np.ndarray:
    """The positives of one half (0 or 1) of a way to halve them."""
    return (flags > 0) & (((flags.astype(np.int64) - 1) >> way) & 1 == which)


def risk_parts(x: np.ndarray, positive: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums for a step, over all rows and over positives: l(-z), its gradient and its curvature; the gradient of l(z) over positives."""
    z = x @ weights
    s, own = _sigmoid(z), x[positive]
    t = s[positive]
    return np.concatenate([
        [np.logaddexp(0, z).sum(), np.logaddexp(0, z[positive]).sum()],
        s @ x, t @ own, (t - 1) @ own,
        ((x * (s * (1 - s))[:, None]).T @ x).ravel(), ((own * (t * (1 - t))[:, None]).T @ own).ravel(),
    ])


class Fit:
    """Weights of standardised features, and what training ended with: N (negative_part), the multiplier c and the last step."""

    def __init__(self, prior: float):
        self.prior, self.weights, self.mean, self.scale = prior, np.zeros(WIDE), np.zeros(WIDE), np.ones(WIDE)
        self.weights[0] = np.log(prior / (1 - prior))
        self.negative_part, self.multiplier, self.step = 0.0, 1.0, 0.0

    def logits(self, raw: np.ndarray) -> np.ndarray:
        return ((expanded(raw) - self.mean) / self.scale) @ self.weights


    def advance(self, sums: np.ndarray, n: float, positives: float, pull: np.ndarray) -> bool:
        """One Newton step from the sums of risk_parts(); whether it was the last."""
        prior, c, w = self.prior, self.multiplier, self.weights
        of_all, of_positives, upward = sums[2 : 2 + 3 * WIDE].reshape(3, WIDE)
        curve_all, curve_positives = sums[2 + 3 * WIDE :].reshape(2, WIDE, WIDE)
        part, slope = sums[0] / n - prior * sums[1] / positives, of_all / n - prior * of_positives / positives
        gradient = prior * upward / positives + c * slope + pull * w
        curve = (1 - c) * prior * curve_positives / positives + c * curve_all / n + np.diag(pull)
        self.negative_part = part
        if c == 1.0 and part >= 0:
            step, turn = -np.linalg.solve(curve, gradient), 0.0
        else:  # the clamp holds: N = 0 with a multiplier
            both = np.block([[curve, slope[:, None]], [slope[None], np.zeros((1, 1))]])
            found = -np.linalg.solve(both, np.append(gradient, part))
            step, turn = found[:-1], found[-1]
        self.step = float(np.abs(step).max())
        damp = min(1.0, 5.0 / max(self.step, 1e-12))
        self.weights, self.multiplier = w + damp * step, min(1.0, max(0.0, c + damp * turn))
        return self.step < 1e-4


def fit_all(table: DataFrame, prior: float, trains: list[Callable[[np.ndarray], np.ndarray]], ridge: float = RIDGE, few: float = FEW, rounds: int = ROUNDS) -> list[Fit]:
    """A model for each of `trains`, which tells a batch's training positives from its flags; all take their steps in the same passes.

    table: f (features) and p (0, or a mark from 1 on for trusted positives).
    """
    made = [Fit(prior) for _ in trains]
    found = _summed(table, lambda x, flags: np.concatenate([[len(x)], [np.count_nonzero(t(flags)) for t in trains], x.sum(axis=0), (x * x).sum(axis=0)]).astype(np.float64))
    if found is None:
        return made
    n, positives, (total, squares) = found[0], found[1 : 1 + len(trains)], found[1 + len(trains) :].reshape(2, WIDE)
    mean = total / n
    scale = np.maximum(np.sqrt(np.maximum(squares / n - mean**2, 0)), 1e-6)
    mean[0], scale[0] = 0.0, 1.0
    for m in made:
        m.mean, m.scale = mean, scale
    going = [k for k in range(len(made)) if positives[k]]
    for _ in range(rounds):
        if not going:
            break

        def parts(x: np.ndarray, flags: np.ndarray) -> np.ndarray:
            x = (x - mean) / scale
            return np.concatenate([risk_parts(x, trains[k](flags), made[k].weights) for k in going])  # noqa: B023

        sums = _summed(table, parts).reshape(len(going), -1)
        pulls = [np.concatenate([[1e-6], np.full(WIDE - 1, ridge + few / positives[k])]) for k in going]
        going = [k for k, own, pull in zip(going, sums, pulls, strict=True) if not made[k].advance(own, n, positives[k], pull)]
    return made


def fit(table: DataFrame, prior: float, ridge: float = RIDGE, few: float = FEW, rounds: int = ROUNDS) -> Fit:
    return fit_all(table, prior, [lambda flags: flags > 0], ridge, few, rounds)[0]


def estimated_prior(table: DataFrame, ridge: float = RIDGE, few: float = FEW) -> float | None:
    """The share of positives among all rows (see above); None without positives in both halves of a way to halve them."""
    ways = [(way, which) for way in range(SPLITS) for which in (0, 1)]
    models = fit_all(table, 0.5, [lambda flags, way=way, which=which: half(flags, way, 1 - which) for way, which in ways], ridge, few)

    def counted(x: np.ndarray, flags: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ways), 2, _BINS))
        for k, ((way, which), m) in enumerate(zip(ways, models, strict=True)):
            z = ((x - m.mean) / m.scale) @ m.weights
            at = np.clip((z + _FAR) * (_BINS / (2 * _FAR)), 0, _BINS - 1).astype(np.int64)
            out[k] = np.bincount(at, minlength=_BINS), np.bincount(at[half(flags, way, which)], minlength=_BINS)
        return out.ravel()

    found = _summed(table, counted)
    if found is None:
        return None
    found = found.reshape(SPLITS, 2, 2, _BINS)
    both = found[:, :, 1].sum(axis=2).all(axis=1)
    if not both.any():
        return None
    everything, others = (np.cumsum(h[::-1])[::-1] for h in found[both].sum(axis=(0, 1)))
    n, m = everything[0] / (2 * both.sum()), others[0] / both.sum()
    above, own = everything / everything[0], others / others[0]
    there = own > 0
    slack = np.sqrt(np.log(4 / _DELTA) / 2 / n) + np.sqrt(np.log(4 / _DELTA) / 2 / m)
    best = int(np.argmin((above[there] + slack) / own[there]))
    return float(min(max(above[there][best] / own[there][best], 0.01), 0.99))


def featurised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and f, the features of the whole text (little-endian 32-bit floats)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"id": b["id"], "f": pa.array([raw_features(t.as_py() or "").astype("<f4").tobytes() for t in b["text"]], pa.binary())})

    return rows.mapInArrow(run, "id long, f binary")


def judged(labels: DataFrame, in_learning: Column, id_col: str, label_col: str) -> DataFrame:
    """id, good (all labels of the id are 1) of the ids in the learning fold that have a label."""
    rows = labels.filter(in_learning & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).cast("long").alias("_id")).agg((F.min(label_col) == 1).alias("good"))


def quality_scores(docs: DataFrame, labels: DataFrame, in_learning: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", prior: float | None = None, ridge: float = RIDGE, few: float = FEW) -> DataFrame:
    """id, held_out, score, predicted of every row of docs; labels are read where in_learning (of the id) holds. prior: estimated unless given."""
    trusted = materialise(judged(labels, in_learning, id_col, label_col).filter("good"), "trusted").select("_id", (F.pmod(F.xxhash64("_id"), F.lit(1 << SPLITS)) + 1).cast("byte").alias("p"))
    flagged = lambda rows, side: rows.join(side, F.col("id") == F.col("_id"), "left").drop("_id")
    if trusted.count() * 16 < BROADCAST_BYTES:
        joined = flagged(featurised(docs, id_col, text_col), F.broadcast(trusted))
    else:  # null ids have no label and would all meet in one task of the join
        joined = flagged(featurised(docs.filter(F.col(id_col).isNotNull()), id_col, text_col), trusted)
        joined = joined.unionByName(featurised(docs.filter(F.col(id_col).isNull()), id_col, text_col).withColumn("p", F.lit(0).cast("byte")))
    table = materialise(joined.withColumn("p", F.coalesce("p", F.lit(0).cast("byte"))), "features")
    prior = estimated_prior(table, ridge, few) if prior is None else prior
    made = fit(table, 0.5 if prior is None else prior, ridge, few)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = _sigmoid(made.logits(np.frombuffer(b"".join(b["f"].to_pylist()), "<f4").reshape(-1, RAW).astype(np.float64)))
            yield pa.record_batch({"id": b["id"], "score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))})

    scored = table.select("id", "f").mapInArrow(run, "id long, score double, predicted int").withColumnRenamed("id", id_col)
    return scored.select(id_col, F.coalesce(~in_learning, F.lit(True)).alias("held_out"), "score", "predicted")
