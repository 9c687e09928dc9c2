"""Main text of pages by a tree-structured graphical model.

A page's blocks and the elements around them are the nodes of a tree; each node is content or not. A node has a
unary potential (a sum of weights of its features: tag, names in class, id and role, size, links, punctuation) and
each edge a 2 x 2 potential by the kinds of parent and child. Sum-product messages, once upward and once
downward, give every node's marginal exactly; blocks whose content marginal is at least one half are the text.

The model is trained from labelled pages (made from a seed) by maximum conditional likelihood: observed less
expected features, the expectation from the same messages. Messages of all pages of a batch run together, level by
level. The trained weights are kept beside this module (html_weights.npz; `python -m sparkweft.llm.html_extract`
makes the file anew, and a test holds it against fresh training); tasks get them with their code.

Defined results: null or empty html has no text; pages are read whole; rows are extracted one by one, so repeated
rows come back repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.html_pages import label_of, labelled_pages
from sparkweft.llm.html_tree import Tree, parse

_KIND = {t: k for k, group in enumerate(("p pre blockquote", "h1 h2 h3 h4 h5 h6 hgroup", "li ul ol dl dd dt menu", "table tbody thead tfoot tr td th", "article main", "div section center figure details", "html body"), 2) for t in group.split()}
KINDS = 9  # 0: a block of text, 1: other elements


def features(tree: Tree) -> tuple[list[list[str]], np.ndarray]:
    """Names of each node's features, and the kind of its edge to its parent (own kind and parent's)."""
    n = len(tree.parent)
    words, chars, linked, commas, leaves = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for k in range(n - 1, -1, -1):
        if t := tree.text[k]:
            words[k], chars[k], linked[k], commas[k], leaves[k] = t.count(" ") + 1, len(t), tree.linked[k], t.count(",") + t.count("."), 1
        p = tree.parent[k]
        if p >= 0:
            words[p] += words[k]
            chars[p] += chars[k]
            linked[p] += linked[k]
            commas[p] += commas[k]
            leaves[p] += leaves[k]
    kinds = [0 if not tree.tag[k] else _KIND.get(tree.tag[k], 1) for k in range(n)]
    out, edge = [], np.empty(n, np.int64)
    for k in range(n):
        size, link = min(words[k].bit_length(), 10), 4 * linked[k] // max(chars[k], 1)
        share = 5 * chars[k] // max(chars[0], 1)  # of the page's characters
        dense = min(3, 20 * commas[k] // max(words[k], 1))
        if tree.tag[k]:
            found = [f"T{tree.tag[k]}", f"N{size}", f"L{link}", f"B{min(leaves[k].bit_length(), 5)}", f"D{dense}", f"S{share}", f"TN{tree.tag[k]}{size // 3}", *(f"K{x}" for x in tree.parts[k])]
            if len(tree.parts[k]) == 0:
                found.append("bare")
        else:
            t = tree.text[k]
            found = ["leaf", f"n{size}", f"l{link}", f"d{dense}", f"s{share}", f"nl{size // 3}{link > 1}"]
            if t[-1] in ".!?…:;\"'":
                found.append("end")
            if "©" in t[:3] or "copyright" in t[:30].lower():
                found.append("copy")
        out.append(found)
        p = tree.parent[k]
        edge[k] = kinds[k] * KINDS + (kinds[p] if p >= 0 else 0)
    return out, edge


class Forest:
    """Several pages' nodes with the ids of their features, ordered so that levels can be taken together."""

    def __init__(self, trees: Iterable[Tree], index: dict[str, int], grow: bool = False):
        parents, depths, edges, rows, ids, self.offsets = [], [], [], [], [], [0]
        for tree in trees:
            found, edge = features(tree)
            base, depth = self.offsets[-1], []
            for k, (p, names) in enumerate(zip(tree.parent, found, strict=True)):
                depth.append(0 if p < 0 else depth[p] + 1)
                parents.append(-1 if p < 0 else base + p)
                for x in names:
                    i = index.setdefault(x, len(index)) if grow else index.get(x)
                    if i is not None:
                        rows.append(base + k)
                        ids.append(i)
            depths += depth
            edges.append(edge)
            self.offsets.append(base + len(found))
        self.parent, self.edge = np.array(parents, np.int64), np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.rows, self.ids = np.array(rows, np.int64), np.array(ids, np.int64)
        order = np.argsort(depths, kind="stable")
        cuts = np.searchsorted(np.array(depths)[order], np.arange(1, max(depths, default=0) + 2))
        self.levels = [order[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        self.child = self.parent >= 0

    def messages(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Content marginals; beliefs from below; what each node's parent believes without it (normalised by message)."""
        n = len(self.parent)
        below = np.zeros((n, 2))
        below[:, 1] = np.bincount(self.rows, unary[self.ids], minlength=n)
        up = np.zeros((n, 2))
        theta = pair[self.edge]  # of each node's edge: parent's state, own state
        for level in reversed(self.levels[1:]):
            up[level] = np.logaddexp(theta[level, :, 0] + below[level, :1], theta[level, :, 1] + below[level, 1:])
            up[level] -= up[level].max(axis=1, keepdims=True)
            np.add.at(below, self.parent[level], up[level])
        belief, rest = below.copy(), np.zeros((n, 2))
        for level in self.levels[1:]:
            rest[level] = belief[self.parent[level]] - up[level]
            down = np.logaddexp(rest[level, :1] + theta[level, 0], rest[level, 1:] + theta[level, 1])
            belief[level] += down - down.max(axis=1, keepdims=True)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), below, rest

    def edge_marginals(self, below: np.ndarray, rest: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """For each node with a parent: the joint distribution of the parent's and its own state."""
        z = pair[self.edge] + rest[:, :, None] + below[:, None, :]
        z = np.exp(z - z.max(axis=(1, 2), keepdims=True))
        return z / z.sum(axis=(1, 2), keepdims=True)


def given_labels(tree: Tree) -> list[int]:
    """Blocks have the nearest label above (0 without one), elements that of most of the characters below them."""
    n = len(tree.parent)
    own, yes, all_ = [0] * n, [0] * n, [0] * n
    for k in range(n):
        p = tree.parent[k]
        own[k] = tree.given[k] if tree.given[k] is not None else (own[p] if p >= 0 else 0)
        if tree.text[k]:
            all_[k], yes[k] = len(tree.text[k]), own[k] * len(tree.text[k])
    for k in range(n - 1, 0, -1):
        yes[tree.parent[k]] += yes[k]
        all_[tree.parent[k]] += all_[k]
    return [int(2 * y > a) for y, a in zip(yes, all_, strict=True)]


class Model:
    """Weights of features and edges, learned from labelled pages."""

    def __init__(self, pages: int = 1000, seed: int = 3, rounds: int = 160, ridge: float = 1e-5, rate: float = 0.3):
        trees = [parse(p, label_of) for p in labelled_pages(pages, seed)]
        self.index: dict[str, int] = {}
        forest = Forest(trees, self.index, grow=True)
        y = np.concatenate([given_labels(t) for t in trees]).astype(np.float64)
        k, e = len(self.index), KINDS * KINDS
        w, n = np.zeros(k + 4 * e), len(y)
        observed = np.concatenate([np.bincount(forest.ids, y[forest.rows], minlength=k), self._edges(forest, np.eye(4).reshape(4, 2, 2)[(2 * y[forest.parent] + y).astype(int)], e)])
        first, second = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, rounds + 1):
            pair = w[k:].reshape(e, 2, 2)
            p, below, rest = forest.messages(w[:k], pair)
            expected = np.concatenate([np.bincount(forest.ids, p[forest.rows], minlength=k), self._edges(forest, forest.edge_marginals(below, rest, pair), e)])
            g = (observed - expected) / n - ridge * w
            first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            w += rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-6)
        self.unary, self.pair = w[:k], w[k:].reshape(e, 2, 2)

    def save(self, path: str | Path) -> None:
        np.savez_compressed(path, names=np.array(list(self.index)), unary=self.unary, pair=self.pair)

    @classmethod
    def load(cls, path: str | Path) -> Model:
        made = cls.__new__(cls)
        with np.load(path) as f:
            made.index, made.unary, made.pair = {str(x): k for k, x in enumerate(f["names"])}, f["unary"], f["pair"]
        return made

    @staticmethod
    def _edges(forest: Forest, joint: np.ndarray, e: int) -> np.ndarray:
        out = np.zeros((e, 2, 2))
        np.add.at(out, forest.edge[forest.child], joint[forest.child])
        return out.ravel()

    def marginals(self, trees: list[Tree]) -> list[np.ndarray]:
        """Content marginals of the nodes of each tree."""
        forest = Forest(trees, self.index)
        p = forest.messages(self.unary, self.pair)[0]
        return [p[a:b] for a, b in zip(forest.offsets[:-1], forest.offsets[1:], strict=True)]

    def texts(self, pages: list[str]) -> list[str]:
        trees = [parse(p) for p in pages]
        return ["\n\n".join(t for t, q in zip(tree.text, p, strict=True) if t and q >= 0.5) for tree, p in zip(trees, self.marginals(trees), strict=True)]


#: The weights that Model() learns.
WEIGHTS = Path(__file__).with_name("html_weights.npz")


@lru_cache(maxsize=1)
def model() -> Model:
    """Read once in a process."""
    return Model.load(WEIGHTS)


#: Pages whose messages run together: as many as have this many characters, so that memory is bounded.
TOGETHER = 400_000


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of each row of pages."""
    trained = model()
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            while at < b.num_rows:
                held, chars, end = [], 0, at
                while end < b.num_rows and (not held or chars < TOGETHER):
                    held.append(b["html"][end].as_py() or "")
                    chars += len(held[-1])
                    end += 1
                texts = trained.texts(held)
                part = b.slice(at, end - at)
                yield pa.record_batch({"id": part["id"], "url": part["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})
                at = end

    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})


if __name__ == "__main__":
    Model().save(WEIGHTS)
