"""Extraction, language model, quality classifier, BPE and packing."""

from __future__ import annotations

import base64
import hashlib
import math
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import WORD, awkward, frame, lower_az
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkweft.llm import arrays, bpe, html_extract, html_tree, kneser_ney, packing, quality_classifier
from sparkweft.llm.html_pages import label_of, labelled_pages
from sparkweft.llm.registry import fold, op3_kneser_ney

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


# --- extraction


def test_blocks_of_a_page():
    t = html_tree.parse("<ul><li>a &amp; b<li>c<br>d</ul><p>x<p>y &lt;z<script>var a='<p>q</p>';</script><!-- no <p> --> w<table><tr><td>1<td>2</table>end<")
    assert [x for x in t.text if x] == ["a & b", "c d", "x", "y <z w", "1", "2", "end<"]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<header><button>Menu</header><article><p>One.</p></article>", ["One."]),
        ("<header><select><option>A<option>B</header><p>One.", ["One."]),
        ("<header><button>Menu<button>Search</button></header><p>One.", ["One."]),
        ("<select><option>A<select><p>One.", ["One."]),
        ("<div><button>Menu<article><p>One.</p></article></div><p>Two.", ["Menu", "One.", "Two."]),
        ("<button>Menu<p>One.</p><button>Go</button><p>Two.", ["Menu", "One.", "Two."]),
        ("<div>x<button>Menu <b>One", ["xMenu One"]),
        ("<svg><canvas><p>One.</p><template><p>Two.", ["One.", "Two."]),
        ("<svg><text>a</text><p>One.", ["One."]),
        ("<div><button><div>a</div><svg><title/><path/></svg></button>One.</div>", ["One."]),
        ("<div><template><p>a</div></template>One.</div>", ["One."]),
        ("<div><button>a<script>'</div>'</script>b</button>One.</div>", ["One."]),
        ("<p>The <math><mi>x</mi></math> of <object data=a>a plan</object> <map>here</map>.</p>", ["The x of a plan here."]),
    ],
)
def test_elements_without_text_swallow_nothing_else(page, texts):
    assert [t for t in html_tree.parse(page).text if t] == texts


@pytest.mark.parametrize("part", ["<button><p>a", "<svg><desc><p>a", "<canvas><div>a", "<select><p><button><p>", "<template><video><p>a", "<div><button><p>a"])
def test_unclosed_elements_cost_linear_time(part):
    def seconds(n: int) -> float:
        start = time.process_time()
        html_tree.parse(part * n)
        return time.process_time() - start

    assert seconds(20_000) < 20 * max(seconds(2_000), 0.02)


@given(st.lists(st.sampled_from([*"<>/!-ap =\"'& \n;", "<p>", "</p>", "<td>", "</table>", "<table>", "<tr>", "</tr>", "<!--", "<a ", "<li>", "</div>", "<div>", "<script>", " data-y=auto", " data-y=''", " class", " id=", " hidden", "<div data-y=1.5>", "<button>", "<select>", "</button>", "<svg", "<math>", "<object>", "sparkweft-training-label=x"]), max_size=80))
def test_parser_never_fails(parts):
    t = html_tree.parse("".join(parts))
    assert all(p < k for k, p in enumerate(t.parent))


def test_extraction_of_held_out_pages():
    pages = labelled_pages(120, 77)
    trees = [html_tree.parse(p, label_of) for p in pages]
    right = total = 0
    for tree, p in zip(trees, html_extract.model().marginals(trees), strict=True):
        given_ = html_extract.given_labels(tree)
        right += sum((q >= 0.5) == bool(y) for t, q, y in zip(tree.text, p, given_, strict=True) if t)
        total += sum(map(bool, tree.text))
    assert right / total > 0.98


def test_pages_cannot_label_themselves():
    """Attributes of any name are no labels, and change neither the tree nor what is extracted."""
    page = "<article><div data-y='auto'><p>One, two and three more words of prose.</p></div><p data-y=''>Four.</p></article>"
    plain = page.replace(" data-y='auto'", "").replace(" data-y=''", "")
    assert html_extract.model().texts([page, page.replace("data-y=''", "sparkweft-training-label=0")]) == html_extract.model().texts([plain] * 2)
    assert set(html_tree.parse(page).given) == {None}


def test_stored_weights_are_what_training_gives():
    fresh, stored = html_extract.Model(), html_extract.model()
    assert list(fresh.index) == list(stored.index)
    trees = [html_tree.parse(p) for p in labelled_pages(40, 5)]
    for a, b in zip(fresh.marginals(trees), stored.marginals(trees), strict=True):
        assert np.allclose(a, b, atol=1e-3)


class Reader(HTMLParser):
    """Blocks of text below <article>, by the standard library's parser and nothing of ours."""

    SILENT = {"script", "style", "nav", "aside", "footer", "form", "template", "noscript"}

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.inside, self.silent, self.run, self.blocks = 0, 0, [], []
        self.feed(page)
        self.close()
        self.flush()

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run.clear()
        if text:
            self.blocks.append(text)

    def turn(self, tag: str, by: int) -> None:
        if tag in html_tree.BLOCKS:
            self.flush()
        if tag == "br":
            self.run.append(" ")
        if tag == "article":
            self.inside += by
        if tag in self.SILENT:
            self.silent = max(0, self.silent + by)

    def handle_starttag(self, tag, attrs):
        self.turn(tag, 1)

    def handle_endtag(self, tag):
        self.turn(tag, -1)

    def handle_data(self, data):
        if self.inside > 0 and not self.silent:
            self.run.append(data)


def test_extraction_agrees_with_another_reader(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    same = [got[r.page_id] == "\n\n".join(Reader(r.html or "").blocks) for r in pages.collect()]
    assert sum(same) / len(same) > 0.99


def test_messages_give_exact_marginals():
    tree = html_tree.parse("<div><p>a b c</p><ul><li>d</li><li>e</li></ul></div><p>f</p>")
    index: dict[str, int] = {}
    forest = html_extract.Forest([tree], index, grow=True)
    rng = np.random.default_rng(0)
    unary, pair = rng.normal(size=len(index)), rng.normal(size=(html_extract.KINDS**2, 2, 2))
    n = len(tree.parent)
    own = np.bincount(forest.rows, unary[forest.ids], minlength=n)
    weight = {}
    for k in range(1 << n):
        y = [k >> j & 1 for j in range(n)]
        weight[tuple(y)] = math.exp(sum(own[j] for j in range(n) if y[j]) + sum(pair[forest.edge[j]][y[tree.parent[j]]][y[j]] for j in range(n) if tree.parent[j] >= 0))
    total = sum(weight.values())
    want = [sum(w for y, w in weight.items() if y[j]) / total for j in range(n)]
    p, below, rest = forest.messages(unary, pair)
    assert np.allclose(p, want)
    joint = forest.edge_marginals(below, rest, pair)
    for j in range(n):
        if tree.parent[j] >= 0:
            assert math.isclose(joint[j][1][1], sum(w for y, w in weight.items() if y[j] and y[tree.parent[j]]) / total)


def test_extract_pages(spark):
    page = "<html><head><title>T</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Head</h1><p>First&nbsp;one,  long\nenough to read. It has two sentences.</p><p>Short.</p></article><div class='comments'><p>I disagree, said a reader.</p></div><footer>&copy; me</footer></body></html>"
    d = spark.createDataFrame([(1, "u", page, 9), (2, None, None, 9), (3, "u", "", 9), (1, "u", page, 9), (None, "u", "<div>" * 3000 + "deep", 9)], "page_id long, url string, html string, text long")
    got = html_extract.extract(d).collect()
    assert len(got) == 5
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "Head\n\nFirst one, long enough to read. It has two sentences.\n\nShort."
    assert texts[2] == texts[3] == "" and all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(d.limit(0)).count() == 0


def test_extract_test_pages(spark):
    """The tables' pages have one article element each."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = r.html[r.html.index("<article>") :]
        body = body[: body.index("</article>")] if "</article>" in body else body
        assert [t for t in html_tree.parse(body).text if t] == r.text.split("\n\n")


# --- language model


def test_scores(docs, rows):
    flag = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 2
    got = kneser_ney.lm_scores(docs, flag).collect()
    tokens = lambda t: [*WORD.findall(lower_az(t or "")), "\n"]
    train = Counter(w for i, t, *_ in rows if (i or 0) % 3 != 2 for w in tokens(t))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t, *_ in rows:
        words = tokens(t)
        want[(i, (i or 0) % 3 == 2, len(words), sum(w in train for w in words), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words), 4))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


class PlainKneserNey:
    """Interpolated modified Kneser-Ney from its definition, over dictionaries of word tuples."""

    def __init__(self, texts: list[str], order: int):
        self.order, self.counts = order, {k: Counter() for k in range(1, order + 1)}
        words = Counter()
        for t in texts:
            tokens = ["\n"] * (order - 1) + self.tokens(t)
            words.update(tokens[order - 1 :])
            self.counts[order].update(tuple(tokens[k : k + order]) for k in range(len(tokens) - order + 1))
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.types = len(words)
        self.d, self.after = {}, {}
        for k, counts in self.counts.items():
            n = [sum(c == j for c in counts.values()) for j in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if min(n) else 0
            d = [min(max(j + 1 - (j + 2) * y * n[j + 1] / n[j], 0.05), j + 0.95) for j in range(3)] if min(n) else [0.5, 0.75, 0.9]
            self.d[k] = [0.0, *d]
            self.after[k] = {}
            for g, c in counts.items():
                self.after[k].setdefault(g[:-1], []).append(c)

    @staticmethod
    def tokens(t: str) -> list[str]:
        return [*WORD.findall(lower_az(t)), "\n"]

    def p(self, gram: tuple) -> float:
        k = len(gram)
        if k == 0:
            return 1 / (self.types + 1)
        found = self.after[k].get(gram[:-1])
        if not found:
            return self.p(gram[1:])
        c, d = self.counts[k][gram], self.d[k]
        return max(c - d[min(c, 3)], 0) / sum(found) + sum(d[min(x, 3)] for x in found) / sum(found) * self.p(gram[1:])

    def score(self, t: str) -> float:
        tokens = ["\n"] * (self.order - 1) + self.tokens(t)
        return sum(math.log10(self.p(tuple(tokens[k : k + self.order]))) for k in range(len(tokens) - self.order + 1))


def _corpus(seed: int) -> tuple[list[str], list[str]]:
    """Training texts, some of them repeated, and others with words never seen."""
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(40)]
    draw = lambda pool, n: " ".join(pool[min(int(x), len(pool) - 1)] for x in rng.exponential(len(pool) / 5, n))
    texts = [draw(words, int(rng.integers(0, 40))) for _ in range(60)]
    return [*texts, *texts[:5], "", "w1"], [draw([*words, "never", "unseen"], int(rng.integers(0, 30))) for _ in range(20)] + ["", "Never W1 w1", "w1"]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize(("bits", "fanout"), [(None, 12), (1, 12), (5, 2)])
def test_scores_are_those_of_the_definition(spark, monkeypatch, order, bits, fanout):
    """With one bit contexts lie whole in one bucket, with more hot ones in several; a fan-out of two bits deals twice."""
    texts, others = _corpus(order)
    plain = PlainKneserNey(texts, order)
    if bits:
        monkeypatch.setattr(kneser_ney, "bits_for", lambda tasks: bits)
    monkeypatch.setattr(arrays, "FANOUT", fanout)
    monkeypatch.setattr(arrays, "HELD_VALUES", 100)
    d = spark.createDataFrame([(k, t, k < len(texts)) for k, t in enumerate(texts + others)], "doc_id long, text string, t boolean").repartition(3)
    got = {r.doc_id: r.score for r in kneser_ney.lm_scores(d, F.col("t"), order=order).collect()}
    for k, t in enumerate(texts + others):
        assert math.isclose(got[k], plain.score(t), rel_tol=1e-9, abs_tol=1e-9), (k, t)


def test_spread_contexts(spark, monkeypatch):
    """Contexts of frequent words are spread over buckets, others are not, and both give the scores of the definition."""
    rng = np.random.default_rng(9)
    texts = [" ".join(["the"] * 3 + [f"w{int(x)}" for x in rng.integers(0, 300, 20)] + ["the", "of", f"w{int(rng.integers(0, 300))}"]) for _ in range(80)]
    monkeypatch.setattr(kneser_ney, "bits_for", lambda tasks: 5)
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    shape = kneser_ney.train(d)
    assert set(shape.several(np.array([1, 240])).tolist()) != {1}
    plain = PlainKneserNey(texts, 3)
    for r in kneser_ney.lm_scores(d, F.lit(True)).collect():
        assert math.isclose(r.score, plain.score(texts[r.doc_id]), rel_tol=1e-9)


def test_query_scores_by_trigrams(spark, tmp_path):
    """The registered query gives the scores of the definition for three words, learnt from the rows of its fold."""
    texts = [t for part in _corpus(3) for t in part]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = PlainKneserNey([t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 7 != 2], 3)
    got = {r.doc_id: r.score for r in op3_kneser_ney(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        assert math.isclose(got[k], plain.score(t), rel_tol=1e-9), (k, t)


def test_training_gives_its_shuffles_back(spark, monkeypatch):
    d = frame(spark, [(k, f"w{k % 7} w{k % 5} w{k}", "en", "s") for k in range(200)]).repartition(3).cache()
    d.count()
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv

    def files() -> int:
        return env.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")

    def settled(most: int) -> int:
        until = time.time() + 10  # files go in the background
        while files() > most and time.time() < until:
            time.sleep(0.2)
        return files()

    there, count_grams, found = files(), kneser_ney._count_grams, []
    monkeypatch.setattr(kneser_ney, "_count_grams", lambda rows, shape: (found.append(settled(there)), count_grams(rows, shape)))
    assert kneser_ney.train(d).types > 200
    assert found[0] <= there and settled(there) <= there


def test_probabilities_sum_to_one(spark):
    """Over all words of the vocabulary, and one share for any other, after any context."""
    texts = ["a b a c a b d", "b a b b c", "c a d", "a b"] * 2 + ["e a b c d e f g h i", "a c a d a e"]
    shape = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = sorted({w for t in texts for w in t.split()})
    hashes = kneser_ney.WordHashes()
    one = lambda w: np.array([kneser_ney.END if w == "\n" else hashes[w]], np.uint64)
    for context in ["", "a", "b", "a b", "b a", "c", "i", "never", "a never", "never a"]:
        before = [one(w) for w in context.split()]
        total = 0.0
        for w in [*words, "\n", "unseen"]:
            h = np.concatenate([*before, one(w)])
            _, _, score = kneser_ney.token_scores(shape, h, np.array([len(h)]))
            total += 10 ** float(score[-1])
        assert math.isclose(total, 1.0, rel_tol=1e-9), context


def test_scores_without_training_rows(spark):
    d = frame(spark, [(1, "a b", "en", "s"), (2, None, "en", "s")])
    assert {(r.doc_id, r.score, r.n_known) for r in kneser_ney.lm_scores(d, F.lit(False)).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert kneser_ney.lm_scores(frame(spark, []), F.lit(True)).count() == 0


# --- quality classifier


def test_classifier_held_out_accuracy(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_classifier.quality_scores(d, labels, fold(3) != 1)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert got.count() == d.count() and len(rows) > 20
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    # Labels of the held-out fold are never read.
    flipped = labels.withColumn("quality", F.when(fold(3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier.quality_scores(d, flipped, fold(3) != 1).collect()}
    assert all(math.isclose(r.score, again[r.doc_id], rel_tol=1e-6) for r in got.collect())


def test_classifier_of_awkward_rows(spark, docs, rows):
    labels = spark.createDataFrame([(i, k % 4 != 0 and 1 or 0, 5) for k, (i, *_) in enumerate(rows)] + [(3, None, 5), (4, 1, 5), (4, 0, 5)], "doc_id long, quality int, p long")
    got = quality_classifier.quality_scores(docs, labels, fold(3) != 1).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.score for r in quality_classifier.quality_scores(docs, labels.limit(0), fold(3) != 1).collect()} == {0.5}
    assert quality_classifier.quality_scores(docs.limit(0), labels, fold(3) != 1).count() == 0


def _mixture(spark, n: int, share: float, positives: int, seed: int = 0):
    """A table as the classifier stores it: unlabelled rows of two classes, then trusted positives; and its arrays."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < share
    x = np.clip(rng.normal(np.where(good, 0.65, 0.35)[:, None], 0.08, (n, quality_classifier.RAW)), 0, None)
    p = np.zeros(n, np.int8)
    p[np.flatnonzero(good)[:positives]] = 1 + np.arange(positives) % (1 << quality_classifier.SPLITS)
    x = x.astype("<f4")
    table = spark.createDataFrame([(bytearray(r.tobytes()), int(q)) for r, q in zip(x, p, strict=True)], "f binary, p byte").repartition(3)
    return table, x.astype(np.float64), p, good


def _risk(w, x, positive, prior: float, pull) -> tuple[float, float]:
    """The non-negative risk with its ridge, and N, from their definitions."""
    z = x @ w
    part = np.logaddexp(0, z).mean() - prior * np.logaddexp(0, z[positive]).mean()
    return prior * np.logaddexp(0, -z[positive]).mean() + max(0.0, part) + (pull * w * w).sum() / 2, part


@pytest.mark.parametrize(("prior", "clamped"), [(0.3, False), (0.9, True)])
def test_fit_minimises_the_non_negative_risk(spark, prior, clamped):
    table, x, p, _ = _mixture(spark, 600, 0.6, 60)
    made = quality_classifier.fit(table, prior, 0.02, 1.0)
    std = (quality_classifier.expanded(x) - made.mean) / made.scale
    pull = np.full(quality_classifier.WIDE, 0.02 + 1.0 / 60)
    pull[0] = 1e-6
    least, part = _risk(made.weights, std, p > 0, prior, pull)
    assert made.step < 1e-4 and part > -1e-6 and math.isclose(part, made.negative_part, abs_tol=1e-4)
    assert (made.multiplier < 1) == clamped and (abs(part) < 1e-4) == clamped
    rng = np.random.default_rng(1)
    for size in (1e-3, 1e-2, 0.1, 1.0):
        assert all(_risk(made.weights + size * rng.normal(size=len(pull)), std, p > 0, prior, pull)[0] >= least - 1e-7 for _ in range(60))


@pytest.mark.parametrize("share", [0.35, 0.8])
def test_prior_comes_from_positives_and_unlabelled_rows(spark, share):
    table, *_, good = _mixture(spark, 4000, share, 300)
    assert abs(quality_classifier.estimated_prior(table) - good.mean()) < 0.06
    assert quality_classifier.estimated_prior(table.withColumn("p", F.lit(0).cast("byte"))) is None


def test_labels_of_zero_are_no_examples(spark):
    """Scores are the same without any row labelled 0; with no trusted positive, or one, there still is a score."""
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scores = lambda some: {r.doc_id: round(r.score, 6) for r in quality_classifier.quality_scores(d, some, fold(3) != 1).collect()}
    assert scores(labels) == scores(labels.filter("quality = 1"))
    assert set(scores(labels.filter("quality = 0")).values()) == {0.5}
    one = scores(labels.filter("quality = 1").filter(fold(3) != 1).orderBy("doc_id").limit(1))
    assert len(one) == 200 and all(0 <= s <= 1 for s in one.values())


# --- BPE


@pytest.fixture(scope="module")
def peer():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="ab c\n\t  éß'sDll09.,\u0085 ", max_size=80), st.text(alphabet="ab", min_size=30, max_size=200)))
def test_bpe_is_tiktoken(peer, text):
    c = bpe.codec(RANKS, PATTERN)
    ids = c.encode(text)
    assert ids == peer.encode_ordinary(text) and c.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=2, max_size=bpe.WIDEST), st.text(alphabet="abeintrs ", min_size=2, max_size=40).map(str.encode)), min_size=1, max_size=30))
def test_trees_side_by_side_merge_like_one_tree(parts):
    c = bpe.codec(RANKS, PATTERN)
    parts = [p for p in parts if p not in c.ranks]
    got = [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(parts, c.single, c.pairs)]
    assert got == [bpe.merge(p, c.ranks) for p in parts]


def test_texts_learned_together(peer, rows):
    """In one batch, and piece by piece once the memory has turned over."""
    texts = [t or "" for _, t, *_ in rows]
    want = [peer.encode_ordinary(t) for t in texts]
    for most in (400_000, 5):
        c = bpe.Codec(RANKS, PATTERN, most)
        assert list(c.encode_all(texts)) == want and list(map(c.encode, texts)) == want


def test_long_run_without_a_boundary(peer):
    c = bpe.codec(RANKS, PATTERN)
    text = "ab" * 20_000 + "é" * 500
    assert c.decode(c.encode(text)) == text.encode()
    assert c.encode("abcab" * 300) == peer.encode_ordinary("abcab" * 300)


def test_encode_frames(docs, rows, peer):
    want = Counter()
    for i, t, *_ in rows:
        ids = peer.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.encode_digests(docs, RANKS, PATTERN).collect())) == want
    full = bpe.encode(docs, RANKS, PATTERN)
    assert all(bytes(r.decoded) == bpe.codec(RANKS, PATTERN).decode(r.ids) for r in full.collect())
    assert bpe.decode(full.drop("decoded"), RANKS, PATTERN).count() == len(rows)


# --- packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(lengths):
    bins, offsets, fills = packing.best_fit(lengths, 50)
    for b, fill in enumerate(fills):
        spans = sorted((offsets[k], offsets[k] + lengths[k]) for k in range(len(lengths)) if bins[k] == b)
        assert spans[0][0] == 0 and spans[-1][1] == fill <= 50 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert not any(a + b <= 50 for k, a in enumerate(fills) for b in fills[k + 1 :])  # no two bins fit together


def _fewest(lengths: list[int], size: int) -> int:
    """The least number of bins, by trying all ways."""
    best = [len(lengths)]

    def place(k: int, free: list[int]) -> None:
        if len(free) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(free)
            return
        for f in set(free):
            if f >= lengths[k]:
                rest = list(free)
                rest[rest.index(f)] -= lengths[k]
                place(k + 1, rest)
        place(k + 1, [*free, size - lengths[k]])

    place(0, [])
    return best[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=9))
def test_best_fit_needs_few_bins(lengths):
    """At most 11/9 of the best number and 6/9 more, as is proved of best fit on falling lengths."""
    assert len(packing.best_fit(lengths, 50)[2]) <= 11 / 9 * _fewest(lengths, 50) + 6 / 9


@pytest.mark.parametrize("group_items", [15_000, 7, 2])
def test_rounds_go_on_until_no_two_bins_fit(spark, group_items):
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.choice([1, 2, 30, 45, 49, 60, 95], 120)]
    d = spark.createDataFrame([(k, n, k, 0, n) for k, n in enumerate(lengths)], "id long, length long, bin long, offset long, fill long")
    got = packing.pack(d, 100, group_items).collect()
    fill, spans = Counter(), {}
    for r in got:
        fill[r.sequence_id] += r.length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert Counter(r.length for r in got) == Counter(lengths)
    assert all(max(b for _, b in s) == fill[k] <= 100 and all(x[1] == y[0] for x, y in zip(sorted(s), sorted(s)[1:], strict=False)) for k, s in spans.items())
    small = sorted(fill.values())[:2]
    assert len(small) < 2 or sum(small) > 100


def test_ids_of_whole_texts_are_the_tokenizers(spark):
    """All texts of the tables: encoding by pieces and ranks gives what the tokenizer gives for the whole text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, data in zip(texts, packing.Encoder(path, most=20_000).of(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("group_items", [15_000, 12])
def test_pack_documents(spark, docs, rows, group_items):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, group_items=group_items).collect()
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) - (len(ids) - 1) // 2048 * 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for spans in bins.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) * 1.1 + 2
    assert packing.pack_documents(frame(spark, []), path).count() == 0


def test_pieces_go_with_their_task(spark, docs, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert {r["id"] for r in packing.tokenised(docs, path).collect()} == {r[0] for r in rows}

    def remembered(batches):
        for b in batches:
            enc = packing.encoder(path)
            yield pa.record_batch({"n": pa.array([len(enc.known) + len(enc.older)] * b.num_rows, pa.int64())})

    assert {r["n"] for r in spark.range(0, 8, 1, 8).mapInArrow(remembered, "n long").collect()} == {0}
