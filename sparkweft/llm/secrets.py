"""Secret scans: three base patterns, and a character convolutional network over wider candidates.

Base findings are matches of fixed patterns and always stay. Candidates are wider: token-like runs with a
digit or a change of case, values given to a name that suggests a credential, user:password parts of URLs, private
key blocks. The network reads every character of a candidate and the text on both sides of it: a convolution, then
its maximum over each part (before, first characters, middle, last characters, after) and its mean over the
candidate. Candidates of any length are read whole, in slices whose maxima and sums are combined.

It is written in numpy and trained from labelled findings (a seeded generator makes them: contexts and values of
secrets, and of what only looks like one). A candidate's score is calibrated (Platt), and its threshold is, for each
kind, the largest that keeps the wanted recall on findings held out from training, or lower where that lets in no
more held-out decoys (not below an even chance). The trained weights are kept beside
this module (secret_weights.npz; `python -m sparkweft.llm.secrets` makes the file anew); tasks get them with their
code, some 20,000 numbers. Accepted candidates are added unless base findings cover them wholly; those that overlap
each other are added as one. Finding candidates takes time linear in the text.

Defined results: null and empty text have no findings; whole texts are scanned; rows are scanned one by one, so
repeated rows come back repeated; an empty table gives an empty result; other columns are ignored (scan) or kept (redact).
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CI = re.ASCII | re.IGNORECASE
#: The base patterns and the least lengths of what counts (for assign: of group 2).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _CI)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ADDED = "network"
ORDER = {k: i for i, k in enumerate(("assign", "access", "hex", ADDED))}
#: Names that suggest a credential; texts without any of these have no match of ASSIGN or PAIR.
NAMES = ("pass", "pwd", "secret", "token", "credential", "auth", "key")
_NAME = re.compile("pass(?:word|wd|phrase)?|pwd|secret|token|credential|auth|(?:api|private|access|signing|encryption)[_-]?key", _CI)
#: Candidates besides token-like runs; the span is the last group. A name's run is tried once, from its start.
PAIR = re.compile(r"""(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)["']?+\s*+(?:=>|[:=]|is(?=\s))\s*+["']?+([^\s"'<>,;|]{6,})""", _CI)
URL = re.compile(r"(?<=[A-Za-z0-9])://[^\s/:@]*+:([^\s/@]{3,})@")
BEGIN, FINISH = re.compile("-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"), re.compile("-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----")
#: What may follow a key block's first line where its last one is missing: header lines and encoded lines.
_BODY = re.compile(r"(?:(?:\s|\\[nr])*+(?:[A-Za-z][A-Za-z0-9-]*: [^\n]*|[A-Za-z0-9+/=]{16,}+))*+(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{2,}={1,2})?")
KINDS = ["run", "pair", "url", "block"]
RUN_LEAST = 16
_VARIED = re.compile("[0-9]|[a-z][A-Z]")
_RUN_CHARS = np.zeros(129, bool)
_RUN_CHARS[[ord(c) for c in string.ascii_letters + string.digits + "+/_.=-"]] = True

#: Characters seen before and after a candidate, and how many of its own are its head and its tail.
LEFT, HEAD, TAIL, RIGHT = 28, 36, 8, 12
#: Parts of what is seen; 0 is padding.
PARTS = 5
_PAD, _OTHER = 0, 1
#: Places of a sequence that are computed at once.
SLICE = 512


def runs(text: str) -> list[tuple[int, int]]:
    """Bounds of the runs of at least RUN_LEAST token-like characters; every ACCESS and HEX that counts lies in one."""
    if len(text) < RUN_LEAST:
        return []
    inside = _RUN_CHARS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= RUN_LEAST
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def _named(text: str) -> bool:
    low = text.lower()
    return any(x in low for x in NAMES)


def base_findings(text: str, found_runs: list[tuple[int, int]] | None = None, named: bool | None = None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping within a kind."""
    out = []
    if _named(text) if named is None else named:
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    for a, b in runs(text) if found_runs is None else found_runs:
        if b - a >= ACCESS_LEAST:
            out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= ACCESS_LEAST]
        if b - a >= HEX_LEAST:
            out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text, a, b)]
    out.sort(key=lambda x: (x[0], ORDER[x[1]]))
    return out


def blocks(text: str) -> list[tuple[int, int]]:
    """Bounds of key blocks: to the last line if it comes before another first line, else as far as it looks like one."""
    begins = [m.span() for m in BEGIN.finditer(text)]
    ends = [m.span() for m in FINISH.finditer(text)] if begins else []
    out = []
    for k, (a, b) in enumerate(begins):
        following = begins[k + 1][0] if k + 1 < len(begins) else len(text)
        e = bisect_left(ends, (b, 0))
        out.append((a, ends[e][1] if e < len(ends) and ends[e][0] < following else _BODY.match(text, b, following).end()))
    return out


def candidates(text: str, found_runs: list[tuple[int, int]] | None = None, named: bool | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind): runs with a digit or a change of case, values of telling names, passwords in URLs, key blocks; of the same span only the latter kind."""
    out = {(a, b): "run" for a, b in (runs(text) if found_runs is None else found_runs) if _VARIED.search(text, a, b)}
    if _named(text) if named is None else named:
        out |= {m.span(2): "pair" for m in PAIR.finditer(text) if _NAME.search(m[1])}
    if "://" in text:
        out |= {m.span(1): "url" for m in URL.finditer(text)}
    if "-----BEGIN " in text:
        out |= {x: "block" for x in blocks(text)}
    return sorted((a, b, k) for (a, b), k in out.items())


def seen(text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of a candidate with the text around it, and the part (1 to PARTS) each belongs to."""
    a, b = max(0, start - LEFT), min(len(text), end + RIGHT)
    codes = np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where((codes >= 32) & (codes < 127), codes, _OTHER).astype(np.int64)
    n, before = end - start, start - a
    part = np.full(b - a, 3, np.int64)
    part[:before] = 1
    part[before : before + min(n, HEAD)] = 2
    part[before + max(HEAD, n - TAIL) : before + n] = 4
    part[before + n :] = 5
    return codes, part


class Network:
    """Embedding, one convolution, pooling by part, two dense layers; trained by Adam on the logistic loss."""

    def __init__(self, seed: int = 0, dim: int = 10, width: int = 5, filters: int = 32, hidden: int = 24):
        rng = np.random.default_rng(seed)
        self.width, self.dim, self.filters = width, dim, filters
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        depth, pooled = dim + PARTS, (PARTS + 1) * filters + 1
        self.w = {
            "embed": normal(127, dim, scale=0.3),
            "conv": normal(width * depth, filters, scale=math.sqrt(2 / (width * depth))), "conv_b": np.zeros(filters, np.float32),
            "dense": normal(pooled, hidden, scale=math.sqrt(2 / pooled)), "dense_b": np.zeros(hidden, np.float32),
            "out": normal(hidden, scale=math.sqrt(1 / hidden)), "out_b": np.zeros(1, np.float32),
        }

    def _convolved(self, x: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs of the convolution and its activations, for rows of codes with their parts (0: padding)."""
        n, length = x.shape
        w, half = self.w, self.width // 2
        inputs = np.concatenate([w["embed"][x], np.eye(PARTS + 1, dtype=np.float32)[part][:, :, 1:]], axis=2) * (part > 0)[:, :, None]
        padded = np.pad(inputs, ((0, 0), (half, half), (0, 0)))
        cols = np.concatenate([padded[:, k : k + length] for k in range(self.width)], axis=2)
        return cols, np.maximum(cols.reshape(n * length, -1) @ w["conv"] + w["conv_b"], 0).reshape(n, length, -1)

    @staticmethod
    def _tops(act: np.ndarray, part: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each part: where each filter is largest, and how large (0 where a row lacks the part)."""
        tops = [np.where((part == s)[:, :, None], act, -1).argmax(axis=1) for s in range(1, PARTS + 1)]
        return tops, [np.take_along_axis(act, t[:, None], axis=1)[:, 0] * (part == s).any(axis=1)[:, None] for s, t in enumerate(tops, 1)]

    def _dense(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(flat @ self.w["dense"] + self.w["dense_b"], 0)
        return h, h @ self.w["out"] + self.w["out_b"][0]

    def logits(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For what seen() gives of candidates of any length: slices are convolved with their neighbours' edges, then pooled together."""
        half, f = self.width // 2, self.filters
        most, total = np.zeros((len(found), PARTS * f), np.float32), np.zeros((len(found), f), np.float32)
        size = np.array([np.count_nonzero((p > 1) & (p < 5)) for _, p in found], np.float32)
        slices = sorted((min(SLICE, len(codes) - a), k, a) for k, (codes, _) in enumerate(found) for a in range(0, len(codes), SLICE))
        at = 0
        while at < len(slices):
            end = at + 1
            while end < len(slices) and (end + 1 - at) * slices[end][0] <= 32_768:
                end += 1
            rows, length = slices[at:end], slices[end - 1][0] + 2 * half
            x, part, own = np.zeros((len(rows), length), np.int64), np.zeros((len(rows), length), np.int64), np.zeros((len(rows), length), bool)
            for r, (n, k, a) in enumerate(rows):
                lo, hi = max(0, a - half), min(len(found[k][0]), a + n + half)
                x[r, half - (a - lo) : half + hi - a], part[r, half - (a - lo) : half + hi - a] = found[k][0][lo:hi], found[k][1][lo:hi]
                own[r, half : half + n] = True
            act = self._convolved(x, part)[1]
            part = part * own
            of = np.array([k for _, k, _ in rows])
            np.maximum.at(most, of, np.concatenate(self._tops(act, part)[1], axis=1))
            np.add.at(total, of, (act * ((part > 1) & (part < 5))[:, :, None]).sum(axis=1))
            at = end
        return self._dense(self._flat(most, total, size))[1] if len(found) else np.empty(0, np.float32)

    @staticmethod
    def _flat(most: np.ndarray, total: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.concatenate([most, total / np.maximum(size, 1)[:, None], np.log1p(size)[:, None] / 8], axis=1).astype(np.float32)

    def _gradients(self, x: np.ndarray, part: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, w, f = len(x), self.w, self.filters
        length = x.shape[1]
        cols, act = self._convolved(x, part)
        tops, most = self._tops(act, part)
        inside = (part > 1) & (part < 5)
        size = inside.sum(axis=1).astype(np.float32)
        flat = self._flat(np.concatenate(most, axis=1), (act * inside[:, :, None]).sum(axis=1), size)
        h, z = self._dense(flat)
        dz = ((1 / (1 + np.exp(-z)) - y) / n).astype(np.float32)
        g = {"out": h.T @ dz, "out_b": dz.sum(keepdims=True)}
        dh = dz[:, None] * w["out"] * (h > 0)
        g |= {"dense": flat.T @ dh, "dense_b": dh.sum(axis=0)}
        dflat = dh @ w["dense"].T
        dact = (dflat[:, PARTS * f : (PARTS + 1) * f] / np.maximum(size, 1)[:, None])[:, None] * inside[:, :, None]
        rows, lanes = np.arange(n)[:, None], np.arange(f)[None]
        for s, t in enumerate(tops):
            dact[rows, t, lanes] += dflat[:, s * f : (s + 1) * f] * (part == s + 1).any(axis=1)[:, None]
        dact = (dact * (act > 0)).reshape(n * length, f)
        g |= {"conv": cols.reshape(n * length, -1).T @ dact, "conv_b": dact.sum(axis=0)}
        dcols = (dact @ w["conv"].T).reshape(n, length, self.width, -1)
        dseen, half = np.zeros((n, length, self.dim), np.float32), self.width // 2
        for k in range(self.width):
            a, b = max(0, half - k), length - max(0, k - half)
            dseen[:, a + k - half : b + k - half] += dcols[:, a:b, k, : self.dim]
        g["embed"] = np.zeros_like(w["embed"])
        there = part > 0
        np.add.at(g["embed"], x[there], dseen[there])
        return g

    def fit(self, found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int, rate: float = 3e-3, batch: int = 64, seed: int = 1) -> None:
        """found: as from seen(). Batches hold candidates of like length, in an order drawn anew for each epoch."""
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(v) for k, v in self.w.items()}
        sizes = np.array([len(c) for c, _ in found])
        for epoch in range(epochs):
            order = np.lexsort((rng.random(len(found)), sizes // 16))
            batches = [order[at : at + batch] for at in range(0, len(order), batch)]
            for b in rng.permutation(len(batches)):
                own = batches[b]
                x, part = (np.zeros((len(own), int(sizes[own].max())), np.int64) for _ in range(2))
                for r, k in enumerate(own):
                    x[r, : sizes[k]], part[r, : sizes[k]] = found[k]
                step += 1
                for k, g in self._gradients(x, part, y[own]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    scale = rate * 0.6**epoch * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.w[k] -= scale * m[k] / (np.sqrt(v[k]) + 1e-8)


_HEX, _ALNUM, _B64 = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"


def labelled_findings(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """(text, start, end, kind of candidate, 1 for a secret): one candidate each from n made-up texts, half of them secrets."""
    rng = random.Random(seed)
    of = lambda chars, a, b=None: "".join(rng.choices(chars, k=rng.randint(a, b or a)))
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ción ung ch sch eau ment que ß ä é ñ".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    ascii_word = lambda: "".join(rng.choices(syllables[:34], k=rng.randint(1, 4)))

    def prose() -> str:
        words, marks = [word() for _ in range(rng.randint(1, 7))], rng.choice([[""]] * 5 + [["!!"], ["%%%", "&&&", "***", "###", "$$$"], [" |"], [",", "."]])
        words = [w + rng.choice(marks) for w in words]
        return " ".join(w.upper() for w in words) if rng.random() < 0.2 else " ".join(words)

    mixed = lambda a, b: of(string.ascii_letters, a, b) + of(string.digits, 2) + of(_ALNUM, 2)
    secrets = [
        lambda: (rng.choice(["ghp_", "gho_", "ghs_", "github_pat_"]), of(_ALNUM, 30, 40)), lambda: (rng.choice(["sk_live_", "rk_live_", "sk-", "pk_live_"]), mixed(18, 40)),
        lambda: (rng.choice(["xoxb-", "xoxp-"]), of(string.digits, 10, 12) + "-" + of(string.digits, 10, 12) + "-" + mixed(20, 24)), lambda: ("AIza", mixed(30, 32)),
        lambda: ("glpat-", mixed(16, 18)), lambda: ("npm_", mixed(30, 34)), lambda: ("SG.", mixed(18, 20) + "." + mixed(38, 40)), lambda: ("hf_", mixed(30, 34)),
        lambda: ("eyJ", of(_ALNUM, 20, 40) + ".eyJ" + of(_ALNUM, 20, 60) + "." + of(_ALNUM + "-_", 20, 43)), lambda: ("ya29.", mixed(40, 80)),
    ]
    names = ["secret", "password", "passwd", "pwd", "token", "access_token", "auth_token", "api_key", "apikey", "client_secret", "aws_secret_access_key", "private_key", "credential", "passphrase", "db_password", "Authorization: Bearer", "key", "signing_key"]
    looks = [
        lambda: of(string.digits, 16, 19), lambda: rng.choice("3456") + of(string.digits, 15), lambda: ".".join(ascii_word() + of(string.digits, 0, 2) for _ in range(rng.randint(3, 4))) + rng.choice([".com", ".example.com", ".net", ".org"]),
        lambda: "-".join([of(_HEX, 8), of(_HEX, 4), of(_HEX, 4), of(_HEX, 4), of(_HEX, 12)]), lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}",
        lambda: "_".join(ascii_word() for _ in range(3)) + "_" + of(string.digits, 1, 4), lambda: "/".join(ascii_word() + of(string.digits, 0, 2) for _ in range(4)) + f"/{rng.randint(0, 999)}.html",
        lambda: ascii_word() + of(string.digits, 2, 4) + "-" + ascii_word() + "-" + ascii_word() + "-" + ascii_word(), lambda: "=" * rng.randint(3, 8) + of(string.digits, 1, 3) + "-" * rng.randint(10, 20),
        lambda: "".join(ascii_word() for _ in range(5)) + of(string.digits, 1, 2), lambda: ".".join(of(string.digits, 1, 3) for _ in range(rng.randint(4, 7))) + "-" + ascii_word() + "-" + ascii_word(),
        lambda: ascii_word() + rng.choice("=+") + of(string.digits, 1, 3) + rng.choice("=+") + "".join(ascii_word() for _ in range(3)), lambda: "+" + "-".join(of(string.digits, 2, 4) for _ in range(5)),
        lambda: of(string.ascii_uppercase, 3, 8) + "-" + of(string.digits, 4, 8) + "-" + of(string.ascii_uppercase, 2, 6) + of(string.digits, 1, 3), lambda: "v" + of(string.digits, 1) + "." + of(string.digits, 1, 2) + "." + of(string.digits, 1, 2) + "-" + ascii_word() + "." + ascii_word(),
        lambda: of("0123456789.", 17, 24), lambda: "/".join(ascii_word() for _ in range(rng.randint(6, 14))) + f"-{rng.randint(1, 99)}.html", lambda: "".join(ascii_word().title() for _ in range(rng.randint(3, 7))),
        lambda: "iVBORw0KGgo" + of(_B64, 80, 300), lambda: "-".join(ascii_word() for _ in range(rng.randint(6, 16))), lambda: "_".join(of(string.ascii_uppercase, 3, 7) for _ in range(4)) + of(string.digits, 1, 2),
    ]
    # What a secret may stand behind in one run of characters.
    fronts = [lambda: ".".join(ascii_word() for _ in range(rng.randint(3, 6))) + "=", lambda: "/".join(ascii_word() for _ in range(rng.randint(3, 6))) + "/", lambda: "_".join(ascii_word().upper() for _ in range(rng.randint(3, 5))) + "=", lambda: "//hooks." + ascii_word() + ".com/services/T" + of(string.ascii_uppercase + string.digits, 8) + "/B" + of(string.ascii_uppercase + string.digits, 8) + "/"]
    headers = ["Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0123456789ABCDEF" * 2 + "\n\n", "Comment: made here\n\n"]
    plain_names = ["sha512", "checksum", "integrity=", "md5", "commit", "digest", "etag", "uuid", "isbn", "order", "file", "build", "version", "id", "ref", "host", "path", "image/png;base64"]
    out = []
    while len(out) < n:
        label = len(out) % 2
        quote = rng.choice(["", "", '"', "'"])
        glue = rng.choice([" = ", "=", ": ", ":", " => ", " "])
        draw = rng.random()
        if label:
            if draw < 0.45:
                head, rest = rng.choice(secrets)()
                kind, value = "run", (rng.choice(fronts)() if rng.random() < 0.2 else "") + head + rest
                before = rng.choice([prose() + " ", rng.choice(names) + glue + quote, prose() + " " + rng.choice(names).upper() + glue + quote])
            elif draw < 0.7:
                kind, value = "run", rng.choice([lambda: mixed(20, 44), lambda: of(_B64, 38, 60) + "9=", lambda: of(_HEX.upper(), 30, 40) + "7A"])()
                before = prose() + " " + rng.choice([str, str.upper, str.title])(rng.choice(names)) + rng.choice([" = ", "=", ": ", ":", " "]) + quote
            elif draw < 0.85:
                kind, value = "pair", rng.choice([lambda: of(string.ascii_letters, 4, 8) + of(string.digits, 1, 4) + of("!@#$%^&*?", 1, 2), lambda: of(_ALNUM + "!@#$%^&*~", 8, 20) + of("!#$%", 1), lambda: of(string.ascii_lowercase, 5, 9) + of(string.digits, 2, 4)])()
                before = prose() + " " + rng.choice(["password", "passwd", "pwd", "secret", "pass", "passphrase", "db_password", "api-key", "auth"]) + rng.choice([" = ", "=", ": ", ":", " is ", " => "]) + quote
            elif draw < 0.95:
                kind, value = "url", rng.choice([lambda: of(_ALNUM + "!#$%", 6, 18), lambda: of(string.ascii_lowercase, 4, 8) + of(string.digits, 1, 3) + of(string.ascii_lowercase, 0, 3)])()
                before = prose() + " " + rng.choice(["postgres", "mysql", "mongodb+srv", "redis", "amqp", "https"]) + "://" + ascii_word() + ":"
                quote = "@" + ascii_word() + ".example.com/" + ascii_word()
            else:
                of_key = rng.choice(["RSA ", "EC ", "OPENSSH ", "ENCRYPTED ", ""])
                lines = "\n".join(of(_B64, 64) for _ in range(rng.randint(1, 5))) + "\n" + of(_B64, 4, 60) + rng.choice(["", "=", "=="])
                kind, value = "block", f"-----BEGIN {of_key}PRIVATE KEY-----\n" + (rng.choice(headers) if rng.random() < 0.4 else "") + lines + (f"\n-----END {of_key}PRIVATE KEY-----" if rng.random() < 0.8 else "")
                before = prose() + "\n"
        elif draw < 0.75:
            kind, value = "run", rng.choice(looks)()
            before = rng.choice([prose() + " ", prose() + " " + rng.choice(plain_names) + glue + quote, prose() + "@"])
        elif draw < 0.85:
            kind, value = "run", rng.choice([lambda: of(_B64, 40, 60) + "1=", lambda: of(_HEX.upper(), 30, 40) + "7A", lambda: mixed(20, 40)])()
            before = prose() + " " + rng.choice(plain_names) + glue + quote
        elif draw < 0.94:
            kind, value = "pair", rng.choice([ascii_word, lambda: "<" + ascii_word(), lambda: "${" + ascii_word().upper() + "}", lambda: "*" * 8, lambda: "".join(ascii_word() for _ in range(2)) + rng.choice([".", "...", ")", "?"]), lambda: "os.environ[" + ascii_word(), lambda: "required", lambda: "changeme", lambda: "function(" + ascii_word()])()
            value += "x" * max(0, 6 - len(value)) if value.isalpha() else ""
            before = prose() + " " + rng.choice(["password", "secret", "token", "pass", "authentication", "tokenizer", "passing", "author", "secretary"]) + rng.choice([" = ", ": ", " is ", " is ", ":"])
        elif draw < 0.97:
            kind, value = "block", "-----BEGIN PRIVATE KEY-----" + rng.choice(["", " " + " ".join(prose() for _ in range(rng.randint(1, 9))) + " -----END PRIVATE KEY-----", "\n...\n-----END PRIVATE KEY-----"])
            before = prose() + " "
        else:
            kind, value = "url", rng.choice(["password", "PASSWORD", "xxxxx", "****", "pass", "$PASS", "${PW}", "<password>"])
            before, quote = prose() + " https://user:", "@" + ascii_word() + ".example.com/"
        text = before + value + quote + rng.choice(["", " ", ". ", "\n", ", ", "!! ", "### "]) + prose()
        out.append((text, len(before), len(before) + len(value), kind, label))
    return out


class Scanner:
    """The trained network with its calibration and its threshold for each kind."""

    def __init__(self, n: int = 24_000, epochs: int = 8, seed: int = 11, recall: float = 0.98):
        found = labelled_findings(n, seed)
        x = [seen(t, a, b) for t, a, b, _, _ in found]
        y = np.array([f[4] for f in found], np.float32)
        kind = np.array([KINDS.index(f[3]) for f in found])
        cut = n * 2 // 3
        self.network = Network()
        self.network.fit(x[:cut], y[:cut], epochs)
        z, target = self.network.logits(x[cut:]), y[cut:]
        self.slope, self.shift = _platt(z, target)
        self.held_out = np.stack([self.probability(z), target, kind[cut:]])
        self.constrain(recall)

    def constrain(self, recall: float) -> Scanner:
        """Sets, for each kind, the largest threshold that keeps the recall on the held-out findings, lowered as far as no
        more decoys pass (to an even chance at the most); report says what that gives."""
        p, target, kind = self.held_out
        self.thresholds, self.report = [], {}
        for k, name in enumerate(KINDS):
            own = kind == k
            yes = np.sort(p[own & (target == 1)])
            least = float(yes[int(math.floor((1 - recall) * len(yes)))]) if len(yes) else 0.5
            decoys = p[own & (target == 0)]
            least = min(least, max(0.5, float(np.nextafter(decoys[decoys < least].max(initial=0.0), 1.0))))
            self.thresholds.append(least)
            hit = p[own] >= least
            self.report[name] = {"recall": float(hit[target[own] == 1].mean()) if len(yes) else 1.0, "false": float(hit[target[own] == 0].mean()) if (target[own] == 0).any() else 0.0, "threshold": least}
        return self

    def save(self, path: str | Path) -> None:
        np.savez_compressed(path, platt=np.array([self.slope, self.shift]), held_out=self.held_out, **self.network.w)

    @classmethod
    def load(cls, path: str | Path, recall: float = 0.98) -> Scanner:
        made = cls.__new__(cls)
        made.network = Network()
        with np.load(path) as f:
            (made.slope, made.shift), made.held_out = f["platt"].tolist(), f["held_out"]
            made.network.w = {k: f[k] for k in made.network.w}
        return made.constrain(recall)

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * z.astype(np.float64) + self.shift)))

    def findings(self, texts: list[str]) -> list[tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]]:
        """(base findings, all findings) of each text, as (start, kind, end); added ones do not overlap each other."""
        base, accepted = [], [[] for _ in texts]
        rows, where, held = [], [], 0

        def score() -> None:
            p = self.probability(self.network.logits(rows))
            for (i, a, b, k), q in zip(where, p.tolist(), strict=True):
                if q >= self.thresholds[k]:
                    accepted[i].append((a, b))
            rows.clear()
            where.clear()

        for i, text in enumerate(texts):
            found_runs, named = runs(text), _named(text)
            base.append(base_findings(text, found_runs, named))
            for a, b, kind in candidates(text, found_runs, named):
                rows.append(seen(text, a, b))
                where.append((i, a, b, KINDS.index(kind)))
                held += len(rows[-1][0])
                if held >= 1 << 20:
                    score()
                    held = 0
        if rows:
            score()
        return [(own, sorted(own + _apart(own, more), key=lambda x: (x[0], ORDER[x[1]], x[2]))) for own, more in zip(base, accepted, strict=True)]


def _apart(base: list[tuple[int, str, int]], more: list[tuple[int, int]]) -> list[tuple[int, str, int]]:
    """Those of `more` that reach beyond the base findings, overlapping ones as one."""
    if not more:
        return []
    starts, ends, out = [], [], []  # of the base findings as disjoint stretches
    for a, _, b in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for a, b in sorted(more):
        k = bisect_right(starts, a) - 1
        if k >= 0 and b <= ends[k]:
            continue
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], ADDED, max(b, out[-1][2]))
        else:
            out.append((a, ADDED, b))
    return out


def _platt(z: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and shift of the logistic fit of labels on logits, by Newton's method with a slight pull to (1, 0)."""
    x = np.stack([z.astype(np.float64), np.ones(len(z))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (p - y) + (w - [1, 0]))
    return float(w[0]), float(w[1])


#: The weights, calibration and held-out scores that Scanner() gives.
WEIGHTS = Path(__file__).with_name("secret_weights.npz")


@lru_cache(maxsize=2)
def scanner(recall: float = 0.98) -> Scanner:
    """Read once in a process; tasks get it with their code."""
    return Scanner.load(WEIGHTS, recall)


def _joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = 0.98) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_network, base_sha256, spans for each row of docs."""
    with_weights = scanner(recall)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 256) for k in range(0, b.num_rows, 256)):
                found = with_weights.findings([x.as_py() or "" for x in part["text"]])
                count = lambda kind: pa.array([sum(k == kind for _, k, _ in every) for _, every in found], pa.int64())  # noqa: B023, E731
                yield pa.record_batch({
                    "id": part["id"], "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"), "n_network": count(ADDED),
                    "base_sha256": pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string()),
                    "spans": pa.array([_joined(every) for _, every in found], pa.string()),
                })

    schema = "id long, n_assign long, n_access long, n_hex long, n_network long, base_sha256 string, spans string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redacted(text: str, found: list[tuple[int, str, int]], mark: str = "[secret]") -> str:
    """text with every finding (overlapping ones as one) replaced by the mark."""
    out, at = [], 0
    for a, _, b in sorted(found):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", recall: float = 0.98) -> DataFrame:
    """docs with the findings in its texts replaced; a row without findings stays as it is. length_col, where there is one, follows changed texts."""
    with_weights = scanner(recall)
    has_length = length_col in docs.columns
    at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # names with dots and the like cannot be sent to Python
    at_length = docs.columns.index(length_col) if has_length else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(k, 256) for k in range(0, b.num_rows, 256)):
                texts = part.column(at).to_pylist()
                found = [every for _, every in with_weights.findings([t or "" for t in texts])]
                if any(found):
                    columns = list(part.columns)
                    columns[at] = pa.array([redacted(t, f) if f else t for t, f in zip(texts, found, strict=True)], columns[at].type)
                    if has_length:
                        new = zip(columns[at_length].to_pylist(), columns[at].to_pylist(), found, strict=True)
                        columns[at_length] = pa.array([len(t) if f else n for n, t, f in new], columns[at_length].type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


if __name__ == "__main__":
    made = Scanner()
    made.save(WEIGHTS)
    print(made.report)
