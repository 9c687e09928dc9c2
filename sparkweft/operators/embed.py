"""Embedders behind a small protocol: a model gets batches, by an iterator UDF, and is loaded once in a worker; what needs no batch gets rows."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkweft.config import Config
from sparkweft.functions.rows import row_udf


class Embedder(Protocol):
    dimension: int

    def embed_texts(self, texts: Sequence[str]) -> list[list[float]]: ...

    def embed_query(self, text: str) -> list[float]: ...


class HashingEmbedder:
    """Signed feature hashing of words and word pairs, of unit length; needs no model and is the same everywhere."""

    row_by_row = True  # a batch is no faster

    def __init__(self, dimension: int = 384):
        self.dimension = dimension

    def embed_query(self, text: str) -> list[float]:
        words = re.findall(r"\w+", text.lower())
        out = np.zeros(self.dimension)
        for w in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]:
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            out[h % self.dimension] += 1 if h >> 63 else -1
        return (out / max(np.linalg.norm(out), 1e-12)).astype(np.float32).tolist()

    def embed_texts(self, texts: Sequence[str]) -> list[list[float]]:
        return [self.embed_query(t) for t in texts]


class SentenceTransformerEmbedder:
    """A model of the sentence-transformers library, where that is installed; loaded on first use."""

    def __init__(self, model: str, dimension: int = 384, batch: int = 32, device: str = "auto"):
        self.model, self.dimension, self.batch, self.device, self._loaded = model, dimension, batch, device, None

    def _get(self):
        if self._loaded is None:
            from sentence_transformers import SentenceTransformer

            self._loaded = SentenceTransformer(self.model, device=resolve_device(self.device))
        return self._loaded

    def embed_texts(self, texts: Sequence[str]) -> list[list[float]]:
        return self._get().encode(list(texts), batch_size=self.batch, normalize_embeddings=True).tolist()

    def embed_query(self, text: str) -> list[float]:
        return self.embed_texts([text])[0]


def resolve_device(name: str) -> str:
    """auto: cuda if it can be used, else cpu."""
    if name not in ("auto", "cpu", "cuda"):
        raise ValueError(f"unknown device: {name}")
    if name != "auto":
        return name
    try:
        import torch

        return "cuda" if torch.cuda.is_available() else "cpu"
    except ImportError:
        return "cpu"


PROVIDERS = {
    "hashing": lambda c: HashingEmbedder(c.embedding_dimension),
    "sentence_transformers": lambda c: SentenceTransformerEmbedder(c.embedding_model, c.embedding_dimension, c.embedding_batch, c.device),
}


def build_embedder(config: Config) -> Embedder:
    if config.embedding_provider not in PROVIDERS:
        raise ValueError(f"unknown embedding provider: {config.embedding_provider}")
    return PROVIDERS[config.embedding_provider](config)


def embedding(text: Column, embedder: Embedder, batch: int = 256) -> Column:
    """The vectors of a text column (null for null)."""
    if getattr(embedder, "row_by_row", False):
        return row_udf("array<float>")(lambda t: None if t is None else embedder.embed_query(t))(text)

    import pandas as pd  # here, as workers that need none would hold it all the same

    def run(batches):
        for texts in batches:
            out = []
            for k in range(0, len(texts), batch):
                part = texts.iloc[k : k + batch]
                found = iter(embedder.embed_texts([t for t in part if t is not None]))
                out += [None if t is None else next(found) for t in part]
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<float>")(text)
