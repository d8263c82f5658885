"""Encoders: named functions from texts to unit vectors, with a licence and language gate."""

from __future__ import annotations

import importlib.util
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.segment import fitted
from fathomline.operators.store import pending
from fathomline.registry import Registry
from fathomline.session import small_batches

#: Licences that a production encoder may have, and the languages of which it must cover one.
LICENSES, LANGUAGES = ("apache-2.0", "mit", "cc-by-4.0"), ("es", "en", "pt")


@dataclass(frozen=True)
class Encoder:
    """encode: list of texts to an n x dim array, not normalised; prefixes go before queries and passages; needs names a
    package without which it can't run."""

    name: str
    dim: int
    encode: Callable[[list[str]], np.ndarray]
    max_tokens: int = 512
    languages: tuple[str, ...] = LANGUAGES
    license: str = "apache-2.0"
    complementary: bool = False
    query_prefix: str = ""
    passage_prefix: str = ""
    model_id: str = ""
    needs: str = ""

    @property
    def available(self) -> bool:
        """Whether the package that the encoder needs is there."""
        return not self.needs or importlib.util.find_spec(self.needs) is not None


class Encoders(Registry[Encoder]):
    def available(self) -> list[str]:
        return [name for name in self.names() if self.get(name).available]

    def add(self, encoder: Encoder) -> Encoder:
        if not encoder.complementary and not set(encoder.languages) & set(LANGUAGES):
            raise ValueError(f"{encoder.name}: covers none of {', '.join(LANGUAGES)} and is not complementary")
        return self.register(encoder.name)(encoder)

    def create(self, name: str, *, any_license: bool = False) -> Encoder:
        encoder = self.get(name)
        if not any_license and encoder.license.lower() not in LICENSES:
            raise ValueError(f"{encoder.name}: licence {encoder.license} is not allowed")
        return encoder


ENCODERS = Encoders("encoder")


@lru_cache(1 << 15)  # texts repeat their words
def _digest(word: str) -> int:
    return xxhash.xxh32_intdigest(word)


def hashed_words(dim: int) -> Callable[[list[str]], np.ndarray]:
    """The built-in encoder: counts of hashed words."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            out[i] = np.bincount(np.fromiter((_digest(w) % dim for w in re.findall(r"\w+", t.lower())), np.int64), minlength=dim)
        return out

    return encode


for _dim in (128, 384):
    ENCODERS.add(Encoder(f"hashed-{_dim}", _dim, hashed_words(_dim), model_id=f"hashed-words-{_dim}"))


def device(preferred: str | None = None) -> str:
    """Where a model runs: the preferred device, else cuda, mps or cpu, whichever the worker has first."""
    if preferred:
        return preferred
    try:
        import torch
    except ImportError:
        return "cpu"
    if torch.cuda.is_available():
        return "cuda"
    return "mps" if getattr(torch.backends, "mps", None) is not None and torch.backends.mps.is_available() else "cpu"


def transformer(model_id: str, pooling: str | None, max_tokens: int = 512) -> Callable[[list[str]], np.ndarray]:
    """Texts to vectors by a published model, loaded in the worker when it is first used.  pooling is that of a plain
    language model; None takes the model's own.  Needs the package sentence_transformers and the weights."""
    loaded: list = []

    def encode(texts: list[str]) -> np.ndarray:
        if not loaded:
            try:
                from sentence_transformers import SentenceTransformer, models
            except ImportError as e:
                raise RuntimeError(f"{model_id} needs the package sentence_transformers and the model's weights") from e
            if pooling is None:
                loaded.append(SentenceTransformer(model_id, device=device()))
            else:
                body = models.Transformer(model_id, max_seq_length=max_tokens)
                loaded.append(SentenceTransformer(modules=[body, models.Pooling(body.get_word_embedding_dimension(), pooling_mode=pooling)], device=device()))
        return np.asarray(loaded[0].encode(texts, show_progress_bar=False), float)

    return encode


#: Published models: (name, model, dimension, languages, licence, complementary).
MODELS = (
    ("bert-multilingual", "google-bert/bert-base-multilingual-cased", 768, LANGUAGES, "apache-2.0", False),
    ("bert-multilingual-uncased", "google-bert/bert-base-multilingual-uncased", 768, LANGUAGES, "apache-2.0", False),
    ("bert-large", "google-bert/bert-large-uncased", 1024, ("en",), "apache-2.0", True),
    ("bert-tiny", "prajjwal1/bert-tiny", 128, ("en",), "mit", True),
    ("bert-es", "dccuchile/bert-base-spanish-wwm-cased", 768, ("es",), "cc-by-4.0", True),
    ("bert-en", "google-bert/bert-base-cased", 768, ("en",), "apache-2.0", True),
    ("bert-pt", "neuralmind/bert-base-portuguese-cased", 768, ("pt",), "mit", True),
    ("e5-multilingual-base", "intfloat/multilingual-e5-base", 768, LANGUAGES, "mit", False),
    ("e5-multilingual-small", "intfloat/multilingual-e5-small", 384, LANGUAGES, "mit", False),
)

for _name, _model, _dim, _languages, _license, _more in MODELS:
    _prefixed = _name.startswith("e5-")
    ENCODERS.add(Encoder(_name, _dim, transformer(_model, None if _prefixed else "mean"), languages=_languages, license=_license, complementary=_more, query_prefix="query: " if _prefixed else "", passage_prefix="passage: " if _prefixed else "", model_id=_model, needs="sentence_transformers"))


def catalogue(spark) -> DataFrame:
    rows = [(e.name, e.model_id, e.dim, e.max_tokens, ",".join(e.languages), e.license, e.complementary) for e in map(ENCODERS.get, ENCODERS.names())]
    return spark.createDataFrame(rows, "encoder_name string, model_id string, embedding_dim int, max_tokens int, languages string, license string, complementary boolean")


def taken(texts: pd.Series, encoder: Encoder) -> list[str | None]:
    """What the encoder gets of each text, its tokens counted as words; null where there is nothing to encode."""
    return [fitted(x or "", encoder.max_tokens, lambda s: len(s.split()), adds=True) for x in texts]


def inputs(texts: DataFrame, encoder: Encoder, *, text_col: str = "texto") -> DataFrame:
    """texts with `input`, what the encoder gets of each."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            yield pd.Series(taken(t, encoder), dtype=object)

    return small_batches(texts).withColumn("input", run(text_col))


def encoded(texts: DataFrame, encoder: Encoder, *, text_col: str = "texto", is_query: bool = False, batch_size: int | None = None) -> DataFrame:
    """texts with `vector`: unit float vectors; texts that an encoder can't take (blank) have null.  A zero vector stays.
    A text of more than the encoder's tokens counts with its first sentences that fit.  batch_size is how many texts the
    model gets at a time (all of an Arrow batch, if none is given)."""
    prefix = encoder.query_prefix if is_query else encoder.passage_prefix

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            ready = taken(t, encoder)
            index = [i for i, x in enumerate(ready) if x is not None]
            out: list = [None] * len(ready)
            if index:
                step = batch_size or len(index)
                v = np.concatenate([np.asarray(encoder.encode([prefix + ready[i] for i in index[at : at + step]]), float) for at in range(0, len(index), step)])
                if v.shape != (len(index), encoder.dim):
                    raise ValueError(f"{encoder.name} made shape {v.shape}")
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                v = np.divide(v, norm, out=v.copy(), where=norm > 0)
                for i, x in zip(index, v):
                    out[i] = x.astype(np.float32)
            yield pd.Series(out)

    return small_batches(texts).withColumn("vector", run(text_col))


def encode_pending(chunks: DataFrame, cache: DataFrame, names: list[str], exclude: tuple[str, ...] = (), batches: dict[str, int] | None = None) -> DataFrame:
    """New embeddings of chunks (chunk_id, doc_id, texto, hash_texto) for each encoder, where cache (chunk_id,
    encoder_name, hash_texto) lacks them.  Each encoder sees only what it lacks; batches are batch sizes by encoder."""
    out = None
    for name in names:
        if name in exclude:
            continue
        e = ENCODERS.create(name)
        todo = pending(chunks, cache.filter(F.col("encoder_name") == e.name))
        part = encoded(todo, e, batch_size=(batches or {}).get(e.name)).filter("vector is not null").select("chunk_id", "doc_id", F.lit(e.name).alias("encoder_name"), F.lit(e.model_id).alias("model_id"), F.lit(e.dim).alias("embedding_dim"), "vector", F.lit(True).alias("normalized"), "hash_texto")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no encoder is left")
    return out


def checked(embeddings: DataFrame, chunks: DataFrame) -> DataFrame:
    """(encoder_name, n, expected, dimension, complete) of a run: for each encoder its vectors and the chunks with a text.

    A run in which an encoder's vectors differ in dimension, or from that of the catalogue, raises ValueError.
    """
    expected = chunks.filter(F.trim("texto") != "").select("chunk_id").distinct().count()
    found = embeddings.groupBy("encoder_name").agg(F.countDistinct("chunk_id").alias("n"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("dimension"), F.max("embedding_dim").alias("_dim"))
    wrong = found.filter("low <> dimension or dimension <> _dim").select("encoder_name").collect()
    if wrong:
        raise ValueError(f"vectors of other dimensions: {', '.join(sorted(r[0] for r in wrong))}")
    return found.select("encoder_name", "n", F.lit(expected).alias("expected"), "dimension", (F.col("n") == expected).alias("complete"))
