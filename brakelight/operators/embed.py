"""Text -> unit vector column with a user-supplied batch model (Arrow batches).

``embed_column`` runs an iterator pandas UDF: the model is built once per
task by ``model_factory()`` and called on whole Arrow batches
(``spark.sql.execution.arrow.maxRecordsPerBatch`` rows), which replaces the
fixed chunk/batch sizes of a single-machine loop. The default model is a
signed feature-hashing encoder (deterministic, no download) used in tests.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col_

_TOKEN = re.compile(r"\w+", re.UNICODE)


class HashingEncoder:
    """Signed hashing of lower-cased word tokens into ``dim`` buckets, L2-normalised."""

    def __init__(self, dim: int = 64, seed: int = 0):
        self.dim, self.seed = dim, seed

    def encode(self, texts: list[str]) -> np.ndarray:
        import xxhash
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for r, t in enumerate(texts):
            for tok in _TOKEN.findall((t or "").lower()):
                h = xxhash.xxh64_intdigest(tok, seed=self.seed)
                out[r, h % self.dim] += 1.0 if (h >> 63) & 1 else -1.0
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=np.zeros_like(out), where=n > 0)


def embed_column(text, model_factory: Callable[[], object] | None = None, dim: int = 64) -> Column:
    """``array<float>`` embedding of a text column; ``model.encode(list[str]) -> (n, dim)``."""
    factory = model_factory or (lambda: HashingEncoder(dim))

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for s in batches:
            m = np.asarray(model.encode(s.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(m))

    return _embed(col_(text))
