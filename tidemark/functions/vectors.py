"""Dense vectors as array columns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def normalise(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(v, lambda x: x.cast("double"))
    )


class HashedWords:
    """Word counts hashed into ``dims`` places: the offline stand-in for a sentence encoder.

    Words are runs of letters and digits, lower-cased. A word's place comes from the first four
    hex digits of its MD5, so any engine can repeat it. Use it with ``embed``.
    """

    def __init__(self, dims: int = 64, remembered: int = 1_000_000):
        self.dims = dims
        self.remembered = remembered
        self.places: dict[str, int] = {}

    def _place(self, word: str) -> int:
        place = self.places.get(word)
        if place is None:
            place = int(hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()[:4], 16) % self.dims
            if len(self.places) < self.remembered:
                self.places[word] = place
        return place

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims), dtype="float32")
        for row, text in enumerate(texts):
            places = [self._place(w) for w in re.findall("[a-z0-9]+", text.lower())]
            if places:
                out[row] = np.bincount(places, minlength=self.dims)
        return out


def embed(
    df: DataFrame,
    col: str,
    fn: Callable[[Sequence[str]], np.ndarray] = HashedWords(),
    name: str = "embedding",
) -> DataFrame:
    """Add the vector ``fn`` gives for each text; ``fn`` maps a batch of texts to a 2-d array.

    An Arrow-batched pandas UDF: only the text goes to Python, and a model is loaded once per
    task and called once per batch.
    """

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            matrix = np.asarray(fn(texts.fillna("").tolist()), dtype="float32")
            yield pd.Series(list(matrix), index=texts.index)

    return df.withColumn(name, encode(F.col(col)))
