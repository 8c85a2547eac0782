"""Helpers of the text operators: whole texts as bytes, word hashes, stored tables.

All of them take whole texts. Null texts count as empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Bytes that are worked on at once, unless one text is longer. Keeps arrays in cache.
SLICE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and its row offsets; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at.astype(np.int64) - int(at[0])


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``limit`` bytes together; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of the input over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2**64, and their inverses."""
    if len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0], _powers[1]


#: Words are runs of digits, letters a-z (A-Z lowered) and all bytes beyond ASCII.
IS_WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    IS_WORD[_a:_b] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_VALUE = mixed((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))


def _words(data: np.ndarray, rows: np.ndarray, stem: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in ``data``; none spans a row start in ``rows``.

    With ``stem``, a second column of hashes: of the word's first so many bytes, 0 if it is shorter.
    """
    word = IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], before[1:] = False, word[:-1]
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    whole = mixed((total[ends] - total[starts]) * down[starts])
    if not stem:
        return starts, whole
    cut = np.minimum(starts + stem, len(data))
    stems = mixed((total[cut] - total[starts]) * down[starts] + np.uint64(_BASE))
    return starts, np.stack([whole, np.where(ends >= starts + stem, stems, np.uint64(0))], axis=1)


def words(column: pa.Array, stem: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of whole texts, slice by slice: first row, last row (exclusive),
    where each of these rows' words begin (one more at the end), and the hashes.
    With ``stem``, the hashes have a second column, see ``_words``.

    A text longer than a slice is hashed in pieces that end between two words.
    """
    data, offsets = texts(column)
    for first, last in slices(offsets):
        at = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        if not len(part):
            yield first, last, np.zeros(last - first + 1, np.int64), np.zeros((0, 2) if stem else 0, np.uint64)
        elif len(part) <= SLICE:
            starts, hashes = _words(part, at[:-1][at[:-1] < len(part)], stem)
            yield first, last, np.searchsorted(starts, at), hashes
        else:
            found, done = [], 0
            while done < len(part):
                end = min(done + SLICE, len(part))
                if end < len(part):
                    gaps = np.flatnonzero(~IS_WORD[part[done:end]])
                    while not len(gaps) and end < len(part):     # one word, longer than a slice
                        seen, end = end, min(end + SLICE, len(part))
                        gaps = np.flatnonzero(~IS_WORD[part[seen:end]]) + (seen - done)
                    end = done + int(gaps[-1]) + 1 if len(gaps) else end
                found.append(_words(part[done:end], np.zeros(1, np.int64), stem)[1])
                done = end
            hashes = np.concatenate(found)
            yield first, last, np.array([0, len(hashes)]), hashes


def shingles(hashes: np.ndarray, begins: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a row, and where each row's runs begin.

    A row with 1 to k - 1 words has one run: all its words.
    """
    counts = np.diff(begins)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    if not len(out):
        return out, at
    row = np.repeat(np.arange(len(counts)), n)
    first = np.arange(len(out)) - at[row] + begins[row]
    length = np.minimum(counts, k)[row]
    for j in range(k):
        here = length > j
        out = np.where(here, out * np.uint64(_BASE) + hashes[np.where(here, first + j, 0)], out)
    return mixed(out), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of docs), ``doc_id``, ``text`` (null as empty) and ``text_key``.

    Packing the row keeps extra columns apart from the names used here, whatever they are.
    Rows of one text_key hold the same text.
    """
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    ).withColumn("text_key", F.unhex(F.sha2("text", 256)))
