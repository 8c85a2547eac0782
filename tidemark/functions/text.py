"""Rows to documents, documents to overlapping chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.functions.columns import let


def render(parts: Sequence[tuple[str, str]]) -> Column:
    """One sentence per (lead, column), joined by blanks. A NULL column drops its sentence."""
    return F.concat_ws(
        " ", *[F.concat(F.lit(lead), F.col(c).cast("string"), F.lit(".")) for lead, c in parts]
    )


def chunk_array(
    col: str | Column,
    size: int = presets.CHUNK_SIZE,
    overlap: int = presets.CHUNK_OVERLAP,
    drop_contained: bool = False,
) -> Column:
    """Array of chunks of ``size`` characters that start ``size - overlap`` apart.

    Chunk i covers characters [i * stride, i * stride + size). With ``overlap <= stride`` the
    text is cut once into stride-wide blocks and each block borrows the head of the next one,
    so the cost is linear in the text. ``drop_contained`` leaves out a last chunk that lies
    wholly inside the one before it.
    """
    text = F.col(col) if isinstance(col, str) else col
    stride = size - overlap
    if overlap < 0 or stride <= 0:
        raise ValueError("need 0 <= overlap < size")
    if overlap <= stride:
        blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))

        def extended(bs: Column) -> Column:
            def head(i: Column) -> Column:
                return F.coalesce(F.substring(F.get(bs, i + 1), 1, overlap), F.lit(""))

            return F.transform(bs, lambda b, i: F.concat(b, head(i)))

        chunks = let(blocks, extended)
    else:
        starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(stride)))
        chunks = F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(size)))
    if drop_contained:

        def trimmed(cs: Column) -> Column:
            last_is_inside = (F.size(cs) > 1) & (F.length(F.element_at(cs, -1)) <= overlap)
            return F.slice(cs, F.lit(1), F.size(cs) - last_is_inside.cast("int"))

        chunks = let(chunks, trimmed)
    return chunks


def chunk(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    size: int = presets.CHUNK_SIZE,
    overlap: int = presets.CHUNK_OVERLAP,
    drop_contained: bool = False,
) -> DataFrame:
    """One row per chunk: keys, ``chunk_no`` from 0, ``chunk_text``. Empty text gives none."""
    pieces = chunk_array(col, size, overlap, drop_contained)
    return df.select(*keys, F.posexplode(pieces).alias("chunk_no", "chunk_text"))
