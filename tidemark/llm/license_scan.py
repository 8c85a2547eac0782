"""License scans by diagonal voting.

Each text becomes its rolling word pairs (k-grams, k = 2), hashed. Spark joins them with
the template positions of the same hash; the templates are fixed values, so that side is
small by construction. A hit at word p of the text and word t of a template votes for the
diagonal p - t. All pairs of a phrase on one diagonal mean that its words stand
consecutively.

For the longer templates, pairs with one word between them are hashed as well, on both sides:
they bridge a word that is put in, left out or replaced. Neighbouring diagonals are merged to a
span. A word of the template that no pair of the span holds is an edit, and so are two words
next to each other that the span has only apart. A span counts with up to one edit, or two if
the template has ``LONG`` words. The words that tell a licence from others must be there, and
those of ``TOGETHER`` next to each other.

Spans are verified by a second, independent hash of each pair, carried beside the first.

Defined results: a null or empty text has 0 words and no labels. Rows that repeat a doc_id
are rows of their own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, mixed, signed, stored, words

K = 2
# The phrases whose places count, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Templates of this module, and their labels.
TEMPLATES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution 4 0 international": "cc-by",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license version 2 0": "mpl-2.0",
}
# Words that a span must have, and neighbours that nothing may part, by template.
NEEDED = {
    "gpl-2": "gnu general license 2", "gpl-3": "gnu general license 3", "lgpl": "lesser license", "agpl": "affero license",
    "apache-2.0": "apache license 2", "cc-by-nc": "cc by nc", "cc-by-sa": "cc by sa", "cc-by": "commons attribution", "mit": "mit license", "mpl-2.0": "mozilla license 2",
}
TOGETHER = {"gpl-2": "gnu general", "gpl-3": "gnu general", "cc-by": "attribution 4"}
LONG = 12
SHIFT = 2
_HEADER = 0
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def pair_hashes(hashes: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes for each two of ``hashes`` with ``gap`` others between them."""
    a, b = hashes[: max(0, len(hashes) - 1 - gap)], hashes[1 + gap :]
    first = mixed(a * np.uint64(3) + b) | np.uint64(1)        # never the header's value
    return signed(first), signed(mixed(a * _SECOND ^ mixed(b)))


def template_rows() -> list[tuple[int, int, int, int, int, int]]:
    """(gram, check, template number, position, pairs in the template, words left out), one per pair."""
    out = [(_HEADER, 0, -1, 0, 0, 0)]
    for number, phrase in enumerate([*PHRASES, *TEMPLATES]):
        _, _, _, hashes = next(words(pa.array([phrase])))
        for gap in (0, 1) if number >= len(PHRASES) else (0,):
            for at, (gram, check) in enumerate(zip(*pair_hashes(hashes, gap), strict=True)):
                out.append((int(gram), int(check), number, at, len(hashes) - 1, gap))
    return out


def _demands() -> tuple[list[list[int]], list[list[int]]]:
    """By template: positions of the words a span must have, and of pairs that must stand together."""
    needed, together = [], []
    for phrase, label in TEMPLATES.items():
        own = phrase.split()
        needed.append([own.index(w) for w in NEEDED.get(label, "").split() if w in own])
        pairs = [f"{a} {b}" for a, b in zip(own, own[1:], strict=False)]
        together.append([pairs.index(TOGETHER[label])] if label in TOGETHER else [])
    return needed, together


def grams(docs: DataFrame) -> DataFrame:
    """All word pairs of all texts, next to each other or with a word between them (gap 1), and
    a header row for each text: its word count as position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, ids = batch.column("rid"), batch.column("doc_id")
            for first, last, begins, hashes in words(batch.column("text")):
                counts = np.diff(begins)
                row = np.repeat(np.arange(last - first), counts)
                parts = [(np.arange(last - first), np.zeros(last - first, np.int64) + _HEADER, np.zeros(last - first, np.int64), counts, 0)]
                for gap in (0, 1):
                    gram, check = pair_hashes(hashes, gap)
                    inside = np.flatnonzero(row[: len(gram)] == row[1 + gap :])      # no pair across two texts
                    parts.append((row[inside], gram[inside], check[inside], inside - begins[row[inside]], gap))
                of, gram, check, at = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(4))
                of = pa.array(of + first)
                gaps = np.repeat(np.array([p[4] for p in parts], np.int8), [len(p[0]) for p in parts])
                yield pa.RecordBatch.from_arrays(
                    [rids.take(of), ids.take(of), pa.array(gram), pa.array(check), pa.array(at), pa.array(gaps)],
                    names=["rid", "doc_id", "gram", "check", "pos", "gap"],
                )

    return docs.select(
        F.monotonically_increasing_id().alias("rid"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    ).mapInArrow(run, "rid long, doc_id long, gram long, check long, pos long, gap byte")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs: n_words, places of the phrases, labels, score, n_spans."""
    spark = docs.sparkSession
    templates = spark.createDataFrame(template_rows(), "gram long, check long, template int, at int, pairs int, skip int")
    hits = stored(
        grams(docs).join(F.broadcast(templates), ["gram", "check"])
        # phrases and headers: neighbours only
        .where((F.col("template") >= len(PHRASES)) | (F.col("gap") == 0)).select("rid", "doc_id", "template", "at", "pairs", "pos", "skip", "gap"),
        "license-hits",
    )
    texts = hits.where("template = -1").select("rid", "doc_id", F.col("pos").alias("n_words"))
    diagonals = (
        hits.where("template >= 0")
        .groupBy("rid", "template", "pairs", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(
            F.count("*").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
            F.collect_set(F.when((F.col("gap") == 0) & (F.col("skip") == 0), F.col("at"))).alias("ats"),
            # words at both ends of a pair
            F.array_union(F.collect_set("at"), F.collect_set(F.col("at") + F.col("skip") + 1)).alias("seen"),
        )
    )
    n = len(PHRASES)
    labels = F.array(*[F.lit(x) for x in [*PHRASES.values(), *TEMPLATES.values()]])
    base = diagonals.where((F.col("template") < n) & (F.col("votes") == F.col("pairs"))).select(
        "rid", "template", "diagonal", F.lit(1.0).alias("cover"), F.lit(True).alias("base")
    )
    needed, together = _demands()

    def has(wanted: list[list[int]], held: str):
        lists = F.array(*[F.array(*[F.lit(x) for x in w]).cast("array<int>") for w in wanted])
        return F.size(F.array_except(F.element_at(lists, F.col("template") - n + 1), held)) == 0

    along = Window.partitionBy("rid", "template").orderBy("lo", "diagonal")
    upto = along.rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        diagonals.where(F.col("template") >= n)
        .withColumn("new", F.when(
            (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) <= SHIFT)
            & (F.col("lo") <= F.max("hi").over(upto) + SHIFT + K), 0).otherwise(1))
        .withColumn("span", F.sum("new").over(along))
        .groupBy("rid", "template", "pairs", "span")
        .agg(F.min("diagonal").alias("diagonal"), F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.array_distinct(F.flatten(F.collect_list("seen"))).alias("seen"))
        .withColumn("apart", F.filter(F.sequence(F.lit(0), F.col("pairs") - 1), lambda t: F.array_contains("seen", t) & F.array_contains("seen", t + 1) & ~F.array_contains("ats", t)))
        .withColumn("edits", F.col("pairs") + 1 - F.size("seen") + F.size("apart"))
        .where((F.col("edits") <= F.when(F.col("pairs") + 1 >= LONG, 2).otherwise(1)) & has(needed, "seen") & has(together, "ats"))
        .select("rid", "template", "diagonal", (F.size("ats") / F.col("pairs")).alias("cover"), F.lit(False).alias("base"))
    )
    label = F.element_at(labels, F.col("template") + 1)
    per_text = base.unionByName(spans).groupBy("rid").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("diagonal"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("diagonal"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), label))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(label)), ",").alias("labels"),
        F.max("cover").alias("score"),
        F.count_if(~F.col("base")).alias("n_spans"),
    )
    return texts.join(per_text, "rid", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


ORACLES: dict[str, str] = {}
QUERIES = {"op3_license_scan": op3_license_scan}
