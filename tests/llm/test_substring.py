"""Substring dedup: against SQL and brute force, with full and nearly empty sketches."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import expected, same
from helpers import MEDIUM, SMALL, prose
from pyspark.sql import functions as F

from tidemark.llm import substring_dedup
from tidemark.llm.common import SLICE, documents

NAME, K = "op13_substring_dedup", substring_dedup.WORDS
COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def by_hand(rows):
    """doc_id, n_words, n_removed, kept_sha256 of (doc_id, text) rows."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for a in range(len(w) - K + 1) if i is not None else ():
            key = tuple(w[a : a + K])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - K + 1) if i is not None else ():
            if least[tuple(w[a : a + K])] < i:
                gone.update(range(a, a + K))
        kept = " ".join(x for a, x in enumerate(w) if a not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(docs):
    got = substring_dedup.deduplicated(docs).withColumn("kept_sha256", F.sha2("kept_text", 256))
    return sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def family():
    """Passages shared in many ways: by two, by all, moved, at the ends, in runs that touch, in one text twice."""
    rng = random.Random(5)
    common, passages = prose(rng, 40), [prose(rng, n) for n in (12, 13, 14, 26, 60)]
    rows = []
    for i in range(240):
        parts = [prose(rng, rng.randint(0, 60)), common] + rng.sample(passages, 2)
        rng.shuffle(parts)
        rows.append((i * 7 % 240, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    rows += [(500, common + " " + common), (501, prose(rng, 30)), (502, " ".join(passages))]
    long = prose(rng, 70_000)
    assert len(long) > SLICE
    rows += [(600, long), (601, " ".join(long.split()[30_000:])), (602, "w" * (SLICE + 9) + " " + passages[4] + " " + "w" * (SLICE + 9))]
    return rows


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_sql(spark, folder):
    assert not same(substring_dedup.QUERIES[NAME](spark, folder).toPandas(), expected(substring_dedup.ORACLES[NAME], folder))


def test_edges(edge_docs, edge_rows, no_docs):
    assert run(edge_docs) == by_hand([r[:2] for r in edge_rows])
    assert run(no_docs) == []


def test_family(spark, family):
    docs = spark.createDataFrame(family, "doc_id long, text string").repartition(7)
    assert run(docs) == by_hand(family)


def test_rows_of_one_id_are_one_document(spark):
    rng = random.Random(6)
    a, b = prose(rng, 20), prose(rng, 20)
    rows = [(1, a), (1, a + " " + b), (1, a), (2, b + " x " + a), (None, a), (None, a), (-3, "lone " + b)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == by_hand(rows)


def test_hot_windows_are_spread(spark, family, monkeypatch):
    """The same rows when nearly every repeated window counts as hot."""
    monkeypatch.setattr(substring_dedup, "OFTEN", 3)
    monkeypatch.setattr(substring_dedup, "OFTEN_SHARE", 60)
    docs = spark.createDataFrame(family, "doc_id long, text string").repartition(7)
    rows = docs.selectExpr("doc_id AS doc", "text")
    sketch = spark.sparkContext.broadcast(substring_dedup.sketch_of(rows))
    hot = substring_dedup.candidates(rows, sketch).selectExpr("place >> 56 AS part").filter("part > 0")
    assert hot.count() > 1000 and hot.distinct().count() == substring_dedup.PARTS
    assert run(docs) == by_hand(family)


def windows_of(docs):
    """Window hashes and their words, as the operator hashes them."""
    out = defaultdict(list)
    for text in docs:
        words = (text or "").split()
        for _, _, begins, hashes in substring_dedup.word_runs(pa.array([text or ""]), 1):
            starts = substring_dedup.window_starts(begins)[1]
            for h, a in zip(substring_dedup.windows(hashes[0], starts).tolist(), starts.tolist(), strict=True):
                out[h].append(tuple(words[a : a + K]))
    return out


def test_estimates_are_never_too_low(spark):
    docs = documents(spark, SMALL).selectExpr("coalesce(text, '') AS text").repartition(5)
    sketch = substring_dedup.sketch_of(docs)
    found = windows_of(r["text"] for r in docs.collect())
    assert all(len(set(v)) == 1 for v in found.values())
    every = np.array(list(found), np.uint64)
    passed = set(every[sketch.repeated(every)].tolist())
    twice = {h for h, v in found.items() if len(v) > 1}
    assert twice and twice <= passed
    assert len(passed) - len(twice) < 0.1 * len(every)       # and the prefilter does prune


def test_a_full_sketch_loses_nothing(spark, family):
    """Counters that all collide pass every window on; the exact pass decides."""
    rows = spark.createDataFrame(family, "doc long, text string")

    def places(sketch):
        passed = substring_dedup.candidates(rows, spark.sparkContext.broadcast(sketch))
        return passed.count(), {(r["doc"], r["at"]) for r in substring_dedup.later(passed, False).collect()}

    full = substring_dedup.Sketch(1, [])
    full.twice[:] = 255
    n_all, by_all = places(full)
    n_few, by_few = places(substring_dedup.sketch_of(rows))
    assert n_few < n_all == sum(max(len(t.split()) - K + 1, 0) for _, t in family)
    assert by_all == by_few


def test_gaps_come_back():
    places = np.array([0, 0, 5, 260, 260, 770, 1 << 20], np.uint32)
    assert (substring_dedup.unpacked(substring_dedup.packed(places)) == places).all()
    assert len(substring_dedup.unpacked(substring_dedup.packed(places[:0]))) == 0
