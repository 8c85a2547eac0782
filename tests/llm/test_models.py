"""Classifiers, scans, extraction and search: against brute force, gold labels or planted cases."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import MEDIUM, SMALL, prose
from personal_lines import LINES

import corpus_pipeline
from tidemark.llm import decontaminate, html_extract, language_id, license_scan, personal_data, quality
from tidemark.llm.common import stored, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOW))


def test_words_match_the_pattern(edge_rows):
    """Same words, same hashes: also in texts longer than a slice and next to each other."""
    texts = [r[1] for r in edge_rows]
    known: dict = {}
    for first, last, begins, hashes in words(pa.array(texts, pa.string())):
        for i in range(first, last):
            own = hashes[begins[i - first] : begins[i - first + 1]].tolist()
            want = tokens(texts[i])
            assert len(own) == len(want)
            for w, h in zip(want, own, strict=True):
                assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


# --- licenses ---


def _places(text):
    found, labels, own = [], set(), tokens(text)
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        for k in range(len(own) - len(parts) + 1):
            if own[k : k + len(parts)] == parts:
                found.append(k)
                labels.add(label)
    return len(own), found, ",".join(sorted(labels))


def _check_license(rows, got):
    want = Counter()
    for i, text in rows:
        n, found, labels = _places(text)
        want[(i, n, len(found), min(found, default=None), max(found, default=None), labels)] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    for r in got:
        own = set(filter(None, r["labels"].split(",")))
        assert set(filter(None, r["base_labels"].split(","))) <= own and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(own)


def test_license_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    _check_license(rows, license_scan.op3_license_scan(spark, MEDIUM).collect())


def test_license_edges(spark, edge_docs, edge_rows):
    _check_license([(r[0], r[1]) for r in edge_rows], license_scan.scan(edge_docs).collect())
    rows = [
        (1, "cc by cc by CC-BY"), (2, "Gnu General, Public\nLicense version 3 gnu general public licens"), (3, "apache"), (4, "license apache license"),
        (5, "released under the MIT License"), (6, "licensed under cc by nc 4 0"), (7, "Permission is hereby granted, free of any charge, to any person obtaining a copy"),
    ]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check_license(rows, got)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[2] == "gpl,gpl-3" and labels[6] == "cc-by,cc-by-nc" and labels[7] == "mit" and labels[3] == ""


def test_license_word_put_in_or_left_out(spark):
    """Each template with one word put in at each place, and with one left out; not so the words that tell licences apart."""
    rows, want = [], {}
    needed, together = license_scan._demands()
    for (phrase, label), must, pinned in zip(license_scan.TEMPLATES.items(), needed, together, strict=True):
        own = phrase.split()
        for k in range(len(own) + 1):
            rows.append((len(rows), " ".join(["here", "is", *own[:k], "inserted", *own[k:], "and", "more"])))
            want[rows[-1][0]] = (label, k - 1 not in pinned)
        for k in range(len(own)):
            rows.append((len(rows), " ".join(["here", "is", *own[:k], *own[k + 1 :], "and", "more"])))
            if label != "mit" or len(own) > 8:
                want[rows[-1][0]] = (label, k not in must and k not in pinned and k - 1 not in pinned)
    others = [
        ("GNU General Public License (GPL) version 2", "gpl-2"), ("Apache License, the Version 2.0", "apache-2.0"), ("Apache License 2.0", "apache-2.0"),
        ("GNU Lesser General Public License version 2", "lgpl"), ("GNU Affero General Public License version 3", "agpl"), ("Eclipse Public License version 2", None),
        ("GNU General Public License", None), ("GNU General Public License version 3", "gpl-3"), ("Creative Commons Attribution NonCommercial 4.0 International", None),
    ]
    texts = {10_000 + i: label for i, (_, label) in enumerate(others)}
    rows += [(10_000 + i, text) for i, (text, _) in enumerate(others)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check_license(rows, got)
    labels = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in got}
    wrong = [(rows[i][1], labels[i]) for i, (label, there) in want.items() if (label in labels[i]) != there]
    assert not wrong
    assert all(labels[i] - {"gpl", "apache"} == ({label} if label else set()) for i, label in texts.items())


# --- language ---


def test_language_held_out(spark):
    got = language_id.op8_language_id(spark, MEDIUM).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(lang) and len(held) > 100
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark, edge_docs, edge_rows, no_docs):
    got = language_id.identify(edge_docs, language_id.train(edge_docs)).collect()
    assert len(got) == len(edge_rows)
    none = [r for r in got if r["doc_id"] in (4, 5, 6, 9)]
    assert all(r["lang_pred"] == "und" and r["score"] == 0 and r["rejected"] for r in none)
    assert all(r["lang_pred"] in {"en", "de", "fr", "es"} for r in got if r["doc_id"] in (1, 7, 10, 13))
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert language_id.train(no_docs) is None
    assert {r["lang_pred"] for r in language_id.identify(edge_docs, None).collect()} == {"und"}
    assert language_id.identify(no_docs, None).count() == 0


def test_language_ignores_label_and_source(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.train(docs)
    from pyspark.sql import functions as F

    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    pick = lambda d: sorted((r["doc_id"], r["lang_pred"]) for r in language_id.identify(d, model).collect())
    assert pick(docs) == pick(other)


def test_histogram_in_pieces(monkeypatch):
    data = np.frombuffer(prose(random.Random(1), 900).encode(), np.uint8)
    whole = language_id.histogram(data)
    monkeypatch.setattr(language_id, "SLICE", 333)
    assert (language_id.histogram(data) == whole).all()


# --- quality ---


def test_quality_labels(spark):
    got = {r["doc_id"]: r for r in quality.op2_quality_classifier(spark, MEDIUM).collect()}
    gold = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    good = [got[r["doc_id"]]["kept"] for r in gold if r["quality"] == 1 and r["toxic"] == 0]
    low = [got[r["doc_id"]]["kept"] for r in gold if r["quality"] == 0]
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    insults = set(quality.INSULTS) | set(quality.CONTEMPT)
    toxic = [got[r["doc_id"]]["kept"] for r in gold if r["toxic"] == 1 and insults & set(tokens(text[r["doc_id"]]))]
    assert np.mean(good) >= 0.99 and np.mean(low) <= 0.05 and np.mean(toxic) <= 0.02


def test_quality_edges(spark, edge_docs, edge_rows, no_docs):
    scorer = quality.fit(edge_docs)
    assert quality.scored(edge_docs, scorer).count() == len(edge_rows)
    assert quality.accepted(edge_docs).columns == edge_docs.columns
    empty = quality.fit(no_docs)
    assert quality.scored(no_docs, empty).count() == 0
    labels = spark.createDataFrame([(None, 1, None), (1, None, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.scored(edge_docs, quality.fit(edge_docs, labels)).count() == len(edge_rows)


def test_em_finds_accuracies():
    """Three labellers of known accuracy: posteriors agree with Bayes' rule."""
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.9, 0.8, 0.7])
    votes = np.where((rng.random((20_000, 3)) < right) == truth[:, None], quality.YES, quality.NO)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post = quality.maximise(patterns, counts.astype(float), rounds=200)
    for pattern, p in zip(patterns, post, strict=True):
        like = [np.prod(np.where((pattern == quality.YES) == c, right, 1 - right)) for c in (False, True)]
        assert p == pytest.approx(0.3 * like[1] / (0.3 * like[1] + 0.7 * like[0]), abs=0.12)


# --- decontamination ---


def test_decontamination_recall(spark):
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.op4_benchmark_decontamination(spark, MEDIUM).collect()}
    items = {r["item_id"]: tokens(r["text"]) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()}
    want = {}
    for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect():
        text = " ".join(tokens(r["text"]))
        want[r["doc_id"]] = {i for i, w in items.items() if " ".join(w) in text}
    pairs = [(d, i) for d, x in want.items() for i in x]
    assert sum(i in got[d] for d, i in pairs) >= 0.9 * len(pairs)
    assert all(want[d] for d, x in got.items() if x)


def test_decontamination_paraphrases(spark):
    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate([12, 18, 30, 45, 60, 110])]
    rows = []
    for i, text in items:
        own = text.split()
        changed = [w if rng.random() > 0.15 else "other" for w in own]
        rows += [(10 * i, prose(rng, 70) + " " + text + " " + prose(rng, 70)), (10 * i + 1, prose(rng, 33) + " " + " ".join(changed) + " " + prose(rng, 20))]
    rows += [(1000 + i, prose(rng, 150)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: set(r["items"]) for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    exact = [d for d in found if d < 1000 and d % 10 == 0]
    assert all(d // 10 in found[d] for d in exact)
    near = [d for d in found if d < 1000 and d % 10 == 1]
    assert sum(d // 10 in found[d] for d in near) >= 5
    assert not any(found[d] for d in found if d >= 1000)


def test_decontamination_edges(spark, edge_docs, edge_rows, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, edge_rows[10][1]), (3, " ".join(edge_rows[0][1].split()[40:90])), (3, " ".join(edge_rows[0][1].split()[40:90]))], "item_id long, text string")
    got = decontaminate.contaminated(edge_docs, items).select("doc_id", "items", "row.text").collect()
    assert len(got) == len(edge_rows)
    assert {r["doc_id"] for r in got if 3 in r["items"]} >= {1, 2, 3}
    assert decontaminate.decontaminated(edge_docs, items).columns == edge_docs.columns
    assert decontaminate.contaminated(edge_docs, items.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate.contaminated(no_docs, items).count() == 0


def test_products_are_summed_before_the_driver(spark, monkeypatch):
    """The driver takes one matrix, not one of each task, and it is A'A of the passages."""
    rng = random.Random(3)
    lines = [prose(rng, rng.randint(1, 100)) for _ in range(60)] + [None, ""]
    docs = stored(spark.createDataFrame([(t,) for t in lines], "text string").repartition(decontaminate.PARTS), "products")
    idf = np.linspace(1, 2, decontaminate.DIMS).astype(np.float32)
    basis = np.random.default_rng(1).normal(size=(decontaminate.DIMS, 5))
    passages = []
    for _, _, begins, hashes in words(pa.array(lines, pa.string())):
        own = decontaminate.buckets(hashes)
        for a, b in zip(begins, begins[1:], strict=False):
            passages += [np.bincount(own[i : min(i + decontaminate.WINDOW, b)], minlength=decontaminate.DIMS) * idf for i in range(a, b, decontaminate.WINDOW)]
    a = np.array(passages, np.float64)
    taken, plain = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: taken.append(plain(self)) or taken[-1])
    np.testing.assert_allclose(decontaminate._products(docs, basis, idf, True), a.T @ (a @ basis), rtol=1e-4, atol=1e-2)
    np.testing.assert_allclose(decontaminate._products(docs, basis, idf, False), (a @ basis).T @ (a @ basis), rtol=1e-4, atol=1e-2)
    assert len(taken) == 2 and all(t.nbytes < 2 * 8 * 5 * n for t, n in zip(taken, (decontaminate.DIMS, 200), strict=True))


def test_latent_space_is_fitted_on_all_documents(spark):
    """Over the passages of all documents, those without an id as well, the projected ones have singular values of 1."""
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(30)]
    lines = [" ".join(rng.choices(vocabulary, k=5)) for _ in range(30_000)]
    docs = spark.createDataFrame([(None if i % 3 == 0 else i, t) for i, t in enumerate(lines)], "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, vocabulary[0])], "item_id long, text string")
    (_, _, _, hashes), = words(pa.array([" ".join(vocabulary)]))
    own = decontaminate.buckets(hashes)
    assert len(set(own)) == len(own)
    counts = np.array([[t.split().count(w) for w in vocabulary] for t in lines])
    projected = counts @ decontaminate.latent_space(docs, items, np.ones(decontaminate.DIMS, np.float32))[own]
    gram = projected.T @ projected
    assert np.sort(np.linalg.eigvalsh(gram))[-len(own) :] == pytest.approx(np.ones(len(own)), abs=0.02)


def test_latent_space_sends_few_matrices(spark, monkeypatch):
    """However many files there are, the tasks of the fit follow the passages."""
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('some words ', id) AS text").repartition(60)
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    seen, plain = [], decontaminate._products
    monkeypatch.setattr(decontaminate, "_products", lambda texts, *a: seen.append(texts.rdd.getNumPartitions()) or plain(texts, *a))
    idf, passages = decontaminate.passage_frequencies(docs)
    assert passages == 200
    decontaminate.latent_space(docs, items, idf, passages)
    monkeypatch.setattr(decontaminate, "SHARE", 10)
    decontaminate.latent_space(docs, items, idf, passages)
    assert seen == [16, 16, 20, 20]


def test_passages_of_texts_and_parts_of_long_ones(monkeypatch):
    """Texts share a chunk, a long one is cut at its passages; nothing is lost."""
    rng = random.Random(2)
    monkeypatch.setattr(decontaminate, "ROWS", 4)
    lines = [prose(rng, n) for n in (3, 40, 41, 90, 1000)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["text"])
    got, sizes = [], []
    for own, begins in decontaminate._passages(iter([batch, batch])):
        sizes.append(len(own))
        got += [tuple(x.tolist()) for x in np.split(own, begins[1:])]
    want = []
    for _, _, begins, hashes in words(batch.column(0)):
        own = decontaminate.buckets(hashes).tolist()
        want += [tuple(own[i : min(i + 40, b)]) for a, b in zip(begins, begins[1:], strict=False) for i in range(a, b, 40)]
    assert got == want * 2
    assert list(decontaminate._passages(iter([batch.slice(5)]))) == []


def test_group_sums_gather_few_rows():
    """The same sums to the last bit as of all rows at once, in a small part of their memory."""
    rng = np.random.default_rng(4)
    table = rng.normal(size=(500, 64)).astype(np.float32)
    rows = rng.integers(0, 500, 60_000)
    sizes = np.append(rng.integers(1, 40, 1500), 3 * decontaminate.ROWS)
    starts = np.append(0, np.cumsum(sizes[rng.permutation(len(sizes))])[:-1])
    starts = starts[starts < len(rows)]
    want = np.add.reduceat(table[rows], starts, axis=0)
    tracemalloc.start()
    got = decontaminate.group_sums(table, rows, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, want) and got.dtype == want.dtype
    most = max(decontaminate.ROWS, int(np.diff(np.append(starts, len(rows))).max()))
    assert peak < 1.5 * (most * 64 * 4 + got.nbytes) < table[rows].nbytes


def test_many_sums_agree_with_group_sums():
    rng = np.random.default_rng(6)
    table = rng.normal(size=(300, 7))
    for sizes in ([1], [5], [3 * decontaminate.ROWS, 2, 2], rng.integers(1, 41, 3000), rng.zipf(1.3, 2000).clip(max=9000)):
        sizes = rng.permutation(sizes)
        rows, starts = rng.integers(0, 300, sizes.sum()), np.cumsum(sizes) - sizes
        np.testing.assert_allclose(decontaminate.many_sums(table, rows, starts), decontaminate.group_sums(table, rows, starts), atol=1e-9)


def test_many_short_words_in_several_rows():
    """A slice with many words is still its rows."""
    rows = pa.array(["1 2 3 " * 8000, "4 5 6 " * 8000, "7 8 9 " * 8000])
    seen = [(lo, begins.tolist()) for _, _, b, h in words(rows) for lo, begins, _ in decontaminate._runs(b, h)]
    assert seen == [(0, [0, 24_000, 48_000, 72_000])]
    (_, _, begins, hashes), = words(pa.array(["1 2 " * 70_000]))
    assert len(list(decontaminate._runs(begins, hashes))) > 1


def test_decontamination_recall_of_paraphrases(spark):
    """Items with 25 to 40% of their words left out or replaced: what brute force accepts is found, in every length class."""
    rng = random.Random(40)
    docs = [r["text"].split() for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("text").collect()]
    docs = [w for w in docs if len(w) > 150 and len(tokens(" ".join(w))) == len(w)] or [w for w in docs if len(w) > 150]
    lengths = {"10-14": (10, 14), "15-24": (15, 24), "25-32": (25, 32), "33-44": (33, 44), "45-90": (45, 90)}
    items, rows, classes = [], [(100_000 + i, " ".join(w)) for i, w in enumerate(docs[:200])], {}
    for name, (a, b) in lengths.items():
        for _ in range(50):
            own, host, n, i = rng.choice(docs[200:]), rng.choice(docs[200:]), rng.randint(a, b), len(items)
            start = rng.randrange(len(own) - n)
            item = tokens(" ".join(own[start : start + n]))
            out = set(rng.sample(range(len(item)), int(rng.uniform(0.25, 0.4) * len(item))))
            put = rng.random() < 0.5
            body = [rng.choice(rng.choice(docs)) if k in out else w for k, w in enumerate(item) if put or k not in out]
            at = rng.randrange(60)
            items.append((i, " ".join(item)))
            rows.append((i, " ".join(host[:at] + body + host[at : at + 60])))
            classes[i] = name
    got = {r["doc_id"]: set(r["items"]) for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")).collect()}
    text, found, want = dict(rows), Counter(), Counter()
    for i, item in items:
        own, near = item.split(), tokens(text[i])
        masks: dict = {}
        for k, w in enumerate(own):
            masks[w] = masks.get(w, 0) | 1 << k
        share = max(decontaminate.lcs(masks, len(own), near[k : k + len(own) + 20]) for k in range(0, max(1, len(near) - len(own)), 5)) / len(own)
        if share >= decontaminate.LCS:
            want[classes[i]] += 1
            found[classes[i]] += i in got[i]
    recall = {c: found[c] / want[c] for c in lengths}
    assert min(want.values()) >= 25 and min(recall.values()) >= 0.9


def test_lcs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        masks: dict = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert decontaminate.lcs(masks, len(a), b) == table[-1, -1]


@pytest.mark.parametrize("cells", [64, decontaminate.CELLS])
def test_shares_of_many_candidates_are_those_of_each(monkeypatch, cells):
    """Items of one to several masks of 64 words, all surroundings at once, against one at a time."""
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    rng = random.Random(23)
    vocabulary = prose(rng, 60).split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (1, 7, 63, 64, 65, 128, 129, 300)] + [""]
    space = np.random.default_rng(1).normal(size=(decontaminate.DIMS, 8)).astype(np.float32)
    queries = decontaminate.Queries(list(range(len(texts))), texts, space, np.ones(decontaminate.DIMS, np.float32))
    (_, _, _, text), = words(pa.array([" ".join(rng.choice(vocabulary) for _ in range(900)) + " " + texts[5]]))
    cases = [(i, lo, min(len(text), lo + rng.choice([5, 80, 200, 700]))) for i in range(8) for lo in rng.sample(range(900), 20)] + [(5, 890, len(text))]
    items, lo, hi = (np.array(c) for c in zip(*cases, strict=True))
    got = queries.shares(items, text, decontaminate.buckets(text), lo, hi)
    for (item, a, b), share in zip(cases, got, strict=True):
        own, near = queries.words[item], text[a:b].tolist()
        masks = {}
        for k, w in enumerate(own):
            masks[w] = masks.get(w, 0) | 1 << k
        enough = sum(w in masks for w in near) >= decontaminate.LCS_ANSWER * len(own)
        assert share == (decontaminate.lcs(masks, len(own), near) / len(own) if enough else 0)
    assert got[-1] == 1


# --- pages ---


def test_html_documents(spark):
    import html

    got = {r["page_id"]: r for r in html_extract.op6_html_extract(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        start = r["html"].index("<article>") + 9
        end = r["html"].find("</article>")
        inner = r["html"][start : end if end >= 0 else None]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain &lt;b&gt; &amp;amp; text", "plain <b> &amp; text"), ("<p>a<p>b", "a\n\nb"), ("<p>a < b</p>", "a < b"),
    ("<div class='comment-list'><p>x</p></div><div><p>main</p></div>", "main"),
    ("<article><h1>T</h1><section class=comments><p>c</p></section><p>q <a href=x>link</a> r</article><div>foot</div>", "T\n\nq link r"),
    ("<article><header><h1>T</h1></header><p>x&nbsp;&#121;</p><form>f</form><aside>s</aside><footer>z</footer></article>", "T\n\nx y"),
    ("<p title='a>b'>z</p><script>if(a<b){'</p>'}</script>w", "z\n\nw"), ("<main><ul><li>a<li>b</ul></main>", "a\n\nb"),
    ("<!-- <p>no</p> --><p>one\n  two<br>three</p>", "one two three"), ("<div role=navigation>n</div><p>t</p>", "t"), ("<p>open", "open"),
    ("</div></p><p>stray</b></p>", "stray"), ("<header>h</header><p>t</p>", "t"),
])
def test_html_cases(page, text):
    assert html_extract.extract(page, frozenset()) == text


def test_style_tree(spark):
    """Boilerplate without telling names goes, since it says the same on all pages of its host."""
    rng = random.Random(7)
    rows = [(i, f"https://site.example/{i}", f"<body><div class=top>Site name and slogan</div><div class=x><p>{prose(rng, 30)}</p></div><div class=end>All pages end so</div></body>") for i in range(20)]
    rows += [(100 + i, "https://other.example/", "<body><div class=top>Only here</div></body>") for i in range(2)] + [(200, None, None), (None, "no url", "<p>x</p>"), (200, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as host", "'c' as paths", "'c' as text")
    got = html_extract.main_texts(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert all("\n" not in by[i]["text"] and "slogan" not in by[i]["text"] and by[i]["n_chars"] > 60 for i in range(20))
    assert by[100]["text"] == "Only here" and by[200]["text"] == "" and by[None]["text"] == "x"
    copies = [(i, "https://copies.example/", "<body><div>One article, copied</div></body>") for i in range(30)]
    assert {r["text"] for r in html_extract.main_texts(spark.createDataFrame(copies, "page_id long, url string, html string")).collect()} == {"One article, copied"}
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_style_tree_and_articles(spark):
    """The tree decides beside and inside article elements as well."""
    rng = random.Random(21)
    rows = []
    for i in range(20):
        # a teaser is the only article; then an article with a notice that all pages share; then one with a line of the host below
        rows.append((i, "https://teaser.example/", f"<body><article class=card>Read {prose(rng, 9)}</article><div class=body><p>body{i} {prose(rng, 60)}</p></div><div class=end>All pages end so</div></body>"))
        rows.append((100 + i, "https://inside.example/", f"<body><article><p>text{i} {prose(rng, 40)} <b>Acme</b> end</p><div class=x>Read our terms</div></article><div class=y>About us</div></body>"))
        rows.append((200 + i, "https://beside.example/", f"<body><article><p>first{i} {prose(rng, 40)}</p></article><section><p>second{i} {prose(rng, 30)}</p></section><div class=y>About us</div></body>"))
    rows.append((300, "https://alone.example/", f"<body><article>Read more</article><div><p>lonely {prose(rng, 40)}</p></div></body>"))
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(20):
        assert f"body{i} " in got[i] and "All pages" not in got[i]
        assert got[100 + i].startswith(f"text{i} ") and got[100 + i].endswith("Acme end") and "terms" not in got[100 + i]
        assert f"first{i} " in got[200 + i] and f"second{i} " in got[200 + i] and "About" not in got[200 + i]
    assert "lonely" in got[300]


def test_labels_stay_with_their_text(spark):
    """Headings, captions and table headers that all pages of a host share belong to the text that they name."""
    rng = random.Random(22)
    rows, want = [], {}
    for i in range(12):
        a, b, c, d = (f"{x}{i} {prose(rng, 25)}" for x in "abcd")
        table = f"<table><caption>Prices</caption><tr><th>Item</th><th>Price</th></tr><tr><td>{c}</td><td>{i}7</td></tr></table>"
        box = "<div class=box><h3>About the <i>author</i></h3><p>Writes for us</p></div>"
        figure = f"<figure><img src=x><figcaption>Photo: Acme</figcaption></figure><p>{d}</p><h2>Sources</h2>"
        rows.append((i, "https://labels.example/", f"<body><article><h1>Title {a}</h1><h2>Background</h2><p>{a}</p>{box}<h2>Method <b>and</b><br>data</h2><p>{b}</p>{table}{figure}</article><div>Imprint</div></body>"))
        blocks = [f"Title {a}", "Background", a, "Method and data", b, "Prices", "Item", "Price", c, f"{i}7", "Photo: Acme", d, "Sources"]
        want[i] = "\n\n".join(" ".join(x.split()) for x in blocks)
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


@pytest.mark.parametrize(("page", "text"), [
    ("<div class='page has-sidebar'><article><p>a text</p></article></div>", "a text"),
    ("<div class='content-sidebar-wrap'><article><p>a text</p></article><div class=sidebar>s</div></div>", "a text"),
    ("<div class='post no-comments'><p>a text</p></div><p>b</p>", "a text\n\nb"),
    ("<div id=content-sidebar-wrap><p>all of the text</p><div class=sidebar>s</div></div><p>b</p>", "all of the text\n\nb"),
    ("<div class=widget><main><p>a text</p></main></div>", "a text"),
    ("<article><p>a text</p><div class=related><p>other</p></div></article>", "a text"),
    ("<div class=ad>a longer text of an advert</div><article><p>text</p></article>", "text"),
    ("<div class=site-footer>f</div><div class=main-nav>n</div><p>text</p>", "text"),
])
def test_names_of_branches(page, text):
    """A name doesn't drop a branch with the article or most of the text."""
    assert html_extract.extract(page, frozenset()) == text


def test_part_of_a_name_is_less_than_importance():
    page = "<p>long enough to hold most text</p><div class=x-related-y><p>rest</p></div>"
    assert html_extract.extract(page, frozenset()) == "long enough to hold most text"
    rich = frozenset(n.path for n in html_extract.parse(page)[0] if n.tag == "p")
    assert html_extract.extract(page, frozenset(), rich).endswith("rest")


# --- personal data ---


def _base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and personal_data.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_patterns():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("a1@..- +()0b9%\n") for _ in range(rng.randint(0, 60)))
        assert personal_data.base_spans(text) == _base(text)
    assert personal_data.base_spans("1" * 100_000 + "a@" * 50_000) == []
    assert [s[1] for s in personal_data.base_spans("4111 1111 1111 1111 x@y.z 10.0.0.255 10.0.0.256 +1 (212) 555-0100")] == [2, 0, 1, 3]


def _check_personal(rows, got):
    want = Counter()
    for i, text in rows:
        spans = _base(text or "")
        digest = hashlib.sha256(personal_data.joined(spans).encode()).hexdigest()
        want[(i, *(sum(s[1] == k for s in spans) for k in range(4)), digest)] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_personal_documents(spark, edge_docs, edge_rows, no_docs):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = personal_data.op10_personal_data(spark, SMALL).collect()
    _check_personal(rows, got)
    text = dict(rows)
    for r in got:       # base spans stay
        assert set(filter(None, personal_data.joined(_base(text[r["doc_id"]])).split(","))) <= set(r["spans"].split(","))
    _check_personal([(r[0], r[1]) for r in edge_rows], personal_data.find(edge_docs, personal_data.fit(edge_docs)).collect())
    assert personal_data.fit(no_docs) is None and personal_data.find(no_docs, None).count() == 0


def _labelled(line):
    out, spans = "", []
    for m in re.finditer(r"<(\w+)\|(.*?)>|([^<]+|<)", line):
        if m[1]:
            spans.append((len(out), personal_data.KINDS.index(m[1]), len(out) + len(m[2])))
        out += m[2] or m[3]
    return out, spans


def test_model_adds_what_patterns_miss(spark):
    """Hand-labelled lines; the model has seen none of them."""
    net = personal_data.fit(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    lines = [_labelled(line) for line in LINES]
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(lines)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in personal_data.find(rows, net).collect()}
    hits = extra = wanted = 0
    for i, (text, spans) in enumerate(lines):
        base = set(personal_data.joined(_base(text)).split(","))
        got = set(found[i]["spans"].split(",")) - base - {""}
        want = set(personal_data.joined(spans).split(",")) - {""}
        assert not base & want and len(got) == found[i]["n_added"]
        hits, extra, wanted = hits + len(got & want), extra + len(got - want), wanted + len(want)
    assert hits >= 0.75 * wanted and hits >= 9 * extra


def test_planted_values():
    """Planted values are where the spans say, and hold up when written plainly (a card up to its check digit)."""
    rng = random.Random(4)
    seen = Counter()
    for _ in range(2000):
        text, spans = personal_data.planted(prose(rng, 30), rng)
        for a, k, b in spans:
            assert text[a:b].strip() == text[a:b]
            assert k == 2 or personal_data.plausible((a, k, b), text)
            seen[k] += 1
    assert min(seen[k] for k in range(4)) > 200
    for decoy in ("2024-03-17", "1,234,567.89", "3.12.4", "@name", "(12, 45, 78, 90)", "4111.1111.1111.1112"):
        assert not any(personal_data.plausible((0, k, len(decoy)), decoy) for k in range(4))
    assert personal_data.plausible((0, 2, 19), "4111.1111.1111.1111") and not personal_data.plausible((0, 1, 16), "10[.]0[.]0[.]300")


def test_windows_cover_triggers():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "1", "@", "(at)"] if rng.random() < 0.2 else "ab c") for _ in range(rng.randint(0, 400)))
        seen = np.zeros(len(text), bool)
        for s in personal_data.windows(text):
            seen[s : s + personal_data.WINDOW] = True
        for m in re.finditer(r"[@0-9]|\(at\)", text):
            assert seen[max(0, m.start() - personal_data.REACH) : m.end() + personal_data.REACH].all()


def test_gradients():
    rng = np.random.default_rng(0)
    net = personal_data.Net.fresh(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes = rng.integers(0, personal_data.CLASSES, (3, 12)).astype(np.int8)
    tags = rng.integers(0, personal_data.TAGS, (3, 12)).astype(np.int8)
    _, grads = net.gradients(codes, tags)
    for k, p in net.p.items():
        at = np.unravel_index(np.abs(grads[k]).argmax(), p.shape)
        old, losses = p[at], []
        for step in (1e-4, -1e-4):
            p[at] = old + step
            losses.append(net.gradients(codes, tags)[0])
        p[at] = old
        assert grads[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=1e-2)


def test_model_learns_spans():
    """Held-out character tags of unambiguous kinds, and spans across window edges."""
    rng = random.Random(5)

    def line():
        kind = rng.randrange(3)
        hit = [f"{prose(rng, 1)}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com", ".".join(str(rng.randint(1, 255)) for _ in range(4)), f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"][kind]
        return f"{prose(rng, rng.randint(3, 30))} {hit} {prose(rng, rng.randint(3, 30))}"

    def data(n):
        texts = [line() for _ in range(n)]
        starts = [personal_data.windows(t) for t in texts]
        return texts, starts, np.concatenate([personal_data.window_codes(t, s) for t, s in zip(texts, starts, strict=True)]), np.concatenate([personal_data.gold_tags(personal_data.base_spans(t), s) for t, s in zip(texts, starts, strict=True)])

    _, _, codes, tags = data(500)
    net = personal_data.train(codes, tags)
    texts, starts, codes, tags = data(150)
    found, sure = net.decode(codes)
    assert (found == tags).mean() > 0.98 and (found == tags)[tags > 0].mean() > 0.9
    at, hits = 0, 0
    for t, s in zip(texts, starts, strict=True):
        spans = personal_data.reconciled(t, s, found[at : at + len(s)], sure[at : at + len(s)])
        hits += [x for x, _ in spans] == personal_data.base_spans(t)
        at += len(s)
    assert hits >= 120


# --- pipeline ---


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = defaultdict(set)
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in now.select("doc_id").collect()}
        from tidemark.llm.common import stored

        now = stored(stage(spark, now, SMALL), name)
        seen[name] = before - {r["doc_id"] for r in now.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    gold = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [i for i, r in gold.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(i in seen["quality_classifier"] for i in good) <= 0.02 * len(good)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rest = [i for i in text if i not in seen["quality_classifier"]]
    groups = defaultdict(list)
    for i in rest:
        groups[text[i]].append(i)
    assert seen["exact_dedup"] == {i for ids in groups.values() for i in ids if i != max(ids)}
    assert now.columns[:1] == ["doc_id"] and now.count() == len(rest) - len(seen["exact_dedup"]) - len(seen["near_dedup"]) - len(seen["decontamination"])
