"""Mixing, exact and near dedup, repeated bytes: against SQL or brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import expected, same
from helpers import MEDIUM, SMALL, prose

from tidemark.llm import exact_dedup, mixing, near_dedup, suffix_dedup
from tidemark.llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


@pytest.mark.parametrize(("module", "name"), [(mixing, "op1_mix_sources"), (exact_dedup, "op5_exact_dedup")])
def test_sql(spark, module, name):
    assert not same(module.QUERIES[name](spark, SMALL).toPandas(), expected(module.ORACLES[name], SMALL))


def test_mixing_edges(edge_docs, edge_rows):
    got = mixing.mixed(edge_docs).collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in edge_rows]
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, n) for r, n in zip(edge_rows, sizes, strict=True))
    by_source = defaultdict(int)
    for r, n in zip(edge_rows, sizes, strict=True):
        by_source[r[3]] += n
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    goal, left, open_ = {}, float(sum(sizes)), set(order)
    while open_:        # reshare until no source is above its ceiling
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * by_source[s]}
        goal |= {s: 3.0 * by_source[s] for s in full} if full else {s: level * weight[s] for s in open_}
        left -= sum(3 * by_source[s] for s in full)
        open_ = open_ - full if full else set()
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert r["source_size"] == by_source[r["source"]] and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6 for s in order)
    again = mixing.mixed(edge_docs.repartition(5)).collect()
    key = lambda rows: sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in rows)
    assert key(got) == key(again)


def test_mixing_when_a_null_source_is_as_full_as_another(spark):
    """a (weight 1) is full; the null source (weight 3) ties with others in fullness, and comes last."""
    rows = [(1, "w " * 100, "a"), (2, "w " * 1000, "b"), (3, "w " * 300, None)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["source"]: r["target"] for r in got} == pytest.approx({"a": 1400 / 6, "b": 2800 / 6, None: 700.0})
    sizes = {"a": 100, "b": 200, None: 300, "c": 5000}      # a, b and null: 3 * size / weight alike, by name a 1, b 2, c 3, null 1
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())] + [(9, "w " * 100, "d")]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(5700)


def test_fingerprints_compose():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 1000, dtype=np.uint8)
    prints = [exact_dedup.fingerprint(data, [exact_dedup.chunk_powers(b, p, c) for b, p in zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True)]) for c in (7, 64, 4096)]
    assert len(set(prints)) == 1
    base, prime = exact_dedup.BASES[0], exact_dedup.PRIMES[0]
    parts = [exact_dedup.fingerprint(x, [exact_dedup.chunk_powers(base, prime, 64)], (base,), (prime,)) for x in (data, data[:300], data[300:])]
    assert parts[0] == exact_dedup.combine(parts[1], parts[2], 700, base, prime)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (2, 3)])
def test_exact_groups_edges(edge_docs, edge_rows, primes):
    """Also with fingerprints so weak that most groups hold different texts."""
    got = exact_dedup.exact_groups(edge_docs, chunk=64, primes=primes).collect()
    groups = defaultdict(list)
    for r in edge_rows:
        groups[r[1] or ""].append(r[0])
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert Counter(r["text_sha256"] for r in got if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_deduplicated_keeps_columns(edge_docs, edge_rows):
    got = exact_dedup.deduplicated(edge_docs)
    assert got.columns == edge_docs.columns
    assert sorted(r["text"] or "" for r in got.collect()) == sorted({r[1] or "" for r in edge_rows})


def _moved(df, capsys):
    """For each exchange of the plan, whether it moves texts."""
    df.explain("formatted")
    return [bool(re.search(r"\b(row|_extract_text|text)#", c)) for c in re.findall(r"\) Exchange\n(?:Input \[\d+\]|Arguments)[^\[]*\[(.*)\]", capsys.readouterr().out)]


def test_whole_rows_move_once(spark, capsys):
    """Rows that stay are dealt out once, also if some repeat id and text; and those come once."""
    rows = [(i, f"text {i % 50}", "en") for i in range(100)] + [(7, "twin", "en"), (7, "twin", "de"), (None, "none", "en"), (None, "none", "en")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "rows")
    repeats, plain = docs, docs.where("text like 'text%'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = exact_dedup.deduplicated(plain)
        assert sum(_moved(got, capsys)) == 1
        assert sorted(r["doc_id"] for r in got.collect()) == list(range(50, 100))
        got = sorted((r["doc_id"] or -1, r["text"]) for r in exact_dedup.deduplicated(repeats).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == sorted([(i, f"text {i % 50}") for i in range(50, 100)] + [(7, "twin"), (-1, "none")])


def test_whole_rows_stay_where_few_near_copies_go(spark, capsys):
    rng = random.Random(12)
    rows = [(i, prose(rng, 12)) for i in range(3000)]
    rows += [(4000 + i, rows[i][1]) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        got = near_dedup.representatives(docs)
        assert not any(_moved(got, capsys))
        assert sorted(r["doc_id"] for r in got.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _shingles(text):
    words = WORD.findall(text.translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else {text}


def _classes(texts, threshold=0.8):
    """Classes of (id: text) by brute force over pairs that share a shingle."""
    sets = {i: _shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                root[find(b)] = find(a)
    out = defaultdict(set)
    for i in texts:
        out[find(i)].add(i)
    return {frozenset(x) for x in out.values()}


def test_near_dedup_brute_force(spark):
    got = near_dedup.op7_minhash_near_dedup(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    mine = defaultdict(set)
    for r in got:
        mine[r["class_id"]].add(r["doc_id"])
    assert {frozenset(x) for x in mine.values()} == _classes(texts)
    assert all(r["class_id"] == min(mine[r["class_id"]]) and r["class_size"] == len(mine[r["class_id"]]) for r in got)
    assert sum(r["kept"] for r in got) == len(mine)


def test_near_dedup_edges(edge_docs, edge_rows):
    got = near_dedup.classes(edge_docs).select("doc_id", "class_id", "class_size", "kept", "row.text").collect()
    assert len(got) == len(edge_rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["class_id"])
    assert by_id[1] == by_id[2] == by_id[3] == {1}
    assert by_id[7] == by_id[8] == {7}
    assert by_id[4] == by_id[5] == {4}          # null and empty
    assert by_id[6] == {6} and by_id[9] == {9}  # no words: equal only to the same text
    assert len(by_id[None]) == 2
    kept = near_dedup.representatives(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["kept"] for r in got)


def test_large_group_of_near_copies(spark):
    """Hundreds of copies, each with its own change, and texts that share half with them."""
    rng = random.Random(3)
    base = prose(rng, 240).split()
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(240)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:120] + prose(rng, 120).split())) for i in range(60)]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["class_id"] for r in got if r["doc_id"] < 1000} == {0}
    assert all(r["class_id"] == r["doc_id"] for r in got if r["doc_id"] >= 1000)


def test_one_pair_joins_two_large_families(spark, monkeypatch):
    """Each end of the only link between two families is close to its own family's centres."""
    monkeypatch.setattr(near_dedup, "ROUNDS", 1)
    rng = random.Random(31)
    base = prose(rng, 1000).split()

    def changed(n, own=None):
        words = list(base)
        for k in range(n):
            words[5 + 18 * k] = f"other{k}"
        if own is not None:
            words[999] = f"edit{own}"
        return " ".join(words)

    rows = [(i, changed(0, i)) for i in range(100)] + [(100 + i, changed(54, 100 + i)) for i in range(100)] + [(300, changed(18)), (301, changed(36))]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["class_id"] for r in got} == {0}
    apart = near_dedup.classes(spark.createDataFrame(rows[:-2], "doc_id long, text string")).collect()
    assert {r["class_id"] for r in apart} == {0, 100}


def test_pairs_just_below_the_threshold_make_no_rows(spark, monkeypatch):
    """Hundreds of texts of 0.7 to 0.8: a member meets the others in blocks, and no table has a row for each pair."""
    sizes = {}

    def counted(df, purpose):
        out = stored(df, purpose)
        sizes[purpose] = max(sizes.get(purpose, 0), out.count())
        return out

    monkeypatch.setattr(near_dedup, "stored", counted)
    rng, rows = random.Random(12), []
    base = prose(rng, 400).split()
    for i in range(400):
        words = list(base)
        for k in rng.sample(range(400), 4):
            words[k] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.classes(docs).collect()
    factor = near_dedup.frequency_factors(docs)
    sets, root = [near_dedup._one(t, factor) for _, t in rows], list(range(400))
    for i in range(400):        # brute force
        for j in range(i):
            if root[i] != root[j] and near_dedup.jaccard(sets[i], sets[j]) >= near_dedup.THRESHOLD:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(enumerate(root))
    assert max(sizes.values()) <= 30 * 400, sizes      # 15,940 pairs when each had a row


def test_levels_have_the_claimed_recall():
    assert all((1 - 0.8**rows) ** bands <= 1.05e-4 for bands, rows in near_dedup.LEVELS)


def test_agreement_is_counted_once(spark):
    """A task of the step that counts how far centres agree needs one Python worker, and pairs below the bound go."""
    rng = np.random.default_rng(2)
    codes = {i: rng.integers(0, 3, 72, np.uint8) for i in range(6)}
    met = spark.createDataFrame([(b, i, i) for b in (1, 2) for i in codes], "bucket long, id long, root long")
    held = spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in codes.items()], "id long, codes binary")
    agree = {(i, j): int((codes[i] == codes[j]).sum()) for i in codes for j in codes if i != j}
    least = sorted(agree.values())[len(agree) // 2]
    found = near_dedup._nearest_centres(met, 0, held, least, None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("ArrowEvalPython|MapInArrow", plan)) == 1
    got = [tuple(r) for r in found.select("id", "centre", "a", "b").collect()]
    assert got and all(agree[i, j] >= least and {a, b} == {i, j} and i > j for i, j, a, b in got)


def test_weighted_samples_estimate_similarity():
    rng = np.random.default_rng(2)
    own = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = rng.uniform(0.5, 3, 400).astype(np.float32), rng.uniform(0.5, 3, 400).astype(np.float32)
    at, tables = np.array([0, 400]), near_dedup._tables()
    x, y = (near_dedup.samples(own, w, at, range(2000), tables)[0] for w in (a, b))
    assert abs((x == y).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def test_suffix_array():
    rng = random.Random(4)
    for _ in range(600):
        top = rng.choice([1, 2, 5])
        text = [rng.randint(0, top) for _ in range(rng.randint(0, 40))]
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in ([1] * 500, [1, 2] * 300, list(range(300)), list(range(300))[::-1]):
        assert suffix_dedup.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def _spans(texts, length):
    """Per text, the bytes to remove."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i] += 1
                mark[i + length if i + length <= len(t) else len(t)] -= 1
        out.append(np.cumsum(mark)[: len(t)] > 0)
    return out


def _check_spans(rows, got):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, mark in zip(rows, texts, _spans(texts, suffix_dedup.LENGTH), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~mark])
        want[(r[0], len(t), int(mark.sum()), int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 1])
def test_repeated_bytes_edges(edge_docs, edge_rows, monkeypatch, crowd):
    """Both ways to decide parts: suffix arrays, and counted windows for crowded classes."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = [r for r in edge_rows if len(r[1] or "") < 100_000]
    docs = stored(edge_docs.where("text is null or length(text) < 100000"), "edges")
    _check_spans(rows, suffix_dedup.without_repeats(docs).collect())


def test_repeated_bytes_passages(spark):
    """A passage that many texts share in different contexts, and pieces of just under and over the length."""
    rng = random.Random(8)
    passage = prose(rng, 200)
    rows = [(i, prose(rng, rng.randint(5, 90)) + passage[rng.randint(0, 60) : len(passage) - rng.randint(0, 60)] + prose(rng, rng.randint(5, 90))) for i in range(60)]
    cut = prose(rng, 200)
    rows += [(100, cut[:399] + "§"), (101, "¶" + cut[:399]), (102, "ß" + cut[:401]), (103, cut[:402] + "é")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "passages")
    _check_spans(rows, suffix_dedup.without_repeats(docs).collect())


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 2000)
    rng = random.Random(6)
    part = prose(rng, 700)
    rows = [(1, prose(rng, 1500) + part + prose(rng, 900)), (2, part + prose(rng, 300)), (3, "z" * 3000)]
    data = [(r[1]).encode() for r in rows]
    got = defaultdict(set)
    for i, t in enumerate(data):
        for lo in range(0, len(t), 2000):
            piece = np.frombuffer(t[lo : lo + 2000 + suffix_dedup.LENGTH - 1], np.uint8)
            _, a, p, q, _, _ = suffix_dedup.ranges(piece, np.array([0, len(piece)]))
            for x, y in zip(p, q, strict=True):
                assert not got[i] & set(range(lo + x, lo + y + 1))
                got[i] |= set(range(lo + x, lo + y + 1))
    assert all(got[i] == set(range(len(t) - suffix_dedup.LENGTH + 1)) for i, t in enumerate(data))


def test_empty_tables(no_docs):
    assert mixing.mixed(no_docs).count() == 0
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.deduplicated(no_docs).count() == 0
    assert near_dedup.classes(no_docs).count() == 0
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_medium_repeats(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("length(text) < 3000").select("doc_id", "text").limit(150)
    rows = [tuple(r) for r in docs.collect()]
    table = stored(spark.createDataFrame(rows, "doc_id long, text string"), "medium")
    _check_spans(rows, suffix_dedup.without_repeats(table).collect())
