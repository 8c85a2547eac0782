"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is its set of five-word shingles. A shingle's weight is (1 + ln tf) times a factor
that falls from 1 to ``1 - IDF_SHARE`` as its document frequency grows to all documents.
Frequencies come from all documents, through a sketch of fixed size (``SKETCH`` counters),
so that the table sent to the tasks stays bounded. Each text gets consistent weighted
samples; two texts of weighted Jaccard similarity s agree in one sample with probability s.
Samples make up bands, so at 0.8 two texts meet in some bucket with probability 0.9999.

Texts with the same weighted set are one vertex from then on. First, ``ROUNDS`` rounds link
members of a bucket to centres: each vertex is compared with the centre that most of its samples
agree with, and the exact weighted Jaccard similarity decides. That makes one component of a
family of near copies, with a comparison for each member and not for each pair. Buckets whose
members are all in one component are done. The vertices of all others get more samples in longer
bands (the second of ``LEVELS``), which part texts of middling similarity. In each bucket that
still holds two components, every member is then compared with every member of another
component: samples in blocks of ``BLOCK`` members (the largest component's members only with
the rest), each pair in the first bucket that it shares. Members that have a pair left by its
samples meet again in their blocks with their texts, and the exact similarity of these pairs
decides, those that agree most first. A pair whose ends earlier pairs of the block have linked
says nothing new; all others are compared, and a block gives no more links than it has
members. So no pair makes a row of its own, none is skipped but by its samples, and no rounds
go on to convergence. Components of all links are the classes.

A pair at exactly 0.8 is lost with a chance of one in ten thousand by each level's bands and by
the samples' bound: at least 0.9997 of such links are found.

Defined results: a text of one to four words has one shingle, all its words. A text without
words is equal only to the same text. Null counts as empty. The class id is the smallest
doc_id in the class, and one row that has it stays; a null doc_id is above every other.
Rows that repeat a doc_id are rows of their own. Extra columns are carried along untouched.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, mixed, shingles, signed, stored, texts, words
from tidemark.llm.components import components

K, THRESHOLD = 5, 0.8
#: Bands and samples in a band: all texts, then those of unsettled buckets. (1 - 0.8 ** samples) ** bands is 0.0001 at most.
LEVELS = ((18, 4), (50, 8))
CENTRES, ROUNDS = 4, 2
#: Members of a bucket, and bytes of their texts, that are compared with as many others at once.
BLOCK, BLOCK_BYTES = 512, 1 << 24
#: Standard deviations below the expected agreement at which the threshold is ruled out.
DOUBT = 3.7
#: Weighted sets that a task keeps while it compares pairs, in shingles.
KEPT = 1 << 22
SKETCH = 1 << 17
IDF_SHARE = 0.3
_TABLE = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) values, logarithms of such values, and uniform values, by 16 hash bits."""
    rng = np.random.default_rng(11)
    return tuple(x.astype(np.float32) for x in (rng.gamma(2, 1, _TABLE), np.log(rng.gamma(2, 1, _TABLE)), rng.random(_TABLE)))


def distinct_shingles(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each row, their counts, and where each row's begin."""
    found, counts, begins = [], [], [0]
    for a, b in zip(at, at[1:], strict=False):
        own, n = np.unique(hashes[a:b], return_counts=True)
        found.append(own)
        counts.append(n)
        begins.append(begins[-1] + len(own))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(found), np.concatenate(counts), np.array(begins)


def weighted(column: pa.Array, factor: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slice by slice: first and last row, distinct shingles, their weights, where rows begin."""
    for first, last, begins, hashes in words(column):
        own, n, at = distinct_shingles(*shingles(hashes, begins, K))
        yield first, last, own, (1 + np.log(n)).astype(np.float32) * factor[(own >> np.uint64(40)) % np.uint64(SKETCH)], at


def samples(own: np.ndarray, weights: np.ndarray, at: np.ndarray, numbers: range, tables) -> np.ndarray:
    """Consistent weighted samples (rows x numbers) as 64-bit codes; every row has a shingle."""
    gammas, logs, uniforms = tables
    out = np.empty((len(at) - 1, len(numbers)), np.uint64)
    heights, counts = np.log(weights), np.diff(at)
    low = np.uint64(0xFFFF)
    for j, number in enumerate(numbers):
        x = own * np.uint64((int(_ODD) * (2 * number + 1) & _MASK) | 1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        r, beta = gammas[x >> np.uint64(48)], uniforms[(x >> np.uint64(32)) & low]
        t = np.floor(heights / r + beta)
        score = logs[(x >> np.uint64(16)) & low] - r * (t - beta + 1)
        least = np.minimum.reduceat(score, at[:-1])
        hits = np.flatnonzero(score == np.repeat(least, counts))
        best = hits[np.searchsorted(hits, at[:-1])]
        out[:, j] = mixed(own[best] + t[best].astype(np.int64).astype(np.uint64) * _ODD)
    return out


def frequency_factors(docs: DataFrame) -> np.ndarray:
    """Weight factor by sketch counter, from the document frequencies of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(SKETCH, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, begins, hashes in words(batch.column(0)):
                own, _, _ = distinct_shingles(*shingles(hashes, begins, K))
                seen += np.bincount(((own >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], rows))], names=["counter", "n"])

    text = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text"))
    got = text.mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()   # SKETCH + 1 rows at most
    counter, n = got["counter"].to_numpy(), got["n"].to_numpy()
    seen, total = np.zeros(SKETCH), max(1, int(n[counter < 0].sum()))
    seen[counter[counter >= 0]] = n[counter >= 0]
    # a counter holds several shingles: take off what the others are expected to add
    own = np.clip(seen - (seen.sum() - seen) / (SKETCH - 1), 1, total)
    idf = np.log((1 + total) / (1 + own)) / np.log(1 + total)
    return (1 - IDF_SHARE + IDF_SHARE * np.clip(idf, 0, 1)).astype(np.float32)


_SIGNATURE = pa.struct([("set_key", pa.int64()), ("set_check", pa.int64()), ("bands", pa.list_(pa.int64())), ("codes", pa.binary())])


def least_agreement(level: int, threshold: float) -> int:
    """Samples in which two texts at the threshold agree, but for one pair in ten thousand."""
    bands, rows = LEVELS[level]
    n = bands * rows
    return max(1, int(threshold * n - DOUBT * (threshold * (1 - threshold) * n) ** 0.5))


def signer(factor, level: int):
    """An Arrow function from texts to their set's key, band hashes, and a byte of each sample.

    Beyond the first level bands are made of these bytes, which show a pair's first common band.
    """
    bands, rows = LEVELS[level]
    before = sum(b * r for b, r in LEVELS[:level])

    def run(column: pa.Array) -> pa.Array:
        tables = _tables()
        data, offsets = texts(column)
        n = len(column)
        keys, checks = np.zeros(n, np.int64), np.zeros(n, np.int64)
        buckets, codes = [[]] * n, [b""] * n
        for first, last, own, weights, at in weighted(column, factor.value):
            some = np.flatnonzero(np.diff(at))
            if len(some):
                starts = at[:-1][some]
                tagged = mixed(own + (weights.view(np.uint32).astype(np.uint64) << np.uint64(7)))
                keys[first + some] = signed(mixed(np.add.reduceat(tagged, starts)))
                checks[first + some] = signed(mixed(np.add.reduceat(mixed(tagged ^ _ODD), starts)))
                drawn = samples(own, weights, np.append(starts, at[-1]), range(before, before + bands * rows), tables)
                key = np.zeros((len(some), bands), np.uint64) + np.arange(before, before + bands, dtype=np.uint64) + np.uint64(1)
                short = (drawn >> np.uint64(56)).astype(np.uint8)
                for k in range(rows):
                    key = mixed(key * _ODD + (short.astype(np.uint64) if level else drawn)[:, k::rows])
                for i, j in enumerate(some):
                    buckets[first + j], codes[first + j] = signed(key[i]), short[i].tobytes()
            for i in set(range(last - first)) - set(some.tolist()):
                text = data[offsets[first + i] : offsets[first + i + 1]].tobytes()     # no words: equal only to the same bytes
                keys[first + i], checks[first + i] = hash_bytes(text, 1), hash_bytes(text, 2)
        return pa.StructArray.from_arrays(
            [pa.array(keys), pa.array(checks), pa.array(buckets, pa.list_(pa.int64())), pa.array(codes, pa.binary())], fields=list(_SIGNATURE)
        )

    return F.arrow_udf(run, "set_key long, set_check long, bands array<long>, codes binary")


def hash_bytes(text: bytes, seed: int) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(text, digest_size=8, salt=bytes([seed])).digest(), "big", signed=True)


def verified(pairs: DataFrame, pool: DataFrame, factor, threshold: float) -> DataFrame:
    """The pairs (id, centre) whose weighted Jaccard similarity reaches the threshold."""

    def run(ids: pa.Array, centres: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        out, known, size = [], {}, 0
        for i, j, a, b in zip(ids.to_pylist(), centres.to_pylist(), left, right, strict=True):
            for key, text in ((i, a), (j, b)):
                if key not in known:
                    if size > KEPT:
                        known, size = {k: known[k] for k in (i, j) if k in known}, 0
                    known[key] = _one(text.as_py(), factor.value)
                    size += len(known[key][0])
            out.append(jaccard(known[i], known[j]))
        return pa.array(out, pa.float64())

    similarity = F.arrow_udf(run, "double")
    left, right = pool.alias("l"), pool.alias("r")
    with_left = pairs.join(left, F.col("id") == F.col("l.rid")).select("id", "centre", F.col("l.text").alias("a"))
    both = with_left.join(right, F.col("centre") == F.col("r.rid")).select("id", "centre", "a", F.col("r.text").alias("b"))
    return both.select("id", "centre", similarity("id", "centre", "a", "b").alias("similarity")).where(F.col("similarity") >= threshold)


Set = tuple[np.ndarray, np.ndarray]


def _one(text: str, factor: np.ndarray) -> Set:
    _, _, own, weights, _ = next(weighted(pa.array([text], pa.large_string()), factor))
    return own, weights


def jaccard(left: Set, right: Set) -> float:
    """Weighted Jaccard similarity of two texts' shingles (sorted) with their weights."""
    (own, weights), (others, theirs) = left, right
    at = np.searchsorted(others, own)
    at[at == len(others)] = 0
    same = others[at] == own
    both = float(np.minimum(weights[same], theirs[at[same]]).sum())
    return both / max(1e-12, float(weights.sum()) + float(theirs.sum()) - both)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _rooted(rows: DataFrame, roots: DataFrame | None, id: str = "id", root: str = "root") -> DataFrame:
    """The rows with the root of the component that ``id`` is in: itself, if it has no link."""
    if roots is None:
        return rows.withColumn(root, F.col(id))
    known = roots.select(F.col("id").alias("_of"), F.col("root").alias("_root"))
    return rows.join(known, F.col(id) == F.col("_of"), "left").withColumn(root, F.coalesce("_root", id)).drop("_of", "_root")


def _unsettled(met: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(bucket, id, root, and what else met has) of the buckets whose members aren't all in one component."""
    now = _rooted(met.select([c for c in met.columns if c != "root"]), roots)
    several = now.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("bucket")
    return stored(now.join(several, "bucket", "left_semi"), "met")


def agreement(a: pa.Array, b: pa.Array) -> pa.Array:
    """In how many samples two rows agree."""
    return pa.array([np.count_nonzero(np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int32())


def _nearest_centres(met: DataFrame, turn: int, codes: DataFrame, least: int, tested: DataFrame | None) -> DataFrame:
    """Pairs (id, centre) with their roots a, b: for each vertex, the centre that agrees with it most.

    A hash of the id alone picks the centres, so a family has the same ones in all its buckets.
    """
    first = F.array(*[F.min_by(F.struct("id", "root"), F.xxhash64("id", F.lit(turn * CENTRES + j))) for j in range(CENTRES)])
    centres = met.groupBy("bucket").agg(F.array_distinct(first).alias("centres"))
    met_centres = met.join(centres, "bucket").select("id", F.col("root").alias("a"), F.explode("centres").alias("c"))
    ends = met_centres.select("id", "a", F.col("c.id").alias("centre"), F.col("c.root").alias("b")).where("a <> b").distinct()
    if tested is not None:
        ends = ends.join(tested.unionByName(tested.select(F.col("centre").alias("id"), F.col("id").alias("centre"))), ["id", "centre"], "left_anti")

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = agreement(batch.column("x"), batch.column("y"))
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "centre", "a", "b")), n], names=["id", "centre", "a", "b", "n"])
            yield out.filter(pc.greater_equal(n, least))

    left, right = codes.select("id", F.col("codes").alias("x")), codes.select(F.col("id").alias("centre"), F.col("codes").alias("y"))
    both = ends.join(left, "id").join(right, "centre").select("id", "centre", "a", "b", "x", "y")
    # as a column, the count would be made by the filter and again behind it, by two Python workers for each task
    seen = both.mapInArrow(agreeing, "id long, centre long, a long, b long, n int")
    best = seen.groupBy("id").agg(F.max(F.struct("n", "centre", "a", "b")).alias("m")).select("id", "m.centre", "m.a", "m.b")
    # two vertices that chose one another are one pair
    return best.groupBy(F.greatest("id", "centre").alias("id"), F.least("id", "centre").alias("centre")).agg(F.first("a").alias("a"), F.first("b").alias("b"))


def _in_blocks(met: DataFrame) -> DataFrame:
    """Members (bucket, band, id, root) dealt to pairs of blocks: side 0 is compared with side 1, or all with all if i = j.

    Members of a large bucket's largest component meet the others only.
    """
    by_root = met.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    sizes = by_root.groupBy("bucket").agg(F.max(F.struct("n", "root", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    large = (F.col("n") > BLOCK) | (F.col("bytes") > BLOCK_BYTES)
    blocks = lambda n, size: F.greatest(F.ceil(n / F.lit(BLOCK)), F.ceil(size / F.lit(BLOCK_BYTES))).cast("int")
    rest = blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes"))
    sizes = sizes.select(
        "bucket", F.when(large, F.col("top.root")).alias("main"), F.when(large, rest).otherwise(1).alias("n_rest"),
        F.when(large, blocks(F.col("top.n"), F.col("top.bytes"))).otherwise(0).alias("n_main"),
    )
    rows = met.join(sizes, "bucket").withColumn("is_main", F.coalesce(F.col("root") == F.col("main"), F.lit(False)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda rest, i, j, side: F.struct(rest.alias("within"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    own, yes, no = F.col("own"), F.lit(True), F.lit(False)
    among_rest = F.transform(upto(F.col("n_rest")), lambda k: place(yes, F.least(own, k), F.greatest(own, k), own > k))
    to_main = F.transform(upto(F.col("n_main")), lambda k: place(no, own, k, no))
    to_rest = F.transform(upto(F.col("n_rest")), lambda k: place(no, k, own, yes))
    places = F.when(F.col("is_main"), to_rest).otherwise(F.concat(among_rest, to_main))
    return rows.select("bucket", "band", "id", "root", F.explode(places).alias("p")).select("bucket", "band", "p.*", "id", "root")


_BLOCK_KEY = ["bucket", "within", "i", "j"]
_MEMBER = [*_BLOCK_KEY, "side", "band", "id", "root"]
Block = dict[str, np.ndarray]


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Block after block out of rows that are sorted by block."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "codes"}
        now["codes"] = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        if rest is not None:
            now = {c: np.concatenate([rest[c], now[c]]) for c in now}
        new = np.zeros(len(now["id"]), bool)
        new[0] = True
        for c in _BLOCK_KEY:
            new[1:] |= now[c][1:] != now[c][:-1]
        begins = np.flatnonzero(new)
        for a, b in zip(begins, begins[1:], strict=False):
            yield {c: v[a:b] for c, v in now.items()}
        rest = {c: v[begins[-1] :] for c, v in now.items()}       # the last block may go on
    if rest is not None:
        yield rest


def _candidates(block: Block, least: int, rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Member by member, the others with another root that agree in ``least`` samples, and in how many.

    A pair that shares several buckets counts in that of its first band.
    """
    roots, side, codes, band = block["root"], block["side"], block["codes"], block["band"][0]
    whole = block["within"][0] and block["i"][0] == block["j"][0]
    left = np.arange(len(roots)) if whole else np.flatnonzero(side == 0)
    right = left if whole else np.flatnonzero(side == 1)
    for k, x in enumerate(left):
        to = right[k + 1 :] if whole else right
        to = to[roots[to] != roots[x]]
        if len(to):
            same = codes[to] == codes[x]
            n = np.bitwise_count(same.view(np.uint64)).sum(axis=1, dtype=np.int64)
            enough = np.flatnonzero(n >= least)
            here = enough[same[enough].reshape(len(enough), codes.shape[1] // rows, rows).all(axis=2).argmax(axis=1) == band]
            if len(here):
                yield int(x), to[here], n[here]


def _links(block: Block, factor: np.ndarray, threshold: float, least: int, rows: int) -> Iterator[tuple[int, int]]:
    """Pairs of roots that link all components of the block which similar members link, directly or by others."""
    found = [(np.full(len(to), x), to, n) for x, to, n in _candidates(block, least, rows)]
    if not found:
        return
    x, y, n = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(-n, kind="stable")
    sets: dict[int, Set] = {}
    parent: dict[int, int] = {}

    def top(root: int) -> int:
        while (up := parent.get(root, root)) != root:
            parent[root] = root = parent.get(up, up)
        return root

    roots = block["root"].tolist()
    for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
        a, b = top(roots[i]), top(roots[j])
        if a == b:
            continue
        for k in (i, j):
            if k not in sets:
                sets[k] = _one(block["text"][k], factor)
        if jaccard(sets[i], sets[j]) >= threshold:
            parent[max(a, b)] = min(a, b)
            yield roots[i], roots[j]


def _alike(met: DataFrame, finer: DataFrame, factor, threshold: float) -> DataFrame:
    """(a, b): pairs of roots that link all components with similar members (bucket, band, id, root) in one bucket."""
    least, rows = least_agreement(1, threshold), LEVELS[1][1]

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_blocks(batches):
            some = np.zeros(len(block["id"]), bool)
            for x, to, _ in _candidates(block, least, rows):
                some[x] = some[to] = True
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(block[c][some]) for c in _MEMBER], names=_MEMBER)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_blocks(batches):
            pairs = list(_links(block, factor.value, threshold, least, rows))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])

    def dealt(members: DataFrame, columns: list[str]) -> DataFrame:
        rows = members.join(finer.select("id", *columns), "id").repartition(_tasks(met.sparkSession), *_BLOCK_KEY)
        return rows.sortWithinPartitions(*_BLOCK_KEY).select(*_MEMBER, *columns)

    schema = "bucket long, within boolean, i int, j int, side int, band int, id long, root long"
    some = stored(dealt(_in_blocks(met), ["codes"]).mapInArrow(involved, schema), "involved")
    return dealt(some, ["codes", "text"]).mapInArrow(linked, "a long, b long")


def _merged(roots: DataFrame | None, good: DataFrame) -> DataFrame | None:
    """The roots (id, root) after the good pairs (with the roots a, b of their ends)."""
    edges = stored(good.select("a", "b").distinct(), "root-edges")
    if edges.isEmpty():
        return roots
    new = components(edges)
    if roots is None:
        return new
    moved = roots.join(new.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
    return stored(moved.unionByName(new.join(roots.select("id"), "id", "left_anti").select("id", "root")), "roots")


def _linked(pairs: DataFrame, pool: DataFrame, factor, threshold: float, roots: DataFrame | None) -> DataFrame | None:
    """The roots after the pairs (with the roots a, b of their ends) that reach the threshold."""
    if pairs.isEmpty():
        return roots
    return _merged(roots, verified(pairs.select("id", "centre"), pool, factor, threshold).join(pairs, ["id", "centre"]))


def _components(marked: DataFrame, sets: DataFrame, factor, threshold: float) -> DataFrame | None:
    """(id, root) of the vertices (rows of marked with an id in sets) that have a link; None if none has."""
    spark = marked.sparkSession
    vertices = marked.select("rid", "bands").join(sets.select(F.col("id").alias("rid")), "rid", "left_semi")
    met = stored(vertices.select(F.col("rid").alias("id"), F.explode("bands").alias("bucket")), "buckets")
    met = _unsettled(met, None)
    ids = stored(met.select(F.col("id").alias("rid")).distinct(), "unsettled")      # stored: its size decides how texts are found
    pool = stored(marked.select("rid", F.coalesce("row.text", F.lit("")).alias("text"), "codes").join(ids, "rid", "left_semi"), "pool")
    codes = pool.select(F.col("rid").alias("id"), "codes")
    roots, tested = None, None
    for turn in range(ROUNDS):
        pairs = stored(_nearest_centres(met, turn, codes, least_agreement(0, threshold), tested), "pairs")
        roots = _linked(pairs, pool, factor, threshold, roots)
        tested = pairs.select("id", "centre") if tested is None else tested.unionByName(pairs.select("id", "centre"))
        met = _unsettled(met, roots)
    # few rows, much work for each: deal them out to all tasks
    rest = pool.select("rid", "text").join(met.select(F.col("id").alias("rid")).distinct(), "rid", "left_semi").repartition(_tasks(spark), "rid")
    finer = stored(rest.withColumn("sig", signer(factor, 1)("text")).select(F.col("rid").alias("id"), "text", "sig.bands", "sig.codes"), "finer")
    met = _unsettled(finer.select("id", F.octet_length("text").alias("size"), F.posexplode("bands").alias("band", "bucket")), roots)
    return _merged(roots, _alike(met, finer, factor, threshold))


def _decided(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The rows of docs with their number (row, rid, doc_id, and more), and rid, class_id, class_size, kept of each."""
    spark = docs.sparkSession
    factor = spark.sparkContext.broadcast(frequency_factors(docs))      # SKETCH numbers
    base = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.monotonically_increasing_id().alias("rid"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    marked = stored(base.withColumn("sig", signer(factor, 0)("text")).select("row", "rid", "doc_id", "sig.*"), "signatures")
    sets = stored(marked.groupBy("set_key", "set_check").agg(F.min("rid").alias("id")), "sets")
    roots = _components(marked, sets, factor, threshold)
    if roots is None:
        roots = sets.select("id", F.col("id").alias("root")).limit(0)
    by_set = stored(sets.join(roots, "id", "left").select("set_key", "set_check", F.coalesce("root", "id").alias("root")), "set-roots")
    rooted = stored(marked.select("rid", "doc_id", "set_key", "set_check").join(by_set, ["set_key", "set_check"]).select("rid", "doc_id", "root"), "rooted")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    groups = stored(rooted.groupBy("root").agg(least.alias("first"), F.count("*").alias("class_size")), "classes")
    decided = rooted.join(groups, "root").select(
        "rid", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("first.rid")).alias("kept")
    )
    return marked, stored(decided, "decided")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: ``row`` (all its columns), rid, doc_id, class_id, class_size, kept."""
    marked, decided = _decided(docs, threshold)
    return marked.select("row", "rid", "doc_id").join(decided, "rid")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class, the class's size, and whether it is the one that stays."""
    return classes(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id", "class_size", "kept")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of docs."""
    marked, decided = _decided(docs, THRESHOLD)
    gone = stored(decided.where("not kept").select("rid"), "gone")      # stored: if they are few, whole rows stay where they are
    return marked.select("row", "rid").join(gone, "rid", "left_anti").select("row.*")


ORACLES: dict[str, str] = {}
QUERIES = {"op7_minhash_near_dedup": op7_minhash_near_dedup}
