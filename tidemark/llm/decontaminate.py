"""Benchmark decontamination by latent semantic retrieval.

Every text is cut into overlapping passages of ``WINDOW`` words, each a TF-IDF vector over
``DIMS`` hashed words. Document frequencies are counted over the passages of all documents.
A randomised SVD gives the latent space: tasks multiply their passages with a random matrix
and its image, and only these small products reach the driver. The space (the index) is
fitted on the disjoint passages of all documents and of the benchmark, without moving them;
every passage of every document is then projected and compared.

Benchmark items are the queries. An item is compared with passages of about its own length, in
steps of ``STRIDE`` words up to ``WINDOW``; a longer one is cut into passages. Passages whose
cosine with an item reaches ``COSINE`` are candidates, unless the surroundings have too few of
the item's words for any subsequence. A candidate is verified on its words: the
longest common subsequence of item and surroundings must hold ``LCS`` of the item's words,
or ``LCS_ANSWER`` if the item's answer (its ``ANSWER`` rarest words) is there as well. These
lengths are computed with a bit per word of the item, for all candidates of a slice at once. Items
are searched in blocks of ``BLOCK``, so the queries sent to tasks are bounded whatever the
size of the benchmark.

Defined results: null or empty texts and items without words match nothing. A null item_id
stands as null in the list. Repeated items are listed once, by item_id. Rows that repeat a
doc_id are rows of their own. Extra columns are carried along untouched. Without benchmark
or documents nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, mixed, words

DIMS, RANK, OVERSAMPLE = 4096, 128, 16
WINDOW, STRIDE = 40, 10
PARTS = 16
COSINE, LCS, LCS_ANSWER, ANSWER = 0.35, 0.6, 0.45, 3
BLOCK = 4096
#: Words that are compared at once.
CELLS = 1 << 18
#: Rows of a matrix that are gathered at once to be added up.
ROWS = 1 << 12
#: Groups of rows that are added up at once, and the least number that is worth it.
GROUPS, FEW = 1 << 10, 48
#: Passages for each task of the fit, and the least and most tasks: each sends a matrix, which costs disk, to be added up.
SHARE, TASKS = 1 << 18, (16, 128)
_PER = WINDOW // STRIDE


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64) % DIMS


Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


def passage_sums(table: np.ndarray, own: np.ndarray, begins: np.ndarray) -> list[Sums]:
    """For passages of 1 to _PER strides: sums of their words' table rows, the row each belongs
    to, and its first word in the row.

    Words are added up in strides first, and strides in passages.
    """
    counts = np.diff(begins)
    n = -(-counts // STRIDE)
    if not n.sum():
        return [(np.zeros((0, table.shape[1]), table.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64))] * _PER
    row = np.repeat(np.arange(len(counts)), n)
    first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=first[1:])
    number = np.arange(len(row)) - first[row]
    start, end = begins[row] + number * STRIDE, begins[row + 1]
    padded = np.vstack([table, np.zeros((1, table.shape[1]), table.dtype)])
    strides = np.zeros((len(row), table.shape[1]), table.dtype)
    for k in range(STRIDE):
        at = start + k
        strides += padded.take(np.where(at < end, own[np.minimum(at, len(own) - 1)], len(table)), axis=0)
    out = []
    whole = strides.copy()
    for k in range(_PER):
        if k:
            inside = np.flatnonzero(number + k < n[row])
            whole[inside] += strides[inside + k]
        full = number <= np.maximum(n[row] - k - 1, 0)      # passages that aren't the tail of another
        out.append((whole[full], row[full], number[full] * STRIDE))
    return out


def passage_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse document frequency of each bucket, over disjoint passages of all documents, and how many these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for _, _, begins, hashes in words(batch.column(0)):
                row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
                number = (np.arange(len(hashes)) - begins[row]) // WINDOW
                new = np.ones(len(hashes), bool)
                new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
                passage = np.cumsum(new) - 1
                total += int(new.sum())
                own = np.sort((passage * DIMS + buckets(hashes)).astype(np.int32 if len(hashes) < 1 << 19 else np.int64))
                seen += np.bincount(own[np.append(True, own[1:] != own[:-1])[: len(own)]] % DIMS, minlength=DIMS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.append(total, seen))], names=["bucket", "n"])

    text = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text"))
    got = text.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").toArrow()
    n = got["n"].to_numpy() if len(got) else np.zeros(DIMS + 1)
    return np.log((1 + n[0]) / (1 + n[1:])).astype(np.float32), int(n[0])


def group_sums(table: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the table's ``rows`` by group; groups lie end to end and begin at ``starts``.

    At most ROWS rows are gathered at once, or one group.
    """
    out, ends = np.empty((len(starts), table.shape[1]), table.dtype), np.append(starts[1:], len(rows))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + ROWS, side="right")))
        np.add.reduceat(table[rows[starts[first] : ends[last - 1]]], starts[first:last] - starts[first], axis=0, out=out[first:last])
        first = last
    return out


def many_sums(table: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``group_sums`` of many groups. The first rows of GROUPS groups are added at once, then the second
    ones, and so on, longest groups first; what is left where few are as long is summed group by group.
    """
    size = np.diff(np.append(starts, len(rows)))
    order = np.argsort(-size, kind="stable")
    out = np.empty((len(starts), table.shape[1]), table.dtype)
    gathered = np.empty((min(GROUPS, len(starts)), table.shape[1]), table.dtype)
    for first in range(0, len(order), GROUPS):
        of = order[first : first + GROUPS]
        at, length = starts[of], size[of]
        sums = table.take(rows[at], axis=0)
        done = 1
        while (n := int(np.searchsorted(-length, -done))) >= FEW:       # groups with more rows
            sums[:n] += table.take(rows[at[:n] + done], axis=0, out=gathered[:n], mode="clip")
            done += 1
        if n:
            begins = np.cumsum(length[:n] - done) - (length[:n] - done)
            place = np.repeat(at[:n] + done - begins, length[:n] - done)
            sums[:n] += group_sums(table, rows[place + np.arange(len(place))], begins)
        out[of] = sums
    return out


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words' buckets of disjoint passages, and where each passage begins: of many texts at once, or parts of a long one."""
    held, n = [], 0
    for batch in batches:
        for _, _, begins, hashes in words(batch.column(0)):
            row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
            new = (np.arange(len(hashes)) - begins[row]) % WINDOW == 0
            cuts = np.append(np.flatnonzero(new)[::ROWS], len(hashes))
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                held.append((buckets(hashes[lo:hi]), new[lo:hi]))
                n += hi - lo
                if n >= WINDOW * ROWS:
                    yield np.concatenate([x for x, _ in held]), np.flatnonzero(np.concatenate([x for _, x in held]))
                    held, n = [], 0
    if held:
        yield np.concatenate([x for x, _ in held]), np.flatnonzero(np.concatenate([x for _, x in held]))


def _products(texts: DataFrame, matrix: np.ndarray, idf: np.ndarray, back: bool) -> np.ndarray:
    """With A the TF-IDF passages (rows): A'A matrix, or if not ``back`` (A matrix)'(A matrix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = matrix.shape[1]
        out = np.zeros((DIMS if back else width, width))
        scaled = (idf[:, None] * matrix).astype(np.float32)
        for own, begins in _passages(batches):
            image = many_sums(scaled, own, begins)
            if back:
                passage = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(own))))
                order = np.argsort(own.astype(np.uint16), kind="stable")        # DIMS numbers: sorted by their digits
                sorted_own = own[order]
                starts = np.flatnonzero(np.r_[True, sorted_own[1:] != sorted_own[:-1]])
                out[sorted_own[starts]] += many_sums(image, passage[order], starts)
            else:
                out += image.T @ image
        if back:
            out *= idf[:, None]
        own, rows = TaskContext.get().partitionId(), [x.tobytes() for x in np.array_split(out, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array([own] * PARTS), pa.array(range(PARTS)), pa.array(rows, pa.binary())], names=["task", "rows", "part"])

    def total(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")       # the same order of summands in every run
        out = sum((np.frombuffer(x) for x in parts["part"].to_pylist()), np.float64(0))
        return pa.table({"rows": parts["rows"][:1], "part": pa.array([out.tobytes()], pa.binary())})

    # the tasks' matrices meet in runs of rows, so that the driver takes one sum and not all of them
    parts = texts.mapInArrow(run, "task long, rows long, part binary").groupBy("rows").applyInArrow(total, "rows long, part binary")
    got = parts.toArrow().sort_by("rows")
    return np.concatenate([np.zeros(0), *(np.frombuffer(x.as_buffer()) for x in got["part"])]).reshape(-1, matrix.shape[1])


def latent_space(docs: DataFrame, benchmark: DataFrame, idf: np.ndarray, passages: int = 0) -> np.ndarray:
    """Projection (DIMS x RANK) of TF vectors: IDF, right singular vectors, singular values to 1.

    ``passages``, about as many as docs have, sets the number of tasks.
    """
    texts = reduce(DataFrame.unionByName, [x.select(F.coalesce(x["text"], F.lit("")).alias("text")) for x in (docs, benchmark)])
    texts = texts.coalesce(min(max(passages // SHARE, TASKS[0]), TASKS[1]))     # no shuffle
    start = np.random.default_rng(17).normal(size=(DIMS, RANK + OVERSAMPLE))
    basis, _ = np.linalg.qr(_products(texts, start, idf, True))
    small = _products(texts, basis, idf, False)
    values, vectors = np.linalg.eigh(small)
    top = np.argsort(values)[::-1][:RANK]
    scale = np.sqrt(np.maximum(values[top], 1e-9))
    return (idf[:, None] * (basis @ vectors[:, top]) / np.maximum(scale, scale.max() * 1e-3)).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def lcs(masks: dict[int, int], n: int, text: list[int]) -> int:
    """Length of the longest common subsequence; masks hold the positions of each item word."""
    state = full = (1 << n) - 1
    for word in text:
        hit = state & masks.get(word, 0)
        state = ((state + hit) | (state - hit)) & full
    return n - state.bit_count()


def lcs_many(places: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``lcs`` of many texts (a row of ``places`` each): word by word, the row of ``bits`` with its positions in the item."""
    width = bits.shape[1]
    filled = np.clip(sizes[:, None] - 64 * np.arange(width), 0, 64)
    full = np.where(filled == 64, ~np.uint64(0), (np.uint64(1) << (filled % 64).astype(np.uint64)) - np.uint64(1))
    state = [full[:, w].copy() for w in range(width)]
    columns = [np.ascontiguousarray(bits[:, w]) for w in range(width)]
    for step in np.ascontiguousarray(places.T):
        carry = None
        for w, own in enumerate(state):
            hit = own & columns[w][step]
            total = own + hit
            over = total < own
            if carry is not None:
                total += carry
                over |= total < carry
            state[w] = total | (own ^ hit)
            carry = over.astype(np.uint64)
    left = sum(np.bitwise_count(own & full[:, w]).astype(np.int64) for w, own in enumerate(state))
    return sizes - left


class Queries:
    """A block of benchmark items: passages in the latent space, and words for verification."""

    def __init__(self, ids: list, texts: list[str | None], projection: np.ndarray, idf: np.ndarray):
        self.ids, self.words = ids, []
        vectors, owners = [[] for _ in range(_PER)], [[] for _ in range(_PER)]      # by the item's size
        for _, _, begins, hashes in words(pa.array(texts, pa.string())):
            for k, (sums, row, at) in enumerate(passage_sums(projection, buckets(hashes), begins)):
                n = np.diff(begins)[row]
                own = np.clip((n + STRIDE // 2) // STRIDE, 1, _PER) == k + 1
                own &= (at == 0) | (2 * (n - at) >= (k + 1) * STRIDE)       # no short rest of an item
                vectors[k].append(unit(sums[own]))
                owners[k].append(row[own] + len(self.words))
            self.words += [hashes[a:b].tolist() for a, b in zip(begins, begins[1:], strict=False)]
        none = [np.zeros((0, projection.shape[1]), np.float32)]
        self.vectors = [np.concatenate(none + v) for v in vectors]
        self.owners = [np.concatenate([np.zeros(0, np.int64), *o]) for o in owners]
        self.size = np.array([len(x) for x in self.words], np.int64)
        self.has = np.zeros((len(self.words), DIMS), bool)       # BLOCK * DIMS at most
        for i, own in enumerate(self.words):
            self.has[i, buckets(np.array(own, np.uint64))] = True
        self.answers = []
        for own in self.words:
            rarity = idf[buckets(np.array(own, np.uint64))] if own else []
            self.answers.append({own[i] for i in np.argsort(rarity, kind="stable")[::-1][:ANSWER]})
        # by the number of 64-bit masks that its positions take: an item's words, and where each stands in it
        self.width = -(-self.size // 64)
        self.index = {int(w): self._positions(np.flatnonzero(self.width == w), int(w)) for w in np.unique(self.width) if w}

    @staticmethod
    def _keys(items: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """An item and one of its words as one number."""
        return mixed(hashes + (items.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))

    def _positions(self, items: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the items' words, and a mask of positions for each; the last one is empty."""
        size = self.size[items]
        item = np.repeat(items, size)
        at = np.arange(len(item)) - np.repeat(np.cumsum(size) - size, size)
        keys, row = np.unique(self._keys(item, np.concatenate([np.array(self.words[i], np.uint64) for i in items])), return_inverse=True)
        bits = np.zeros((len(keys) + 1, width), np.uint64)
        np.bitwise_or.at(bits, (row, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
        return keys, bits

    def candidates(self, passages: list[Sums], own: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, items, and first words of the passages whose cosine with the item is high enough, in this order."""
        out = [np.zeros((3, 0), np.int64)]
        for (sums, row, at), vectors, owners in zip(passages, self.vectors, self.owners, strict=True):
            if len(owners):
                i, j = np.divmod(np.flatnonzero(unit(sums) @ vectors.T >= COSINE), len(owners))
                rows, items, places = row[i], owners[j], at[i]
                enough = self.enough(items, own, *self.around(items, begins[rows], begins[rows + 1], places))
                out.append(np.stack([rows[enough], items[enough], places[enough]]))
        rows, items, places = np.concatenate(out, axis=1)
        order = np.lexsort((places, items, rows))
        return rows[order], items[order], places[order]

    def around(self, items: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the surroundings begin and end that an item is verified on."""
        n = self.size[items]
        return np.maximum(begin, begin + at - STRIDE - np.maximum(0, n - WINDOW)), np.minimum(end, begin + at + np.maximum(n, WINDOW) + 2 * STRIDE)

    def enough(self, items: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether surroundings hold so many words of the item (by bucket) that a hit is possible."""
        out = np.ones(len(items), bool)
        width = hi - lo
        some = np.flatnonzero(width <= 8 * WINDOW)      # wider ones are left to shares()
        some = some[np.argsort(width[some], kind="stable")]
        held, padded = self.has.ravel(), np.append(own, np.zeros(8 * WINDOW, own.dtype)).astype(np.int32)
        for first in range(0, len(some), 512):      # arrays that stay in cache
            of = some[first : first + 512]
            step = np.arange(int(width[of[-1]]), dtype=np.int32)
            word = padded.take(lo[of, None].astype(np.int32) + step) + (items[of, None] * DIMS).astype(np.int32)
            in_item = held.take(word) & (step < width[of, None])
            out[of] = in_item.view(np.uint8).sum(axis=1, dtype=np.int32) >= LCS_ANSWER * self.size[items[of]]
        return out

    def shares(self, items: np.ndarray, text: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Share of the item's words that stand in sequence in its surroundings; 0 where these have too few of them."""
        out, size, length = np.zeros(len(items)), self.size[items], hi - lo
        for width, (keys, bits) in self.index.items():
            some = np.flatnonzero(self.width[items] == width)
            some = some[np.argsort(length[some], kind="stable")]
            while len(some):
                # as many as fill CELLS with the longest of them
                n = max(1, int(np.searchsorted(length[some] * np.arange(1, len(some) + 1), CELLS, side="right")))
                of, some = some[:n], some[n:]
                step = np.arange(int(length[of].max()))
                at = np.minimum(lo[of, None] + step, len(text) - 1)
                row, column = np.nonzero((step < length[of, None]) & self.has[items[of, None], own[at]])
                key = self._keys(items[of[row]], text[at[row, column]])
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                held = keys[place] == key
                places = np.full(at.shape, len(keys))
                places[row[held], column[held]] = place[held]
                enough = np.flatnonzero((places < len(keys)).sum(axis=1) >= LCS_ANSWER * size[of])     # else no subsequence is long enough
                out[of[enough]] = lcs_many(places[enough], bits, size[of[enough]]) / size[of[enough]]
        return out

    def found(self, passages: list[Sums], text: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, float, bool]]:
        """Row, item, best share of the item's words in sequence, and whether it makes a hit, for every candidate."""
        own = buckets(text)
        rows, items, places = self.candidates(passages, own, begins)
        if not len(rows):
            return
        chosen, last, done = [], None, -1
        for n, (row, item, at) in enumerate(zip(rows.tolist(), items.tolist(), places.tolist(), strict=True)):
            if (row, item) != last:
                last, done = (row, item), -1
            if at >= done:      # else inside the surroundings that are compared already
                chosen.append(n)
                done = at + 2 * STRIDE
        rows, items, places = rows[chosen], items[chosen], places[chosen]
        lo, hi = self.around(items, begins[rows], begins[rows + 1], places)
        shares = self.shares(items, text, own, lo, hi)
        hits = shares >= LCS
        for n in np.flatnonzero((shares >= LCS_ANSWER) & ~hits):
            hits[n] = self.answers[items[n]] <= set(text[lo[n] : hi[n]].tolist())
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (items[1:] != items[:-1])])
        best, hit = np.maximum.reduceat(shares, first), np.logical_or.reduceat(hits, first)
        yield from zip(rows[first].tolist(), items[first].tolist(), best.tolist(), hit.tolist(), strict=True)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: ``row`` (all its columns), doc_id, items (ids of the items found), score."""
    spark = docs.sparkSession
    idf, passages = passage_frequencies(docs)
    projection = latent_space(docs, benchmark, idf, passages)
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text"))
    out = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    found = []
    for n, block in enumerate(_blocks(items)):
        queries = spark.sparkContext.broadcast((Queries(block["item_id"].to_pylist(), block["text"].to_pylist(), projection, idf), projection))
        found.append(f"found_{n}")
        out = out.withColumn(found[-1], _search(queries)("text"))
    both = [F.col(f"{c}.items") for c in found] or [F.array().cast("array<long>")]
    scores = [F.col(f"{c}.score") for c in found] or [F.lit(0.0)]
    return out.select(
        "row", "doc_id", F.array_sort(F.array_distinct(F.concat(*both))).alias("items"), (F.greatest(*scores) if len(scores) > 1 else scores[0]).alias("score")
    )


def _blocks(items: DataFrame) -> Iterator[pa.Table]:
    """The benchmark in blocks of BLOCK items, one at a time."""
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-items.count() // BLOCK)))))
    for r in sorted(x["part"] for x in dealt.select("part").distinct().collect()):
        yield dealt.where(F.col("part") == r).drop("part").toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])


def _search(queries):
    def run(column: pa.Array) -> pa.Array:
        block, projection = queries.value
        items, scores = [[] for _ in range(len(column))], np.zeros(len(column))
        for first, _, begins, hashes in words(column):
            # a long text is projected in runs of passages, to bound memory
            for lo, own_begins, own in _runs(begins, hashes):
                for i, item, share, hit in block.found(passage_sums(projection, buckets(own), own_begins), own, own_begins):
                    i += first + lo
                    scores[i] = max(scores[i], share)
                    if hit:
                        items[i].append(block.ids[item])
        return pa.StructArray.from_arrays([pa.array(items, pa.list_(pa.int64())), pa.array(scores)], names=["items", "score"])

    return F.arrow_udf(run, "items array<long>, score double")


def _runs(begins: np.ndarray, hashes: np.ndarray, limit: int = 1 << 16) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The slice itself, or if it is one long text, overlapping parts of it."""
    if len(hashes) <= limit or len(begins) > 2:     # many rows are a slice of bounded bytes
        yield 0, begins, hashes
        return
    overlap = 4 * WINDOW * max(1, limit >> 10)
    for i in range(0, len(hashes), limit - overlap):
        part = hashes[i : i + limit]
        yield 0, np.array([0, len(part)]), part


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the benchmark items that it holds, and the best share of an item."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items", "score")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any benchmark item, with all their columns."""
    return contaminated(docs, benchmark).where(F.size("items") == 0).select("row.*")


ORACLES: dict[str, str] = {}
QUERIES = {"op4_benchmark_decontamination": op4_benchmark_decontamination}
