"""Substring dedup: a count-min prefilter, then exact grouping of what it lets through.

A window is 13 consecutive words of one text. A word goes if a window that covers it occurs in
a document with a smaller doc_id as well.

1. Each task sketches its windows: a window adds one to a counter in each of two rows. What a
   task sends is sparse: sorted counter numbers as gaps of a byte, by blocks of counters. The
   partitions' sketches merge block by block, so no task holds a whole sketch. A window's
   estimate is the smaller of its two counters; counters only ever add, so it is never too low.
2. A second pass over the texts passes on the windows whose estimate is two or more. Those
   are grouped by an 88-bit hash of their words (0.2 pairs collide among 10**13), and the smallest doc_id of each group is
   compared with each member's. What the sketch overestimates (collisions, repeats within one
   document) gives no match here; what it leaves out occurs once.
3. The places found are put in order by document, as runs of covered words, and the texts are
   joined with them. A Bloom filter of the documents that have runs (8 bits for each, 16 MB at
   most) keeps most other texts out of that shuffle; what it lets through just finds no runs.

The broadcast sketch has one bit a counter (is it two or more), sized by the bytes of text: two
rows of a bit for each four bytes, up to 2**28, so 64 MB at most (``MOST_BLOCKS`` raises that where
executors hold more). A corpus of more than a billion bytes fills it more densely: the prefilter
then passes on more windows that occur once and the exact pass grows; the result is the same. Windows that both rows count very often (a hundred-thousandth of the corpus' bytes
and 1,000 at least; 131,072 counters a row at most, by that bound) are spread over 64 parts of
their group. Each part keeps the smallest doc_id, and only the rows of its smallest meet again.

Defined results: a null or blank text has no words, and a text of fewer than 13 words has no
window. A null doc_id is neither smaller nor larger than another: its windows neither remove
nor go. Rows of one doc_id are one document when compared (a window in both of them isn't
removed by that), and each gives a row. Whole copies lose all words but those of the smallest
doc_id. Words that are longer than a slice are hashed whole. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, documents, mixed, powers, signed, slices, stored, texts

WORDS = 13
BLOCK_BITS = 20                 # counters of a block: 2**20
MOST_BLOCKS = 1 << 8            # of a row of the sketch
BYTES_PER_COUNTER = 4           # of text, in each of the two rows
FLUSH = 1 << 21                 # windows that a task gathers before it sends their counters
OFTEN, OFTEN_SHARE = 1_000, 17  # a counter is hot from OFTEN and bytes / 2**OFTEN_SHARE
PARTS = 64                      # parts of a hot window's group
PART_SHIFT = 57                 # where k1 takes in the part
ROWS = 2                        # of the sketch
BLOOM_BITS = 27                 # of the filter of documents: 2**27 bits at most

#: Words are runs of bytes other than space and 0x09 to 0x0D.
GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0xD6E8FEB86659FD93)
_BYTE = [mixed((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * k)) * _ODD) for k in range(2)]


def _word_hashes(data: np.ndarray, rows: np.ndarray, tables: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of the words in ``data`` and so many hashes of each; no word spans a row start in ``rows``."""
    word = ~GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data) + 1)
    out, total = [], np.zeros(len(data) + 1, np.uint64)
    for table in _BYTE[:tables]:
        np.cumsum(table[data] * up[: len(data)], out=total[1:])
        out.append(mixed((total[ends] - total[starts]) * down[starts]))
    return starts, out


def word_runs(column: pa.Array, tables: int) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """First row, last row (exclusive), where each of these rows' words begin (one more at the end), hashes.

    A text longer than a slice is hashed in pieces that end between two words.
    """
    data, offsets = texts(column)
    for first, last in slices(offsets):
        at, part = offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        if not len(part):
            continue
        if len(part) <= SLICE:
            starts, hashes = _word_hashes(part, at[:-1][at[:-1] < len(part)], tables)
            yield first, last, np.searchsorted(starts, at), hashes
            continue
        gaps, found, done = np.flatnonzero(GAP[part]), [], 0
        while done < len(part):
            end = min(done + SLICE, len(part))
            if end < len(part):
                k = int(np.searchsorted(gaps, end))
                inside = k > 0 and gaps[k - 1] >= done
                end = int(gaps[k - 1]) + 1 if inside else int(gaps[k]) + 1 if k < len(gaps) else len(part)
            found.append(_word_hashes(part[done:end], np.zeros(1, np.int64), tables)[1])
            done = end
        hashes = [np.concatenate(h) for h in zip(*found, strict=True)]
        yield first, last, np.array([0, len(hashes[0])]), hashes


def windows(hashes: np.ndarray, starts: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hashes of the k words from each of ``starts``: a difference of running sums, shifted back."""
    up, down = powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    return mixed((total[starts + k] - total[starts]) * down[starts])


def window_starts(begins: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row and number (among all words of the rows) of the first word of each window."""
    n = np.maximum(np.diff(begins) - k + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    before = np.cumsum(n) - n
    return row, np.arange(len(row)) - before[row] + begins[:-1][row]


def counters(window: np.ndarray, blocks: int) -> list[np.ndarray]:
    """A window's counter in each row of the sketch: 32 bits of its hash, scaled to the row's length."""
    length, half = np.uint64(blocks << BLOCK_BITS), np.uint64(32)
    return [((h * length) >> half).astype(np.uint32) for h in (window & np.uint64(0xFFFFFFFF), window >> half)]


def packed(places: np.ndarray) -> bytes:
    """Sorted numbers as gaps of a byte each; 255 says that the gap goes on."""
    gaps = np.diff(places, prepend=places.dtype.type(0)).astype(np.int64)
    out = np.full(len(gaps) + int((gaps // 255).sum()), 255, np.uint8)
    out[np.cumsum(1 + gaps // 255) - 1] = gaps % 255
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def _partition_sketch(blocks: int):
    """Windows of a task to (block, gaps): block r * blocks + b is block b of row r."""

    def flush(gathered: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for r, parts in enumerate(gathered):
            places = np.sort(np.concatenate(parts))
            cuts = np.searchsorted(places, np.arange(blocks + 1, dtype=np.uint64) << np.uint64(BLOCK_BITS))
            full = np.flatnonzero(np.diff(cuts))
            data = [packed(places[cuts[b] : cuts[b + 1]] - np.uint32(b << BLOCK_BITS)) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(r * blocks + full, pa.int32()), pa.array(data, pa.binary())], names=["block", "gaps"])
            parts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        n = 0
        for batch in batches:
            for _, _, begins, hashes in word_runs(batch.column(0), 1):
                window = windows(hashes[0], window_starts(begins)[1])
                for parts, places in zip(gathered, counters(window, blocks), strict=True):
                    parts.append(places)
                n += len(window)
                if n >= FLUSH:
                    yield from flush(gathered)
                    n = 0
        if n:
            yield from flush(gathered)

    return run


def _merged(often: int):
    """Rows of a block, one after the other, to its bits (two or more) and its hot counters."""
    size = 1 << BLOCK_BITS

    def result(block: int, counts: np.ndarray) -> pa.RecordBatch:
        bits, hot = np.packbits(counts >= 2, bitorder="little").tobytes(), np.flatnonzero(counts >= often).astype(np.uint32).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits], pa.binary()), pa.array([hot], pa.binary())], names=["block", "bits", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, waiting, n = -1, np.zeros(size, np.int64), [], 0

        def add() -> None:
            nonlocal n
            if waiting:
                counts[:] += np.bincount(np.concatenate(waiting), minlength=size)
                waiting.clear()
                n = 0

        for batch in batches:
            for block, gaps in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if block != now:
                    add()
                    if now >= 0:
                        yield result(now, counts)
                    now, counts[:] = block, 0
                waiting.append(unpacked(gaps.as_buffer()))
                n += len(waiting[-1])
                if n >= size:
                    add()
        add()
        if now >= 0:
            yield result(now, counts)

    return run


class Sketch:
    """The merged sketch as tasks read it: which counters are two or more, and the hot ones."""

    def __init__(self, blocks: int, merged: list):
        width = 1 << (BLOCK_BITS - 3)
        self.blocks = blocks
        self.twice = np.zeros((ROWS, blocks * width), np.uint8)
        hot: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        for block, twice, often in merged:
            r, b = divmod(block, blocks)
            self.twice[r, b * width : (b + 1) * width] = np.frombuffer(twice, np.uint8)
            hot[r].append(np.frombuffer(often, np.uint32) + np.uint32(b << BLOCK_BITS))
        self.hot = [np.sort(np.concatenate(h)) if h else np.zeros(0, np.uint32) for h in hot]

    def repeated(self, window: np.ndarray) -> np.ndarray:
        """Windows whose estimate is two or more."""
        left = np.arange(len(window))
        for r, places in enumerate(counters(window, self.blocks)):
            here = places[left]
            left = left[(self.twice[r][here >> np.uint32(3)] >> (here & np.uint32(7)).astype(np.uint8)) & np.uint8(1) > 0]
        return left

    def often(self, window: np.ndarray) -> np.ndarray:
        """TRUE for windows whose counters are all hot."""
        out = np.ones(len(window), bool)
        for hot, places in zip(self.hot, counters(window, self.blocks), strict=True):
            if not len(hot):
                return np.zeros(len(window), bool)
            at = np.minimum(np.searchsorted(hot, places), len(hot) - 1)
            out &= hot[at] == places
        return out


def sketch_of(docs: DataFrame) -> Sketch:
    """The sketch of all windows. ``docs``: text without nulls. Its bits come to the driver: 64 MB at most."""
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = min(1 + (n_bytes // BYTES_PER_COUNTER >> BLOCK_BITS), MOST_BLOCKS)
    often = max(OFTEN, n_bytes >> OFTEN_SHARE)
    parts = docs.select("text").mapInArrow(_partition_sketch(blocks), "block int, gaps binary")
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merged(often), "block int, bits binary, hot binary")
    return Sketch(blocks, [tuple(r) for r in merged.collect()])


#: A candidate: k1, then ``place`` with 24 more bits of hash, the window's first word (32 bits) and the part
#: of a hot window's group, from 1 (else 0). Few bytes that differ from row to row keep the shuffle small.
CANDIDATE = "k1 long, place long, doc long"
HASH_BITS, AT_BITS = 24, 32


def candidates(docs: DataFrame, sketch: Broadcast) -> DataFrame:
    """The windows of ``docs`` that the sketch takes for repeated; with a tag where ``docs`` has one."""
    tagged = "tag" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Sketch = sketch.value
        for batch in batches:
            text, *keys = batch.columns
            keys = [np.asarray(k) for k in keys]
            for first, _, begins, hashes in word_runs(text, 2):
                row, starts = window_starts(begins)
                window = windows(hashes[0], starts)
                left = seen.repeated(window)
                if not len(left):
                    continue
                row, starts, window = row[left], starts[left], window[left]
                at = (starts - begins[row]).astype(np.uint64)
                spread = mixed((keys[0][first + row].astype(np.uint64) + at) * _ODD) % np.uint64(PARTS) + np.uint64(1)
                part = np.where(seen.often(window), spread, np.uint64(0))
                rest = windows(hashes[1], starts) >> np.uint64(64 - HASH_BITS)
                place = rest | at << np.uint64(HASH_BITS) | part << np.uint64(HASH_BITS + AT_BITS)
                columns = [signed(window ^ part << np.uint64(PART_SHIFT)), signed(place), *[k[first + row] for k in keys]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k1", "place", "doc", "tag"][: len(columns)])

    return docs.select("text", "doc", *["tag"][:tagged]).mapInArrow(run, CANDIDATE + ", tag long" * tagged)


def later(found: DataFrame, hot: bool) -> DataFrame:
    """Candidates whose window also starts in a document with a smaller id: doc, tag if there is one, at.

    One shuffle by k1, in which the part of a hot window is mixed; with ``hot`` windows, the rows
    of their parts' smallest documents meet again under the whole hash.
    """
    rest = F.col("place").bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    part = F.shiftrightunsigned("place", HASH_BITS + AT_BITS)
    at = F.shiftright("place", HASH_BITS).bitwiseAND(F.lit((1 << AT_BITS) - 1)).cast("int")
    removed = F.col("least") < F.col("doc")

    def compared(df: DataFrame, by: Column) -> DataFrame:
        return df.withColumn("least", F.min("doc").over(Window.partitionBy(by, rest)))

    once = compared(found.repartition("k1"), F.col("k1"))
    shown = ["doc", *["tag"][: "tag" in found.columns], at.alias("at")]
    out = once.filter(removed).select(*shown)
    if hot:
        whole = F.col("k1").bitwiseXOR(F.shiftleft(part, PART_SHIFT))
        again = compared(once.filter((part > 0) & ~removed).drop("least"), whole)
        out = out.unionByName(again.filter(removed).select(*shown))
    return out


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their keys and ``at`` (last) to one row per key with its runs of removed words."""

    def result(keys: tuple[int, ...], names: list[str], places: list[np.ndarray]) -> pa.RecordBatch:
        at = np.unique(np.concatenate(places)).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=at[0] - WORDS - 1) > WORDS)      # windows that touch are one run
        runs = np.column_stack([at[new], np.append(at[new[1:] - 1], at[-1]) + WORDS]).ravel()
        return pa.RecordBatch.from_arrays([*[pa.array([k]) for k in keys], pa.array([runs.astype(np.int32)], pa.list_(pa.int32()))], names=[*names, "runs"])

    now, names, places = None, [], []
    for batch in batches:
        *keys, at = (np.asarray(c) for c in batch.columns)
        names = batch.schema.names[:-1]
        edges = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
        for a, b in zip([0, *edges], [*edges, len(at)], strict=True):
            if a == b:
                continue
            if (key := tuple(int(k[a]) for k in keys)) != now:
                if places:
                    yield result(now, names, places)
                now, places = key, []
            places.append(at[a:b])
    if places:
        yield result(now, names, places)


def _results(ids: pa.Array, text: pa.Array, runs: list) -> pa.RecordBatch:
    counted, removed, kept = [], [], []
    data, ends = texts(text)
    whole = data.tobytes()
    for a, b, cut in zip(ends[:-1].tolist(), ends[1:].tolist(), runs, strict=True):
        words = whole[a:b].split()
        left, done = [], 0
        for start, end in zip(cut[::2], cut[1::2], strict=True) if cut else ():
            left += words[done:start]
            done = end
        left += words[done:]
        counted.append(len(words))
        removed.append(len(words) - len(left))
        kept.append(b" ".join(left))
    columns = [ids, pa.array(counted, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _results(batch.column(0), batch.column(1), batch.column(2).to_pylist())


def _words_of_filter(hashed: Column, bits: int) -> list[Column]:
    """The two places of a hash in a Bloom filter of 2**bits bits."""
    mask = F.lit((1 << bits) - 1)
    return [hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask)]


def bloom_of(keys: DataFrame) -> tuple[int, np.ndarray]:
    """log2 of the bits, and the bits as 64-bit words, of a filter over all of ``keys``."""
    bits = min(max(10, (8 * keys.count()).bit_length()), BLOOM_BITS)
    places = keys.select(F.explode(F.array(*_words_of_filter(F.xxhash64(*keys.columns), bits))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("b"))
    found = words.toArrow()         # 2**BLOOM_BITS / 64 rows at most
    out = np.zeros(1 << (bits - 6), np.int64)
    out[np.asarray(found.column("w"))] = np.asarray(found.column("b"))
    return bits, out


def _parted(bloom: Broadcast, within: bool):
    """Rows (two places in the filter, any columns, text) that it may hold, or the results of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bloom.value
        for batch in batches:
            places = [np.asarray(c) for c in batch.columns[:2]]
            held = [(words[p >> 6] >> (p & 63)) & 1 for p in places]
            rows = batch.select(batch.schema.names[2:]).filter(pa.array(((held[0] & held[1]) > 0) == within))
            if within:
                yield rows
            else:
                yield _results(rows.column("doc"), rows.column("text"), [None] * len(rows))

    return run


def removed_spans(docs: DataFrame) -> DataFrame:
    """doc, tag and runs [start, end, start, end, ...] of the words to remove; documents without any are left out.

    ``docs``: text without nulls, doc (long, may be null) and, where texts share a doc, a tag (long).
    """
    known = docs.filter(F.col("doc").isNotNull())
    keys = [c for c in ("doc", "tag") if c in docs.columns]
    sketch = sketch_of(known)
    sent, hot = docs.sparkSession.sparkContext.broadcast(sketch), all(len(h) for h in sketch.hot)
    del sketch
    ordered = later(candidates(known, sent), hot).repartition(*keys).sortWithinPartitions(*keys, "at")
    runs = stored(ordered.mapInArrow(_covered, ", ".join(f"{k} long" for k in keys) + ", runs array<int>"), "runs")
    sent.unpersist()
    return runs


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_text, the kept words joined by one space."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    # rows that share a doc_id are told apart by their text
    shared = rows.groupBy("doc").count().filter(F.col("doc").isNotNull() & (F.col("count") > 1)).limit(1).count() > 0
    keys = ["doc", "tag"] if shared else ["doc"]
    if shared:
        rows = rows.withColumn("tag", F.xxhash64("text"))
    runs = removed_spans(rows)
    bits, words = bloom_of(runs.select(*keys))
    bloom = docs.sparkSession.sparkContext.broadcast(words)
    places = [p.alias(f"place_{i}") for i, p in enumerate(_words_of_filter(F.xxhash64(*keys), bits))]
    asked = rows.select(*places, *keys, "text")
    result = "doc_id long, n_words long, n_removed long, kept_text string"
    marked = asked.mapInArrow(_parted(bloom, True), ", ".join(f"{k} long" for k in keys) + ", text string")
    found = marked.join(runs, keys, "left").select("doc", "text", "runs").mapInArrow(_kept, result)
    return found.unionByName(asked.mapInArrow(_parted(bloom, False), result))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 13 words."""
    kept = deduplicated(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES = {
    "op13_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        p AS (SELECT rid, doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
        g AS (
            SELECT rid, doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
        k AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS words FROM g),
        f AS (SELECT words, min(doc_id) AS least FROM k GROUP BY words),
        r AS (SELECT k.rid, k.i FROM k JOIN f USING (words) WHERE f.least < k.doc_id),
        c AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS i FROM r),
        q AS (
            SELECT p.rid, count(*) AS n_removed FROM p JOIN c USING (rid, i) GROUP BY p.rid),
        s AS (
            SELECT p.rid, string_agg(p.word, ' ' ORDER BY p.i) AS kept FROM p ANTI JOIN c USING (rid, i) GROUP BY p.rid)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(q.n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(s.kept, '')) AS kept_sha256
        FROM d LEFT JOIN q USING (rid) LEFT JOIN s USING (rid)
    """
}
QUERIES = {"op13_substring_dedup": op13_substring_dedup}
