"""Repeated byte strings, decided by suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Every window of LENGTH bytes picks an anchor: of its runs of ``GRAM`` bytes the one with the
   least hash. Equal windows pick equal anchors, so windows need only be compared within the
   class of an anchor's bytes. Windows that share an anchor form a range.
2. Ranges whose class has one member are dropped: nothing repeats. Ranges whose bytes are all
   equal to another's are repeated as a whole. Only ranges that differ from their class
   partners go on; equal ones go on as one.
3. These are cut into parts of ``PART`` windows, at the same distances from the anchor
   everywhere, and steps 1 and 2 are applied to the parts: all windows of a part share
   LENGTH + 1 - PART bytes, which are its class.
4. Parts that still differ are decided by suffix arrays. The shared bytes become a single
   symbol, so that a part is at most 2 * PART symbols long, and a repeated window is a
   repeated string of PART symbols. Many parts make up one text of bounded length.

The suffix array is built in linear time by grouping. Phase 1 groups suffixes by their longest
Lyndon prefix: groups are processed in descending order, each suffix finds the previous suffix
of a lower group through previous-smaller pointers, and the group's prefix is appended to that
one's. Phase 2 emits each group's order from the order of the next smaller suffixes; nothing
is renamed and there is no recursion.

A class with more than ``CROWD`` different parts (a passage that very many texts begin or end
in different ways) isn't gathered in one task: its windows are counted by their fingerprints
instead, which gives the same result.

Classes are compared by two 64-bit hashes of their bytes.

Defined results: a null text is empty. Texts shorter than LENGTH lose nothing. Repeated rows
are texts of their own, so all their windows repeat. Extra columns are ignored. An empty table
gives an empty result. Row numbers must be the same at each reading: give a stored table or a
plain file scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE, documents, mixed, powers, signed, slices, stored, texts

LENGTH, GRAM, PART = 400, 128, 40
CROWD = 8192
#: Symbols in one suffix array.
SYMBOLS = 1 << 16
_SPAN = LENGTH - GRAM + 1       # starts of runs in a window
_PLACE = np.uint64((1 << 20) - 1)
_VALUES = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(c)) for c in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[which][data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def _hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from a to b, the same wherever they lie."""
    return mixed((sums[b] - sums[a]) * powers(len(sums))[1][a])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` neighbours."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def ranges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of windows with a common anchor in texts that lie end to end in ``data``:
    text number, anchor, first and last window (within the text), class and content hash."""
    none = (np.zeros(0, np.int64),) * 6
    if len(data) < LENGTH:
        return none
    sums = _sums(data)
    starts = np.arange(len(data) - GRAM + 1)
    grams = _hash(sums, starts, starts + GRAM)
    anchors = (_sliding_least((grams & ~_PLACE) | starts.astype(np.uint64), _SPAN) & _PLACE).astype(np.int64)
    # windows that end within their own text
    delta = np.zeros(len(data) + 2, np.int64)
    lengths = np.diff(at)
    np.add.at(delta, at[:-1], (lengths >= LENGTH).astype(np.int64))
    np.add.at(delta, np.maximum(at[1:] - LENGTH + 1, at[:-1]), -(lengths >= LENGTH).astype(np.int64))
    window = np.flatnonzero(np.cumsum(delta)[: len(anchors)])
    if not len(window):
        return none
    anchor = anchors[window]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(window)] - 1
    lo, hi, a = window[first], window[last], anchor[first]
    content = mixed(_hash(sums, lo, hi + LENGTH) + (a - lo).astype(np.uint64))
    row = np.searchsorted(at, lo, side="right") - 1
    return row, a - at[row], lo - at[row], hi - at[row], signed(grams[a]), signed(content)


def all_ranges(docs: DataFrame) -> DataFrame:
    names = ["rid", "a", "lo", "hi", "class", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids = batch.column("rid").to_numpy()
            data, offsets = texts(batch.column("text"))
            for first, last in slices(offsets):
                base, end = offsets[first], offsets[last]
                # a long text in pieces that overlap, so that each window lies in one
                for lo in range(0, max(1, end - base), SLICE) if last == first + 1 else (0,):
                    hi = min(end - base, lo + SLICE + LENGTH - 1) if last == first + 1 else end - base
                    at = np.array([0, hi - lo]) if last == first + 1 else offsets[first : last + 1] - base
                    row, a, p, q, c, d = ranges(data[base + lo : base + hi], at)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rids[first + row], a + lo, p + lo, q + lo, c, d)], names=names)

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def settle(rows: DataFrame, key: list[str], place: list[str], purpose: str) -> tuple[DataFrame, DataFrame]:
    """Repeated rows, and one row of each content in classes of several contents.

    A row counts ``weight`` times. Rows of weight 2 and more are known to repeat already and
    matter as partners only.
    """
    contents = stored(
        rows.groupBy(*key, "content").agg(F.sum("weight").alias("n"), F.min(F.struct(*place)).alias("first")), f"{purpose}-contents"
    )
    several = contents.groupBy(*key).agg(F.count("*").alias("contents")).where("contents > 1").select(*key)
    again = stored(contents.where("n > 1").select(*key, "content"), f"{purpose}-again")
    repeated = rows.where("weight = 1").join(again, [*key, "content"], "left_semi")
    still = contents.join(stored(several, f"{purpose}-several"), key, "left_semi").select(*key, "first.*", F.least("n", F.lit(2)).alias("weight"))
    return repeated, still


def part_rows(docs: DataFrame, still: DataFrame) -> DataFrame:
    """Ranges cut into parts, with the bytes to the left and right of the shared ones."""
    schema = pa.schema([*((n, pa.int64()) for n in ("rid", "lo", "hi", "key1", "key2", "content")), ("left", pa.binary()), ("right", pa.binary()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                found = batch.column("ranges")[i].values
                a, lo, hi, weight = (found.field(n).to_numpy() for n in ("a", "lo", "hi", "weight"))
                number = (a - lo) // PART - (a - hi) // PART + 1
                of = np.repeat(np.arange(len(a)), number)
                step = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + ((a - hi) // PART)[of]
                top = a[of] - step * PART                      # last window start of a whole part
                p, q = np.maximum(lo[of], top - PART + 1), np.minimum(hi[of], top)
                after = top - PART + 1 + LENGTH                # end of the shared bytes
                for s in range(0, len(of), 4096):
                    cut = slice(s, s + 4096)
                    sums = [_sums(own, k) for k in (0, 1)] if not s else sums
                    keys = [signed(_hash(x, top[cut], after[cut])) for x in sums]
                    content = signed(mixed(_hash(sums[0], p[cut], q[cut] + LENGTH) + (top[cut] - p[cut]).astype(np.uint64)))
                    raw = own.tobytes() if not s else raw
                    left = [raw[x:y] for x, y in zip(p[cut], top[cut], strict=True)]
                    right = [raw[x : y + LENGTH] for x, y in zip(after[cut], q[cut], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x, pa.int64()) for x in (np.full(len(left), batch.column("rid")[i].as_py()), p[cut], q[cut], *keys, content)), pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(weight[of[cut]], pa.int64())],
                        schema=schema,
                    )

    by_text = still.groupBy("rid").agg(F.collect_list(F.struct("a", "lo", "hi", "weight")).alias("ranges"))      # of one text
    joined = docs.join(stored(by_text, "open-ranges"), "rid").select("rid", "text", "ranges")
    return joined.mapInArrow(run, "rid long, lo long, hi long, key1 long, key2 long, content long, left binary, right binary, weight long")


# --- suffix arrays -------------------------------------------------------------------


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Phase 1. For each suffix its group and the length of its longest Lyndon prefix; and the
    groups in descending order of their prefixes."""
    n = len(text)
    members: list[list[int]] = []
    symbols = {c: g for g, c in enumerate(sorted(set(text)))}
    members = [[] for _ in symbols]
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    group = [symbols[c] for c in text]
    for i, g in enumerate(group):
        members[g].append(i)
    length, previous, done = [1] * n, [-1] * n, bytearray(n)
    order: list[int] = []
    now = len(members) - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        members[now] = own
        if own:
            own.sort()
            order.append(now)
            size = length[own[0]]
            times: dict[int, int] = {}
            for i in own:
                j = i - 1
                while j >= 0 and done[j]:
                    j = previous[j]
                previous[i] = j
                done[i] = 1
                if j >= 0:
                    times[j] = times.get(j, 0) + 1
            # a suffix that this prefix follows k times moves up within its group: the more, the higher
            for k in sorted(set(times.values()), reverse=True):
                moved: dict[int, int] = {}
                for j, m in times.items():
                    if m == k:
                        old = group[j]
                        to = moved.get(old)
                        if to is None:
                            to = moved[old] = len(members)
                            members.append([])
                            over = above[old]
                            below.append(old)
                            above.append(over)
                            above[old] = to
                            if over >= 0:
                                below[over] = to
                        members[to].append(j)
                        group[j] = to
                        length[j] += k * size
        now = below[now]
    return group, length, order


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in lexicographic order."""
    n = len(text)
    if not n:
        return []
    group, length, order = lyndon_groups(text)
    sizes = np.bincount(np.array(group), minlength=max(order) + 1)
    front = [0] * len(sizes)
    filled = 0
    for g in reversed(order):
        front[g] = filled
        filled += int(sizes[g])
    # phase 2: within a group, suffixes stand in the order of what follows their prefix
    smaller = np.arange(n) + np.array(length)
    by = np.argsort(smaller, kind="stable")
    bounds = np.searchsorted(smaller[by], np.arange(n + 2)).tolist()
    waiting, out = by.tolist(), [0] * n
    for i in waiting[bounds[n] : bounds[n + 1]]:
        out[front[group[i]]] = i
        front[group[i]] += 1
    for r in range(n):
        s = out[r]
        for i in waiting[bounds[s] : bounds[s + 1]]:
            g = group[i]
            out[front[g]] = i
            front[g] += 1
    return out


def repeated_windows(keys: list[int], lefts: list[bytes], rights: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    """For each part, which of its ``counts`` windows also start in another part of its class."""
    pieces, starts, at = [], [], 0
    for key, left, right in zip(keys, lefts, rights, strict=True):
        starts.append(at)
        pieces += [np.frombuffer(left, np.uint8).astype(np.int64) + 1, np.array([257 + key]), np.frombuffer(right, np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64)]
        at += len(left) + len(right) + 2
    text = np.concatenate(pieces)
    part = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts) + np.array(starts)[part]
    number = np.full(len(text), -1, np.int64)
    number[window] = np.arange(len(window))
    ranked = number[np.array(suffix_array(text.tolist()))]
    ranked = ranked[ranked >= 0]                    # windows in suffix order: equal ones are neighbours
    place = window[ranked]
    same = np.ones(len(place) - 1, bool)
    for k in range(PART):
        same &= text[place[1:] + k] == text[place[:-1] + k]
    again = np.zeros(len(window), bool)
    again[ranked[1:][same]] = True
    again[ranked[:-1][same]] = True
    return np.split(again, np.cumsum(counts)[:-1])


_RUNS = pa.schema([("rid", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def sorted_parts(parts: DataFrame) -> DataFrame:
    """Runs (rid, lo, hi) of repeated windows, from parts whose classes lie together in order."""

    def decide(rows: list[dict]) -> pa.RecordBatch:
        numbers: dict[tuple, int] = {}
        keys = [numbers.setdefault((r["key1"], r["key2"]), len(numbers)) for r in rows]
        marks = repeated_windows(keys, [r["left"] for r in rows], [r["right"] for r in rows], np.array([r["hi"] - r["lo"] + 1 for r in rows]))
        out: list[tuple[int, int, int]] = []
        for r, mark in zip(rows, marks, strict=True):
            if r["weight"] == 1 and mark.any():
                edges = np.flatnonzero(np.diff(np.r_[False, mark, False]))
                out += [(r["rid"], r["lo"] + int(x), r["lo"] + int(y) - 1) for x, y in zip(edges[::2], edges[1::2], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], schema=_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["key1"], r["key2"])
                if size > SYMBOLS and key != last:
                    yield decide(waiting)
                    waiting, size = [], 0
                waiting.append(r)
                size += len(r["left"]) + len(r["right"]) + 2
                last = key
        if waiting:
            yield decide(waiting)

    return parts.repartition("key1", "key2").sortWithinPartitions("key1", "key2").mapInArrow(run, "rid long, lo long, hi long")


def counted_windows(parts: DataFrame) -> DataFrame:
    """The same runs from counting each window's own bytes: no class meets in one task."""
    offset = F.explode(F.sequence(F.lit(0), (F.col("hi") - F.col("lo")).cast("int")))
    windows = parts.withColumn("w", offset).select(
        "rid", (F.col("lo") + F.col("w")).alias("p"), "weight", "key1", "key2",
        F.expr("substring(left, w + 1)").alias("l"),
        F.expr(f"substring(right, 1, {PART - 1} - (length(left) - w))").alias("r"),
    )
    key = ["key1", "key2", "l", "r"]
    again = stored(windows.groupBy(*key).agg(F.sum("weight").alias("n")).where("n > 1").select(*key), "crowd-again")
    return windows.where("weight = 1").join(again, key, "left_semi").select("rid", F.col("p").alias("lo"), F.col("p").alias("hi"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Runs (rid, lo, hi) of starts of windows that occur more than once, for docs (rid, text)."""
    rows = stored(all_ranges(docs), "ranges").withColumn("weight", F.lit(1).cast("long"))
    whole, still = settle(rows, ["class"], ["rid", "a", "lo", "hi"], "ranges")
    parts = stored(part_rows(docs, stored(still, "open")), "parts")
    key = ["key1", "key2"]
    places = ["rid", "lo", "hi", "left", "right"]
    equal, differ = settle(parts, key, places, "parts")
    differ = stored(differ, "differ")
    crowds = stored(differ.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select(*key), "crowds")
    runs = [
        whole.select("rid", "lo", "hi"),
        equal.select("rid", "lo", "hi"),
        sorted_parts(differ.join(crowds, key, "left_anti").select(*key, *places, "weight")),
    ]
    if not crowds.isEmpty():
        runs.append(counted_windows(differ.join(crowds, key, "left_semi")))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return stored(out, "runs")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans."""
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    runs = repeated_runs(base.select("rid", "text"))
    by_text = runs.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))        # of one text
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column("text"))
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                spans = _joined(batch.column("runs")[i])
                digest, done = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(own[done:a])
                    done = b
                digest.update(own[done:])
                row = (len(own), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"start": a, "end": b} for a, b in spans])
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | out, schema)

    joined = base.join(stored(by_text, "runs-by-text"), "rid", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>")


def _joined(runs) -> list[tuple[int, int]]:
    """Byte spans covered by the runs' windows, joined where they touch."""
    if not runs.is_valid:
        return []
    lo, hi = (runs.values.field(n).to_numpy() for n in ("lo", "hi"))
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(hi[order] + LENGTH)
    new = np.r_[True, lo[1:] > end[:-1]]
    first = np.flatnonzero(new)
    return list(zip(lo[first].tolist(), end[np.r_[first[1:] - 1, len(lo) - 1]].tolist(), strict=True))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("spans")


ORACLES: dict[str, str] = {}
QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
