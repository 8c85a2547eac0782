"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns (email, ip, card, phone) give the base spans. The model is trained in numpy
from labelled spans, to find what the patterns miss: values in other forms (``FORMS``: "name
(at) host (dot) org", "10[.]0[.]0[.]7", a card in groups parted by dots, two cards side by
side, a phone number without a plus sign). Three samples, ``SAMPLE`` windows in all, each the
first in a seeded order, make up the training set: windows of the documents that hold a base
span (a fifth), windows that hold none (a fifth), and stretches of documents into which seeded values in other
forms, and look-alikes such as dates, versions and amounts, are planted. In labels a card is
any number of a card's length, as its check digit can't be seen in character classes.

The model reads overlapping windows of every text; Viterbi decoding gives tags, and each character takes the
tag of the window in whose middle it lies most, so that one span is never decided twice.
Model spans that no base span touches are added if the model is sure of them and they hold up
when written plainly: an email or ip matches its pattern then, a card passes the Luhn check, a
phone number has 9 to 15 digits.

Every kind holds digits, an at-sign or a bracketed "at". Windows are therefore laid around
those, wherever they occur in the whole text; text further away cannot hold a span.

Positions are code points, end exclusive. Matching is leftmost and without overlap per kind.

Defined results: a null or empty text has no spans. Repeated rows are rows of their own. A
null doc_id is allowed. Extra columns are ignored. Where no text holds ``STRETCH`` characters
and none a base span, there are base spans only. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP, REACH = 64, 32, 24
SAMPLE = 5000
#: Characters of a document into which values are planted for training.
STRETCH = 160
HIDDEN, EPOCHS, BATCH = 24, 9, 100
SURE = 0.65
#: Windows that are decoded together.
DECODE = 1024

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_BRACKETED_AT = r"[(\[{] ?at ?[)\]}]"
_TRIGGER = re.compile(rf"[@0-9]+|{_BRACKETED_AT}", re.I)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]     # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign outwards: linear, however long the runs of word characters are."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        # an at-sign ends every local part, so the next one starts behind it
        done = domain.end() if domain else at + 1
        if domain:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str, check: Callable[[str], bool] = luhn) -> list[Span]:
    """The patterns' spans by start, then kind. ``check`` decides on a card's digits."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(_octet(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and check(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


# --- windows -------------------------------------------------------------------------

_SIGNS = "\n .,@+-()_%:;/\"'=#[]{}"
CLASSES = len(_SIGNS) + 5
_CLASS = np.full(128, len(_SIGNS) + 4, np.int8)
for _i, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = _i
_CLASS[0x30:0x3A], _CLASS[0x61:0x7B], _CLASS[0x41:0x5B] = len(_SIGNS), len(_SIGNS) + 1, len(_SIGNS) + 2
_FOREIGN = len(_SIGNS) + 3


def classes(text: str) -> np.ndarray:
    """Character class of each code point of a stretch of text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], _FOREIGN).astype(np.int8)


def windows(text: str) -> list[int]:
    """Starts of overlapping windows that cover every digit and at-sign with REACH around it."""
    out, end = [], -1
    for m in _TRIGGER.finditer(text):
        at = max(0, m.start() - REACH) if m.start() - REACH > end else max(end, 0)
        while at < m.end() + REACH and at < len(text):
            start = max(0, at - STEP // 2) if not out or at > out[-1] + WINDOW else out[-1] + STEP
            out.append(start)
            at = start + WINDOW - STEP // 2
            end = at
    return out


def window_codes(text: str, starts: list[int]) -> np.ndarray:
    out = np.zeros((len(starts), WINDOW), np.int8)
    for i, s in enumerate(starts):
        part = classes(text[s : s + WINDOW])
        out[i, : len(part)] = part
    return out


# --- model ---------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)       # outside; begin and inside of each kind


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Net:
    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Net:
        # the first axis is the direction: forwards, backwards
        p = {"x": rng.normal(0, 0.3, (2, CLASSES, 4 * HIDDEN)), "h": rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN))}
        p["b"] = np.tile(np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]), (2, 1, 1))
        p["out"], p["bias"], p["move"] = rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS))
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def _run(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """Hidden states (batch, time, both directions' hidden), and what the way back needs."""
        n, t = codes.shape
        h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        states, tape = np.empty((n, t, 2 * HIDDEN), np.float32), []
        seen = self.p["x"] + self.p["b"]
        for i in range(t):
            z = np.matmul(h, self.p["h"])
            z[0] += seen[0][codes[:, i]]
            z[1] += seen[1][codes[:, t - 1 - i]]
            gates = _sigmoid(z[..., : 3 * HIDDEN])
            new = np.tanh(z[..., 3 * HIDDEN :])
            keep_h, keep_c = h, c
            c = gates[..., HIDDEN : 2 * HIDDEN] * c + gates[..., :HIDDEN] * new
            bent = np.tanh(c)
            h = gates[..., 2 * HIDDEN :] * bent
            states[:, i, :HIDDEN], states[:, t - 1 - i, HIDDEN:] = h
            tape.append((i, gates, new, keep_h, keep_c, bent))
        return states, tape

    def emissions(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        both, tape = self._run(codes)
        return both @ self.p["out"] + self.p["bias"], both, tape

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of the CRF likelihood, back through both directions."""
        n, t = codes.shape
        emit, both, tape = self.emissions(codes)
        forward, backward, total = marginal_logs(emit, self.p["move"])
        node = np.exp(forward + backward - total[:, None, None])
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        for i in range(t - 1):
            edge = forward[:, i, :, None] + self.p["move"] + (emit[:, i + 1] + backward[:, i + 1])[:, None, :]
            g["move"] += np.exp(edge - total[:, None, None]).sum(axis=0)
        np.add.at(g["move"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        rows, cols = np.arange(n)[:, None], np.arange(t)[None]
        gold = emit[rows, cols, tags].sum(axis=1) + self.p["move"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
        node[rows, cols, tags] -= 1
        g["out"] = both.reshape(-1, 2 * HIDDEN).T @ node.reshape(-1, TAGS)
        g["bias"] = node.sum(axis=(0, 1))
        back = node @ self.p["out"].T
        dh, dc = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        slopes, befores = np.empty((2, n, t, 4 * HIDDEN), np.float32), np.empty((2, n, t, HIDDEN), np.float32)
        for i, gates, new, h, c, bent in reversed(tape):
            dh = dh + np.stack([back[:, i, :HIDDEN], back[:, t - 1 - i, HIDDEN:]])
            ig, fg, og = gates[..., :HIDDEN], gates[..., HIDDEN : 2 * HIDDEN], gates[..., 2 * HIDDEN :]
            dc = dc + dh * og * (1 - bent**2)
            dz = np.concatenate([dc * new * ig * (1 - ig), dc * c * fg * (1 - fg), dh * bent * og * (1 - og), dc * ig * (1 - new**2)], axis=2)
            slopes[:, :, i], befores[:, :, i] = dz, h
            dh, dc = np.matmul(dz, self.p["h"].transpose(0, 2, 1)), dc * fg
        marks = np.eye(CLASSES, dtype=np.float32)
        for d, order in enumerate((codes, codes[:, ::-1])):
            flat = slopes[d].reshape(-1, 4 * HIDDEN)
            g["x"][d], g["h"][d], g["b"][d] = marks[order.ravel()].T @ flat, befores[d].reshape(-1, HIDDEN).T @ flat, flat.sum(axis=0)
        return float((total - gold).mean()), {k: v / n for k, v in g.items()}

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags, and their marginal probabilities in windows with a span."""
        emit, _, _ = self.emissions(codes)
        n, t, _ = emit.shape
        best, back = emit[:, 0], np.empty((n, t, TAGS), np.int8)
        for i in range(1, t):
            ways = best[:, :, None] + self.p["move"]
            back[:, i] = ways.argmax(axis=1)
            best = ways.max(axis=1) + emit[:, i]
        tags = np.empty((n, t), np.int8)
        tags[:, -1] = best.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            tags[:, i - 1] = back[np.arange(n), i, tags[:, i]]
        sure, some = np.ones((n, t), np.float32), np.flatnonzero(tags.any(axis=1))
        if len(some):
            forward, backward, total = marginal_logs(emit[some], self.p["move"])
            chance = np.exp(forward + backward - total[:, None, None])
            sure[some] = chance[np.arange(len(some))[:, None], np.arange(t)[None], tags[some]]
        return tags, sure


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def marginal_logs(emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums of a chain, and the log partition."""
    forward, backward = np.empty_like(emit), np.zeros_like(emit)
    forward[:, 0] = emit[:, 0]
    for i in range(1, emit.shape[1]):
        forward[:, i] = _logsum(forward[:, i - 1, :, None] + move, 1) + emit[:, i]
    for i in range(emit.shape[1] - 2, -1, -1):
        backward[:, i] = _logsum(move + (emit[:, i + 1] + backward[:, i + 1])[:, None, :], 2)
    return forward, backward, _logsum(forward[:, -1], 1)


def train(codes: np.ndarray, tags: np.ndarray, seed: int = 3) -> Net:
    """Adam over shuffled batches."""
    rng = np.random.default_rng(seed)
    net = Net.fresh(rng)
    m, v, step = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2)), None, 0
    m, v = m
    for epoch in range(EPOCHS):
        rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
        for part in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // BATCH)):
            _, g = net.gradients(codes[part], tags[part])
            norm = float(np.sqrt(sum((x**2).sum() for x in g.values())))
            step += 1
            for k, x in g.items():
                x = x * min(1.0, 5 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x**2
                net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def gold_tags(spans: list[Span], starts: list[int]) -> np.ndarray:
    out = np.zeros((len(starts), WINDOW), np.int8)
    for i, s in enumerate(starts):
        for a, k, b in spans:
            lo, hi = max(a - s, 0), min(b - s, WINDOW)
            if lo < hi:
                out[i, lo:hi] = 2 + 2 * k
                if a >= s:
                    out[i, lo] = 1 + 2 * k
    return out


def reconciled(text: str, starts: list[int], tags: np.ndarray, sure: np.ndarray) -> list[tuple[Span, float]]:
    """Spans of a whole text from its windows' tags, with the least certainty of their characters."""
    out: list[tuple[Span, float]] = []
    here: list = []

    def close() -> None:
        if here:
            (a, k, b), s = here.pop()
            out.append(((a, k, b), s))

    for i, s in enumerate(starts):
        # a window decides from the middle of its overlap with the one before to that with the next
        lo = (s + starts[i - 1] + WINDOW) // 2 if i and starts[i - 1] + WINDOW > s else s
        hi = (s + WINDOW + starts[i + 1]) // 2 if i + 1 < len(starts) and starts[i + 1] < s + WINDOW else s + WINDOW
        for at in range(lo, min(hi, len(text))):
            tag = int(tags[i, at - s])
            kind = (tag - 1) // 2
            follows = bool(here) and here[0][0][2] == at and here[0][0][1] == kind
            if tag and tag % 2 == 0 and follows:
                (a, k, _), p = here.pop()
                here.append(((a, k, at + 1), min(p, float(sure[i, at - s]))))
            else:
                close()
                if tag:
                    here.append(((at, kind, at + 1), float(sure[i, at - s])))
    close()
    return out


_PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WRITTEN = (
    (re.compile(rf"\s*(?:{_BRACKETED_AT}|@)\s*", re.I), "@"),
    (re.compile(r"\s*(?:[(\[{] ?(?:dot|\.) ?[)\]}]|\.)\s*", re.I), "."),
)
_CARD_SIGNS = frozenset("0123456789 -./_\u00a0\u2009\u202f")
_PHONE_SIGNS = frozenset("0123456789 -./()+\u00a0\u2009\u202f")


def plainly(value: str) -> str:
    """An address with its at-signs and dots as such."""
    for form, sign in _WRITTEN:
        value = form.sub(sign, value)
    return value


def plausible(span: Span, text: str) -> bool:
    a, kind, b = span
    value = text[a:b]
    digits = _digits(value)
    if kind == 0:
        return bool(_PLAIN_EMAIL.fullmatch(plainly(value)))
    if kind == 1:
        return bool(_IP.fullmatch(plainly(value))) and all(_octet(p) for p in plainly(value).split("."))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and _CARD_SIGNS.issuperset(value)
    return 9 <= len(digits) <= 15 and _PHONE_SIGNS.issuperset(value)


def added(text: str, base: list[Span], found: list[tuple[Span, float]]) -> list[Span]:
    """Model spans that no base span touches, certain enough and plausible."""
    out, j, reach = [], 0, 0
    for span, p in sorted(found):
        while j < len(base) and base[j][0] < span[2]:        # base spans that begin before this one ends
            reach, j = max(reach, base[j][2]), j + 1
        if p >= SURE and reach <= span[0] and plausible(span, text):
            out.append(span)
    return out


# --- planted values --------------------------------------------------------------------

def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def _name(rng: random.Random) -> str:
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))


_ATS = ("@", "@ ", " @ ", " @", "(at)", " (at) ", "[at]", " [at] ", " {at} ")
_DOTS = (".", ".", "[.]", " [.] ", "[dot]", " [dot] ", "(dot)", " (dot) ", " {dot} ")
#: Forms that the patterns miss, by kind: n a name, 9 a digit, o one to three digits. A bar parts two values.
FORMS = (
    tuple(f"{name}{at}n{dot}n{more}" for name in ("n", "n.n", "n_n", "n9") for at in _ATS for dot in _DOTS for more in ("", f"{dot}n") if (at, dot) != ("@", ".")),
    ("o[.]o[.]o[.]o", "o.o.o[.]o", "o[.]o.o.o", "o(.)o(.)o(.)o", "o . o . o . o", "o. o. o. o", "o [.] o [.] o [.] o", "o[dot]o[dot]o[dot]o"),
    ("9999.9999.9999.9999", "9999/9999/9999/9999", "9999_9999_9999_9999", "9999  9999  9999  9999", "9999 - 9999 - 9999 - 9999", "9999.999999.99999",
     "9999999999999999 | 9999999999999999", "9999999999999999 | 9999999999999999", "9999 9999 9999 9999 | 9999 9999 9999 9999", "9999-9999-9999-9999 | 9999-9999-9999-9999"),
    ("(999) 999-9999", "(999)999-9999", "999-999-9999", "999.999.9999", "999-9999-9999", "9 (999) 999-9999", "9-999-999-9999", "0099 99 9999 9999", "0099 999 9999999",
     "+ 9 999 999 9999", "+ 99 99 9999 9999", "+9/999/999-9999", "+99/99/9999/9999"),
)
#: What looks like them and is none.
DECOYS = (
    "9999-99-99", "99/99/9999", "99.99.9999", "9999-99-99 99:99", "9999-99-99T99:99:99", "99:99:99", "9.9.9", "9.99.9", "o.o.o", "o.o", "9,999,999.99", "99,999,999",
    "99.999.999,99", "9999999", "99999999999", "#99999", "@n", "@n9", "@n.n", "999-9-99-999999-9", "9999-9999", "99-99", "(99) n", "(9999)", "99 999", "9 999 999", "9-9",
    "99.9%", "n9", "n_9", "9999 9999", "99 99 99", "n (at) n", "n @ n", "9 + 9 = 99", "(o, o, o, o)", "[o, o, o]", "o o o o", "9999 n 9999", "99 x 99 x 99",
)


def filled(form: str, rng: random.Random) -> str:
    out = []
    for part in re.findall(r"dot|at|[no9]|[^no9]", form):
        out.append(_name(rng) if part == "n" else str(rng.randint(0, 255)) if part == "o" else _number(rng, 1) if part == "9" else part)
    return "".join(out)


def planted(stretch: str, rng: random.Random) -> tuple[str, list[Span]]:
    """The stretch with two things put between its words, and the spans of the values among them."""
    gaps = [m.start() for m in re.finditer(r" ", stretch)] or [len(stretch)]
    places = sorted(rng.choices(gaps, k=2))
    out, spans, before = "", [], 0
    for place in places:
        out += stretch[before:place] + " "
        before = place
        if rng.random() < 0.35:
            out += filled(rng.choice(DECOYS), rng)
        else:
            kind = rng.randrange(len(KINDS))
            for i, value in enumerate(rng.choice(FORMS[kind]).split("|")):
                value = filled(value.strip(), rng)
                out += " " * (i > 0) + value
                spans.append((len(out) - len(value), kind, len(out)))
        out += rng.choice(("", "", ",", ".", ";", ")"))
    out += stretch[before:]
    own = [(a, k, b) for a, k, b in base_spans(out, bool) if all(b <= x or a >= y for x, _, y in spans)]
    return out, sorted(spans + own)


# --- Spark ---------------------------------------------------------------------------

def _with_trigger(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def training_windows(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Classes and gold tags of SAMPLE windows: a fifth each without and with a base span, the others of planted stretches."""

    shares = (SAMPLE // 5, SAMPLE // 5, SAMPLE * 3 // 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn: tuple[list, list] = ([], [])
            whole = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if len(text) >= STRETCH:
                    whole.append((hashlib.md5(f"pii-2:{doc_id}:{len(text)}".encode()).hexdigest(), text))
                starts = windows(text)
                if not starts:
                    continue
                codes, tags = window_codes(text, starts), gold_tags(base_spans(text, bool), starts)
                for s, c, t in zip(starts, codes, tags, strict=True):
                    key = hashlib.md5(f"pii-1:{doc_id}:{s}".encode()).hexdigest()
                    drawn[int(t.any())].append((key, c.tobytes(), t.tobytes()))
            rows = [(k, *x) for k in (0, 1) for x in heapq.nsmallest(shares[k], drawn[k])]     # the first of all are among the first of each batch
            for key, text in heapq.nsmallest(shares[2], whole):
                rng = random.Random(key)
                begin = rng.randint(0, len(text) - STRETCH)
                text, spans = planted(text[begin : begin + STRETCH], rng)
                starts = windows(text)
                rows += [(2, f"{key}:{s}", c.tobytes(), t.tobytes()) for s, c, t in zip(starts, window_codes(text, starts), gold_tags(spans, starts), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                names=["spans", "draw", "codes", "tags"],
            )

    found = stored(_with_trigger(docs).mapInArrow(run, "spans int, draw string, codes binary, tags binary"), "pii-windows")
    first = [found.where(F.col("spans") == k).orderBy("draw", "codes").limit(n) for k, n in enumerate(shares)]
    picked = first[0].unionByName(first[1]).unionByName(first[2]).toArrow().sort_by([("draw", "ascending"), ("codes", "ascending")])
    shape = (len(picked), WINDOW)
    return tuple(np.frombuffer(b"".join(picked[c].to_pylist()), np.int8).reshape(shape) for c in ("codes", "tags"))


def fit(docs: DataFrame) -> Net | None:
    codes, tags = training_windows(docs)
    return train(codes, tags) if tags.any() else None


def find(docs: DataFrame, net: Net | None) -> DataFrame:
    """One row per row of docs: doc_id, counts and digest of the base spans, all spans, n_added."""
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    arrow = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list[Span]] = []
            wait: list[tuple[int, list[int]]] = []
            codes: list[np.ndarray] = []
            more: dict[int, list[Span]] = {}
            texts = batch.column("text")

            def flush() -> None:
                if not codes:
                    return
                tags, sure = net.decode(np.concatenate(codes))
                at = 0
                for i, starts in wait:
                    text, n = texts[i].as_py(), len(starts)
                    more[i] = added(text, rows[i], reconciled(text, starts, tags[at : at + n], sure[at : at + n]))
                    at += n
                wait.clear()
                codes.clear()

            size = 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                starts = windows(text)
                rows.append(base_spans(text) if starts else [])
                if starts and net is not None:
                    wait.append((i, starts))
                    codes.append(window_codes(text, starts))
                    size += len(starts)
                    if size >= DECODE:
                        flush()
                        size = 0
            flush()
            out = {"doc_id": batch.column("doc_id").to_pylist()}
            out |= {f"n_{name}": [sum(s[1] == k for s in spans) for spans in rows] for k, name in enumerate(KINDS)}
            out["base_sha256"] = [hashlib.sha256(joined(s).encode()).hexdigest() for s in rows]
            out["spans"] = [joined([*s, *more.get(i, [])]) for i, s in enumerate(rows)]
            out["n_added"] = [len(more.get(i, [])) for i in range(len(rows))]
            yield pa.RecordBatch.from_pydict(out, arrow)

    return _with_trigger(docs).mapInArrow(run, schema)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return find(docs, fit(docs))


ORACLES: dict[str, str] = {}
QUERIES = {"op10_personal_data": op10_personal_data}
