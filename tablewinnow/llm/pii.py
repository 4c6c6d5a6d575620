"""Personal data: patterns, and a character tagger that finds what they miss.

The tagger is a bidirectional LSTM over classes of characters whose outputs a linear-chain
CRF joins to tags (outside, or the start or inside of a kind). It is trained in numpy on
windows around the spans of the patterns in a bounded sample, and on windows in
which such spans follow one another directly, where the patterns fail.

All kinds contain a digit or an @, so only the windows that have one are decoded; all others
are outside by definition. Windows overlap by half; a character's tag is that of the window
it is more central in, and spans are read from the joined tags, so that they may cross
windows. What is tagged counts if it passes the same test as a pattern's match.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import drawn, read

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns of the task.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, nor could it end there.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_PLAIN = re.compile(r"\+?[0-9(][\x20().0-9-]*[0-9]")

WINDOW = 64
STRIDE = 32
HIDDEN = 20
TRAINING_PARTS = 800  # texts learned from with each kind, and with none, at most
TRAINING_WINDOWS = 2400
EPOCHS = 8
BATCH = 48
FEWEST_SPANS = 40  # with fewer labelled spans nothing is learned
DECODED = 2048  # windows at a time

TAGS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]

Span = tuple[int, int, str]


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def passes(kind: str, text: str) -> bool:
    """The test a match of a kind's pattern has to pass."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 13 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, in time linear in the text: from each @ to the left as
    far as the address may reach, and to the right by pattern."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str, failed: bool = False) -> list[Span]:
    """Spans of the patterns, by kind as listed and start; matches that fail their test are
    left out, or with ``failed`` the only ones returned, as kind ''."""
    if not _ANCHOR.search(text):
        return []
    found = [] if failed else [(a, b, "email") for a, b in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        for m in pattern.finditer(text):
            if passes(kind, m[0]) != failed:
                found.append((m.start(), m.end(), "" if failed else kind))
    return found


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0], s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# Classes of characters: 0 pads, letters and digits are one class each, punctuation that
# matters has its own.
_OWN = "@._%+-() ,:/\n"
CLASSES = 6 + len(_OWN)
_TABLE = np.full(128, 1)
_TABLE[ord("0") : ord("9") + 1] = 2
_TABLE[ord("a") : ord("z") + 1] = 3
_TABLE[ord("A") : ord("Z") + 1] = 4
for _i, _c in enumerate(_OWN):
    _TABLE[ord(_c)] = 6 + _i


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 5).astype(np.int8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


@dataclass
class Tagger:
    """Parameters by name. The first axis of those of the LSTM is the direction."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, hidden: int = HIDDEN) -> Tagger:
        rng = np.random.default_rng(5)
        tags = len(TAGS)
        p = {
            "x": rng.normal(0, 0.3, (2, CLASSES, 4 * hidden)),
            "h": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)),
            "out": rng.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, tags)),
            "bias": np.zeros(tags),
            "move": np.zeros((tags, tags)),
        }
        p["x"][:, :, hidden : 2 * hidden] += 1.0  # remembers at first
        # An inside tag follows its own kind only.
        for j, tag in enumerate(TAGS):
            if tag[0] == "I":
                for i, before in enumerate(TAGS):
                    if before[2:] != tag[2:] or before == "O":
                        p["move"][i, j] = -8.0
        return cls({k: v.astype(np.float32) for k, v in p.items()})

    def emissions(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Scores of the tags at each place of windows ``x``: windows, places, tags."""
        n, length = x.shape
        hidden = self.p["h"].shape[1]
        both = np.stack([x, x[:, ::-1]])  # direction, window, place
        state = np.zeros((2, n, hidden), np.float32)
        cell = np.zeros_like(state)
        outputs = np.empty((2, length, n, hidden), np.float32)
        way = np.arange(2)[:, None]
        for t in range(length):
            z = self.p["x"][way, both[:, :, t]] + state @ self.p["h"]
            gates = _sigmoid(z[..., : 3 * hidden])
            fresh = np.tanh(z[..., 3 * hidden :])
            i, f, o = np.split(gates, 3, axis=2)
            before, cell = cell, f * cell + i * fresh
            bent = np.tanh(cell)
            if keep is not None:
                keep.append((state, before, i, f, o, fresh, bent))
            state = o * bent
            outputs[:, t] = state
        joined = np.concatenate([outputs[0], outputs[1, ::-1]], axis=2).transpose(1, 0, 2)
        if keep is not None:
            keep.append((both, joined))
        return joined @ self.p["out"] + self.p["bias"]

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags ``y`` and its gradient."""
        keep: list = []
        scores = self.emissions(x, keep).astype(np.float64)
        both, joined = keep.pop()
        n, length, tags = scores.shape
        move = self.p["move"].astype(np.float64)
        ahead = np.empty_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, length):
            ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + move, 1) + scores[:, t]
        behind = np.zeros_like(scores)
        for t in range(length - 2, -1, -1):
            behind[:, t] = _logsum(move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        whole = _logsum(ahead[:, -1], 1)
        row = np.arange(n)[:, None]
        place = np.arange(length)[None, :]
        gold = scores[row, place, y].sum(1) + move[y[:, :-1], y[:, 1:]].sum(1)
        d_scores = np.exp(ahead + behind - whole[:, None, None])
        d_scores[row, place, y] -= 1
        d_move = np.zeros_like(move)
        for t in range(1, length):
            joint = (
                ahead[:, t - 1, :, None] + move + (scores[:, t] + behind[:, t])[:, None, :]
            ) - whole[:, None, None]
            d_move += np.exp(joint).sum(0)
        np.subtract.at(d_move, (y[:, :-1], y[:, 1:]), 1)
        d_scores = (d_scores / n).astype(np.float32)
        grad = {
            "out": np.einsum("nth,ntk->hk", joined, d_scores),
            "bias": d_scores.sum((0, 1)),
            "move": (d_move / n).astype(np.float32),
            "x": np.zeros_like(self.p["x"]),
            "h": np.zeros_like(self.p["h"]),
        }
        d_joined = d_scores @ self.p["out"].T
        hidden = self.p["h"].shape[1]
        d_out = np.stack([d_joined[..., :hidden], d_joined[:, ::-1, hidden:]])
        d_state = np.zeros((2, n, hidden), np.float32)
        d_cell = np.zeros_like(d_state)
        back = self.p["h"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            state, before, i, f, o, fresh, bent = keep[t]
            d_state = d_state + d_out[:, :, t]
            d_cell = d_cell + d_state * o * (1 - bent**2)
            z = np.concatenate(
                [
                    d_cell * fresh * i * (1 - i),
                    d_cell * before * f * (1 - f),
                    d_state * bent * o * (1 - o),
                    d_cell * i * (1 - fresh**2),
                ],
                axis=2,
            )
            grad["h"] += state.transpose(0, 2, 1) @ z
            for way in (0, 1):
                chosen = np.eye(CLASSES, dtype=np.float32)[both[way, :, t]]
                grad["x"][way] += chosen.T @ z[way]
            d_state = z @ back
            d_cell = d_cell * f
        return float((whole - gold).mean()), grad

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Tagger:
        rng = np.random.default_rng(9)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            rate = 0.02 * (1 - 0.8 * epoch / max(1, epochs - 1))
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                chosen = order[at : at + BATCH]
                _, grad = self.loss(x[chosen], y[chosen])
                norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g / max(1.0, norm / 5)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g**2
                    change = mean[k] / (1 - 0.9**step)
                    change /= np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
                    self.p[k] = (self.p[k] - rate * change).astype(np.float32)
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of windows ``x``."""
        tags = np.empty(x.shape, np.int8)
        for at in range(0, len(x), DECODED):
            scores = self.emissions(x[at : at + DECODED])
            n, length, k = scores.shape
            best = scores[:, 0]
            came = np.empty((length, n, k), np.int8)
            for t in range(1, length):
                options = best[:, :, None] + self.p["move"]
                came[t] = options.argmax(axis=1)
                best = options.max(axis=1) + scores[:, t]
            now = best.argmax(axis=1)
            row = np.arange(n)
            for t in range(length - 1, -1, -1):
                tags[at : at + n, t] = now
                if t:
                    now = came[t, row, now]
        return tags


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts, in multiples of ``STRIDE``, of the windows with a digit or @, and the classes
    of their characters, padded at the end of the text."""
    places = np.fromiter((m.start() for m in _ANCHOR.finditer(text)), np.int64)
    home = np.unique(places // STRIDE)
    starts = np.unique(np.concatenate([home, np.maximum(home - 1, 0)])) * STRIDE
    rows = np.zeros((len(starts), WINDOW), np.int8)
    for row, start in zip(rows, starts.tolist(), strict=True):
        part = classes(text[start : start + WINDOW])
        row[: len(part)] = part
    return starts, rows


def joined_tags(starts: np.ndarray, tags: np.ndarray) -> list[Span]:
    """Spans of kinds in document places: each place has the tag of the window that it
    is more central in, and runs of tags are read across windows."""
    tag_at: dict[int, np.ndarray] = dict(zip(starts.tolist(), tags, strict=True))
    half = STRIDE // 2
    places: list[tuple[int, int]] = []
    for start in sorted({s + d for s in tag_at for d in (0, STRIDE)}):
        own, before = tag_at.get(start), tag_at.get(start - STRIDE)
        first = own if before is None else before[STRIDE:]
        second = before[STRIDE:] if own is None else own
        for i in range(STRIDE):
            tag = (first if i < half else second)[i]
            if tag:
                places.append((start + i, int(tag)))
    spans: list[list] = []
    for place, tag in places:
        kind = TAGS[tag][2:]
        last = spans[-1] if spans else None
        if last and TAGS[tag][0] == "I" and last[2] == kind and last[1] == place:
            last[1] = place + 1
        else:
            spans.append([place, place + 1, kind])
    return [tuple(s) for s in spans]


def more_spans(text: str, found: list[Span], base: list[Span]) -> list[Span]:
    """The tagger's spans that overlap no base span and pass: blanks at the ends are cut
    off, and what is left has the form of its kind."""
    forms = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PLAIN}
    covered = sorted((a, b) for a, b, _ in base)
    kept, at, upto = [], 0, 0
    for start, end, kind in sorted(found):
        part = text[start:end]
        start += len(part) - len(part.lstrip(" \n,:"))
        end -= len(part) - len(part.rstrip(" \n,:.-("))
        while at < len(covered) and covered[at][0] < end:
            upto = max(upto, covered[at][1])
            at += 1
        if end <= start or upto > start:
            continue
        part = text[start:end]
        if forms[kind].fullmatch(part) and passes(kind, part):
            kept.append((start, end, kind))
            upto = max(upto, end)
    return kept


def find_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans in order, and the tagger's, of each text; windows of all are decoded
    together."""
    base = [in_order(base_spans(t)) for t in texts]
    more: list[list[Span]] = [[] for _ in texts]
    if tagger is None:
        return list(zip(base, more, strict=True))
    asked = [i for i, t in enumerate(texts) if _ANCHOR.search(t)]
    batch: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if not batch:
            return
        tags = tagger.decode(np.concatenate([rows for _, _, rows in batch]))
        at = 0
        for i, starts, rows in batch:
            spans = joined_tags(starts, tags[at : at + len(rows)])
            more[i] = more_spans(texts[i], spans, base[i])
            at += len(rows)
        batch.clear()

    for i in asked:
        starts, rows = windows_of(texts[i])
        batch.append((i, starts, rows))
        if sum(len(r) for _, _, r in batch) >= DECODED:
            flush()
    flush()
    return list(zip(base, more, strict=True))


def _tagged(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for start, end, kind in spans:
        tags[start:end] = TAGS.index(f"I-{kind}")
        tags[start] = TAGS.index(f"B-{kind}")
    return tags


def _hides(text: str, failed: Span, spans: list[Span]) -> bool:
    """Whether a match that failed its test may hold personal data that no span has."""
    start, end, _ = failed
    inside = any(a <= start and end <= b for a, b, _ in spans)
    return not inside and len(_digits(text[start:end])) >= 9


def training_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags from labelled texts: as they stand, where no match that failed its
    test may hide something and no spans overlap, and with two or three labelled spans in a row, joined by a blank."""
    rng = np.random.default_rng(3)
    real, pieces, around = [], [], []
    for text in texts:
        spans = sorted(base_spans(text))
        overlap = any(a[1] > b[0] for a, b in zip(spans, spans[1:], strict=False))
        if overlap or any(_hides(text, f, spans) for f in base_spans(text, failed=True)):
            continue
        tags = _tagged(len(text), spans)
        for start, end, kind in spans:
            pieces.append((text[start:end], kind))
            around.append((text[max(0, start - 40) : start], text[end : end + 40]))
        starts, rows = windows_of(text)
        for start, row in zip(starts.tolist(), rows, strict=True):
            padded = np.zeros(WINDOW, np.int64)
            padded[: len(tags[start : start + WINDOW])] = tags[start : start + WINDOW]
            real.append((row, padded))
    if len(pieces) < FEWEST_SPANS:
        return np.zeros((0, WINDOW), np.int8), np.zeros((0, WINDOW), np.int64)
    made = []
    for _ in range(TRAINING_WINDOWS // 2):
        before, after = around[rng.integers(len(around))]
        text, spans = before, []
        for n, k in enumerate(rng.choice(len(pieces), rng.integers(2, 4))):
            text += " " if n else ""
            spans.append((len(text), len(text) + len(pieces[k][0]), pieces[k][1]))
            text += pieces[k][0]
        text += after
        start = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        row, tags = np.zeros(WINDOW, np.int8), np.zeros(WINDOW, np.int64)
        part = classes(text[start : start + WINDOW])
        row[: len(part)] = part
        tags[: len(part)] = _tagged(len(text), spans)[start : start + WINDOW]
        made.append((row, tags))
    chosen = rng.permutation(len(real))[: TRAINING_WINDOWS - len(made)]
    both = [real[i] for i in chosen] + made
    return np.array([b[0] for b in both]), np.array([b[1] for b in both])


def fit(docs: DataFrame, parts: int = TRAINING_PARTS) -> Tagger | None:
    """Train on neighbourhoods of digits and @: all documents are searched, and of the
    distinct neighbourhoods that have a span of a kind, or of none, at most ``parts`` are drawn by
    their own hash. None where those have fewer than ``FEWEST_SPANS`` spans."""

    def kinds(text: str) -> Iterator[tuple[str, str, int]]:
        for part in neighbourhoods(text):
            found = {kind for _, _, kind in base_spans(part)}
            yield from ((kind, part, 0) for kind in found or {""})

    texts = docs.select(F.col("text").cast("string").alias("text"))
    chosen = drawn(texts.where(F.col("text").rlike("[0-9@]")), kinds, parts)
    x, y = training_windows(sorted({part for own in chosen.values() for part in own}))
    return Tagger.new().train(x, y) if len(x) else None


def neighbourhoods(text: str, reach: int = 64, longest: int = 1024) -> list[str]:
    """The text around runs of digits and @; none of a run that is longer than ``longest``."""
    parts: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        start, end = max(0, m.start() - reach), m.end() + reach
        if parts and start <= parts[-1][1]:
            parts[-1][1] = end
        else:
            parts.append([start, end])
    return [text[a:b] for a, b in parts if b - a <= longest]


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans for each row of
    ``docs`` (doc_id, text).

    The counts and the digest are of the patterns' spans; ``spans`` has the tagger's too, by
    kind, then start, and ``n_spans`` counts all of them. Null texts count as empty: no spans. Repeated and null doc_ids are
    searched row by row. An empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = find_spans(texts, shared.value)
            counts = [Counter(kind for _, _, kind in base) for base, _ in found]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([c[kind] for c in counts], pa.int64()) for kind in KINDS],
                    pa.array(digests, pa.string()),
                    pa.array([written(in_order(a + b)) for a, b in found], pa.string()),
                    pa.array([len(a) + len(b) for a, b in found], pa.int64()),
                ],
                ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans", "n_spans"],
            )

    columns = ", ".join(f"n_{kind} long" for kind in KINDS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        search, f"doc_id long, {columns}, base_sha256 string, spans string, n_spans long"
    )


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind; spans that overlap become one."""
    out, upto = [], 0
    for start, end, kind in sorted(spans):
        if start >= upto:
            out += [text[upto:start], f"[{kind.upper()}]"]
        upto = max(upto, end)
    return "".join([*out, text[upto:]])


def masked(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` as it then is. Null
    texts stay null; texts without personal data and their n_chars stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist()
            found = find_spans([t or "" for t in texts], shared.value)
            for i, (base, more) in enumerate(found):
                if base or more:
                    texts[i] = mask(texts[i], base + more)
                    sizes[i] = len(texts[i])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            columns["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(change, docs.schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find(docs, fit(docs))
