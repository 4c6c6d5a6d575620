"""Secrets: patterns, and formats learned by grammar inference.

What the patterns find in all documents are labelled credentials. From a bounded sample of
them a probabilistic automaton per kind is inferred: a prefix tree of the samples, with
counts, whose states are merged where the counts of endings and of next symbols
do not differ more than Hoeffding's bound allows, and so on for the states that follow.
Every other token that is as long as the shortest credential is scored by the automata, and
if it is none, the parts that ``=``, ``/`` and ``.`` cut it into: a secret is what has a mean
log-likelihood not below that of nearly all samples, and above that of ordinary tokens.

Ordinary tokens are learned from by make-up. Among them are credentials that no pattern has
found: a token that has a learned format and was met in one context only is not learned from.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewinnow.llm.common import drawn, read

KINDS = ("assign", "access", "hex")
# Fixed patterns of the task; letters of the keyword in either case.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # of the runs, those of 24 or more
_KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
LEAST = {"assign": 6, "access": 20, "hex": 24}

TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+")
PART = re.compile(r"[^=/.]+")
TRAINING_VALUES = 400  # learned from per kind, and of ordinary tokens per make-up, at most
FEWEST_VALUES = 20  # a kind with fewer is not learned
CONTEXT = 16  # symbols before a token
LONGEST_VALUE = 256  # longer ones are not learned from
ALPHA = 0.05
SMOOTHING = 0.02
LEAST_QUANTILE = 0.02
MARGIN = 0.4  # log-likelihood per symbol above ordinary tokens
_SYMBOLS = 66
MAKEUP = tuple(map(re.compile, ("[0-9]", "[a-z]", "[A-Z]", "[^A-Za-z0-9]")))
COMMON = 0.01  # share of a kind's samples that a make-up has to have
KNOWN_TOKENS = 1 << 18

Span = tuple[int, int, str]


def base_spans(text: str) -> tuple[list[Span], list[tuple[str, str]]]:
    """Spans of the patterns by start and kind as listed, and the kinds and values."""
    spans, values = [], []
    if _KEYWORDS.search(text):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                spans.append((m.start(), m.end(), "assign"))
                values.append(("assign", m[2]))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= LEAST["access"]:
                spans.append((m.start(), m.end(), "access"))
                values.append(("access", m[0]))
    for m in _HEX.finditer(text):
        spans.append((m.start(), m.end(), "hex"))
        values.append(("hex", m[0]))
    return in_order(spans), values


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


@dataclass
class Automaton:
    """A deterministic automaton with counts: next[state][symbol], seen[state][symbol] and
    ends[state]. State 0 starts."""

    next: list[dict[str, int]] = field(default_factory=lambda: [{}])
    seen: list[Counter] = field(default_factory=lambda: [Counter()])
    ends: list[int] = field(default_factory=lambda: [0])
    least: float = -math.inf
    shortest: int = 0
    makeups: frozenset[str] = frozenset()

    @classmethod
    def infer(cls, samples: list[str], alpha: float = ALPHA) -> Automaton:
        """The automaton of the samples. What new values of the format score is measured with
        automata of one half of the samples on the other."""
        whole = cls._of(samples, alpha)
        halves = samples[::2], samples[1::2]
        scores = sorted(
            score
            for learned, tested in (halves, halves[::-1])
            if learned
            for score in map(cls._of(learned, alpha).score, tested)
        )
        if scores:
            whole.least = scores[int(LEAST_QUANTILE * len(scores))]
        whole.shortest = min(map(len, samples), default=0)
        made = Counter(map(makeup, samples))
        whole.makeups = frozenset(m for m, n in made.items() if n >= COMMON * len(samples))
        return whole

    @classmethod
    def _of(cls, samples: list[str], alpha: float) -> Automaton:
        tree = cls()
        for sample in samples:
            state = 0
            for symbol in sample:
                tree.seen[state][symbol] += 1
                if symbol not in tree.next[state]:
                    tree.next[state][symbol] = len(tree.next)
                    tree.next.append({})
                    tree.seen.append(Counter())
                    tree.ends.append(0)
                state = tree.next[state][symbol]
            tree.ends[state] += 1
        tree._merge(alpha)
        return tree

    def accepts(self, token: str, made: str, slack: float = 0.0) -> float | None:
        """The token's score, if its length, make-up and, but for ``slack``, score are those of
        samples."""
        if len(token) < self.shortest or made not in self.makeups:
            return None
        score = self.score(token)
        return score if score >= self.least - slack else None

    def _total(self, state: int) -> int:
        return self.ends[state] + self.seen[state].total()

    def _differ(self, a: int, n: int, b: int, m: int, alpha: float) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(a / n - b / m) > bound

    def _compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether both states, and those that follow by equal symbols, may be one."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self._total(a), self._total(b)
            if a == b or not n or not m:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m, alpha):
                return False
            for symbol in self.seen[a].keys() | self.seen[b].keys():
                if self._differ(self.seen[a][symbol], n, self.seen[b][symbol], m, alpha):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, gone: int) -> None:
        """Add the tree below ``gone`` to the automaton at ``into``."""
        todo = [(into, gone)]
        while todo:
            into, gone = todo.pop()
            self.ends[into] += self.ends[gone]
            self.seen[into].update(self.seen[gone])
            for symbol, child in self.next[gone].items():
                if symbol in self.next[into]:
                    todo.append((self.next[into][symbol], child))
                else:
                    self.next[into][symbol] = child

    def _merge(self, alpha: float) -> None:
        """Settled states are compared with the roots of the trees below them, the most
        frequent first; a root merges into the first settled state it agrees with, or is
        settled itself."""
        settled = [0]
        while True:
            fringe = [
                (-self._total(child), parent, symbol, child)
                for parent in settled
                for symbol, child in self.next[parent].items()
                if child not in settled
            ]
            if not fringe:
                return
            _, parent, symbol, child = min(fringe)
            for state in settled:
                if self._compatible(state, child, alpha):
                    self.next[parent][symbol] = state
                    self._fold(state, child)
                    break
            else:
                settled.append(child)

    def score(self, text: str) -> float:
        """Mean log-likelihood per symbol, the end counted as one; unseen symbols and
        states are smoothed."""
        state: int | None = 0
        total = 0.0
        unseen = math.log(SMOOTHING / (_SYMBOLS + 1))
        for symbol in text:
            if state is None:
                total += unseen
                continue
            n = self._total(state)
            chance = (1 - SMOOTHING) * self.seen[state][symbol] / n if n else 0.0
            total += math.log(chance + SMOOTHING / (_SYMBOLS + 1))
            state = self.next[state].get(symbol, state if n else None)
        n = self._total(state) if state is not None else 0
        chance = (1 - SMOOTHING) * self.ends[state] / n if n else 0.0
        total += math.log(chance + SMOOTHING / (_SYMBOLS + 1))
        return total / (len(text) + 1)


@dataclass
class Formats:
    automata: dict[str, Automaton]
    ordinary: list[Automaton]
    # Most tokens occur again and again; a worker keeps what it found for so many of them.
    known: dict[str, str | None] = field(default_factory=dict)

    @property
    def shortest(self) -> int:
        return min((a.shortest for a in self.automata.values()), default=0)

    def kind_of(self, token: str) -> str | None:
        """The kind whose format explains the token best, if any explains it."""
        if token not in self.known:
            if len(self.known) >= KNOWN_TOKENS:
                self.known.clear()
            self.known[token] = self._kind_of(token)
        return self.known[token]

    def _kind_of(self, token: str) -> str | None:
        best, usual, made = None, None, makeup(token)
        for kind, automaton in self.automata.items():
            score = automaton.accepts(token, made)
            if score is None or (best and score <= best[0]):
                continue
            if usual is None:
                usual = max((o.score(token) for o in self.ordinary), default=-math.inf)
            if score - usual > MARGIN:
                best = score, kind
        return best[1] if best else None

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates with a learned format, and such parts of the others."""
        found = []
        for start, end in candidates(text, base, self.shortest) if self.automata else ():
            kind = self.kind_of(text[start:end])
            if kind:
                found.append((start, end, kind))
                continue
            for m in PART.finditer(text, start, end):
                if self.shortest <= len(m[0]) < end - start:
                    kind = self.kind_of(m[0])
                    if kind:
                        found.append((*m.span(), kind))
        return found


def candidates(text: str, base: list[Span], least: int) -> Iterator[tuple[int, int]]:
    """Tokens of ``least`` or more symbols that overlap no span of ``base``, which is by start;
    of tokens that do, what lies before, between and after the spans."""
    at, upto = 0, 0
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if end - start < least:
            continue
        start = max(start, upto)
        while at < len(base) and base[at][0] < end:
            if base[at][0] - start >= least:
                yield start, base[at][0]
            upto = max(upto, base[at][1])
            start = max(start, upto)
            at += 1
        if end - start >= least:
            yield start, end


def makeup(token: str) -> str:
    """Which classes of symbols a token is made of. Ordinary tokens of each make-up have
    automata of their own: numbers are not to be judged by words."""
    return "".join("01"[test.search(token) is not None] for test in MAKEUP)


def fit(docs: DataFrame, values: int = TRAINING_VALUES) -> Formats:
    """Infer formats from the credentials in all documents, and ordinary tokens from the
    other candidates: of the distinct values of each kind or make-up at most ``values``, by
    their own hash. A kind with fewer than ``FEWEST_VALUES`` is not learned."""
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def labelled(text: str) -> list[tuple[str, str, int]]:
        return [(*v, 0) for v in base_spans(text)[1] if len(v[1]) <= LONGEST_VALUE]

    by_kind = drawn(texts, labelled, values)
    automata = {
        kind: Automaton.infer(list(by_kind[kind]))
        for kind in KINDS
        if len(by_kind.get(kind, ())) >= FEWEST_VALUES
    }
    shortest = min((a.shortest for a in automata.values()), default=0)

    def others(text: str) -> Iterator[tuple[str, str, int]]:
        for start, end in candidates(text, base_spans(text)[0], shortest):
            if end - start <= LONGEST_VALUE:
                context = zlib.crc32(text[max(0, start - CONTEXT) : start].encode())
                yield makeup(text[start:end]), text[start:end], context

    def alike(token: str) -> bool:
        parts = [token, *(p for p in PART.findall(token) if len(p) >= shortest)]
        return any(
            a.accepts(p, makeup(p), MARGIN) is not None for a in automata.values() for p in parts
        )

    plain = {
        made: [t for t, several in own.items() if several or not alike(t)]
        for made, own in (drawn(texts, others, values) if automata else {}).items()
    }
    # For tokens of a make-up that hardly occurs, one of all.
    every = sorted(v for own in plain.values() for v in own)
    plain[""] = every[:: 1 + len(every) // values]
    ordinary = [Automaton.infer(v) for v in plain.values() if len(v) >= FEWEST_VALUES]
    return Formats(automata, ordinary)


def find(docs: DataFrame, model: Formats) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of ``docs``
    (doc_id, text).

    The counts and the digest are of the patterns' spans; ``spans`` has the learned ones too,
    by start, then kind, joined by commas. Null texts count as empty: no spans. Repeated and
    null doc_ids are searched row by row. An empty table gives no rows. Other columns are not
    read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column("text").to_pylist():
                base, _ = base_spans(text or "")
                counts.append(Counter(kind for _, _, kind in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                more = shared.value.spans(text or "", base)
                spans.append(written(in_order(base + more)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array([c[kind] for c in counts], pa.int64()) for kind in KINDS],
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        search,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return find(docs, fit(docs))
