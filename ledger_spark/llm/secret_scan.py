"""Secrets in texts: fixed patterns, and long tokens that look random.

Two first-order Markov models of characters, one of random strings and one of ordinary
text, are compared by log-likelihood ratio, which decides on every token with a letter. Both are trained
on the corpus: strings that the patterns catch are the samples labelled random; all other text, prose
mostly and not labelled identifiers, is the ordinary one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.llm.tables import from_text, pieces, share, shared

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
# Fixed patterns; letters of the names of the first one in either case.
ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

# Characters of tokens; every other byte is the boundary 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1
CODE = np.zeros(256, dtype=np.uint8)
CODE[list(ALPHABET.encode())] = np.arange(1, SYMBOLS)
IS_HEX = np.zeros(256, dtype=bool)
IS_HEX[list(b"0123456789abcdef")] = True

# Weight, in pairs, of the frequencies of single characters.
BACKOFF = 5.0
# Tokens are scored from the length of the shortest fixed pattern. The ratio must be so large per
# character and, as short tokens have less to show, so large in all.
MIN_TOKEN = 12
MIN_RATIO_PER_CHARACTER = 0.7
MIN_RATIO = 14.0
CHUNK_BYTES = 1_000_000
# Pairs numbered at a time; counting them takes eight bytes each.
PAIRS_AT_ONCE = 1 << 18
MARK = "<SECRET>"
SPANS = "array<struct<start: int, rank: int, kind: string, end: int, score: double>>"


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, rank of the kind, end, start of the secret itself) of the fixed patterns."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [
            (m.start(), 0, m.end(), m.start(2))
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 12
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end(), m.start())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= 18
        ]
    found += [
        (m.start(), 2, m.end(), m.start())
        for m in HEX.finditer(text)
        if m.end() - m.start() >= 16
    ]
    return sorted(found)


def _transitions(data: bytes) -> np.ndarray:
    """Counts of neighbouring characters, pairs of two boundaries left out."""
    code = CODE[np.frombuffer(data, dtype=np.uint8)]
    counts = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
    for at in range(0, len(code) - 1, PAIRS_AT_ONCE):
        part = code[at : at + PAIRS_AT_ONCE + 1]
        pair = part[:-1].astype(np.uint16) * np.uint16(SYMBOLS) + part[1:]
        counts += np.bincount(pair, minlength=SYMBOLS * SYMBOLS)
    counts[0] = 0
    return counts


def _runs(member: np.ndarray, least: int) -> np.ndarray:
    """Starts of the runs of at least that many members."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], member, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    return starts[ends - starts >= least]


def suspects(texts: list[str]) -> tuple[bytes, list[int]]:
    """All texts as bytes between boundaries, and which of them can hold a secret at all."""
    data = [t.encode() for t in texts]
    joined = b"\xff" + b"\xff".join(data) + b"\xff"
    values = np.frombuffer(joined, dtype=np.uint8)
    begins = np.cumsum([1] + [len(d) + 1 for d in data])
    starts = np.concatenate([_runs(IS_HEX[values], 16), _runs(CODE[values] > 0, MIN_TOKEN)])
    found = set((np.searchsorted(begins, starts, side="right") - 1).tolist())
    for i, text in enumerate(texts):
        if i not in found:
            lower = text.lower()
            if "akia" in lower or any(name in lower for name in NAMES):
                found.add(i)
    return joined, sorted(found)


def train(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of each pair of neighbouring characters.

    Counts cover all rows; each task adds up its own and hands on two small tables, so what reaches
    the driver has a fixed size. A corpus without samples of a class gives it the uniform model.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        random = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for batch in pieces(batches, 0, CHUNK_BYTES):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            joined, found = suspects(texts)
            ordinary += _transitions(joined)
            for i in found:
                for _, _, end, secret in base_spans(texts[i]):
                    part = _transitions(b"\xff" + texts[i][secret:end].encode() + b"\xff")
                    random += part
                    ordinary -= part
        for label, counts in enumerate((ordinary, random)):
            pair = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(pair), label), pa.int32()),
                    pa.array(pair, pa.int32()),
                    pa.array(counts[pair], pa.int64()),
                ],
                ["label", "pair", "n"],
            )

    counted = df.select(text_column).mapInArrow(count, "label int, pair int, n long")
    logs = np.zeros((2, SYMBOLS * SYMBOLS))
    for label, pair, n in counted.groupBy("label", "pair").agg(F.sum("n")).collect():
        logs[label, pair] = max(n, 0)
    logs = logs.reshape(2, SYMBOLS, SYMBOLS)
    # Rare pairs lean on how often the character occurs at all in its class.
    single = logs.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    logs = (logs + BACKOFF * single) / (logs.sum(axis=2, keepdims=True) + BACKOFF)
    logs = np.log(logs)
    return logs[1] - logs[0]


def all_spans(text: str, ratio: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Base spans with score 1, and random-looking tokens apart from them."""
    found = [(start, rank, end, 1.0) for start, rank, end, _ in base_spans(text)]
    begins = [start for start, *_ in found]
    # The furthest end of the base spans up to each; they stand by start.
    ends = list(accumulate((end for _, _, end, _ in found), max))
    for m in TOKEN.finditer(text):
        start, end = m.span()
        token = m.group()
        before = bisect_left(begins, end)  # base spans that begin before the token ends
        if end - start < MIN_TOKEN or (before and ends[before - 1] > start):
            continue
        if not any(c.isalpha() for c in token):  # a number, a date; from 16 digits on a base span
            continue
        code = np.concatenate([[0], CODE[list(token.encode())], [0]])
        total = float(ratio[code[:-1], code[1:]].sum())
        score = total / len(token)
        if score >= MIN_RATIO_PER_CHARACTER and total >= MIN_RATIO:
            found.append((start, 3, end, 1.0 / (1.0 + float(np.exp(-score)))))
    return sorted(found)


def scan(
    df: DataFrame,
    ratio: np.ndarray,
    text_column: str = "text",
    into: str = "secret_spans",
    clean: str | None = None,
    mark: str = MARK,
) -> DataFrame:
    """``df`` with its spans of secrets, in order: start and end in code points, end exclusive.

    NULL and empty texts have none. Columns named ``into`` and ``clean`` are replaced; all rows and
    other columns stay. Where ``clean`` names a column it holds the text with every run of overlapping
    spans replaced by the mark, NULL where there is no span. No shuffle.
    """
    model = share(df.sparkSession, ratio)
    kind = pa.list_(
        pa.struct(
            [
                ("start", pa.int32()),
                ("rank", pa.int32()),
                ("kind", pa.string()),
                ("end", pa.int32()),
                ("score", pa.float64()),
            ]
        )
    )

    def start():
        ratios = shared(model)

        def compute(texts: list[str | None]) -> list[pa.Array]:
            plain = [t or "" for t in texts]
            spans: list[list] = [[] for _ in plain]
            redacted: list[str | None] = [None] * len(plain)
            for i in suspects(plain)[1]:
                found = all_spans(plain[i], ratios)
                spans[i] = [
                    {"start": a, "rank": r, "kind": KINDS[r], "end": b, "score": s}
                    for a, r, b, s in found
                ]
                if clean and found:
                    redacted[i] = without(plain[i], [(a, b) for a, _, b, _ in found], mark)
            return [pa.array(spans, kind), *([pa.array(redacted, pa.string())] if clean else [])]

        return compute

    added = f"{into} {SPANS}" + (f", {clean} string" if clean else "")
    return from_text(df, text_column, added, start, CHUNK_BYTES)


def without(text: str, spans: list[tuple[int, int]], mark: str = MARK) -> str:
    """The text with every run of overlapping spans, which stand in order, replaced by one mark; one
    pass over the text."""
    parts, end = [], 0
    for start, stop in spans:
        if not parts or start >= end:
            parts += [text[end:start], mark]
        end = max(end, stop)
    return "".join([*parts, text[end:]])


def redact(text: Column, spans: Column, mark: str = MARK) -> Column:
    """``without`` as a column; ``scan`` gives the same in the pass that finds the spans."""

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, found in batches:
            out = [
                None if t is None else without(t, [(s["start"], s["end"]) for s in runs or ()], mark)
                for t, runs in zip(texts.to_pylist(), found.to_pylist(), strict=True)
            ]
            yield pa.array(out, pa.string())

    # Texts without a span are not sent to Python.
    some = F.size(spans) > 0
    return F.coalesce(F.arrow_udf(cut, "string")(F.when(some, text), F.when(some, spans)), text)
