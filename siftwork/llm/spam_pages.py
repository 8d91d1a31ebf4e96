"""Problem 10: keyword-stuffed and link-list pages.

A page is cut into lines (long ones into sentences, then into runs of SPAN words).  A hidden
Markov model with the states prose, links, tags and menu explains the lines by what can be
seen of each: links among its words, hash tags or prices, function words, words that the page repeats
beyond measure, formulas, a sentence's end.  The texts are read once; what is seen of their lines, a
few bytes each, is kept in the shared folder.  The model starts from the prior counts below and is fitted by
expectation maximisation on all lines of all pages: each round is a map that sums the expected
counts (some 1,700 numbers a task) and a sum over the tasks.  The counts weigh as much against the prior
as those of PAGES pages, however many there are, so the states mean the same at every size.
Every page is then decoded whole by Viterbi, a batch at a time, and flagged when more than half of
its words stand in lines that aren't prose.  Nothing is shuffled but the counts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm import cleanup
from siftwork.llm.defects import STOPWORDS
from siftwork.operators.checkpoints import cut

STATES = ("prose", "links", "tags", "menu")
#: Pages whose counts weigh like those of the whole corpus.
PAGES = 2_000
#: Rounds of expectation maximisation.
ROUNDS = 4
#: Words of a line at most; longer ones are several lines.
SPAN = 25

_URL = re.compile(r"(?:https?://|www\.)[^\s\"'<>]+|(?<![\w-])[\w-]{1,80}(?:\.[\w-]{1,80}){0,6}\.(?:[a-z]{2,24}|xn--[a-z0-9-]{2,59})(?![\w-])(?:/[^\s\"'<>]*)?", re.I)
_CUT = re.compile(r"\n+|(?<=[.!?;])\s+(?=\S)|(?=<a\s)")
_STOP = re.compile(r"[.!?](?: |$)")
_TAG = re.compile(r"(?:^|\s)#\w")
_PRICE = re.compile(r"\d[\d\s.,]{0,12}\s?(?:zł|pln|eur|usd|gbp|€|£|грн)(?!\w)|[€£]\s?\d|\$\s?\d+[.,]\d\d\b(?!.*\$)", re.I)
_MONEY = re.compile(r"(?:zł|pln|eur|usd|gbp|грн)(?!\w)|[€£]|\$\s?\d+[.,]\d\d\b")
#: Every address without a scheme has this.
_DOT = re.compile(r"\.[a-z0-9-]{2}")
_HTML = re.compile(r"</?[a-zA-Z][^<>]*>")
_FUNCTION = frozenset().union(*STOPWORDS.values()) | frozenset("і та що не на до як це або якщо нехай тоді для від при є то у в з за отже звідси тому маємо мають розглянемо залишилося цей ця це який яка яке".split())

#: Values of each feature: links, marks, function words, repetition, formulas, sentence end.
SIZES = (4, 3, 3, 3, 2, 2)
#: Prior counts of each feature's values in each state, in the order of STATES.
PRIOR = (
    ((960, 30, 8, 2), (4, 60, 500, 436), (985, 10, 4, 1), (900, 80, 15, 5)),
    ((990, 2, 8), (960, 10, 30), (450, 180, 370), (950, 30, 20)),
    ((130, 270, 600), (880, 100, 20), (640, 110, 250), (850, 130, 20)),
    ((930, 60, 10), (400, 350, 250), (60, 120, 820), (600, 300, 100)),
    ((400, 600), (997, 3), (997, 3), (997, 3)),
    ((250, 750), (960, 40), (650, 350), (980, 20)),
)
#: Features whose counts are not fitted: no state but prose has formulas, whatever lines of formulas a corpus has.
FIXED = (4,)
START = (900, 30, 60, 10)
MOVES = ((970, 8, 16, 6), (15, 960, 15, 10), (15, 10, 970, 5), (40, 30, 30, 900))


def page_lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of each line: one row of values per feature of SIZES, and the number of words."""
    lower = cleanup.simple_fold(text).lower()
    linked, priced = "://" in lower or _DOT.search(lower) is not None, _MONEY.search(lower) is not None
    counts: Counter = Counter()
    lines = []
    for part in _CUT.split(lower):
        pieces = part.split()
        for k in range(0, len(pieces), SPAN):
            run = pieces[k : k + SPAN]
            line = " ".join(run)
            urls, rest = 0, line
            if linked and ("://" in line or _DOT.search(line)):
                rest, urls = _URL.subn(" ", line)
            if "<" in rest:
                rest = _HTML.sub(" ", rest)
            words = cleanup.LETTERS.findall(rest)
            counts.update(words)
            ends = run[-1][-1] in ".!?:" if k + SPAN >= len(pieces) else _STOP.search(line) is not None
            lines.append((line, len(run), urls, words, ends))
    least = max(5, 0.06 * sum(n for w, n in counts.items() if len(w) > 2))
    hot = {w for w, n in counts.items() if n >= least and len(w) > 2 and w not in _FUNCTION}
    out, sizes = [], []
    for line, length, urls, words, ends in lines:
        n = len(words)
        share = urls / (urls + n) if urls else 0
        function = sum(map(_FUNCTION.__contains__, words)) / n if n else 0
        repeated = sum(map(hot.__contains__, words)) / n if n and hot else 0
        tags = len(_TAG.findall(line)) if "#" in line else 0
        math = "$" in line or "\\" in line or n == 0 or (n < 3 and not urls and any(map(str.isdigit, line)))
        out.append(
            (
                0 if share == 0 else 1 if share < 0.28 else 2 if share < 0.6 else 3,
                1 if tags * 3 > length else 2 if priced and _PRICE.search(line) else 0,
                0 if function == 0 else 1 if function < 0.12 else 2,
                0 if repeated < 0.2 else 1 if repeated < 0.5 else 2,
                int(math),
                int(ends),
            )
        )
        sizes.append(max(1, n + urls))
    return np.array(out, np.int8).reshape(-1, len(SIZES)), np.array(sizes, np.int64)


def codes_of(features: np.ndarray) -> np.ndarray:
    """One number for the values of each line."""
    return np.ravel_multi_index(tuple(features.T.astype(np.int64)), SIZES).astype(np.int16)


class Model:
    """Probabilities: start (S), moves (S, S), emissions, one (S, values) for each feature, and of whole lines by their code (codes, S)."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emissions: list[np.ndarray]):
        norm = lambda x: x / x.sum(-1, keepdims=True)
        self.start, self.moves, self.emissions = norm(start), norm(moves), [norm(e) for e in emissions]
        values = np.unravel_index(np.arange(math.prod(SIZES)), SIZES)
        self.lines = math.prod(e.T[v] for e, v in zip(self.emissions, values, strict=True))

    @classmethod
    def prior(cls) -> Model:
        return cls(np.array(START, float), np.array(MOVES, float), [np.array(p, float) for p in PRIOR])

    def expected(self, pages: list[np.ndarray]) -> np.ndarray:
        """Expected counts over pages (codes of their lines): starts, moves and lines by code and state, in one vector; last the number of pages."""
        start, moves, lines, n = np.zeros(len(STATES)), np.zeros((len(STATES),) * 2), np.zeros((len(self.lines), len(STATES))), 0
        for ids, own, code in _blocks(pages):
            f, scale = np.empty((code.shape[1], len(ids), len(STATES))), np.empty((code.shape[1], len(ids), 1))
            for t in range(code.shape[1]):
                x = (f[t - 1] @ self.moves if t else self.start) * self.lines[code[:, t]]
                scale[t] = x.sum(1, keepdims=True)
                f[t] = x / scale[t]
            back = np.ones((len(ids), len(STATES)))
            for t in range(code.shape[1] - 1, -1, -1):
                here = (t < own)[:, None]
                seen = np.where(here, f[t] * back, 0.0)
                for s in range(len(STATES)):
                    lines[:, s] += np.bincount(code[:, t], seen[:, s], len(lines))
                ahead = np.where(here, self.lines[code[:, t]] * back / scale[t], 0.0)
                if t:
                    moves += f[t - 1].T @ ahead * self.moves
                else:
                    start += seen.sum(0)
                back = np.where(here, ahead @ self.moves.T, 1.0)
            n += len(ids)
        return np.concatenate([start, moves.ravel(), lines.ravel(), [n]])

    @classmethod
    def updated(cls, counts: np.ndarray, weight: float = 30.0) -> Model:
        """The model that expected counts give; ``weight`` times the prior counts stay in, so a state keeps its meaning."""
        size = len(STATES)
        counts = counts * (PAGES / max(counts[-1], 1.0))
        start, moves = weight * np.array(START, float) + counts[:size], weight * np.array(MOVES, float) + counts[size : size + size * size].reshape(size, size)
        lines = counts[size + size * size : -1].reshape(*SIZES, size)
        emissions = []
        for k, p in enumerate(PRIOR):
            found = lines.sum(tuple(i for i in range(len(SIZES)) if i != k)).T
            emissions.append(weight * np.array(p, float) + (0 if k in FIXED else found))
        return cls(start, moves, emissions)


def _blocks(pages: list[np.ndarray], most: int = 2_000_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(pages, their numbers of lines, their codes padded) of pages of like length, so that padding stays below a factor of two."""
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i]))
    lengths = np.array([len(pages[i]) for i in order])
    begin = 0
    while begin < len(order):
        longest = int(lengths[begin])
        stop = begin + int(np.searchsorted(-lengths[begin:], -(longest // 2), side="left"))
        stop = max(begin + 1, min(stop, begin + max(1, most // longest)))
        ids = order[begin:stop]
        code = np.zeros((len(ids), longest), np.int64)
        for k, i in enumerate(ids):
            code[k, : len(pages[i])] = pages[i]
        yield ids, lengths[begin:stop], code
        begin = stop


def decode(model: Model, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Most likely states of each page's lines (codes); pages of a block step together."""
    out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(pages)
    start, moves, lines = np.log(model.start), np.log(model.moves), np.log(model.lines).astype(np.float32)
    for ids, own, code in _blocks(pages):
        longest = code.shape[1]
        back = np.zeros((len(ids), longest, len(STATES)), np.int8)
        best = start + lines[code[:, 0]]
        for t in range(1, longest):
            step = best[:, :, None] + moves
            back[:, t] = step.argmax(1)
            best = np.where((t < own)[:, None], step.max(1) + lines[code[:, t]], best)
        state = best.argmax(1)
        path = np.zeros((len(ids), longest), np.int8)
        rows = np.arange(len(ids))
        for t in range(longest - 1, -1, -1):
            path[:, t] = state
            state = np.where(t < own, back[rows, t, state], state) if t else state
        for k, i in enumerate(ids):
            out[i] = path[k, : len(pages[i])]
    return out


def seen_lines(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """The kept columns with page_codes and page_words: what is seen of each line of the text, and its words; both empty for null and blank texts."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("page_codes", T.BinaryType()), T.StructField("page_words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [page_lines(t) if t else (np.zeros((0, len(SIZES)), np.int8), np.zeros(0, np.int64)) for t in b.column(len(keep)).to_pylist()]
            codes, words = [codes_of(f).tobytes() for f, _ in found], [w.astype(np.int32).tobytes() for _, w in found]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(codes, pa.binary()), pa.array(words, pa.binary())], names=[*keep, "page_codes", "page_words"])

    return df.select(*keep, text_col).mapInArrow(run, schema)


def _codes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16) for x in column.to_pylist()]


def fit(lines: DataFrame) -> Model:
    """The model for all pages of ``lines`` (seen_lines, kept where it can be read again); with no pages, the prior."""
    model = Model.prior()
    for _ in range(ROUNDS):

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                got = model.expected(_codes(b.column(0)))
                total = got if total is None else total + got
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "n"])

        rows = lines.select("page_codes").mapInArrow(run, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect()
        if not rows:
            return model
        counts = np.zeros(len(rows))
        for r in rows:
            counts[r["i"]] = r["n"]
        model = Model.updated(counts)
    return model


def spam_pages(df: DataFrame, text_col: str = "text", share: float = 0.5, model: Model | None = None) -> DataFrame:
    """The rows without the text, with n_words, the words by state (prose, links, tags, menu) and ``spam``.

    Spam is a page of which more than ``share`` of the words stand in lines that aren't prose; null, empty and
    blank pages have no words and are none.  Texts are judged whole, however long.  Repeated rows stay; other
    columns pass through, those of the names added are replaced; page_codes and page_words are taken.
    """
    added = ("n_words", *STATES, "spam")
    keep = [c for c in df.columns if c != text_col and c not in added and c not in ("page_codes", "page_words")]
    lines = seen_lines(df, keep, text_col)
    if model is None:
        lines = cut(lines)
        model = fit(lines)
    schema = T.StructType([*[df.schema[c] for c in keep], *[T.StructField(c, T.LongType()) for c in added[:-1]], T.StructField("spam", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
        for b in batches:
            states = decode(model, _codes(b.column(len(keep))))
            sizes = [np.frombuffer(x, np.int32) for x in b.column(len(keep) + 1).to_pylist()]
            words = np.array([np.bincount(s, w, len(STATES)) if len(s) else np.zeros(len(STATES)) for s, w in zip(states, sizes, strict=True)]).reshape(-1, len(STATES)).astype(np.int64)
            total = words.sum(1)
            arrays = [pa.array(total), *[pa.array(words[:, k]) for k in range(len(STATES))], pa.array(total - words[:, 0] > share * total)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *arrays], names=[*keep, *added])

    return lines.mapInArrow(run, schema)
