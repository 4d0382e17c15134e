"""Quality rules as a short-circuit cascade: the rule that rejects most per cost comes first, and what it rejects isn't looked at again."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tarnlake.llm.scratch import free_name, importable
from tarnlake.llm.words import shingle_hashes, span_hashes, text_runs, word_spans

#: Documents on which costs and selectivities are estimated, about.
SAMPLE_DOCS = 2_000
#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))


@dataclass
class Texts:
    """Some whole texts with the statistics worked out for them so far; every statistic is made at its first use."""

    data: np.ndarray
    offsets: np.ndarray
    made: dict[str, np.ndarray] = field(default_factory=dict)
    cost: dict[str, float] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def get(self, name: str) -> np.ndarray:
        if name not in self.made:
            for other in NEEDS.get(name, ()):
                self.get(other)
        if name not in self.made:
            began = time.thread_time()
            self.made |= MAKERS[name](self)
            self.cost[name] = self.cost.get(name, 0.0) + time.thread_time() - began
        return self.made[name]

    def only(self, rows: np.ndarray) -> Texts:
        """These rows alone; what counts per row is kept, what lies along the texts is cut with them."""
        if len(rows) == len(self):
            return self
        size = np.diff(self.offsets)[rows]
        offsets = np.r_[0, np.cumsum(size)]
        at = np.repeat(self.offsets[rows] - offsets[:-1], size) + np.arange(offsets[-1])
        out = Texts(self.data[at], offsets, {k: v[rows] for k, v in self.made.items() if k in PER_ROW}, self.cost)
        if "_word" in self.made:  # (row, start, end) of words, moved to where the rows' bytes are now
            row, start, end = self.made["_word"]
            place = np.full(len(self), -1)
            place[rows] = np.arange(len(rows))
            has = place[row] >= 0
            shift = (offsets[:-1] - self.offsets[rows])[place[row[has]]]
            out.made["_word"] = np.stack([place[row[has]], start[has] + shift, end[has] + shift])
        return out


def _words(t: Texts) -> dict[str, np.ndarray]:
    return {"_word": np.stack(word_spans(t.data, t.offsets))}


def _n_words(t: Texts) -> dict[str, np.ndarray]:
    return {"n_words": np.bincount(t.made["_word"][0], minlength=len(t))}


def _word_chars(t: Texts) -> dict[str, np.ndarray]:
    """Code points: bytes that don't continue one."""
    row, start, end = t.made["_word"]
    upto = np.r_[0, np.cumsum((t.data & 0xC0) != 0x80)]
    return {"word_chars": np.bincount(row, weights=upto[end] - upto[start], minlength=len(t)).astype(np.int64)}


def _n_symbols(t: Texts) -> dict[str, np.ndarray]:
    upto = np.r_[0, np.cumsum(_SYMBOL[t.data])]
    return {"n_symbols": np.diff(upto[t.offsets])}


def _lines(t: Texts) -> dict[str, np.ndarray]:
    """Lines that hold a word, and how many of them repeat an earlier one of their text."""
    cut = np.unique(np.r_[t.offsets, np.flatnonzero(t.data == 10) + 1])
    start, end = cut[:-1], cut[1:].copy()
    end -= t.data[end - 1] == 10 if len(end) else 0
    word_start = t.made["_word"][1]
    has = np.searchsorted(word_start, end) > np.searchsorted(word_start, start)
    start, end = start[has], end[has]
    row = np.searchsorted(t.offsets, start, side="right") - 1
    h = span_hashes(t.data, start, end)
    order = np.lexsort((h, row))
    again = (row[order][1:] == row[order][:-1]) & (h[order][1:] == h[order][:-1])
    return {"n_lines": np.bincount(row, minlength=len(t)), "n_dup_lines": np.bincount(row[order][1:][again], minlength=len(t))}


def _n_repeat_words(t: Texts) -> dict[str, np.ndarray]:
    """Words in windows of three that the text holds twice or more, the first one included."""
    row, start, end = t.made["_word"]
    of, at, h = shingle_hashes(row, span_hashes(t.data, start, end), 3, whole=False)
    order = np.lexsort((h, of))
    same = (of[order][1:] == of[order][:-1]) & (h[order][1:] == h[order][:-1])
    twice = np.zeros(len(of), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(row) + 3, dtype=np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + 3, -1)
    inside = np.cumsum(edge)[: len(row)] > 0
    return {"n_repeat_words": np.bincount(row[inside], minlength=len(t))}


MAKERS: dict[str, Callable[[Texts], dict[str, np.ndarray]]] = {"_word": _words, "n_words": _n_words, "word_chars": _word_chars, "n_symbols": _n_symbols, "n_lines": _lines, "n_repeat_words": _n_repeat_words}
#: Statistics that must be there before another is made.
NEEDS = {"n_words": ("_word",), "word_chars": ("_word",), "n_lines": ("_word",), "n_dup_lines": ("_word", "n_lines"), "n_repeat_words": ("_word",)}
PER_ROW = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``test`` of the statistics ``uses`` (arrays of whole numbers) is true."""

    name: str
    uses: tuple[str, ...]
    test: Callable[..., np.ndarray]


#: Too few words, and more than half of the words in repeated runs.
BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
)
#: Limits in common use for web text: mean word length, symbols a word, lines that repeat.
RULES = (
    *BASE,
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 14 * n)),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > 2 * n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
)


def _parts(rules: tuple[Rule, ...]) -> list[str]:
    """All statistics that rules use, what they need first."""
    out: list[str] = []
    for r in rules:
        for name in r.uses:
            out += [x for x in (*NEEDS.get(name, ()), name) if x not in out]
    return out


def measure_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE_DOCS, seed: int = 11) -> tuple[dict[int, int], dict[str, float]]:
    """Of about ``sample`` documents: how many break which rules together, and each statistic's CPU seconds.

    A document is drawn with the same small chance wherever it lies. Only sets of broken rules (bits) with their
    counts and one sum for each statistic come back, at most one row a task and set.
    """
    importable(docs.sparkSession)
    rows = docs.count()
    drawn = docs.select(F.col(text).cast("string").alias("text"))
    if rows > sample:
        drawn = drawn.where(F.rand(seed) < sample / rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        broken: dict[int, int] = {}
        cost: dict[str, float] = {}
        for batch in batches:
            for _, data, offsets in text_runs(batch["text"]):
                t = Texts(data, offsets)
                bits = np.zeros(len(t), dtype=np.int64)
                for i, r in enumerate(rules):
                    bits |= r.test(*(t.get(x) for x in r.uses)).astype(np.int64) << i
                for b, n in zip(*np.unique(bits, return_counts=True), strict=True):
                    broken[int(b)] = broken.get(int(b), 0) + int(n)
                for k, v in t.cost.items():
                    cost[k] = cost.get(k, 0.0) + v
        yield pa.RecordBatch.from_arrays([pa.array([str(b) for b in broken] + list(cost), pa.string()), pa.array([float(n) for n in broken.values()] + list(cost.values()), pa.float64())], ["what", "value"])

    found = {r["what"]: r["value"] for r in drawn.mapInArrow(run, "what string, value double").groupBy("what").agg(F.sum("value").alias("value")).collect()}
    return {int(k): int(v) for k, v in found.items() if k.isdigit()}, {k: v for k, v in found.items() if not k.isdigit()}


def order_rules(broken: dict[int, int], cost: dict[str, float], rules: tuple[Rule, ...] = RULES) -> list[int]:
    """Places of ``rules`` in the order that a cascade asks them.

    Next comes the rule that rejects most of the sample's texts that are left, per second of the statistics
    which no earlier rule has made; so a rule whose statistics are there is nearly free, and one that only rejects
    what others did comes late. Ties, and rules that reject nothing more, go by cost and then as given.
    """
    left, made, out = dict(broken), set(), []
    todo = list(range(len(rules)))
    while todo:
        def rate(i: int) -> tuple[float, float, int]:
            price = 1e-9 + sum(cost.get(x, 0.0) for x in _parts((rules[i],)) if x not in made)
            return -sum(n for b, n in left.items() if b >> i & 1) / price, price, i

        best = min(todo, key=rate)
        out.append(best)
        todo.remove(best)
        made |= set(_parts((rules[best],)))
        left = {b: n for b, n in left.items() if not b >> best & 1}
    return out


def rule_cascade(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, order: list[int] | None = None, whole: bool = False) -> DataFrame:
    """``doc_id, kept, rejected_by, asked`` and the statistics of every whole text.

    ``rejected_by`` is the first rule of the cascade that a text breaks (null: none) and ``asked`` the number of
    rules that looked at it. Statistics that no rule came to ask for are null, unless ``whole`` has them made in the
    end. The order is estimated on a sample (see ``measure_rules``) if none is given; it changes costs,
    ``rejected_by`` and ``asked``, never ``kept``, so reruns agree on what stays. One pass, no shuffle.
    A null text counts as empty: no words, no lines. Ids aren't looked at: null and repeated ones have their rows.
    Other columns are ignored; an empty table gives no rows.
    """
    importable(docs.sparkSession)
    if order is None:
        order = order_rules(*measure_rules(docs, text, rules), rules)
    uses = [x for x in PER_ROW if x in _parts(rules)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [_cascaded(data, offsets, rules, order, uses, whole) for _, data, offsets in text_runs(batch["text"])]
            if runs:
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.concat_arrays(c) for c in zip(*runs, strict=True))], ["doc_id", "kept", "rejected_by", "asked", *uses])

    schema = StructType([StructField("doc_id", docs.schema[id].dataType), StructField("kept", BooleanType()), StructField("rejected_by", StringType()), StructField("asked", IntegerType()), *(StructField(x, LongType()) for x in uses)])
    return docs.select(F.col(id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def _cascaded(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...], order: list[int], uses: list[str], whole: bool) -> list[pa.Array]:
    n = len(offsets) - 1
    verdict, asked = np.full(n, -1), np.zeros(n, dtype=np.int32)
    found = {x: (np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)) for x in uses}

    def note(t: Texts, rows: np.ndarray) -> None:
        for x in uses:
            if x in t.made:
                found[x][0][rows], found[x][1][rows] = t.made[x], True

    left, t = np.arange(n), Texts(data, offsets)
    gone: list[tuple[np.ndarray, Texts]] = []
    for i in order:
        bad = rules[i].test(*(t.get(x) for x in rules[i].uses))
        asked[left] += 1
        if bad.any():
            verdict[left[bad]] = i
            out, stay = np.flatnonzero(bad), np.flatnonzero(~bad)
            gone.append((left[out], t.only(out)))
            left, t = left[stay], t.only(stay)
    for rows, part in [*gone, (left, t)]:
        if whole:
            for x in uses:
                part.get(x)
        note(part, rows)
    names = np.array([*(r.name for r in rules), None], dtype=object)
    return [pa.array(verdict < 0), pa.array(names[verdict], pa.string()), pa.array(asked, pa.int32()), *(pa.array(v, pa.int64(), mask=~has) for v, has in found.values())]


def judged(docs: DataFrame, cascade: Callable[[DataFrame], DataFrame] = rule_cascade) -> DataFrame:
    """``docs`` without the rows that the cascade rejects, all of their columns as they were."""
    row = free_name(docs, "row")
    numbered = docs.withColumn(row, F.struct(*docs.columns))
    return cascade(numbered.select(F.col(row).alias("doc_id"), "text")).where("kept").select("doc_id.*")


def broke_base(n_words: Column, n_repeat_words: Column) -> Column:
    """The two base rules as a column."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)
