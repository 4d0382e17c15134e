"""Toxicity by compression distance: windows cost less under a dictionary of toxic text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tarnlake.llm.boost import Boosted, fit_boosted
from tarnlake.llm.labelled import fit_in_a_task, sample_documents
from tarnlake.llm.scratch import importable
from tarnlake.llm.words import distinct_sorted, lower, shingle_hashes, span_hashes, text_runs, word_hashes, word_spans

#: Documents of either label to learn from, at most.
LEARN_DOCS = 2000
#: Bytes of the ordinary dictionary and, at most, of what is toxic in the other.
ORDINARY_BYTES, TOXIC_BYTES = 6144, 4096
LEVEL, GRAM, LONGEST, MANY, MOST_GAIN, STORE_WORDS = 9, 4, 9, 6, 12, 500_000
#: A count is no chance when its Poisson log likelihood ratio is so large.
UNLIKELY = 15.0
#: Classes of a gain for its window's length.
COVERS = 4
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicityModel:
    """Two raw-content dictionaries of equal length and layout, and what gains say."""

    toxic: bytes
    ordinary: bytes
    evidence: np.ndarray  # log odds of a window by its kind: gain, and gain for its length
    thresholds: Boosted | None  # over what a document's windows say
    base: float  # share of toxic documents learned from; the score of texts without windows

    def kinds(self) -> Callable[[list[bytes]], np.ndarray]:
        """Kinds of windows, by the bytes that the toxic dictionary saves over the ordinary one."""
        same = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
        if not self.toxic:
            return lambda windows: np.zeros(len(windows), dtype=np.int64)
        a, b = (zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), **same).multi_compress_to_buffer for d in (self.ordinary, self.toxic))

        # The compressor leaves the last bytes of its input unmatched and keeps what it can't shrink as it is; the frame keeps a window clear of both.
        def kinds(windows: list[bytes]) -> np.ndarray:
            out = []
            for part in range(0, len(windows), 20_000):
                some = windows[part : part + 20_000]
                framed = [b"\x02" * 24 + b" " + w + b" " + b"\x02" * 16 for w in some]
                one, two = (np.fromiter(map(len, f(framed)), dtype=np.int64, count=len(framed)) for f in (a, b))
                gain = np.clip(one - two, 0, MOST_GAIN)
                size = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
                out.append(gain * COVERS + np.minimum(gain * COVERS // (size + 1), COVERS - 1))
            return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)

        return kinds

    def scores(self, data: np.ndarray, offsets: np.ndarray, kinds_of: Callable[[list[bytes]], np.ndarray], known: dict[int, int]) -> np.ndarray:
        """Scores of the texts in ``data``; a window is a word, and equal windows are compressed once."""
        data = lower(data)
        row, starts, ends = word_spans(data, offsets)
        if not len(starts):
            return np.full(len(offsets) - 1, self.base)
        hashes, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(known) + len(hashes) > STORE_WORDS:
            known.clear()
        raw = data.tobytes()
        keys = hashes.tolist()
        new = [(h, i) for h, i in zip(keys, first.tolist(), strict=True) if h not in known]
        known.update(zip([h for h, _ in new], kinds_of([raw[starts[i] : ends[i]] for _, i in new]).tolist(), strict=True))
        kinds = np.fromiter((known[h] for h in keys), dtype=np.int64, count=len(keys))[inverse]
        found = window_statistics(row, self.evidence[kinds], len(offsets) - 1)
        if self.thresholds is None:
            return np.full(len(found), self.base)
        return np.where(np.bincount(row, minlength=len(found)) > 0, self.thresholds.probability(found), self.base)


def window_statistics(row: np.ndarray, evidence: np.ndarray, rows: int) -> np.ndarray:
    """Per row: the evidence of its windows in all, on average, and of its three strongest."""
    n = np.bincount(row, minlength=rows)
    total = np.bincount(row, weights=evidence, minlength=rows)
    order = np.lexsort((-evidence, row))
    start = np.cumsum(n) - n
    top = np.zeros((rows, 3))
    for k in range(3):
        has = n > k
        top[has, k] = evidence[order[start[has] + k]]
    return np.c_[total, total / np.maximum(n, 1), top.cumsum(axis=1), (top > 1).sum(axis=1)]


def _stretches(word: str) -> list[tuple[int, int]]:
    """Candidates in a word, a space before it: its beginnings of up to LONGEST characters and all runs of GRAM letters."""
    n = len(word) + 1
    return [(0, e) for e in range(GRAM, min(n, LONGEST) + 1)] + [(i, i + GRAM) for i in range(1, n - GRAM + 1)]


def _typical(toxic: list[str], ordinary: list[str]) -> set[str]:
    """Stretches in many times more toxic than ordinary documents, and more than chance would give."""

    def documents_with(texts: list[str], wanted: dict[str, int] | None) -> Counter:
        found: Counter = Counter()
        for text in texts:
            here = {f" {w}"[s:e] for w in set(_LETTERS.findall(text.lower())) for s, e in _stretches(w)}
            found.update(here if wanted is None else here & wanted.keys())
        return found

    a = {g: n for g, n in documents_with(toxic, None).items() if n >= 4}
    b = documents_with(ordinary, a)
    each = len(toxic) / len(ordinary)

    def stands_out(n: int, due: float) -> bool:
        return n >= MANY * due and n * np.log(n / due) - (n - due) >= UNLIKELY

    return {g for g, n in a.items() if stands_out(n, each * (b[g] + 1))}


def _toxic_content(toxic: list[str], typical: set[str]) -> bytes:
    """What typical stretches cover of toxic words: a dictionary's content, frequent ones nearest."""
    spans: Counter = Counter()
    for text in toxic:
        for word in _LETTERS.findall(text.lower()):
            covered = np.zeros(len(word) + 3, dtype=bool)
            for s, e in _stretches(word):
                if f" {word}"[s:e] in typical:
                    covered[s + 1 : e + 1] = True
            edges = np.flatnonzero(covered[1:] != covered[:-1]).tolist()
            for s, e in zip(edges[::2], edges[1::2], strict=True):
                spans[f" {word}"[s:e]] += 1
    content = b""
    for span, _ in spans.most_common():
        if len(content) + len(span.encode()) > TOXIC_BYTES:
            break
        content = span.encode() + content
    return content


def _unlike(texts: list[str]) -> list[int]:
    """Indexes of texts of which at least half of the runs of four words occur in no earlier one."""
    if not texts:
        return []
    found = []
    for first, data, offsets in text_runs(pa.array(texts, pa.string())):
        row, _, h = shingle_hashes(*word_hashes(data, offsets), 4)
        row, h = distinct_sorted(row, h)
        found.append((row + first, h))
    row, h = (np.concatenate(x) for x in zip(*found, strict=True))
    new = np.bincount(row[np.unique(h, return_index=True)[1]], minlength=len(texts))
    runs = np.bincount(row, minlength=len(texts))
    return np.flatnonzero((2 * new >= runs) & ((runs > 0) | (np.arange(len(texts)) == 0))).tolist()


def fit_toxicity(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Train both dictionaries, then calibrate the evidence of each kind of window and thresholds over a document's windows.

    Copies would pass for many documents, so texts are dropped that mostly repeat earlier ones.
    """
    kept = _unlike(texts)
    texts, labels = [texts[i] for i in kept], [labels[i] for i in kept]
    toxic = [t or "" for t, y in zip(texts, labels, strict=True) if y]
    ordinary = [t or "" for t, y in zip(texts, labels, strict=True) if not y]
    base = len(toxic) / max(1, len(texts))
    kinds = (MOST_GAIN + 1) * COVERS
    none = ToxicityModel(b"", b"", np.zeros(kinds), None, base)
    if not toxic or not ordinary:
        return none
    content = _toxic_content(toxic, _typical(toxic, ordinary))
    if not content:
        return none
    samples = [p for t in ordinary for p in re.findall(rb"(?s).{1,60}", t.lower().encode())]
    try:
        shared = zstandard.train_dictionary(ORDINARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: take it as it is
        shared = b" ".join(samples)[-ORDINARY_BYTES:]
    # The toxic stretches take the place of bytes that no text holds, so all else lies at the same distance in both.
    model = ToxicityModel(content + shared, b"\x01" * len(content) + shared, np.zeros(kinds), None, base)
    kinds_of_words = model.kinds()
    known: dict[bytes, int] = {}
    kinds_of = []
    for text in texts:
        words = (text or "").lower().encode().split()
        new = [w for w in set(words) if w not in known]
        known.update(zip(new, kinds_of_words(new).tolist(), strict=True))
        kinds_of.append(np.fromiter((known[w] for w in words), dtype=np.int16, count=len(words)))
    row = np.repeat(np.arange(len(texts)), [len(k) for k in kinds_of])
    found = np.concatenate(kinds_of).astype(np.int64)
    y = np.array(labels, dtype=float)
    counts = np.stack([np.bincount(found[y[row] == v], minlength=kinds) for v in (0, 1)]).astype(float)
    share = (counts + 0.5 * counts.sum(axis=1, keepdims=True) / counts.sum()) / (counts.sum(axis=1, keepdims=True) + 1)
    evidence = np.clip(np.log(share[1] / share[0]), -1, 8)
    thresholds = fit_boosted(window_statistics(row, evidence[found], len(texts)), y, trees=40, depth=2, rate=0.2, least=2.0)
    return ToxicityModel(model.toxic, model.ordinary, evidence, thresholds, base)


def learn_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, most: int = LEARN_DOCS) -> ToxicityModel:
    """Fit on at most ``most`` learning documents of either label, of at most LEARN_BYTES (the documented bound); all of their text is used."""
    return fit_in_a_task(sample_documents(docs, labels, "toxic", learn, most), fit_toxicity)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; null and empty texts score the base rate.

    Only ``id`` and ``text`` are read. Repeated rows are scored each; an empty table gives no rows.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, known = model.kinds(), {}
        for batch in batches:
            found = [model.scores(data, offsets, gain, known) for _, data, offsets in text_runs(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate(found or [np.zeros(0)]))], ["doc_id", "score"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def with_toxicity(docs: DataFrame, model: ToxicityModel, out: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and their score as the new column ``out``, a name that ``docs`` doesn't have."""
    importable(docs.sparkSession)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, known = model.kinds(), {}
        for batch in batches:
            found = [model.scores(data, offsets, gain, known) for _, data, offsets in text_runs(batch[text])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found or [np.zeros(0)]))], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)
