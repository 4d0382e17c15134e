"""Quality scores from document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.boost import Boosted, fit_boosted
from tarnlake.llm.labelled import sample_documents
from tarnlake.llm.scratch import importable
from tarnlake.llm.words import lower, shingle_hashes, span_hashes, text_runs, word_spans

#: Documents of either label to learn from, at most.
LEARN_DOCS = 10_000
#: Groups of byte values whose shares are features.
BYTES: dict[str, bytes] = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "space": b" ", "line": b"\n\r", "tab": b"\t\x0b\x0c",
    "other_language": bytes(range(128, 256)), "stop": b".", "comma": b",", "shout": b"!?", "bar": b"|", "hash": b"#", "percent": b"%", "and": b"&", "dollar": b"$",
    "star": b"*", "quote": b"\"'`", "bracket": b"()[]{}<>", "rest": b"+-/:;=@\\^_~", "control": bytes([*range(9), *range(14, 32), 127]),
}
NAMES = ["log_bytes", "log_words", "word_bytes", "long_word", "distinct_words", "top_word", "distinct_runs", "top_run", "log_lines", "distinct_lines", "top_line", "line_bytes", "entropy", *BYTES]


def _repeats(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: number of hashes, share that is distinct, share of the most frequent."""
    n = np.bincount(row, minlength=rows)
    order = np.lexsort((h, row))
    r, s = row[order], h[order]
    new = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1])]) if len(r) else np.zeros(0, np.int64)
    size = np.diff(np.r_[new, len(r)])
    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, r[new], size)
    some = np.maximum(n, 1)
    return n, np.bincount(r[new], minlength=rows) / some, top / some


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features NAMES of every whole text in ``data``; an empty text has zeros."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    some = np.maximum(size, 1)
    of = np.repeat(np.arange(rows), size)
    hist = np.bincount(of * 256 + data, minlength=rows * 256).reshape(rows, 256)
    share = hist / some[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    small = lower(data)
    row, starts, ends = word_spans(data, offsets)
    words = span_hashes(small, starts, ends)
    n_words, distinct_words, top_word = _repeats(row, words, rows)
    longest = np.zeros(rows, dtype=np.int64)
    np.maximum.at(longest, row, ends - starts)
    run_row, _, runs = shingle_hashes(row, words, 3)
    _, distinct_runs, top_run = _repeats(run_row, runs, rows)
    cut = np.unique(np.r_[offsets, np.flatnonzero(data == 10) + 1])
    line_start, line_end = cut[:-1], cut[1:]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    n_lines, distinct_lines, top_line = _repeats(line_row, span_hashes(small, line_start, line_end), rows)
    total = np.bincount(row, weights=ends - starts, minlength=rows)
    groups = [hist[:, list(b)].sum(axis=1) / some for b in BYTES.values()]
    columns = [np.log1p(size), np.log1p(n_words), total / np.maximum(n_words, 1), longest, distinct_words, top_word, distinct_runs, top_run, np.log1p(n_lines), distinct_lines, top_line, size / np.maximum(n_lines, 1), entropy, *groups]
    return np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)


def document_statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the array ``features`` of every whole text."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([np.zeros((0, len(NAMES))), *(statistics(data, offsets) for _, data, offsets in text_runs(batch["text"]))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(NAMES)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], ["doc_id", "features"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, features array<double>")


def learn_quality(docs: DataFrame, labels: DataFrame, learn: Column, most: int = LEARN_DOCS) -> Boosted:
    """Fit on at most ``most`` learning documents of either label (the documented bound), from all of their text."""
    sample = sample_documents(docs, labels, "quality", learn, most).select("doc_id", "label", "text")
    ids = {x["doc_id"]: x["label"] for x in sample.select("doc_id", "label").collect()}
    found = sorted((x["doc_id"], *x["features"]) for x in document_statistics(sample).collect())
    x = np.array([f[1:] for f in found]).reshape(len(found), len(NAMES))
    return fit_boosted(x, np.array([ids[f[0]] for f in found], dtype=float))


def score_quality(docs: DataFrame, model: Boosted, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text; a null text counts as empty.

    Only ``id`` and ``text`` are read. Repeated rows are scored each; an empty table gives no rows.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.probability(statistics(data, offsets)) for _, data, offsets in text_runs(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.concatenate(found or [np.zeros(0)]))], ["doc_id", "score"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


