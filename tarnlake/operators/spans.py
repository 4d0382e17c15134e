"""Text spans of notes: chunks, detection, scoring and redaction.

Offsets are 0-based code points, half open.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Container, Iterable, Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SPAN = "note_id long, char_start int, char_end int, category string, surface string"
SPAN_FIELDS = pa.schema([("note_id", pa.int64()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("category", pa.string()), ("surface", pa.string())])
#: Notes of a batch that are Python objects, and share an automaton, at a time; the rest of it stays in Arrow's memory.
NOTES = 500


def chunk_notes(notes: DataFrame, id: str, text: str, size: int = 2000, step: int = 1800) -> DataFrame:
    """Pieces of ``size`` characters every ``step``; a note has one piece at least, and no piece lies inside the one before."""
    last = F.greatest(F.floor((F.char_length(text) - 1) / step).cast("int"), F.lit(0))
    at = notes.select(F.col(id).alias("note_id"), F.col(text).alias("_text"), F.explode(F.sequence(F.lit(0), F.coalesce(last, F.lit(0)))).alias("chunk_index"))
    return at.select("note_id", "chunk_index", (F.col("chunk_index") * step).alias("char_start"), F.col("_text").substr(F.col("chunk_index") * step + 1, F.lit(size)).alias("chunk"))


def rebuild_notes(chunks: DataFrame, id: str, step: int = 1800) -> DataFrame:
    """Notes glued together from the first ``step`` characters of their pieces, and all of the last."""
    parts = chunks.groupBy(id).agg(F.sort_array(F.collect_list(F.struct("chunk_index", "chunk"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x, i: F.when(i == F.size("p") - 1, x["chunk"]).otherwise(F.substring(x["chunk"], 1, step))), "")
    return parts.select(id, text.alias("rebuilt"))


def merge_tokens(tokens: DataFrame) -> DataFrame:
    """A tagger's token spans of one note and kind that touch (at most one character between) become one span."""
    numbered = number_spans_by_char(tokens)
    return numbered.groupBy("note_id", "kind", "part").agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end")).drop("part")


def number_spans_by_char(tokens: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("note_id", "kind").orderBy("char_start", "char_end")
    before = F.max("char_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("char_start") <= before + 1, 0).otherwise(1)
    return tokens.withColumn("_new", new).withColumn("part", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def detect_patterns(notes: DataFrame, patterns: dict[str, str], id: str = "note_id", text: str = "note_text", shift: str | None = None) -> DataFrame:
    """Every match of every pattern, with its place; group 1 is the span if a pattern has one. Positions are what built-in functions don't give.

    ``shift`` names the column of where a row's text begins in its note; places are the note's own then.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {k: re.compile(p) for k, p in patterns.items()}
        for frame in frames:
            rows = [(i, m.start(g) + at, m.end(g) + at, k, m.group(g)) for i, t, at in zip(frame["note_id"], frame["note_text"], frame["shift"], strict=True) if t for k, p in compiled.items() for g in [1 if p.groups else 0] for m in p.finditer(t)]
            yield pd.DataFrame(rows, columns=["note_id", "char_start", "char_end", "category", "surface"])

    at = F.lit(0) if shift is None else F.col(shift).cast("int")
    return notes.select(F.col(id).cast("long").alias("note_id"), F.col(text).alias("note_text"), at.alias("shift")).mapInPandas(run, SPAN)


def find_needles(notes: DataFrame, needles: DataFrame) -> DataFrame:
    """All whole-word places of each note's own needles (``note_id, category, needle``): one pass over a note, its needles joined to it.

    A needle with several categories gives a span of each.
    """
    own = needles.where("needle <> ''").groupBy("note_id").agg(F.collect_set(F.struct("category", "needle")).alias("needles"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, ...], re.Pattern] = {}
        for frame in frames:
            rows = []
            for i, t, ns in zip(frame["note_id"], frame["note_text"], frame["needles"], strict=True):
                kinds: dict[str, list[str]] = {}
                for n in ns:
                    kinds.setdefault(n["needle"], []).append(n["category"])
                words = tuple(sorted(kinds, key=lambda n: (-len(n), n)))
                if len(known) > 1000:
                    known.clear()
                if t and words:
                    any_ = known.setdefault(words, re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)")) if words not in known else known[words]
                    rows += [(i, *m.span(), k, m.group()) for m in any_.finditer(t) for k in sorted(kinds[m.group()])]
            yield pd.DataFrame(rows, columns=["note_id", "char_start", "char_end", "category", "surface"])

    return notes.select("note_id", "note_text").join(own, "note_id").mapInPandas(run, SPAN)


MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_MONTH = "|".join(MONTHS)
#: Fixed shapes of a date in a note; one pass over the text finds them all.
DATE_SHAPE = re.compile(rf"(?<!\w)(?:(?P<y>\d{{4}})-(?P<m>\d{{2}})-(?P<d>\d{{2}})|(?P<m2>\d{{1,2}})/(?P<d2>\d{{1,2}})/(?P<y2>\d{{4}})|(?P<n3>{_MONTH}) (?P<d3>\d{{1,2}}), (?P<y3>\d{{4}})|(?P<d4>\d{{1,2}}) (?P<n4>{_MONTH}) (?P<y4>\d{{4}}))(?!\w)")
AGE = re.compile(r"\b(\d{2,3}) year-old")
OLDEST = 89


def date_forms(day: datetime.date) -> set[str]:
    """The six ways in which a day is written."""
    y, m, d, name = day.year, day.month, day.day, MONTHS[day.month - 1]
    return {f"{y:04d}-{m:02d}-{d:02d}", f"{m}/{d}/{y}", f"{m:02d}/{d:02d}/{y}", f"{name} {d}, {y}", f"{name} {d:02d}, {y}", f"{d} {name} {y}"}


def dated(m: re.Match[str]) -> datetime.date | None:
    """The day that a match of ``DATE_SHAPE`` names, if there is such a day."""
    g = m.groupdict()
    month = g["m"] or g["m2"] or MONTHS.index(g["n3"] or g["n4"]) + 1
    try:
        return datetime.date(*(int(x) for x in (g["y"] or g["y2"] or g["y3"] or g["y4"], month, g["d"] or g["d2"] or g["d3"] or g["d4"])))
    except ValueError:
        return None


class Dictionary:
    """One Aho-Corasick automaton over the needles of many owners; a text is read once, whoever it belongs to."""

    def __init__(self, owners: Iterable[Iterable[str]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for needle in {n for own in owners for n in own}:
            self.automaton.add_word(needle, needle)
        if len(self.automaton):
            self.automaton.make_automaton()

    def places(self, text: str, own: Container[str]) -> Iterator[tuple[int, int, str]]:
        """Places of the needles of ``own`` that no letter, digit or underscore touches; those of one needle don't overlap."""
        if not len(self.automaton):
            return
        last: dict[str, int] = {}
        for stop, needle in self.automaton.iter(text):
            begin, end = stop + 1 - len(needle), stop + 1
            if needle in own and begin >= last.get(needle, 0) and not (begin and _WORDY.match(text[begin - 1])) and not (end < len(text) and _WORDY.match(text[end])):
                last[needle] = end
                yield begin, end, needle


_WORDY = re.compile(r"\w")


def patient_spans(notes: DataFrame, values: DataFrame, days: DataFrame) -> DataFrame:
    """Where each note (``note_id, patient_id, note_text``) holds what its patient's tables know, by category.

    ``values`` (``patient_id, category, needle``) are found as whole words by one automaton over the needles of NOTES
    notes; a value of two categories gives a span of each. Strings that look like a date are spans if they write one of the
    patient's ``days`` (``patient_id, day``) in one of six forms; ages above 89 are. A null text or patient gives no span,
    a patient without values still has dates and ages.
    """
    own = values.where("needle <> ''").groupBy("patient_id").agg(F.collect_set(F.struct("category", "needle")).alias("needles"))
    dates = days.groupBy("patient_id").agg(F.collect_set("day").alias("days"))
    rows = notes.select("note_id", "patient_id", "note_text").join(own, "patient_id", "left").join(dates, "patient_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, NOTES):
                part = batch.slice(first, NOTES).to_pydict()
                kinds: list[dict[str, list[str]]] = []
                for ns in part["needles"]:
                    kinds.append({})
                    for n in ns or ():
                        kinds[-1].setdefault(n["needle"], []).append(n["category"])
                automaton = Dictionary(kinds)
                rows = []
                for i, t, own_kinds, own_days in zip(part["note_id"], part["note_text"], kinds, part["days"], strict=True):
                    if not t:
                        continue
                    rows += [(i, a, b, k, n) for a, b, n in automaton.places(t, own_kinds) for k in sorted(own_kinds[n])]
                    known = set(own_days or ())
                    rows += [(i, *m.span(), "date", m.group()) for m in DATE_SHAPE.finditer(t) if (day := dated(m)) in known and m.group() in date_forms(day)]
                    rows += [(i, *m.span(1), "age", m.group(1)) for m in AGE.finditer(t) if int(m.group(1)) > OLDEST]
                yield pa.RecordBatch.from_pylist([dict(zip(SPAN_FIELDS.names, r, strict=True)) for r in rows], schema=SPAN_FIELDS)

    return rows.select(F.col("note_id").cast("long").alias("note_id"), "note_text", "needles", "days").mapInArrow(run, SPAN)


REPLY = "array<struct<text: string, category: string>>"


def located(replies: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Each text that a reply (``note_id, chunk_index, char_start, chunk, reply``) names, once, with its places in the piece and a status.

    ``bad_json`` for a reply that can't be read (one row, without a text), ``not_in_note`` for a text that
    the piece doesn't hold, else ``ok``. Categories go by their aliases, in lower case where they have none.
    Places are added up from what lies between a text's occurrences, so no Python is needed.
    """
    parsed = replies.withColumn("said", F.from_json("reply", REPLY))
    items = F.when(F.col("said").isNull(), F.array(F.lit(None).cast("struct<text: string, category: string>"))).otherwise(F.array_distinct("said"))
    one = parsed.withColumn("bad", F.col("said").isNull()).withColumn("item", F.explode(items)).select("note_id", "chunk_index", F.col("char_start").alias("shift"), "chunk", "bad", "item.*")
    text = F.col("text")
    parts = F.split("chunk", F.concat(F.lit("\\Q"), text, F.lit("\\E")))
    starts = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda i: F.aggregate(F.slice("parts", 1, i), F.lit(0), lambda n, x: n + F.char_length(x)) + (i - 1) * F.char_length(text))
    out = one.withColumn("parts", parts).withColumn("starts", F.when(F.size("parts") > 1, starts))
    status = F.when(F.col("bad"), "bad_json").when(F.col("starts").isNull(), "not_in_note").otherwise("ok")
    category = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in aliases.items() for v in kv]), F.col("category")), F.lower("category"))
    return out.select("note_id", "chunk_index", "shift", "text", category.alias("category"), "starts", status.alias("status"))


def reply_spans(replies: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """``note_id, char_start, char_end, category`` of all located texts in the note's own places, each once."""
    rows = located(replies, aliases).where("status = 'ok'").withColumn("at", F.explode("starts"))
    begin = (F.col("shift") + F.col("at")).cast("int")
    return rows.select("note_id", begin.alias("char_start"), (begin + F.char_length("text")).cast("int").alias("char_end"), "category").distinct()


def score_spans(truth: DataFrame, guess: DataFrame) -> DataFrame:
    """Per stage and category: recall over distinct real spans, precision over distinct guesses, by overlap, cover and exactly; categories without real spans are kept."""
    t = truth.select("note_id", "category", F.col("char_start").alias("t_start"), F.col("char_end").alias("t_end")).distinct()
    g = guess.select("stage", "note_id", "category", "char_start", "char_end").distinct()
    meets = (F.col("char_start") < F.col("t_end")) & (F.col("t_start") < F.col("char_end"))
    pairs = g.join(t, ["note_id", "category"]).where(meets)
    real = F.struct("note_id", "t_start", "t_end")
    matched = pairs.groupBy("stage", "category").agg(
        F.count_distinct(F.struct("note_id", "char_start", "char_end")).alias("right"), F.count_distinct(real).alias("hit"),
        F.count_distinct(F.when((F.col("char_start") == F.col("t_start")) & (F.col("char_end") == F.col("t_end")), real)).alias("exact"),
        F.count_distinct(F.when((F.col("char_start") <= F.col("t_start")) & (F.col("char_end") >= F.col("t_end")), real)).alias("covered"))
    out = g.groupBy("stage", "category").agg(F.count("*").alias("guesses")).join(t.groupBy("category").agg(F.count("*").alias("reals")), "category", "left").join(matched, ["stage", "category"], "left").fillna(0, ["right"])
    share = lambda x, y: F.try_divide(F.col(x).cast("double"), F.col(y).cast("double"))
    p, r = share("right", "guesses"), share("hit", "reals")
    return out.select("stage", "category", "reals", "guesses", "right", F.round(p, 3).alias("precision"), F.round(r, 3).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 3).alias("f1"), F.round(share("exact", "reals"), 3).alias("exact_recall"), F.round(share("covered", "reals"), 3).alias("covered_recall"))


def leftmost_longest(spans: Column) -> Column:
    """Of an array of spans, those that a walk from the left keeps: the longest at a start, none that overlaps one kept."""
    by = F.array_sort(F.transform(spans, lambda s: F.struct(s["char_start"].alias("a"), (-s["char_end"]).alias("b"), s.alias("span"))), lambda x, y: F.when(x["a"] != y["a"], x["a"] - y["a"]).otherwise(x["b"] - y["b"]))
    ordered = F.transform(by, lambda x: x["span"])
    free = lambda kept, s: (F.size(kept) == 0) | (s["char_start"] >= F.element_at(kept, -1)["char_end"])
    return F.aggregate(ordered, F.filter(ordered, lambda s: F.lit(False)), lambda kept, s: F.when((F.size(kept) == 0), F.array(s)).when(free(F.when(F.size(kept) == 0, F.array(s)).otherwise(kept), s), F.concat(kept, F.array(s))).otherwise(kept))


def redact(notes: DataFrame, spans: DataFrame, shift_days: Column) -> DataFrame:
    """Notes with their spans replaced: ISO dates moved by the note's days, other dates ``[DATE]``, ages ``90+``, all else ``[NAME]``.

    Fails if a span's recorded text is not what the note has there. Native: a fold over the
    sorted spans builds the text from the pieces between them.
    """
    own = spans.groupBy("note_id").agg(F.collect_set(F.struct("char_start", "char_end", "category", "surface")).alias("_s"))
    rows = notes.withColumn("_shift", shift_days).join(own, "note_id", "left").withColumn("_k", leftmost_longest(F.coalesce("_s", F.array().cast("array<struct<char_start:int,char_end:int,category:string,surface:string>>"))))
    text = F.col("note_text")
    moved = lambda s: F.when(s["category"] == "date", F.coalesce(F.date_format(F.date_add(F.when(s["surface"].rlike(r"^\d{4}-\d{2}-\d{2}$"), s["surface"]).try_cast("date"), F.col("_shift")), "yyyy-MM-dd"), F.lit("[DATE]"))).when(s["category"] == "age", "90+").otherwise("[NAME]")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        good = text.substr(s["char_start"] + 1, s["char_end"] - s["char_start"]) == s["surface"]
        piece = F.concat(acc["out"], text.substr(acc["at"] + 1, s["char_start"] - acc["at"]), moved(s))
        return F.struct(F.when(good, piece).otherwise(F.raise_error(F.lit("a span does not match its note"))).alias("out"), s["char_end"].alias("at"))

    done = F.aggregate("_k", start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.char_length(text))))
    return rows.select("note_id", done.alias("note_text"))
