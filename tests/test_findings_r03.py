"""What the review of round 3 found."""

import datetime
import itertools

from pyspark.sql import functions as F

from tarnlake.operators import drift, spans, stays
from tarnlake.plans import registry, storage, texts
from tarnlake.sources import adapters


def test_resampling_never_multiplies_rows(spark):
    rows = [(None if i == 4 else i % 40, i % 3, None if i % 7 == 0 or i % 3 == 2 else float(i), 1) for i in range(300)]
    per = spark.createDataFrame(rows, "k int, g int, x double, n int")
    got = drift.resampled(per, "k", ["x", "n"], ["g"], 50)
    want = drift.drawn(per, "k", 50).groupBy("g", "b").agg(F.sum(F.col("w") * F.col("x")).alias("x"), F.sum(F.col("w") * F.col("n")).alias("n"))
    same = lambda df: sorted((r["g"], r["b"], -1.0 if r["x"] is None else r["x"], float(r["n"])) for r in df.collect())
    assert same(got) == same(want)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_notes_land_as_files_of_few_folders_from_counted_tasks(spark, sf, tmp_path):
    storage._note_files(spark, sf, f"file://{tmp_path}")
    files = list((tmp_path / "in").rglob("*.txt"))
    notes = {r["note_id"]: r["note_text"] for r in adapters.note(spark, sf).where("note_text IS NOT NULL").collect()}
    assert {int(f.stem): f.read_bytes().decode() for f in files} == {i: t + "\u0001" for i, t in notes.items()}
    assert len(list((tmp_path / "in").iterdir())) <= storage.NOTE_FOLDERS


def test_tokens_of_any_note_id_keep_their_places(spark, monkeypatch):
    text = "x" * 1795 + " Maria " + "y" * 300 + " Peter 12345"
    notes = spark.createDataFrame([(i, text) for i in (-5, 7, 10**13)], "note_id long, note_text string")
    monkeypatch.setattr(texts.a, "note", lambda *_: notes)
    got = {(r["note_id"], text[r["char_start"] : r["char_end"]]) for r in texts.tx_detect_tokens(spark, "").collect()}
    assert got == {(i, w) for i in (-5, 7, 10**13) for w in ("Maria", "Peter", "12345")}


def test_shared_tables_are_shuffled_in_parts_that_follow_the_input(spark, sf, monkeypatch):
    conf, seen = "spark.sql.shuffle.partitions", []
    monkeypatch.setattr(registry, "INPUT_BYTES", max(1, sum(size for _, size, _ in registry.stamp(spark, sf)) // 50))
    build = registry.shared(lambda s, d: s.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    with monkeypatch.context() as m:
        m.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", lambda df: seen.append(spark.conf.get(conf)) or df)
        build(spark, sf)
    assert 50 <= int(seen[0]) <= 52 and spark.conf.get(conf) == "4"


def test_open_conditions_count_codes_without_sets_of_them(spark):
    day = lambda n: None if n is None else datetime.date(2000, 1, 1) + datetime.timedelta(n)
    ends = [None, *range(0, 40, 3)]
    rows = [(i % 3, "C" + str(i % 5) if i % 11 else None, day(a) if i % 13 else None, day(b)) for i, (a, b) in enumerate(itertools.product(range(0, 40, 4), ends))]
    index = [(p, n, day(3 * n + p)) for p in range(4) for n in range(14)]
    codes = [("lab_done", "C1"), ("lab_done", "C2"), ("drug_taken", "C1"), ("lab_done", "C1")]
    plan = stays.open_conditions(spark.createDataFrame(index, "patient_id int, stay_no int, admit_day date"), spark.createDataFrame(rows, "patient_id int, code string, onset_date date, resolved_date date"), spark.createDataFrame(codes, "measure string, code string"))
    got = {(r["patient_id"], r["stay_no"]): tuple(r)[2:] for r in plan.collect()}
    want = {}
    for p, n, at in index:
        held = {c for q, c, a, b in rows if p == q and c and a and a <= at and (b is None or b >= at)}
        if held:
            want[p, n] = (len(held), any(("lab_done", c) in codes for c in held), False, any(("drug_taken", c) in codes for c in held))
    assert got == want


def test_patient_spans_turn_few_notes_into_objects_at_a_time(spark):
    notes = spark.range(1201).repartition(1).select(F.col("id").alias("note_id"), (F.col("id") % 1000).alias("patient_id"), F.concat(F.lit("seen p"), F.col("id") % 1000, F.lit(" on 2000-01-02, 95 year-old")).alias("note_text"))
    values = spark.range(1000).select(F.col("id").alias("patient_id"), F.lit("name").alias("category"), F.concat(F.lit("p"), "id").alias("needle"))
    days = spark.range(1000).select(F.col("id").alias("patient_id"), F.lit("2000-01-02").cast("date").alias("day"))
    found = spans.patient_spans(notes, values, days)
    assert "MapInPandas" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.groupBy("category").count().orderBy("category").collect() == [("age", 1201), ("date", 1201), ("name", 1201)]
