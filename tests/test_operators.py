"""Rules of the operators on small rows of their own."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import columns as c
from tarnlake.functions import ranks
from tarnlake.operators import modelling, privacy, quality, retraining, spans, stays
from tarnlake.sources import sinks
from tarnlake.streaming import ingest


def day(s):
    return dt.date.fromisoformat(s)


def test_nested_short_span_does_not_split(spark):
    rows = [("p", day("2020-01-01"), day("2020-01-20"), 1), ("p", day("2020-01-03"), day("2020-01-04"), 2), ("p", day("2020-01-10"), day("2020-01-12"), 3), ("p", day("2020-01-21"), day("2020-01-22"), 4)]
    df = spark.createDataFrame(rows, "k string, a date, b date, id int")
    got = {r["id"]: r["n"] for r in stays.number_spans(df, ["k"], "a", "b", ["a", "id"], "n").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 2}


def test_return_window_edges(spark):
    rows = [(1, 1, day("2020-01-01"), day("2020-01-02"), False), (1, 2, day("2020-02-01"), day("2020-02-02"), False), (2, 1, day("2020-01-01"), day("2020-01-02"), False), (2, 2, day("2020-02-02"), day("2020-02-03"), False), (3, 1, day("2020-01-01"), day("2020-01-02"), False), (3, 2, day("2020-01-10"), day("2020-01-11"), True)]
    df = spark.createDataFrame(rows, "patient_id int, stay_no int, admit_day date, discharge_day date, is_planned boolean")
    assert [(r["patient_id"], r["days_to_unplanned_return"]) for r in stays.unplanned_returns(df).collect()] == [(1, 30)]


def test_null_rule_is_a_violation(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -1)], "id int, v int")
    good, bad = quality.quarantine(df, {"positive": F.col("v") > 0})
    assert [r["id"] for r in good.collect()] == [2]
    assert {r["id"]: r["violations"] for r in bad.collect()} == {1: ["positive"], 3: ["positive"]}
    with pytest.raises(ValueError, match="positive"):
        quality.enforce(df, {"positive": F.col("v") > 0})


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert tuple(quality.reconcile(a, b).first()) == (3, 3, 1, 1)


def test_wilson_and_shown(spark):
    low, high = c.wilson(F.col("k"), F.col("n"))
    rows = spark.createDataFrame([(0, 0), (5, 10)], "k int, n int").select(low.alias("l"), high.alias("h"), c.shown(F.col("n"), F.col("k")).alias("s")).collect()
    assert (rows[0]["l"], rows[0]["h"], rows[0]["s"]) == (0.0, 1.0, 0)
    assert rows[1]["l"] == pytest.approx(0.2366, abs=1e-4) and rows[1]["s"] is None


def test_lone_hidden_level_takes_another(spark):
    rows = [("s", "a", 5, 0, True), ("s", "b", 40, 20, False), ("s", "other", 60, 30, False)]
    df = spark.createDataFrame(rows, "signal string, level string, index_stays long, readmitted long, suppressed boolean")
    df = df.withColumn("rest_stays", F.lit(105) - F.col("index_stays")).withColumn("rest_readmitted", F.lit(50) - F.col("readmitted"))
    assert {r["level"]: r["suppressed"] for r in privacy.complementary(df).collect()} == {"a": True, "b": False, "other": True}


def test_secondary_hides_the_smallest_others(spark):
    df = spark.createDataFrame([("g", m, n) for m, n in [("a", 3), ("b", 20), ("c", 20), ("d", 50)]], "g string, m string, n long")
    got = {r["m"]: r["hidden"] for r in privacy.secondary(df, "g", "n", "m").collect()}
    assert got["a"] and got["b"] and not got["d"]


def test_redaction(spark):
    text = "Ann met Bo on 2020-01-30 or 5/1/20, aged 95."
    notes = spark.createDataFrame([(1, text), (2, "plain")], "note_id long, note_text string")
    place = lambda t, k: (1, text.index(t), text.index(t) + len(t), k, t)
    found = spark.createDataFrame([place("Ann", "name"), place("2020-01-30", "date"), place("5/1/20", "date"), place("95", "age")], spans.SPAN)
    got = {r["note_id"]: r["note_text"] for r in spans.redact(notes, found, F.lit(3)).collect()}
    assert got == {1: "[NAME] met Bo on 2020-02-02 or [DATE], aged 90+.", 2: "plain"}
    wrong = spark.createDataFrame([(1, 0, 3, "name", "Bob")], spans.SPAN)
    with pytest.raises(Exception, match="does not match"):
        spans.redact(notes, wrong, F.lit(3)).collect()


def test_deid_keys_are_stable_and_only_new(spark):
    p = spark.createDataFrame([(i,) for i in range(50)], "patient_id long")
    none = p.limit(0)
    a = {r["patient_id"]: r for r in privacy.deid_keys(p, none, "s").collect()}
    b = {r["patient_id"]: r for r in privacy.deid_keys(p, p.where("patient_id < 25"), "s").collect()}
    assert len({r["deid_id"] for r in a.values()}) == 50 and all(1 <= r["offset_days"] <= 364 for r in a.values())
    assert set(b) == set(range(25, 50)) and all(a[k] == b[k] for k in b)


def test_quantiles_and_places_without_one_task(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=3000), np.full(2000, 0.5)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(9999, None)], "i int, x double")
    got = ranks.quantiles(df, F.col("x"), [0.0, 0.1, 0.5, 0.77, 1.0]).first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(x, [0.0, 0.1, 0.5, 0.77, 1.0])), abs=1e-12)
    placed = ranks.numbered(df, [F.asc_nulls_last("x"), F.asc("i")], F.col("x"), "r").collect()
    want = {i: r for r, (_, i) in enumerate(sorted([(float(v), i) for i, v in enumerate(x)] + [(float("inf"), 9999)]), 1)}
    assert {r["i"]: r["r"] for r in placed} == want


def test_frequent_categories_have_no_cap(spark):
    rows = spark.range(1200 * 20).select((F.col("id") % 1200).cast("string").alias("gender"), F.lit("r").alias("admit_reason"))
    assert len(modelling.frequent(rows)["gender"]) == 1200


def test_results_match_within_a_tolerance_whatever_the_grid(spark):
    a = spark.createDataFrame([("X", 1.004), ("y", 2.0), ("y", None)], "k string, v double")
    same = spark.createDataFrame([(2.003, "Y ", 7), (1.006, "x", 8), (None, "y", 9)], "v double, k string, more int")
    other = spark.createDataFrame([(2.003, "Y"), (1.02, "x"), (None, "y")], "v double, k string")
    assert quality.same_results(a, same).first()["same"] and not quality.same_results(a, other).first()["same"]


def test_events_are_counted_within_stays(spark):
    rows = [(1, 1, day("2020-01-05"), day("2020-01-08")), (1, 2, day("2020-01-09"), day("2020-01-09")), (2, 1, day("2020-01-05"), day("2020-01-08"))]
    df = spark.createDataFrame(rows, "patient_id int, stay_no int, admit_day date, discharge_day date")
    events = spark.createDataFrame([(1, day("2020-01-08"), "x"), (1, day("2020-01-04"), "x"), (1, day("2020-01-03"), "x"), (3, day("2020-01-05"), "x"), (2, None, "x")], "patient_id int, day date, tag string")
    got = {(r["patient_id"], r["stay_no"]): r["x"] for r in stays.count_within(df, events, {"x": (F.date_sub("admit_day", 1), F.col("discharge_day"))}).collect()}
    assert got == {(1, 1): 2, (1, 2): 1, (2, 1): 0}


def test_history_refuses_a_date_twice(spark, tmp_path):
    decided = spark.createDataFrame([(day("2020-01-01"), "keep"), (day("2021-01-01"), "retrain")], "as_of date, action string")
    path = str(tmp_path / "h")
    log = retraining.replay(spark, decided, ["2020-01-01"], path, "2021-01-01").orderBy("step").collect()
    assert [(r["mode"], r["action"]) for r in log] == [("replay", "keep"), ("live", "retrain")]
    with pytest.raises(ValueError, match="decided before"):
        retraining.replay(spark, decided, ["2020-01-01"], path, "2021-01-01")
    with pytest.raises(ValueError, match="in order"):
        retraining.replay(spark, decided, ["2021-01-01"], path, "2020-01-01")


def test_a_needle_of_two_categories_gives_two_spans(spark):
    notes = spark.createDataFrame([(1, "Ann saw Ann, not Annie")], "note_id long, note_text string")
    needles = spark.createDataFrame([(1, "name", "Ann"), (1, "place", "Ann"), (1, "name", "")], "note_id long, category string, needle string")
    assert sorted((r["char_start"], r["category"]) for r in spans.find_needles(notes, needles).collect()) == [(0, "name"), (0, "place"), (8, "name"), (8, "place")]


def test_leak_guard():
    with pytest.raises(ValueError, match="outcome_x"):
        modelling.guarded(["age_at_admit", "outcome_x"])


def test_streams_read_a_file_once(spark, tmp_path):
    land, out = tmp_path / "in", str(tmp_path / "out")
    land.mkdir()
    (land / "a.csv").write_text("Id,NAME\n1,x\n2,y\n")
    run = lambda: ingest.ingest_csv(spark, str(land), ["Id", "NAME"], out, str(tmp_path / "cp"), "b1")
    run()
    assert spark.read.parquet(out).count() == 2
    (land / "b.csv").write_text("Id,NAME\n3,z\n")
    run()
    run()
    rows = spark.read.parquet(out)
    assert rows.count() == 3 and {f.dataType.simpleString() for f in rows.schema.fields if f.name in ("Id", "NAME")} == {"string"}


def test_partition_replacement(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    sinks.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, "p")
    assert sorted((r["v"], r["p"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]
