"""Redaction, stored models, grouped fits, grading, refreshed views and widening ingestion on rows of their own."""

import collections
import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.functions import ranks
from tarnlake.operators import bayes, drift, grading, modelling, refresh, retraining, serving, spans
from tarnlake.streaming import ingest

DAY = datetime.date


@pytest.mark.parametrize("day", [DAY(1971, 5, 1), DAY(1999, 12, 11), DAY(2004, 2, 29)])
def test_every_form_of_a_day_is_found_once_and_read_back(day):
    for form in spans.date_forms(day):
        found = list(spans.DATE_SHAPE.finditer(f"Seen on {form}. Next visit pending."))
        assert [m.group() for m in found] == [form] and spans.dated(found[0]) == day


@pytest.mark.parametrize("text", ["1971-05-01T10:00", "x5/1/1971", "5/1/19711", "May 1 1971"])
def test_what_is_glued_to_letters_is_no_date(text):
    assert not spans.DATE_SHAPE.search(text)


def test_days_that_no_month_has_are_no_days():
    assert spans.dated(spans.DATE_SHAPE.search("31 June 2001")) is None


def test_needles_are_whole_words_of_the_notes_own_patient(spark):
    notes = spark.createDataFrame([(1, 10, "Ann planned it. Ann's son Ann Lee, not Bob; Ann_x, 02139, age 93 year-old or 47 year-old, on 5/1/1971 and 5/2/1971."), (2, 20, "Bob and Ann. May 1, 1971"), (3, 30, None), (4, None, "Ann 1971-05-01"), (5, 10, "Ünn Ann")], "note_id long, patient_id long, note_text string")
    values = spark.createDataFrame([(10, "name", "Ann"), (10, "name", "Ann Lee"), (10, "zip", "02139"), (10, "other_id", "02139"), (20, "name", "Bob"), (20, "name", "")], "patient_id long, category string, needle string")
    days = spark.createDataFrame([(10, DAY(1971, 5, 1)), (20, DAY(1971, 5, 1))], "patient_id long, day date")
    rows = spans.patient_spans(notes, values, days)
    text = {r["note_id"]: r["note_text"] for r in notes.collect()}
    got = rows.collect()
    assert all(text[r["note_id"]][r["char_start"] : r["char_end"]] == r["surface"] for r in got)
    assert collections.Counter((r["note_id"], r["category"], r["surface"]) for r in got) == collections.Counter({
        (1, "name", "Ann"): 3, (1, "name", "Ann Lee"): 1, (1, "zip", "02139"): 1, (1, "other_id", "02139"): 1, (1, "age", "93"): 1, (1, "date", "5/1/1971"): 1, (2, "name", "Bob"): 1, (2, "date", "May 1, 1971"): 1, (5, "name", "Ann"): 1})
    out = {r["note_id"]: r["note_text"] for r in spans.redact(notes, rows, F.lit(5)).collect()}
    assert out[1] == "[NAME] planned it. [NAME]'s son [NAME], not Bob; Ann_x, [NAME], age 90+ year-old or 47 year-old, on [DATE] and 5/2/1971." and out[2] == "[NAME] and Ann. [DATE]" and out[3] is None and out[5] == "Ünn [NAME]"
    assert spans.patient_spans(notes.limit(0), values, days).count() == 0


def stays(spark, n=400):
    rng = np.random.default_rng(3)
    rows = [(i % 90, i, bool(rng.random() < 0.3), *(bool(x) for x in rng.random(4) < 0.4), int(rng.integers(0, 12)), int(rng.integers(0, 6)), int(rng.integers(0, 3)), DAY(1994, 1, 1) + datetime.timedelta(days=int(rng.integers(0, 2000)))) for i in range(n)]
    out = spark.createDataFrame(rows, "patient_id long, stay_no long, outcome_readmitted boolean, has_lab_done boolean, has_pressure_controlled boolean, has_drug_taken boolean, arrived_via_emergency boolean, length_of_stay int, conditions_at_admit int, prior_stays_12m int, admit_day date")
    return out.withColumn("discharge_day", F.date_add("admit_day", F.col("length_of_stay")))


def test_counted_model_equals_the_fitted_pipeline_and_leaves_own_folds_out(spark):
    rows = stays(spark)
    fold = F.pmod(F.col("patient_id"), F.lit(5))
    model = modelling.sign_pipeline().fit(modelling.sign_rows(rows))
    fitted = {r["stay_no"]: r["score"] for r in modelling.score(model, modelling.sign_rows(rows)).collect()}
    counted = {r["stay_no"]: r["s"] for r in bayes.scores(rows, rows, [], fold, F.lit(False), F.col("outcome_readmitted"), modelling.signs(), "s").collect()}
    assert fitted.keys() == counted.keys() and all(math.isclose(fitted[k], counted[k], abs_tol=1e-9) for k in fitted)
    left = {r["stay_no"]: r["s"] for r in bayes.scores(rows, rows, [], fold, F.lit(True), F.col("outcome_readmitted"), modelling.signs(), "s").collect()}
    for k in range(5):
        part = modelling.sign_rows(rows.where(fold == k))
        own = modelling.score(modelling.sign_pipeline().fit(modelling.sign_rows(rows.where(fold != k))), part).collect()
        assert own and all(math.isclose(r["score"], left[r["stay_no"]], abs_tol=1e-9) for r in own)


def test_grouped_challengers_equal_models_fitted_one_by_one(spark):
    rows, dates = stays(spark, 600), ["1997-07-02", "1998-07-02"]
    fold = F.pmod(F.col("patient_id"), F.lit(5))
    got = {(str(r["as_of"]), r["stay_no"]): (r["window"], r["trains"], r["challenger"]) for r in retraining.challenged(rows, dates, modelling.signs(), "outcome_readmitted", fold).collect()}
    for date in dates:
        each = retraining.cursors(rows, [date])
        train = modelling.sign_rows(each.where("trains"))
        check = modelling.score(modelling.sign_pipeline().fit(train), modelling.sign_rows(each.where("window = 'check'"))).collect()
        assert len(check) > 20 and all(got[date, r["stay_no"]][:2] == ("check", False) and math.isclose(got[date, r["stay_no"]][2], r["score"], abs_tol=1e-9) for r in check)
        assert any(w == "cut" and t for (d, _), (w, t, _) in got.items() if d == date)


@pytest.mark.parametrize(("champion", "action"), [(0.3, "keep"), (0.9, "new cutoff")])
def test_the_smallest_change_that_helps_is_decided(spark, champion, action):
    rng = np.random.default_rng(1)
    rows = [(DAY(1999, 1, 1), w, float(x), float(rng.random())) for w in ("cut", "check") for x in rng.random(400)]
    scored = spark.createDataFrame(rows, "as_of date, window string, a double, b double")
    got = retraining.decisions(scored, "a", "b", {0.3: 0.75, 0.9: 0.2}[champion], 0.25).first()
    assert got["action"] == action and got["triggered"] == (action != "keep")


def test_a_challenger_that_ranks_at_random_is_clearly_worse_and_one_that_ranks_as_well_is_not(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 150, bool(y), float(0.6 * y + rng.random()), float(rng.random())) for i, y in enumerate(rng.random(600) < 0.3)]
    df = spark.createDataFrame(rows, "patient_id long, y boolean, good double, bad double")
    assert retraining.ranking_guard(df, "patient_id", "good", "bad", "y", 200).first()["verdict"] == "clearly worse"
    assert retraining.ranking_guard(df, "patient_id", "bad", "good", "y", 200).first()["verdict"] == "not clearly worse"
    assert retraining.ranking_guard(df.withColumn("y", F.lit(False)), "patient_id", "good", "bad", "y", 20).first()["verdict"] == "not judged"


def test_draws_are_poisson_and_the_same_again(spark):
    per = spark.createDataFrame([(i,) for i in range(300)], "k long")
    w = collections.Counter(r["w"] for r in drift.drawn(per, "k", 30).collect())
    assert abs(sum(k * n for k, n in w.items()) / 9000 - 1) < 0.05 and abs(w[1] / 9000 - 0.368) < 0.03
    assert sorted(map(tuple, drift.drawn(per, "k", 30).collect())) == sorted(map(tuple, drift.drawn(per.repartition(7), "k", 30).collect()))


def test_versions_are_stored_promoted_loaded_and_scored(spark, tmp_path):
    root, rows = f"file://{tmp_path}", modelling.sign_rows(stays(spark))
    with pytest.raises(ValueError, match="no version"):
        serving.served(spark, root)
    models = {}
    for version, until in (("v1", "1996-01-01"), ("v2", "1999-01-01")):
        models[version] = modelling.sign_pipeline().fit(rows.where(f"admit_day < DATE'{until}'"))
        serving.publish(spark, root, version, models[version], {"expected": "400", "cutoff": "0.3"})
        serving.promote(spark, root, version)
        served = serving.served(spark, root)
        assert served.version == version and served.tags["cutoff"] == "0.3"
        for _ in range(2):
            out = serving.batch_score(rows, served, f"{root}/scores", ["patient_id", "stay_no"])
        own = {r["stay_no"]: r["score"] for r in out.where(F.col("version") == version).collect()}
        memory = {r["stay_no"]: r["score"] for r in modelling.score(models[version], rows).collect()}
        assert own == memory
    assert {r["version"]: r["count"] for r in out.groupBy("version").count().collect()} == {"v1": 400, "v2": 400}
    with pytest.raises(ValueError, match="published already"):
        serving.publish(spark, root, "v1", models["v1"], {})
    with pytest.raises(ValueError, match="400 expected"):
        serving.batch_score(rows.limit(3), served, f"{root}/scores", ["patient_id", "stay_no"])


def test_quantiles_of_groups_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(x)) for g in range(4) for x in rng.integers(0, 40, 50 + 300 * g)] + [(1, None), (9, 5.0)]
    got = {r["g"]: r["quantiles"] for r in ranks.group_quantiles(spark.createDataFrame(rows, "g int, x double"), ["g"], F.col("x"), [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for g, found in got.items():
        assert found == pytest.approx(np.quantile([x for k, x in rows if k == g and x is not None], [0.0, 0.25, 0.5, 0.9, 1.0]))
    assert set(got) == {0, 1, 2, 3, 9}


def test_one_verdict_for_every_kind_of_reply(spark):
    stay = spark.range(30).select(F.col("id").alias("n"), (F.col("id") % 3).alias("g"))
    gold = lambda: stay.groupBy("g").agg(F.count("*").alias("c"))
    easy, top = grading.Question("easy", gold), grading.Question("hard", lambda: stay.orderBy(F.desc("n")).limit(3), ordered=True)
    want = {"SELECT g, count(*) FROM {stay} GROUP BY g": "correct", "SELECT count(*) AS c, g, 'x' FROM {stay} GROUP BY g -- more;": "correct", "SELECT g, count(*) + 1 FROM {stay} GROUP BY g": "wrong_result", "SELECT nothing FROM {stay}": "sql_error", "SELECT 1 / (n - n) FROM {stay}": "sql_error",
            "INSERT INTO x SELECT 1": "blocked", "SELECT 1; DROP TABLE y": "blocked", "SELECT * FROM range(20000)": "too_many_rows", " refuse. ": "wrongly_refused", None: "error"}
    for reply, verdict in want.items():
        assert grading.verdict(spark, easy, reply, {"stay": stay}) == verdict, reply
    assert grading.verdict(spark, top, "SELECT * FROM {stay} ORDER BY n DESC LIMIT 3", {"stay": stay}) == "correct"
    assert grading.verdict(spark, top, "SELECT * FROM (SELECT * FROM {stay} ORDER BY n DESC LIMIT 3) ORDER BY n", {"stay": stay}) == "wrong_result"
    nothing = grading.Question("none", None)
    assert [grading.verdict(spark, nothing, r, {}) for r in ("REFUSE", "SELECT 1", None)] == ["correct", "answered_unanswerable", "error"]


def test_refreshed_views_equal_a_rebuild_and_touch_only_their_batchs_buckets(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.range(2000).select((F.col("id") % 300).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v"))
    views = [refresh.Totals("t", ("k",), {"n": ("count", F.lit(1)), "known": ("count", F.col("v")), "total": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))}), refresh.Derived("big", "t", {"big": F.col("total") > 900})]
    for part in (rows.where("v % 3 = 0 OR v IS NULL"), rows.where("v % 3 > 0")):
        refresh.refresh(spark, root, part, views)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    one = spark.createDataFrame([(5, 1)], "k long, v long")
    written = refresh.refresh(spark, root, one, views)
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    assert 0 < written["t"] < 300 and len(before.items() & after.items()) >= len(before) - 8
    assert set(refresh.refresh(spark, root, one.limit(0), views).values()) == {0}
    want = views[0].of(rows.unionByName(one)).withColumns(dict(views[1].columns))
    assert sorted(map(tuple, spark.read.parquet(f"{root}/big").drop("_bucket").select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ingestion_widens_with_each_batch_and_reads_headers_of_split_files(spark, tmp_path):
    landing, out, state = tmp_path / "in", f"file://{tmp_path}/out", f"{tmp_path}/state"
    landing.mkdir()
    (landing / "a.csv").write_text("id,name\n" + "".join(f"{i},n{i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(str(landing)).rdd.getNumPartitions() > 3 and ingest.header(spark, str(landing)) == ["id", "name"]
        ingest.ingest_evolving(spark, str(landing), out, state, "b1")
        (landing / "b.csv").write_text('name,"city, state",id\nx,"Salem, MA",7\n')
        (landing / "c.csv").write_text("id\n8\n")
        ingest.ingest_evolving(spark, str(landing), out, state, "b2")
        ingest.ingest_evolving(spark, str(landing), out, state, "b3")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ingest.declared(spark, out) == ["id", "name", "city, state"]
    rows = ingest.evolved(spark, out)
    assert rows.count() == 3002 and rows.where("`city, state` IS NOT NULL").select("id", "name", "`city, state`", "_batch_id").collect() == [("7", "x", "Salem, MA", "b2")]
    assert {(r["id"], r["name"]) for r in rows.where("_batch_id = 'b2'").collect()} == {("7", "x"), ("8", None)}
