"""Queries over windows of scores, retraining decisions and their log."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions import ranks
from tarnlake.functions.columns import ratio
from tarnlake.operators import bayes, drift, serving
from tarnlake.operators import modelling as ml
from tarnlake.operators import retraining as op
from tarnlake.plans.basics import WILSON_HIGH, WILSON_LOW
from tarnlake.plans.models import INTERVAL, parts, ruled
from tarnlake.plans.registry import query, shared
from tarnlake.plans.sql_views import VIEWS
from tarnlake.sources.shared import shared_folder

DATES, LIVE, BUDGET, CUTOFF = ["1996-07-02", "1997-07-02", "1998-07-02"], "1999-07-02", 0.25, 0.06
SIGNS = {"lab": "has_lab_done", "pressure": "has_pressure_controlled", "drug": "has_drug_taken", "emergency": "arrived_via_emergency", "long": "length_of_stay > 5", "ill": "conditions_at_admit > 3", "before": "prior_stays_12m > 0"}
VIEWS["signed"] = f"SELECT patient_id, stay_no, part, admit_day, discharge_day, patient_id % 5 AS fold, (outcome_readmitted IS TRUE)::INT AS y, {', '.join(f'(({x}) IS TRUE)::INT AS {k}' for k, x in SIGNS.items())} FROM stay_part"


def _sums(prefix: str) -> str:
    """SQL of the counts that a model is made of."""
    return ", ".join(f"sum({x})::DOUBLE AS {prefix}{name}" for y in (1, 0) for name, x in [(f"n_{y}", f"(y = {y})::INT"), *((f"k_{y}_{k}", f"(y = {y})::INT * {k}") for k in SIGNS)])


#: A count of the whole group's model, less the row's own fold if the model has seen the row.
def _left(seen: str) -> str:
    return f"(coalesce(w.{{0}}, 0) - CASE WHEN {seen} THEN coalesce(f.f_{{0}}, 0) ELSE 0 END)"


VIEWS["champion_sum"] = f"SELECT {_sums('')} FROM signed WHERE part = 'train'"
VIEWS["champion_fold"] = f"SELECT fold, {_sums('f_')} FROM signed WHERE part = 'train' GROUP BY fold"
VIEWS["window_score"] = f"SELECT s.*, {bayes.odds_sql(list(SIGNS), _left("s.part = 'train'"))} AS score FROM signed s CROSS JOIN champion_sum w LEFT JOIN champion_fold f ON f.fold = s.fold"


def fold() -> Column:
    return F.pmod(F.col("patient_id"), F.lit(5))


def scores(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)
    return bayes.scores(x.where("part = 'train'"), x, [], fold(), F.col("part") == "train", F.col("outcome_readmitted"), ml.signs(), "score")


@query("SELECT patient_id, stay_no, score FROM window_score")
def rt_window_scores(spark: SparkSession, d: str) -> DataFrame:
    """The champion's scores; rows that it was trained on are scored without their own fold."""
    return scores(spark, d).select("patient_id", "stay_no", "score")


VERSIONS = {"v1": "1997-01-01", "v2": "1999-01-01"}
VIEWS["version_sum"] = " UNION ALL ".join(f"SELECT '{v}' AS version, {_sums('')} FROM signed WHERE part = 'train' AND admit_day < DATE '{day}'" for v, day in VERSIONS.items())


@query(f"SELECT version, patient_id, stay_no, score, score >= 0.08 AS flagged FROM (SELECT w.version, patient_id, stay_no, {bayes.odds_sql(list(SIGNS), 'w.{0}')} AS score FROM signed s CROSS JOIN version_sum w WHERE part = 'production')")
def ml_batch_score(spark: SparkSession, d: str) -> DataFrame:
    """Two versions are fitted, saved, promoted in turn and loaded again to score later stays; scoring again replaces a version's rows."""
    root = shared_folder(spark, "models")
    x = ml.sign_rows(parts(spark, d))
    later = x.where("part = 'production'")
    tags = {"expected": str(later.count()), "cutoff": "0.08"}
    for version, until in VERSIONS.items():
        model = ml.sign_pipeline().fit(x.where(f"part = 'train' AND admit_day < DATE'{until}'"))
        serving.publish(spark, root, version, model, tags | {"admit_before": until})
        serving.promote(spark, root, version)
        for _ in range(2):
            out = serving.batch_score(later, serving.served(spark, root), f"{root}/scores", ["patient_id", "stay_no"])
    return out.select("version", "patient_id", "stay_no", "score", "flagged")


@query()
def ml_group_cv(spark: SparkSession, d: str) -> DataFrame:
    """Mean and spread of average precision over five folds of whole patients, for every setting of a grid."""
    x = parts(spark, d).where("part = 'train'")
    rows = ml.folds(ml.features(x, ml.frequent(x)))
    pipe = ml.pipeline()
    grid = ParamGridBuilder().addGrid(pipe.getStages()[-1].regParam, [0.01, 0.1]).build()
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")
    fitted = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=judge, numFolds=5, foldCol="fold", parallelism=2).fit(rows)
    found = [(float(next(iter(p.values()))), float(m), float(s)) for p, m, s in zip(grid, fitted.avgMetrics, fitted.stdMetrics, strict=True)]
    return spark.createDataFrame(found, "reg_param double, mean double, sd double").crossJoin(rows.agg(F.count("*").alias("rows")))


@query("SELECT s.y AS train_year, count(*) AS stays, avg(outcome_readmitted::INT)::DOUBLE AS rate, quantile_cont(score, 0.75)::DOUBLE AS cutoff FROM ruled, (VALUES (1993), (1994), (1995), (1996)) s(y) WHERE admit_day >= make_date(s.y, 1, 1) AND admit_day < DATE '1999-01-01' GROUP BY s.y")
def ml_window_probe(spark: SparkSession, d: str) -> DataFrame:
    """What training would see from several starting years on."""
    rows = ruled(spark, d).where("admit_day < DATE'1999-01-01'").withColumn("train_year", F.explode(F.array(*[F.lit(y) for y in range(1993, 1997)]))).where("admit_day >= make_date(train_year, 1, 1)")
    cutoff = ranks.group_quantiles(rows, ["train_year"], F.col("score"), [0.75]).select("train_year", F.col("quantiles")[0].alias("cutoff"))
    return rows.groupBy("train_year").agg(F.count("*").alias("stays"), F.avg(F.col("outcome_readmitted").cast("double")).alias("rate")).join(cutoff, "train_year", "left")


@query(f"SELECT part, {WILSON_LOW} <= 0.4 AND {WILSON_HIGH} >= 0.4 AS on_budget FROM flagged_year")
def rt_on_budget(spark: SparkSession, d: str) -> DataFrame:
    """Years whose flag rate could be the budget."""
    rates = drift.flag_rates(parts(spark, d), F.col("length_of_stay") > 5, F.col("admit_year"))
    return rates.select("part", F.lit(0.4).between(F.col("low"), F.col("high")).alias("on_budget"))


VIEWS["ranked_sum"] = "SELECT patient_id, who, s, sum(y) AS k, count(*) AS n FROM (SELECT patient_id, outcome_readmitted::INT AS y, unnest([{'who': 0, 's': score}, {'who': 1, 's': age_at_admit::DOUBLE}], recursive := true) FROM ruled) GROUP BY ALL"


@query(INTERVAL.replace("SELECT q[1]", "SELECT hits, CASE WHEN hits = 0 THEN 'not judged' WHEN q[3] < 0 THEN 'clearly worse' ELSE 'not clearly worse' END AS verdict, q[1]").format(
    f"""SELECT max(ap) FILTER (WHERE who = 1) - max(ap) FILTER (WHERE who = 0) AS d FROM (SELECT b, who, sum(k * tp / rank) / nullif(sum(k), 0) AS ap FROM (SELECT *, sum(n) OVER (PARTITION BY b, who ORDER BY s DESC) AS rank, sum(k) OVER (PARTITION BY b, who ORDER BY s DESC) AS tp
    FROM (SELECT b, who, s, sum(w * k)::DOUBLE AS k, sum(w * n)::DOUBLE AS n FROM ({drift.drawn_sql('ranked_sum', 'patient_id')}) GROUP BY ALL)) GROUP BY ALL) GROUP BY b""") + " CROSS JOIN (SELECT count_if(outcome_readmitted) AS hits FROM ruled)")
def rt_ranking_guard(spark: SparkSession, d: str) -> DataFrame:
    """Does a score by age alone rank clearly worse than the rule's?"""
    rows = ruled(spark, d).withColumn("other", F.col("age_at_admit").cast("double"))
    return op.ranking_guard(rows, "patient_id", "score", "other", "outcome_readmitted")


ALL_DATES = ", ".join(f"(DATE '{x}')" for x in [*DATES, LIVE])
VIEWS["cursor"] = f"""SELECT s.*, as_of, CASE WHEN admit_day > as_of - 30 - INTERVAL 12 MONTH AND admit_day <= as_of - 30 THEN 'check' WHEN admit_day > as_of - 30 - INTERVAL 24 MONTH AND admit_day <= as_of - 30 - INTERVAL 12 MONTH THEN 'cut' END AS w,
  admit_day > as_of - 30 - INTERVAL 12 MONTH - INTERVAL 36 MONTH AND admit_day <= as_of - 30 - INTERVAL 12 MONTH AND discharge_day <= as_of - 30 AS trains FROM window_score s, (VALUES {ALL_DATES}) c(as_of)"""
VIEWS["rival_sum"] = f"SELECT as_of, {_sums('')} FROM cursor WHERE trains GROUP BY as_of"
VIEWS["rival_fold"] = f"SELECT as_of, fold, {_sums('f_')} FROM cursor WHERE trains GROUP BY as_of, fold"
VIEWS["rivalled"] = f"SELECT s.as_of, s.w, s.score, {bayes.odds_sql(list(SIGNS), _left('s.trains'))} AS other FROM cursor s LEFT JOIN rival_sum w ON w.as_of = s.as_of LEFT JOIN rival_fold f ON f.as_of = s.as_of AND f.fold = s.fold WHERE s.w IS NOT NULL"
VIEWS["new_cut"] = f"SELECT as_of, quantile_cont(score, {1 - BUDGET}) AS new_cutoff, quantile_cont(other, {1 - BUDGET}) AS own_cutoff FROM rivalled WHERE w = 'cut' GROUP BY as_of"
VIEWS["tried"] = f"SELECT as_of, count(*)::DOUBLE AS n, count_if(score > {CUTOFF})::DOUBLE AS a, count_if(score > new_cutoff)::DOUBLE AS b, count_if(other > own_cutoff)::DOUBLE AS c FROM rivalled LEFT JOIN new_cut USING (as_of) WHERE w = 'check' GROUP BY as_of"


def _fits(k: str) -> str:
    """The budget lies in the interval of ``k`` out of n."""
    return f"({BUDGET} BETWEEN {WILSON_LOW.replace('k ', k + ' ')} AND {WILSON_HIGH.replace('k ', k + ' ')})"


VIEWS["decision"] = f"SELECT as_of, n::BIGINT AS n, a / n AS rate, NOT {_fits('a')} AS triggered, CASE WHEN {_fits('a')} THEN 'keep' WHEN {_fits('b')} THEN 'new cutoff' WHEN {_fits('c')} THEN 'retrain' ELSE 'no candidate' END AS action FROM tried"


@shared
def decided(spark: SparkSession, d: str) -> DataFrame:
    """The decisions of all dates: made once, read by each step of the replay."""
    rows = op.challenged(scores(spark, d), [*DATES, LIVE], ml.signs(), "outcome_readmitted", fold())
    return op.decisions(rows, "score", "challenger", CUTOFF, BUDGET)


@query("SELECT * FROM decision")
def rt_decide(spark: SparkSession, d: str) -> DataFrame:
    """Trigger, then the smallest change that brings the flag rate back to the budget."""
    return decided(spark, d)


def _history(spark: SparkSession, d: str) -> DataFrame:
    return op.replay(spark, decided(spark, d), DATES, shared_folder(spark, "history"), LIVE)


@query(f"SELECT as_of, action, CASE WHEN as_of = DATE '{LIVE}' THEN 'live' ELSE 'replay' END AS mode FROM decision")
def rt_replay(spark: SparkSession, d: str) -> DataFrame:
    """Yearly dates in order, nothing twice, the live one last."""
    return _history(spark, d).select("as_of", "action", "mode")


@query("SELECT CAST(row_number() OVER (ORDER BY as_of) AS INT) - 1 AS step, as_of, round(rate, 3) AS rate, triggered, action FROM decision")
def rt_history_report(spark: SparkSession, d: str) -> DataFrame:
    """The log of decisions in the order they were written."""
    return _history(spark, d).orderBy("step").select("step", "as_of", F.round("rate", 3).alias("rate"), "triggered", "action")


@query("""SELECT 'v' || admit_year AS version, make_date(admit_year - 2, 1, 1) AS train_from, CASE WHEN admit_year % 2 = 0 THEN DATE '1998-12-01' ELSE make_date(admit_year, 1, 1) END AS train_to,
greatest(CASE WHEN admit_year % 2 = 0 THEN DATE '1998-12-01' ELSE make_date(admit_year, 1, 1) END, CASE WHEN admit_year % 3 <> 0 THEN min(admit_day) END) AS scoring_start, CASE WHEN admit_year % 3 = 0 THEN 50.0 ELSE max(length_of_stay) END::DOUBLE AS cutoff FROM signal GROUP BY admit_year""")
def rt_champion_meta(spark: SparkSession, d: str) -> DataFrame:
    """Settings of model versions, read from text tags that may be missing or unreadable."""
    years = parts(spark, d).groupBy("admit_year").agg(F.min("admit_day").alias("first"), F.max("length_of_stay").alias("longest"))
    year, day = F.col("admit_year"), F.lit("-01-01")
    tags = F.map_from_entries(F.array_compact(F.array(
        F.struct(F.lit("train_from").alias("k"), F.concat(year - 2, day).alias("v")), F.when(year % 2 != 0, F.struct(F.lit("train_to").alias("k"), F.concat(year, day).alias("v"))),
        F.struct(F.lit("scoring_start").alias("k"), F.when(year % 3 != 0, F.col("first").cast("string")).otherwise("soon").alias("v")), F.when(year % 3 != 0, F.struct(F.lit("cutoff").alias("k"), F.col("longest").cast("string").alias("v"))))))
    return op.champion_meta(years.select(F.concat(F.lit("v"), year).alias("version"), tags.alias("tags")))


VIEWS["score_edge"] = "SELECT list_distinct(quantile_cont(score, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM ruled WHERE part = 'train'"
VIEWS["score_bin"] = "SELECT admit_year, part, outcome_readmitted, length_of_stay, len(list_filter(edges, lambda e: e < score)) AS bin FROM ruled CROSS JOIN score_edge"


@query("""WITH t AS (SELECT bin, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM score_bin WHERE part = 'train' GROUP BY bin), y AS (SELECT DISTINCT admit_year FROM score_bin WHERE part <> 'train'), b AS (SELECT DISTINCT bin FROM score_bin),
q AS (SELECT admit_year, bin, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY admit_year) AS q FROM score_bin WHERE part <> 'train' GROUP BY admit_year, bin),
g AS (SELECT y.admit_year, greatest(coalesce(t.p, 0), 0.0001) AS p, greatest(coalesce(q.q, 0), 0.0001) AS q FROM y CROSS JOIN b LEFT JOIN t USING (bin) LEFT JOIN q ON q.admit_year = y.admit_year AND q.bin = b.bin),
m AS (SELECT admit_year, sum((q - p) * ln(q / p)) AS psi FROM g GROUP BY admit_year)
SELECT admit_year, any_value(psi) AS psi, avg((length_of_stay > 5)::INT)::DOUBLE AS flag_rate, avg(outcome_readmitted::INT)::DOUBLE AS readmission_rate FROM score_bin JOIN m USING (admit_year) WHERE part <> 'train' GROUP BY admit_year""")
def dr_report_years(spark: SparkSession, d: str) -> DataFrame:
    """Per later year: how far the scores moved from training's, and the rates of flags and of returns."""
    rows = ruled(spark, d)
    edges = ranks.quantiles(rows.where("part = 'train'"), F.col("score"), [i / 10 for i in range(1, 10)]).select(F.array_distinct("quantiles").alias("edges"))
    binned = rows.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("score"))))
    counts = binned.groupBy("bin", F.when(F.col("part") != "train", F.col("admit_year")).alias("admit_year")).agg(F.count("*").alias("n"))
    base = counts.where("admit_year IS NULL").select("bin", F.col("n").alias("before"))
    years, bins = counts.where("admit_year IS NOT NULL").select("admit_year").distinct(), counts.select("bin").distinct()
    grid = years.crossJoin(F.broadcast(bins)).join(F.broadcast(base), "bin", "left").join(counts.where("admit_year IS NOT NULL"), ["admit_year", "bin"], "left")
    moved = drift.stability(grid.select(F.col("admit_year").alias("feature"), F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("n", F.lit(0)).alias("now"))).withColumnRenamed("feature", "admit_year")
    rates = rows.where("part <> 'train'").groupBy("admit_year").agg(F.avg((F.col("length_of_stay") > 5).cast("double")).alias("flag_rate"), F.avg(F.col("outcome_readmitted").cast("double")).alias("readmission_rate"))
    return moved.join(rates, "admit_year").select("admit_year", "psi", "flag_rate", "readmission_rate")


@query("SELECT rows, n, round(recall, 3) AS recall FROM (SELECT 'train' AS rows, count(*) AS n, count_if(outcome_readmitted AND length_of_stay > 5)::DOUBLE / nullif(count_if(outcome_readmitted), 0) AS recall FROM stay_part WHERE part = 'train' UNION ALL SELECT 'production', count(*), count_if(outcome_readmitted AND length_of_stay > 5)::DOUBLE / nullif(count_if(outcome_readmitted), 0) FROM stay_part WHERE part = 'production')")
def rt_rule_recall(spark: SparkSession, d: str) -> DataFrame:
    """The rule's recall on either side of the split."""
    hit = F.col("outcome_readmitted")
    return parts(spark, d).where("part <> 'gap'").groupBy(F.col("part").alias("rows")).agg(F.count("*").alias("n"), F.round(ratio(F.count_if(hit & (F.col("length_of_stay") > 5)), F.count_if(hit)), 3).alias("recall"))
