"""Queries over evaluation, drift and retraining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.columns import ratio
from tarnlake.operators import drift as op
from tarnlake.operators import modelling as ml
from tarnlake.operators import stays as stay_op
from tarnlake.plans.basics import WILSON_HIGH, WILSON_LOW
from tarnlake.plans.registry import query
from tarnlake.plans.sql_views import VIEWS
from tarnlake.plans.stays import signal
from tarnlake.sources import adapters as a

SPLIT = ("1995-01-01", "1999-01-01", "1998-12-01")
VIEWS["stay_part"] = "SELECT *, CASE WHEN admit_day >= DATE '1995-01-01' AND admit_day < DATE '1999-01-01' AND discharge_day <= DATE '1998-12-01' THEN 'train' WHEN admit_day >= DATE '1999-01-01' THEN 'production' ELSE 'gap' END AS part FROM signal"
VIEWS["ruled"] = "SELECT *, (length_of_stay * 10 + conditions_at_admit)::DOUBLE AS score, CASE WHEN length_of_stay > 5 THEN 0.3 ELSE 0.1 END AS p FROM stay_part"


def parts(spark: SparkSession, d: str) -> DataFrame:
    return op.time_split(signal(spark, d), *SPLIT)


def ruled(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).withColumn("score", (F.col("length_of_stay") * 10 + F.col("conditions_at_admit")).cast("double")).withColumn("p", F.when(F.col("length_of_stay") > 5, 0.3).otherwise(0.1))


@query("SELECT part, count(*) AS stays FROM stay_part GROUP BY part")
def ml_time_split(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).groupBy("part").agg(F.count("*").alias("stays"))


#: A procedure that most stays of its kind return from by plan, so that a model may leave them out.
BYPASS = "P3"


@query(f"SELECT 'all' AS population, count(*) AS stays FROM signal UNION ALL SELECT 'no_bypass', count(*) FROM signal s WHERE NOT EXISTS (FROM procedure p WHERE p.patient_id = s.patient_id AND p.code = '{BYPASS}' AND p.done_on BETWEEN s.admit_day AND s.discharge_day)")
def ml_population(spark: SparkSession, d: str) -> DataFrame:
    """Index stays, and those without bypass surgery."""
    stays = signal(spark, d)
    during = stay_op.count_within(stays, a.procedure(spark, d).where(F.col("code") == BYPASS).select("patient_id", F.col("done_on").alias("day"), F.lit("bypass").alias("tag")), {"bypass": (F.col("admit_day"), F.col("discharge_day"))})
    counts = during.agg(F.count("*").alias("all"), F.count_if(F.col("bypass") == 0).alias("no_bypass"))
    return counts.unpivot([], ["all", "no_bypass"], "population", "stays")


@query("SELECT patient_id, stay_no, score, CASE WHEN length_of_stay > 5 THEN 1 ELSE 0 END AS rule FROM ruled")
def ml_rule_baseline(spark: SparkSession, d: str) -> DataFrame:
    return ruled(spark, d).select("patient_id", "stay_no", "score", (F.col("length_of_stay") > 5).cast("int").alias("rule"))


@query("SELECT r.patient_id, r.stay_no, coalesce(m.rate, (SELECT avg(outcome_readmitted::INT) FROM stay_part WHERE part = 'train'))::DOUBLE AS p FROM stay_part r LEFT JOIN (SELECT admit_reason, avg(outcome_readmitted::INT) AS rate FROM stay_part WHERE part = 'train' GROUP BY ALL) m USING (admit_reason) WHERE r.part = 'production'")
def ag_group_mean_map(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)
    hit = F.avg(F.col("outcome_readmitted").cast("double"))
    train = x.where("part = 'train'")
    rates, overall = train.groupBy("admit_reason").agg(hit.alias("rate")), train.agg(hit.alias("overall"))
    out = x.where("part = 'production'").join(rates, "admit_reason", "left").crossJoin(F.broadcast(overall))
    return out.select("patient_id", "stay_no", F.coalesce("rate", "overall").alias("p"))


@query("SELECT quantile_cont(score, 0.75) AS cutoff FROM ruled")
def ml_threshold(spark: SparkSession, d: str) -> DataFrame:
    return op.threshold(ruled(spark, d), "score", 0.25)


@query("SELECT count_if(outcome_readmitted) AS caught, (SELECT count_if(outcome_readmitted) FROM ruled) AS hits, count_if(outcome_readmitted)::DOUBLE / (SELECT count_if(outcome_readmitted) FROM ruled) AS recall FROM (SELECT * FROM ruled ORDER BY score DESC, first_encounter_id LIMIT 500)")
def ml_recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    return op.recall_at(ruled(spark, d), "score", "outcome_readmitted", 500, "first_encounter_id")


@query("SELECT sum(k::DOUBLE / t * tp / rank) AS average_precision FROM (SELECT k, sum(k) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS rank, sum(k) OVER () AS t FROM (SELECT score, count(*) AS n, count_if(outcome_readmitted) AS k FROM ruled GROUP BY score))")
def ag_average_precision(spark: SparkSession, d: str) -> DataFrame:
    return op.average_precision(ruled(spark, d), "score", "outcome_readmitted")


@query("""WITH c AS (SELECT *, score > (SELECT quantile_cont(score, 0.75) FROM ruled) AS flag FROM ruled), g AS (SELECT 'all' AS rows, * FROM c UNION ALL SELECT 'new', * FROM c WHERE prior_stays_12m = 0 UNION ALL SELECT 'returning', * FROM c WHERE prior_stays_12m > 0),
s AS (SELECT rows, score, count(*) AS n, count_if(outcome_readmitted) AS k FROM g GROUP BY ALL),
u AS (SELECT rows, k, sum(k) OVER w AS uk, sum(n) OVER w AS un, sum(k) OVER (PARTITION BY rows) AS t FROM s WINDOW w AS (PARTITION BY rows ORDER BY score DESC)),
ap AS (SELECT rows, sum(k::DOUBLE * uk / un) / any_value(t) AS average_precision FROM u GROUP BY rows),
e AS (SELECT rows, count(*) AS n, count_if(outcome_readmitted) AS hits, count_if(flag AND outcome_readmitted) AS caught, count_if(NOT flag AND outcome_readmitted) AS missed, avg(power(p - outcome_readmitted::INT, 2))::DOUBLE AS brier FROM g GROUP BY rows)
SELECT rows, n, hits, caught, missed, caught::DOUBLE / nullif(hits, 0) AS recall, average_precision::DOUBLE AS average_precision, brier, """ + WILSON_LOW.replace("k", "caught::DOUBLE").replace("n", "hits") + " AS recall_low, " + WILSON_HIGH.replace("k", "caught::DOUBLE").replace("n", "hits") + """ AS recall_high FROM e JOIN ap USING (rows)""")
def ml_evaluate(spark: SparkSession, d: str) -> DataFrame:
    prior = F.col("prior_stays_12m")
    return op.evaluate(ruled(spark, d), "score", "outcome_readmitted", "p", 0.25, {"all": F.lit(True), "new": prior == 0, "returning": prior > 0})


def _errors() -> tuple:
    """Squared errors of two scorers: the training rate for all, and the rule's chance."""
    y = F.col("outcome_readmitted").cast("double")
    return F.pow(y - 0.1, F.lit(2)), F.pow(y - F.col("p"), F.lit(2))


INTERVAL = "SELECT q[1] AS low, q[2] AS mid, q[3] AS high FROM (SELECT quantile_cont(d, [0.025, 0.5, 0.975]) AS q FROM ({}))"
VIEWS["error_sum"] = "SELECT patient_id, sum(pow(y - 0.1, 2)) AS a, sum(pow(y - p, 2)) AS b_, count(*) AS n FROM (SELECT patient_id, p, outcome_readmitted::INT::DOUBLE AS y FROM ruled) WHERE y IS NOT NULL GROUP BY patient_id"


@query(INTERVAL.format(f"SELECT (sum(w * a) - sum(w * b_)) / sum(w * n) AS d FROM ({op.drawn_sql('error_sum', 'patient_id')}) GROUP BY b"))
def ml_cluster_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """How much the rule's chances improve on one chance for all: the interval of the difference of mean squared errors."""
    return op.cluster_bootstrap(ruled(spark, d), "patient_id", *_errors())


VIEWS["cut_sum"] = """SELECT patient_id, count_if(score > cutoff)::DOUBLE AS flags, count_if(length_of_stay > 5)::DOUBLE AS ruled, count_if(score > cutoff AND outcome_readmitted)::DOUBLE AS caught, count_if(length_of_stay > 5 AND outcome_readmitted)::DOUBLE AS by_rule, count_if(outcome_readmitted)::DOUBLE AS hits
  FROM ruled CROSS JOIN (SELECT quantile_cont(score, 0.9) AS cutoff FROM ruled) GROUP BY patient_id"""


@query(INTERVAL.format(f"SELECT (caught - coalesce(by_rule * least(1.0::DOUBLE, flags / nullif(ruled, 0)), 0)) / nullif(hits, 0) AS d FROM (SELECT {', '.join(f'sum(w * {x}) AS {x}' for x in ('flags', 'ruled', 'caught', 'by_rule', 'hits'))} FROM ({op.drawn_sql('cut_sum', 'patient_id')}) GROUP BY b)"))
def ml_cut_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """The score's recall at its cutoff against the rule's, thinned to as many flags."""
    rows = parts(spark, d).withColumn("score", (F.col("length_of_stay") * 10 + F.col("conditions_at_admit")).cast("double"))
    return op.cut_bootstrap(rows, "patient_id", "score", F.col("length_of_stay") > 5, "outcome_readmitted", 0.1)


VIEWS["gain_sum"] = "SELECT admit_year, patient_id, sum(pow(y - 0.1, 2) - pow(y - p, 2)) AS gain, count(*) AS n FROM (SELECT admit_year, patient_id, p, outcome_readmitted::INT::DOUBLE AS y FROM ruled) GROUP BY ALL"


@query(f"""SELECT admit_year, low, hits, CASE WHEN hits < 30 THEN 'too few' WHEN low > 0 THEN 'beats' ELSE 'no better' END AS verdict FROM (SELECT admit_year, quantile_cont(d, 0.025) AS low FROM (SELECT admit_year, b, sum(w * gain) / sum(w * n) AS d FROM ({op.drawn_sql('gain_sum', 'patient_id')}) GROUP BY ALL) GROUP BY admit_year)
JOIN (SELECT admit_year, count_if(outcome_readmitted) AS hits FROM ruled GROUP BY admit_year) USING (admit_year)""")
def ml_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Per year: does the rule beat one chance for all, by the lower bound of the bootstrap's interval?"""
    return op.verdicts(ruled(spark, d), "admit_year", "patient_id", *_errors(), "outcome_readmitted")


FEATURE_SQL = ", ".join(f"coalesce({c}, 3650)::DOUBLE AS {c}" if c == "days_since_last_discharge" else f"{c}::DOUBLE AS {c}" for c in [*ml.NUMBERS, *ml.FLAGS])
KEPT_SQL = ", ".join(f"CASE WHEN {c} IN (SELECT {c} FROM stay_part WHERE part = 'train' GROUP BY {c} HAVING count(*) >= 20) THEN {c} ELSE 'infrequent' END AS {c}" for c in ml.CATEGORIES)


@query(f"SELECT patient_id, stay_no, {FEATURE_SQL}, {KEPT_SQL}, outcome_readmitted::DOUBLE AS label FROM stay_part")
def ml_features(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)
    rows = ml.features(x, ml.frequent(x.where("part = 'train'")))
    return rows.select("patient_id", "stay_no", *ml.NUMBERS, *ml.FLAGS, *ml.CATEGORIES, "label")


@query()
def ml_pipeline(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)
    rows = ml.features(x, ml.frequent(x.where("part = 'train'")))
    return ml.score(ml.pipeline().fit(rows.where("part = 'train'")), rows.where("part = 'production'")).select("patient_id", "stay_no", "score")


@query()
def ml_oof(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d).where("part = 'train'")
    return ml.out_of_fold(ml.features(x, ml.frequent(x))).select("patient_id", "stay_no", "fold", "score")


VIEWS["edge"] = "SELECT list_distinct(quantile_cont(length_of_stay::DOUBLE, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM stay_part WHERE part = 'train'"
VIEWS["binned"] = "SELECT part, len(list_filter(edges, lambda e: e < length_of_stay)) AS bin FROM stay_part CROSS JOIN edge WHERE part <> 'gap'"
VIEWS["psi_number"] = "SELECT sum((q - p) * ln(q / p)) AS psi FROM (SELECT greatest(count_if(part = 'train')::DOUBLE / sum(count_if(part = 'train')) OVER (), 0.0001) AS p, greatest(count_if(part = 'production')::DOUBLE / sum(count_if(part = 'production')) OVER (), 0.0001) AS q FROM binned GROUP BY bin)"
VIEWS["psi_reason"] = "SELECT sum((q - p) * ln(q / p)) AS psi FROM (SELECT greatest(count_if(part = 'train')::DOUBLE / sum(count_if(part = 'train')) OVER (), 0.0001) AS p, greatest(count_if(part = 'production')::DOUBLE / sum(count_if(part = 'production')) OVER (), 0.0001) AS q FROM stay_part WHERE part <> 'gap' GROUP BY admit_reason)"
VIEWS["psi_flag"] = "SELECT sum((q - p) * ln(q / p)) AS psi FROM (SELECT greatest(count_if(part = 'train')::DOUBLE / sum(count_if(part = 'train')) OVER (), 0.0001) AS p, greatest(count_if(part = 'production')::DOUBLE / sum(count_if(part = 'production')) OVER (), 0.0001) AS q FROM stay_part WHERE part <> 'gap' GROUP BY is_planned)"


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    x = parts(spark, d)
    return x.where("part = 'train'"), x.where("part = 'production'")


@query("SELECT 'length_of_stay' AS feature, psi FROM psi_number UNION ALL SELECT 'admit_reason', psi FROM psi_reason")
def dr_psi(spark: SparkSession, d: str) -> DataFrame:
    train, prod = _sides(spark, d)
    return op.psi(train, prod, {"length_of_stay": "number", "admit_reason": "category"})


@query("SELECT CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.25 THEN 'watch' ELSE 'shifted' END AS status FROM psi_number")
def dr_status(spark: SparkSession, d: str) -> DataFrame:
    return op.psi(*_sides(spark, d), {"length_of_stay": "number"}).select(op.status(F.col("psi")).alias("status"))


VIEWS["yearly"] = "SELECT admit_year, count(*)::DOUBLE AS n, count_if(outcome_readmitted)::DOUBLE AS k, (SELECT avg(outcome_readmitted::INT) FROM stay_part WHERE part = 'train')::DOUBLE AS ref FROM signal GROUP BY admit_year"


def yearly(spark: SparkSession, d: str) -> DataFrame:
    x = parts(spark, d)
    ref = x.where("part = 'train'").agg(F.avg(F.col("outcome_readmitted").cast("double")).alias("ref"))
    return x.groupBy("admit_year").agg(F.count("*").alias("n"), F.count_if("outcome_readmitted").alias("k")).crossJoin(F.broadcast(ref))


@query(f"SELECT admit_year, CASE WHEN ref BETWEEN {WILSON_LOW} AND {WILSON_HIGH} THEN 'stable' ELSE 'shifted' END AS status FROM yearly")
def dr_interval_status(spark: SparkSession, d: str) -> DataFrame:
    return yearly(spark, d).select("admit_year", op.interval_status(F.col("ref"), F.col("k"), F.col("n")).alias("status"))


@query(f"SELECT admit_year, CASE WHEN ref BETWEEN {WILSON_LOW} AND {WILSON_HIGH} THEN 'stable' WHEN abs(k / n - ref) >= 0.05 THEN 'shifted' ELSE 'watch' END AS status FROM yearly")
def dr_rate_status(spark: SparkSession, d: str) -> DataFrame:
    return yearly(spark, d).select("admit_year", op.rate_status(F.col("ref"), F.col("k"), F.col("n")).alias("status"))


REPORT = f"""SELECT 'length_of_stay' AS feature, psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.25 THEN 'watch' ELSE 'shifted' END AS status FROM psi_number UNION ALL SELECT 'admit_reason', psi, CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.25 THEN 'watch' ELSE 'shifted' END FROM psi_reason
UNION ALL SELECT 'is_planned', psi, (SELECT CASE WHEN ref BETWEEN {WILSON_LOW} AND {WILSON_HIGH} THEN 'stable' WHEN abs(k / n - ref) >= 0.05 THEN 'shifted' ELSE 'watch' END FROM (SELECT count_if(part = 'production')::DOUBLE AS n, count_if(part = 'production' AND is_planned)::DOUBLE AS k, avg(is_planned::INT) FILTER (WHERE part = 'train')::DOUBLE AS ref FROM stay_part)) FROM psi_flag"""


@query(REPORT)
def dr_report(spark: SparkSession, d: str) -> DataFrame:
    return op.drift_report(*_sides(spark, d), {"length_of_stay": "number", "admit_reason": "category", "is_planned": "flag"})


@query("SELECT feature FROM (" + REPORT + ") WHERE status = 'shifted'")
def rt_shifted_features(spark: SparkSession, d: str) -> DataFrame:
    return dr_report(spark, d).where("status = 'shifted'").select("feature")


VIEWS["profiled"] = "SELECT *, admit_reason || ' / ' || gender || ' / ' || conditions_at_admit AS profile FROM stay_part"


@query("SELECT profile AS category, count_if(part = 'production') AS rows, count_if(part = 'production')::DOUBLE / (SELECT count(*) FROM stay_part WHERE part = 'production') AS share FROM profiled WHERE part <> 'gap' GROUP BY profile HAVING count_if(part = 'train') = 0")
def dr_unseen_categories(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of reason, gender and number of conditions that production has and training never had."""
    train, prod = (x.withColumn("profile", F.concat_ws(" / ", "admit_reason", "gender", F.col("conditions_at_admit").cast("string"))) for x in _sides(spark, d))
    return op.unseen_categories(train, prod, "profile")


@query("SELECT count_if(admit_day > DATE '1999-06-02' AND admit_day <= DATE '2000-06-02') AS check_stays, count_if(admit_day > DATE '1998-06-02' AND admit_day <= DATE '1999-06-02') AS cut_stays FROM signal")
def rt_windows(spark: SparkSession, d: str) -> DataFrame:
    w = op.windows(F.lit("2000-07-02").cast("date"))
    inside = lambda a, b: F.count_if((F.col("admit_day") > w[a]) & (F.col("admit_day") <= w[b]))
    return signal(spark, d).agg(inside("check_from", "check_to").alias("check_stays"), inside("cut_from", "cut_to").alias("cut_stays"))


@query("SELECT avg((length_of_stay > 5)::INT)::DOUBLE AS budget FROM stay_part WHERE part = 'train'")
def rt_budget(spark: SparkSession, d: str) -> DataFrame:
    return parts(spark, d).where("part = 'train'").agg(F.avg((F.col("length_of_stay") > 5).cast("double")).alias("budget"))


VIEWS["flagged_year"] = "SELECT admit_year AS part, count(*)::DOUBLE AS n, count_if(length_of_stay > 5)::DOUBLE AS k FROM signal GROUP BY admit_year"


@query(f"SELECT part, n::BIGINT AS n, k::BIGINT AS k, k / n AS rate, {WILSON_LOW} AS low, {WILSON_HIGH} AS high FROM flagged_year")
def rt_flag_rate(spark: SparkSession, d: str) -> DataFrame:
    return op.flag_rates(signal(spark, d), F.col("length_of_stay") > 5, F.col("admit_year"))
