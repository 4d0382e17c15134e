"""A guarded feature frame, a Spark ML pipeline and grouped cross-validation."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = ["age_at_admit", "conditions_at_admit", "length_of_stay", "prior_stays_12m", "prior_emergency_12m", "encounters_in_stay", "days_since_last_discharge"]
FLAGS = ["has_lab_done", "has_pressure_controlled", "has_drug_taken", "is_planned", "arrived_via_emergency"]
CATEGORIES = ["gender", "admit_reason"]
#: Names that are never features: known too late, the answer, keys, dates or bills.
LEAKS = ("post_", "outcome_")
NEVER = {"patient_id", "stay_no", "first_encounter_id", "admit_day", "discharge_day", "admit_year", "stay_cost"}
NEVER_BEFORE = 3650.0


def guarded(columns: list[str]) -> list[str]:
    """The columns, or an error naming those that must not be features."""
    bad = [c for c in columns if c in NEVER or c.startswith(LEAKS)]
    if bad:
        raise ValueError(f"not features: {bad}")
    return columns


def features(signals: DataFrame, rare: dict[str, list[str]] | None = None) -> DataFrame:
    """The feature frame: numbers, flags as 0/1, a missing indicator, categories as text, rare ones folded."""
    guarded([*NUMBERS, *FLAGS, *CATEGORIES])
    out = signals.withColumn("no_earlier_stay", F.col("days_since_last_discharge").isNull().cast("double")).withColumn("days_since_last_discharge", F.coalesce(F.col("days_since_last_discharge").cast("double"), F.lit(NEVER_BEFORE)))
    out = out.withColumns({c: F.col(c).cast("double") for c in [*NUMBERS, *FLAGS]}).withColumn("label", F.col("outcome_readmitted").cast("double"))
    for c in CATEGORIES:
        value = F.coalesce(F.col(c).cast("string"), F.lit("missing"))
        out = out.withColumn(c, F.when(value.isin(rare[c]), value).otherwise("infrequent") if rare else value)
    return out


def frequent(train: DataFrame, least: int = 20) -> dict[str, list[str]]:
    """Categories with at least ``least`` training rows; others, and unseen ones, are infrequent. The list is as long as the feature vector is wide."""
    return {c: [r[c] for r in train.groupBy(c).count().where(F.col("count") >= least).orderBy(F.desc("count"), c).collect() if r[c] is not None] for c in CATEGORIES}


def pipeline(kind: str = "logistic") -> Pipeline:
    indexed, hot = [f"{c}_index" for c in CATEGORIES], [f"{c}_hot" for c in CATEGORIES]
    numbers = [*NUMBERS, "no_earlier_stay"]
    stages = [Imputer(inputCols=NUMBERS, outputCols=NUMBERS), StringIndexer(inputCols=CATEGORIES, outputCols=indexed, handleInvalid="keep"), OneHotEncoder(inputCols=indexed, outputCols=hot),
              VectorAssembler(inputCols=numbers, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), VectorAssembler(inputCols=["scaled", *FLAGS, *hot], outputCol="features")]
    model = LogisticRegression(regParam=0.01, maxIter=30) if kind == "logistic" else GBTClassifier(maxIter=20, maxDepth=3, seed=7)
    return Pipeline(stages=[*stages, model])


def signs() -> dict[str, Column]:
    """Yes/no features of the plain model; what is missing counts as no."""
    of = {"lab": F.col("has_lab_done"), "pressure": F.col("has_pressure_controlled"), "drug": F.col("has_drug_taken"), "emergency": F.col("arrived_via_emergency"),
          "long": F.col("length_of_stay") > 5, "ill": F.col("conditions_at_admit") > 3, "before": F.col("prior_stays_12m") > 0}
    return {k: F.coalesce(x.cast("boolean"), F.lit(False)) for k, x in of.items()}


def sign_rows(signals: DataFrame) -> DataFrame:
    """``signals`` with the yes/no features as numbers and the label, for ``sign_pipeline``."""
    return signals.withColumns({f"x_{k}": x.cast("double") for k, x in signs().items()}).withColumn("label", F.coalesce("outcome_readmitted", F.lit(False)).cast("double"))


def sign_pipeline() -> Pipeline:
    """Naive Bayes over the yes/no features: its fit is a count, so grouped counts give the same model (``operators.bayes``)."""
    return Pipeline(stages=[VectorAssembler(inputCols=[f"x_{k}" for k in signs()], outputCol="features"), NaiveBayes(modelType="bernoulli", smoothing=1.0)])


def score(model: object, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1]).select(*rows.columns, "score")


def folds(rows: DataFrame, n: int = 5) -> DataFrame:
    """``fold`` of each row, by patient, so that no patient is on both sides."""
    return rows.withColumn("fold", F.pmod(F.xxhash64("patient_id"), F.lit(n)).cast("int"))


def out_of_fold(rows: DataFrame, kind: str = "logistic", n: int = 5) -> DataFrame:
    """Every row scored by a model that never saw its patient."""
    split = folds(rows, n)

    def parts() -> Iterator[DataFrame]:
        for k in range(n):
            yield score(pipeline(kind).fit(split.where(F.col("fold") != k)), split.where(F.col("fold") == k))

    first, *rest = parts()
    for r in rest:
        first = first.unionByName(r)
    return first
