"""Purchase classifiers: encoding, training, search and scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from random import Random
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfwise.functions.columns import numeric_columns, quoted, replace_inf, string_columns
from shelfwise.functions.staging import dealt_by_rows, stage
from shelfwise.operators.evaluate import evaluation_report
from shelfwise.operators.labels import TARGET
from shelfwise.operators.sampling import row_split
from shelfwise.operators.transforms import categories, moments, one_hot, standardize

FEATURES = "features"
WEIGHT = "weight"
PROBABILITY = "probability_1"


def class_weights(df: DataFrame, label: str = TARGET, weight: str = WEIGHT) -> DataFrame:
    """Add the balanced weight: rows / (classes x rows of the class).

    The counts, a row per class, are sent to every task: a join dealt by the label would
    lay all rows of a class in one task. Rows without a label get no weight.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("class_n"))
    totals = counts.agg(F.sum("class_n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    per_class = counts.select(
        F.col(label).alias("class_label"),
        (F.lit(totals.rows).cast("double") / (F.lit(totals.classes) * F.col("class_n"))).alias(weight),
    )
    return df.join(F.broadcast(per_class), F.col(label) == F.col("class_label"), "left").select(*df.columns, weight)


@dataclass(frozen=True)
class Encoder:
    """Fitted encoding: standardised numbers, then 0/1 columns per category."""

    keys: list[str]
    numbers: dict[str, tuple[float, float]]
    levels: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numbers, *[f"{c}_{v}" for c, values in self.levels.items() for v in values]]

    def columns(self, df: DataFrame) -> DataFrame:
        """Keys, label and one numeric column per feature."""
        return one_hot(standardize(replace_inf(df), self.numbers), self.levels).select(
            *self.keys, TARGET, *[quoted(n) for n in self.names]
        )

    def vectors(self, df: DataFrame) -> DataFrame:
        """Keys, label and the feature vector. The keys stay with their row, so
        no step joins by position."""
        wide = self.columns(df).select(
            *self.keys,
            F.col(TARGET).cast("double").alias(TARGET),
            *[
                F.coalesce(quoted(n).cast("double"), F.lit(0.0)).alias(f"f{i}")
                for i, n in enumerate(self.names)
            ],
        )
        inputs = [f"f{i}" for i in range(len(self.names))]
        assembled = VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(wide)
        return assembled.select(*self.keys, TARGET, FEATURES)


def fit_encoder(train: DataFrame, keys: Sequence[str], features: Sequence[str] | None = None) -> Encoder:
    """Learn means, deviations and categories from the training rows."""
    kept = replace_inf(train.select(*[quoted(c) for c in features])) if features else replace_inf(train)
    skip = (*keys, TARGET)
    numbers = numeric_columns(kept, skip)
    strings = string_columns(kept, skip)
    return Encoder(
        list(keys),
        moments(kept, numbers) if numbers else {},
        categories(kept, strings) if strings else {},
    )


@dataclass(frozen=True)
class Splits:
    """Encoded train, test and validation rows with balanced training weights."""

    encoder: Encoder
    train: DataFrame
    test: DataFrame
    valid: DataFrame


def prepare(
    train: DataFrame,
    valid: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] | None = None,
    test_share: float = 0.2,
    seed: int = 0,
) -> Splits:
    """Split train into train and test, fit the encoding on train, encode all."""
    fit_rows, test_rows = row_split(train, list(keys), test_share, seed)
    encoder = fit_encoder(fit_rows, keys, features)
    return Splits(
        encoder,
        dealt_by_rows(class_weights(stage(encoder.vectors(fit_rows), "train")), keys),
        stage(encoder.vectors(test_rows), "test"),
        stage(encoder.vectors(valid), "valid"),
    )


def logistic(train: DataFrame, reg_param: float = 1.0, iterations: int = 100) -> Estimator:
    """L1 logistic regression; ``reg_param`` is the inverse penalty, so the
    penalty per weighted row is 1 / (reg_param x total weight)."""
    total = train.agg(F.sum(WEIGHT)).first()[0]
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=TARGET,
        weightCol=WEIGHT,
        elasticNetParam=1.0,
        regParam=1.0 / (max(reg_param, 1e-9) * total),
        standardization=False,
        maxIter=iterations,
    )


def forest(
    train: DataFrame, n_estimators: int = 500, max_features: str = "auto", max_depth: int = 5, seed: int = 0
) -> Estimator:
    """Balanced random forest. ``auto`` means the square root of the features."""
    return RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=TARGET,
        weightCol=WEIGHT,
        numTrees=int(n_estimators),
        featureSubsetStrategy={"auto": "sqrt"}.get(max_features, max_features),
        maxDepth=int(max_depth),
        seed=seed,
    )


def boosting(
    train: DataFrame,
    rounds: int = 200,
    max_depth: int = 5,
    eta: float = 0.1,
    subsample: float = 1.0,
    gamma: float = 0.0,
    min_child_weight: int = 1,
    seed: int = 0,
) -> Estimator:
    """Gradient-boosted trees. A column ``is_validation`` turns on early stopping."""
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol=TARGET,
        maxIter=int(rounds),
        maxDepth=int(max_depth),
        stepSize=float(eta),
        subsamplingRate=float(subsample),
        minInfoGain=float(gamma),
        minInstancesPerNode=int(min_child_weight),
        seed=seed,
        **({"validationIndicatorCol": "is_validation"} if "is_validation" in train.columns else {}),
    )


def with_validation(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training rows and test rows in one frame, the latter marked for early stopping."""
    return train.drop(WEIGHT).withColumn("is_validation", F.lit(False)).unionByName(
        test.withColumn("is_validation", F.lit(True))
    )


def network(
    train: DataFrame, hidden: Sequence[int] = (32, 16), epochs: int = 100, step: float = 0.03, seed: int = 0
) -> Estimator:
    """Dense network with sigmoid layers; a regression layer of two outputs."""
    width = len(train.select(FEATURES).first()[0])
    return MultilayerPerceptronClassifier(
        featuresCol=FEATURES,
        labelCol=TARGET,
        layers=[width, *[int(h) for h in hidden], 2],
        maxIter=int(epochs),
        stepSize=float(step),
        seed=seed,
    )


BUILDERS: dict[str, Callable[..., Estimator]] = {
    "logistic": logistic,
    "forest": forest,
    "boosting": boosting,
    "network": network,
}

# The searched settings. A pair of numbers is a range, a list is a
# choice; whole-number ranges are drawn as whole numbers.
SPACES: dict[str, dict[str, object]] = {
    "logistic": {"reg_param": (0.0, 10.0)},
    "forest": {
        "max_depth": (3, 12),
        "n_estimators": (50, 1000),
        "max_features": ["auto", "sqrt", "log2"],
    },
    "boosting": {
        "max_depth": (3, 12),
        "eta": (0.05, 0.5),
        "min_child_weight": (2, 8),
        "subsample": (0.5, 0.9),
        "gamma": (0.0, 10.0),
    },
    "network": {"hidden": [(16,), (32, 16), (64, 32)], "epochs": (50, 500), "step": (0.001, 0.1)},
}


def draw(space: Mapping[str, object], random: Random) -> dict[str, object]:
    """One random setting of a search space."""
    out = {}
    for name, values in space.items():
        if isinstance(values, list):
            out[name] = random.choice(values)
        elif isinstance(values[0], int):
            out[name] = random.randint(*values)
        else:
            out[name] = random.uniform(*values)
    return out


def evaluator(metric: str):
    if metric == "auc":
        return BinaryClassificationEvaluator(labelCol=TARGET, rawPredictionCol="rawPrediction")
    return MulticlassClassificationEvaluator(labelCol=TARGET, metricName=metric)


@dataclass(frozen=True)
class Search:
    """Trials (best first), best settings and the best model."""

    trials: DataFrame
    best: dict[str, object]
    model: Model


def tune_classifier(
    kind: str,
    train: DataFrame,
    test: DataFrame,
    trials: int = 20,
    parallelism: int = 3,
    metric: str = "auc",
    space: Mapping[str, object] | None = None,
    seed: int = 0,
) -> Search:
    """Seeded random search that maximises a metric of the test rows.

    Trials run side by side as Spark jobs over one persisted training frame. Settings and
    metrics of all trials reach the driver, and the model of the best so far: at no time
    are there more models than trials under way and one.
    """
    random = Random(seed)
    settings = [draw(space or SPACES[kind], random) for _ in range(trials)]
    rows = with_validation(train, test) if kind == "boosting" else train
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    score = evaluator(metric)

    lead: list[tuple[float, int, Model]] = []
    lock = Lock()

    @inheritable_thread_target(train.sparkSession)
    def run(number: int) -> tuple[int, float]:
        model = BUILDERS[kind](rows, **settings[number]).fit(rows)
        value = score.evaluate(model.transform(test))
        with lock:
            if not lead or (value, -number) > lead[0][:2]:
                lead[:] = [(value, -number, model)]
        return number, value

    with ThreadPool(min(parallelism, trials)) as pool:
        results = pool.map(run, range(trials))
    rows.unpersist()
    (_, minus, best_model), = lead
    table = train.sparkSession.createDataFrame(
        [(n, value, {k: str(v) for k, v in settings[n].items()}) for n, value in results],
        "iteration int, objective double, params map<string,string>",
    )
    return Search(
        table.orderBy(F.desc("objective"), "iteration"), settings[-minus], best_model
    )


def score(model: Model, df: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Keys, label, probability of class 1 and prediction at a cut-off."""
    scored = model.transform(df).withColumn(
        PROBABILITY, vector_to_array("probability")[1]
    )
    kept = [c for c in df.columns if c not in (FEATURES, WEIGHT)]
    return scored.select(
        *kept, PROBABILITY, (F.col(PROBABILITY) > cutoff).cast("int").alias("prediction")
    )


def train(kind: str, splits: Splits, settings: Mapping[str, object]) -> Model:
    """Fit the chosen settings on train; boosting stops early on the test rows."""
    rows = with_validation(splits.train, splits.test) if kind == "boosting" else splits.train
    return BUILDERS[kind](rows, **settings).fit(rows)


def train_evaluate(
    kind: str, splits: Splits, settings: Mapping[str, object], cutoff: float = 0.5
) -> tuple[Model, DataFrame]:
    """Fit the chosen settings on train and report on the validation rows."""
    model = train(kind, splits, settings)
    scored = stage(score(model, splits.valid, cutoff), "scored")
    return model, evaluation_report(scored, TARGET, "prediction", PROBABILITY)
