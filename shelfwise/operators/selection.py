"""Feature ranking, selection and clustering over an encoded frame.

The search loops run on the driver, but they only hold feature numbers and
scores: every fit and every evaluation is a Spark job over a persisted vector
column, and a subset of features is a slice of that vector.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfwise.functions.staging import dealt_by_rows
from shelfwise.operators.classify import FEATURES, evaluator
from shelfwise.operators.labels import TARGET
from shelfwise.operators.profile import correlation_matrix
from shelfwise.operators.sampling import row_split, stratified_folds
from shelfwise.operators.transforms import moments

MakeEstimator = Callable[[DataFrame], Estimator]


def importances(model: Model) -> np.ndarray:
    """Weight of each feature: forest importance or absolute coefficient."""
    if hasattr(model, "featureImportances"):
        return np.asarray(model.featureImportances.toArray())
    return np.abs(np.asarray(model.coefficients.toArray()))


def _ranking(df: DataFrame, names: Sequence[str], values: np.ndarray, value: str, rank: str, k: int) -> DataFrame:
    order = sorted(range(len(names)), key=lambda i: (-abs(values[i]), names[i]))[:k]
    return df.sparkSession.createDataFrame(
        [(names[i], float(values[i]), r) for r, i in enumerate(order, start=1)],
        f"features string, {value} double, {rank} int",
    )


def rf_importance(df: DataFrame, names: Sequence[str], make: MakeEstimator, k: int = 10) -> DataFrame:
    """The k features with the largest forest importance, ranked from 1."""
    return _ranking(df, names, importances(make(df).fit(df)), "rf_importance", "rf_rank", k)


def abs_coeffs(df: DataFrame, names: Sequence[str], make: MakeEstimator, k: int = 10) -> DataFrame:
    """The k features with the largest absolute coefficient, ranked from 1."""
    model = make(df).fit(df)
    ranked = _ranking(df, names, np.asarray(model.coefficients.toArray()), "coeff", "coeff_rank", k)
    return ranked.select("features", "coeff", F.abs("coeff").alias("coeff_abs"), "coeff_rank")


def sliced(df: DataFrame, indices: Sequence[int]) -> DataFrame:
    """Keep some entries of the feature vector."""
    slicer = VectorSlicer(inputCol=FEATURES, outputCol="sliced", indices=[int(i) for i in indices])
    return slicer.transform(df).drop(FEATURES).withColumnRenamed("sliced", FEATURES)


def _fit_score(make: MakeEstimator, train: DataFrame, test: DataFrame, indices: Sequence[int], metric: str) -> tuple[Model, float]:
    rows = sliced(train, indices)
    model = make(rows).fit(rows)
    return model, evaluator(metric).evaluate(model.transform(sliced(test, indices)))


def _side_by_side(spark: SparkSession, task: Callable, items: Sequence, parallelism: int) -> list:
    """Results of ``task`` in the order of ``items``. A fit is a chain of short jobs that
    leave cores idle, so several run at once; none depends on another."""
    with ThreadPool(max(1, min(parallelism, len(items)))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items, chunksize=1)


def _eliminate(make: MakeEstimator, train: DataFrame, test: DataFrame | None, p: int, until: int, metric: str):
    """Drop the weakest feature one at a time; yields (indices, score)."""
    left = list(range(p))
    while True:
        if test is None:
            rows = sliced(train, left)
            model, value = make(rows).fit(rows), float("nan")
        else:
            model, value = _fit_score(make, train, test, left, metric)
        yield list(left), value
        if len(left) <= until:
            return
        weights = importances(model)
        left.pop(min(range(len(left)), key=lambda i: (weights[i], -left[i])))


def rfe_cv(
    df: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    make: MakeEstimator,
    folds: int = 3,
    metric: str = "auc",
    seed: int = 0,
    parallelism: int = 3,
) -> DataFrame:
    """Recursive elimination: the number of features with the best mean fold
    score, and the features that stay at that number. One row per feature. The folds are
    worked through side by side."""
    p = len(names)
    dealt = dealt_by_rows(stratified_folds(df, list(keys), TARGET, folds, seed), keys).persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()  # fills the rows once, before the folds start together

    def fold_scores(fold: int) -> dict[int, float]:
        train, test = dealt.where(F.col("fold") != fold), dealt.where(F.col("fold") == fold)
        return {len(indices): value for indices, value in _eliminate(make, train, test, p, 1, metric)}

    scores = np.zeros(p + 1)
    for found in _side_by_side(df.sparkSession, fold_scores, range(folds), parallelism):
        for size, value in found.items():
            scores[size] += value / folds
    best = 1 + int(np.argmax(scores[1:]))
    steps = list(_eliminate(make, dealt, None, p, best, metric))
    dealt.unpersist()
    # A feature's rank is 1 when kept, and grows with how early it was dropped.
    kept_at = {i: min(len(indices) for indices, _ in steps if i in indices) for i in range(p)}
    return df.sparkSession.createDataFrame(
        [(names[i], kept_at[i] == best, kept_at[i] - best + 1, float(scores[kept_at[i]])) for i in range(p)],
        "features string, selected boolean, ranking int, mean_score double",
    )


def best_subset(
    df: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    make: MakeEstimator,
    k: int,
    test_share: float = 0.25,
    seed: int = 1,
    parallelism: int = 3,
) -> DataFrame:
    """Backward search: from all features, drop the one without which the
    hold-out AUC is best, down to k features. One row per step; ``is_best`` marks
    the best-scoring subset, the larger one on a tie. The subsets of a step are fitted
    side by side."""
    train, test = row_split(df, list(keys), test_share, seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    test = test.persist(StorageLevel.MEMORY_AND_DISK)

    def auc(indices: Sequence[int]) -> float:
        return _fit_score(make, train, test, indices, "auc")[1]

    subset = tuple(range(len(names)))
    steps = [(subset, auc(subset))]
    while len(subset) > k:
        smaller = [subset[:i] + subset[i + 1 :] for i in range(len(subset))]
        scores = _side_by_side(df.sparkSession, auc, smaller, parallelism)
        place = int(np.argmax(scores))
        subset = smaller[place]
        steps.append((subset, scores[place]))
    train.unpersist()
    test.unpersist()
    best = max(range(len(steps)), key=lambda i: (steps[i][1], -i))
    return df.sparkSession.createDataFrame(
        [(len(s), [names[i] for i in s], float(v), n == best) for n, (s, v) in enumerate(steps)],
        "n_features int, features array<string>, auc double, is_best boolean",
    )


def _ward(squared: np.ndarray, n_clusters: int) -> list[int]:
    """Merge the two clusters whose union adds least variance until n are left.

    Works on the p x p squared distances of the features.
    """
    p = len(squared)
    # Ward's cost of merging two single points is half their squared distance.
    cost = squared / 2.0
    np.fill_diagonal(cost, np.inf)
    size = np.ones(p)
    label = np.arange(p)
    for _ in range(p - n_clusters):
        i, j = sorted(divmod(int(np.argmin(cost)), p))
        others = np.isfinite(cost[i]) & np.isfinite(cost[j])
        total = size[i] + size[j] + size
        merged = ((size[i] + size) * cost[i] + (size[j] + size) * cost[j] - size * cost[i, j]) / total
        cost[i, others] = cost[others, i] = merged[others]
        cost[j, :] = cost[:, j] = np.inf
        size[i] += size[j]
        label[label == j] = i
    numbers = {root: n for n, root in enumerate(dict.fromkeys(label.tolist()))}
    return [numbers[root] for root in label.tolist()]


def feature_clusters(df: DataFrame, columns: Sequence[str], n_clusters: int, standardized: bool = True) -> DataFrame:
    """Cluster features by how alike their columns are.

    Spark reduces the rows to the p x p matrix of products; the clustering only
    sees that matrix.
    """
    columns = list(columns)
    fitted = moments(df, columns)
    spread = np.array([1.0 if s == 1.0 else s for _, s in (fitted[c] for c in columns)])
    matrix = np.nan_to_num(correlation_matrix(df, columns))
    np.fill_diagonal(matrix, 1.0)
    constant = df.agg(
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(columns)]
    ).first()
    alive = np.array([1.0 if constant[i] else 0.0 for i in range(len(columns))])
    if standardized:
        gram = matrix * np.outer(alive, alive)
    else:
        means = np.array([fitted[c][0] for c in columns])
        scale = spread * alive
        gram = matrix * np.outer(scale, scale) + np.outer(means, means)
    diagonal = np.diag(gram)
    squared = np.maximum(diagonal[:, None] + diagonal[None, :] - 2.0 * gram, 0.0)
    labels = _ward(squared, n_clusters)
    return df.sparkSession.createDataFrame(
        list(zip(columns, labels, strict=True)), "features string, cluster_number int"
    ).orderBy("cluster_number", "features")
