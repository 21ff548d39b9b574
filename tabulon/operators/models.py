"""Random forests and the other classifiers of the leaderboard, as MLlib estimators.

Training is MLlib's: each tree level is one distributed pass that aggregates
split statistics per node (histogram aggregation), so the data never leaves the
executors. The reference's own settings are kept as documented constants; the
catalog queries use smaller forests so they run in seconds.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.ml.feature import StringIndexer

from tabulon.operators.binned import (BinnedForestClassifier, BinnedForestRegressor, BinnedRows, covers,
                                      remember_raw)
from tabulon.operators.features import MAX_INDEX_LEVELS, check_levels
from tabulon.operators.recipes import fitted_on
from tabulon.operators.trees import joined_forest
from tabulon.session import kept

# The reference's MLlib forest settings.
REFERENCE_REGRESSOR = dict(numTrees=754, maxDepth=5, minInstancesPerNode=15, minInfoGain=5.0, seed=1)
REFERENCE_CLASSIFIER = dict(numTrees=136, maxDepth=5, minInstancesPerNode=3, minInfoGain=0.0,
                            featureSubsetStrategy="sqrt", seed=123)


def forest_regressor(label: str = "label", features: str = "features", **params) -> RandomForestRegressor:
    """Defaults: 20 trees, depth 5, 15 rows per leaf, all features per split (the tuned
    scikit-learn forest considers every feature; MLlib's regression default is 1/3)."""
    p = dict(numTrees=20, maxDepth=5, minInstancesPerNode=15, featureSubsetStrategy="all", seed=1)
    p.update(params)
    return BinnedForestRegressor(labelCol=label, featuresCol=features, **p)


def forest_classifier(label: str = "label", features: str = "features", **params) -> RandomForestClassifier:
    p = dict(numTrees=20, maxDepth=5, minInstancesPerNode=3, featureSubsetStrategy="sqrt", seed=123)
    p.update(params)
    return BinnedForestClassifier(labelCol=label, featuresCol=features, **p)


def leaderboard_models(label: str = "label", features: str = "features", seed: int = 123) -> dict[str, Estimator]:
    """The classifier families compared by the AutoML step, all distributed in MLlib."""
    kw = dict(labelCol=label, featuresCol=features)
    return {
        "logistic_regression": LogisticRegression(maxIter=10, **kw),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, seed=seed, **kw),
        "random_forest": forest_classifier(label, features, seed=seed),
        "gradient_boosted_trees": GBTClassifier(maxIter=10, maxDepth=3, seed=seed, **kw),
        "naive_bayes": NaiveBayes(modelType="gaussian", **kw),
        "linear_svc": LinearSVC(maxIter=10, **kw),
    }


def _indexed_columns(stages) -> list[str]:
    cols = []
    for st in stages:
        if isinstance(st, StringIndexer):
            cols += st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]
    return cols


def fit_with_recipe(recipe: Pipeline, estimator: Estimator, train: DataFrame,
                    max_levels: int = MAX_INDEX_LEVELS) -> PipelineModel:
    """Recipe and model fitted together on the training side only (no leakage).

    Columns the recipe indexes are first checked for a bounded number of levels
    (one HyperLogLog pass), because the indexer collects its labels to the driver.
    """
    stages = list(recipe.getStages())
    check_levels(train, _indexed_columns(stages), max_levels)
    return fit_prepared(stages, estimator, train)


#: Most trees that are fitted together: MLlib keeps a number for every row and tree.
TREES_A_FIT = 150


def fit_forest(estimator: RandomForestRegressor, train: DataFrame, trees_a_fit: int = TREES_A_FIT):
    """The forest, a part of its trees at a time where they are many, each part drawn by a seed
    of its own: the drawn numbers of 754 trees do not fit into memory. The parts share the coded
    rows (``binned``); where MLlib fits, node ids are kept, which gives the same trees without a walk
    down each at every level."""
    total = estimator.getOrDefault("numTrees")
    parts = -(-total // trees_a_fit)
    if parts == 1:
        return estimator.fit(train)
    ends = [total * i // parts for i in range(parts + 1)]
    seed = estimator.getOrDefault("seed")
    # the number of the partition is added to the seed
    own = [{"numTrees": ends[i + 1] - ends[i], "seed": seed + 1_000_003 * i, "cacheNodeIds": True} for i in range(parts)]
    fit = lambda e, values: e.fit(train, {e.getParam(p): v for p, v in values.items()})
    shared = BinnedRows(estimator, train) if covers(estimator) else None
    if shared is None or shared.rows is None:
        forests = [fit(estimator, values) for values in own]
    else:
        estimator = estimator.copy()
        estimator.shared_rows = shared
        with kept(shared.rows):
            forests = [fit(estimator, values) for values in own]
    return joined_forest(forests, train.sparkSession)


def fit_prepared(stages: Sequence, estimator: Estimator, train: DataFrame) -> PipelineModel:
    """``Pipeline(stages + [estimator]).fit(train)``; the rows that the stages prepared are kept
    while the estimator reads them, unless it does so once."""
    fitted = fitted_on(Pipeline(stages=list(stages)), train)
    read = [estimator.getOrDefault(p) for p in ("labelCol", "featuresCol", "weightCol")
            if estimator.hasParam(p) and estimator.isDefined(p)]
    fit = fit_forest if isinstance(estimator, RandomForestRegressor) else type(estimator).fit
    prepared = remember_raw(fitted.transform(train).select(*read), fitted, train)
    with nullcontext(prepared) if covers(estimator) else kept(prepared) as prepared:
        return PipelineModel([*fitted.stages, fit(estimator, prepared)])


def extend_fitted(fitted: PipelineModel, estimator: Estimator, train: DataFrame) -> PipelineModel:
    """Append a model to an already fitted pipeline; fitted stages pass through unchanged."""
    return fit_prepared(fitted.stages, estimator, train)


def positive_probability(col: str | Column = "probability") -> Column:
    """P(class 1) from an MLlib probability vector."""
    c = F.col(col) if isinstance(col, str) else col
    return vector_to_array(c)[1]
