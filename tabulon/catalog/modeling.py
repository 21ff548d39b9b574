"""Model queries: forests, save/load, pipeline extension, batch scoring, tuning,
leaderboard, Shapley attributions.

Forest results depend on how MLlib samples per partition, so these queries return
invariants an oracle can state exactly: how many held-out rows were scored, how
many predictions lie in the range a forest can produce, whether a reloaded model
predicts identically, whether Shapley values add up. The held-out side is the
same md5 hash split in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.catalog.features import REG_INDEX, REG_ONEHOT, REG_RAW, REG_SCALED
from tabulon.catalog.registry import query, t
from tabulon.functions.scalar import binary_label, net_amount
from tabulon.operators import explain as X
from tabulon.operators import features as FE
from tabulon.operators import metrics as M
from tabulon.operators import models as MD
from tabulon.operators import trees as T
from tabulon.operators import tuning as TU
from tabulon.operators.ordering import top_k
from tabulon.operators.score import score_claims, score_fraud
from tabulon.operators.split import hash_split, with_folds
from tabulon.session import cut_lineage, shared_path, spread, written
from tabulon.sources.models import load_model, save_model

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# The line key repeats once at sf0.001; price and ship date make a record id unique.
RECORD_ID = LINE_KEY + ["l_extendedprice", "l_shipdate"]
THRESHOLD = 50_000.0
NET_SQL = "l_extendedprice*(1-l_discount)*(1+l_tax)"

_BUCKET = ("cast('0x' || substr(md5(concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar), "
           "cast(l_suppkey as varchar), cast(l_linenumber as varchar), '123')), 1, 8) as bigint) % 1000000")
TEST_SIDE = f"(select * from lineitem where {_BUCKET} >= 800000)"
TRAIN_SIDE = f"(select * from lineitem where {_BUCKET} < 800000)"


def claims(spark, sf):
    """lineitem as claim records: raw features, the charged amount, a Y/N flag."""
    return claims_from(t(spark, sf, "lineitem"))


def claims_from(li):
    """The claim projection of a lineitem DataFrame (batch or stream)."""
    net = net_amount()
    return li.select(*LINE_KEY, "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus", net.alias("net_amount"),
                     F.when(net > THRESHOLD, "Y").otherwise("N").alias("fraud_reported"))


#: Rows that one partition of a training or scoring side holds.
ROWS_A_PARTITION = 100_000


def spread_by_key(df, keys):
    """``spread`` with a partition for so many rows, 16 at least: a small table read from
    one unsplittable file would else be fitted by one task."""
    return spread(df, keys, max(16, -(-df.count() // ROWS_A_PARTITION)))


def claims_split(spark, sf):
    """(train, test); what is fitted on is written, as a fit reads it several times over, scoring
    reads the table as it lies."""
    train, test = claims_sides(spark, sf)
    return written(train), test


def claims_sides(spark, sf):
    """(train, test) as they lie in the table."""
    return hash_split(claims(spark, sf), LINE_KEY, seed=123, train_fraction=0.8)


REG_FEATURES = REG_INDEX + REG_SCALED + REG_RAW  # raw columns the regression recipe reads
CLS_CAT = ["l_returnflag", "l_linestatus"]
CLS_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]  # quantity alone carries no signal here


def regression_model(train, **forest):
    recipe = FE.regression_recipe(REG_INDEX, REG_ONEHOT, REG_SCALED, REG_RAW)
    return MD.fit_with_recipe(recipe, MD.forest_regressor(label="net_amount", **forest), train)


def with_label(df):
    return df.withColumn("label", binary_label("fraud_reported", {"Y": 1, "N": 0}))


def classification_model(train, **forest):
    recipe = FE.feature_recipe(CLS_CAT, CLS_NUM)
    return MD.fit_with_recipe(recipe, MD.forest_classifier(label="label", **forest), with_label(train))


def _count_oracle(*cols: str, side: str = TEST_SIDE) -> str:
    return "select " + ", ".join(f"count(*) as {c}" for c in cols) + f" from {side}"


# ------------------------------------------------------------------ flagship

def flagship(spark, sf):
    """Fit the claim-amount pipeline on the training side, score the held-out side,
    and summarise the claim flags: (Claim_Status, n, avg_expected, avg_actual)."""
    train, test = claims_split(spark, sf)
    model = regression_model(train)
    scored = score_claims(model, test, "net_amount", LINE_KEY)
    return scored.groupBy("Claim_Status").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("Expected_Expenses"), 2).alias("avg_expected"),
        F.round(F.avg("Actual_Expenses"), 2).alias("avg_actual"))


# -------------------------------------------------------------------- forests

def _regress(spark, sf, bar, **forest):
    """Held-out rows scored once: how many lie in the training labels' range (a forest
    averages labels), and whether R² clears the bar and agrees with MLlib's."""
    train, test = claims_split(spark, sf)
    model = regression_model(train, **forest)
    lo, hi = train.agg(F.min("net_amount"), F.max("net_amount")).first()
    pred = cut_lineage(model.transform(test).select("net_amount", "prediction"))
    r2 = RegressionEvaluator(labelCol="net_amount", metricName="r2").evaluate(pred)
    own = M.regression_metrics(pred, "net_amount", "prediction").first()["r2"]
    return pred.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.col("prediction").between(lo - 1e-6, hi + 1e-6)).alias("n_in_range")) \
               .select("*", F.lit(r2 > bar).alias("good_fit"), F.lit(abs(r2 - own) <= 1e-4).alias("same_r2"))


_REGRESS_ORACLE = f"""select count(*) as n_scored, count(*) as n_in_range, true as good_fit, true as same_r2
from {TEST_SIDE}"""


@query("rf_regress", oracle=_REGRESS_ORACLE)
def q_rf_regress(spark, sf):
    """Forest regression of the charged amount; held-out R² must exceed 0.9."""
    return _regress(spark, sf, 0.9)


@query("rf_regress_reference", oracle=_REGRESS_ORACLE)
def q_rf_regress_reference(spark, sf):
    """The same with the reference's own forest (754 trees)."""
    return _regress(spark, sf, 0.9, **MD.REFERENCE_REGRESSOR)


@query("rf_classify", oracle=f"""
select count(*) as n_scored, count(*) as n_prob_in_range, count(*) as n_pred_valid, true as better_than_chance,
       true as same_auc from {TEST_SIDE}
""")
def q_rf_classify(spark, sf):
    """Forest classification of 'charged over 50,000' with the reference's 136 trees;
    held-out AUC must beat 0.9 and agree with MLlib's on the same rows."""
    train, test = claims_split(spark, sf)
    model = classification_model(train, numTrees=MD.REFERENCE_CLASSIFIER["numTrees"])
    pred = model.transform(with_label(test)).withColumn("p1", MD.positive_probability())
    pred = written(pred.select("label", "p1", "prediction", "rawPrediction"))  # scored once
    auc = M.auc(pred, "label", "p1").first()["auc"]
    mllib = _auc_evaluator().evaluate(pred)
    return pred.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("p1").between(0.0, 1.0)).alias("n_prob_in_range"),
        F.count_if(F.col("prediction") == (F.col("p1") > 0.5).cast("double")).alias("n_pred_valid")) \
        .select("*", F.lit(auc > 0.9).alias("better_than_chance"), F.lit(abs(auc - mllib) <= 1e-4).alias("same_auc"))


@query("model_roundtrip", oracle=_count_oracle("n_scored", "n_equal"))
def q_model_roundtrip(spark, sf):
    """Save the fitted pipeline to the shared folder, load it, predictions must agree."""
    train, test = claims_split(spark, sf)
    model = regression_model(train)
    path = save_model(model, shared_path(spark, "models", "claims_rf", unique=True))
    again = load_model(path)
    both = model.transform(test).select(*test.columns, F.col("prediction").alias("p_mem"))
    both = again.transform(both)  # the loaded pipeline on the same rows
    return both.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.abs(F.col("p_mem") - F.col("prediction")) <= 1e-9).alias("n_equal"))


@query("pipeline_extend", oracle=f"select count(*) as n_scored, count(*) as n_same, true as better_than_chance from {TEST_SIDE}")
def q_pipeline_extend(spark, sf):
    """Fit the feature recipe, then append a forest to the fitted stages and fit again:
    the predictions are those of fitting both together, and beat chance."""
    train, test = claims_split(spark, sf)
    train, test = with_label(train), with_label(test)
    recipe = FE.feature_recipe(CLS_CAT, CLS_NUM)
    extended = MD.extend_fitted(recipe.fit(train), MD.forest_classifier(), train)
    together = MD.fit_with_recipe(recipe, MD.forest_classifier(), train)
    a = extended.transform(test).select(*test.columns, MD.positive_probability().alias("p_ext"))
    pred = cut_lineage(together.transform(a).select("label", "p_ext", MD.positive_probability().alias("p1")))
    auc = M.auc(pred, "label", "p_ext").first()["auc"]
    return pred.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.abs(F.col("p_ext") - F.col("p1")) <= 1e-9).alias("n_same")) \
               .withColumn("better_than_chance", F.lit(auc > 0.9))


# -------------------------------------------------------------------- scoring

_SCORE_ORACLE = f"""select count(*) as n_scored, count(*) as n_status_valid, true as good_fit
from (select {NET_SQL} as net_amount from {TEST_SIDE})"""


def _status_check(scored):
    """Flags recomputed from the saved amounts, and a bar on how well they fit."""
    status = F.expr("case when round(Expected_Expenses, 2) < round(Actual_Expenses, 2) "
                    "then 'Abnormal Claim' else 'Normal Claim' end")
    r2 = 1 - F.sum(F.pow(F.col("Expected_Expenses") - F.col("Actual_Expenses"), 2)) / (
        F.var_pop("Actual_Expenses") * F.count(F.lit(1)))
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("Claim_Status") == status).alias("n_status_valid"),
                      (r2 > 0.9).alias("good_fit"))


@query("score_claims", oracle=_SCORE_ORACLE)
def q_score_claims(spark, sf):
    """Score every held-out claim; the flags are recomputed from the written amounts, which
    must explain the actual ones."""
    train, test = claims_split(spark, sf)
    return _status_check(score_claims(regression_model(train), test, "net_amount", LINE_KEY))


@query("score_fraud", oracle=f"""select count(*) as n_scored, count(*) as n_text_valid, true as finds_fraud
from {TEST_SIDE}""")
def q_score_fraud(spark, sf):
    """Score held-out records without their label with the saved-and-loaded classifier; the
    text must follow the probability, and 80 % of the records must be judged right
    (a constant answer is right for fewer)."""
    train, test = claims_split(spark, sf)
    model = classification_model(train)
    model = load_model(save_model(model, shared_path(spark, "models", "fraud_rf", unique=True)))
    out = score_fraud(model, test.drop("fraud_reported"), [*LINE_KEY, "net_amount", "probability"])
    abnormal = F.col("Model Prediction") == "Abnormal Policy"
    right = abnormal == (F.col("net_amount") > THRESHOLD)
    valid = F.col("Model Prediction") == F.when(MD.positive_probability() > 0.5, "Abnormal Policy").otherwise("Normal Policy")
    return out.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(valid).alias("n_text_valid"),
                   ((F.count_if(right) > 0.8 * F.count(F.lit(1))) & (F.count_if(abnormal) > 0)
                    & (F.count_if(~abnormal) > 0)).alias("finds_fraud"))


# --------------------------------------------------------------------- tuning

def _train_folds(spark, sf, k):
    """Labelled training side with a hash fold column, read by every fold."""
    train, _ = claims_sides(spark, sf)
    return written(with_folds(with_label(train), LINE_KEY, k))


def _auc_evaluator():
    """Exact ROC AUC (numBins=0: no down-sampling of the curve)."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


def _r2_evaluator():
    return RegressionEvaluator(labelCol="net_amount", predictionCol="prediction", metricName="r2")


def _cls_recipe():
    return FE.feature_recipe(CLS_CAT, CLS_NUM)


def _reg_recipe():
    return FE.regression_recipe(REG_INDEX, REG_ONEHOT, REG_SCALED, REG_RAW)


REG_KEEP = ("net_amount", "features")


@query("cv_score", oracle=f"""select 10 as n_folds, count(*) as n_validated, true as beats_bar, true as folds_agree
from {TRAIN_SIDE}""")
def q_cv_score(spark, sf):
    """10-fold cross-validated AUC of the forest on the training side, the recipe fitted
    anew in every fold: every row is validated once, every fold beats 0.9 and none is
    far from the mean."""
    data = _train_folds(spark, sf, 10)
    trial, = TU.cross_validate(MD.forest_classifier(), {}, _auc_evaluator(), data, 10, recipe=_cls_recipe())
    scores = trial.scores["score"]
    return data.where(F.col("fold").between(0, 9)).agg(F.count(F.lit(1)).alias("n_validated")).select(
        F.lit(len(scores)).alias("n_folds"), "n_validated", F.lit(min(scores) > 0.9).alias("beats_bar"),
        F.lit(max(abs(s - trial.mean("score")) for s in scores) < 0.1).alias("folds_agree"))


@query("validation_curve", oracle="""
select 'maxDepth' as param, v as param_value, true as beats_bar, v = 1 as is_worst
from (values (1.0::double), (3.0::double), (5.0::double)) s(v) where (select count(*) from lineitem) > 0
""")
def q_validation_curve(spark, sf):
    """Mean 3-fold AUC for depths 1, 3, 5; a forest of stumps must do worst."""
    curve = TU.validation_curve(MD.forest_classifier(), "maxDepth", [1, 3, 5], _auc_evaluator(),
                                _train_folds(spark, sf, 3), 3, recipe=_cls_recipe())
    least = curve.agg(F.min("mean_score")).first()[0]
    return curve.select("param", "param_value", (F.col("mean_score") > 0.6).alias("beats_bar"),
                        (F.col("mean_score") == least).alias("is_worst"))


def _grid_check(spark, sf, estimator, grid, evaluator, k, recipe, bar, keep, refit_score):
    """The result table with checks: ranks follow the means, and the best setting, refitted
    on the training side, clears the bar on the held-out side."""
    data = _train_folds(spark, sf, k)
    trials = TU.cross_validate(estimator, grid, evaluator, data, k, recipe=recipe, keep=keep)
    model = TU.refit(estimator, TU.best_params(trials), data, recipe)
    held_out = with_label(claims_sides(spark, sf)[1])
    good = refit_score(model.transform(held_out)) > bar
    table = TU.results_table(spark, trials)
    better = Window.orderBy(F.desc("mean_test_score"))
    return table.select("params", F.col("mean_test_score").between(bar, 1.0).alias("in_range"),
                        (F.rank().over(better) <= F.col("rank_test_score")).alias("rank_follows"),
                        (F.col("rank_test_score") <= 2).alias("in_top_two"),
                        F.lit(good).alias("best_generalises"))


_GRID = "(values (1, 10), (1, 20), (5, 10), (5, 20)) s(d, n)"
_GRID_ORACLE = f"""select '{{"maxDepth": ' || d || ', "numTrees": ' || n || '}}' as params, true as in_range,
       true as rank_follows, d > 1 as in_top_two, true as best_generalises from {_GRID}
where (select count(*) from lineitem) > 0"""


@query("grid_search", oracle=_GRID_ORACLE)
def q_grid_search(spark, sf):
    """2x2 grid (maxDepth x numTrees), 3 folds, by AUC: one row per setting; the deeper
    forests must rank before the stumps."""
    return _grid_check(spark, sf, MD.forest_classifier(), {"maxDepth": [1, 5], "numTrees": [10, 20]}, _auc_evaluator(),
                       3, _cls_recipe(), 0.6, ("label", "features"), lambda p: _auc_evaluator().evaluate(p))


@query("grid_search_regression", oracle=_GRID_ORACLE)
def q_grid_search_regression(spark, sf):
    """The same grid for the regression forest, by R²."""
    return _grid_check(spark, sf, MD.forest_regressor(label="net_amount"), {"maxDepth": [1, 5], "numTrees": [10, 20]},
                       _r2_evaluator(), 3, _reg_recipe(), 0.2, REG_KEEP, lambda p: _r2_evaluator().evaluate(p))


_MODELS = ["logistic_regression", "decision_tree", "random_forest", "gradient_boosted_trees",
           "naive_bayes", "linear_svc"]


@query("model_leaderboard", oracle="select m as model, true as beats_chance, true as rank_follows, true as best_generalises"
       " from (values " + ", ".join(f"('{m}')" for m in _MODELS) + ") s(m) where (select count(*) from lineitem) > 0")
def q_model_leaderboard(spark, sf):
    """Six classifier families under one 3-fold scheme by AUC and accuracy, ranked by AUC;
    the best one, fitted on the training side, is scored on the held-out side."""
    # NaiveBayes needs non-negative features: min-max scaled and one-hot inputs are.
    accuracy = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    board, best = TU.leaderboard(MD.leaderboard_models(), {"auc": _auc_evaluator(), "accuracy": accuracy},
                                 _train_folds(spark, sf, 3), 3, recipe=_cls_recipe())
    held_out = _auc_evaluator().evaluate(best.transform(with_label(claims_sides(spark, sf)[1])))
    return board.select("model", ((F.col("mean_auc") > 0.6) & (F.col("mean_accuracy") > 0.5)).alias("beats_chance"),
                        (F.rank().over(Window.orderBy(F.desc("mean_auc"))) == F.col("rank")).alias("rank_follows"),
                        F.lit(held_out > 0.95).alias("best_generalises"))


# ------------------------------------------------------------------- Shapley

def _with_row_id(df):
    return df.withColumn("row_id", F.concat_ws("|", *[F.col(c).cast("string") for c in RECORD_ID]))


#: Training rows whose mean output is the base value of the attributions.
BACKGROUND = 100


def _tree_shapley(spark, sf, kind, rows_fn):
    """(exact attributions, model, rows) of the held-out side's rows."""
    train, test = claims_split(spark, sf)
    rows = cut_lineage(_with_row_id(rows_fn(test)))
    if kind == "regression":
        model, cols, scaled = regression_model(train), REG_FEATURES, REG_SCALED
    else:
        model, cols, scaled = classification_model(train), CLS_CAT + CLS_NUM, CLS_NUM
    bg = X.background_sample(train, cols, BACKGROUND, RECORD_ID)
    return T.tree_shapley_wide(model, rows, "row_id", cols, bg, scaled), model, rows


_TOP5 = f"(select * from {TEST_SIDE} order by l_orderkey, l_partkey, l_suppkey, l_linenumber limit 5)"


@query("shapley_summary", oracle=f"""select count(*) as n_rows, count(*) as n_additive, {len(REG_FEATURES)} as n_features,
       true as one_base, true as amount_leads from {TEST_SIDE}""")
def q_shapley_summary(spark, sf):
    """Exact attributions for every held-out row against 100 background rows: they add up to
    the model's own prediction, all rows have one base value, and the charged amount is
    explained by price above all."""
    wide, model, rows = _tree_shapley(spark, sf, "regression", lambda test: test)
    wide = cut_lineage(wide)
    fx = model.transform(rows).select("row_id", "prediction")
    total = sum((F.col(f"phi__{c}") for c in REG_FEATURES), F.col("base"))
    ranked = [r["feature"] for r in X.shapley_summary_wide(wide, REG_FEATURES, top=10).collect()]
    return wide.join(fx, "row_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(total - F.col("prediction")) <= 1e-6 * F.abs("prediction")).alias("n_additive"),
        (F.max("base") - F.min("base") <= 1e-6 * F.max(F.abs("base"))).alias("one_base")) \
        .withColumns({"n_features": F.lit(len(ranked)), "amount_leads": F.lit(ranked[0] in ("l_extendedprice", "l_quantity"))})


@query("shapley_local", oracle=f"""
select count(*) as n_records, count(*) * {len(REG_FEATURES)} as n_values, count(*) as n_additive, true as one_base
from {_TOP5}
""")
def q_shapley_local(spark, sf):
    """Local attribution of the first 5 held-out records (by key): one value per feature."""
    wide = cut_lineage(_tree_shapley(spark, sf, "regression", lambda test: top_k(test, 5, LINE_KEY))[0])
    contrib = X.contributions_from_wide(wide, "row_id", REG_FEATURES)
    add = X.additivity_wide(wide, "row_id", REG_FEATURES)
    return add.agg(F.count(F.lit(1)).alias("n_records"),
                   contrib.agg(F.count(F.lit(1))).scalar().alias("n_values"),
                   F.count_if("additive").alias("n_additive"),
                   (F.max("base") - F.min("base") <= 1e-6 * F.max(F.abs("base"))).alias("one_base"))


@query("shapley_class1", oracle=f"select count(*) as n_records, count(*) as n_additive, count(*) as n_fx_same from {TEST_SIDE}")
def q_shapley_class1(spark, sf):
    """Class-1 attribution of the fraud classifier for every held-out record: values add up
    to the positive probability that the classifier gives the record."""
    cols = CLS_CAT + CLS_NUM
    wide, model, rows = _tree_shapley(spark, sf, "classification", lambda test: test)
    p1 = model.transform(rows).select("row_id", MD.positive_probability().alias("p1"))
    add = X.additivity_wide(wide, "row_id", cols).join(p1, "row_id")
    return add.agg(F.count(F.lit(1)).alias("n_records"), F.count_if("additive").alias("n_additive"),
                   F.count_if(F.abs(F.col("fx") - F.col("p1")) <= 1e-9).alias("n_fx_same"))


_LINEAR = {"l_quantity": 2.0, "l_discount": -300.0, "l_tax": 50.0}


@query("shapley_linear", oracle=f"""
with bg as (select * from {TRAIN_SIDE} order by {", ".join(RECORD_ID)} limit 8)
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       {", ".join(f"round({w} * ({c} - (select avg({c}) from bg)), 4) + 0.0 as phi_{c}" for c, w in _LINEAR.items())}
from {TEST_SIDE}
""")
def q_shapley_linear(spark, sf):
    """Attributions of a model with fixed weights for every held-out row: each must be
    weight * (value - background mean)."""
    train, test = claims_sides(spark, sf)
    model = PipelineModel([SQLTransformer(statement="select *, " + " + ".join(
        f"{w} * {c}" for c, w in _LINEAR.items()) + " as prediction from __THIS__")])
    cols = list(_LINEAR)
    bg = top_k(train, 8, RECORD_ID).select(*cols)
    keyed = test.withColumn("key", F.struct(*LINE_KEY, "l_extendedprice"))
    wide = X.shapley_wide(model, keyed, "key", cols, bg, permutations=2)
    return wide.select("key.*", *[(F.round(f"phi__{c}", 4) + 0.0).alias(f"phi_{c}") for c in cols])


# ------------------------------------------------- labelled documents classifier

_DOC_BUCKET = ("cast('0x' || substr(md5(concat_ws('|', cast(doc_id as varchar), '123')), 1, 8) as bigint) % 1000000")


DOC_NUM = ["n_chars", "n_words", "word_chars", "symbols", "repeated_lines", "capitals"]


def labelled_documents(spark, sf):
    """Documents with a quality label: (doc_id, lang, source, n_chars and shares counted over
    the whole text, label)."""
    text = F.coalesce("text", F.lit(""))
    words = F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1))
    lines = F.split(text, "\n")
    docs = t(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars", words.alias("n_words"),
        (F.length(text) / words).alias("word_chars"),
        (F.regexp_count(text, F.lit(r"[^\w\s.,;:!?'-]")) / words).alias("symbols"),
        (1 - F.size(F.array_distinct(lines)) / F.size(lines)).alias("repeated_lines"),
        (F.regexp_count(text, F.lit("[A-Z]")) / words).alias("capitals"))
    labels = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id")


def documents_recipe():
    return FE.feature_recipe(["lang", "source"], DOC_NUM)


def documents_classifier(train, **forest):
    """The reference's MLlib classifier settings on a keep-unseen recipe."""
    params = dict(MD.REFERENCE_CLASSIFIER)
    params.update(forest)
    return MD.fit_with_recipe(documents_recipe(), MD.forest_classifier(label="label", **params), train)


@query("rf_classify_documents", oracle=f"""
select count(*) as n_scored, count(*) as n_prob_in_range, count(*) as n_pred_valid, true as beats_bar
from documents d join labels l on d.doc_id = l.doc_id where {_DOC_BUCKET.replace('doc_id', 'd.doc_id')} >= 800000
""")
def q_rf_classify_documents(spark, sf):
    """Quality classifier on labelled documents with the reference forest (136 trees,
    depth 5, 3 rows per leaf, sqrt features); held-out 20% by doc_id hash, whose AUC must
    exceed 0.75."""
    train, test = hash_split(labelled_documents(spark, sf), ["doc_id"], seed=123, train_fraction=0.8)
    model = documents_classifier(train)
    pred = cut_lineage(model.transform(test).withColumn("p1", MD.positive_probability()).select("label", "p1", "prediction"))
    auc = M.auc(pred, "label", "p1").first()["auc"]
    return pred.agg(F.count(F.lit(1)).alias("n_scored"),
                    F.count_if(F.col("p1").between(0.0, 1.0)).alias("n_prob_in_range"),
                    F.count_if(F.col("prediction") == (F.col("p1") > 0.5).cast("double")).alias("n_pred_valid")) \
        .withColumn("beats_bar", F.lit(auc > 0.75))


# ----------------------------------------------- tuning at the reference's size

def _document_folds(spark, sf, k=10):
    train, _ = hash_split(labelled_documents(spark, sf), ["doc_id"], seed=123, train_fraction=0.8)
    return cut_lineage(with_folds(train, ["doc_id"], k))


# The fraud grid and the first of its curves.
FRAUD_GRID = dict(trees=list(range(135, 142)), min_split=[7, 8, 9], min_leaf=[4, 5, 3])
CURVE_TREES = list(range(50, 200, 10))


@query("grid_search_reference", oracle="""
select n as n_estimators, s as min_samples_split, l as min_samples_leaf, 10 as n_folds, true as beats_bar, true as rank_follows
from range(135, 142) a(n), (values (7), (8), (9)) b(s), (values (3), (4), (5)) c(l)
where (select count(*) from documents d join labels q on d.doc_id = q.doc_id) > 0
""")
def q_grid_search_reference(spark, sf):
    """The reference's fraud grid, 63 settings in 10 folds by AUC, on the labelled documents:
    30 fits in place of 630."""
    trials = TU.forest_grid(MD.forest_classifier(), _document_folds(spark, sf), 10, **FRAUD_GRID, recipe=documents_recipe())
    rows = [(t.params["n_estimators"], t.params["min_samples_split"], t.params["min_samples_leaf"], len(t.scores["score"]),
             t.mean("score")) for t in trials]
    table = TU.results_table(spark, trials).select(F.from_json("params", "n_estimators int, min_samples_split int, "
                                                               "min_samples_leaf int").alias("p"), "rank_test_score")
    means = spark.createDataFrame(rows, "n_estimators int, min_samples_split int, min_samples_leaf int, n_folds int, mean double")
    by = ["n_estimators", "min_samples_split", "min_samples_leaf"]
    ranked = means.withColumn("r", F.rank().over(Window.orderBy(F.desc("mean"))))
    return ranked.join(table.select("p.*", "rank_test_score"), by).select(
        F.col("n_estimators").cast("long").alias("n_estimators"), "min_samples_split", "min_samples_leaf", "n_folds",
        (F.col("mean") > 0.75).alias("beats_bar"), (F.col("r") == F.col("rank_test_score")).alias("rank_follows"))


@query("validation_curve_reference", oracle="""
select n as n_estimators, 10 as n_folds, true as beats_bar from range(50, 200, 10) a(n)
where (select count(*) from documents d join labels q on d.doc_id = q.doc_id) > 0
""")
def q_validation_curve_reference(spark, sf):
    """The reference's curve of 15 forest sizes in 10 folds, from one fit a fold."""
    trials = TU.forest_grid(MD.forest_classifier(minInstancesPerNode=1), _document_folds(spark, sf), 10, CURVE_TREES,
                            recipe=documents_recipe())
    rows = [(t.params["n_estimators"], len(t.scores["score"]), t.mean("score") > 0.75) for t in trials]
    return spark.createDataFrame(rows, "n_estimators long, n_folds int, beats_bar boolean")


@query("leaderboard_documents", oracle="select m as model, true as rank_follows, true as in_range from (values "
       + ", ".join(f"('{m}')" for m in _MODELS) + ") s(m) where (select count(*) from labels) > 0")
def q_leaderboard_documents(spark, sf):
    """The six families on the labelled documents, by kappa and MCC as well as AUC, ranked by
    kappa."""
    metrics = {"kappa": M.ConfusionEvaluator("kappa"), "mcc": M.ConfusionEvaluator("mcc"), "auc": _auc_evaluator()}
    board, _ = TU.leaderboard(MD.leaderboard_models(), metrics, _document_folds(spark, sf, 3), 3, recipe=documents_recipe(),
                              sort="kappa", fit_best=False)
    return board.select("model", (F.rank().over(Window.orderBy(F.desc("mean_kappa"))) == F.col("rank")).alias("rank_follows"),
                        (F.col("mean_kappa").between(-1, 1) & F.col("mean_mcc").between(-1, 1)
                         & F.col("mean_auc").between(0.3, 1)).alias("in_range"))


@query("rf_min_split", oracle=f"""select count(*) as n_scored, true as bound_holds, true as was_needed, true as good_fit
from {TEST_SIDE}""")
def q_rf_min_split(spark, sf):
    """The regression forest grown to depth 10 and pruned so that no node of fewer than 40
    rows is split; held-out R² stays above 0.9."""
    train, test = claims_split(spark, sf)
    model = regression_model(train, maxDepth=10, minInstancesPerNode=1, numTrees=10)
    was = T.smallest_split(T.node_table(spark, model.stages[-1]))
    cut = T.prune_small_nodes(model.stages[-1], spark, 40)
    now = T.smallest_split(T.node_table(spark, cut))
    pruned = PipelineModel([*model.stages[:-1], cut])
    pred = cut_lineage(pruned.transform(test).select("net_amount", "prediction"))
    r2 = M.regression_metrics(pred, "net_amount", "prediction").first()["r2"]
    return pred.agg(F.count(F.lit(1)).alias("n_scored")).select(
        "n_scored", F.lit(now >= 40).alias("bound_holds"), F.lit(was < 40).alias("was_needed"), F.lit(r2 > 0.9).alias("good_fit"))


# ------------------------------------------------------------------ streaming

@query("score_claims_stream", oracle=_SCORE_ORACLE)
def q_score_claims_stream(spark, sf):
    """Score held-out claims arriving as a file stream: lineitem read with
    ``readStream`` (at most 2 files per micro-batch), the batch-fitted pipeline applied
    row by row, appended to Parquet in the shared folder with its checkpoint there;
    an ``availableNow`` trigger drains the source and stops."""
    from pyspark.sql.types import StructType

    from tabulon.streaming import start_claims_scoring

    train, _ = claims_split(spark, sf)
    model = regression_model(train)
    source = t(spark, sf, "lineitem")
    stream = (spark.readStream.schema(StructType(source.schema.fields))
              .option("maxFilesPerTrigger", 2).parquet(f"{sf.rstrip('/')}/lineitem*.parquet"))
    held_out = hash_split(claims_from(stream), LINE_KEY, seed=123, train_fraction=0.8)[1]
    out_dir = shared_path(spark, "streams", "claims_out", unique=True)
    q = start_claims_scoring(score_claims(model, held_out, "net_amount", RECORD_ID), out_dir,
                             available_now=True)
    q.awaitTermination()
    return _status_check(spark.read.parquet(out_dir))
