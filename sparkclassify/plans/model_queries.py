"""Queries for the estimators (M1-M8).

A fit has no SQL equivalent, so the queries that return fitted values register
no oracle statement; beside each stands a ``..._check`` query whose rows SQL
knows: the right rows and labels, and the conditions any correct model meets
on them."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators.metrics import classification_summary
from ..operators.forest_table import forest_nodes, route
from ..operators.models import feature_importances, random_forest, score, text_naive_bayes_pipeline
from ..operators.newton import gradients
from ..operators.partitioning import FitLayout, fit_table, kept
from ..operators.sampling import hash_split
from ..operators.text_model import score_text_vectors
from ..operators.tuning import IMPURITY_GRID, MAX_DEPTH_GRID, NUM_TREES_GRID, TUNER_SEED, search_results
from ..session import materialize
from . import sqlparts as S
from .catalog import register
from .common import SPLIT_SEED, clean_lines
from .doc_features import feature_names
from .jobs import _J4_SQL, LR_SCORED_SQL, doc_stat_table, forest_job, forest_search, logistic_job, prepare, tuned_forest


def _forest_model(spark, sf_dir, layout: FitLayout = FitLayout()):
    data = fit_table(doc_stat_table(spark, sf_dir, "lang"), "doc_id", layout)
    train, test = hash_split(data, ["doc_id"], [0.85, 0.15], SPLIT_SEED)
    ready = prepare(train, "lang")
    with kept(ready.transform(train)) as rows:
        model = random_forest(num_trees=16, max_depth=4).fit(rows)
    return model, ready.transform(test)


@register("rf_predict")
def rf_predict(spark, sf_dir):
    """Forest of 16 trees, depth 4: held-out language predictions."""
    model, test = _forest_model(spark, sf_dir)
    return score(model, test, keep=["doc_id", "lang", "label"])


@register("rf_feature_importance")
def rf_feature_importance(spark, sf_dir):
    model, _ = _forest_model(spark, sf_dir)
    return feature_importances(model, feature_names(), spark)


@register("lr_predict", LR_SCORED_SQL + """
SELECT doc_id, label, prediction, p FROM lr_scored WHERE part = 1""", round6=("p",))
def lr_predict(spark, sf_dir):
    return logistic_job(spark, sf_dir)[0].select("doc_id", "label", "prediction", "p")


@register("lr_coefficients", LR_SCORED_SQL + """
SELECT CAST(0 AS INTEGER) AS class_index, feature, round(coefficient, 4) AS coefficient FROM lr_coef
UNION ALL SELECT 0, '(intercept)', round(c0, 4) FROM lr_line""")
def lr_coefficients_query(spark, sf_dir):
    """Coefficients and intercept to four places."""
    return logistic_job(spark, sf_dir)[1].coefficient_rows(spark).withColumn("coefficient", F.round("coefficient", 4))


@register("lr_training_summary", LR_SCORED_SQL + """
SELECT doc_id, label, prediction FROM lr_scored WHERE part = 0""")
def lr_training_summary(spark, sf_dir):
    """The training-set predictions, which the original's summary holds."""
    _, model, labelled = logistic_job(spark, sf_dir)
    return model.transform(labelled).select("doc_id", "label", "prediction")


@register("nb_pipeline", _J4_SQL + """
SELECT doc_id, line_no, label, prediction, score, probability FROM nb_scored""",
          round6=("score", "probability"))
def nb_pipeline(spark, sf_dir):
    """Vector-form six-stage text pipeline (Tokenizer, StopWordsRemover,
    HashingTF, IDF, Normalizer, NaiveBayes) as one ``Pipeline`` on document
    lines (English or not), fitted on the training documents' lines."""
    lines = clean_lines(spark, sf_dir)
    train, test = hash_split(lines, ["doc_id"], [0.8, 0.2], SPLIT_SEED)
    # IDF and naive Bayes each pass over the training lines.
    train = materialize(train, "lines")
    model = text_naive_bayes_pipeline("clean", "label").fit(train)
    return score_text_vectors(model, test, ["doc_id", "line_no", "label"])


@register("tuned_rf_predict")
def tuned_rf_predict(spark, sf_dir):
    return forest_job(spark, sf_dir, "lang", 0.85)


@register("search_results")
def search_results_query(spark, sf_dir):
    """One row per candidate of the hold-out search with its weighted F1."""
    search = forest_search(spark, sf_dir, "lang", 0.85)[-1]
    return search_results(search, spark).withColumn("metric", F.round("metric", 6))


# -- what any correct model must satisfy on the right rows ---------------------

_LANG_TRAIN = S.split_part(["doc_id"], [0.85, 0.15], SPLIT_SEED) + " = 0"
_QUALITY = """q AS (SELECT doc_id, CAST(quality AS VARCHAR) AS quality FROM documents JOIN labels USING (doc_id))"""


def _quality_index(split) -> str:
    return f"""{_QUALITY}, qi AS (
  SELECT quality, CAST(row_number() OVER (ORDER BY count(*) DESC, quality) - 1 AS DOUBLE) AS label
  FROM q WHERE {S.split_part(['doc_id'], split, SPLIT_SEED)} = 0 GROUP BY quality)"""


_LANG_CHECK_SQL = f"""WITH {S.lang_index(_LANG_TRAIN)}
SELECT doc_id, li.label, true AS sums_to_one, true AS is_argmax, true AS in_range
FROM documents JOIN lang_index li USING (lang) WHERE NOT ({_LANG_TRAIN})"""


def _quality_check_sql(split) -> str:
    return f"""WITH {_quality_index(split)}
SELECT doc_id, qi.label, true AS sums_to_one, true AS is_argmax, true AS in_range
FROM q JOIN qi USING (quality) WHERE {S.split_part(['doc_id'], split, SPLIT_SEED)} = 1"""


def checked(scored):
    """Per scored row: probabilities sum to 1 and lie in [0, 1], and the
    prediction is the first class with the highest one."""
    p = vector_to_array("probability")
    return scored.select(
        "doc_id", "label",
        (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("sums_to_one"),
        (F.array_position(p, F.array_max(p)) - 1 == F.col("prediction")).alias("is_argmax"),
        F.forall(p, lambda x: (x >= 0) & (x <= 1)).alias("in_range"))


@register("rf_predict_check", _LANG_CHECK_SQL)
def rf_predict_check(spark, sf_dir):
    """The test part with its label index, and the probability rules."""
    model, test = _forest_model(spark, sf_dir)
    return checked(model.transform(test))


@register("tuned_forest_multiclass_check", _LANG_CHECK_SQL)
def tuned_forest_multiclass_check(spark, sf_dir):
    return checked(tuned_forest(spark, sf_dir, "lang", 0.85)[0])


@register("tuned_forest_binary_check", _quality_check_sql([0.85, 0.15]))
def tuned_forest_binary_check(spark, sf_dir):
    return checked(tuned_forest(spark, sf_dir, "quality", 0.80)[0])


def routed(scored, model):
    """Per scored row, whether routing it through the table of the forest's
    nodes gives the model's own prediction and class votes."""
    depth = max(t.depth for t in model.trees)
    kept_cols = ["doc_id", "label", "prediction", vector_to_array("rawPrediction").alias("raw")]
    found = route(scored.select(*kept_cols, "features"), forest_nodes(model), depth,
                  keep=("doc_id", "label", "prediction", "raw"))
    near = F.forall(F.zip_with("votes", "raw", lambda a, b: F.abs(a - b)), lambda x: x < 1e-9)
    return found.select("doc_id", "label", (F.col("routed") == F.col("prediction")).alias("same_prediction"),
                        near.alias("same_votes"))


_ROUTED_SQL = f"""WITH {S.lang_index(_LANG_TRAIN)}
SELECT doc_id, li.label, true AS same_prediction, true AS same_votes
FROM documents JOIN lang_index li USING (lang) WHERE NOT ({_LANG_TRAIN})"""


@register("rf_routed", _ROUTED_SQL)
def rf_routed(spark, sf_dir):
    """The forest as a table of nodes: every test row, routed through it."""
    model, test = _forest_model(spark, sf_dir)
    return routed(model.transform(test), model)


@register("tuned_rf_routed", _ROUTED_SQL)
def tuned_rf_routed(spark, sf_dir):
    scored, model, _ = tuned_forest(spark, sf_dir, "lang", 0.85)
    return routed(scored, model)


@register("rf_feature_importance_check", """SELECT 'sum' AS quantity, true AS holds
UNION ALL SELECT 'not negative', true""")
def rf_feature_importance_check(spark, sf_dir):
    """Importances are not negative and sum to 1."""
    v = rf_feature_importance(spark, sf_dir).agg(F.sum("importance").alias("s"), F.min("importance").alias("m"))
    return v.select(F.explode(F.array(
        F.struct(F.lit("sum").alias("quantity"), (F.abs(F.col("s") - 1) < 1e-9).alias("holds")),
        F.struct(F.lit("not negative").alias("quantity"), (F.col("m") >= 0).alias("holds")))).alias("r")).select("r.*")


@register("lr_predict_check", f"""WITH {_quality_index([0.75, 0.25])}
SELECT doc_id, qi.label, true AS in_range, true AS consistent FROM q JOIN qi USING (quality)
WHERE {S.split_part(['doc_id'], [0.75, 0.25], SPLIT_SEED)} = 1""")
def lr_predict_check(spark, sf_dir):
    """Test part and label index; p is the logistic of the raw score and the
    prediction says whether it is over one half."""
    out = logistic_job(spark, sf_dir)[0]
    logistic = 1 / (1 + F.exp(-F.col("raw_score")))
    return out.select("doc_id", "label", F.col("p").between(0.0, 1.0).alias("in_range"), (
        (F.abs(F.col("p") - logistic) < 1e-9) & ((F.col("p") > 0.5) == (F.col("prediction") == 1.0))).alias("consistent"))


@register("lr_training_check", f"""WITH {_quality_index([0.75, 0.25])}
SELECT doc_id, qi.label FROM q JOIN qi USING (quality)
WHERE {S.split_part(['doc_id'], [0.75, 0.25], SPLIT_SEED)} = 0""")
def lr_training_check(spark, sf_dir):
    """The rows the summary is about: training part with its label index."""
    return lr_training_summary(spark, sf_dir).select("doc_id", "label")


@register("lr_optimality_check", f"""WITH {_quality_index([0.75, 0.25])},
n AS (SELECT count(*) AS n_rows FROM q JOIN qi USING (quality) WHERE {S.split_part(['doc_id'], [0.75, 0.25], SPLIT_SEED)} = 0)
SELECT f.feature, n_rows, true AS at_optimum
FROM n, (SELECT unnest([{', '.join(f"'{f}'" for f in [*feature_names(), '(intercept)'])}]) AS feature) f""")
def lr_optimality_check(spark, sf_dir):
    """First-order condition of the fit (regularisation is 0): for every
    standardised feature, and the intercept, the mean of ``(p - y) * x`` over
    the training rows is 0 to 1e-6."""
    _, model, labelled = logistic_job(spark, sf_dir)
    names = [*feature_names(), "(intercept)"]
    scored = model.transform(labelled)
    got = scored.agg(F.count(F.lit(1)).alias("n_rows"), gradients(scored, feature_names()).alias("g"))
    return got.select("n_rows", F.explode(F.arrays_zip(F.array(*[F.lit(c) for c in names]).alias("feature"), "g")).alias("r")).select(
        F.col("r.feature"), "n_rows", (F.abs(F.col("r.g")) < 1e-6).alias("at_optimum"))


@register("search_results_check", f"""WITH t AS (
  SELECT {S.split_part(['doc_id'], [0.85, 0.15], TUNER_SEED)} AS part FROM documents WHERE {_LANG_TRAIN})
SELECT CAST(a AS INTEGER) AS "numTrees", CAST(b AS INTEGER) AS "maxDepth", c AS impurity,
  (SELECT count(*) FROM t WHERE part = 0) AS train_rows, (SELECT count(*) FROM t WHERE part = 1) AS validation_rows,
  true AS in_range, true AS one_winner_with_the_maximum
FROM (SELECT unnest({list(NUM_TREES_GRID)}) AS a), (SELECT unnest({list(MAX_DEPTH_GRID)}) AS b),
  (SELECT unnest({list(IMPURITY_GRID)}) AS c)""")
def search_results_check(spark, sf_dir):
    """All candidates, the sizes of the inner split, and exactly one winner,
    whose F1 is the highest."""
    search = forest_search(spark, sf_dir, "lang", 0.85)[-1]
    rows = search_results(search, spark)
    good = rows.agg(((F.sum(F.col("winner").cast("int")) == 1)
                     & (F.max(F.when(F.col("winner"), F.col("metric"))) == F.max("metric"))).alias("g"))
    return rows.select("numTrees", "maxDepth", "impurity", F.lit(search.train_rows).cast("long").alias("train_rows"),
                       F.lit(search.validation_rows).cast("long").alias("validation_rows"),
                       F.col("metric").between(0.0, 1.0).alias("in_range"),
                       good.scalar().alias("one_winner_with_the_maximum"))


def _eval_check_sql(pairs: str) -> str:
    return f"""{pairs}
SELECT (SELECT count(*) FROM p) AS n, true AS beats_majority, true AS in_range"""


def _eval_check(pairs):
    """Rows evaluated, and whether weighted F1 is at least that of always
    naming the most frequent class."""
    pairs = materialize(pairs.select("label", "prediction"), "pairs")
    top = pairs.groupBy("label").count().orderBy(F.desc("count"), "label").limit(1).select("label")
    base = classification_summary(pairs.withColumn("prediction", top.scalar())).select("weighted_f1")
    s = classification_summary(pairs)
    return s.select("n", (F.col("weighted_f1") >= base.scalar()).alias("beats_majority"),
                    (F.col("accuracy").between(0.0, 1.0) & F.col("weighted_f1").between(0.0, 1.0)).alias("in_range"))


@register("tuned_forest_multiclass_eval_check", _eval_check_sql(
    f"WITH p AS (SELECT doc_id FROM documents WHERE lang IS NOT NULL AND NOT ({_LANG_TRAIN}))"))
def tuned_forest_multiclass_eval_check(spark, sf_dir):
    return _eval_check(forest_job(spark, sf_dir, "lang", 0.85))


@register("tuned_forest_binary_eval_check", _eval_check_sql(
    f"WITH {_QUALITY}, p AS (SELECT doc_id FROM q WHERE {S.split_part(['doc_id'], [0.85, 0.15], SPLIT_SEED)} = 1)"))
def tuned_forest_binary_eval_check(spark, sf_dir):
    return _eval_check(forest_job(spark, sf_dir, "quality", 0.80))


@register("logistic_binary_eval_check", _eval_check_sql(
    f"WITH {_QUALITY}, p AS (SELECT doc_id FROM q WHERE {S.split_part(['doc_id'], [0.75, 0.25], SPLIT_SEED)} = 1)"))
def logistic_binary_eval_check(spark, sf_dir):
    return _eval_check(logistic_job(spark, sf_dir)[0])
