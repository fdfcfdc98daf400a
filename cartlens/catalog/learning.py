"""L: churn models, their evaluation, and recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog.registry import Data, query, rounded
from cartlens.catalog.scalars import REGIONS, REGION_SQL
from cartlens.models import churn, factors, recommend, topk
from cartlens.operators import evaluation, stattests
from cartlens.session import materialize, scratch_path

# -- recommendations -------------------------------------------------------------------------

_RATINGS = """g AS (SELECT customer_id AS customer, upper(replace(product_category_name_english, ' ', '')) || '_' || product_id AS product_name,
        avg(review_score) AS rating, min(order_purchase_timestamp) AS t FROM wide GROUP BY 1, 2),
    u AS (SELECT customer, row_number() OVER (ORDER BY min(t), customer) AS "user" FROM g GROUP BY customer),
    i AS (SELECT product_name, row_number() OVER (ORDER BY product_name) AS item FROM (SELECT DISTINCT product_name FROM g))"""


@query(
    "l1_ratings",
    f"""WITH {_RATINGS} SELECT "user", item, round(rating, 6) AS rating FROM g JOIN u USING (customer) JOIN i USING (product_name)""",
)
def l1(d: Data):
    ratings, _, _ = recommend.numbered_ratings(d.wide)
    return rounded(ratings, 6, "rating")


@query("l1_rating_scale", "SELECT min(review_score) AS low, max(review_score) AS high FROM wide")
def l1b(d: Data):
    return d.wide.agg(F.min("review_score").alias("low"), F.max("review_score").alias("high"))


# Ratings of persons; what a model adds to them is checked by properties that any good fit has.
_PERSON_RATINGS = _RATINGS.replace("SELECT customer_id AS customer", "SELECT customer_unique_id AS customer")


def _person_ratings(d: Data):
    return recommend.numbered_ratings(d.wide, "customer_unique_id")


@query(
    "l2_predicted_ratings",
    f"""WITH {_PERSON_RATINGS} SELECT "user", item, round(rating, 6) AS rating, TRUE AS in_range FROM g JOIN u USING (customer) JOIN i USING (product_name)""",
)
def l2(d: Data):
    """Every rated pair with its rating, and whether the predicted one lies in the rating range."""
    ratings, _, _ = _person_ratings(d)
    model = recommend.fit(ratings)
    rows = model.predict(ratings).withColumn("in_range", F.col("prediction").between(model.low, model.high))
    return rounded(rows.select(F.col("user").cast("bigint"), F.col("item").cast("bigint"), "rating", "in_range"), 6, "rating")


@query("l2_error_against_mean", f"WITH {_PERSON_RATINGS} SELECT count(*) AS ratings, TRUE AS better_than_mean FROM g")
def l2b(d: Data):
    """Whether the fitted ratings are nearer to the given ones than their mean is."""
    ratings, _, _ = _person_ratings(d)
    rmse, _ = recommend.errors(recommend.fit(ratings), ratings)
    return ratings.agg(F.count(F.lit(1)).alias("ratings"), (F.lit(rmse) < F.stddev_pop("rating")).alias("better_than_mean"))


_RANKS, _REGS = (30, 40), (0.02, 0.1, 0.4)


@query(
    "l3_recommender_grid_search",
    f"""SELECT CAST(r AS INTEGER) AS rank, CAST(g AS DOUBLE) AS reg, TRUE AS has_errors, TRUE AS not_above_best
        FROM (VALUES {", ".join(f"({r}, {g})" for r in _RANKS for g in _REGS)}) t(r, g)""",
)
def l3(d: Data):
    """Every combination, over five folds: its errors are known and the first place has the least."""
    ratings, _, _ = _person_ratings(d)
    found = recommend.grid_search(ratings, _RANKS, _REGS, folds=5)
    least = found.agg(F.min("rmse")).scalar()
    return found.select(
        "rank", "reg", (F.col("rmse") >= F.col("mae")).alias("has_errors"), (F.col("rmse") >= least).alias("not_above_best")
    )


@query(
    "l4_top_unseen_items",
    f"""WITH {_PERSON_RATINGS} SELECT customer, CAST(k AS INTEGER) AS place, TRUE AS unseen, TRUE AS falling FROM u CROSS JOIN range(1, 6) r(k)""",
)
def l4(d: Data):
    """Five products for every customer: that none was rated and that the scores fall."""
    ratings, users, items = _person_ratings(d)
    best = materialize(recommend.recommend(recommend.fit(ratings), ratings, users), "best-items")
    above = best.select("user", (F.col("place") + 1).alias("place"), F.col("prediction").alias("above"))
    seen = ratings.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), F.lit(True).alias("seen"))
    rows = best.join(above, ["user", "place"], "left").join(seen, ["user", "item"], "left").join(users, "user")
    falling = F.col("above").isNull() | (F.col("above") >= F.col("prediction"))
    return rows.select("customer", F.col("place").cast("int").alias("place"), F.col("seen").isNull().alias("unseen"), falling.alias("falling"))


@query(
    "l5_saved_recommender",
    f"""WITH {_PERSON_RATINGS} SELECT "user", item, TRUE AS same FROM g JOIN u USING (customer) JOIN i USING (product_name)""",
)
def l5(d: Data):
    """Whether a model that was saved and loaded again predicts the same."""
    ratings, _, _ = _person_ratings(d)
    path = scratch_path(d.spark, "recommender")
    model = recommend.fit(ratings)
    model.save(path)
    before = model.predict(ratings).select("user", "item", F.col("prediction").alias("before"))
    after = recommend.load(d.spark, path).predict(ratings).select("user", "item", "prediction")
    same = F.abs(F.col("before") - F.col("prediction")) < 1e-9
    return before.join(after, ["user", "item"]).select(F.col("user").cast("bigint"), F.col("item").cast("bigint"), same.alias("same"))


# Trained by stratified gradient descent; tests compare it with a sequential run and with all pairs.
_DESCENT = factors.Setting(rank=30, lr=0.01, reg=0.02)
_DESCENT_EPOCHS, _CELL = 5, 2_000


def _descent(d: Data):
    ratings, users, items = _person_ratings(d)
    return factors.train(ratings, [_DESCENT], _DESCENT_EPOCHS, cell_ratings=_CELL).factors(), ratings, users, items


@query("l2_descent_ratings")
def l2c(d: Data):
    """Every rated pair with its rating and the one predicted by factors from gradient descent."""
    model, ratings, _, _ = _descent(d)
    return rounded(model.predict(ratings).select("user", "item", "rating", "prediction"), 6, "rating", "prediction")


@query("l3_descent_grid")
def l3b(d: Data):
    """Errors of all 18 combinations of rank, learning rate and regularisation over five folds, best first."""
    ratings, _, _ = _person_ratings(d)
    settings = factors.grid((40, 30), (0.001, 0.5005, 1.0), (0.01, 0.405, 0.8))
    return rounded(factors.grid_search(ratings, settings, 5, 2, cell_ratings=_CELL), 6, "rmse", "mae")


@query("f6_top_predicted_items")
def f6b(d: Data):
    """Five unseen products for every customer by predicted score, and how many of all pairs were scored for it."""
    model, ratings, users, items = _descent(d)
    best = topk.best_items(model, users, ratings, k=5, first_chunk=64)
    named = best.rows.join(users, "user").join(items, "item").select("customer", "product_name", "place", "prediction")
    named = named.withColumns({"scored": F.lit(best.scored).cast("bigint"), "pairs": F.lit(best.pairs).cast("bigint")})
    return rounded(named, 6, "prediction")


# -- churn -----------------------------------------------------------------------------------

_FRAME = f"""SELECT CAST(dense_rank() OVER (ORDER BY {REGION_SQL}) - 1 AS INTEGER) AS customer_state, price, freight_value,
    CAST(dense_rank() OVER (ORDER BY payment_type) - 1 AS INTEGER) AS payment_type, payment_installments, review_score,
    frequency, monetary_value, customer_tenure, num_orders, churn FROM churn_kept"""


@query("l6_training_frame", _FRAME)
def l6(d: Data):
    return churn.training_frame(d.facts, REGIONS)


@query("l6_labelled_rows", "SELECT * FROM churn_raw")
def l6b(d: Data):
    return churn.labelled_rows(d.facts)


@query(
    "l7_train_test_split",
    """SELECT count(*) AS n, CAST(sum(churn) AS BIGINT) AS churned, TRUE AS a_fifth_for_the_test FROM churn_kept""",
)
def l7(d: Data):
    """Both parts together hold every row once, and the test part about a fifth."""
    train, test = churn.split(materialize(churn.training_frame(d.facts, REGIONS), "frame"))
    tagged = train.withColumn("test", F.lit(0)).unionByName(test.withColumn("test", F.lit(1)))
    return tagged.agg(
        F.count(F.lit(1)).alias("n"), F.sum("churn").cast("bigint").alias("churned"),
        F.avg("test").between(0.15, 0.25).alias("a_fifth_for_the_test"),
    )


@query("l7_train_test_difference")
def l7b(d: Data):
    """t-tests of every feature between training and test rows."""
    frame = materialize(churn.training_frame(d.facts, REGIONS), "frame")
    train, test = churn.split(frame)
    tagged = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    tests = stattests.with_t_p_value(stattests.two_sample_t(tagged, "part", churn.TRAINING_FEATURES, "train", "test"))
    return tests.withColumn("differs", F.col("p_value") < 0.05)


def _fitted(d: Data, kind: str, seed: int = 42, **params):
    frame = materialize(churn.training_frame(d.facts, REGIONS), "frame")
    train, test = churn.split(frame, seed=seed)
    return churn.fit(train, kind, **params), train, test


_SUPPORT = """SELECT CAST(churn AS INTEGER) AS actual, count(*) AS support, 0.0::DOUBLE AS roc_start, 1.0::DOUBLE AS roc_end, TRUE AS useful
    FROM churn_kept GROUP BY churn"""


def _reported(d: Data, kind: str, seed: int = 42, **params):
    """Per class: the cells of the confusion matrix over all rows add up to its support, the ROC of the test
    part runs from (0, 0) to (1, 1), and the test part is predicted about as well as by its larger class
    at least."""
    model, train, test = _fitted(d, kind, seed, **params)
    scored = materialize(churn.predict(model, test), "scored-test")
    cells = evaluation.confusion_counts(churn.predict(model, train).unionByName(scored))
    per_class = cells.groupBy("actual").agg(F.sum("n").alias("support"))
    ends = evaluation.roc_points(scored).agg(
        F.min(F.greatest("fpr", "tpr")).alias("roc_start"), F.max(F.least("fpr", "tpr")).alias("roc_end")
    ).first()
    share = scored.agg(F.avg("label").alias("p"), F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("right")).first()
    useful = share["right"] >= max(share["p"], 1 - share["p"]) - 0.05
    return per_class.select(
        "actual", "support", F.lit(ends["roc_start"]).cast("double").alias("roc_start"), F.lit(ends["roc_end"]).cast("double").alias("roc_end"),
        F.lit(bool(useful)).alias("useful"),
    )


@query("l8_decision_tree", _SUPPORT)
def l8(d: Data):
    return _reported(d, "decision_tree")


@query("l9_random_forest", _SUPPORT)
def l9(d: Data):
    return _reported(d, "random_forest", seed=500)


@query("l10_boosted_trees", _SUPPORT)
def l10(d: Data):
    return _reported(d, "boosted_trees")


@query("l11_logistic_regression", _SUPPORT)
def l11(d: Data):
    return _reported(d, "logistic_regression", seed=500)


# A fixed rule as the prediction, so that evaluation can be checked by SQL: low scores are
# predicted to have been delivered late.
_JUDGED = """j AS (SELECT CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS label,
    CASE WHEN review_score <= 2 THEN 1 ELSE 0 END AS prediction, freight_value / price + 0.01::DOUBLE * (5 - review_score) AS score FROM wide)"""


def _judged(d: Data):
    from cartlens.functions.labels import flag
    from cartlens.plans.features import late_column

    score = F.col("freight_value") / F.col("price") + F.lit(0.01) * (F.lit(5) - F.col("review_score"))
    return d.wide.select(late_column().alias("label"), flag(F.col("review_score") <= 2).alias("prediction"), score.alias("score"))


@query(
    "l12_confusion_matrix",
    f"""WITH {_JUDGED} SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, count(label) AS n
        FROM range(2) x(a) CROSS JOIN range(2) y(p) LEFT JOIN j ON label = a AND prediction = p GROUP BY ALL""",
)
def l12(d: Data):
    return evaluation.confusion_counts(_judged(d))


@query(
    "l13_classification_report",
    f"""WITH {_JUDGED}, c AS (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
        CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp, CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM j),
      r AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS s FROM c UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), tp + fn FROM c),
      f AS (SELECT class, p, r, 2 * p * r / (p + r) AS f, s FROM r),
      a AS (SELECT class, p, r, f, s FROM f UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM f UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM f)
      SELECT class, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, CAST(s AS BIGINT) AS support FROM a""",
)
def l13(d: Data):
    return rounded(evaluation.classification_report(_judged(d)), 9, "precision", "recall", "f1")


_ROC = """s AS (SELECT CAST({score} AS DOUBLE) AS t, sum(label) AS p, sum(1 - label) AS n FROM j GROUP BY 1),
    r AS (SELECT t, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM s WINDOW w AS (ORDER BY t DESC))"""


@query(
    "l14_roc_hard_labels",
    f"""WITH {_JUDGED}, {_ROC.format(score='prediction')} SELECT t AS threshold, round(fp / (SELECT sum(n) FROM s), 9) AS fpr, round(tp / (SELECT sum(p) FROM s), 9) AS tpr FROM r
        UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def l14(d: Data):
    return rounded(evaluation.roc_points(_judged(d), score="prediction"), 9, "fpr", "tpr")


@query(
    "l14_roc_scores",
    f"""WITH {_JUDGED}, {_ROC.format(score='round(score, 4)')} SELECT t AS threshold, round(fp / (SELECT sum(n) FROM s), 9) AS fpr, round(tp / (SELECT sum(p) FROM s), 9) AS tpr FROM r
        UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def l14b(d: Data):
    judged = _judged(d).withColumn("score", F.round("score", 4))
    return rounded(evaluation.roc_points(judged), 9, "fpr", "tpr")


@query(
    "l14_area_under_curve",
    f"""WITH {_JUDGED}, {_ROC.format(score='round(score, 4)')}
        SELECT round(sum(s.n * (r.tp - s.p / 2.0::DOUBLE)) / (CAST(sum(s.p) AS DOUBLE) * sum(s.n)), 9) AS auc FROM s JOIN r USING (t)""",
)
def l14c(d: Data):
    judged = _judged(d).withColumn("score", F.round("score", 4))
    return rounded(evaluation.auc(judged), 9, "auc")


_SEVEN = "SELECT CAST(k AS INTEGER) AS place, TRUE AS is_feature, TRUE AS falling, TRUE AS fits FROM range(1, 8) r(k)"


def _places(d: Data, listed, value: str, most):
    """Places 1 to 7 of a ranking: that each is a training feature, that the values fall, and that they
    add up to no more than `most`. The list has at most seven rows."""
    rows = [(r["feature"], float(r[value])) for r in listed.collect()]
    falling = all(x[1] >= y[1] for x, y in zip(rows, rows[1:]))
    fits = sum(v for _, v in rows) <= most + 1e-9 and len({f for f, _ in rows}) == len(rows)
    placed = [(k + 1, f in churn.TRAINING_FEATURES, falling, fits) for k, (f, _) in enumerate(rows)]
    return d.spark.createDataFrame(placed, "place int, is_feature boolean, falling boolean, fits boolean")


@query("l15_feature_importances", _SEVEN)
def l15(d: Data):
    model, _, _ = _fitted(d, "random_forest")
    return _places(d, churn.importances(model, top=7), "importance", 1.0)


@query("l15_split_counts", _SEVEN)
def l15b(d: Data):
    model, _, _ = _fitted(d, "boosted_trees")
    return _places(d, churn.split_counts(model, scratch_path(d.spark, "trees"), top=7), "splits", float("inf"))


_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [3, 6, 10]}


@query(
    "l16_parameter_search",
    f"""SELECT 'impurity=' || i || ', maxDepth=' || m AS parameters, TRUE AS measured, TRUE AS not_above_best
        FROM (VALUES {", ".join(f"('{i}')" for i in _GRID["impurity"])}) a(i) CROSS JOIN (VALUES {", ".join(f"({m})" for m in _GRID["maxDepth"])}) b(m)""",
)
def l16(d: Data):
    """Every combination of the grid, over five folds and all training features."""
    train, _ = churn.split(materialize(churn.training_frame(d.facts, REGIONS), "frame"))
    found = churn.search_results(churn.tune(train, "decision_tree", _GRID, folds=5))
    best = found.agg(F.max("metric")).scalar()
    return found.select("parameters", F.col("metric").between(0.3, 1.0).alias("measured"), (F.col("metric") <= best).alias("not_above_best"))


# Grids of the three kinds of model; the widest that five folds of all cells finish in well under a minute here.
_GRIDS = {
    "decision_tree": _GRID,
    "random_forest": {"numTrees": [10, 20], "impurity": ["gini", "entropy"], "maxDepth": [4, 8]},
    "boosted_trees": {"maxIter": [5, 10], "stepSize": [0.1, 0.3], "maxDepth": [3]},
}


@query("l16_search_of_three_models")
def l16b(d: Data):
    """Every cell of a grid for each of three kinds of model, over five folds, with its accuracy and its place."""
    train, _ = churn.split(materialize(churn.training_frame(d.facts, REGIONS), "frame"))
    found = churn.search_models(train, _GRIDS, folds=5)
    return rounded(found, 6, "metric")


@query(
    "l17_scored_rows",
    """SELECT CAST(payment_installments AS BIGINT) AS payment_installments, count(*) AS n, count(*) FILTER (WHERE payment_installments % 3 <> 0) AS scored,
       TRUE AS in_range FROM churn_kept GROUP BY 1""",
)
def l17(d: Data):
    """Rows scored by a model that was saved and loaded again. A third of the installment plans has no review
    score here; their rows come back too, without a score."""
    frame = materialize(churn.training_frame(d.facts, REGIONS), "frame")
    train, _ = churn.split(frame)
    path = scratch_path(d.spark, "tree")
    churn.save(churn.fit(train, "decision_tree", churn.SCORING_FEATURES), path)
    missing = F.when(F.col("payment_installments") % 3 != 0, F.col("review_score"))
    rows = frame.withColumn("review_score", missing).select(*churn.SCORING_FEATURES)
    scored = churn.predict(churn.load(path), rows, label=None)
    ok = F.col("score").isNull() & F.col("prediction").isNull() | F.col("score").between(0, 1) & F.col("prediction").isin(0, 1)
    return scored.groupBy(F.col("payment_installments").cast("bigint").alias("payment_installments")).agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("scored"), F.bool_and(ok).alias("in_range")
    )


@query("g5_top_features", _SEVEN)
def g5(d: Data):
    model, _, _ = _fitted(d, "decision_tree")
    return _places(d, churn.importances(model, top=7), "importance", 1.0)
