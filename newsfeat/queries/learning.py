"""Classifier queries.

Metrics are checked on a **given** prediction table derived from
``embeddings``: the scores of an embedding are the softmax of ten sums over
all its components and its label is the true class ('0' .. '9').  Training and
attribution queries run ``pyspark.ml`` and have no SQL equivalent.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from newsfeat.functions.columns import MODERATION_CATEGORIES, clean_name
from newsfeat.operators import attribution as At
from newsfeat.operators import model as Mdl
from newsfeat.operators.ranking import materialize
from newsfeat.plans import featurize as Fz
from newsfeat.queries import sql as S
from newsfeat.queries.common import balanced, table
from newsfeat.queries.registry import query

R = 9
CLASSES = [str(i) for i in range(10)]


def given_predictions(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    # all components count: class k gets the sum of every tenth one from k on
    at = lambda k: F.transform(F.sequence(F.lit(k), F.size("embedding"), F.lit(10)),
                               lambda i: F.element_at("embedding", i).cast("double"))
    ex = F.array(*[F.exp(F.aggregate(at(k), F.lit(0.0), lambda a, x: a + x)) for k in range(1, 11)])
    s = F.aggregate(F.col("_ex"), F.lit(0.0), lambda a, x: a + x)
    return (e.withColumn("_ex", ex)
            .select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label_name"),
                    F.array(*[F.lit(c) for c in CLASSES]).alias("classes"),
                    F.transform(F.col("_ex"), lambda x: F.round(x / s, R)).alias("scores")))


PRED = f"""_ex AS (SELECT vec_id, label, [exp(list_sum([cast(embedding[i] AS DOUBLE) for i in generate_series(k, len(embedding), 10)])) for k in generate_series(1, 10)] AS ex FROM embeddings),
pred AS (SELECT vec_id AS id, cast(label AS VARCHAR) AS label_name, {CLASSES!r} AS classes,
                list_transform(ex, lambda x: round(x / list_sum(ex), {R})) AS scores FROM _ex),
_flat AS (SELECT id, label_name, unnest(classes) AS class, unnest(scores) AS score FROM pred)"""


def _w(body: str) -> str:
    return f"WITH {PRED}\n{body}"


_PTRUE = "scores[cast(label_name AS INTEGER) + 1]"


@query("m3_log_loss", _w(f"""
SELECT round(avg(-ln(greatest(least({_PTRUE}, 1 - 1e-15), 1e-15))), {R}) AS log_loss FROM pred"""))
def m3_log_loss(spark, sf_dir):
    return Mdl.log_loss(given_predictions(spark, sf_dir)).select(F.round("log_loss", R).alias("log_loss"))


@query("m4_class_log_loss", _w(f"""
SELECT label_name, round(avg(-ln(greatest(least({_PTRUE}, 1 - 1e-15), 1e-15))), {R}) AS log_loss, count(*) AS n
FROM pred GROUP BY label_name"""))
def m4_class_log_loss(spark, sf_dir):
    r = Mdl.log_loss(given_predictions(spark, sf_dir), by_class=True)
    return r.select("label_name", F.round("log_loss", R).alias("log_loss"), "n")


_ARGMAX = "struct_extract(list_max(list_zip(scores, classes)), 2)"


@query("m5_confusion_matrix", _w("SELECT label_name, " + ", ".join(
    f"count(*) FILTER (WHERE {_ARGMAX} = '{c}') AS \"{c}\"" for c in CLASSES) + " FROM pred GROUP BY label_name"))
def m5_confusion_matrix(spark, sf_dir):
    return Mdl.confusion_matrix(given_predictions(spark, sf_dir), CLASSES)


_ROC = """_cells AS (SELECT class, score, count(*) FILTER (WHERE label_name = class) AS pos,
                  count(*) FILTER (WHERE label_name <> class) AS neg FROM _flat GROUP BY class, score),
_cum AS (SELECT *, sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS tp,
                sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS fp,
                sum(pos) OVER (PARTITION BY class) AS P, sum(neg) OVER (PARTITION BY class) AS N FROM _cells)"""


@query("m6_roc_points", _w(f""", {_ROC}
SELECT class, score AS threshold, round(tp / P, {R}) AS tpr, round(fp / N, {R}) AS fpr,
       round(tp / (tp + fp), {R}) AS precision FROM _cum"""))
def m6_roc_points(spark, sf_dir):
    p = Mdl.roc_points(given_predictions(spark, sf_dir))
    return p.select("class", "threshold", *[F.round(c, R).alias(c) for c in ["tpr", "fpr", "precision"]])


@query("m7_auc", _w(f""", {_ROC}
SELECT class, round(sum((fp / N - (fp - neg) / N) * (tp / P + (tp - pos) / P) / 2), {R}) AS au_roc,
       round(sum((tp / P - (tp - pos) / P) * tp / (tp + fp)), {R}) AS au_prc FROM _cum GROUP BY class"""))
def m7_auc(spark, sf_dir):
    a = Mdl.auc(Mdl.roc_points(given_predictions(spark, sf_dir)))
    return a.select("class", F.round("au_roc", R).alias("au_roc"), F.round("au_prc", R).alias("au_prc"))


@query("m9_metrics_rows", _w(f""", {_ROC},
_auc AS (SELECT class, sum((fp / N - (fp - neg) / N) * (tp / P + (tp - pos) / P) / 2) AS au_roc,
                sum((tp / P - (tp - pos) / P) * tp / (tp + fp)) AS au_prc FROM _cum GROUP BY class)
SELECT 'logLoss' AS metric, round((SELECT avg(-ln(greatest(least({_PTRUE}, 1 - 1e-15), 1e-15))) FROM pred), {R}) AS value
UNION ALL SELECT 'auRoc', round((SELECT avg(au_roc) FROM _auc), {R})
UNION ALL SELECT 'auPrc', round((SELECT avg(au_prc) FROM _auc), {R})
UNION ALL SELECT 'accuracy', round((SELECT avg(CASE WHEN {_ARGMAX} = label_name THEN 1.0 ELSE 0.0 END) FROM pred), {R})"""))
def m9_metrics_rows(spark, sf_dir):
    m = Mdl.metrics_rows(given_predictions(spark, sf_dir))
    return m.select("metric", F.round("value", R).alias("value"))


@query("m11_flatten_predictions", _w("SELECT id, class, score FROM _flat"))
def m11_flatten_predictions(spark, sf_dir):
    return Mdl.flatten_predictions(given_predictions(spark, sf_dir))


@query("m12_predicted_class", _w(f"SELECT id, {_ARGMAX} AS predicted FROM pred"))
def m12_predicted_class(spark, sf_dir):
    """Arg-max class per row."""
    return given_predictions(spark, sf_dir).select("id", Mdl.predicted_class().alias("predicted"))


@query("o7_cosorted_scores", _w("""
SELECT id, list_transform(list_reverse(list_sort(list_zip(scores, classes))), lambda z: struct_extract(z, 2))[1:3] AS top3
FROM pred"""))
def o7_cosorted_scores(spark, sf_dir):
    """Classes co-sorted by score (descending), first three kept."""
    p = given_predictions(spark, sf_dir)
    z = F.reverse(F.array_sort(F.arrays_zip(F.col("scores").alias("s"), F.col("classes").alias("c"))))
    return p.select("id", F.slice(F.transform(z, lambda t: t["c"]), 1, 3).alias("top3"))


_GATES = [("logLoss", 1.0), ("logLoss", 1e6), ("accuracy", 0.95), ("accuracy", 0.0)]


@query("m8_gate_decisions", _w(f""", _m AS (
  SELECT avg(-ln(greatest(least({_PTRUE}, 1 - 1e-15), 1e-15))) AS ll, avg(CASE WHEN {_ARGMAX} = label_name THEN 1.0 ELSE 0.0 END) AS acc,
         avg(-ln(greatest(least({_PTRUE}, 1 - 1e-15), 1e-15))) FILTER (WHERE id % 2 = 0) AS pll,
         avg(CASE WHEN {_ARGMAX} = label_name THEN 1.0 ELSE 0.0 END) FILTER (WHERE id % 2 = 0) AS pacc FROM pred)
""" + "\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, CAST({t} AS DOUBLE) AS threshold, NOT ({v} {worse} {t} AND {v} {worse} {p}) AS deploy FROM _m"
    for (m, t), (v, p, worse) in zip(_GATES, [("ll", "pll", ">")] * 2 + [("acc", "pacc", "<")] * 2))))
def m8_gate_decisions(spark, sf_dir):
    """M8: whether to deploy the model of the given predictions, its
    predecessor being the one of the even ids."""
    pred = given_predictions(spark, sf_dir)
    values = lambda p: {r["metric"]: r["value"] for r in Mdl.metrics_rows(p).collect()}
    now, before = values(pred), values(pred.where(F.col("id") % 2 == 0))
    return spark.createDataFrame([(m, t, Mdl.deployment_gate(now, before, {m: t})) for m, t in _GATES],
                                 "metric string, threshold double, deploy boolean")


# ----------------------------------------------------------------- training (no SQL equivalent)

# The model's columns and their types.
_MODERATION = [clean_name(c) for c in MODERATION_CATEGORIES]
TOPIC_SPEC = Mdl.FeatureSpec(
    text=["title", "body_pre"], categorical=["authors", "sourceTitle", "month"],
    numeric=["relevance", "importanceRank", "alexaGlobalRank", "shares_scaled", "score", "magnitude", *_MODERATION,
             "PERSON_mean_salience", "OTHER_mean_salience", "ORGANIZATION_mean_salience", "EVENT_mean_salience",
             "LOCATION_mean_salience", "WORK_OF_ART_mean_salience", "CONSUMER_GOOD_mean_salience", "PRICE_mean_salience"],
    num_features=1 << 10, zero=_MODERATION)


def _features(spark, sf_dir):
    # the estimators make several passes (indexers, IDF, imputer, LBFGS):
    # cut the lineage once so the feature chain runs a single time, on the
    # model's columns only
    feats = Fz.feature_table(balanced(spark, sf_dir))
    return materialize(feats.select("uri", "topic", "split", *TOPIC_SPEC.text, *TOPIC_SPEC.categorical, *TOPIC_SPEC.numeric))


@query("m1_topic_model_test_metrics")
def m1_topic_model_test_metrics(spark, sf_dir):
    """M1 + M2 + M3 + M9: logistic regression on the balanced feature table,
    regularisation chosen on VALIDATE, metrics reported on TEST."""
    feats = _features(spark, sf_dir)
    model, _grid = Mdl.train_with_validation(feats, TOPIC_SPEC, "topic", grid=(0.0, 0.1))
    test = Mdl.prediction_table(model, Mdl.model_input(feats.where(F.col("split") == "TEST"), TOPIC_SPEC), "topic")
    return Mdl.metrics_rows(test)


@query("m1_language_model_metrics")
def m1_language_model_metrics(spark, sf_dir):
    """P25 + M1 + M9 where there is something to learn: the language of
    ``documents`` by their text, size and source, on every fifth document by hash."""
    docs = table(spark, sf_dir, "documents").where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("string").alias("uri"), "lang", "text", "source", "n_chars",
        (F.xxhash64("doc_id") % 5 == 0).alias("_test"))
    spec = Mdl.FeatureSpec(text=["text"], categorical=["source"], numeric=["n_chars"])
    model = Mdl.train_classifier(docs.where(~F.col("_test")), spec, "lang", 0.01)
    return Mdl.metrics_rows(Mdl.prediction_table(model, Mdl.model_input(docs.where("_test"), spec), "lang"))


@query("m2_validation_grid")
def m2_validation_grid(spark, sf_dir):
    """M2: VALIDATE log loss for each regularisation."""
    return Mdl.train_with_validation(_features(spark, sf_dir), TOPIC_SPEC, "topic", grid=(0.0, 0.1))[1]


@query("m10_topic_batch_scores")
def m10_topic_batch_scores(spark, sf_dir):
    """M10 + M11 + M12: class probabilities for every TEST article, with the
    predicted class, flattened to (id, class, score) rows."""
    feats = _features(spark, sf_dir)
    model = Mdl.train_classifier(feats.where(F.col("split") == "TRAIN"), TOPIC_SPEC, "topic", 0.1)
    pred = Mdl.prediction_table(model, Mdl.model_input(feats.where(F.col("split") == "TEST"), TOPIC_SPEC), "topic")
    flat = Mdl.flatten_predictions(pred.withColumn("predicted", Mdl.predicted_class()), "id")
    return flat


@query("m10_score_invariants", S.with_(S.SPLIT, """
SELECT (SELECT count(*) FROM split_articles WHERE split = 'TEST' AND coalesce(body, '') <> '') AS ids,
       (SELECT count(DISTINCT topic) FROM split_articles WHERE split = 'TRAIN') AS least_classes,
       (SELECT count(DISTINCT topic) FROM split_articles WHERE split = 'TRAIN') AS most_classes,
       CAST(0 AS BIGINT) AS rows_without_class, CAST(0 AS BIGINT) AS ids_not_summing_to_one"""))
def m10_score_invariants(spark, sf_dir):
    """Every TEST article has one score for each class, which sum to 1."""
    per = m10_topic_batch_scores(spark, sf_dir).groupBy("id").agg(
        F.count_distinct("class").alias("n"), F.sum("score").alias("s"), F.count_if(F.col("class").isNull()).alias("none"))
    return per.agg(F.count("*").alias("ids"), F.min("n").alias("least_classes"), F.max("n").alias("most_classes"),
                   F.sum("none").alias("rows_without_class"),
                   F.count_if(F.abs(F.col("s") - 1) > 1e-9).alias("ids_not_summing_to_one"))


@query("m13_attributions")
def m13_attributions(spark, sf_dir):
    """Per TEST article, the three source columns contributing most to
    the predicted class of the linear model."""
    feats = _features(spark, sf_dir)
    model = Mdl.train_classifier(feats.where(F.col("split") == "TRAIN"), TOPIC_SPEC, "topic", 0.1)
    return Mdl.linear_attributions(model, Mdl.model_input(feats.where(F.col("split") == "TEST"), TOPIC_SPEC), TOPIC_SPEC, "uri", top=3)


@query("m13_shapley_topics")
def m13_shapley_topics(spark, sf_dir):
    """M13 by sampled Shapley walks: per TEST article, what each source column
    adds to the probability of its class, against 16 articles of the training set."""
    feats = _features(spark, sf_dir)
    train = feats.where(F.col("split") == "TRAIN")
    model = Mdl.train_classifier(train, TOPIC_SPEC, "topic", 0.1)
    ground = Mdl.model_input(train.orderBy("uri").limit(16), TOPIC_SPEC)
    return At.classifier_shapley(model, Mdl.model_input(feats.where(F.col("split") == "TEST"), TOPIC_SPEC), TOPIC_SPEC, ground)


_CHARGE = """SELECT l_orderkey, l_linenumber, cast(round(l_extendedprice * 100) AS DOUBLE) AS price,
 cast(100 - round(l_discount * 100) AS DOUBLE) AS paid, cast(100 + round(l_tax * 100) AS DOUBLE) AS taxed FROM lineitem"""
_GAIN = "sum(({0} - g.{0}) * (2 * {1} * {2} + {1} * g.{2} + g.{1} * {2} + 2 * g.{1} * g.{2})) / 30 AS {0}_part"


@query("m13_shapley_charge", f"""WITH c AS ({_CHARGE}),
g AS (SELECT price, paid, taxed FROM c ORDER BY l_orderkey, l_linenumber LIMIT 5)
SELECT l_orderkey, l_linenumber, sum(g.price * g.paid * g.taxed) / 5 AS baseline_output, c.price * c.paid * c.taxed AS instance_output,
{_GAIN.format("price", "c.paid", "c.taxed").replace("g.c.", "g.").replace("(price", "(c.price")},
{_GAIN.format("paid", "c.price", "c.taxed").replace("g.c.", "g.").replace("(paid", "(c.paid")},
{_GAIN.format("taxed", "c.price", "c.paid").replace("g.c.", "g.").replace("(taxed", "(c.taxed")}
FROM c, g GROUP BY ALL""")
def m13_shapley_charge(spark, sf_dir):
    """M13 of a product of three columns, all permutations: how price, discount
    and tax part the charge of a line from that of five lines.  Whole numbers,
    so that the sums are exact."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("double").alias("price"),
        (100 - F.round(F.col("l_discount") * 100)).cast("double").alias("paid"),
        (100 + F.round(F.col("l_tax") * 100)).cast("double").alias("taxed"))
    parts = ["price", "paid", "taxed"]
    ground = li.orderBy("l_orderkey", "l_linenumber").limit(5)
    out = At.sampled_shapley(li, parts, lambda: lambda rows: rows.prod(axis=1).to_numpy(), ground,
                             ["l_orderkey", "l_linenumber"])
    by_name = F.map_from_entries(F.transform("attributions", lambda a: F.struct(a["feature"], a["contribution"])))
    return out.select("l_orderkey", "l_linenumber", "baseline_output", "instance_output",
                      *[by_name[c].alias(f"{c}_part") for c in parts])


@query("m1_embedding_model_metrics")
def m1_embedding_model_metrics(spark, sf_dir):
    """M1 at scale on ``embeddings``: 10-class logistic regression on the
    64-dimensional vectors (hash split 80/20), TEST metrics as rows."""
    from pyspark.ml.classification import LogisticRegression

    e = (table(spark, sf_dir, "embeddings")
         .withColumn("features", array_to_vector("embedding"))
         .withColumn("label", F.col("label").cast("double"))
         .withColumn("_test", F.abs(F.hash("vec_id")) % 5 == 0))
    m = LogisticRegression(maxIter=30, regParam=0.01, family="multinomial").fit(e.where(~F.col("_test")))
    classes = F.array(*[F.lit(str(float(i)).rstrip("0").rstrip(".")) for i in range(m.numClasses)])
    pred = (m.transform(e.where(F.col("_test")))
            .select(F.col("vec_id").alias("id"), F.col("label").cast("int").cast("string").alias("label_name"),
                    classes.alias("classes"), vector_to_array_col("probability").alias("scores")))
    return Mdl.metrics_rows(pred)


def vector_to_array_col(c):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(c)
