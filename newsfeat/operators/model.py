"""Classifier training, evaluation and scoring (M1-M13) on ``pyspark.ml``.

Training and scoring are ``pyspark.ml`` pipelines (distributed fit,
``transform`` is a projection).  Evaluation works on a *prediction table*
``(id, label, classes, scores)``; every metric is an aggregation over it or
over per-(class, score) cells, with ROC points from distributed running
totals, so no class or score range is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (FeatureHasher, HashingTF, IDF, Imputer, RegexTokenizer, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.operators.ranking import cumulative_within, materialize

# ----------------------------------------------------------------- features (P25) and training (M1, M2)


class FeatureSpec:
    """P25: typed feature map — text columns are hashed term frequencies with
    IDF, categorical columns are hashed to 0/1 features (no list of their
    values is gathered), numeric columns imputed by their median, or by 0 for
    those in ``zero`` (absence means none of it)."""

    #: Features of a categorical column.
    CATEGORY_FEATURES = 256

    def __init__(self, text: Sequence[str] = (), categorical: Sequence[str] = (), numeric: Sequence[str] = (),
                 num_features: int = 1 << 12, zero: Sequence[str] = ()):
        self.zero = list(zero)
        self.text, self.categorical, self.numeric = list(text), list(categorical), list(numeric)
        self.num_features = num_features

    def row_stages(self) -> list:
        """What each row is turned into on its own, nothing being fitted."""
        st = []
        for c in self.text:
            st += [RegexTokenizer(inputCol=c, outputCol=f"{c}__tok", pattern=r"[\p{L}\p{N}]+", gaps=False),
                   HashingTF(inputCol=f"{c}__tok", outputCol=f"{c}__tf", numFeatures=self.num_features)]
        for c in self.categorical:
            st.append(FeatureHasher(inputCols=[c], outputCol=f"{c}__cat", categoricalCols=[c],
                                    numFeatures=self.CATEGORY_FEATURES))
        return st

    def row_columns(self) -> list[str]:
        """The columns that the fitted stages read."""
        return [f"{c}__tf" for c in self.text] + [f"{c}__cat" for c in self.categorical] + self.numeric

    def fitted_stages(self, label: str) -> list:
        """The label indexer first, the assembler last."""
        st = [StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error")]
        st += [IDF(inputCol=f"{c}__tf", outputCol=f"{c}__vec") for c in self.text]
        vec_inputs = [f"{c}__vec" for c in self.text] + [f"{c}__cat" for c in self.categorical]
        if self.numeric:
            st.append(Imputer(inputCols=self.numeric, outputCols=[f"{c}__imp" for c in self.numeric],
                              strategy="median"))
            vec_inputs += [f"{c}__imp" for c in self.numeric]
        st.append(VectorAssembler(inputCols=vec_inputs, outputCol="features", handleInvalid="keep"))
        return st

    def source_of(self, assembler_inputs: Sequence[str]) -> list[str]:
        """The column that each assembler input was made of."""
        made = {f"{c}{end}": c for end, cols in (("__vec", self.text), ("__cat", self.categorical), ("__imp", self.numeric))
                for c in cols}
        return [made[c] for c in assembler_inputs]

    def width(self, assembler_input: str) -> int:
        return {"__vec": self.num_features, "__cat": self.CATEGORY_FEATURES}.get(assembler_input[-5:], 1)


def numeric_cast(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def model_input(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Cast the numeric features to double (what ``Imputer`` expects), with 0
    where the spec says that absence means it; use it for training and
    scoring alike."""
    return numeric_cast(df, spec.numeric).fillna(0.0, subset=spec.zero)


def fit_features(train: DataFrame, spec: FeatureSpec, label: str = "topic") -> tuple[PipelineModel, DataFrame]:
    """The fitted feature stages, the label indexer first, and the encoded rows
    ``(label, features)``.  Texts are tokenised and hashed once, into a table of
    sparse vectors; the passes of the estimators read that."""
    row_stages = spec.row_stages()
    rows = PipelineModel(row_stages).transform(model_input(train, spec)).select(label, *spec.row_columns())
    rows = materialize(rows, "encoded")
    fitted = Pipeline(stages=spec.fitted_stages(label)).fit(rows)
    model = PipelineModel([fitted.stages[0], *row_stages, *fitted.stages[1:]])
    return model, fitted.transform(rows).select("label", "features")


def _fit_on(encoded: DataFrame, reg: float, max_iter: int) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, maxIter=max_iter,
                              family="multinomial").fit(encoded)


def train_classifier(train: DataFrame, spec: FeatureSpec, label: str = "topic", reg: float = 0.01,
                     max_iter: int = 50) -> PipelineModel:
    """M1: multinomial logistic regression (log-loss objective) on the
    feature spec."""
    features, encoded = fit_features(train, spec, label)
    return PipelineModel([*features.stages, _fit_on(encoded, reg, max_iter)])


def train_with_validation(df: DataFrame, spec: FeatureSpec, label: str = "topic", split: str = "split",
                          grid: Sequence[float] = (0.0, 0.01, 0.1), max_iter: int = 50) -> tuple[PipelineModel, DataFrame]:
    """M2: predefined split — fit the features on TRAIN once and a classifier
    for each regularisation, pick the one with the lowest VALIDATE log loss
    (M3); returns the model and the grid scores.  Both parts are encoded once."""
    features, encoded = fit_features(df.where(F.col(split) == "TRAIN"), spec, label)
    valid = scorer(features).transform(model_input(df.where(F.col(split) == "VALIDATE"), spec))
    valid = materialize(valid.select(label, "features"), "valid")
    results, best = [], None
    for reg in grid:
        m = _fit_on(encoded, reg, max_iter)
        pred = prediction_table(PipelineModel([features.stages[0], m]), valid, label, id_col=label)
        ll = log_loss(pred).collect()[0]["log_loss"]
        results.append((float(reg), float(ll) if ll is not None else None))
        if ll is not None and (best is None or ll < best[1]):
            best = (m, ll)
    if best is None:
        raise ValueError("no labelled VALIDATE rows to choose by")
    spark = df.sparkSession
    return PipelineModel([*features.stages, best[0]]), spark.createDataFrame(results, "reg_param double, validate_log_loss double")


# ----------------------------------------------------------------- scoring

def model_classes(model: PipelineModel) -> list[str]:
    """Class names in label-index order (from the fitted label indexer)."""
    return list(model.stages[0].labels)


def scorer(model: PipelineModel) -> PipelineModel:
    """The stages that scoring needs: all but the label indexer, so that rows
    with an unknown or no label are scored as well."""
    return PipelineModel(model.stages[1:])


def prediction_table(model: PipelineModel, df: DataFrame, label: str | None = "topic",
                     id_col: str = "uri") -> DataFrame:
    """``(id, label_name, classes, scores)`` per row; scores are the
    class probabilities (``vector_to_array(probability)``)."""
    classes = F.array(*[F.lit(c) for c in model_classes(model)])
    scored = scorer(model).transform(df)
    out = scored.select(F.col(id_col).alias("id"),
                        (F.col(label) if label else F.lit(None).cast("string")).alias("label_name"),
                        classes.alias("classes"), vector_to_array("probability").alias("scores"))
    return out


def predicted_class(classes: str = "classes", scores: str = "scores"):
    """Arg-max over parallel arrays (zip the columns, not literals)."""
    return F.array_max(F.arrays_zip(F.col(scores).alias("s"), F.col(classes).alias("c")))["c"]


def flatten_predictions(pred: DataFrame, id_col: str = "id") -> DataFrame:
    """One ``(id, class, score)`` row per class."""
    z = F.arrays_zip(F.col("classes").alias("class"), F.col("scores").alias("score"))
    return pred.select(id_col, F.inline(z))


# ----------------------------------------------------------------- metrics (M3-M9)

def _p_true():
    idx = F.array_position(F.col("classes"), F.col("label_name"))
    return F.element_at(F.col("scores"), idx.cast("int"))


def log_loss(pred: DataFrame, eps: float = 1e-15, by_class: bool = False) -> DataFrame:
    """M3 (and M4 with ``by_class``): mean ``-ln p(true class)``, clipped."""
    ll = -F.log(F.greatest(F.least(_p_true(), F.lit(1 - eps)), F.lit(eps)))
    base = pred.where(F.col("label_name").isNotNull())
    if by_class:
        return base.groupBy("label_name").agg(F.avg(ll).alias("log_loss"), F.count(F.lit(1)).alias("n"))
    return base.agg(F.avg(ll).alias("log_loss"))


def confusion_matrix(pred: DataFrame, classes: Sequence[str]) -> DataFrame:
    """M5: true class x predicted class counts, 0 for empty cells."""
    p = pred.withColumn("predicted", predicted_class())
    m = p.groupBy("label_name").pivot("predicted", list(classes)).agg(F.count(F.lit(1)))
    m = m.fillna(0, subset=list(classes))
    return m.select("label_name", *[F.col(f"`{c}`").cast("long").alias(str(c)) for c in classes])


def roc_cells(pred: DataFrame) -> DataFrame:
    """One-vs-rest score cells ``(class, score, pos, neg)``: for every class,
    how many rows of that class / of other classes got each score."""
    z = F.arrays_zip(F.col("classes").alias("class"), F.col("scores").alias("score"))
    e = pred.select("label_name", F.inline(z))
    return (e.groupBy("class", "score")
            .agg(F.count_if(F.col("label_name") == F.col("class")).alias("pos"),
                 F.count_if(F.col("label_name") != F.col("class")).alias("neg")))


def roc_points(pred: DataFrame) -> DataFrame:
    """M6: for every class and distinct score (as threshold, descending):
    true-positive and false-positive rates and precision.  Running totals
    come from ``cumulative_within`` grouped by class."""
    cells = roc_cells(pred)
    c = cumulative_within(cells, ["class"], [F.col("score").desc()], ["pos", "neg"], cum=["tp", "fp"],
                          total=["P", "N"])
    return c.select("class", F.col("score").alias("threshold"), "tp", "fp", "pos", "neg", "P", "N",
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"),
                    F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def auc(points: DataFrame) -> DataFrame:
    """M7: per class, area under ROC (trapezoids) and under the
    precision-recall curve (step form, average precision).  The previous
    point is the running total minus the cell itself, so no ordered window
    is needed."""
    tpr, fpr = F.col("tpr"), F.col("fpr")
    ptpr = F.try_divide(F.col("tp") - F.col("pos"), F.col("P"))
    pfpr = F.try_divide(F.col("fp") - F.col("neg"), F.col("N"))
    return points.groupBy("class").agg(
        F.sum((fpr - pfpr) * (tpr + ptpr) / 2).alias("au_roc"),
        F.sum((tpr - ptpr) * F.col("precision")).alias("au_prc"))


def metrics_rows(pred: DataFrame) -> DataFrame:
    """M9: all metrics as ``(metric, value)`` rows: log loss, macro auROC and
    auPRC, accuracy (confidence points excluded)."""
    a = auc(roc_points(pred))
    acc = pred.agg(F.avg((predicted_class() == F.col("label_name")).cast("double")))
    one = log_loss(pred).select(
        "log_loss", a.agg(F.avg("au_roc")).scalar().alias("au_roc"),
        a.agg(F.avg("au_prc")).scalar().alias("au_prc"), acc.scalar().alias("accuracy"))
    return one.selectExpr("stack(4, 'logLoss', log_loss, 'auRoc', au_roc, 'auPrc', au_prc, "
                          "'accuracy', accuracy) AS (metric, value)")


#: Metrics and whether more is better.
HIGHER_IS_BETTER = {"auRoc": True, "auPrc": True, "accuracy": True, "logLoss": False}


def deployment_gate(current: dict[str, float], previous: dict[str, float] | None,
                    threshold: dict[str, float]) -> bool:
    """M8: deploy unless, for some thresholded metric, the new model is worse
    than the threshold **and** worse than the previous model (trap T9: the
    threshold must be a dict such as ``{"auRoc": 0.95}``)."""
    if not isinstance(threshold, dict):
        raise TypeError("threshold must be a dict of metric -> value")
    for name, th in threshold.items():
        if name not in HIGHER_IS_BETTER:
            raise ValueError(f"no such metric: {name}")
        sign = 1 if HIGHER_IS_BETTER[name] else -1
        value = sign * current[name]
        prev = previous.get(name) if previous else None
        if value < sign * th and (prev is None or value < sign * prev):
            return False
    return True


# ----------------------------------------------------------------- attribution

_CREDITS = pa.list_(pa.struct([("contribution", pa.float64()), ("feature", pa.string())]))
#: Rows of features that a task holds as dense arrays at once.
DENSE_ROWS = 1024


def sparse_parts(vector: str) -> list[Column]:
    """A vector column as ``_at`` and ``_v``: the positions and values
    that travel to the tasks (null positions: all)."""
    v = F.unwrap_udt(vector)
    return [v["indices"].alias("_at"), v["values"].alias("_v")]


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, max(1, len(batch)), DENSE_ROWS):
            yield batch.slice(k, DENSE_ROWS)


def dense_rows(pdf: pd.DataFrame, width: int) -> np.ndarray:
    """``(rows, width)`` of the ``sparse_parts`` of a piece."""
    out = np.zeros((len(pdf), width))
    for row, at, v in zip(out, pdf["_at"], pdf["_v"]):
        row[slice(None) if at is None else at] = v
    return out


def linear_attributions(model: PipelineModel, df: DataFrame, spec: FeatureSpec, id_col: str = "uri",
                        top: int | None = None) -> DataFrame:
    """M13 (re-aimed): for the predicted class of each row, coefficient x
    feature value summed back to the source columns and sorted by
    contribution (O7).  The coefficient matrix is model-sized (classes x
    width) and travels with the task closure; an Arrow batch is one array
    operation, no shuffle."""
    lr = model.stages[-1]
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][0]
    coef = lr.coefficientMatrix.toArray()
    inputs = assembler.getInputCols()
    sources = spec.source_of(inputs)
    sizes = [spec.width(c) for c in inputs]
    starts = np.cumsum([0] + sizes[:-1])
    by_name = np.argsort(sources, kind="stable")  # equal contributions go by name
    scored = scorer(model).transform(df).select(F.col(id_col).cast("string").alias("id"), *sparse_parts("features"),
                                                F.col("prediction").cast("int").alias("k"))

    def attribute(batches):
        for batch in pieces(batches):
            pdf = batch.select(["_at", "_v", "k"]).to_pandas()
            rows = []
            if len(pdf):
                contrib = coef[pdf["k"].to_numpy()] * dense_rows(pdf, coef.shape[1])
                per = np.add.reduceat(contrib, starts, axis=1)[:, by_name]
                order = np.argsort(-per, axis=1, kind="stable")[:, :top]
                rows = [[{"contribution": float(p[i]), "feature": sources[by_name[i]]} for i in o]
                        for p, o in zip(per, order)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, _CREDITS)], ["id", "attributions"])

    return scored.mapInArrow(attribute, "id string, attributions array<struct<contribution:double,feature:string>>")
