"""Sampled Shapley attributions of any model, against a background sample.

A *walk* starts from a background row and gives it the row's own values one
column after the other, in the order of a permutation; what a step adds to the
model's output is credited to its column.  Permutations come in pairs, one and
its reverse, which cancels the parts that are linear in the position.  The
contributions of a row add up to its output less the mean output of the
background.  If all permutations are affordable they are all walked, and the
result is exact.

Rows are independent: an Arrow batch at a time, no shuffle.  The walks are the
same for every row, so results do not hang on partitions.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.operators.model import FeatureSpec, dense_rows, pieces, scorer, sparse_parts

#: The background travels with the task closure; more rows are refused.
MOST_BACKGROUND = 1000

#: Gives, for a batch of rows, the outputs ``(rows, outputs)``.
Predict = Callable[[pd.DataFrame], np.ndarray]
#: A walk: the order of the columns and the number of its background row.
Walk = tuple[tuple[int, ...], int]

OUTPUTS = ("output_index int, baseline_output double, instance_output double, approximation_error double, "
           "attributions array<struct<contribution:double,feature:string>>")
OUTPUT_NAMES = ("output_index", "baseline_output", "instance_output", "approximation_error", "attributions")


def walks(columns: int, background: int, pairs: int, seed: int = 0) -> tuple[list[list[Walk]], bool]:
    """Pairs of walks and whether they are all there are.  The pairs use every
    background row equally often, so ``pairs`` is rounded up to a multiple."""
    if columns < 8 and math.factorial(columns) <= 2 * pairs:
        orders = list(itertools.permutations(range(columns)))
        return [[(o, b)] for b in range(background) for o in orders], True
    rng = np.random.default_rng(seed)
    out = []
    for i in range(-(-pairs // background) * background):
        order = tuple(int(c) for c in rng.permutation(columns))
        out.append([(order, i % background), (order[::-1], i % background)])
    return out, False


def _each_once(value: Callable[[np.ndarray, int], np.ndarray]) -> Callable[[np.ndarray, int], np.ndarray]:
    """``value`` with the outputs of the background row at hand kept."""
    kept: dict[bytes, np.ndarray] = {}
    ground = [-1]

    def found(own: np.ndarray, b: int) -> np.ndarray:
        if ground[0] != b:
            ground[0] = b
            kept.clear()
        key = own.tobytes()
        if key not in kept:
            kept[key] = value(own, b)
        return kept[key]

    return found


def contributions(value: Callable[[np.ndarray, int], np.ndarray], columns: int, paired: list[list[Walk]],
                  exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, columns)`` contributions, the mean output of the background and
    the largest standard error of a row's contributions.  ``value(own, b)`` is
    the rows' output with the columns marked in ``own`` and the others of
    background row ``b``."""
    total = squares = start = 0.0
    if exact:  # the same subsets come up in many orders
        value = _each_once(value)
    for pair in paired:
        here = 0.0
        for order, b in pair:
            own = np.zeros(columns, dtype=bool)
            before = value(own, b)
            start = start + before / len(pair)
            steps = np.empty((len(before), columns))
            for c in order:
                own[c] = True
                after = value(own, b)
                steps[:, c], before = after - before, after
            here = here + steps
        total = total + here
        squares = squares + (here / len(pair)) ** 2
    n, each = len(paired), len(paired[0])
    mean = total / (n * each)
    spread = np.maximum(squares / n - mean ** 2, 0.0) / max(1, n - 1)
    error = np.zeros(len(mean)) if exact or not columns else np.sqrt(spread).max(axis=1)
    return mean, start / n, error


def _sorted_pairs(per: np.ndarray, names: Sequence[str], top: int | None) -> pa.Array:
    """A row's contributions in descending order, as a list column."""
    by_name = np.argsort(np.array(names), kind="stable")  # equal contributions go by name
    order = by_name[np.argsort(-per[:, by_name], axis=1, kind="stable")[:, :top]]
    ends = np.arange(len(order) + 1, dtype=np.int32) * order.shape[1]
    pairs = pa.StructArray.from_arrays([pa.array(np.take_along_axis(per, order, axis=1).ravel(), pa.float64()),
                                        pa.array(names, pa.string()).take(pa.array(order.ravel()))], ["contribution", "feature"])
    return pa.ListArray.from_arrays(pa.array(ends), pairs)


def _explained(kept: pa.RecordBatch, index: np.ndarray, whole: np.ndarray, names: Sequence[str], top: int | None,
               value: Callable[[np.ndarray, int], np.ndarray], paired: list[list[Walk]], exact: bool) -> pa.RecordBatch:
    per, start, error = contributions(value, len(names), paired, exact)
    columns = [pa.array(index.astype(np.int32)), *[pa.array(np.asarray(c, dtype=float)) for c in (start, whole, error)],
               _sorted_pairs(per, names, top)]
    return pa.RecordBatch.from_arrays([*kept.columns, *columns], [*kept.schema.names, *OUTPUT_NAMES])


def _as_pandas(batch: pa.RecordBatch, zone: str) -> pd.DataFrame:
    """As ``toPandas`` has it: times without a zone, in that of the session."""
    pdf = batch.to_pandas()
    for c in pdf.columns:
        if isinstance(pdf[c].dtype, pd.DatetimeTZDtype):
            pdf[c] = pdf[c].dt.tz_convert(zone).dt.tz_localize(None)
    return pdf


def bounded_background(background: DataFrame) -> pd.DataFrame:
    rows = background.limit(MOST_BACKGROUND + 1).toPandas()
    if not 0 < len(rows) <= MOST_BACKGROUND:
        raise ValueError(f"the background needs 1 to {MOST_BACKGROUND} rows")
    return rows


def sampled_shapley(df: DataFrame, columns: Sequence[str], make_predict: Callable[[], Predict], background: DataFrame,
                    keep: Sequence[str], pairs: int = 32, output: int | None = None, top: int | None = None,
                    seed: int = 0) -> DataFrame:
    """M13 for any model: ``keep`` columns, ``output_index``, the mean output
    of the background, the row's output, the standard error of the worst
    contribution (0 where all permutations are walked) and the contributions of
    ``columns`` in descending order.

    ``make_predict()`` is called once a partition; its function takes a pandas
    frame of ``columns``.  ``output`` names the output to explain (default: the
    row's largest, the first of equals).  Nulls reach the model as pandas has
    them; rows with equal values have equal results; an empty table gives none."""
    columns = list(columns)
    ground = bounded_background(background.select(*columns))
    paired, exact = walks(len(columns), len(ground), pairs, seed)
    schema = T.StructType([df.schema[c] for c in keep] + T._parse_datatype_string(OUTPUTS).fields)
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")

    def run(batches):
        predict = make_predict()
        for batch in batches:
            if not len(batch):
                continue
            own_rows, n = _as_pandas(batch.select(columns), zone), np.arange(len(batch))
            first = np.asarray(predict(own_rows), dtype=float).reshape(len(n), -1)
            index = np.full(len(n), output) if output is not None else first.argmax(axis=1)

            def value(own, b, own_rows=own_rows, n=n, index=index):
                mixed = own_rows.assign(**{c: ground[c].iloc[b] for c, mine in zip(columns, own) if not mine})
                return np.asarray(predict(mixed), dtype=float).reshape(len(n), -1)[n, index]

            yield _explained(batch.select(list(keep)), index, first[n, index], columns, top, value, paired, exact)

    return df.select(*dict.fromkeys([*keep, *columns])).mapInArrow(run, schema)


def classifier_shapley(model: PipelineModel, df: DataFrame, spec: FeatureSpec, background: DataFrame,
                       id_col: str = "uri", pairs: int = 16, probability: bool = True, top: int | None = None,
                       seed: int = 0) -> DataFrame:
    """M13 for the trained classifier, in its source columns: what each adds to
    the probability of the predicted class (or to its margin).

    A source column acts through the margins that its part of the feature vector
    gives to the classes; a batch's vectors are turned into these at once, and the
    walks only add them up."""
    lr = model.stages[-1]
    coef, base = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    inputs = [s for s in model.stages if isinstance(s, VectorAssembler)][0].getInputCols()
    sources = spec.source_of(inputs)
    names = sorted(set(sources))
    ends = np.cumsum([0] + [spec.width(c) for c in inputs])

    def margins(rows: pd.DataFrame) -> np.ndarray:
        f = dense_rows(rows, coef.shape[1])
        out = np.zeros((len(f), len(names), len(coef)))
        for s, a, b in zip(sources, ends[:-1], ends[1:]):
            out[:, names.index(s)] += f[:, a:b] @ coef[:, a:b].T
        return out

    def outputs(z: np.ndarray) -> np.ndarray:
        if not probability:
            return z
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    encoded = scorer(model)
    ground = margins(bounded_background(encoded.transform(background).select(*sparse_parts("features"))))
    paired, exact = walks(len(names), len(ground), pairs, seed)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)] + T._parse_datatype_string(OUTPUTS).fields)

    def run(batches):
        for batch in pieces(batches):
            if not len(batch):
                continue
            mine, n = margins(batch.select(["_at", "_v"]).to_pandas()), np.arange(len(batch))
            whole = base + mine.sum(axis=1)
            index = whole.argmax(axis=1)

            def value(own, b, mine=mine, n=n, index=index):
                return outputs(base + mine[:, own].sum(axis=1) + ground[b][~own].sum(axis=0))[n, index]

            yield _explained(batch.select(["id"]), index, outputs(whole)[n, index], names, top, value, paired, exact)

    return encoded.transform(df).select(F.col(id_col).alias("id"), *sparse_parts("features")).mapInArrow(run, schema)
