"""Model features, split, training, scoring, back-test and order intents.

Scaling and encoding are fitted once on the training data and travel inside
the saved ``PipelineModel`` (no refit at scoring time). Statistics are
distributed aggregates (one row), levels come from ``StringIndexer`` (bounded
by the column's cardinality). Fitting and scoring are Spark ML; the back-test
and error metrics are single aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)
CATEGORICAL = (T.StringType, T.BooleanType)


def feature_columns(df: DataFrame, *, target: str, ids: Sequence[str]) -> list[str]:
    """Model features = all columns - target - identification columns."""
    drop = set(ids) | {target}
    return [c for c in df.columns if c not in drop]


def split_types(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if isinstance(types[c], NUMERIC)]
    cat = [c for c in cols if isinstance(types[c], CATEGORICAL)]
    return num, cat


# ------------------------------------------------------------------ scaling ---

def zscore_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean and population std of each column (nulls ignored)."""
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols],
                  *[F.stddev_pop(c).alias(f"{c}__std") for c in cols])


def scale_continuous(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0. ``stats``
    (from the training data) can be reused at scoring time. The statistics
    enter as scalar subqueries over the one-row stats frame (Catalyst merges
    them into one aggregate job); no join."""
    stats = stats if stats is not None else zscore_stats(df, cols)
    out = {}
    for c in cols:
        mean = stats.select(f"{c}__mean").scalar()
        std = stats.select(f"{c}__std").scalar()
        out[c] = F.when(std == 0, F.lit(0.0)).otherwise((F.col(c) - mean) / std)
    return df.withColumns(out)


# ----------------------------------------------------------------- encoding ---

def categorical_stages(cat: Sequence[str]) -> tuple[list, list[str]]:
    """StringIndexer (alphabetical levels) + OneHotEncoder without dropping;
    binary columns are later reduced to one 0/1 column."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep") for c in cat]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cat],
                        outputCols=[f"{c}__ohe" for c in cat], dropLast=False,
                        handleInvalid="keep") if cat else None
    return idx + ([ohe] if ohe else []), [f"{c}__ohe" for c in cat]


def one_hot_columns(df: DataFrame, cat: Sequence[str]) -> DataFrame:
    """Plain-column one-hot: per column, the alphabetically sorted levels seen
    in the data become 0/1 columns ``<col>_<level>``; a binary column keeps a
    single column for its second level. Levels come from a fitted
    ``StringIndexer`` (a distinct over the column, bounded by cardinality)."""
    typed = df.withColumns({c: F.col(c).cast("string") for c in cat
                            if isinstance(df.schema[c].dataType, T.BooleanType)})
    model = Pipeline(stages=[StringIndexer(inputCol=c, outputCol=f"{c}__idx",
                                           stringOrderType="alphabetAsc") for c in cat]).fit(typed)
    out = typed
    for c, m in zip(cat, model.stages):
        levels = list(m.labels)
        keep = levels[1:] if len(levels) == 2 else levels
        out = out.withColumns({f"{c}_{lv}": (F.col(c) == F.lit(lv)).cast("double") for lv in keep})
        out = out.drop(c)
    return out


# -------------------------------------------------------------------- split ---

def split_bucket(key: str | Column) -> Column:
    """Stable 0..99 bucket from the row key (independent of partitioning)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"),
                  F.lit(100))


def train_test_split(df: DataFrame, *, key: str, test_fraction: float) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(key)
    cut = int(round(test_fraction * 100))
    return df.where(b >= cut), df.where(b < cut)


# ------------------------------------------------------------------- models ---

def binary_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each boolean feature gets a 0/1 twin ``<c>__f`` (binary one-hot); the
    original column is kept so scored rows still equal their input."""
    return df.withColumns({f"{c}__f": F.col(c).cast("double") for c in features
                           if isinstance(df.schema[c].dataType, T.BooleanType)})


def feature_stages(df: DataFrame, features: Sequence[str]) -> list:
    """Stages over ``binary_flags(df)`` that end in a ``features`` vector: numeric
    columns z-scored (fitted on training data), strings one-hot, 0/1 flags as they
    are. Spark ML's scaler divides by the sample standard deviation, the plain
    ``scale_continuous`` by the population's: a constant factor near 1."""
    types = {f.name: f.dataType for f in df.schema.fields}
    flags = [f"{c}__f" for c in features if isinstance(types[c], T.BooleanType)]
    num, cat = split_types(df, [c for c in features if not isinstance(types[c], T.BooleanType)])
    stages, ohe_cols = categorical_stages(cat)
    raw = VectorAssembler(inputCols=num, outputCol="__num", handleInvalid="keep")
    scaler = StandardScaler(inputCol="__num", outputCol="__num_s", withMean=True, withStd=True)
    assemble = VectorAssembler(inputCols=["__num_s", *flags, *ohe_cols], outputCol="features",
                               handleInvalid="keep")
    return [*stages, raw, scaler, assemble]


FAMILIES = ("linear", "forest", "boosted")


def _family(name: str, target: str, seed: int):
    """An estimator and its small grid."""
    if name == "linear":
        est = LinearRegression(labelCol=target, featuresCol="features")
        return est, ParamGridBuilder().addGrid(est.regParam, [0.0, 0.01, 0.1]).build()
    if name == "forest":
        est = RandomForestRegressor(labelCol=target, featuresCol="features", seed=seed, numTrees=20)
        return est, ParamGridBuilder().addGrid(est.maxDepth, [3, 5]).build()
    if name == "boosted":
        est = GBTRegressor(labelCol=target, featuresCol="features", seed=seed, maxIter=10)
        return est, ParamGridBuilder().addGrid(est.maxDepth, [3]).build()
    raise ValueError(f"unknown family {name!r}")


def search_regressors(train: DataFrame, *, features: Sequence[str], target: str,
                      families: Sequence[str] = FAMILIES, parallelism: int = 3,
                      seed: int = 42) -> tuple[PipelineModel, list[tuple[str, float]]]:
    """Model search across families, each with its own small grid, by MAE on a
    held-out part of the training data; returns the leader, as one pipeline from
    raw columns to prediction, and (family, MAE) per family.

    The feature stages are fitted once; all candidates train on the stored
    vectors (a reliable checkpoint), not on the lineage behind them."""
    flagged = binary_flags(train, features)
    prepared = Pipeline(stages=feature_stages(flagged, features)).fit(flagged)
    vectors = stored(prepared.transform(flagged).select("features", target))
    results = []
    for fam in families:
        est, grid = _family(fam, target, seed)
        tvs = TrainValidationSplit(estimator=est, estimatorParamMaps=grid,
                                   evaluator=RegressionEvaluator(labelCol=target, metricName="mae"),
                                   trainRatio=0.8, parallelism=parallelism, seed=seed).fit(vectors)
        results.append((fam, float(min(tvs.validationMetrics)), tvs.bestModel))
    best = min(results, key=lambda r: r[1])
    return (PipelineModel(stages=[*prepared.stages, best[2]]), [(f, m) for f, m, _ in results])


def train_regressor(train: DataFrame, *, features: Sequence[str], target: str,
                    estimator: str = "linear", parallelism: int = 3, seed: int = 42
                    ) -> PipelineModel:
    """The search within one family."""
    return search_regressors(train, features=features, target=target, families=(estimator,),
                             parallelism=parallelism, seed=seed)[0]


def score(model: PipelineModel, df: DataFrame, *, keep: Sequence[str] | None = None) -> DataFrame:
    """Predict on every row (map-only); originals kept + ``prediction``."""
    out = model.transform(binary_flags(df, df.columns))
    cols = list(keep) if keep is not None else df.columns
    return out.select(*cols, "prediction")


def classify_sign(df: DataFrame, *, features: Sequence[str], target: str, seed: int = 42):
    """Classifier on the sign of the target (declared in the reference, kept
    for parity): logistic regression over the same features."""
    from pyspark.ml.classification import LogisticRegression
    labelled = binary_flags(df, features).withColumn("__label", (F.col(target) < 0).cast("double"))
    num, cat = split_types(labelled, features)
    flags = [f"{c}__f" for c in features if isinstance(df.schema[c].dataType, T.BooleanType)]
    num = [c for c in num if not isinstance(df.schema[c].dataType, T.BooleanType)]
    cat = [c for c in cat if not isinstance(df.schema[c].dataType, T.BooleanType)]
    stages, ohe_cols = categorical_stages(cat)
    pipe = Pipeline(stages=[*stages,
                            VectorAssembler(inputCols=[*num, *flags, *ohe_cols], outputCol="features",
                                            handleInvalid="keep"),
                            LogisticRegression(labelCol="__label", featuresCol="features")])
    return pipe.fit(labelled)


# ------------------------------------------------------ back-test / metrics ---

def backtest_shorts(pred: DataFrame, *, actual: str = "label", prediction: str = "prediction",
                    investment: float = 100.0, threshold: float = -0.3, initial: int = 1,
                    by: Sequence[str] | None = None) -> DataFrame:
    """Short every row predicted at or below ``threshold``: gains =
    sum(-investment * actual); capital = investment * (n + initial). The sum
    runs in decimal so the result does not depend on row order."""
    hit = F.col(prediction) <= F.lit(threshold)
    gains = F.coalesce(F.sum(F.when(hit, F.col(actual).cast("decimal(20,8)"))),
                       F.lit(0).cast("decimal(20,8)")).cast("double") * F.lit(-investment)
    n = F.count_if(hit)
    aggs = [gains.alias("gains"), (F.lit(investment) * (n + F.lit(initial))).alias("capital"),
            n.alias("n_positions")]
    return pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)


def mae_negative(pred: DataFrame, *, actual: str = "label", prediction: str = "prediction",
                 below: float = 0.0) -> DataFrame:
    """Mean absolute error over rows predicted below ``below``."""
    neg = F.col(prediction) < F.lit(below)
    err = F.abs(F.col(actual) - F.col(prediction)).cast("decimal(20,10)")
    return pred.agg((F.sum(F.when(neg, err)).cast("double") / F.count_if(neg)).alias("mae"),
                    F.count_if(neg).alias("n_negative"))


def order_intents(pred: DataFrame, *, threshold: float, qty: int = 1, side: str = "sell",
                  order_type: str = "market", time_in_force: str = "gtc",
                  prediction: str = "prediction", ticker: str = "ticker") -> DataFrame:
    """Order rows for predictions below ``threshold`` (written as a table;
    no broker call)."""
    return pred.where(F.col(prediction) < F.lit(threshold)).select(
        F.upper(F.trim(F.col(ticker))).alias("symbol"), F.lit(str(qty)).alias("qty"),
        F.lit(side).alias("side"), F.lit(order_type).alias("order_type"),
        F.lit(time_in_force).alias("time_in_force"))
