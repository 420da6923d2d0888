"""Registered queries: features, split, training, scoring, back-test, orders.

The training frame is the forward-return table ``rt4`` built from the driver
tables. Queries with a deterministic outcome use ``avg_target_expanding`` (the
leakage-safe prior) as the prediction so they have a SQL twin; fitting and
model scoring are checked by row counts.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import ml as ML
from ..operators.search import search_within
from ..session import cut_lineage, in_part, number_of_parts, partitions_for, \
    scratch_path, stored
from ..sources.catalog import FeatureStore, load_catalog
from ..sources.models import ModelStore
from ..sources.tables import input_stamp, read_table, table_path
from . import q_target
from . import target as TG
from .proxies import price_bars, transactions, with_ctes
from .registry import register

RT4 = dict(rt4=q_target._rt4_sql_cte())
# Columns that training drops, and those that only identify a row
DROPPED = ("timestamp", "coding", "insider_cik")
IDS = ["key", "ticker", "insider_name", "date", "company_cik", "price"]
TARGET = "pct_change"
THRESHOLD = 0.0


def rt4(spark, sf):
    return q_target.q_build_training_target(spark, sf)


def _stamped(spark, sf, name):
    """A place in the shared folder for what is derived from a data folder as it is now."""
    stamp = "|".join([sf.rstrip("/"), input_stamp(spark, table_path(sf, "lineitem")),
                      input_stamp(spark, table_path(sf, "orders"))])
    return scratch_path(spark, f"{name}-{hashlib.sha256(stamp.encode()).hexdigest()[:16]}")


def _features(spark, sf):
    """The store of the feature tables."""
    return FeatureStore(spark, _stamped(spark, sf, "features"), load_catalog(TG.TARGET_CATALOG, 1))


def _sized(spark, sf):
    """(shuffle partitions, parts) by the line items, of which transactions and bars are made."""
    n = read_table(spark, sf, "lineitem").count()
    parts = number_of_parts(n)
    return partitions_for(spark, -(-n // parts)), parts


def _partitions(spark, sf):
    return partitions_for(spark, read_table(spark, sf, "lineitem").count())


def _has(store, ref):
    m = store.manifest(ref)
    return m is not None and m.last is not None


def stored_rt4(spark, sf):
    """The stored training target; the target service's upsert comes first if it never ran."""
    store = _features(spark, sf)
    if not _has(store, "rt4"):
        partitions, parts = _sized(spark, sf)
        with partitions:
            store.upsert("rt4", TG.training_target_in_parts(
                transactions(spark, sf), price_bars(spark, sf), parts, period=q_target.PERIOD,
                direction="R"))
    return store.read("rt4")


def stored_bir4(spark, sf):
    """The stored inference features, built from the stored target if they are not there."""
    store = _features(spark, sf)
    if not _has(store, "bir4"):
        target = stored_rt4(spark, sf)
        partitions, parts = _sized(spark, sf)
        with partitions:
            store.upsert("bir4", TG.inference_features_in_parts(
                transactions(spark, sf), target, parts, direction="A"))
    return store.read("bir4")


def _prior(spark, sf):
    """Predictions = the leakage-safe expanding average; label = target."""
    return rt4(spark, sf).select("key", "ticker", F.col(TARGET).alias("label"),
                                 F.col("avg_target_expanding").alias("prediction"))


@register("scale_continuous", with_ctes(
    "select key, round(case when stddev_pop(price) over () = 0 then 0 else (price - avg(price) "
    "over ()) / stddev_pop(price) over () end, 6) as price_z, round(case when stddev_pop(tx_value) "
    "over () = 0 then 0 else (tx_value - avg(tx_value) over ()) / stddev_pop(tx_value) over () end, "
    "6) as tx_value_z from rt4", **RT4))
def q_scale_continuous(spark, sf):
    df = rt4(spark, sf).select("key", "price", "tx_value")
    z = ML.scale_continuous(df, ["price", "tx_value"])
    return z.select("key", F.round("price", 6).alias("price_z"),
                    F.round("tx_value", 6).alias("tx_value_z"))


@register("one_hot_drop_binary", with_ctes(
    "select key, (coding = 'O')::double as coding_O, "
    "(derivative::varchar = 'true')::double as derivative_true, "
    + ", ".join(f"(owner_code = '{c}')::double as owner_code_{c}"
                for c in ("0000", "0010", "0100", "0110", "1000", "1010", "1100", "1110"))
    + " from rt4", **RT4))
def q_one_hot_drop_binary(spark, sf):
    with _partitions(spark, sf):     # stored: each column's levels are a pass over the rows
        df = stored(rt4(spark, sf).select("key", "coding", "derivative", "owner_code"))
    return ML.one_hot_columns(df, ["coding", "derivative", "owner_code"])


@register("train_test_split", with_ctes(
    "select key, ('0x' || substr(md5(key), 1, 8))::bigint % 100 < 20 as is_test from rt4", **RT4))
def q_train_test_split(spark, sf):
    df = rt4(spark, sf).select("key")
    return df.withColumn("is_test", ML.split_bucket("key") < 20)


@register("filter_negative_predictions", with_ctes(
    "select key, avg_target_expanding as prediction from rt4 where avg_target_expanding < 0",
    **RT4))
def q_filter_negative_predictions(spark, sf):
    return _prior(spark, sf).where(F.col("prediction") < 0).select("key", "prediction")


@register("backtest_shorts", with_ctes(
    "select coalesce(sum(pct_change::decimal(20,8)) filter (where avg_target_expanding <= 0), 0)"
    "::double * -100.0 as gains, (100.0 * (count(*) filter (where avg_target_expanding <= 0) + 1))"
    "::double as capital, count(*) filter (where avg_target_expanding <= 0) as n_positions from rt4", **RT4))
def q_backtest_shorts(spark, sf):
    return ML.backtest_shorts(_prior(spark, sf), investment=100.0, threshold=THRESHOLD)


@register("mae_negative", with_ctes(
    "select sum(abs(pct_change - avg_target_expanding)::decimal(20,10)) filter "
    "(where avg_target_expanding < 0)::double / count(*) filter (where avg_target_expanding < 0) "
    "as mae, count(*) filter (where avg_target_expanding < 0) as n_negative from rt4", **RT4))
def q_mae_negative(spark, sf):
    return ML.mae_negative(_prior(spark, sf))


@register("row_counts", with_ctes(
    "select count(*) as n_rows, count(distinct ticker) as n_tickers from rt4", **RT4))
def q_row_counts(spark, sf):
    """Counted on two columns of the stored target, without building it again. (``observe``
    would count during the write, but the first observation of a session makes it
    unserialisable for the closures of Spark ML's models in this version.)"""
    return stored_rt4(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct("ticker").alias("n_tickers"))


@register("align_predictions", with_ctes(
    "select key, pct_change as label, avg_target_expanding as prediction from rt4", **RT4))
def q_align_predictions(spark, sf):
    """Predictions meet actuals by key (inner join), never by position; the rows are
    stored once, both sides read them."""
    r = cut_lineage(rt4(spark, sf))
    preds = r.select("key", F.col("avg_target_expanding").alias("prediction"))
    actual = r.select("key", F.col(TARGET).alias("label"))
    return actual.join(preds, "key", "inner")


@register("order_intents", with_ctes(
    "select upper(trim(ticker)) as symbol, '1' as qty, 'sell' as side, 'market' as order_type, "
    "'gtc' as time_in_force from rt4 where avg_target_expanding < 0", **RT4))
def q_order_intents(spark, sf):
    return ML.order_intents(_prior(spark, sf), threshold=THRESHOLD)


def _models(spark, sf):
    """The stored models of a data folder."""
    return ModelStore(spark, _stamped(spark, sf, "models"))


BUDGET_S = 15.0


def _training_frame(spark, sf):
    """(rows, features): the stored target without the dropped columns."""
    df = C.drop_if_present(stored_rt4(spark, sf), DROPPED)
    return df, ML.feature_columns(df, target=TARGET, ids=IDS)


def _train(spark, sf, families=("linear",)):
    df, feats = _training_frame(spark, sf)
    train, test = ML.train_test_split(df, key="key", test_fraction=0.2)
    model, _ = ML.search_regressors(train, features=feats, target=TARGET, families=families)
    return model, test, feats


def _search(spark, sf, budget_s=BUDGET_S):
    """(search, test rows): all families within the time budget, on the training part."""
    df, feats = _training_frame(spark, sf)
    train, test = ML.train_test_split(df, key="key", test_fraction=0.2)
    return search_within(train, features=feats, target=TARGET, key="key", budget_s=budget_s), test


@register("train_regressor")
def q_train_regressor(spark, sf):
    """Model search over the regressor families (linear, random forest, boosted
    trees) within a time budget; one row per trial with its share of the training
    rows and held-out MAE, the leader flagged."""
    found, _ = _search(spark, sf)
    best = found.leader
    return spark.createDataFrame(
        [(t.candidate.family, str(dict(t.candidate.params)), t.share, t.mae, t is best)
         for t in found.trials],
        "family string, params string, one_in int, validation_mae double, leader boolean")


@register("score")
def q_score(spark, sf):
    model, test, _ = _train(spark, sf)
    return ML.score(model, test, keep=["key", "ticker", TARGET])


@register("train_and_backtest")
def q_train_and_backtest(spark, sf):
    """stored target -> drop -> features -> split -> budgeted search over all families ->
    score -> rows predicted negative -> back-test + MAE -> store the model as the leader."""
    found, test = _search(spark, sf)
    _models(spark, sf).save(found.model)
    pred = stored(ML.score(found.model, test, keep=["key", "ticker", TARGET]).withColumnRenamed(
        TARGET, "label").where(F.col("prediction") < 0))
    bt = ML.backtest_shorts(pred, threshold=THRESHOLD)
    mae = ML.mae_negative(pred)
    # both metrics are one-row aggregates: attach MAE as scalar subqueries
    return bt.select("*", mae.select("mae").scalar().alias("mae"),
                     mae.select("n_negative").scalar().alias("n_negative"))


@register("model_store")
def q_model_store(spark, sf):
    """Store the fitted pipeline as a version, load the leader back, score with the loaded
    copy; rows carry the version (1 in a store of its own)."""
    model, test, _ = _train(spark, sf)
    store = ModelStore(spark, scratch_path(spark, f"models-{uuid.uuid4().hex}"))
    store.save(model)
    loaded, version = store.load()
    return ML.score(loaded, test, keep=["key"]).withColumn("model_version", F.lit(version))


def scoring_inputs(spark, sf):
    """(model, version, rows): the leader (trained if there is none yet) and the cleaned
    stored inference rows, their shares valued in USD as in training."""
    models = _models(spark, sf)
    if models.leader() is None:
        models.save(_search(spark, sf)[0].model)
    rows = stored_bir4(spark, sf)
    usd = {"tx_value": "shares", "remaining_value": "remaining_shares",
           "direct_holding": "direct_holding", "indirect_holding": "indirect_holding"}
    n = rows.count()
    parts = number_of_parts(n)
    with partitions_for(spark, -(-n // parts)):     # equal rows have one key, so one part
        cleaned = stored(C.drop_if_present(C.dropna_any(C.dedup_exact(
            rows.where(in_part(F.col("key"), i, parts)))).withColumns(
            {dst: F.col(src) * F.col("price") for dst, src in usd.items()}), DROPPED)
            for i in range(parts))
    return *models.load(), cleaned


@register("score_and_order")
def q_score_and_order(spark, sf):
    """Load the leader, score the stored inference rows, check alignment, emit order
    intents."""
    model, version, rows = scoring_inputs(spark, sf)
    scored = stored(ML.score(model, rows).withColumn("model_version", F.lit(version)))
    # what feeds the orders, minus its prediction, must equal the input (multiset
    # fingerprint: two aggregates instead of two full-row shuffles)
    if not C.same_rows(scored.drop("prediction", "model_version"), rows):
        raise AssertionError("scored rows do not match the input rows")
    return ML.order_intents(scored, threshold=THRESHOLD)


@register("train_classifier")
def q_train_classifier(spark, sf):
    """Fitted on the training part, applied to the other."""
    df, feats = _training_frame(spark, sf)
    train, test = ML.train_test_split(df, key="key", test_fraction=0.2)
    model = ML.classify_sign(train, features=feats, target=TARGET)
    return model.transform(ML.binary_flags(test, feats)).select("key", "prediction")


@register("encode_categories", with_ctes(
    "select key, (dense_rank() over (order by coding) - 1)::double as coding_idx, "
    "(dense_rank() over (order by owner_code) - 1)::double as owner_code_idx from rt4", **RT4))
def q_encode_categories(spark, sf):
    """Dictionary encoding of low-cardinality strings for the model: the
    alphabetical level index (Parquet already dictionary-encodes on write)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    with _partitions(spark, sf):     # stored: each column's levels are a pass over the rows
        df = stored(rt4(spark, sf).select("key", "coding", "owner_code"))
    model = Pipeline(stages=[StringIndexer(inputCol=c, outputCol=f"{c}_idx",
                                           stringOrderType="alphabetAsc")
                             for c in ("coding", "owner_code")]).fit(df)
    return model.transform(df).select("key", "coding_idx", "owner_code_idx")


@register("train_regressor_ols", with_ctes(
    "select round(regr_slope(pct_change, avg_target_expanding), 6) as slope, "
    "round(regr_intercept(pct_change, avg_target_expanding), 6) as intercept, "
    "count(*) as n from rt4", **RT4))
def q_train_regressor_ols(spark, sf):
    """One-feature least squares fitted by Spark ML (normal equations, no
    regularisation, no scaling) — the checkable core of the model search."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    with _partitions(spark, sf):     # stored: the fit takes several passes over the rows
        df = stored(rt4(spark, sf).select(TARGET, "avg_target_expanding"))
    va = VectorAssembler(inputCols=["avg_target_expanding"], outputCol="features")
    lr = LinearRegression(labelCol=TARGET, featuresCol="features", solver="normal",
                          regParam=0.0, standardization=False).fit(va.transform(df))
    stats = df.agg(F.count(F.lit(1)).alias("n"))
    return stats.select(F.round(F.lit(float(lr.coefficients[0])), 6).alias("slope"),
                        F.round(F.lit(float(lr.intercept)), 6).alias("intercept"), "n")


@register("src_csv_fallback", with_ctes(
    "select key, ticker, price, avg_target_expanding from rt4", **RT4))
def q_src_csv_fallback(spark, sf):
    """Scoring rows exported to CSV in the shared folder and loaded back with
    an explicit schema (the store-less path of the scoring job)."""
    from ..sources.dimensions import read_scoring_csv
    path = scratch_path(spark, f"scoring-csv-{uuid.uuid4().hex[:12]}")
    rows = rt4(spark, sf).select("key", "ticker", "price", "avg_target_expanding")
    rows.write.mode("overwrite").option("header", True).csv(path)
    return read_scoring_csv(spark, path, "key string, ticker string, price double, "
                                         "avg_target_expanding double")


@register("backtest_shorts_by_ticker", with_ctes(
    "select ticker, coalesce(sum(pct_change::decimal(20,8)) filter (where avg_target_expanding "
    "<= 0), 0)::double * -100.0 as gains, (100.0 * (count(*) filter (where avg_target_expanding "
    "<= 0) + 1))::double as capital, count(*) filter (where avg_target_expanding <= 0) "
    "as n_positions from rt4 group by ticker", **RT4))
def q_backtest_shorts_by_ticker(spark, sf):
    """The back-test rule per ticker (same conditional aggregate, grouped)."""
    return ML.backtest_shorts(_prior(spark, sf), investment=100.0, threshold=THRESHOLD,
                              by=["ticker"])
