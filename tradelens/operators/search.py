"""Model search within a time budget, by successive halving.

All families form one pool of candidates in a fixed order. A rung fits every candidate
left on a nested share of the training rows (1/9, 1/3, all) and measures its mean
absolute error on the same held-out rows; the best third goes on. The budget is checked
before every few fits and fits that outlast it are cancelled on the cluster, so the search
ends in time with the leader found so far. Every fit counts for the leader: a longer
budget only adds fits to those of a shorter one, so it is never worse on the held-out rows.

The feature stages are fitted once and their vectors stored before the clock starts. Rows
are split by a hash of their key, which no partitioning changes. The first candidate, a
linear model on the smallest share, is always finished.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ml import FAMILIES, binary_flags, feature_stages, split_bucket

SHARES = (9, 3, 1)       # a rung's rows are one in so many
KEEP = 3                 # one in so many candidates goes on
HELD_OUT = 20            # hundredths of the rows


@dataclass(frozen=True)
class Candidate:
    family: str
    params: tuple

    def estimator(self, target: str, seed: int):
        common = {"labelCol": target, "featuresCol": "features"}
        if self.family == "linear":
            return LinearRegression(**common, **dict(self.params))
        kind = RandomForestRegressor if self.family == "forest" else GBTRegressor
        return kind(**common, seed=seed, **dict(self.params))


def candidates(families: Sequence[str] = FAMILIES) -> list[Candidate]:
    """The pool, the families in turn, cheap ones first."""
    grids = {
        "linear": [dict(regParam=r) for r in (0.0, 0.001, 0.01, 0.1, 1.0)],
        "forest": [dict(maxDepth=d, numTrees=n) for d, n in ((3, 10), (5, 20), (7, 20), (7, 40))],
        "boosted": [dict(maxDepth=d, maxIter=n) for d, n in ((2, 10), (3, 10), (3, 20), (5, 20))]}
    rows = [[Candidate(f, tuple(p.items())) for p in grids[f]] for f in families]
    return [r[i] for i in range(max(map(len, rows))) for r in rows if i < len(r)]


@dataclass
class Trial:
    candidate: Candidate
    share: int
    mae: float
    model: object
    seconds: float


@dataclass
class Search:
    model: PipelineModel
    trials: list[Trial]
    seconds: float

    @property
    def leader(self) -> Trial:
        return min(self.trials, key=lambda t: t.mae)


def search_within(train: DataFrame, *, features: Sequence[str], target: str, key: str,
                  budget_s: float, families: Sequence[str] = FAMILIES, parallelism: int = 3,
                  seed: int = 42, clock: Callable[[], float] = time.monotonic) -> Search:
    """The leader, as one pipeline from raw columns to prediction, and all trials."""
    flagged = binary_flags(train, features)
    prepared = Pipeline(stages=feature_stages(flagged, features)).fit(flagged)
    vectors = stored(prepared.transform(flagged).select(
        "features", target,
        # another hash than that of a train / test split by the same key
        split_bucket(F.concat(F.col(key).cast("string"), F.lit("|search"))).alias("bucket")))
    spark = train.sparkSession
    sc, tag = spark.sparkContext, f"search-{uuid.uuid4().hex}"
    held = vectors.where(F.col("bucket") >= 100 - HELD_OUT)
    begun = clock()
    trials: list[Trial] = []

    def trial(c: Candidate, share: int) -> Trial:
        sc.addJobTag(tag)
        at = clock()
        rows = vectors.where(F.col("bucket") < (100 - HELD_OUT) // share)
        model = c.estimator(target, seed).fit(rows)
        mae = model.transform(held).agg(
            F.avg(F.abs(F.col("prediction") - F.col(target)))).first()[0]
        return Trial(c, share, float("inf") if mae is None else float(mae), model, clock() - at)

    def fits(todo: list[Candidate], share: int) -> list[Trial]:
        """The rung's trials in order; fewer when the time runs out."""
        done: list[Trial] = []
        with ThreadPoolExecutor(parallelism) as pool:
            for low in range(0, len(todo), parallelism):
                left = budget_s - (clock() - begun)
                first = not trials and not done
                if left <= 0 and not first:
                    break
                some = [pool.submit(inheritable_thread_target(spark)(trial), c, share)
                        for c in todo[low:low + (1 if first and left <= 0 else parallelism)]]
                for i, f in enumerate(some):
                    try:
                        wait = None if first and i == 0 else max(0.0, budget_s - (clock() - begun))
                        done.append(f.result(wait))
                    except TimeoutError:
                        sc.cancelJobsWithTag(tag)
                    except Exception:
                        if clock() - begun < budget_s:
                            raise
        return done

    left = candidates(families)
    for share in SHARES:
        rung = fits(left, share)
        trials += rung
        if len(rung) < len(left) or clock() - begun >= budget_s:
            break
        left = [t.candidate for t in sorted(rung, key=lambda t: t.mae)[:-(-len(left) // KEEP)]]
    best = min(trials, key=lambda t: t.mae)
    return Search(PipelineModel(stages=[*prepared.stages, best.model]), trials, clock() - begun)
