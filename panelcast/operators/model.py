"""Boosted-tree training on a panel: fits, staged errors, search, folds, importances.

One MLlib ``GBTRegressor`` is fitted on the whole panel (all series at once), so
the work grows with the data instead of with a loop over series. The rows of a fit
are turned into vectors once, dealt over as many partitions as their measured
bytes need and stored, in a fixed order, so that a fit does not depend on how its
input was dealt. Fits that are independent of each other (search trials,
walk-forward folds) are submitted as concurrent Spark jobs from a driver thread pool,
as many at once as keep the cores busy; only model parameters, scores and column names
come back to the driver.
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.operators.stats import MAPE_EPS
from panelcast.session import cut_lineage, scratch_path

FEATURES_VEC = "features_vec"


@dataclass
class TreeParams:
    max_iter: int = 200
    max_depth: int = 3
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.7"
    min_instances: int = 3
    min_info_gain: float = 0.0

    @classmethod
    def from_search_names(cls, params: dict) -> TreeParams:
        """Parameters under the names of the reference's search space. Names without an
        exact counterpart in MLlib's trees are refused, not dropped."""
        refused = sorted(set(params) & set(NO_COUNTERPART))
        unknown = sorted(set(params) - set(COUNTERPART) - set(NO_COUNTERPART))
        if refused or unknown:
            raise ValueError("; ".join([f"{n}: {NO_COUNTERPART[n]}" for n in refused] + [f"{n}: unknown parameter" for n in unknown]))
        own = {COUNTERPART[n]: v for n, v in params.items()}
        if "feature_subset" in own:
            own["feature_subset"] = str(own["feature_subset"])
        return cls(**own)

    def estimator(self, label: str, weight: str | None, seed: int = 0) -> GBTRegressor:
        extra = {"weightCol": weight} if weight else {}
        return GBTRegressor(featuresCol=FEATURES_VEC, labelCol=label, predictionCol="y_pred",
                            maxIter=self.max_iter, maxDepth=self.max_depth, stepSize=self.step_size,
                            subsamplingRate=self.subsampling_rate,
                            featureSubsetStrategy=self.feature_subset,
                            minInstancesPerNode=self.min_instances, minInfoGain=self.min_info_gain,
                            seed=seed, **extra)


#: Names of the reference's search space and the fields that stand for them.
COUNTERPART = {"n_estimators": "max_iter", "max_depth": "max_depth", "learning_rate": "step_size",
               "subsample": "subsampling_rate", "colsample_bytree": "feature_subset",
               "min_child_weight": "min_instances", "gamma": "min_info_gain"}
NO_COUNTERPART = {"reg_alpha": "leaf values of MLlib trees are plain means, an L1 penalty has no counterpart",
                  "reg_lambda": "leaf values of MLlib trees are plain means, an L2 penalty has no counterpart"}
#: Rounds without a better validation error after which boosting counts as stopped.
PATIENCE = 20
#: A fit's rows are dealt in partitions of about this many bytes of vectors.
FIT_BYTES = 64 << 20
#: Small fits to submit together at most: with more, the driver frees the broadcasts of ended
#: stages more slowly than new ones come, and every later job takes longer.
MOST_FITS = 8


@dataclass
class SearchSpace:
    """Ranges of the random search (the reference's boosted-tree space on MLlib knobs)."""
    max_iter: tuple[int, int] = (50, 600)
    max_depth: tuple[int, int] = (2, 5)
    step_size: tuple[float, float] = (0.005, 0.1)      # log-uniform
    subsampling_rate: tuple[float, float] = (0.5, 0.9)
    feature_subset: tuple[float, float] = (0.5, 0.9)
    min_instances: tuple[int, int] = (3, 15)
    min_info_gain: tuple[float, float] = (1e-4, 5.0)    # log-uniform

    def sample(self, rng: random.Random) -> TreeParams:
        def logu(lo, hi):
            return math.exp(rng.uniform(math.log(lo), math.log(hi)))
        return TreeParams(
            max_iter=rng.randint(*self.max_iter), max_depth=rng.randint(*self.max_depth),
            step_size=logu(*self.step_size), subsampling_rate=rng.uniform(*self.subsampling_rate),
            feature_subset=f"{rng.uniform(*self.feature_subset):.3f}",
            min_instances=rng.randint(*self.min_instances), min_info_gain=logu(*self.min_info_gain))


@dataclass
class TrainSpec:
    feature_cols: list[str]
    label: str = "demand"
    keys: list[str] = field(default_factory=lambda: ["series"])
    date: str = "date"
    weight: str = "weight"
    lam: float = 0.95


def fit_rows(df: DataFrame, spec: TrainSpec, *more: str) -> DataFrame:
    """Vectors, label and weights for fits, stored: (keys, date, label, vector, ``more``).

    Partitions follow from the measured number of rows, and rows are in key and date
    order, so that the same rows give the same fit however they came."""
    order = [*spec.keys, spec.date, *[c for c in more if c == "fold"]]
    rows = _assembler(spec).transform(df).select(*spec.keys, spec.date, spec.label, FEATURES_VEC, *more)
    parts = max(1, math.ceil(df.count() * 8 * (len(spec.feature_cols) + len(more) + 2) / FIT_BYTES))
    return cut_lineage(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order))


def fits_at_once(rows: DataFrame) -> int:
    """Independent fits on ``rows`` (of ``fit_rows``) to submit together.

    A fit has as many tasks at a time as its rows have partitions, and on a small panel
    its jobs mostly wait for the scheduler: two tasks for each core, four fits at least
    and ``MOST_FITS`` at most, however many cores there are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return min(MOST_FITS, max(4, math.ceil(2 * cores / max(1, rows.rdd.getNumPartitions()))))


def _assembler(spec: TrainSpec) -> VectorAssembler:
    return VectorAssembler(inputCols=spec.feature_cols, outputCol=FEATURES_VEC, handleInvalid="keep")


def fit_boosted_trees(train: DataFrame, spec: TrainSpec, params: TreeParams, seed: int = 0) -> PipelineModel:
    """The fitted trees behind an assembler of the feature columns. ``train`` holds feature
    columns, or is what ``fit_rows`` gives."""
    rows = train if FEATURES_VEC in train.columns else fit_rows(train, spec, *([spec.weight] if spec.weight else []))
    return PipelineModel([_assembler(spec), params.estimator(spec.label, spec.weight, seed).fit(rows)])


def trees_used(model: PipelineModel) -> int:
    return len(model.stages[-1].trees)


def staged_errors(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean squared error of every prefix of the trees, in one pass over ``rows`` (of ``fit_rows``).

    With a weight column in the model's settings the mean is weighted by it."""
    return [float(e) for e in model.stages[-1].evaluateEachIteration(rows, "squared")]


def stopping_round(errors: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(trees to use, has it stopped): boosting stops ``patience`` rounds after its best
    error so far, and the trees up to that best one count."""
    best, at = math.inf, 0
    for i, e in enumerate(errors, 1):
        if e < best:
            best, at = e, i
        elif i - at >= patience:
            return max(at, 1), True
    return max(at, 1), False


def fit_lengths(most: int, patience: int) -> list[int]:
    """Rounds of a trial's fits, one after the other until it stops: four patiences, then
    double as many each time, ``most`` as soon as the next would come near it."""
    out, n = [], max(1, 4 * patience)
    while n < 0.75 * most:
        out.append(n)
        n *= 2
    return [*out, most]


def hyperparameter_search(df: DataFrame, spec: TrainSpec, space: SearchSpace, n_trials: int,
                          split: str = "split", seed: int = 0, parallel: int | None = None,
                          callback=None, patience: int = PATIENCE) -> tuple[DataFrame, TreeParams]:
    """Seeded random search; each trial fits on train, and the staged error on val says
    where ``patience`` rounds bring no gain: ``trees_used`` trees count, with their error.

    A trial is fitted with few rounds first (``fit_lengths``), and with more only if it
    hasn't stopped by then; the first rounds of a longer fit are the same. ``parallel``
    trials (``fits_at_once`` by default) run at a time, those with the deepest trees first.
    Returns the trial table (with the running best) and the best parameters, with
    ``max_iter`` set to the trees used."""
    spark = df.sparkSession
    rng = random.Random(seed)
    trials = [space.sample(rng) for _ in range(n_trials)]
    tv = df.filter(F.col(split).isin("train", "val"))
    tv = tv.withColumn(spec.weight, F.when(F.col(split) == "val", F.lit(1.0)).otherwise(F.col(spec.weight)))
    rows = fit_rows(tv, spec, spec.weight, split)
    train, val = (rows.filter(F.col(split) == s) for s in ("train", "val"))

    def run(i_p):
        i, p = i_p
        for rounds in fit_lengths(p.max_iter, patience):
            m = fit_boosted_trees(train, spec, replace(p, max_iter=rounds), seed)
            errors = staged_errors(m, val)
            used, stopped = stopping_round(errors, patience)
            if stopped:
                break
        if callback:
            callback(i, p, errors[used - 1])
        return i, p, errors[used - 1], used

    longest_first = sorted(enumerate(trials), key=lambda t: (-t[1].max_depth, -t[1].max_iter))
    with ThreadPoolExecutor(max_workers=max(1, parallel or fits_at_once(train))) as ex:
        results = sorted(ex.map(run, longest_first), key=lambda r: r[0])
    table = spark.createDataFrame([(i, json.dumps(asdict(p)), s, u) for i, p, s, u in results],
                                  "trial int, params string, val_mse double, trees_used int")
    w = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = table.withColumn("best_so_far", F.min("val_mse").over(w))
    _, best, _, used = min(results, key=lambda r: (r[2], r[0]))
    return table, replace(best, max_iter=used)


def walk_forward_cv(folds: DataFrame, spec: TrainSpec, params: TreeParams, seed: int = 0,
                    parallel: int | None = None) -> DataFrame:
    """One fit per fold on its 'train' rows (weights on the full trainval scale),
    MAPE on its 'test' rows; ``parallel`` fits (``fits_at_once`` by default) run as
    concurrent jobs. Output (fold, mape).

    Series that were rejected for the folds (NULL fold) take no part."""
    spark = folds.sparkSession
    rows = fit_rows(folds.filter(F.col("fold").isNotNull()), spec, spec.weight, "fold", "role")
    ids = sorted(r["fold"] for r in rows.select("fold").distinct().collect())

    def run(k):
        f = rows.filter(F.col("fold") == k)
        m = fit_boosted_trees(f.filter(F.col("role") == "train"), spec, params, seed).stages[-1]
        pred = m.transform(f.filter(F.col("role") == "test"))
        y = F.col(spec.label)
        mape = pred.agg(F.avg(F.abs(y - F.col("y_pred")) / F.greatest(F.abs(y), F.lit(MAPE_EPS)))).collect()[0][0]
        return k, float(mape)

    with ThreadPoolExecutor(max_workers=max(1, parallel or fits_at_once(rows))) as ex:
        res = list(ex.map(run, ids))
    return spark.createDataFrame(res, "fold int, mape double")


# ------------------------------------------------------------------ trees as a table

def tree_nodes(model: PipelineModel) -> DataFrame:
    """Node table of the fitted trees: (tree, node, feature, threshold, left, right, value,
    weight). A leaf has a NULL feature; a split sends values up to its threshold left.

    Read from the model as MLlib stores it, in the shared folder."""
    spark, gbt = SparkSession.active(), model.stages[-1]
    path = scratch_path(spark, "trees")
    gbt.save(path)
    weights = spark.createDataFrame([(t, float(w)) for t, w in enumerate(gbt.treeWeights)], "tree int, weight double")
    n = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    numeric = F.when(F.col("split.numCategories") == -1, F.get("split.leftCategoriesOrThreshold", F.lit(0))).otherwise(
        F.raise_error(F.lit("a split by category has no threshold")).cast("double"))
    return n.select("tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
                    F.when(inner, numeric).alias("threshold"), F.when(inner, F.col("leftChild")).alias("left"),
                    F.when(inner, F.col("rightChild")).alias("right"), F.col("prediction").alias("value")).join(F.broadcast(weights), "tree")


def score_by_expression(df: DataFrame, nodes: DataFrame, feature_cols: list[str], out: str = "y_pred") -> DataFrame:
    """Predictions of the node table as one compiled column expression: nested conditions
    over the feature columns, one term for each tree."""
    by_tree: dict[int, dict[int, tuple]] = {}
    for r in nodes.collect():
        by_tree.setdefault(r["tree"], {})[r["node"]] = r

    def term(tree: dict, at: int) -> str:
        n = tree[at]
        if n["feature"] is None:
            return repr(n["value"] * n["weight"]) + "D"
        return (f"if(`{feature_cols[n['feature']]}` <= {n['threshold']!r}D, "
                f"{term(tree, n['left'])}, {term(tree, n['right'])})")

    terms = [term(by_tree[t], 0) for t in sorted(by_tree)]
    return df.withColumn(out, F.aggregate(F.array(*[F.expr(t) for t in terms]), F.lit(0.0), lambda a, v: a + v))


def score_by_join(df: DataFrame, nodes: DataFrame, feature_cols: list[str], row_keys: list[str], out: str = "y_pred") -> DataFrame:
    """The same predictions relationally: each row stands at the root of every tree and is
    joined with its node once for each level; (row_keys, out)."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in feature_cols])
    n_trees = nodes.agg(F.max("tree")).first()[0] + 1
    at = df.select(*row_keys, values.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"), F.lit(0).alias("node"))
    small = F.broadcast(nodes)                   # bounded by the trees and their depth
    for _ in range(_depth(nodes)):
        here = at.join(small, ["tree", "node"])
        go = F.when(F.element_at("_x", F.col("feature") + 1) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.select(*row_keys, "_x", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(go).alias("node"))
    leaves = at.join(small, ["tree", "node"])
    return leaves.groupBy(*row_keys).agg(F.sum(F.col("value") * F.col("weight")).alias(out))


def _depth(nodes: DataFrame) -> int:
    """Levels of splits of the deepest tree."""
    child = {}
    for r in nodes.filter("feature is not null").select("tree", "node", "left", "right").collect():
        child[r["tree"], r["node"]] = (r["left"], r["right"])
    level, depth = [(t, n) for t, n in child if n == 0], 0
    while level:
        depth += 1
        level = [(t, c) for t, n in level for c in child[t, n] if (t, c) in child]
    return depth


def feature_importance(model: PipelineModel, feature_cols: list[str], spark: SparkSession) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(feature_cols, [float(v) for v in imp])),
                                 "feature string, importance double")


def permutation_importance(model: PipelineModel, val: DataFrame, spec: TrainSpec, repeats: int,
                           protected: list[str] | None = None, seed: int = 0) -> tuple[DataFrame, list[str]]:
    """Mean/std MAPE increase when one feature is shuffled, per feature.

    All (feature, repeat) copies of the validation rows are built as one
    DataFrame: the shuffled value is the value of the row with the same rank in
    an ``xxhash64(row, feature, repeat)`` order, within the same series, and
    the model scores every copy in a single ``transform``. The increase is taken
    row by row, so that a shuffle that changes no prediction costs exactly 0 in
    whatever order rows are added up. Features with mean > 0 are kept; protected
    features are put first."""
    feats = list(spec.feature_cols)
    keys = spec.keys
    rid_w = Window.partitionBy(*keys).orderBy(spec.date)
    y = F.col(spec.label)
    ape = F.abs(y - F.col("y_pred")) / F.greatest(F.abs(y), F.lit(MAPE_EPS))
    base = model.transform(val.withColumn("_rid", F.row_number().over(rid_w)))
    base = base.withColumn("_base", ape).drop(FEATURES_VEC, "y_pred")
    # F x R copies of each validation row (a fixed factor, made by two explodes)
    copies = base.withColumn("_feat", F.explode(F.lit(feats))) \
                 .withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    # donor row: same rank in a hash order of (row, feature, repeat), within the series
    order = Window.partitionBy(*keys, "_feat", "_rep").orderBy(
        F.xxhash64("_rid", "_feat", "_rep", F.lit(seed)), "_rid")
    copies = copies.withColumn("_donor", F.row_number().over(order))
    long = base.select(*keys, "_rid", F.explode(F.map_from_arrays(
        F.lit(feats), F.array(*[F.col(c).cast("double") for c in feats]))).alias("_feat", "_val"))
    donors = long.withColumnRenamed("_rid", "_donor").withColumnRenamed("_val", "_perm")
    copies = copies.join(donors, [*keys, "_donor", "_feat"], "left")
    copies = copies.withColumns({c: F.when(F.col("_feat") == F.lit(c), F.col("_perm")).otherwise(F.col(c))
                                 for c in feats})
    perm = model.transform(copies).groupBy("_feat", "_rep").agg(F.avg(ape - F.col("_base")).alias("increase"))
    imp = perm.groupBy(F.col("_feat").alias("feature")).agg(
        F.avg("increase").alias("importance_mean"), F.stddev_pop("increase").alias("importance_std"))
    named = F.array(*[F.lit(f) for f in protected or []]).cast("array<string>")
    useful, score = F.col("importance_mean") > 0, F.col("importance_mean")
    place = F.nullif(F.array_position(named, F.col("feature")), F.lit(0))
    ranked = imp.select("feature", useful.alias("useful"), score.alias("score"),
                        F.when(~useful, place).alias("place"))
    # protected features that would go are kept in the order they are named, then the useful ones by score
    chosen = ranked.filter(F.col("useful") | F.col("place").isNotNull()).orderBy(
        F.col("place").asc_nulls_last(), F.col("score").desc(), "feature")
    return imp, [r["feature"] for r in chosen.collect()]
