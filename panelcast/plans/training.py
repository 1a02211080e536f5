"""End-to-end model plans on the demand panel: selection, search, folds, final fit,
forecast, sessions.

The gold panel and the feature table are checkpointed to the shared folder
once, because selection and every fit read them again; after that each fit is
one MLlib job over the whole panel. A session is a folder of tables and one manifest
row that is written last: what has no manifest row does not exist.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.operators import features as FE
from panelcast.operators import model as MD
from panelcast.operators import stats as ST
from panelcast.operators.recursive import recursive_forecast
from panelcast.operators.splits import fold_table, temporal_split
from panelcast.plans import panels as P
from panelcast.session import cut_lineage, scratch_path

VAL_START, TEST_START = "1999-01-01", "2000-08-01"
PROTECTED = ["demand_lag_1", "demand_lag_2", "demand_ma3"]


@dataclass
class RunParams:
    """Defaults are full training budgets, which the registered queries run on; ``quick`` holds small ones for trials."""
    collinear_t: float = 0.9
    target_corr_t: float = 0.05
    lam: float = 0.95
    n_trials: int = 50
    n_folds: int = 8
    fold_size: int = 6
    horizon: int = 12
    seed: int = 0
    until: str | None = None        # leave out rows from this date on; all rows by default
    base_trees: MD.TreeParams = field(default_factory=lambda: MD.TreeParams())
    space: MD.SearchSpace = field(default_factory=MD.SearchSpace)
    repeats: int = 50               # shuffles of each feature in the permutation importance
    patience: int = MD.PATIENCE     # rounds without gain that stop a search trial

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> RunParams:
        d = json.loads(text)
        space = MD.SearchSpace(**{k: tuple(v) for k, v in d.pop("space").items()})
        return cls(**{**d, "base_trees": MD.TreeParams(**d["base_trees"]), "space": space})

    @classmethod
    def quick(cls, **changes) -> RunParams:
        """Small work budgets (2 trials, 5 to 15 trees, 5 shuffles); all rows are used all the same."""
        small = dict(n_trials=2, base_trees=MD.TreeParams(max_iter=10), space=MD.SearchSpace(max_iter=(5, 15)), repeats=5)
        return cls(**(small | changes))


FP = FE.FeatureParams()


def prepared_frame(spark: SparkSession, sf_dir: str, rp: RunParams) -> tuple[DataFrame, list[str]]:
    """master -> collinearity drop -> features -> target-corr filter -> split -> weights."""
    # the gold table is read by three steps below: materialise it once
    master = cut_lineage(P.master_panel(spark, sf_dir))
    master, _dropped = FE.drop_collinear(master, P.TARGET, rp.collinear_t, exclude=P.KEYS)
    feat = FE.feature_table(master, FP)
    feat = cut_lineage(feat.filter(F.col("date") < F.to_date(F.lit(rp.until))) if rp.until else feat)
    cands = [c for c in feat.columns if c not in P.KEYS + ["date", P.TARGET]]
    kept = FE.target_corr_table(feat, FP, TEST_START, cands).filter(F.col("corr_abs") >= rp.target_corr_t)
    feature_cols = [r["feature"] for r in kept.orderBy(F.col("corr_abs").desc(), "feature").collect()]
    return weighted(feat, feature_cols, rp), feature_cols


def weighted(feat: DataFrame, feature_cols: list[str], rp: RunParams) -> DataFrame:
    """Split labels and recency weights beside the chosen feature columns."""
    df = temporal_split(feat, VAL_START, TEST_START).select(*P.KEYS, "date", P.TARGET, "split", *feature_cols)
    w_desc = Window.partitionBy(*P.KEYS, F.col("split") == "train").orderBy(F.col("date").desc())
    w_tv = Window.partitionBy(*P.KEYS, F.col("split") != "test").orderBy(F.col("date").desc())
    lam = F.lit(rp.lam)
    return df.withColumns({
        "w_train": F.when(F.col("split") == "train", F.pow(lam, (F.row_number().over(w_desc) - 1).cast("double"))),
        "w_trainval": F.when(F.col("split") != "test", F.pow(lam, (F.row_number().over(w_tv) - 1).cast("double"))),
    })


def spec_for(feature_cols: list[str], weight: str, rp: RunParams) -> MD.TrainSpec:
    return MD.TrainSpec(feature_cols=feature_cols, label=P.TARGET, keys=P.KEYS, weight=weight, lam=rp.lam)


@dataclass
class TrainResult:
    params: RunParams
    frame: DataFrame
    feature_cols: list[str]
    best: MD.TreeParams
    trials: DataFrame | None
    model: PipelineModel | None
    predictions: DataFrame | None
    metrics: DataFrame | None
    cv: DataFrame | None
    rejected: DataFrame | None = None       # series that are too short for the folds
    importance: DataFrame | None = None     # of the selection step, where it ran


def select_by_permutation(df: DataFrame, feature_cols: list[str], rp: RunParams,
                          protected: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """The selection step of training: fit on train, shuffle each feature on val, keep those
    whose shuffling costs accuracy; protected names always stay. (importances, names kept)."""
    spec = spec_for(feature_cols, "w_train", rp)
    model = MD.fit_boosted_trees(df.filter(F.col("split") == "train"), spec, rp.base_trees, seed=rp.seed)
    named = [c for c in (PROTECTED if protected is None else protected) if c in feature_cols]
    return MD.permutation_importance(model, df.filter(F.col("split") == "val"), spec, repeats=rp.repeats,
                                     protected=named, seed=rp.seed)


def train(spark: SparkSession, sf_dir: str, rp: RunParams | None = None, with_cv: bool = True,
          with_search: bool = True, select: bool = False, with_final: bool = True) -> TrainResult:
    """Prepare, optionally select by permutation, search, cross-validate and fit the final model."""
    rp = rp or RunParams()
    df, cols = prepared_frame(spark, sf_dir, rp)
    return train_on(df, cols, rp, with_cv, with_search, select, with_final)


def train_on(df: DataFrame, cols: list[str], rp: RunParams, with_cv: bool = True, with_search: bool = True,
             select: bool = False, with_final: bool = True, protected: list[str] | None = None) -> TrainResult:
    """``train`` on a prepared frame: key, date, target, split, features and weights."""
    importance = None
    if select:
        importance, cols = select_by_permutation(df, cols, rp, protected)
        df = df.select(*P.KEYS, "date", P.TARGET, "split", *cols, "w_train", "w_trainval")
    if with_search:
        trials, best = MD.hyperparameter_search(df, spec_for(cols, "w_train", rp), rp.space, rp.n_trials,
                                                seed=rp.seed, patience=rp.patience)
    else:
        trials, best = None, rp.base_trees
    tv_spec = spec_for(cols, "w_trainval", rp)
    out = TrainResult(rp, df, cols, best, trials, None, None, None, None, importance=importance)
    if with_cv:
        folds, out.rejected = fold_table(df, rp.n_folds, rp.fold_size, P.KEYS)
        out.cv = MD.walk_forward_cv(folds, tv_spec, best, seed=rp.seed)
    if with_final:
        out.model = MD.fit_boosted_trees(df.filter(F.col("split") != "test"), tv_spec, best, seed=rp.seed)
        out.predictions = predictions_of(out.model, df)
        out.metrics = ST.regression_metrics(out.predictions, group=["split"])
    return out


def predictions_of(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).select(*P.KEYS, "date", "split", F.col(P.TARGET).alias("y_real"), "y_pred")


def forecast_from(df: DataFrame, feature_cols: list[str], best: MD.TreeParams,
                  rp: RunParams | None = None) -> DataFrame:
    """Refit on every row (weights over all rows), then forecast ``horizon`` months."""
    rp = rp or RunParams()
    w = Window.partitionBy(*P.KEYS).orderBy(F.col("date").desc())
    full = df.withColumn("w_all", F.pow(F.lit(rp.lam), (F.row_number().over(w) - 1).cast("double")))
    model = MD.fit_boosted_trees(full, spec_for(feature_cols, "w_all", rp), best, seed=rp.seed)
    return recursive_forecast(model, df, feature_cols, P.TARGET, P.KEYS, rp.horizon)


def forecast(res: TrainResult, rp: RunParams | None = None) -> DataFrame:
    return forecast_from(res.frame, res.feature_cols, res.best, rp or res.params)


# ------------------------------------------------------------------- sessions

MANIFEST = ("session_id string, run_params string, feature_params string, params string, metrics string, cv_mape array<double>, "
            "feature_cols array<string>, data_min date, data_max date, path string, created_at timestamp")
FORECASTS = "session_id string, path string, created_at timestamp"


def sessions_path(spark: SparkSession, base: str | None = None) -> str:
    return base or scratch_path(spark, "sessions")


def save_session(spark: SparkSession, res: TrainResult, base: str, forecast_df: DataFrame | None = None) -> str:
    """Model, validation rows and folds under one session id, then the manifest row with all
    parameters and metrics: a session whose writing failed half-way is never listed."""
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd_HH-mm-ss")).first()[0]
    sid = now + "_" + uuid.uuid4().hex[:6]
    path = f"{base}/{sid}"
    res.model.write().overwrite().save(f"{path}/model")
    rows = res.model.transform(res.frame).withColumnRenamed(P.TARGET, "y_real")
    rows.select(*P.KEYS, "date", "split", *res.feature_cols, "y_real", "y_pred").write.parquet(f"{path}/validation")
    metrics = {r["split"]: {k: r[k] for k in METRICS} for r in res.metrics.collect()}
    cv = [r["mape"] for r in res.cv.orderBy("fold").collect()] if res.cv is not None else []
    if forecast_df is not None:
        add_forecast(spark, base, sid, forecast_df)
    bounds = res.frame.agg(F.min("date").alias("a"), F.max("date").alias("b")).first()
    row = [(sid, res.params.to_json(), json.dumps(asdict(FP)), json.dumps(asdict(res.best)), json.dumps(metrics), cv,
            res.feature_cols, bounds["a"], bounds["b"], path)]
    manifest = spark.createDataFrame(row, MANIFEST.rsplit(",", 1)[0]).withColumn("created_at", F.current_timestamp())
    manifest.write.mode("append").parquet(f"{base}/sessions")
    return sid


METRICS = ("r2", "mse", "mae", "mape")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of a sessions folder; without rows where nothing was written yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def list_sessions(spark: SparkSession, base: str) -> DataFrame:
    """Sessions with a manifest, newest first."""
    return _table(spark, f"{base}/sessions", MANIFEST).orderBy(F.col("created_at").desc(), F.col("session_id").desc())


def _manifest(spark: SparkSession, base: str, session_id: str):
    meta = list_sessions(spark, base).filter(F.col("session_id") == session_id).first()
    if meta is None:
        raise ValueError(f"no session {session_id}")
    return meta


def load_session(spark: SparkSession, base: str, session_id: str, sf_dir: str) -> TrainResult:
    """The training result of a stored session.

    Model, parameters, metrics and folds come from the session; the feature rows are
    rebuilt from the *current* master panel with the saved parameters and columns (no
    new selection), from the first month each series had when it was saved."""
    meta = _manifest(spark, base, session_id)
    if json.loads(meta["feature_params"]) != asdict(FP):
        raise ValueError(f"session {session_id} was trained with other feature parameters: {meta['feature_params']}")
    rp, cols = RunParams.from_json(meta["run_params"]), list(meta["feature_cols"])
    first = load_validation(spark, base, session_id).groupBy(*P.KEYS).agg(F.min("date").alias("_first"))
    feat = FE.rebuild_features(P.master_panel(spark, sf_dir), FP, cols).join(first, P.KEYS, "left")
    feat = feat.filter(F.col("_first").isNull() | (F.col("date") >= F.col("_first"))).drop("_first")
    if rp.until:
        feat = feat.filter(F.col("date") < F.to_date(F.lit(rp.until)))
    df = weighted(cut_lineage(feat), cols, rp)
    model = PipelineModel.load(f"{meta['path']}/model")
    by_split = json.loads(meta["metrics"])
    metrics = spark.createDataFrame([(s, *[m[k] for k in METRICS]) for s, m in by_split.items()],
                                    "split string, " + ", ".join(f"{k} double" for k in METRICS))
    cv = spark.createDataFrame(list(enumerate(meta["cv_mape"])), "fold int, mape double")
    return TrainResult(rp, df, cols, MD.TreeParams(**json.loads(meta["params"])), None, model, predictions_of(model, df), metrics, cv)


def load_validation(spark: SparkSession, base: str, session_id: str) -> DataFrame:
    """Features, real and predicted values of every split as they were when saved."""
    return spark.read.parquet(f"{_manifest(spark, base, session_id)['path']}/validation")


def add_forecast(spark: SparkSession, base: str, session_id: str, forecast_df: DataFrame) -> str:
    """Store a forecast with a session; the newest one is the session's forecast."""
    path = f"{base}/{session_id}/forecast-{uuid.uuid4().hex[:6]}"
    forecast_df.write.parquet(path)
    row = spark.createDataFrame([(session_id, path)], "session_id string, path string")
    row.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(f"{base}/forecasts")
    return path


def load_forecast(spark: SparkSession, base: str, session_id: str) -> DataFrame | None:
    found = _table(spark, f"{base}/forecasts", FORECASTS).filter(F.col("session_id") == session_id)
    last = found.orderBy(F.col("created_at").desc()).first()
    return spark.read.parquet(last["path"]) if last else None
