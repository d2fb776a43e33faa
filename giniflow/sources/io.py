"""Sources and sinks: sample reads, read-through snapshots, reports, category lists, versioned run registry, model
packages, batch scoring, pool snapshots and run parameters (S1, S2, S4, S6-S12)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str):
    """File system and path object of a path, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def read_sample(spark: SparkSession, source: str, fmt: str = "parquet", long: bool = False,
                options: dict | None = None) -> DataFrame:
    """S1. ``fmt``: parquet (path), table (catalog name) or jdbc (``options`` carry url, dbtable, partitionColumn,
    lowerBound, upperBound, numPartitions so the read is split across executors). ``long`` picks the wide table
    ``<source>_long`` instead of the selected-feature table."""
    name = f"{source}_long" if long else source
    if fmt == "table":
        return spark.table(name)
    if fmt == "jdbc":
        opts = dict(options or {})
        opts.setdefault("dbtable", name)
        return spark.read.format("jdbc").options(**opts).load()
    return spark.read.options(**(options or {})).format(fmt).load(name)


def read_through(spark: SparkSession, snapshot: str, load: Callable[[], DataFrame],
                 on_first_load: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Read the parquet snapshot if it exists (one that cannot be read is an error, never overwritten); otherwise
    load the source, write the snapshot, run the first-load hook (the period report) and read the snapshot back (which
    also cuts the lineage to the source)."""
    if path_exists(spark, snapshot):
        return spark.read.parquet(snapshot)
    load().write.parquet(snapshot)
    df = spark.read.parquet(snapshot)
    if on_first_load is not None:
        on_first_load(df)
    return df


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """S4. Reports are small tables: one CSV file with a header, or parquet."""
    if fmt == "csv":
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_category_list(spark: SparkSession, path: str) -> DataFrame:
    """One category column name per line, trimmed; blank lines ignored."""
    return (spark.read.text(path).select(F.trim("value").alias("name")).where(F.col("name") != ""))


def next_version(registry: DataFrame | None, kind: str) -> int:
    """``max(version) + 1`` among registry rows of this kind, or 1 when there are none."""
    if registry is None:
        return 1
    v = registry.where(F.col("kind") == kind).agg(F.max("version")).first()[0]
    return int(v or 0) + 1


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry table, None before the first run."""
    return _registered(spark, path)


def _registered(spark: SparkSession, path: str) -> DataFrame | None:
    """The runs written so far; claims alone are no runs."""
    if not path_exists(spark, path):
        return None
    fs, p = _hadoop(spark, path)
    return spark.read.parquet(path) if any(not f.getPath().getName().startswith("_") for f in fs.listStatus(p)) else None


def claim_version(spark: SparkSession, path: str, kind: str, first: int) -> int:
    """The least free version from ``first`` on. A version is taken by creating its marker file, which only one of
    several writers can do."""
    version = first
    while True:
        fs, marker = _hadoop(spark, f"{path}/_claims/{kind}-{version}")
        if fs.createNewFile(marker):
            return version
        version += 1


def register_run(spark: SparkSession, path: str, kind: str, params: dict, metrics_rows: Sequence[tuple] = ()) -> int:
    """Append a run to the registry table (parquet, partitioned by kind): version, params JSON; returns the version."""
    version = claim_version(spark, path, kind, next_version(_registered(spark, path), kind))
    row = [(kind, version, json.dumps(params, sort_keys=True, default=str))]
    spark.createDataFrame(row, "kind string, version int, params_json string").write.mode("append") \
        .partitionBy("kind").parquet(path)
    return version


def save_model_package(spark: SparkSession, model: PipelineModel, path: str, features: Sequence[str],
                       categorical: Sequence[str], category_values: DataFrame | None = None,
                       params: dict | None = None, config: dict | None = None) -> None:
    """The fitted pipeline plus its metadata (features, categorical features, category values, parameters and the job
    configuration)."""
    model.write().overwrite().save(f"{path}/model")
    meta = {"features": list(features), "categorical": list(categorical), "params": params or {},
            "config": config or {}}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/meta")
    if category_values is not None:
        category_values.write.mode("overwrite").parquet(f"{path}/categories")


def load_model_package(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return model, meta


def publish_package(spark: SparkSession, src: str, dst: str) -> bool:
    """Copy a chosen run's whole scoring package to the deployment location. A missing run is reported (False); a
    package that cannot be read or copied is an error and leaves the deployed one in place: the copy is made beside it,
    then takes its name."""
    if not path_exists(spark, src):
        return False
    load_model_package(spark, src)          # a broken package must not replace a deployed one
    mark = uuid.uuid4().hex[:8]
    (fs_from, a), (fs_to, b) = _hadoop(spark, src), _hadoop(spark, dst)
    (_, new), (_, old) = _hadoop(spark, f"{dst}.new-{mark}"), _hadoop(spark, f"{dst}.old-{mark}")
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_from, a, fs_to, new, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"{src} could not be copied")
    load_model_package(spark, f"{dst}.new-{mark}")
    had = fs_to.exists(b)
    if had and not fs_to.rename(b, old):
        raise OSError(f"{dst} could not be set aside")
    if not fs_to.rename(new, b):
        if had:
            fs_to.rename(old, b)
        raise OSError(f"{dst} could not be replaced")
    if had:
        fs_to.delete(old, True)
    return True


def score_batch(spark: SparkSession, df: DataFrame, package: str, out: str = "score") -> DataFrame:
    """Encode with the saved pipeline and emit P(class 1). Stateless, so it also runs on a streaming frame."""
    from giniflow.operators.models import score
    model, meta = load_model_package(spark, package)
    return score(model, df, [f for f in meta["features"] if f not in meta["categorical"]], meta["categorical"], out)


def snapshot_pools(df: DataFrame, path: str, pool_col: str = "pool") -> DataFrame:
    """Materialise the pools (partitioned by pool) and read them back: later fits prune to their pool and the
    lineage to the source is cut."""
    df.write.mode("overwrite").partitionBy(pool_col).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_run_params(spark: SparkSession, base: str, pattern: str = "*/params.json") -> DataFrame:
    """Every run's JSON parameters as one row per run, with the run number parsed from the folder name."""
    df = spark.read.option("multiLine", True).json(f"{base}/{pattern}")
    return df.withColumn("__file", F.input_file_name()).withColumn(
        "run_id", F.regexp_extract("__file", r"_(\d+)/[^/]+$", 1).cast("int")).drop("__file")
