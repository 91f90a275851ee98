"""Drift report (R2): the latest ``current`` rows against the ``reference`` rows before them.

The two windows (500 and 1000 rows by default) are taken with one distributed top-k by time
(``TakeOrderedAndProject``) — never a global window over the raw table — and everything after
runs on those 1500 rows.

* categorical column: Jensen-Shannon distance (base 2, in [0, 1]) of the two frequency tables;
* numeric column: Wasserstein-1 distance of the two empirical distributions divided by the
  reference range (0 when the reference range is 0);
* ``drift`` = distance > threshold.

On a stream (``stream_drift``) the latest rows are a small state table with one version per micro-batch: a batch joins
the version before it with its own latest rows and writes its version and its report under its number.  A batch that
is run again after a failure reads the same version and overwrites its own, so nothing is lost or counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drift_windows(df: DataFrame, ts_col: str, id_col: str, reference: int = 1000, current: int = 500) -> DataFrame:
    """The latest ``reference + current`` rows tagged ``side`` = current / reference."""
    top = df.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).limit(reference + current)
    w = Window.orderBy(F.col(ts_col).desc(), F.col(id_col).desc())  # over 1500 rows only
    return (top.withColumn("_rn", F.row_number().over(w))
            .withColumn("side", F.when(F.col("_rn") <= current, "current").otherwise("reference")).drop("_rn"))


def js_distance(tagged: DataFrame, col: str) -> DataFrame:
    freq = tagged.groupBy(col).agg(
        F.count_if(F.col("side") == "reference").alias("r"), F.count_if(F.col("side") == "current").alias("c"))
    tot = Window.partitionBy()
    p = F.col("r") / F.sum("r").over(tot)
    q = F.col("c") / F.sum("c").over(tot)
    probs = freq.select(p.alias("p"), q.alias("q")).withColumn("m", (F.col("p") + F.col("q")) / 2)

    def kl(a):
        return F.when(F.col(a) > 0, F.col(a) * F.log2(F.col(a) / F.col("m"))).otherwise(F.lit(0.0))

    js = probs.agg((F.sum(kl("p")) / 2 + F.sum(kl("q")) / 2).alias("js"))
    return js.select(F.lit(col).alias("feature"), F.lit("categorical").alias("kind"),
                     F.sqrt(F.greatest(F.col("js"), F.lit(0.0))).alias("distance"))


def wasserstein(tagged: DataFrame, col: str) -> DataFrame:
    vals = tagged.where(F.col(col).isNotNull())
    n = vals.groupBy("side").count()
    n_ref = n.where(F.col("side") == "reference").select("count").scalar()
    n_cur = n.where(F.col("side") == "current").select("count").scalar()
    steps = vals.select(F.col(col).cast("double").alias("x"),
                        F.when(F.col("side") == "reference", F.lit(1.0) / n_ref)
                        .otherwise(F.lit(-1.0) / n_cur).alias("dw"))
    pts = steps.groupBy("x").agg(F.sum("dw").alias("dw"))
    w = Window.orderBy("x")  # over at most 1500 distinct values
    cdf = (pts.withColumn("diff", F.sum("dw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("gap", F.lead("x").over(w) - F.col("x")))
    r = vals.where(F.col("side") == "reference").agg(
        (F.max(F.col(col)) - F.min(F.col(col))).cast("double").alias("r")).scalar()
    w1 = cdf.agg(F.sum(F.abs(F.col("diff")) * F.coalesce(F.col("gap"), F.lit(0.0))).alias("w1"))
    return w1.select(F.lit(col).alias("feature"), F.lit("numeric").alias("kind"),
                     F.when(r > 0, F.col("w1") / r).otherwise(F.lit(0.0)).alias("distance"))


def _report(tagged: DataFrame, categorical, numeric, threshold: float, digits: int) -> DataFrame:
    parts = [js_distance(tagged, c) for c in categorical] + [wasserstein(tagged, c) for c in numeric]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("feature", "kind", F.round("distance", digits).alias("distance"),
                      F.lit(float(threshold)).alias("threshold"), (F.col("distance") > threshold).alias("drift"))


def drift_report(df: DataFrame, ts_col: str, id_col: str, categorical=(), numeric=(), reference: int = 1000,
                 current: int = 500, threshold: float = 0.1, digits: int = 9) -> DataFrame:
    tagged = drift_windows(df.select(ts_col, id_col, *dict.fromkeys([*categorical, *numeric])), ts_col, id_col,
                           reference, current)
    # At most reference + current narrow rows: taken once, reused by every feature.
    tagged = df.sparkSession.createDataFrame(tagged.collect(), tagged.schema)
    return _report(tagged, categorical, numeric, threshold, digits)


def _versions(spark, path: str) -> list[int]:
    """Numbers of the versions under a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and
                  fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def _drop_version(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stream_drift(source: DataFrame, state_path: str, report_path: str, checkpoint: str, ts_col: str, id_col: str,
                 categorical=(), numeric=(), reference: int = 1000, current: int = 500, threshold: float = 0.1,
                 digits: int = 9) -> str:
    """R2 on a stream: after each micro-batch, the report over the latest rows of all that has arrived, written to
    ``report_path/v=<batch>``; the last is what ``drift_report`` gives for the same rows.

    Rows may arrive in any order: the state holds the ``reference + current`` latest by ``(ts, id)``.  No report is
    written before there is a row to compare with.  Runs until all that is available is processed; a restart with the
    same paths goes on from there."""
    cols = list(dict.fromkeys([ts_col, id_col, *categorical, *numeric]))

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        earlier = [v for v in _versions(spark, state_path) if v < number]
        latest = rows.select(*cols)
        if earlier:
            latest = latest.unionByName(spark.read.schema(latest.schema).parquet(f"{state_path}/v={earlier[-1]}"))
        latest = latest.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).limit(reference + current)
        latest.write.mode("overwrite").parquet(f"{state_path}/v={number}")
        kept = spark.read.schema(latest.schema).parquet(f"{state_path}/v={number}")
        tagged = drift_windows(kept, ts_col, id_col, reference, current)
        tagged = spark.createDataFrame(tagged.collect(), tagged.schema)  # reference + current narrow rows at most
        if tagged.where(F.col("side") == "reference").limit(1).count():
            report = _report(tagged, categorical, numeric, threshold, digits)
            report.coalesce(1).write.mode("overwrite").parquet(f"{report_path}/v={number}")
        for v in earlier[:-1]:  # the version before this one stays until this batch is committed
            _drop_version(spark, f"{state_path}/v={v}")

    query = (source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return report_path


def latest_report(spark, report_path: str) -> DataFrame:
    versions = _versions(spark, report_path)
    if not versions:
        raise LookupError(f"no drift report in {report_path}")
    return spark.read.parquet(f"{report_path}/v={versions[-1]}")
