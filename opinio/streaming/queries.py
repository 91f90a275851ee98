"""Streaming and drift queries registered into the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinio.plans.catalog import query, table
from opinio.session import scratch_path
from opinio.streaming.drift import drift_report, latest_report, stream_drift
from opinio.streaming.stream import event_windows, read_table_stream, run_available, stream_score

_TS = "%Y-%m-%d %H:%M:%S"


@query("event_windows",
       "WITH e AS (SELECT date_trunc('day', ts) AS ws, event_type, value, ts FROM events), "
       "m AS (SELECT max(ts) - INTERVAL 1 hour AS wm FROM events) "
       f"SELECT strftime(ws, '{_TS}') AS window_start, strftime(ws + INTERVAL 1 day, '{_TS}') AS window_end, "
       "event_type, count(*) AS events, round(sum(value), 6) AS value_sum FROM e GROUP BY ws, event_type "
       "HAVING ws + INTERVAL 1 day <= (SELECT wm FROM m)")
def q_event_windows(spark, sf_dir):
    """Structured Streaming over ``events``: daily tumbling windows per event type with a one-hour
    watermark, append mode, run to completion with ``availableNow``; the sink is read back.  Windows
    still open under the final watermark are (correctly) not emitted."""
    src = read_table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    out = run_available(event_windows(src), scratch_path(spark, "windows"), scratch_path(spark, "windows-ckpt"))
    res = spark.read.parquet(out)
    return res.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                      "event_type", "events", F.round("value_sum", 6).alias("value_sum"))


_DRIFT_SQL = (
    "WITH top AS (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rn FROM events QUALIFY rn <= 1500), "
    "t AS (SELECT *, CASE WHEN rn <= 500 THEN 'current' ELSE 'reference' END AS side FROM top), "
    "f AS (SELECT event_type, count(*) FILTER (WHERE side = 'reference') AS r, "
    "count(*) FILTER (WHERE side = 'current') AS c FROM t GROUP BY event_type), "
    "pq AS (SELECT r / sum(r) OVER () AS p, c / sum(c) OVER () AS q FROM f), "
    "pm AS (SELECT p, q, (p + q) / 2 AS m FROM pq), "
    "js AS (SELECT sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END) / 2 + "
    "sum(CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2, 0)) AS d FROM pm), "
    "n AS (SELECT count(*) FILTER (WHERE side = 'reference') AS nr, count(*) FILTER (WHERE side = 'current') AS nc "
    "FROM t WHERE value IS NOT NULL), "
    "st AS (SELECT CAST(value AS DOUBLE) AS x, sum(CASE WHEN side = 'reference' THEN 1.0 / (SELECT nr FROM n) "
    "ELSE -1.0 / (SELECT nc FROM n) END) AS dw FROM t WHERE value IS NOT NULL GROUP BY 1), "
    "cdf AS (SELECT x, sum(dw) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS diff, "
    "lead(x) OVER (ORDER BY x) - x AS gap FROM st), "
    "w AS (SELECT sum(abs(diff) * coalesce(gap, 0)) AS w1 FROM cdf), "
    "rg AS (SELECT CAST(max(value) - min(value) AS DOUBLE) AS r FROM t WHERE side = 'reference' AND value IS NOT NULL), "
    "nd AS (SELECT CASE WHEN r > 0 THEN w1 / r ELSE 0.0 END AS d FROM w, rg) "
    "SELECT 'event_type' AS feature, 'categorical' AS kind, round(d, 9) AS distance, CAST(0.1 AS DOUBLE) AS threshold, "
    "d > 0.1 AS drift FROM js UNION ALL "
    "SELECT 'value', 'numeric', round(d, 9), CAST(0.1 AS DOUBLE), d > 0.1 FROM nd"
)


@query("drift_report", _DRIFT_SQL)
def q_drift_report(spark, sf_dir):
    """R2 on ``events``: latest 500 rows against the 1000 before them (configured sizes and 0.1
    threshold); event-type mix by Jensen-Shannon distance, ``value`` by normalised Wasserstein."""
    events = table(spark, sf_dir, "events")
    return drift_report(events, "ts", "event_id", categorical=("event_type",), numeric=("value",),
                        reference=1000, current=500, threshold=0.1)


@query("drift_stream", _DRIFT_SQL)
def q_drift_stream(spark, sf_dir):
    """R2 on ``events`` as a stream with its state kept between micro-batches; the report after the last."""
    src = read_table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    root = scratch_path(spark, "drift")
    reports = stream_drift(src, f"{root}/state", f"{root}/reports", f"{root}/checkpoint", "ts", "event_id",
                           categorical=("event_type",), numeric=("value",), reference=1000, current=500, threshold=0.1)
    return latest_report(spark, reports)


@query("stream_scores")
def q_stream_scores(spark, sf_dir):
    """Documents arriving as a file stream, scored by the flagship model, written with a
    checkpoint and read back (every document, empty-after-cleaning ones included)."""
    from opinio.plans.ml_queries import _scoring_model

    model = _scoring_model(spark, sf_dir)
    src = read_table_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    scored = stream_score(model, src.select("doc_id", F.col("text").alias("review")))
    out = run_available(scored.drop("review", "processed_at"), scratch_path(spark, "stream-scores"),
                        scratch_path(spark, "stream-scores-ckpt"))
    return spark.read.parquet(out).select("doc_id", "prediction", "sentiment", "status")
