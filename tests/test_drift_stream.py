"""Drift on a stream equals the batch report after every restart, also when a batch is run twice."""

import glob
import shutil

from opinio.streaming.drift import drift_report, latest_report, stream_drift
from opinio.streaming.stream import read_table_stream

ARGS = dict(categorical=("kind",), numeric=("value",), reference=60, current=30)


def test_restart_and_repeated_batch(spark, tmp_path):
    rows = [(i * 7919 % 400, i, "abc"[i % (3 if i < 300 else 2)], float(i % 50)) for i in range(400)]
    source = str(tmp_path / "in")
    everything = spark.createDataFrame(rows, "ts long, id long, kind string, value double")
    paths = [str(tmp_path / x) for x in ("state", "reports", "checkpoint")]
    seen = 0
    for upto in (20, 150, 280, 400):
        part = everything.where(f"id >= {seen} and id < {upto}").coalesce(1 if upto == 400 else 2)
        part.write.mode("append").parquet(source)
        seen = upto
        if upto == 400:  # the last batch wrote its state and report, but was not committed
            shutil.copytree(paths[2], str(tmp_path / "before"))
            stream_drift(read_table_stream(spark, source, everything.schema, 1), *paths, "ts", "id", **ARGS)
            shutil.move(paths[2], str(tmp_path / "after"))
            shutil.copytree(str(tmp_path / "before"), paths[2])
        stream_drift(read_table_stream(spark, source, everything.schema, 1), *paths, "ts", "id", **ARGS)
        if upto == 20:  # nothing to compare with yet
            assert not glob.glob(paths[1] + "/v=*")
            continue
        want = drift_report(everything.where(f"id < {upto}"), "ts", "id", **ARGS)
        assert sorted(latest_report(spark, paths[1]).collect()) == sorted(want.collect())
    assert 1 <= len(glob.glob(paths[0] + "/v=*")) <= 3
