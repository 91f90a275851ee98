"""Plan-shape checks: no Python evaluation in the cleaner, bounded broadcasts, and the
rows-only queries run end to end."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as e


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaner_stays_in_jvm(spark):
    plan = _plan(e.queries()["clean_reviews"](spark, SF_SMALL))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_split_window_is_partitioned(spark):
    plan = e.queries()["stratified_split"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # every window of the split is partitioned by (label, bucket)
    for line in plan.splitlines():
        if "Window [" in line and "row_number()" in line:
            assert "_bucket" in line


@pytest.mark.parametrize("name", ["tfidf", "term_counts", "term_binary"])
def test_feature_rows_are_not_shuffled(spark, name):
    """Documents are dealt out once where their file has too few partitions; no exploded term is exchanged."""
    plan = _plan(e.queries()[name](spark, SF_SMALL))
    assert "EvalPython" not in plan
    above_generate = plan[:plan.index("Generate")]
    assert "Exchange hashpartitioning" not in plan and "Exchange" not in above_generate.replace("BroadcastExchange", "")


@pytest.mark.parametrize("name", ["stream_scores", "score_file", "stem_tokens", "event_windows"])
def test_rows_only_queries_run(spark, name):
    df = e.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
