"""The registry loads without a JVM, also from the zipped PySpark that spark-submit puts on the path."""

from __future__ import annotations

import glob
import os
import subprocess
import sys

import pyspark
from pyspark.ml.feature import StopWordsRemover

from opinio.functions.stopwords import ENGLISH_STOP_WORDS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import pyspark
import __spark_entry__ as e
assert ".zip" in pyspark.__file__, pyspark.__file__
from pyspark import SparkContext
assert len(e.queries()) >= 44 and len(e.oracle_sql()) >= 44
assert SparkContext._active_spark_context is None and SparkContext._gateway is None
print("ok")
"""


def test_import_from_zip_without_session():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, "pyspark.zip"), *glob.glob(os.path.join(lib, "py4j-*.zip"))]
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*zips, ROOT]), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", PROBE], env=env, cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and done.stdout.strip().endswith("ok"), done.stderr[-2000:]


def test_stop_list_equals_spark_ml(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
