"""opinio — review-sentiment analytics as Spark DataFrame plans.

Sub-packages:

* ``functions``  – Column builders (text cleaning, label mapping, n-grams).
* ``sources``    – readers and writers (CSV / JSON / text directories / splits / predictions).
* ``operators``  – relational operators (sampling, stratified split, profiles,
  vocabulary and TF-IDF in long form, metrics, lemma / stem dictionaries).
* ``plans``      – Spark ML plans (feature pipeline, training, scoring, run log).
* ``streaming``  – Structured Streaming scoring and drift windows.
"""

from opinio.options import CleanOptions, FeatureOptions, SplitOptions, TrainOptions

__all__ = ["CleanOptions", "FeatureOptions", "SplitOptions", "TrainOptions"]
