"""Frozen option sets.  Defaults are the reference configuration's values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Optional


@dataclass(frozen=True)
class CleanOptions:
    remove_html: bool = True
    remove_punctuation: bool = True
    remove_stopwords: bool = True
    lowercase: bool = True
    min_word_length: int = 2
    max_word_length: int = 50


@dataclass(frozen=True)
class SplitOptions:
    test_size: float = 0.2
    val_size: float = 0.1
    seed: int = 42
    # Hex digits of the order key used as a rank bucket: 16**3 = 4096 buckets per class,
    # so one class holding a third of all rows is still spread over thousands of tasks.
    bucket_hex_digits: int = 3

    @property
    def val_fraction_of_rest(self) -> float:
        # Same double arithmetic as the reference: val / (1 - test).
        return self.val_size / (1 - self.test_size)


@dataclass(frozen=True)
class FeatureOptions:
    vectorizer_type: str = "tfidf"  # "tfidf" or "count"
    max_features: Optional[int] = 10000
    ngram_range: tuple[int, int] = (1, 2)
    max_df: float = 0.95  # float in (0, 1] = share of documents; int >= 1 = count
    min_df: float = 2  # int = document count; float in (0, 1) = share
    stop_words: Optional[tuple[str, ...]] = None  # None = Spark's English list; () = none
    lowercase: bool = True
    binary: bool = False


@dataclass(frozen=True)
class TrainOptions:
    clean: CleanOptions = field(default_factory=CleanOptions)
    split: SplitOptions = field(default_factory=SplitOptions)
    features: FeatureOptions = field(default_factory=FeatureOptions)
    dataset_size: Optional[int] = None  # None = all rows
    cv_folds: int = 5
    seed: int = 42
    lr_c: tuple[float, ...] = (0.1, 1.0, 10.0)
    lr_max_iter: int = 1000
    svm_c: tuple[float, ...] = (0.1, 1.0, 10.0)
    svm_max_iter: int = 10_000  # far beyond what the tolerance needs; reaching it is recorded
    svm_kernels: tuple[str, ...] = ("linear", "rbf")
    svm_gammas: tuple[str, ...] = ("scale", "auto")
    svm_landmarks: int = 512  # landmark rows of the rbf kernel; exact when there are no more training rows
    rf_trees: tuple[int, ...] = (100, 200)
    rf_depths: tuple[Optional[int], ...] = (10, 20, None)
    rf_min_split: tuple[int, ...] = (2, 5)
    rf_min_leaf: tuple[int, ...] = (1, 2)
    models: tuple[str, ...] = ("logistic_regression", "svm", "random_forest")
    parallelism: int = 8  # concurrent fits in grid search (the reference searches on all cores)
    # Rows per partition of the persisted training features: iterative solvers pay one task per
    # partition per iteration, so the partition count follows the row count, not the shuffle default.
    rows_per_partition: int = 100_000
    least_rows_per_partition: int = 500  # below these a partition is not worth a task, even with idle cores


def with_overrides(options, overrides: Optional[dict] = None):
    """Apply nested overrides one level deep, e.g. ``{"features": {"max_features": 5000}}``."""
    if not overrides:
        return options
    changes = {}
    for key, value in overrides.items():
        current = getattr(options, key)
        if isinstance(value, dict) and hasattr(current, "__dataclass_fields__"):
            changes[key] = replace(current, **value)
        else:
            changes[key] = value
    return replace(options, **changes)
