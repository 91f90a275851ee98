"""Seeded sampling, stratified train / val / test split and stratified folds (A1, A2, M4).

Row membership is decided by a deterministic order key ``md5(id|seed)`` — never ``rand()`` or
``monotonically_increasing_id`` — so results do not depend on partitioning or task retries.

Scale design (one class may hold a third of all rows):

* class sizes come from a partial-aggregated ``groupBy(label, bucket).count()`` over a narrow
  projection; ``bucket`` = first hex digits of the key, so each class is spread over
  ``16**d`` buckets;
* a row's rank inside its class is ``rows of the class in earlier buckets`` + its rank inside
  its bucket; buckets that lie wholly inside one split need no rank at all, so only the rows of
  the few *boundary* buckets go through a window (partitioned by ``(label, bucket)``);
* the quota and bucket tables are tiny (``classes x 16**d`` rows) and are broadcast.
"""

from __future__ import annotations

import math
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.options import SplitOptions
from opinio.session import scratch_path

_MAX_BUCKET_DIGITS = 4


def order_key(id_col: str | Column, seed: int) -> Column:
    """``md5(concat_ws('|', id, seed))`` — identical hex in Spark and DuckDB."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws("|", c.cast("string"), F.lit(str(seed))))


def _keyed(df: DataFrame, id_col: str, seed: int, digits: int) -> DataFrame:
    if not 1 <= digits <= _MAX_BUCKET_DIGITS:
        raise ValueError("bucket_hex_digits must be between 1 and 4")
    return (df.withColumn("_key", order_key(id_col, seed))
              .withColumn("_bucket", F.substring("_key", 1, digits)))


def _bucket_table(keyed: DataFrame, group_col: Optional[str]) -> DataFrame:
    """Per (group, bucket): row count and the number of rows of the group in earlier buckets."""
    gcols = [group_col] if group_col else []
    counts = keyed.groupBy(*gcols, "_bucket").agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*gcols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_bstart", F.coalesce(F.sum("_bn").over(w), F.lit(0)))


def largest_remainder(counts: dict, n_draws: int) -> dict:
    """Allocate ``n_draws`` over classes proportionally: floor, then +1 to the largest remainders.

    Same float arithmetic as the reference's library (``count / total * n_draws``); remainder ties go
    to the smaller class label (the reference breaks them at random).
    """
    total = sum(counts.values())
    cont = {k: v / total * n_draws for k, v in counts.items()}
    alloc = {k: math.floor(v) for k, v in cont.items()}
    need = int(n_draws - sum(alloc.values()))
    if need > 0:
        order = sorted(cont, key=lambda k: (-(cont[k] - alloc[k]), k))
        for k in order[:need]:
            alloc[k] += 1
    return alloc


def split_quotas(class_counts: dict, options: SplitOptions = SplitOptions()) -> dict:
    """A2 quotas: ``{label: (n_test, n_val, n_train)}``.

    Step 1: n_test = ceil(test_size * n); train share by largest remainder; test = complement.
    Step 2 on the remainder with val_size / (1 - test_size).
    """
    if min(class_counts.values()) < 2:
        raise ValueError("every class needs at least two rows to be split")

    def step(counts: dict, frac: float):
        n = sum(counts.values())
        n_test = math.ceil(frac * n)
        n_train = n - n_test
        if n_train < len(counts) or n_test < len(counts):
            raise ValueError(f"split of {n} rows into {n_train}/{n_test} leaves a class empty")
        keep = largest_remainder(counts, n_train)
        return keep, {k: counts[k] - keep[k] for k in counts}

    rest, test = step(class_counts, options.test_size)
    train, val = step(rest, options.val_fraction_of_rest)
    return {k: (test[k], val[k], train[k]) for k in class_counts}


def _cut_keys(narrow: DataFrame, cells: dict, label_col: str, id_col: str, cuts: dict) -> dict:
    """``{(label, n): (key, id)}`` of the row at the n-th wanted rank of each class (``cuts``: class -> ranks), in one
    job over the boundary buckets.

    ``cells`` holds the rows per (class, bucket); a rank falls into one bucket of its class, and only the rows of
    these buckets are ranked, each bucket by its own task.  One row per class and rank comes back."""
    wanted = []
    for label, ranks in cuts.items():
        for cut, rank in enumerate(ranks):
            start = 0
            for bucket in sorted(cells[label]):
                if start < rank <= start + cells[label][bucket]:
                    wanted.append((label, bucket, cut, rank - start))
                    break
                start += cells[label][bucket]
    if not wanted:
        return {}
    kind = narrow.schema[label_col].dataType.simpleString()
    table = narrow.sparkSession.createDataFrame(wanted, f"{label_col} {kind}, _bucket string, _cut int, _at long")
    w = Window.partitionBy(label_col, "_bucket", "_cut").orderBy("_key", id_col)
    found = (narrow.join(F.broadcast(table), [label_col, "_bucket"]).withColumn("_r", F.row_number().over(w))
             .where(F.col("_r") == F.col("_at")))
    return {(label, cut): (key, i) for label, cut, key, i in found.select(label_col, "_cut", "_key", id_col).collect()}


def _narrow_keys(df: DataFrame, label_col: str, id_col: str, seed: int, digits: int) -> tuple[DataFrame, dict]:
    """The written ``(label, id, key, bucket)`` table of ``df``, and its rows per class and bucket."""
    keyed = _keyed(df.select(label_col, id_col), id_col, seed, digits)
    path = scratch_path(df.sparkSession, "split-keys")
    keyed.write.parquet(path)
    narrow = df.sparkSession.read.schema(keyed.schema).parquet(path)
    cells: dict = {}
    for label, bucket, n in narrow.groupBy(label_col, "_bucket").count().collect():
        cells.setdefault(label, {})[bucket] = n
    return narrow, cells


def _by_cuts(df: DataFrame, label_col: str, id_col: str, seed: int, cells: dict, found: dict, names: Sequence, col: str) -> DataFrame:
    """``df`` with ``col``: the name of the first cut of its class that a row does not lie beyond, by ``(key, id)``.
    One small row per class is broadcast; rows stay where they are."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (label_col, id_col)}
    n = len(names) - 1
    rows = [(k, *(x for c in range(n) for x in found.get((k, c), ("", None)))) for k in cells]
    schema = f"_l {kinds[label_col]}" + "".join(f", _k{c} string, _i{c} {kinds[id_col]}" for c in range(n))
    key = order_key(id_col, seed)
    out = F.lit(names[-1])
    for c in reversed(range(n)):
        upto = (key < F.col(f"_k{c}")) | ((key == F.col(f"_k{c}")) & (F.col(id_col) <= F.col(f"_i{c}")))
        out = F.when(upto, F.lit(names[c])).otherwise(out)
    table = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(table), F.col(label_col) == F.col("_l")).withColumn(col, out).select(*df.columns, col)


def stratified_split(df: DataFrame, label_col: str, id_col: str,
                     options: SplitOptions = SplitOptions(), split_col: str = "split") -> DataFrame:
    """A2: adds ``split`` in {train, val, test}.  Exact quotas per class; the rank of a row in its
    class is by ``(md5(id|seed), id)``: the first ``n_test`` rows go to test, the next ``n_val``
    to val, the rest to train.

    One pass writes the narrow ``(id, label, key)`` table; its bucket counts (classes x buckets values) give the
    quotas, and the two boundary keys of each class follow from the boundary buckets.  The rows themselves are
    then read once and compared with their class's keys: no shuffle, no window over texts."""
    narrow, cells = _narrow_keys(df, label_col, id_col, options.seed, options.bucket_hex_digits)
    if None in cells:
        raise ValueError("null label in stratified split")
    quotas = split_quotas({k: sum(v.values()) for k, v in cells.items()}, options)
    cuts = {k: (n_test, n_test + n_val) for k, (n_test, n_val, _) in quotas.items()}
    found = _cut_keys(narrow, cells, label_col, id_col, cuts)
    return _by_cuts(df, label_col, id_col, options.seed, cells, found, ("test", "val", "train"), split_col)


def fold_ranges(df: DataFrame, label_col: str, id_col: str, k: int = 5, seed: int = 42, fold_col: str = "fold",
                digits: int = 3) -> DataFrame:
    """M4 folds without moving a row: stratified, the ranks of a class by ``(md5(id|seed), id)`` cut into k ranges,
    ``fold = floor((rank - 1) * k / rows of the class)``; sizes differ by one at most.

    As in ``stratified_split``, a narrow table of keys gives the k - 1 boundary keys of each class, and the rows are
    compared with those of their class.  A null label is an error, an empty table gives no rows."""
    narrow, cells = _narrow_keys(df, label_col, id_col, seed, digits)
    if None in cells:
        raise ValueError("null label in folds")
    sizes = {label: sum(v.values()) for label, v in cells.items()}
    # The last rank of each fold but the last: ranks r with floor((r - 1) * k / n) <= fold.
    cuts = {label: [-(-(fold + 1) * n // k) for fold in range(k - 1)] for label, n in sizes.items()}
    found = _cut_keys(narrow, cells, label_col, id_col, cuts)
    return _by_cuts(df, label_col, id_col, seed, cells, found, tuple(range(k)), fold_col)


def class_rank(df: DataFrame, label_col: Optional[str], id_col: str, seed: int,
               digits: int = 3, rank_col: str = "rank") -> DataFrame:
    """Exact 1-based rank of every row inside its class by ``(md5(id|seed), id)``.

    The window is partitioned by ``(label, bucket)``, never by the label alone, so a hot class is
    ranked by many tasks; bucket offsets come from a tiny broadcast table.
    """
    keyed = _keyed(df, id_col, seed, digits)
    gcols = [label_col] if label_col else []
    buckets = _bucket_table(keyed.select(*gcols, "_bucket"), label_col)
    w = Window.partitionBy(*gcols, "_bucket").orderBy("_key", id_col)
    ranked = (keyed.join(F.broadcast(buckets), gcols + ["_bucket"])
              .withColumn(rank_col, F.col("_bstart") + F.row_number().over(w)))
    return ranked.drop("_key", "_bucket", "_bn", "_bstart")


def assign_folds(df: DataFrame, label_col: str, id_col: str, k: int = 5, seed: int = 42,
                 fold_col: str = "fold", digits: int = 3) -> DataFrame:
    """M4 folds: stratified, ``fold = (rank in class - 1) mod k``."""
    ranked = class_rank(df, label_col, id_col, seed, digits, "_rank")
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def sample_n(df: DataFrame, n: Optional[int], id_col: str, seed: int = 42, digits: int = 3) -> DataFrame:
    """A1: exactly ``min(n, rows)`` rows, the smallest by ``(md5(id|seed), id)``; None / 0 = all rows.

    Whole buckets below the cut pass a broadcast filter; only the rows of the one boundary bucket are ranked.
    """
    if not n:
        return df
    keyed = _keyed(df, id_col, seed, digits)
    buckets = _bucket_table(keyed.select("_bucket"), None).withColumn("_bend", F.col("_bstart") + F.col("_bn"))
    # At most 16**digits rows, broadcast.
    buckets = buckets.where(F.col("_bstart") < n)
    tagged = keyed.join(F.broadcast(buckets), "_bucket")
    inner = tagged.where(F.col("_bend") <= n)
    w = Window.partitionBy("_bucket").orderBy("_key", id_col)
    edge = (tagged.where(F.col("_bend") > n)
            .withColumn("_r", F.col("_bstart") + F.row_number().over(w)).where(F.col("_r") <= n))
    return inner.select(*df.columns).unionByName(edge.select(*df.columns))
