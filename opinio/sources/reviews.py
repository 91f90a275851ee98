"""Review sources and sinks (S1-S8) and the load-time projections."""

from __future__ import annotations

from typing import Iterable, Optional, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.labels import label_to_int

TEXT_ALIASES = ("review", "text", "comment")
LABEL_ALIASES = ("sentiment", "label", "rating")
SPLITS = ("train", "val", "test")

# ---------------------------------------------------------------------------------------------
# The tokens pandas' CSV reader turns into a missing value by default.  Spark keeps
# most of them as text, so they are mapped to null explicitly after the scan.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# ---------------------------------------------------------------------------------------------
# Spark's CSV writer trims values unless told otherwise.
CSV_WRITE_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
                     "ignoreTrailingWhiteSpace": False}


def normalize_columns(df: DataFrame, text_aliases: Sequence[str] = TEXT_ALIASES,
                      label_aliases: Sequence[str] = LABEL_ALIASES) -> DataFrame:
    """Rename the first present alias to ``review`` / ``sentiment``; other columns are kept."""
    for target, aliases in (("review", text_aliases), ("sentiment", label_aliases)):
        if target in df.columns:
            continue
        found = next((a for a in aliases[1:] if a in df.columns), None)
        if found is None:
            raise ValueError(f"no {target} column: none of {list(aliases)} in {df.columns}")
        df = df.withColumnRenamed(found, target)
    return df


def normalize_labels(df: DataFrame, col: str = "sentiment", on_bad: str = "error") -> DataFrame:
    """P2 + P3: map / cast the label to int.  ``on_bad``: error | null | drop."""
    dtype = df.schema[col].dataType
    mapped = df.withColumn(col, label_to_int(col, dtype, "null" if on_bad in ("null", "drop") else "error"))
    if on_bad == "drop":
        mapped = mapped.where(F.col(col).isNotNull())
    return mapped


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop a row with a null in any column."""
    return df.dropna(how="any")


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """P5."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) {missing} not found; columns are {df.columns}")
    return df


def null_csv_tokens(df: DataFrame, cols: Optional[Iterable[str]] = None) -> DataFrame:
    cols = list(cols) if cols is not None else [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c).isin(*CSV_NULL_TOKENS), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def prepare_reviews(df: DataFrame, on_bad_label: str = "error") -> DataFrame:
    """P1 -> P2/P3 -> P4, the load-time contract of a labelled review table."""
    return drop_null_rows(normalize_labels(normalize_columns(df), "sentiment", on_bad_label))


def read_csv(spark: SparkSession, paths, schema: Optional[T.StructType] = None) -> DataFrame:
    """Quoted fields may hold newlines and doubled quotes.  ``multiLine`` makes a file unsplittable:
    convert large CSV inputs to Parquet once and read that."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        # String columns only; the label column is typed by the label step.
        reader = reader.option("inferSchema", False)
    return null_csv_tokens(reader.csv(paths))


def read_reviews_csv(spark: SparkSession, paths, schema: Optional[T.StructType] = None,
                     on_bad_label: str = "error") -> DataFrame:
    """CSV review scan with the P1-P4 contract.

    A label column that holds numbers only is numeric, as a typed reader would have it (one aggregate over that
    column); any other is text."""
    df = normalize_columns(read_csv(spark, paths, schema))
    if isinstance(df.schema["sentiment"].dataType, T.StringType):
        number = F.expr("try_cast(sentiment AS double)")
        words = df.where(F.col("sentiment").isNotNull() & number.isNull()).limit(1).count()
        if not words:
            df = df.withColumn("sentiment", number)
    return prepare_reviews(df, on_bad_label)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system, so object stores work too."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def is_file(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(hpath).isFile())


def resolve_source(spark: SparkSession, candidates: Sequence[str]) -> Optional[str]:
    """The first existing path of the candidates, in order; None if none exists."""
    return next((p for p in candidates if path_exists(spark, p)), None)


def read_label_directories(spark: SparkSession, root: str, subset: str = "train",
                           shuffle_seed: Optional[int] = None) -> DataFrame:
    """S3 + U1: ``{root}/{subset}/pos/*.txt`` -> 1, ``neg`` -> 0, one file per row.

    A missing directory contributes no rows.  Row identity is the file path; an optional
    seeded order (``md5(path|seed)``) replaces the reference's in-memory shuffle.
    """
    parts = []
    for name, label in (("pos", 1), ("neg", 0)):
        directory = f"{root.rstrip('/')}/{subset}/{name}"
        if not path_exists(spark, directory):
            continue
        part = (spark.read.option("pathGlobFilter", "*.txt").text(directory, wholetext=True)
                .select(F.col("value").alias("review"), F.lit(label).alias("sentiment"),
                        F.col("_metadata.file_path").alias("source_path")))
        parts.append(part)
    if not parts:
        schema = "review string, sentiment int, source_path string"
        return spark.createDataFrame([], schema)
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    if shuffle_seed is not None:
        df = df.orderBy(F.md5(F.concat_ws("|", F.col("source_path"), F.lit(str(shuffle_seed)))))
    return df


def load_reviews(spark: SparkSession, candidates: Sequence[str], corpus_root: Optional[str] = None,
                 subsets: Sequence[str] = ("train", "test"), on_bad_label: str = "error") -> DataFrame:
    """The first review file that exists; else the label directories under ``corpus_root`` (S3, U2); else an
    error that names the paths tried."""
    found = resolve_source(spark, candidates)
    if found:
        return read_reviews_csv(spark, found, on_bad_label=on_bad_label)
    if corpus_root and path_exists(spark, corpus_root):
        out = None
        for subset in subsets:
            part = read_label_directories(spark, corpus_root, subset)
            out = part if out is None else out.unionByName(part)
        return out
    raise FileNotFoundError(f"no review source at {[*candidates, corpus_root]}")


def read_records(spark: SparkSession, path: str, schema: Optional[T.StructType] = None,
                 multiline_json: bool = False) -> DataFrame:
    """``.csv`` or ``.json`` (JSON Lines; ``multiline_json`` for one array of records)."""
    lower = path.lower().rstrip("/")
    if lower.endswith(".csv"):
        return read_csv(spark, path, schema)
    if lower.endswith(".json") or lower.endswith(".jsonl"):
        reader = spark.read.option("multiLine", multiline_json)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"cannot tell the format of {path!r} by its suffix")


def to_review_frame(spark: SparkSession, data, text_col: str = "review") -> DataFrame:
    """A string, a list of strings or a DataFrame (which must carry ``text_col``)."""
    if isinstance(data, DataFrame):
        return require_columns(data, text_col)
    if isinstance(data, str):
        data = [data]
    if isinstance(data, (list, tuple)):
        rows = [(i, t) for i, t in enumerate(data)]
        return spark.createDataFrame(rows, f"review_id long, {text_col} string")
    raise ValueError(f"texts must be a str, a list of str or a DataFrame, not {type(data).__name__}")


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", split_col: str = "split") -> str:
    """One directory per split (``split=train`` ...), written in one job."""
    (df.write.mode("overwrite").partitionBy(split_col).format(fmt)
     .options(**(CSV_WRITE_OPTIONS if fmt == "csv" else {})).save(path))
    return path


def read_splits(spark: SparkSession, path: str, splits: Sequence[str] = SPLITS, fmt: str = "parquet",
                schema: Optional[T.StructType] = None) -> DataFrame:
    """The splits present; absent ones simply contribute no rows (partition pruning)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).where(F.col("split").isin(*splits))


def write_predictions(df, path: str, fmt: str = "csv", records_per_file: Optional[int] = None) -> str:
    """Csv / json / parquet ("pickle" maps to parquet); unknown formats raise.  ``df`` is a DataFrame or a
    list of row dictionaries."""
    if isinstance(df, (list, tuple)):
        df = SparkSession.active().createDataFrame([Row(**r) for r in df])
    fmt = fmt.lower()
    if fmt == "pickle":
        fmt = "parquet"
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"cannot write {fmt!r}; use csv, json or parquet")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_WRITE_OPTIONS)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.save(path)
    return path
