"""Record-file and small-file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RECORD_SCHEMA = T.StructType([
    T.StructField("Time", T.StringType()),
    T.StructField("Parameter", T.StringType()),
    T.StructField("Value", T.DoubleType()),
])

# Above this many files the file -> id table is joined by shuffle (with AQE
# skew splitting) instead of being broadcast.
BROADCAST_MAX_FILES = 200_000


def nan_to_null(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def load_record_files(spark: SparkSession, path: str, id_param: str = "RecordID",
                      id_col: str = "RecordID") -> DataFrame:
    """Every ``*.txt`` record file under ``path`` as one long table.

    Each file holds ``Time,Parameter,Value`` rows after a header line; the
    entity id is the value of the file's first ``id_param`` row and is
    attached to all rows of that file.  One distributed scan; the per-file
    id table is broadcast when the file count is small, shuffled otherwise.
    """
    raw = (spark.read.schema(RECORD_SCHEMA)
           .option("header", True)
           .option("pathGlobFilter", "*.txt")
           .option("recursiveFileLookup", True)
           .csv(path)
           .withColumn("_file", F.col("_metadata.file_path")))
    return attach_record_ids(raw, id_param, id_col, small=len(raw.inputFiles()) <= BROADCAST_MAX_FILES)


def attach_record_ids(raw: DataFrame, id_param: str = "RecordID", id_col: str = "RecordID",
                      small: bool = False) -> DataFrame:
    """Attach to every row the value of its file's first ``id_param`` row.

    ``raw`` holds ``Time, Parameter, Value, _file``.  The per-file table is
    broadcast when the caller knows the file count is small, shuffle-joined
    otherwise (AQE splits a skewed file).  A file without an id is an error
    that names the file."""
    raw = (raw.withColumn("_row", F.monotonically_increasing_id())
           .withColumn("Value", nan_to_null("Value")))
    ids = (raw.where(F.col("Parameter") == id_param)
           .groupBy("_file")
           .agg(F.min_by("Value", "_row").alias(id_col)))
    if small:
        ids = F.broadcast(ids)
    missing = F.raise_error(F.concat(F.lit(f"no {id_param} row in "), F.col("_file"))).cast("long")
    return (raw.join(ids, "_file", "left")
            .select(F.coalesce(F.col(id_col).cast("long"), missing).alias(id_col), "Parameter", "Time", "Value"))


def read_outcomes(spark: SparkSession, path: str, id_col: str = "RecordID",
                  label_src: str = "In-hospital_death", label_col: str = "label") -> DataFrame:
    """S3: outcomes CSV with a header; other columns are ignored."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.col(id_col).cast("long").alias(id_col),
                     F.col(f"`{label_src}`").cast("int").alias(label_col))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``variable,description`` CSV."""
    schema = "variable STRING, description STRING"
    return spark.read.option("header", True).schema(schema).csv(path)


def read_ranked_features(spark: SparkSession, path: str) -> DataFrame:
    """Text file, one ranked feature per line, name = last whitespace token.

    Returns ``(rank, feature)`` with rank 1 for the first line.  The list is
    as long as the feature set (hundreds of lines), so one ordered window is fine.
    """
    lines = (spark.read.text(path)
             .withColumn("_pos", F.monotonically_increasing_id())
             .where(F.length(F.trim("value")) > 0))
    return (lines
            .select("_pos", F.element_at(F.split(F.trim("value"), r"\s+"), -1).alias("feature"))
            .withColumn("rank", F.row_number().over(Window.orderBy("_pos")))
            .select("rank", "feature"))


def top_ranked(ranked: DataFrame, k: int) -> DataFrame:
    """O3: the first ``k`` features of a ranked list."""
    return ranked.where(F.col("rank") <= F.lit(k))
