"""Readers and writers.

Every reader takes an explicit schema where the format has none, so no job
is spent on inference and a malformed record fails fast (or is routed to a
quarantine column in permissive mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonality import registry as R
from tonality.functions import text as TX
from tonality.functions.labels import label_dispatch
from tonality.schemas import KB_SCHEMA

# ---------------------------------------------------------------- readers


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
               **options) -> DataFrame:
    """Generic reader by format name."""
    r = spark.read.options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.format(fmt).load(path)


SMALL_BYTES = 256 << 20


def balanced(df: DataFrame, min_partitions: int | None = None, key: str | list[str] | None = None,
             max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Spread the rows of a small table (at most ``max_bytes`` by the scan's
    size) over at least ``min_partitions`` partitions (default: the session's
    default parallelism) when it has fewer.

    A file with one row group is read by a single task however large it is;
    text-heavy row work after it (tokenising, regexes) would then run on one
    core. Larger tables, and those that already have enough partitions, are
    returned unchanged, so no table of a cluster's size is shuffled here
    (write those with row groups of a split's size).
    Hashing on ``key`` (unique id columns) keeps the placement deterministic
    without the sort a round-robin repartition needs for that.
    """
    try:
        n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - Spark Connect exposes neither; leave the plan alone
        return df
    if have >= n or size > max_bytes:
        return df
    if not key:
        return df.repartition(n)
    return df.repartition(n, *([key] if isinstance(key, str) else key))


def read_dataset(spark: SparkSession, spec: R.DatasetSpec) -> DataFrame:
    """S1 + P1: materialise one registered dataset as ``id, text, label``
    (label still raw) plus ``dataset``, ``label_type`` and ``train_ratio``."""
    df = spec.reader(spark) if spec.reader is not None else read_table(spark, spec.path, spec.fmt)
    return df.select(F.col(spec.id_field).cast("long").alias("id"),
                     F.col(spec.input_field).cast("string").alias("text"),
                     F.col(spec.output_field).cast("string").alias("label"),
                     F.lit(spec.name).alias("dataset"), F.lit(spec.label_type).alias("label_type"),
                     F.lit(float(spec.train_ratio)).alias("train_ratio"))


def read_multi(spark: SparkSession, specs: list[R.DatasetSpec]) -> DataFrame:
    """S6 + P4: every registered dataset, labels normalised per label type,
    as one frame (bag union)."""
    frames = []
    for s in specs:
        d = read_dataset(spark, s)
        frames.append(d.withColumn("label", label_dispatch(F.col("label"), F.col("label_type"), s.label_mapping)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """One JSON object per line. ``FAILFAST`` raises on a bad line;
    ``PERMISSIVE`` keeps it in ``_corrupt_record`` for the quarantine."""
    r = spark.read.schema(schema).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
        r = spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = KB_SCHEMA) -> DataFrame:
    """S3: files that each hold one JSON array of objects; one row per element."""
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
            .option("recursiveFileLookup", True).json(path))


def read_phrasebank(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """S4 + F2 + P19: ``text@label`` lines in a single-byte encoding. The text
    reader yields raw bytes re-decoded from ``encoding``; blank lines are
    dropped, the split is on the last ``@``."""
    # default line separators (\r, \n, \r\n) = Python's universal newlines
    lines = spark.read.text(path)
    # The text source hands over each line's raw bytes; re-decode them.
    value = F.decode(F.col("value").cast("binary"), encoding)
    df = lines.select(value.alias("line"))
    df = df.where(F.length(TX.ustrip("line")) > 0)
    return df.select(TX.rsplit_text("line").alias("text"), TX.rsplit_label("line").alias("sentiment"))


# ---------------------------------------------------------------- writers


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8, non-ASCII kept as is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_kb(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The knowledge base as splittable JSON lines (one object per line)."""
    df.select("text", "sentiment", "metadata").write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "overwrite",
                      bytes_per_file: int = 64 << 20) -> None:
    """S8 (array form): JSON-array files of about ``bytes_per_file`` each (or
    at most ``rows_per_file`` elements), one file an array, all in one folder,
    written by many tasks in parallel; readable with :func:`read_json_array`."""
    j = df.select(F.to_json(F.struct(*df.columns)).alias("_j"))
    if rows_per_file is None:
        mean = j.agg(F.avg(F.octet_length("_j"))).first()[0] or 1
        rows_per_file = max(1, int(bytes_per_file / (mean + 1)))
    pid = F.spark_partition_id()
    # row position inside its partition, from the id's lower 33 bits
    pos = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    chunks = j.select("_j", pid.alias("_p"), F.floor(pos / rows_per_file).alias("_chunk"))
    arrays = chunks.groupBy("_p", "_chunk").agg(F.concat(F.lit("["), F.array_join(F.collect_list("_j"), ","), F.lit("]"))
                                                .alias("value"))
    arrays.select("value").write.mode(mode).option("maxRecordsPerFile", 1).text(path)


def write_lines(df: DataFrame, col: str, path: str, encoding: str = "ISO-8859-1", mode: str = "overwrite") -> None:
    """One text line per row in a single-byte ``encoding``: the encoded bytes
    are handed to the text writer unchanged (characters the encoding cannot
    represent raise an error)."""
    df.select(F.encode(F.col(col), encoding).cast("string").alias("value")).write.mode(mode).text(path)


def write_metrics_document(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row metrics document as a JSON text file."""
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1).write.mode(mode).text(path)
