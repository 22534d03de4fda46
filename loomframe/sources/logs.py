"""Training logs: CSV and JSON lines in, appended files out."""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


_LONG, _DOUBLE, _TIME = T.LongType(), T.DoubleType(), T.TimestampType()

# The columns of the log files, in their order.
TRAIN_SCHEMA = _schema(
    step=_LONG, loss=_DOUBLE, smooth_loss=_DOUBLE, lr=_DOUBLE, tokens_seen=_LONG, tokens_per_sec=_DOUBLE,
    grad_norm=_DOUBLE, elapsed_sec=_DOUBLE, vram_used_gb=_DOUBLE, vram_peak_gb=_DOUBLE, timestamp=_TIME,
)
EVAL_SCHEMA = _schema(
    step=_LONG, val_loss=_DOUBLE, val_perplexity=_DOUBLE, best_val_loss=_DOUBLE, tokens_seen=_LONG,
    elapsed_sec=_DOUBLE, timestamp=_TIME,
)
# one schema for a file that mixes both kinds of row; epoch is an extra some runs log
JSONL_SCHEMA = T.StructType(
    [T.StructField("type", T.StringType()), *TRAIN_SCHEMA.fields,
     *[f for f in EVAL_SCHEMA.fields if f.name not in TRAIN_SCHEMA.names], T.StructField("epoch", T.IntegerType())]
)
SAMPLE_CHARS = 500


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A metrics CSV with header, and the ``run`` it belongs to (its folder); no file, no rows."""
    try:
        rows = (
            spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("positiveInf", "inf").option("negativeInf", "-inf").csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("run", T.StringType())]))
    return rows.withColumn("run", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def write_metrics(df: DataFrame, path: str) -> None:
    """Append rows as CSV files, each with its header."""
    (df.write.mode("append").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a mixed log, with keys beyond the schema in ``extra`` and unreadable lines in ``broken``.

    ``extra`` maps a key to a ``VARIANT``: nested values and keys whose type changes from line to line
    stay what they are. Keys with a null value are left out; a line without further keys has no map.
    """
    schema = T.StructType([*JSONL_SCHEMA.fields, T.StructField("broken", T.StringType())])
    options = {"allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": "broken"}
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    parsed = lines.select(
        F.from_json("value", schema, options).alias("row"),
        F.from_json("value", T.MapType(T.StringType(), T.VariantType()), options).alias("all"),
    )
    names = [F.lit(n) for n in JSONL_SCHEMA.names]
    extra = F.map_filter("all", lambda k, v: ~k.isin(*names) & v.isNotNull() & ~F.is_variant_null(v))
    return parsed.select("row.*", F.when(F.size(extra) > 0, extra).alias("extra"))


def to_jsonl(df: DataFrame, extra: str = "extra") -> DataFrame:
    """Rows as JSON lines; null keys are left out, those of the map ``extra`` stand beside the columns."""
    known = F.to_json(F.struct(*[c for c in df.columns if c != extra]))
    if extra not in df.columns:
        return df.select(known.alias("value"))
    more = F.coalesce(F.to_json(extra), F.lit("{}"))
    inner = F.concat_ws(",", *[F.nullif(F.substring(c, F.lit(2), F.length(c) - 2), F.lit("")) for c in (known, more)])
    return df.select(F.concat(F.lit("{"), inner, F.lit("}")).alias("value"))


def split_jsonl(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, evaluation rows and unreadable lines of a mixed log."""
    sound = rows.where(F.col("broken").isNull())
    is_eval = F.coalesce(F.col("type") == "eval", F.lit(False))
    train = [f.name for f in TRAIN_SCHEMA.fields] + ["epoch", "extra"]
    return (
        sound.where(~is_eval).select(*train), sound.where(is_eval).select(*EVAL_SCHEMA.names, "extra"),
        rows.where(F.col("broken").isNotNull()).select("broken"),
    )


def sample_log(samples: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Generated samples (``step, prompt, text, ts``) as they are logged: cut, with a time stamp in words."""
    return samples.select(
        "step", "prompt", F.substring("text", 1, chars).alias("text"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logged_at"),
    )


def last_samples(samples: DataFrame, n: int = 5, chars: int = 300) -> DataFrame:
    """The newest ``n`` samples, shortened for a report."""
    return samples.orderBy(F.col("step").desc()).limit(n).withColumn("text", F.substring("text", 1, chars))


def append_table(df: DataFrame, path: str, batch: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Add a batch of rows to a table, once: a batch that is there already is left as it is (and False returned).

    Rows go to a folder of their own that no reader looks at. A manifest named after the batch then
    tells where they are; it is put in its place by one rename that fails if there is one. So a job that
    dies before that leaves nothing to be seen, and of two that write the same batch one counts.
    """
    spark = df.sparkSession
    files, place = _files(spark, path)
    manifest = f"{path}/_manifests/{batch}"
    if files.util().exists(place(manifest)):
        return False
    folder = f"{batch}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/rows-{folder}")
    waiting = f"{path}/_waiting/{folder}"
    spark.createDataFrame([(f"rows-{folder}",)], "value string").coalesce(1).write.text(waiting)
    named = next(x.getPath() for x in files.util().listStatus(place(waiting)) if x.getPath().getName().startswith("part-"))
    files.mkdir(place(f"{path}/_manifests"), None, True)
    try:
        files.rename(named, place(manifest), spark.sparkContext._gateway.new_array(_java(spark, "Options$Rename"), 0))
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(place(waiting), True)
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the batches that have a manifest; no batch, no rows."""
    files, place = _files(spark, path)
    if not files.util().exists(place(f"{path}/_manifests")):
        return spark.createDataFrame([], schema)
    folders = [r[0] for r in spark.read.text(f"{path}/_manifests").collect()]
    # each folder is its own root, so that partition columns are found below it
    parts = [spark.read.schema(schema).parquet(f"{path}/{folder}") for folder in sorted(folders)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _java(spark: SparkSession, name: str):
    return getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, name)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how paths are made for it."""
    place = _java(spark, "Path")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    whole = place(path).getFileSystem(conf).makeQualified(place(path))
    return _java(spark, "FileContext").getFileContext(whole.toUri(), conf), lambda p: place(p)


def write_examples(df: DataFrame, path: str, order: str | None = None) -> None:
    """Finished samples by split and epoch, in ``order`` within each file; only the parts written are replaced."""
    keys = [c for c in ("split", "epoch") if c in df.columns]
    if order is not None:
        df = df.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
