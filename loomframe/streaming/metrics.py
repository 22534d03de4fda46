"""Run metrics kept up to date as log rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomframe.operators.joins import lookup
from loomframe.operators.ordering import Running, running
from loomframe.operators.runs import POSITION, in_order, smooth_metric, step_throughput

ROW_SCHEMA = "run string, step long, loss double, elapsed_sec double, tokens_seen long"


#: Parts that the state of the runs is kept in; a batch reads and writes those of its runs only.
PARTS = 256


class LiveMetrics:
    """Merges each micro-batch with the end of what came before.

    The state of a run is its last ``width - 1`` rows and its best loss so far. Runs are dealt to
    ``PARTS`` parts by hash; batch n reads the parts of the runs it holds, writes these anew, and an index
    of at most ``PARTS`` lines says which batch wrote the newest version of each part. A batch that is repeated after
    a failure reads the index of batch n-1 and overwrites its own folders, so it gives the same rows. All
    work is done by the batch operators, which split a run that dominates a batch.
    """

    def __init__(self, path: str, tokens_per_step: int, width: int = 100):
        self.path, self.tokens_per_step, self.width = path, tokens_per_step, width

    def _index(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        """Of each part, the batch that wrote its newest version."""
        if batch_id < 0:
            return {}
        lines = spark.read.text(f"{self.path}/index/{batch_id}").collect()
        return dict(tuple(map(int, line[0].split())) for line in lines)

    def _folder(self, part: int, batch_id: int) -> str:
        return f"{self.path}/state/{batch_id}/part={part}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = ["run", "step", "loss", "elapsed_sec", "tokens_seen"]
        part = F.pmod(F.xxhash64("run"), F.lit(PARTS)).cast("int")
        index = self._index(spark, batch_id - 1)
        touched = [r[0] for r in batch.select(part.alias("part")).distinct().collect()]
        held = [self._folder(p, index[p]) for p in touched if p in index]
        schema = ROW_SCHEMA + ", best double"
        state = spark.read.schema(schema).parquet(*held) if held else spark.createDataFrame([], schema)
        rows = state.select(*columns, F.lit(False).alias("is_new")).unionByName(
            batch.select(*columns, F.lit(True).alias("is_new"))
        )
        total = rows.count()
        numbered = in_order(rows, rows=total)
        smoothed = step_throughput(smooth_metric(numbered, width=self.width), self.tokens_per_step)
        best = running(
            smoothed, [POSITION], {"seen_best": Running("min", F.col("loss"), current=False)}, ["run"], total
        )
        earlier = state.groupBy(F.col("run").alias("__run")).agg(F.min("best").alias("before"))
        known = F.least("before", "seen_best")
        out = lookup(best, earlier, "run", "__run", "left", rows=total).where("is_new").select(
            *columns, "smooth_loss", "tokens_per_sec", "corrected",
            F.coalesce(known, F.lit(float("inf"))).alias("best_loss"),
        )
        out.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

        new = spark.read.parquet(f"{self.path}/rows/batch={batch_id}")
        reached = new.select("run", F.least("loss", "best_loss").alias("best")).unionByName(state.select("run", "best"))
        lowest = reached.groupBy(F.col("run").alias("__run")).agg(F.min("best").alias("best"))
        newest = Window.partitionBy("run").orderBy(F.col("step").desc())
        tail = (
            new.select(*columns).unionByName(state.select(*columns))
            .withColumn("__rn", F.row_number().over(newest)).where(F.col("__rn") < max(self.width, 2)).drop("__rn")
        )
        kept = tail.join(lowest, tail["run"] == lowest["__run"]).select(*columns, "best", part.alias("part"))
        kept.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/state/{batch_id}")
        after = index | {p: batch_id for p in touched}
        spark.createDataFrame([(f"{p} {n}",) for p, n in sorted(after.items())], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/index/{batch_id}"
        )
        # versions that batch n-1 replaced: no repeated batch can ask for them any more
        old_index = f"{self.path}/index/{batch_id - 2}"
        if batch_id > 1 and self._on_disk(spark, old_index, "exists"):
            for p, n in self._index(spark, batch_id - 2).items():
                if index.get(p) != n:
                    self._on_disk(spark, self._folder(p, n), "delete", True)
            self._on_disk(spark, old_index, "delete", True)

    def _on_disk(self, spark: SparkSession, path: str, what: str, *more: bool) -> bool:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return getattr(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), what)(place, *more)

    def run(self, stream: DataFrame) -> None:
        """Process everything that is there and stop; a second call resumes."""
        (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", f"{self.path}/_progress")
            .trigger(availableNow=True).start().awaitTermination()
        )

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows").drop("batch")
