"""The analysis over a stream of read pairs.

Events of a read depend on that read alone: they are computed as rows arrive and
appended to a table.  Families need a category's counts: a second query reads that
table as a stream and keeps the count of every (category, UMI) as its state.  Of
each micro-batch it stores the counts that changed, and calls families anew for the
categories that these belong to, from their counts alone.

Folders of a micro-batch carry its number and are written over when it is run
again after a failure, so a restart changes nothing.  Counts only grow: a UMI's
count is the largest one stored.  The families of a category are those of the last
micro-batch that touched it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import RunConfig, build_config
from ..functions.lineage import cut, let_go
from ..operators import chain, umi

READS = "read_ix bigint, id string, r1 string, r2 string"
#: Folders by category in each micro-batch's counts: what is read again is that of the touched ones.
BUCKETS = 64
STATE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def stream_events(spark: SparkSession, folder: str, config: RunConfig) -> DataFrame:
    """Events of the parquet read pairs that arrive in a folder."""
    reads = spark.readStream.schema(READS).parquet(folder)
    return chain.events(reads, build_config(config.strain, config.assay, config.distance, config.genome), config.header)


def start(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends events to a parquet folder, exactly once."""
    return events.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def start_families(spark: SparkSession, table: str, folder: str, checkpoint: str, config: RunConfig, files_at_once: int = 1000) -> StreamingQuery:
    """Families of the events in ``table``, which has rows, as it grows; ``folder`` holds them."""
    spark.conf.set(*STATE)  # state on the executors' disks, not in their memory
    events = spark.readStream.schema(spark.read.parquet(table).schema).option("maxFilesPerTrigger", files_at_once).parquet(table)
    update = lambda changed, batch: _update(changed, batch, folder.rstrip("/"), config)
    return umi.counts(events).writeStream.outputMode("update").foreachBatch(update).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _update(changed: DataFrame, batch: int, folder: str, config: RunConfig) -> None:
    """Stores the counts of a micro-batch and the families of its categories."""
    spark = changed.sparkSession
    at = f"{folder}/counts/batch={batch}"
    bucket = F.pmod(F.xxhash64(umi.CATEGORY), F.lit(BUCKETS))
    changed.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(at)
    new = spark.read.schema(f"{umi.CATEGORY} string, umi string, n bigint, bucket bigint").parquet(at)
    touched = [r[0] for r in new.select("bucket").distinct().collect()]
    if not touched:
        return
    every = spark.read.parquet(f"{folder}/counts").where(F.col("bucket").isin(touched) & (F.col("batch") <= batch))
    umis = cut(every.join(new.select(umi.CATEGORY).distinct(), umi.CATEGORY, "left_semi").groupBy(umi.CATEGORY, "umi").agg(F.max("n").alias("n")))
    per_umi, choice = umi.assigned(umis, config.family_model, config.distance, config.min_fraction, config.neighbor_risk, config.coverage_ratio)
    per_umi.write.mode("overwrite").parquet(f"{folder}/families/batch={batch}")
    choice.write.mode("overwrite").parquet(f"{folder}/choices/batch={batch}")  # last: a category has its new families once it has its choice
    let_go(umis)


def families_so_far(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """Events with the families that the stream has called; events of categories that it has not seen yet are left out."""
    choices = spark.read.parquet(f"{folder}/choices")
    rest = [c for c in choices.columns if c not in (umi.CATEGORY, "batch")]
    last = choices.groupBy(umi.CATEGORY).agg(F.max(F.struct("batch", *rest)).alias("c")).select(umi.CATEGORY, "c.*")
    per_umi = spark.read.parquet(f"{folder}/families").join(last.select(umi.CATEGORY, "batch"), [umi.CATEGORY, "batch"], "left_semi").drop("batch")
    return umi.with_families(spark.read.parquet(table), per_umi, last.drop("batch"))
