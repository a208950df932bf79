"""Exact deduplication as a stream with keyed state.

The table is read as a stream of files. The state, held on disk (RocksDB) and checkpointed in the shared folder, never
expires; for each digest it keeps the row that stays (length, identifier) with its place (file and row number) and the
number of rows seen. Afterwards rows that met a digest already held are compared byte by byte, by the least and greatest bytes
of a digest, so that no task gathers the rows of a common text.
Only DataFrame functions run on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import cut_lineage, new_path, settings

FILES_PER_BATCH = 1000
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
_STATE = {
    "spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
    "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
    "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "200",
    "spark__sql__streaming__stateStore__rocksdb__writeBufferSizeMB": "4",
    "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",  # else each partition reserves megabytes
}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _WHITE, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _placed(rows: DataFrame, digest) -> DataFrame:
    """Digest, length, identifier and place of each row; texts are not carried on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = normalised(F.col("text"))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(same).alias("digest"),
        sha256(same).alias("text_sha256"),
        F.char_length(text).alias("points"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _ahead() -> Column:
    """Larger for the row that stays: more code points, then the smaller identifier (null last), then the earlier place."""
    return F.struct(
        F.col("points").alias("points"),
        F.col("doc_id").isNotNull().alias("named"),
        F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")).alias("low"),
        F.col("file").alias("file"),
        (-F.col("row")).alias("row"),
    )


def keepers(spark: SparkSession, path: str, digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Per digest the row that stays and the number of rows, from one run of the stream over all files there are."""
    folder = new_path(spark, "exact")
    schema = spark.read.parquet(path).schema
    pattern = path[:-1] + f"[{path[-1]}]"  # a pattern reads one file and a folder of files alike
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)
    state = _placed(rows, digest).groupBy("digest").agg(F.max(_ahead()).alias("best"), F.count(F.lit(1)).alias("seen"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changed/batch={batch}")  # a repeated batch replaces itself

    with settings(spark, **_STATE):
        stream = state.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{folder}/state").foreachBatch(write).start()
        stream.awaitTermination()
    kept = "digest string, best struct<points:int,named:boolean,low:decimal(20,0),file:string,row:bigint>, seen bigint, batch int"
    changes = spark.read.schema(kept).parquet(f"{folder}/changed")
    return changes.groupBy("digest").agg(F.max(F.struct("seen", "best")).alias("last")).select("digest", F.col("last.seen").alias("seen"), F.col("last.best").alias("best"))


def deduplicate(spark: SparkSession, path: str, digest=sha256, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of the Parquet table at `path` (doc_id, text).

    Texts are equal when they agree without white space; null is empty. Of equal texts the longest original stays, of
    these the smallest identifier (null last), of repeated rows the earliest place in the last file by name: one row of
    each group is kept. Further columns are not read. Should texts of one digest differ in bytes, the groups of that
    digest are formed by the bytes themselves. An empty table gives no rows.
    """
    held = cut_lineage(keepers(spark, path, digest, files_per_batch))
    rows = _placed(spark.read.parquet(path), digest)
    low = F.col("best.low")
    met = rows.join(held, "digest").withColumns({"keep_id": F.when(F.col("best.named"), (-low).cast("long")), "keep_file": F.col("best.file"), "keep_row": -F.col("best.row")})
    met = cut_lineage(met.drop("best", "points"))
    here = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))

    # bytes of every row that hit a held digest against those of the row it met
    wanted = met.filter("seen > 1").select("file", "row", "digest")
    text = spark.read.parquet(path).select(normalised(F.col("text")).alias("bytes"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    hits = text.join(wanted, ["file", "row"])
    # the held row is among them, so all bytes are its bytes when the least equals the greatest; a common text leaves each
    # task as one row
    ends = hits.groupBy("digest").agg(F.min("bytes").alias("least"), F.max("bytes").alias("greatest"))
    wrong = ends.filter(F.col("least") != F.col("greatest")).select("digest")
    wrong = cut_lineage(wrong)
    out = met.select("doc_id", "keep_id", F.col("seen").alias("group_size"), here.alias("kept"), "text_sha256", "digest")
    if not wrong.limit(1).count():
        return out.drop("digest")
    again = hits.join(wrong, "digest", "left_semi").join(met.select("file", "row", "doc_id", "text_sha256"), ["file", "row"])
    points = spark.read.parquet(path).select(F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("points"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    again = again.join(points, ["file", "row"])
    groups = again.groupBy("bytes").agg(F.max(_ahead()).alias("best"), F.count(F.lit(1)).alias("group_size"))
    again = again.join(groups, "bytes").select(
        "doc_id",
        F.when(F.col("best.named"), (-low).cast("long")).alias("keep_id"),
        "group_size",
        ((F.col("file") == F.col("best.file")) & (F.col("row") == -F.col("best.row"))).alias("kept"),
        "text_sha256",
    )
    return out.join(wrong, "digest", "left_anti").drop("digest").unionByName(again)
