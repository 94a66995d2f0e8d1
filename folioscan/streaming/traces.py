"""Token use as a stream of traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscan.functions import answers as A
from folioscan.session import shared_folder


def token_windows(traces: DataFrame, width: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Tumbling windows of logged_at by domain: window_start, domain, n_traces, prompt, completion and total tokens.

    Of rows with one trace_id and time the first counts, within the time that traces may be late; later ones are
    dropped by a stream, and a batch has none. Null times make no window.
    """
    usage = F.col("usage")
    rows = traces.withColumn("at", F.col("logged_at").cast("timestamp")).withWatermark("at", late).dropDuplicates(["trace_id", "at"])
    return (
        rows.groupBy(F.window("at", width), F.coalesce("domain", F.lit("")).alias("domain"))
        .agg(F.count("*").alias("n_traces"), F.sum(A.prompt_tokens(usage)).alias("prompt_tokens"), F.sum(A.completion_tokens(usage)).alias("completion_tokens"), F.sum(A.total_tokens(usage)).alias("total_tokens"))
        .select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "domain", "n_traces", "prompt_tokens", "completion_tokens", "total_tokens")
    )


def stream_traces(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream of the Parquet files of a folder, or of one file; at most `files` of them in a trigger, or all that are there.

    A bound makes what counts as late depend on the order of the files.
    """
    held = spark.read.parquet(path)
    stream = spark.readStream.schema(held.schema)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    folder, _, name = path.rstrip("/").rpartition("/")
    files = held.inputFiles()
    if len(files) == 1 and files[0].endswith("/" + name):  # a stream reads folders
        return stream.option("pathGlobFilter", name).parquet(folder)
    return stream.parquet(path)


def run_token_windows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All windows of what lies in `path`, by a stream that ends once it has read it, in one trigger, so that no row is late; state and progress lie in the shared folder."""
    import uuid

    folder = f"{shared_folder(spark)}/folioscan/stream-{uuid.uuid4().hex}"
    out = token_windows(stream_traces(spark, path))

    def upsert(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{folder}/out")

    query = out.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(upsert).queryName(name).start()
    query.awaitTermination()
    rows = spark.read.schema(T.StructType([*out.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{folder}/out")
    latest = F.struct("batch", *out.columns)
    return rows.groupBy("window_start", "domain").agg(F.max(latest).alias("x")).select("window_start", "domain", *(f"x.{c}" for c in out.columns[2:]))
