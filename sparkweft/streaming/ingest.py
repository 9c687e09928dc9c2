"""Pages as a stream (an extension): each micro-batch is built and upserted; a batch that is repeated changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkweft.config import Config
from sparkweft.operators import fts
from sparkweft.operators.corpus import build
from sparkweft.operators.store import Warehouse

PAGES = "collection string, canonical_url string, url string, html string, status int, error string"


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PAGES).parquet(path)


def ingest(pages: DataFrame, warehouse: Warehouse, config: Config, checkpoint: str) -> StreamingQuery:
    """Build and store what has arrived, then stop (availableNow)."""

    def batch(rows: DataFrame, number: int) -> None:
        made = build(rows, rows.select("url", "html", "status", "error"), config)
        urls = made.documents.select("collection", "canonical_url")
        warehouse.upsert("raw_documents", made.documents.withColumn("metadata", F.lit(None).cast("map<string, string>")))
        warehouse.replace_sections(urls, made.sections)
        warehouse.replace_chunks(urls, made.chunks)
        warehouse.replace_postings(urls, fts.postings(made.chunks, "chunk_id", keep=("collection", "canonical_url")))

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and type of a stream (or table) of events; rows later than `late` behind are dropped by the watermark."""
    d = events.withColumn("ts", F.col("ts").cast("timestamp"))
    d = d.withWatermark("ts", late) if events.isStreaming else d
    return d.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
