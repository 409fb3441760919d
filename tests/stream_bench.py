"""Streaming throughput and batch latency of the four jobs.

Usage: ``python tests/stream_bench.py [sf_dir]``.  The post and weather
records of ``sf_dir`` land as 10 time-ordered files each; every job reads
them one file per micro-batch (``maxFilesPerTrigger=1``) with
``trigger(availableNow=True)`` and writes parquet.  Prints one JSON line
per job from Structured Streaming's own progress reports: rows, batches,
mean processed rows/s over the data batches and median batch time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

N_FILES = 10


def land(spark, df, path):
    from pyspark.sql import functions as F
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    lo, hi = df.agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))).first()
    width = -(-(hi - lo + 1) // N_FILES)
    staged = df.withColumn("_f", ((F.unix_micros("timestamp") - F.lit(lo)) / F.lit(width)).cast("int"))
    staged.write.partitionBy("_f").parquet(path + "-all")
    stored = spark.read.parquet(path + "-all")
    for i in range(N_FILES):   # one file per slice, written in time order
        stored.where(F.col("_f") == i).drop("_f").coalesce(1).write.mode("append").parquet(path)
    return stored.drop("_f").schema


def summary(name, queries, seconds):
    progress = [p for q in queries for p in q.recentProgress if p["numInputRows"] > 0]
    rows = sum(p["numInputRows"] for p in progress)
    return {
        "job": name,
        "rows": rows,
        "batches": len(progress),
        "wall_sec": round(seconds, 2),
        "rows_per_sec_mean": round(statistics.mean(p["processedRowsPerSecond"] for p in progress), 1),
        "batch_ms_median": statistics.median(p["durationMs"]["triggerExecution"] for p in progress),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from chirpwave.session import local_session, scratch_path
    from chirpwave.sources import feeds
    from chirpwave.sources.tables import read_parquet_stream
    from chirpwave.streaming import jobs as J

    spark = local_session(cores=8, shuffle_partitions=8)
    base = scratch_path(spark, "stream-bench")
    post_schema = land(spark, feeds.post_records(spark, sf_dir), f"{base}/posts")
    weather_schema = land(spark, feeds.weather_records(spark, sf_dir), f"{base}/weather")
    once = {"availableNow": True}

    def posts():
        return read_parquet_stream(spark, f"{base}/posts", post_schema, max_files_per_trigger=1)

    def weather():
        return read_parquet_stream(spark, f"{base}/weather", weather_schema, max_files_per_trigger=1)

    runs = {
        "classify (P1)": lambda out: J.classify_job(posts(), J.Sink.files(f"{out}/o"), J.Sink.files(f"{out}/r"),
                                                    f"{out}/c", trigger=once),
        "state_sentiment (P2, 1 day)": lambda out: J.state_sentiment_job(
            posts(), J.Sink.files(f"{out}/o"), J.Sink.files(f"{out}/r"), f"{out}/c", size="1 day", trigger=once),
        "trending (P3, 4 h / 2 h)": lambda out: J.trending_job(
            posts(), J.Sink.files(f"{out}/o"), J.Sink.files(f"{out}/r"), f"{out}/c", size="4 hours",
            slide="2 hours", trigger=once),
        "sentiment_weather (P4, 1 day)": lambda out: J.sentiment_weather_job(
            posts(), weather(), J.Sink.files(f"{out}/o"), J.Sink.files(f"{out}/r"), f"{out}/c", size="1 day",
            trigger=once),
    }
    for name, start in runs.items():
        out = scratch_path(spark, "stream-bench-out")
        t0 = time.perf_counter()
        job = start(out)
        job.await_all()
        print(json.dumps(summary(name, [job.result], time.perf_counter() - t0)), flush=True)


if __name__ == "__main__":
    main()
