"""Exactly-once ingestion of newline-delimited JSON files with a ledger and line-level quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.staging import EVENT_TYPES, classified, split
from tessera.sources.store import TableStore

EVENTS, QUARANTINE, LEDGER = "bronze/github_events", "bronze/quarantine", "bronze/ops/file_ledger"


def source_ref():
    """The file of a row as a plain path. Spark escapes paths; a plus sign is one, not a blank."""
    raw = F.regexp_replace(F.col("_metadata.file_path"), "^file:/*", "/")
    return F.url_decode(F.regexp_replace(raw, "[+]", "%2B"))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.text(paths).select("value", source_ref().alias("source_ref"))


def list_files(spark: SparkSession, folder: str, suffix: str = ".ndjson") -> DataFrame:
    """The plain paths of the folder's files, and their sizes, through Spark's own file systems."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(folder)
    path = F.regexp_replace("path", "^file:/*", "/")
    return found.select(F.url_decode(F.regexp_replace(path, "[+]", "%2B")).alias("file_path"), F.col("path").alias("uri"), "length")


def audited(df: DataFrame, run_id: str) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"run_id": F.lit(run_id), "ingest_ts": now, "ingest_date": F.to_date(now)})


def copy_into(store: TableStore, folder: str, run_id: str, event_types: list[str] = EVENT_TYPES, dataset: str = "github_archive", compat: bool = False, suffix: str = ".ndjson") -> dict[str, int]:
    """Loads the files that the ledger does not list; counts of files, lines, events and quarantined lines.

    Quarantine, events and ledger are written in this order, each at once or not at all. After a crash in between, the rerun
    finds the files that a table already holds and adds none of them twice. Spark does not list empty files, so they are never new.
    """
    spark = store.spark
    listed = list_files(spark, folder, suffix)
    if store.exists(LEDGER):
        listed = listed.join(store.read(LEDGER).select("file_path"), "file_path", "left_anti")
    files = listed.collect()
    if not files:
        return {"files_loaded": 0, "lines": 0, "events": 0, "quarantined": 0}
    lines = classified(read_lines(spark, [f["uri"] for f in files]), event_types, compat).persist()
    try:
        def missing(table: str, df: DataFrame) -> DataFrame:
            if not store.exists(table):
                return df
            held = store.read(table).select("source_ref").distinct().join(listed.select(F.col("file_path").alias("source_ref")), "source_ref", "left_semi")
            return df.join(held, "source_ref", "left_anti")

        valid, bad = split(lines)
        quarantined = store.append(QUARANTINE, audited(missing(QUARANTINE, bad), run_id))
        valid = valid.select("event_key", "raw_value", "event_type", (F.col("created_ts").cast("long") * 1000).alias("ts_ms"), "source_ref")
        events = store.append(EVENTS, audited(missing(EVENTS, valid), run_id), ["ingest_date", "event_type"])
        counts = lines.groupBy(F.col("source_ref").alias("file_path")).agg(F.count(F.lit(1)).alias("rows_loaded"))
        ledger = listed.select("file_path").join(counts, "file_path", "left").select(
            "file_path",
            F.lit(dataset).alias("dataset"),
            F.coalesce("rows_loaded", F.lit(0).cast("long")).alias("rows_loaded"),
            F.lit(run_id).alias("run_id"),
            F.current_timestamp().alias("loaded_at"),
        )
        store.append(LEDGER, ledger)
        total = lines.count()
    finally:
        lines.unpersist()
    return {"files_loaded": len(files), "lines": total, "events": events, "quarantined": quarantined}
