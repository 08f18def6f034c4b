"""The daily job over a landing folder: read the CSV files not seen before, then merge them.

A file stream keeps the list of files it has read and its sink commits each batch once, so a day's
run reads that day's files however many the folder holds. With trigger availableNow it ends when
it has caught up, like any batch job. The merge itself is run_etl.

Lines that cannot be loaded stay in the staging table. `rejects` lists those that nobody has repaired, and
`replay` takes repaired ones in as a load of its own, each rejected line once.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.plans.etl import RunResult, run_etl
from tillworks.sources.csv_load import CSV_OPTIONS, STAGED, TEXT_SCHEMA, split_staged, typed_lines, typed_rows
from tillworks.sources.warehouse import Warehouse, typed_row

_LOADED = T.StructType([*STAGED.fields, T.StructField("load", T.LongType())])
_REPAIRED = T.StructType([*_LOADED.fields, T.StructField("repairs", T.StringType())])


def stage_new_files(
    spark: SparkSession,
    landing: str,
    staging: str,
    load: int,
    timestamp_pattern: str | None = None,
    multi_line: bool = False,
) -> None:
    """Append the typed rows of new files to the staging table as partition `load`."""
    text = spark.readStream.schema(TEXT_SCHEMA).csv(landing, multiLine=multi_line, **CSV_OPTIONS)
    rows = typed_rows(text, timestamp_pattern)
    query = (
        rows.withColumn("load", F.lit(load))
        .withColumn("rejected", F.col("reject_reason").isNotNull())
        .writeStream.format("parquet")
        .partitionBy("load", "rejected")
        .option("path", staging)
        .option("checkpointLocation", f"{staging}_progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def staged_since(spark: SparkSession, staging: str, load: int) -> tuple[DataFrame, DataFrame]:
    """Good and rejected rows of all loads after the given one, with their load."""
    table = spark.read.schema(_LOADED).parquet(staging)
    return tuple(rows.filter(F.col("load") > load) for rows in split_staged(table, "load"))


def _repaired(spark: SparkSession, warehouse: Warehouse) -> DataFrame | None:
    """The rows of all replays that were written to their end; `repairs` is the reject_id a row stands for."""
    done = [n for n in warehouse.names_in("repaired") if warehouse.exists(f"repaired/{n}/_SUCCESS")]
    if not done:
        return None
    folder = f"{warehouse.root}/repaired"
    return spark.read.schema(_REPAIRED).option("basePath", folder).parquet(*[f"{folder}/{n}" for n in done])


def _loads(warehouse: Warehouse) -> list[int]:
    # By the folders, not by a clock, which may go back.
    names = [*warehouse.names_in("staging"), *warehouse.names_in("repaired")]
    return [int(name.removeprefix("load=")) for name in names if name.startswith("load=")]


def rejects(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """Lines of the landing folder that could not be loaded and that no replay has taken up yet.

    reject_id, load, line, reject_reason and what could be read of the typed columns. The id is the hash of
    load and line: copies of a line in one load share it and are repaired together. A repaired line that
    still cannot be loaded is a new reject of its own load.
    """
    again = _repaired(spark, warehouse)
    rows = typed_row(spark, _LOADED, None) if again is None else again.drop("repairs")
    if any(name.startswith("load=") for name in warehouse.names_in("staging")):
        rows = rows.unionByName(spark.read.schema(_LOADED).parquet(f"{warehouse.root}/staging"))
    _, bad = split_staged(rows, "load")
    bad = bad.withColumn("reject_id", F.sha2(F.concat_ws(":", F.col("load").cast("string"), "line"), 256))
    if again is None:
        return bad
    return bad.join(again.select(F.col("repairs").alias("reject_id")), "reject_id", "left_anti")


def replay(
    spark: SparkSession, warehouse: Warehouse, repaired: DataFrame, timestamp_pattern: str | None = None
) -> RunResult | None:
    """Take in repaired lines (reject_id, line) as a load of their own and merge it, after all earlier loads.

    Ids that are not among the open `rejects` are passed over, so the same call again does nothing. A
    rejected line may be repaired into several. Being the newest delivery, a repaired line replaces what is
    stored under its transaction id. If the merge fails, the next replay or merge_new_files catches it up. As with
    merge_new_files, one call at a time. None if there is nothing to merge.
    """
    open_ids = rejects(spark, warehouse).select("reject_id")
    lines = repaired.select(F.col("reject_id").alias("repairs"), "line").filter("line is not null")
    # Joined before they are made distinct: both go by the id, so the lines are shuffled once.
    lines = lines.join(open_ids, lines["repairs"] == open_ids["reject_id"], "left_semi").distinct()
    folder = f"repaired/load={max([_last_merged(spark, warehouse), *_loads(warehouse)]) + 1}"
    rows = typed_lines(lines, timestamp_pattern, "repairs").withColumn("rejected", F.col("reject_reason").isNotNull())
    rows.write.mode("overwrite").partitionBy("rejected").parquet(f"{warehouse.root}/{folder}")
    if not warehouse.names_in(folder):
        # Written without looking first whether there is anything: that would work out all lines twice.
        warehouse.remove(folder)
    return _merge_pending(spark, warehouse)


def merge_new_files(
    spark: SparkSession,
    warehouse: Warehouse,
    landing: str,
    timestamp_pattern: str | None = None,
    multi_line: bool = False,
) -> RunResult | None:
    """Stage what is new in the landing folder and merge all loads that no run has merged yet.

    A load is what one call has staged, numbered after all earlier ones. Loads are merged one
    by one in that order, each by a run of its own, so the latest delivery of a transaction wins
    whether or not an earlier call has failed. A load is noted as merged after its run is published;
    should the note be lost, the next call merges the load once more before any later one, which
    changes nothing. Nothing new gives None; else the last run, with the rows and months of all.
    """
    load = max([_last_merged(spark, warehouse), *_loads(warehouse)]) + 1
    stage_new_files(spark, landing, f"{warehouse.root}/staging", load, timestamp_pattern, multi_line)
    return _merge_pending(spark, warehouse)


_NOTED = T.StructType([T.StructField("load", T.LongType())])


def _last_merged(spark: SparkSession, warehouse: Warehouse) -> int:
    notes = f"{warehouse.root}/merged_loads"
    typed_row(spark, _NOTED, None).write.mode("ignore").parquet(notes)
    return spark.read.schema(_NOTED).parquet(notes).agg(F.coalesce(F.max("load"), F.lit(0))).first()[0]


def _merge_pending(spark: SparkSession, warehouse: Warehouse) -> RunResult | None:
    merged = _last_merged(spark, warehouse)
    again = _repaired(spark, warehouse)
    good, _ = split_staged(typed_row(spark, _REPAIRED, None) if again is None else again, "load")
    good = good.filter(F.col("load") > merged)
    if warehouse.exists("staging"):
        good = good.unionByName(staged_since(spark, f"{warehouse.root}/staging", merged)[0])
    # One row for each call that has staged rows since the last merge.
    pending = sorted(r["load"] for r in good.select("load").distinct().collect())
    total = None
    for load in pending:
        result = run_etl(warehouse, good.filter(F.col("load") == load).drop("load"))
        spark.range(load, load + 1).select(F.col("id").alias("load")).write.mode("append").parquet(f"{warehouse.root}/merged_loads")
        if total is not None:
            result = RunResult(result.run, total.rows_processed + result.rows_processed, total.months | result.months)
        total = result
    return total
