"""Tables on a shared folder. Every run writes new directories; one new file publishes them.

    <root>/stores/run=3                              a whole dimension per run
    <root>/payment_methods/run=3
    <root>/daily_summary/run=3
    <root>/transactions/run=3/sales_month=2024-01    the rows a run wrote, by month
    <root>/replaced/run=3/sales_month=2024-01        ids of older rows that this run's rows replace
    <root>/manifest/0000000007-...                   what a version consists of, a row for each run and month
    <root>/commits/0000000007.json                   a version; the newest one is what readers see
    <root>/runs/3                                    a run number that is taken
    <root>/error_log, <root>/etl_audit               appended
    <root>/quarantine/run=3/reason=...               rows set aside; error_samples likewise

A reader follows the newest commit, so it sees all tables of a version or none. A month of the facts
is the union of its runs' directories, less the rows that later runs have replaced: those are subtracted
when a directory that has some is read, so a run never writes rows anew that it does not hold itself.
`compact` folds them in. The manifest has counts and dates of every directory, and readers open
those of the months they ask for.

Several writers may work at once. Each takes a run number of its own, so their directories never mix.
A commit file is created only where none of that version is, in one step, so of two writers that
started from one version exactly one publishes; the other gets a WriteConflict and may run again. A
failed run leaves directories that no commit names.
"""

import datetime as dt
import json
import uuid
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import schema as S
from tillworks.functions import month_of, text_key
from tillworks.functions.calendar import MONTH_COLUMN

# The month of a transaction without a date.
NO_MONTH = "undated"

_TABLES = {"error_log": S.ERROR_LOG, "etl_audit": S.ETL_AUDIT}
_DIMENSIONS = {
    "stores": S.STORES,
    "payment_methods": S.PAYMENT_METHODS,
    "daily_summary": S.DAILY_SUMMARY,
}
_SUSPECTS = ("quarantine", "error_samples")
# What a landing folder's loads leave next to the tables.
_LANDED = ("staging", "staging_progress", "merged_loads", "repaired")
_FACT = T.StructType(
    S.TRANSACTIONS.fields
    + [T.StructField("run", T.IntegerType()), T.StructField(MONTH_COLUMN, T.StringType())]
)
_REPLACED = T.StructType(
    [T.StructField("id", T.StringType())]
    + [T.StructField(n, T.IntegerType()) for n in ("of_run", "run")]
    + [T.StructField(MONTH_COLUMN, T.StringType())]
)


@dataclass(frozen=True)
class Part:
    """A directory of one run and month: facts, or ids of replaced ones; dead counts facts that no longer count."""

    kind: str
    sales_month: str
    run: int
    rows: int
    dead: int = 0
    first_date: dt.datetime | None = None
    last_date: dt.datetime | None = None


@dataclass(frozen=True)
class State:
    """What one version consists of: a run per dimension, and the directories of the facts.

    There is a part for each run and month, however many rows it has: a few thousand after years of days.
    """

    version: int = 0
    run: int = 0
    stores_run: int | None = None
    payment_methods_run: int | None = None
    daily_summary_run: int | None = None
    parts: tuple[Part, ...] = ()

    @property
    def month_runs(self) -> dict[str, list[int]]:
        """The runs that hold rows of each month."""
        runs: dict[str, list[int]] = {}
        for part in self.parts:
            if part.kind == "facts":
                runs.setdefault(part.sales_month, []).append(part.run)
        return {month: sorted(runs[month]) for month in sorted(runs)}


def typed_row(spark: SparkSession, declared: T.StructType, values: dict | None) -> DataFrame:
    """One row of the given values, or an empty table; built without Python workers."""
    rows = spark.range(0 if values is None else 1, numPartitions=1)
    values = values or {}
    return rows.select(
        *[_constant(values.get(f.name)).cast(f.dataType).alias(f.name) for f in declared.fields]
    )


def _constant(value) -> Column:
    if isinstance(value, dict):
        return F.create_map(*[_constant(x) for pair in value.items() for x in pair])
    if isinstance(value, list):
        return F.array(*[F.lit(x) for x in value])
    return value if isinstance(value, Column) else F.lit(value)


class WriteConflict(RuntimeError):
    """Another writer has published meanwhile."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, recreate: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        if recreate:
            self._clear()
        for name, table in _TABLES.items():
            typed_row(spark, table, None).write.mode("ignore").parquet(f"{self.root}/{name}")

    def _clear(self) -> None:
        """Remove every table of an earlier warehouse in this folder; run numbers start again.

        What the landing folder's loads have staged goes too, so its files are all read anew.
        """
        folders = ("transactions", "replaced", "manifest", "commits", "runs")
        for name in [*_TABLES, *_DIMENSIONS, *folders, *_SUSPECTS, *_LANDED]:
            fs, path = self._at(name)
            fs.delete(path, True)

    def _at(self, name: str):
        """The Hadoop file system and path of a file or folder of this warehouse."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def names_in(self, folder: str) -> list[str]:
        """Names in a folder, hidden ones left out; none if there is no such folder."""
        fs, path = self._at(folder)
        names = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
        return [name for name in names if name[0] not in "._"]

    def _create(self, name: str, content: str) -> bool:
        """Create a whole file in one step; False where it exists already."""
        jvm = self.spark.sparkContext._jvm
        folder, _, file = name.rpartition("/")
        fs, target = self._at(name)
        _, draft = self._at(f"{folder}/_{file}-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(content.encode())
        out.close()
        try:
            if fs.getUri().getScheme() == "file":
                # A local rename overwrites; a link to an existing name fails.
                paths = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
                jvm.java.nio.file.Files.createLink(*paths)
            else:
                files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
                rename = jvm.org.apache.hadoop.fs.Options.Rename
                keep = self.spark.sparkContext._gateway.new_array(rename, 1)
                keep[0] = rename.NONE
                files.rename(draft, target, keep)
        except Py4JJavaError as failure:
            if "FileAlreadyExists" in failure.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(draft, False)
        return True

    # -- reading ---------------------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_TABLES[name]).parquet(f"{self.root}/{name}")

    def published(self) -> DataFrame:
        """All commits, a row each."""
        if not self.names_in("commits"):
            return typed_row(self.spark, S.PUBLISHED, None)
        return self.spark.read.schema(S.PUBLISHED).json(f"{self.root}/commits")

    def state(self) -> State:
        commits = self.names_in("commits")
        if not commits:
            return State()
        fs, path = self._at(f"commits/{max(commits)}")
        stream = fs.open(path)
        try:
            told = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        manifest = self.spark.read.schema(S.MANIFEST).parquet(f"{self.root}/manifest/{told.pop('manifest')}")
        told.pop("published_at")
        return State(**told, parts=tuple(Part(**r.asDict()) for r in manifest.collect()))

    def snapshot(self) -> "Snapshot":
        """All tables as of the newest version: what a reader of several tables should use."""
        return Snapshot(self, self.state())

    def _dimension(self, name: str, run: int | None) -> DataFrame:
        if run is None:
            return typed_row(self.spark, _DIMENSIONS[name], None)
        return self.spark.read.schema(_DIMENSIONS[name]).parquet(f"{self.root}/{name}/run={run}")

    def stores(self, state: State | None = None) -> DataFrame:
        return self._dimension("stores", (state or self.state()).stores_run)

    def payment_methods(self, state: State | None = None) -> DataFrame:
        return self._dimension("payment_methods", (state or self.state()).payment_methods_run)

    def daily_summary(self, state: State | None = None) -> DataFrame:
        return self._dimension("daily_summary", (state or self.state()).daily_summary_run)

    def transactions(
        self, state: State | None = None, months: set[str] | None = None
    ) -> DataFrame:
        """The facts with their sales_month, of all months or of the given ones."""
        return self.located(state or self.state(), months).select(*S.TRANSACTION_COLUMNS, MONTH_COLUMN)

    def located(self, state: State, months: set[str] | None = None) -> DataFrame:
        """The facts with their sales_month and the run whose directory they are in.

        Only directories with replaced rows are compared with the ids of those.
        """
        parts = [p for p in state.parts if months is None or p.sales_month in months]
        facts = [p for p in parts if p.kind == "facts"]
        whole, worn = [p for p in facts if not p.dead], [p for p in facts if p.dead]
        rows = self._parts("transactions", whole or facts[:0], _FACT) if whole or not worn else None
        if worn:
            in_months = {p.sales_month for p in worn}
            gone = self._parts("replaced", [p for p in parts if p.kind == "replaced" and p.sales_month in in_months], _REPLACED)
            gone = gone.select("id", F.col("of_run").alias("run"), MONTH_COLUMN)
            older = self._parts("transactions", worn, _FACT).withColumn("id", text_key("transaction_id"))
            left = older.join(gone, ["id", "run", MONTH_COLUMN], "left_anti").select(*_FACT.fieldNames())
            rows = left if rows is None else rows.unionByName(left)
        return rows

    def _parts(self, name: str, parts: list[Part], declared: T.StructType) -> DataFrame:
        if not parts:
            return typed_row(self.spark, declared, None)
        paths = [f"{self.root}/{name}/run={p.run}/{MONTH_COLUMN}={p.sales_month}" for p in parts]
        return self.spark.read.schema(declared).option("basePath", f"{self.root}/{name}").parquet(*paths)

    # -- writing ---------------------------------------------------------------------------------

    def write_dimension(self, name: str, df: DataFrame, run: int) -> None:
        declared = _DIMENSIONS[name]
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])
        typed.write.mode("overwrite").parquet(f"{self.root}/{name}/run={run}")

    def write_months(self, df: DataFrame, run: int, mode: str = "overwrite") -> None:
        """Write facts by month, sorted by date in each file for min/max skipping.

        The rebalance brings a month together, splits it into files of the advisory size however
        large it is, and packs small months into one task.
        """
        (
            with_month(df)
            .hint("rebalance", MONTH_COLUMN)
            .sortWithinPartitions(MONTH_COLUMN, "transaction_date")
            .write.mode(mode)
            .partitionBy(MONTH_COLUMN)
            .parquet(f"{self.root}/transactions/run={run}")
        )

    def written(self, run: int) -> DataFrame:
        """What write_months wrote for this run, published or not."""
        declared = T.StructType(S.TRANSACTIONS.fields + [T.StructField(MONTH_COLUMN, T.StringType())])
        return self.spark.read.schema(declared).parquet(f"{self.root}/transactions/run={run}")

    def parts_written(self, run: int) -> list[Part]:
        """The directories that write_months wrote for this run, one for each month, with their counts."""
        # Counted on the written rows: an accumulator would count a retried task twice.
        date = F.col("transaction_date")
        by_month = self.written(run).groupBy(MONTH_COLUMN).agg(F.count("*").alias("n"), F.min(date).alias("lo"), F.max(date).alias("hi"))
        return [Part("facts", r[MONTH_COLUMN], run, r["n"], 0, r["lo"], r["hi"]) for r in by_month.collect()]

    def replace_rows(self, state: State, rows: DataFrame, run: int) -> State:
        """The state in which the given rows (id, of_run, sales_month) of older runs no longer count.

        Their ids are written next to the run's own rows. A directory all of whose rows are replaced
        leaves the state, and so do the lists of a month whose directories have nothing replaced left.
        """
        path = f"{self.root}/replaced/run={run}"
        columns = rows.select(F.col("id").cast("string"), F.col("of_run").cast("int"), MONTH_COLUMN)
        columns.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path)
        declared = T.StructType([f for f in _REPLACED.fields if f.name != "run"])
        counts = self.spark.read.schema(declared).parquet(path).groupBy(MONTH_COLUMN, "of_run").count()
        # One row for each directory that loses rows.
        lost = {(r[MONTH_COLUMN], r["of_run"]): r["count"] for r in counts.collect()}
        parts = [replace(p, dead=p.dead + lost.get((p.sales_month, p.run), 0)) if p.kind == "facts" else p for p in state.parts]
        months: dict[str, int] = {}
        for (month, _), n in lost.items():
            months[month] = months.get(month, 0) + n
        parts += [Part("replaced", month, run, n) for month, n in sorted(months.items())]
        parts = [p for p in parts if p.kind != "facts" or p.dead < p.rows]
        worn = {p.sales_month for p in parts if p.kind == "facts" and p.dead}
        return replace(state, parts=tuple(p for p in parts if p.kind == "facts" or p.sales_month in worn))

    def write_suspects(self, name: str, df: DataFrame, run: int) -> None:
        df.write.mode("overwrite").partitionBy("reason").parquet(f"{self.root}/{name}/run={run}")

    def suspects(self, name: str) -> DataFrame:
        """Quarantined or sampled rows of all published runs, with their `run` and `reason`."""
        declared = T.StructType(
            S.RAW.fields
            + ([T.StructField("sample", T.IntegerType())] if name == "error_samples" else [])
            + [T.StructField("run", T.IntegerType()), T.StructField("reason", T.StringType())]
        )
        if not self.exists(name):
            return typed_row(self.spark, declared, None)
        rows = self.spark.read.schema(declared).parquet(f"{self.root}/{name}")
        return rows.join(self.published().select("run"), "run", "left_semi").select(*declared.fieldNames())

    def exists(self, name: str) -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def remove(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def new_run(self) -> int:
        """A run number that no other writer has or will get."""
        number = max([0, *map(int, self.names_in("runs"))]) + 1
        while not self._create(f"runs/{number}", ""):
            number += 1
        return number

    def publish(self, state: State) -> None:
        """Commit: from here on, readers see this state as the version after the one it was read from.

        If another writer has published that version, even at the same moment, this is a WriteConflict
        and nothing changes for readers.
        """
        version = state.version + 1
        manifest = f"{version:010d}-{uuid.uuid4().hex[:8]}"
        rows = [tuple(vars(part).values()) for part in state.parts]
        self.spark.createDataFrame(rows, S.MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest/{manifest}")
        told = {name: value for name, value in vars(state).items() if name != "parts"}
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="milliseconds")
        content = told | {"version": version, "published_at": now, "manifest": manifest}
        if not self._create(f"commits/{version:010d}.json", json.dumps(content)):
            raise WriteConflict(f"version {version} is published already")

    def append_log(self, name: str, id_column: str, time_column: str, values: dict) -> None:
        """Append one row to a log with the next id and the current time."""
        last = self.table(name).agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
        stamped = values | {id_column: last + 1, time_column: F.localtimestamp()}
        typed_row(self.spark, _TABLES[name], stamped).write.mode("append").parquet(f"{self.root}/{name}")


@dataclass(frozen=True)
class Snapshot:
    """The tables of one published version, whatever is published later."""

    warehouse: Warehouse
    state: State

    def stores(self) -> DataFrame:
        return self.warehouse.stores(self.state)

    def payment_methods(self) -> DataFrame:
        return self.warehouse.payment_methods(self.state)

    def daily_summary(self) -> DataFrame:
        return self.warehouse.daily_summary(self.state)

    def transactions(self, months: set[str] | None = None) -> DataFrame:
        return self.warehouse.transactions(self.state, months)


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(
        MONTH_COLUMN, F.coalesce(month_of("transaction_date"), F.lit(NO_MONTH))
    )
