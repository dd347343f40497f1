"""Staged publication: tables below one root whose readers see a run's changes in one step.

A run writes every table to a folder of its own and counts rows while it writes
(an ``Observation`` in the writing job). Staged rows are counted again from the
stored files; only if both agree may the run be published. Publishing appends one
small file to the manifest, which maps each part (one value of the partition
columns) of each table to the folder that holds it. Readers follow the manifest:
they see all tables of a run, or none, and never a part twice. Parts that a run
does not cover stay as they are; a covered part without rows becomes empty.

Folders of replaced parts stay until :meth:`Publication.superseded` is acted on,
so readers that began before a publication finish on what they began with. Runs
that publish at the same time are ordered by version, then time, then run id.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.sources.tables import union_tables
from tripmill.sources.writers import observed, write_partitioned

MANIFEST = (
    "version bigint, run_id string, table_name string, part string, folder string, rows bigint, schema string, published_at timestamp"
)
#: Part of rows whose partition column is null (the name that partitioned writers give it).
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class PublicationError(ValueError):
    """Staged rows differ from the rows that were written."""


def new_run_id() -> str:
    return f"r{uuid.uuid4().hex}"


def part_name(partition: Sequence[str]) -> Column:
    """The folder of a row's partition values, as partitioned writers name it; values must not need escaping."""
    texts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PART))) for c in partition]
    return F.concat_ws("/", *texts)


@dataclass(frozen=True)
class Staged:
    """A table of a run, stored but not visible; ``observed`` was counted by the writing job."""

    table: str
    run_id: str
    partition: tuple[str, ...]
    schema: T.StructType
    observed: dict = field(hash=False)

    @property
    def folder(self) -> str:
        return f"{self.table}/run={self.run_id}"


class Publication:
    """The published tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(self._manifest)

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    def stage(
        self,
        df: DataFrame,
        table: str,
        run_id: str,
        partition: Sequence[str],
        cluster: Sequence[str] = (),
        measures: Mapping[str, Column] | None = None,
        spread: bool = True,
    ) -> Staged:
        """Store a table of a run and count its rows, and any ``measures``, in the same job.

        Staging again under the same run id replaces what the run stored before.
        Without ``spread`` rows are not shuffled: they lie by partition value already.
        """
        seen, measures = Observation(f"{table}-{run_id}"), {"rows": F.count(F.lit(1)), **(measures or {})}
        staged = Staged(table, run_id, tuple(partition), df.schema, {})
        counted = df.observe(seen, *[column.alias(name) for name, column in measures.items()])
        write_partitioned(counted, f"{self.root}/{staged.folder}", partition, cluster, replace="all", spread=spread)
        staged.observed.update(observed(seen, df, measures))
        if staged.observed["rows"] != self.staged(staged).count():
            # a task that ran again after a lost executor counts its rows again
            staged.observed.update(df.agg(*[column.alias(name) for name, column in measures.items()]).first().asDict())
        return staged

    def staged(self, staged: Staged) -> DataFrame:
        """The rows of a staged table."""
        return self.spark.read.schema(staged.schema).parquet(f"{self.root}/{staged.folder}")

    def _parts(self, staged: Staged) -> DataFrame:
        """One row per part of a staged table, counted from the stored files without reading a data column."""
        counted = self.staged(staged).groupBy(part_name(staged.partition).alias("part")).agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.lit(staged.table).alias("table_name"), "part", F.lit(staged.folder).alias("folder"), "rows", F.lit(staged.schema.json()).alias("schema"))

    def publish(self, staged: Sequence[Staged], scope: Sequence[str]) -> int:
        """Make the staged tables of one run visible together; returns the version.

        ``scope`` lists the parts that the run covers: those without staged rows
        become empty. Raises, and changes nothing, if a table holds other rows than
        were counted while it was written.
        """
        if len({s.run_id for s in staged}) != 1:
            raise ValueError("the tables of one publication belong to one run")
        found = [row.asDict() for s in staged for row in self._parts(s).collect()]  # one row per part and table
        stored = {s.table: sum(r["rows"] for r in found if r["table_name"] == s.table) for s in staged}
        wrong = {s.table: (s.observed["rows"], stored[s.table]) for s in staged if s.observed["rows"] != stored[s.table]}
        if wrong:
            raise PublicationError(f"rows written and rows stored differ: {wrong}")
        held = {(r["table_name"], r["part"]) for r in found}
        found += [
            {"table_name": s.table, "part": p, "folder": None, "rows": 0, "schema": s.schema.json()} for s in staged for p in scope if (s.table, p) not in held
        ]
        version = 1 + (self._history().agg(F.max("version")).first()[0] or 0)
        rows = self.spark.createDataFrame([tuple(r[c] for c in ("table_name", "part", "folder", "rows", "schema")) for r in found], "table_name string, part string, folder string, rows bigint, schema string")
        entry = rows.select(F.lit(version).cast("long").alias("version"), F.lit(staged[0].run_id).alias("run_id"), *rows.columns, F.current_timestamp().alias("published_at"))
        entry.coalesce(1).write.mode("append").parquet(self._manifest)  # one file: seen whole or not at all
        return version

    def _history(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(self._manifest)

    def live(self) -> DataFrame:
        """The current row of each part of each table; ``folder`` is null where a run emptied it."""
        order = F.struct("version", "published_at", "run_id")
        current = self._history().groupBy("table_name", "part").agg(F.max_by(F.struct("version", "run_id", "folder", "rows", "schema"), order).alias("_now"))
        return current.select("table_name", "part", "_now.*")

    def read(self, table: str, parts: Sequence[str] | None = None) -> DataFrame:
        """The published rows of a table, or of some of its parts, with the columns of the newest run."""
        schema, stored = self._stored(table)
        return self._rows(table, schema, [path for part, (path, _) in stored.items() if path and (parts is None or part in parts)])

    def read_apart(self, table: str, groups: Sequence[Sequence[str]], rows_per_task: int) -> DataFrame:
        """The rows of groups of parts, each group in tasks of its own that read about ``rows_per_task`` rows; nothing is shuffled."""
        schema, stored = self._stored(table)
        frames = []
        for group in groups:
            held = [stored[part] for part in group if stored[part][0]]
            tasks = -(-sum(rows for _, rows in held) // rows_per_task)
            # two at least: frames of a single task each would be united in a single task
            frames.append(self._rows(table, schema, [path for path, _ in held]).coalesce(max(2, tasks)))
        return union_tables(frames)

    def _stored(self, table: str) -> tuple[T.StructType, dict[str, tuple[str | None, int]]]:
        """The columns of the newest run, and folder (None: emptied) and rows of each part."""
        own = self.live().where(F.col("table_name") == table)
        rows = own.select("part", "folder", "version", "schema", "rows").collect()  # one row per part
        if not rows:
            raise ValueError(f"nothing is published as {table} below {self.root}")
        schema = T.StructType.fromJson(_json(max(rows, key=lambda r: r["version"])["schema"]))
        return schema, {r["part"]: (r["folder"] and f"{self.root}/{r['folder']}/{r['part']}", r["rows"]) for r in rows}

    def _rows(self, table: str, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*schema.fieldNames())

    def superseded(self) -> DataFrame:
        """Stored parts that no reader of the current manifest needs: table_name, part, folder."""
        live = self.live().where(F.col("folder").isNotNull()).select("table_name", "part", "folder")
        return self._history().where(F.col("folder").isNotNull()).select("table_name", "part", "folder").distinct().join(live, ["table_name", "part", "folder"], "left_anti")


def _json(text: str) -> dict:
    import json

    return json.loads(text)
