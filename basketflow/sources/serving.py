"""Publishing tables as keyed serving snapshots."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.config import ServingTable
from basketflow.session import delete_folder
from basketflow.sources.files import read_table, write_version
from basketflow.sources.keyed import check_key

POLICIES = ("SNAPSHOT", "TRIGGERED", "CONTINUOUS")
_NAME = re.compile(r"^[A-Za-z0-9_]+$")
# Rows of a written table whose key is looked at before the table is copied.
FIRST_ROWS = 1_000
_REPORT = "target string, success boolean, detail string"
_STATUS = "target string, exists boolean, source string, primary_key string, policy string, num_rows long"


def parse_target(target: str) -> tuple[str, str, str]:
    """catalog, schema and table of a full name; schema and table must be plain identifiers."""
    parts = target.split(".")
    if len(parts) != 3:
        raise ValueError(f"expected catalog.schema.table, got {target!r}")
    for part in parts[1:]:
        if not _NAME.match(part):
            raise ValueError(f"only letters, digits and underscores are allowed in names, got {part!r}")
    return parts[0], parts[1], parts[2]


class ServingStore:
    """Serving tables of one catalog, as Spark tables under a shared folder.

    A target ``catalog.schema.table`` becomes the table ``<catalog>__<schema>.table``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _place(self, target: str) -> tuple[str, str]:
        catalog, schema, table = parse_target(target)
        database = f"{re.sub(r'[^A-Za-z0-9_]', '_', catalog)}__{schema}"
        return database, table

    def exists(self, target: str) -> bool:
        database, table = self._place(target)
        return self.spark.catalog.databaseExists(database) and self.spark.catalog.tableExists(f"{database}.{table}")

    def read(self, target: str) -> DataFrame:
        return self.spark.table(".".join(self._place(target)))

    def publish(
        self,
        source: DataFrame | str,
        target: str,
        primary_key: list[str] | None = None,
        skip_if_exists: bool = True,
        policy: str = "SNAPSHOT",
        create_database: bool = True,
    ) -> str:
        """Copy ``source`` to the serving table ``target`` and return "published" or "skipped".

        The snapshot is written once, into a folder of its own, and its key is checked there; then the
        table is pointed at it. After a ``KeyViolation`` the old snapshot is still served. A named source
        is written already, so that its first rows cost little: if the key fails in these, nothing is
        copied. An unknown policy counts as SNAPSHOT, as every policy starts with a full copy; a TRIGGERED
        or CONTINUOUS table goes on with ``streaming.publish.refresh_serving``.
        """
        keys = primary_key or ["id"]
        database, table = self._place(target)
        if skip_if_exists and self.exists(target):
            return "skipped"
        df = read_table(self.spark, source) if isinstance(source, str) else source
        if isinstance(source, str):
            check_key(df.limit(FIRST_ROWS), keys)
        if create_database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{database}'")
        folder = f"{self.root}/{database}/{table}"
        write_version(df, f"`{database}`.`{table}`", folder, lambda rows: check_key(rows, keys))
        kept = policy.upper() if policy.upper() in POLICIES else POLICIES[0]
        origin = source if isinstance(source, str) else ""
        self.spark.sql(
            f"ALTER TABLE `{database}`.`{table}` SET TBLPROPERTIES "
            f"('serving.key' = '{','.join(keys)}', 'serving.policy' = '{kept}', 'serving.source' = '{origin}')"
        )
        return "published"

    def publish_many(
        self,
        tables: list[ServingTable],
        sources: dict[str, DataFrame] | None = None,
        skip_if_exists: bool = True,
        policy: str = "SNAPSHOT",
    ) -> DataFrame:
        """Publish each configured table; one failing does not stop the others. One report row each."""
        report = []
        for t in tables:
            source = (sources or {}).get(t.source, t.source)
            try:
                detail = self.publish(source, t.target, t.primary_key, skip_if_exists, t.policy or policy)
                report.append((t.target, True, detail))
            except Exception as error:  # noqa: BLE001 - the report carries the reason
                report.append((t.target, False, f"{type(error).__name__}: {str(error).splitlines()[0]}"))
        return self.spark.createDataFrame(report, _REPORT)

    def status(self, targets: list[str]) -> DataFrame:
        """Existence, origin, key, policy and rows of each target."""
        rows = []
        for target in targets:
            if not self.exists(target):
                rows.append((target, False, None, None, None, None))
                continue
            name = ".".join(f"`{p}`" for p in self._place(target))
            found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            rows.append(
                (
                    target,
                    True,
                    found.get("serving.source") or None,
                    found.get("serving.key"),
                    found.get("serving.policy"),
                    self.read(target).count(),
                )
            )
        return self.spark.createDataFrame(rows, _STATUS)

    def drop(self, target: str) -> bool:
        """Remove a serving table; False if there was none."""
        if not self.exists(target):
            return False
        database, table = self._place(target)
        self.spark.sql(f"DROP TABLE `{database}`.`{table}`")
        delete_folder(self.spark, f"{self.root}/{database}/{table}")
        return True


def verify_tables(spark: SparkSession, tables: dict[str, DataFrame | str]) -> DataFrame:
    """Row count of every expected table in one job; raises and names the missing ones."""
    found, missing = {}, []
    for name, table in tables.items():
        try:
            df = read_table(spark, table) if isinstance(table, str) else table
            df.schema  # noqa: B018 - resolves the table now
            found[name] = df
        except Exception:  # noqa: BLE001
            missing.append(name)
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("table_name"), "num_rows")
        for name, df in found.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 16) -> None:
    """Copy a snapshot into an external database through at most ``writers`` connections."""
    df.repartition(writers).write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)
