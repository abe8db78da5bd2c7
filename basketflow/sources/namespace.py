"""Environment-qualified names and their databases."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Schema prefix per environment.
SCHEMA_PREFIX = {"dev": "", "staging": "staging_", "prod": "prod_"}


@dataclass(frozen=True)
class Namespace:
    """Full table names of one environment; source tables are shared by all environments."""

    catalog: str
    schema: str
    environment: str = "dev"

    @property
    def qualified_schema(self) -> str:
        return SCHEMA_PREFIX[self.environment] + self.schema

    def table(self, name: str) -> str:
        return f"{self.catalog}.{self.qualified_schema}.{name}"

    def source(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"


def ensure_namespace(spark: SparkSession, schema: str, location: str | None = None) -> bool:
    """Create the database if it is missing; True if it was created."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", schema):
        raise ValueError(f"not a database name: {schema!r}")
    if spark.catalog.databaseExists(schema):
        return False
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{place}")
    return True
