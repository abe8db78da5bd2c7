"""Registered model versions as a table in the shared store, and aliases that move by compare-and-set.

A version is a folder of fitted tables and one row (name, version, kind, metrics, path). An alias is a
log of moves; its last row says which version it names. Rows are claimed by renaming a folder that
already holds them to the next number, which succeeds once: whoever finds another's row under the
number has lost. That needs a store whose renames are atomic (HDFS, mounted and local folders); on an
object store put the root on one of these. Rows are small and only grow by registrations and moves.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators import contexts, recommend
from basketflow.plans.scoring import Model
from basketflow.session import delete_folder, file_text, list_folder, rename_folder, write_text

VERSION_ROW = (
    "model_name string, version int, kind string, path string, columns array<string>, params map<string,string>, "
    "metrics map<string,double>, registered_at timestamp"
)
ALIAS_ROW = "model_name string, alias string, number int, version int, reason string, moved_at timestamp"

Tables = dict[str, DataFrame]
Predictor = Callable[[Tables, Tables, dict[str, str], DataFrame], DataFrame]


def _next_item(tables: Tables, sources: Tables, params: dict[str, str], customers: DataFrame) -> DataFrame:
    lists = recommend.next_item_recommend(sources["purchases"], tables["followers"])
    return customers.join(lists, "customer_id")


def _contexts(tables: Tables, sources: Tables, params: dict[str, str], customers: DataFrame) -> DataFrame:
    lists = contexts.sequence_recommend(sources["purchases"], tables)
    return customers.join(lists, "customer_id")


# How a model of each kind is applied: its tables, the job's sources, its parameters, the customers.
PREDICTORS: dict[str, Predictor] = {
    "popularity": lambda t, s, p, c: recommend.popularity_predict(c, t["ranked"], int(p.get("top_k", 12))),
    "age_rules": lambda t, s, p, c: recommend.age_rules_predict(c, t["ranked"], keep_empty=True),
    "next_item": _next_item,
    "contexts": _contexts,
}


class AliasMoved(RuntimeError):
    """The alias does not name the version its mover has seen."""


def _number(n: int) -> str:
    return f"{n:06d}"


def _plain(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise ValueError(f"only letters, digits, dashes and underscores are allowed in names, got {name!r}")
    return name


class ModelRegistry:
    """All registered versions and aliases under one folder of the shared store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def register(
        self,
        name: str,
        kind: str,
        tables: Tables,
        columns: tuple[str, ...] = ("customer_id",),
        params: dict[str, str] | None = None,
        metrics: dict[str, float] | None = None,
    ) -> int:
        """Write a model's tables and give it the next version number of its name."""
        path = f"{self.root}/tables/{_plain(name)}/{uuid.uuid4().hex}"
        for part, df in tables.items():
            df.write.parquet(f"{path}/{part}")
        row = {
            "model_name": name,
            "kind": kind,
            "path": path,
            "columns": list(columns),
            "params": params or {},
            "metrics": metrics or {},
            "registered_at": _now(),
        }
        folder = f"{self.root}/versions/{name}"
        while True:
            version = self._last(folder) + 1
            if self._claim(f"{folder}/{_number(version)}", {**row, "version": version}):
                return version

    def versions(self) -> DataFrame:
        return self._rows("versions/*/*", VERSION_ROW)

    def moves(self) -> DataFrame:
        """Every move of every alias, in the order of ``number`` per alias."""
        return self._rows("aliases/*/*/*", ALIAS_ROW)

    def aliases(self) -> DataFrame:
        """The current version of each alias."""
        latest = self.moves().groupBy("model_name", F.lower("alias").alias("key"))
        row = F.max_by(F.struct("alias", "version", "number", "moved_at"), "number").alias("row")
        return latest.agg(row).select("model_name", "row.*")

    def table(self) -> DataFrame:
        """One row per version, with the aliases that name it."""
        named = self.aliases().groupBy("model_name", "version").agg(F.sort_array(F.collect_list("alias")).alias("aliases"))
        return self.versions().join(named, ["model_name", "version"], "left").withColumn(
            "aliases", F.coalesce("aliases", F.array().cast("array<string>"))
        )

    def current(self, name: str, alias: str) -> int | None:
        """The version an alias names, in any case of letters."""
        return self._current(name, alias)[1]

    def set_alias(self, name: str, alias: str, version: int, expected: int | None, reason: str = "") -> None:
        """Let the alias name ``version`` if it names ``expected`` now; else ``AliasMoved``, and nothing is changed."""
        if not list_folder(self.spark, f"{self.root}/versions/{_plain(name)}/{_number(version)}"):
            raise LookupError(f"{name} has no version {version}")
        number, now = self._current(name, alias)
        row = {
            "model_name": name,
            "alias": alias,
            "number": number + 1,
            "version": version,
            "reason": reason,
            "moved_at": _now(),
        }
        if now != expected or not self._claim(f"{self._alias(name, alias)}/{_number(number + 1)}", row):
            raise AliasMoved(f"{alias} of {name} names version {self.current(name, alias)}, not {expected}")

    def model(self, name: str, version: int, sources: Tables | None = None, alias: str | None = None) -> Model:
        """A version ready to predict; its tables are read when it is applied."""
        row = json.loads(file_text(self.spark, f"{self.root}/versions/{_plain(name)}/{_number(version)}/row.json"))
        return self._model(row, sources or {}, alias)

    def models(self, sources: Tables | None = None) -> list[Model]:
        """All versions with the aliases they have, for ``batch_scoring``; one entry per alias."""
        rows = self.table().orderBy("model_name", "version").collect()
        return [self._model(r.asDict(), sources or {}, a) for r in rows for a in (r["aliases"] or [None])]

    def _model(self, row: dict, sources: Tables, alias: str | None) -> Model:
        predict = partial(self._predict, row, sources)
        return Model(row["model_name"], str(row["version"]), alias, predict, tuple(row["columns"]))

    def _predict(self, row: dict, sources: Tables, customers: DataFrame) -> DataFrame:
        if row["kind"] not in PREDICTORS:
            raise LookupError(f"nothing is known about models of the kind {row['kind']!r}")
        parts = list_folder(self.spark, row["path"])
        tables = {part: self.spark.read.parquet(f"{row['path']}/{part}") for part in parts}
        return PREDICTORS[row["kind"]](tables, sources, row["params"] or {}, customers)

    def _alias(self, name: str, alias: str) -> str:
        return f"{self.root}/aliases/{_plain(name)}/{_plain(alias).lower()}"

    def _current(self, name: str, alias: str) -> tuple[int, int | None]:
        number = self._last(self._alias(name, alias))
        if not number:
            return 0, None
        return number, json.loads(file_text(self.spark, f"{self._alias(name, alias)}/{_number(number)}/row.json"))["version"]

    def _last(self, folder: str) -> int:
        return max((int(n) for n in list_folder(self.spark, folder) if n.isdigit()), default=0)

    def _rows(self, pattern: str, schema: str) -> DataFrame:
        if not list_folder(self.spark, f"{self.root}/{pattern.split('/')[0]}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.root}/{pattern}/row.json")

    def _claim(self, place: str, row: dict) -> bool:
        """Put a row in its place, if no other is there."""
        token = uuid.uuid4().hex
        staged = f"{self.root}/staged/{token}"
        write_text(self.spark, f"{staged}/row.json", json.dumps({**row, "token": token}))
        rename_folder(self.spark, staged, place)
        won = json.loads(file_text(self.spark, f"{place}/row.json"))["token"] == token
        if not won:
            # Renaming onto a folder leaves the staged one where it is, or inside the other.
            delete_folder(self.spark, staged)
            delete_folder(self.spark, f"{place}/{token}")
        return won


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
