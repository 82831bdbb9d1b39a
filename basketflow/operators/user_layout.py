"""Transactions and users stored by user, so that histories and the users' attributes need no shuffle.

Rows of quiet users and the users themselves are bucketed tables with as many buckets of the same key: windows by user
and the join with users go on from the files as they are. Rows of busy users (and those without a user) would fill one
bucket, so they are a table of their own without buckets; their history is added up by second and day as always.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketflow.operators.history import MAX_USER_ROWS, history_columns, keyed_users, of_busy, of_quiet, set_apart, with_user_second
from basketflow.operators.joins import broadcast_if_small
from basketflow.operators.ordering import MAX_GROUP_ROWS
from basketflow.settings import Scoring
from basketflow.shared import exists

KEYS = ["user_key", "event_sec"]
_LAYOUT = "buckets int, n_busy long, n_users long, quiet_schema string, users_schema string"


@dataclass(frozen=True)
class UserLayout:
    """Stored tables under ``path``. A layout is written as a whole; days that come later go to ``HistoryStore``.

    Spark reads buckets only of tables it has a name for, so an open layout holds names in the session's current
    database until it is closed. The files do not depend on them.
    """

    quiet: DataFrame
    busy: DataFrame
    users: DataFrame
    names: tuple[str, str]
    n_busy: int
    n_users: int

    @staticmethod
    def write(
        spark: SparkSession, path: str, dated: DataFrame, users: DataFrame, buckets: int | None = None, max_user_rows: int = MAX_USER_ROWS
    ) -> UserLayout:
        """Store transactions that have a ``transaction_date``, and users with ``user_id`` and columns to attach.

        ``buckets`` (as many as shuffle partitions) should be such that one holds some hundred MB. Each is one file
        of either table, sorted by user and second. Users with more than ``max_user_rows`` rows are busy. Nothing may be
        stored under ``path`` yet; what a failed write left there is not a layout and must be removed first.
        """
        if exists(spark, path):
            raise FileExistsError(path)
        parts = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        few, many = set_apart(with_user_second(dated), max_user_rows)
        _write_buckets(few, f"{path}/quiet", parts, [*KEYS, "transaction_id"])
        seen = Observation()
        (few.limit(0) if many is None else many).observe(seen, F.count("*").alias("n")).write.parquet(f"{path}/busy")
        known = Observation()
        attached = [name for name in users.columns if name != "user_id"]
        attributes = keyed_users(users, attached)
        _write_buckets(attributes.observe(known, F.count("*").alias("n")), f"{path}/users", parts, ["user_key"])
        stored = [(parts, seen.get["n"], known.get["n"], few.schema.json(), attributes.schema.json())]
        # comes last: a layout without it was not finished
        spark.createDataFrame(stored, _LAYOUT).coalesce(1).write.parquet(f"{path}/layout")
        return UserLayout.open(spark, path)

    @staticmethod
    def open(spark: SparkSession, path: str) -> UserLayout:
        """A layout that this or another session has written."""
        stored = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first()
        of = {part: StructType.fromJson(json.loads(stored[f"{part}_schema"])) for part in ("quiet", "users")}
        names = tuple(_named(spark, f"{path}/{part}", schema, stored["buckets"]) for part, schema in of.items())
        quiet, users = map(spark.table, names)
        busy = spark.read.schema(of["quiet"]).parquet(f"{path}/busy").select(*quiet.columns)
        return UserLayout(quiet, busy, users, names, stored["n_busy"], stored["n_users"])

    def close(self) -> None:
        """Give the names back; frames of this layout cannot be read any more, the files stay."""
        for name in self.names:
            self.quiet.sparkSession.sql(f"drop table if exists `{name}`")

    def history(self, scoring: Scoring = Scoring(), broadcast: bool = False, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
        """The columns of ``with_history`` with the users' own, for all stored transactions.

        ``broadcast`` sends users to the transactions if there are few of them; their number is known.
        """
        own = [name for name in self.quiet.columns if name not in KEYS]
        attached = [name for name in self.users.columns if name != "user_key"]
        users = broadcast_if_small(self.users, broadcast, rows=self.n_users)
        past = of_quiet(self.quiet, scoring.window_days, users)
        if self.n_busy:
            past = past.unionByName(of_busy(self.busy, scoring.window_days, max_group_rows, users))
        return history_columns(past, own, scoring, attached)


def _write_buckets(rows: DataFrame, path: str, buckets: int, order: list[str]) -> None:
    """One file a bucket, as rows are dealt to tasks by the rule that deals them to buckets."""
    spark, name = rows.sparkSession, _new_name()
    dealt = rows.repartition(buckets, "user_key")
    dealt.write.bucketBy(buckets, "user_key").sortBy(*order).option("path", path).saveAsTable(name)
    spark.sql(f"drop table `{name}`")  # the files stay, as the path is given


def _named(spark: SparkSession, path: str, schema: StructType, buckets: int) -> str:
    name = _new_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("'", "\\'")
    spark.sql(f"create table `{name}` ({columns}) using parquet clustered by (user_key) into {buckets} buckets location '{location}'")
    return name


def _new_name() -> str:
    return f"by_user_{uuid.uuid4().hex}"
