"""Layers: Parquet folders, one per date, with the schema of all batches and a log of changes.

A layer is plain Parquet below its path, which any reader can read. Beside the dates a folder
``_layer`` holds what they do not tell: the union of the schemas of all batches, how far another
layer has been taken in, and the rows of recent publications.

A publication is written to a folder of its own first, so a job that fails leaves the layer as it
is. Then an intent is noted, the dates are exchanged, and the new state is stored; whoever opens
a layer with an intent carries it out to the end. One writer at a time is assumed."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.naming import column, quoted, same_name
from tidemark.functions.schemas import united
from tidemark.operators.incremental import Mark, read_mark
from tidemark.sources.files import discard, folders, move, path_exists, read_text, write_text
from tidemark.sources.readers import read_table

#: What Spark names the folder of NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: New rows, and old rows, to what is kept of both.
Merge = Callable[[DataFrame, DataFrame], DataFrame]

_META = "_layer"
_STREAMED = "_spark_metadata"


@dataclass(frozen=True)
class State:
    """What a layer knows about itself."""

    schema: StructType
    partition: str
    #: Publications so far.
    version: int = 0
    #: For each layer that rows came from, the last of its publications that was taken in.
    taken: tuple[tuple[str, int], ...] = ()

    def text(self) -> str:
        return json.dumps({"version": self.version, "partition": self.partition,
                           "taken": dict(self.taken), "schema": self.schema.jsonValue()})

    @classmethod
    def of(cls, text: str) -> State:
        held = json.loads(text)
        return cls(StructType.fromJson(held["schema"]), held["partition"], held["version"],
                   tuple(sorted(held["taken"].items())))


class Dated:
    """Something stored with one folder per date, the value of the column ``partition``."""

    partition: str

    def values(self) -> list[str]:
        """Dates that have a folder, as text, ascending, without NULL. No file is opened."""
        raise NotImplementedError

    def read(self) -> DataFrame:
        """All rows."""
        raise NotImplementedError

    def exists(self) -> bool:
        raise NotImplementedError

    def newest(self, name: str, days: int) -> Mark | None:
        """The largest ``name``, of which the partition column is the date; None if there is none.

        The folders say where to look: those within ``days`` of the newest one are read, and
        older ones only where these hold no value. Other files are not even opened."""
        dates = self.values() if self.exists() else []
        while dates:
            oldest = (date.fromisoformat(dates[-1]) - timedelta(days)).isoformat()
            near = [value for value in dates if value >= oldest]
            rows = self.read().where(column(self.partition).isin([date.fromisoformat(d) for d in near]))
            found = read_mark(rows.agg(F.max(column(name)).alias(name)))
            if found is not None:
                return found
            dates = dates[: -len(near)]
        return None


class Layer(Dated):
    """A layer at ``path``, with one folder per value of the column ``partition``."""

    def __init__(self, spark: SparkSession, path: str, partition: str) -> None:
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self._meta = f"{self.path}/{_META}"
        self._recover()

    # --- What is there ----------------------------------------------------------------------

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def state(self) -> State | None:
        """The stored state; None for a folder that something else has written."""
        text = read_text(self.spark, f"{self._meta}/state.json")
        return None if text is None else State.of(text)

    def values(self) -> list[str]:
        return _dates(folders(self.spark, self.path), self.partition)

    def read(self) -> DataFrame:
        """All rows, with the columns of all batches; rows of a batch that lacked one hold NULL.

        The stored schema saves opening files to find it. Folders without one, which another
        program wrote, are opened file by file, so that no column of any is missed."""
        state = self.state()
        if state is None:
            return self.spark.read.option("mergeSchema", "true").parquet(self.path)
        return self.spark.read.schema(state.schema).parquet(self.path)

    # --- What changed -----------------------------------------------------------------------

    def changes(self, after: int, merge: Merge | None = None) -> DataFrame | None:
        """Rows of the publications after number ``after``, or None where there are none. Where
        the log does not reach back so far, that is the whole layer. ``merge`` is what the
        publications were merged by: rows that a later one of them replaces are left out."""
        state = self.state()
        if state is None:
            return self.read() if self.exists() else None
        wanted = [f"{self._meta}/changes/{number}" for number in range(after + 1, state.version + 1)]
        if not wanted:
            return None
        if not all(path_exists(self.spark, path) for path in wanted):
            return self.read()
        frames = [self.spark.read.schema(state.schema).option("basePath", path).parquet(path) for path in wanted]
        rows = frames[0]
        for later in frames[1:]:
            rows = later.unionByName(rows) if merge is None else merge(later, rows)
        return rows

    def taken(self, source: Layer) -> int:
        """Number of the last publication of ``source`` that this layer took in, 0 for none."""
        state = self.state()
        return 0 if state is None else dict(state.taken).get(source.path, 0)

    # --- Publishing -------------------------------------------------------------------------

    def publish(self, rows: DataFrame, merge: Merge | None = None,
                prepare: Callable[[DataFrame], DataFrame] | None = None, log: int = 0,
                took: tuple[Layer, int] | None = None) -> bool:
        """Write ``rows`` once, then make them the layer; says whether there were any. Without
        a row the layer stays as it is.

        Without ``merge`` they take the place of all that was there. With it, only the dates they
        have rows for are written anew, with what ``merge`` makes of them and the old rows of
        these dates. The schema is united with the stored one then; a type that does not go with
        the stored one raises before anything is exchanged. ``prepare`` may bring rows together
        before they are written. The log keeps the rows of the last ``log`` publications. ``took``
        is stored with the rows, so that nothing is taken in twice or missed if a run breaks off."""
        if path_exists(self.spark, f"{self.path}/{_STREAMED}"):
            raise ValueError(f"a stream writes {self.path!r}; its readers would not see other files")
        fresh = f"{self._beside()}{uuid.uuid4().hex}"
        prepare = prepare or (lambda df: df)
        try:
            growing = merge is not None
            state = self._stored() if growing else None
            schema = rows.schema if state is None else united(state.schema, rows.schema, same_name(rows))
            self._write(rows if growing and state else prepare(rows), f"{fresh}/rows")
            dates = folders(self.spark, f"{fresh}/rows")
            if not dates:
                if took is not None and self.state() is not None:
                    self._store(replace(self.state(), taken=self._taken(took)))
                return False
            written = f"{fresh}/rows"
            if growing and state:
                new = self.spark.read.schema(schema).parquet(f"{fresh}/rows")
                old = self.spark.read.schema(schema).parquet(self.path)
                self._write(prepare(merge(new, old.where(self._among(dates)))), f"{fresh}/whole")
                written = f"{fresh}/whole"
            old = self.state()
            number = 1 + (old.version if old else 0)
            after = State(_last(schema, self.partition, same_name(rows)), self.partition, number, self._taken(took))
            self._intend({"fresh": fresh, "written": written, "dates": dates, "all": not growing,
                          "changes": f"{fresh}/rows" if growing and log else None, "log": log, "state": after.text()})
            return True
        finally:
            if read_text(self.spark, f"{self._meta}/intent.json") is None:
                discard(self.spark, fresh)

    def _beside(self) -> str:
        """Start of the names of this layer's unpublished folders, beside it. What a lost driver has
        left there without an intent is deleted, as there is one writer at a time."""
        root, _, name = self.path.rpartition("/")
        for left in folders(self.spark, root):
            if left[:-32] == f"_fresh-{name}-":
                discard(self.spark, f"{root}/{left}")
        return f"{root}/_fresh-{name}-"

    def register(self, schema: StructType) -> StructType:
        """Unite the stored schema with that of rows another writer, such as a stream, is about
        to add; returns the union."""
        state = self.state()
        whole = schema if state is None else united(state.schema, schema)
        self._store(State(_last(whole, self.partition, str.lower), self.partition) if state is None else replace(state, schema=whole))
        return whole

    def _write(self, rows: DataFrame, path: str, partition: str | None = None) -> None:
        rows.write.mode("errorifexists").partitionBy(partition or self.partition).parquet(path)

    def _among(self, names: Iterable[str]):
        """Rows of some partition folders, as a condition the listing is pruned by."""
        held = [unquote(name.partition("=")[2]) for name in names]
        some = column(self.partition).cast("string").isin([value for value in held if value != NULL_FOLDER])
        return some | column(self.partition).isNull() if NULL_FOLDER in held else some

    def _stored(self) -> State | None:
        """The state of a layer that has rows, from its files where nothing is stored."""
        state = self.state()
        if state is None and folders(self.spark, self.path):
            return State(self.read().schema, self.partition)
        return state

    def _taken(self, took: tuple[Layer, int] | None) -> tuple[tuple[str, int], ...]:
        state = self.state()
        held = dict(state.taken) if state else {}
        if took is not None:
            held[took[0].path] = took[1]
        return tuple(sorted(held.items()))

    def _store(self, state: State) -> None:
        write_text(self.spark, f"{self._meta}/state.json", state.text())

    def _intend(self, intent: dict) -> None:
        write_text(self.spark, f"{self._meta}/intent.json", json.dumps(intent))
        self._recover()

    def _recover(self) -> None:
        """Carry out the intent, if there is one. Each step can be done again."""
        text = read_text(self.spark, f"{self._meta}/intent.json")
        if text is None:
            return
        intent = json.loads(text)
        state = State.of(intent["state"])
        if intent["changes"]:
            # The rows as they came; where they are also the dates' rows, they are copied.
            target = f"{self._meta}/changes/{state.version}"
            if not path_exists(self.spark, target):
                if intent["changes"] == intent["written"]:
                    rows = self.spark.read.schema(state.schema).parquet(intent["changes"])
                    half = f"{intent['fresh']}/copy"
                    discard(self.spark, half)
                    self._write(rows, half, state.partition)
                    move(self.spark, half, target)
                else:
                    move(self.spark, intent["changes"], target)
        if intent["all"]:
            for name in folders(self.spark, self.path):
                if "=" in name and name not in intent["dates"]:
                    discard(self.spark, f"{self.path}/{name}")
            discard(self.spark, f"{self._meta}/changes")
        for name in intent["dates"]:
            source, target = f"{intent['written']}/{name}", f"{self.path}/{name}"
            if path_exists(self.spark, source):
                discard(self.spark, target)
                move(self.spark, source, target)
        for name in folders(self.spark, f"{self._meta}/changes"):
            if int(name) <= state.version - intent["log"]:
                discard(self.spark, f"{self._meta}/changes/{name}")
        self._store(state)
        discard(self.spark, intent["fresh"])
        discard(self.spark, f"{self._meta}/intent.json")


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of a layer, with the partition column found from its directories and the columns of
    all its batches. A ``schema`` overrides the stored one."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return Layer(spark, path, "").read()


class Table(Dated):
    """A table of the catalog, partitioned by the column ``partition``. Its name is qualified, so
    the session's current database neither matters nor changes."""

    def __init__(self, spark: SparkSession, name: str, partition: str, database: str | None = None) -> None:
        self.spark, self.partition = spark, partition
        self.name, self.database = name, database
        self.qualified = ".".join(map(quoted, [name] if database is None else [database, name]))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.qualified)

    def read(self) -> DataFrame:
        return read_table(self.spark, self.name, self.database)

    def dated(self) -> bool:
        """Whether the table is there, and partitioned by the date; a view is not."""
        return self.exists() and any(
            c.isPartition and c.name == self.partition for c in self.spark.catalog.listColumns(self.qualified)
        )

    def values(self) -> list[str]:
        found = self.spark.sql(f"SHOW PARTITIONS {self.qualified}").collect()
        return _dates((row[0] for row in found), self.partition)

    def append(self, rows: DataFrame) -> None:
        """Add ``rows``, and columns for what only they have. The table, and its database, are
        created if need be."""
        if self.database is not None:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.database)}")
        if not self.exists():
            rows.write.format("parquet").partitionBy(self.partition).saveAsTable(self.qualified)
            return
        key = same_name(rows)
        held = {key(field.name) for field in self.read().schema}
        more = [field for field in rows.schema if key(field.name) not in held]
        if more:
            columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in more)
            self.spark.sql(f"ALTER TABLE {self.qualified} ADD COLUMNS ({columns})")
        whole = rows.unionByName(self.read().limit(0), allowMissingColumns=True)
        whole.select(*map(column, self.read().columns)).write.insertInto(self.qualified)


def _dates(names: Iterable[str], partition: str) -> list[str]:
    found = (unquote(name.partition("=")[2]) for name in names if name.startswith(f"{partition}="))
    return sorted(value for value in found if value != NULL_FOLDER)


def _last(schema: StructType, name: str, key) -> StructType:
    """``schema`` with the field ``name`` at the end, where readers expect a partition column."""
    own = [field for field in schema if key(field.name) == key(name)]
    return StructType([field for field in schema if key(field.name) != key(name)] + own)
