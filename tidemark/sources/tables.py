"""The layered tables as Parquet folders, and the all-or-nothing change of them.

Spark writes every file where it stays: each write is a ``run=`` folder of its own below its table. A
version, one small JSON file, names the folders that make up each table, and the files in them that an
upsert has replaced. A :class:`Run` writes its folders and then names them in the next version; that one new file
is the switch. Readers take the newest version, so they see all tables before a run or after it,
whatever happens in between, and folders of a run that was cut off belong to no table. Nothing is
moved, and nothing needs to be recovered. One writer at a time for each table.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from datetime import UTC, datetime, timedelta
from itertools import batched

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.upsert import find_matches, newest_per_key, rows_to_write, survivors
from tidemark.schemas import LAYOUTS
from tidemark.session import materialized, utc_session
from tidemark.sources.csv_files import literal_paths
from tidemark.sources.storage import Storage

#: A batch of up to this many keys is looked up by the keys themselves, which Parquet's Bloom filters
#: and dictionaries answer for each row group; of a larger one only the range of its keys is.
LOOKUP_KEYS = 10_000
#: Spark hands Parquet a list of keys as a chain of "or", one in the other, which Parquet follows by
#: recursion. Chains of this length are joined as a balanced tree, so that it never goes deep.
CHAINED_KEYS = 64
#: How long replaced files are kept for readers that have opened an older version.
KEPT_HOURS = 72

_RUN = StructField("run", StringType())
_publishing: dict[str, threading.Lock] = defaultdict(threading.Lock)


def _columns_sql(layout_name: str, types: bool) -> str:
    columns = []
    for field in LAYOUTS[layout_name].stored:
        kind = f" {field.dataType.simpleString()}" if types else ""
        default = " DEFAULT current_timestamp()" if types and field.name == "_processed_at" else ""
        comment = field.metadata.get("comment", "derived, for partition pruning")
        columns.append(f"`{field.name}`{kind}{default} COMMENT '{comment}'")
    return ", ".join(columns)


def create_table_sql(table: str, layout_name: str, location: str) -> str:
    """The DDL of a table, with its column descriptions and its partitions."""
    layout = LAYOUTS[layout_name]
    parts = f" PARTITIONED BY ({', '.join(layout.partitions)})" if layout.partitions else ""
    return (f"CREATE TABLE IF NOT EXISTS {table} ({_columns_sql(layout_name, True)}) "
            f"USING parquet{parts} LOCATION '{location}'")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Tables:
    """The tables below one root folder. Opening them creates the root folder, nothing else.

    With ``version`` all reads are of that version, else of the newest one at the time of the read.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark = utc_session(spark)
        self.storage = Storage(spark)
        self.root = self.storage.qualified(root)
        self.pinned = version
        self._shown: set[str] = set()  # tables offered as temporary views of this session
        self.storage.make_folder(f"{self.root}/versions")

    def version(self) -> int:
        """Number of the newest version, 0 before the first."""
        if self.pinned is not None:
            return self.pinned
        names = self.storage.children(f"{self.root}/versions")
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def state(self, version: int | None = None) -> dict:
        """What a version says: folders and dropped files by table, and the batches it holds."""
        version = self.version() if version is None else version
        found = {"folders": {}, "dropped": {}, "done": [], "database": None}
        if version:
            found |= json.loads(self.storage.read_text(f"{self.root}/versions/{version}.json"))
        return found

    def read(self, name: str, with_files: bool = False) -> DataFrame:
        """A table scan. ``with_files`` adds the file of each row, and its position in it.

        Dropped files are left out by their path, which Spark does when it lists files, so they
        are not opened.
        """
        state = self.state()
        stored = LAYOUTS[name].stored
        if not state["folders"].get(name):
            extra = [StructField("_file", StringType()), *StructType.fromDDL("_row bigint").fields]
            return self.spark.createDataFrame(
                [], StructType([*stored.fields, *(extra if with_files else [])]))
        table = self._scan(name, state)
        place = table.metadataColumn("_metadata")
        dropped = state["dropped"].get(name, [])
        if dropped:
            table = table.filter(~place["file_path"].isin(dropped))
        columns = [F.col(c) for c in stored.names]
        if with_files:
            columns += [place["file_path"].alias("_file"), place["row_index"].alias("_row")]
        return table.select(*columns)

    def files(self, name: str) -> list[str]:
        """The files that make up a table."""
        state = self.state()
        dropped = set(map(self.storage.from_uri, state["dropped"].get(name, [])))
        found = self._scan(name, state).inputFiles() if state["folders"].get(name) else []
        return [f for f in map(self.storage.from_uri, found) if f not in dropped]

    def _scan(self, name: str, state: dict) -> DataFrame:
        """All files in the folders of a table, the dropped ones, too."""
        folders = [f"{self.root}/{name}/{f}" for f in state["folders"][name]]
        return (self.spark.read.schema(StructType([*LAYOUTS[name].stored, _RUN]))
                .option("basePath", f"{self.root}/{name}").parquet(*literal_paths(folders)))

    def is_empty(self, name: str) -> bool:
        return not self.state()["folders"].get(name)

    def read_files(self, name: str, files: Sequence[str]) -> DataFrame:
        """Some files of a table, given by the ``_file`` of their rows."""
        return (self.spark.read.schema(StructType([*LAYOUTS[name].stored, _RUN]))
                .option("basePath", f"{self.root}/{name}")
                .parquet(*literal_paths(map(self.storage.from_uri, files))).drop(_RUN.name))

    def run(self, run_id: str | None = None) -> Run:
        return Run(self, run_id)

    def feed_id(self, checkpoint: str) -> str:
        """A name for a stream's batches that lasts as long as its checkpoint folder."""
        note = f"{checkpoint.rstrip('/')}/feed-id"
        if not self.storage.exists(note):
            self.storage.write_text(note, uuid.uuid4().hex)
        return self.storage.read_text(note)

    def landed(self, run_id: str) -> bool:
        return run_id in self.state()["done"]

    def publish(self, added: dict[str, list[str]], dropped: dict[str, list[str]],
                replaced: Iterable[str] = (), run_id: str | None = None) -> int:
        """The next version: the newest one with this change. Returns its number."""
        if self.pinned is not None:
            raise ValueError(f"version {self.pinned} cannot be changed")
        replaced = set(replaced)
        with _publishing[self.root]:  # jobs of one driver may end at the same time
            number, state = self.version() + 1, self.state()
            for name in replaced:
                state["folders"].pop(name, None)
                state["dropped"].pop(name, None)
            for name, folders in added.items():
                held = [f for f in folders if self.storage.has_data(f"{self.root}/{name}/{f}")]
                if held:
                    state["folders"][name] = [*state["folders"].get(name, []), *held]
            for name, files in dropped.items():
                state["dropped"][name] = [*state["dropped"].get(name, []), *files]
            if run_id:  # only the last batch of a feed can be repeated
                feed = run_id.rpartition("-")[0]
                last = [r for r in state["done"] if feed and r.rpartition("-")[0] == feed][-1:]
                state["done"] = [r for r in state["done"] if r in last or not feed
                                 or r.rpartition("-")[0] != feed] + [run_id]
            state["at"] = datetime.now(UTC).isoformat()
            self._write_version(number, state)
        for name in {*added, *dropped, *replaced}:
            if name in self._shown:
                self.spark.sql(self.view_sql(name, name, temporary=True))
            if state["database"]:
                self.spark.sql(self.view_sql(name, f"{state['database']}.{name}"))
        return number

    def _write_version(self, number: int, state: dict) -> None:
        target = f"{self.root}/versions/{number}.json"
        if self.storage.exists(target):
            raise RuntimeError(f"another writer has published version {number} of {self.root}")
        self.storage.write_text(target, json.dumps(state))

    def vacuum(self, hours: float = KEPT_HOURS) -> int:
        """Remove what no version of the last hours needs: replaced files, folders of runs that were
        cut off, old versions. Returns how many folders and files went."""
        since = datetime.now(UTC) - timedelta(hours=hours)
        with _publishing[self.root]:
            newest = self.version()
            names = self.storage.children(f"{self.root}/versions")
            numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
            states = {n: self.state(n) for n in numbers}
            # a version is in use until the time of the next one
            old = [n for n, after in zip(numbers, numbers[1:], strict=False)
                   if datetime.fromisoformat(states[after]["at"]) < since]
            kept = [states[n] for n in numbers if n not in old]
            gone = 0
            for name in LAYOUTS:
                live = {f for s in kept for f in s["folders"].get(name, ())}
                for folder in self.storage.children(f"{self.root}/{name}"):
                    begun = datetime.strptime(folder[4:19], "%Y%m%dT%H%M%S")
                    if folder not in live and begun.replace(tzinfo=UTC) < since:
                        self.storage.remove(f"{self.root}/{name}/{folder}", whole_folder=True)
                        gone += 1
            state = states.get(newest, {"dropped": {}})
            done = {}
            for name, files in state["dropped"].items():
                # dropped in all versions that are kept
                done[name] = [f for f in files if all(f in s["dropped"].get(name, ()) or not any(
                    f"/{g}/" in f for g in s["folders"].get(name, ())) for s in kept)]
                for file in done[name]:
                    self.storage.remove(self.storage.from_uri(file))
                gone += len(done[name])
            if any(done.values()):
                state["dropped"] = {n: [f for f in fs if f not in set(done[n])]
                                    for n, fs in state["dropped"].items()}
                state["at"] = datetime.now(UTC).isoformat()
                self._write_version(newest + 1, state)
            for number in old:
                self.storage.remove(f"{self.root}/versions/{number}.json")
        return gone

    def view_sql(self, name: str, view: str, temporary: bool = False) -> str:
        """SQL that makes a view of what a table is now, with the descriptions of its columns."""
        stored, state = LAYOUTS[name].stored, self.state()
        folders = state["folders"].get(name, [])
        if folders:
            columns = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                       for f in stored]
            runs = ", ".join(_quoted(f.removeprefix("run=")) for f in folders)
            body = f"FROM parquet.`{self.root}/{name}` WHERE run IN ({runs})"
            dropped = state["dropped"].get(name, [])
            if dropped:  # SQL has no way to the file's metadata beside a column _metadata
                inside = [_quoted(f.partition(f"/{name}/")[2]) for f in dropped]
                body += (f" AND substring_index(input_file_name(), '/{name}/', -1) "
                         f"NOT IN ({', '.join(inside)})")
        else:
            columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in stored]
            body = "WHERE FALSE"
        kind = "TEMPORARY VIEW" if temporary else "VIEW"
        return (f"CREATE OR REPLACE {kind} {view} ({_columns_sql(name, False)}) AS "
                f"SELECT {', '.join(columns)} {body}")

    def show(self, names: Iterable[str]) -> None:
        """Offer tables as temporary views of the session, renewed with each change made here."""
        for name in names:
            self._shown.add(name)
            self.spark.sql(self.view_sql(name, name, temporary=True))

    def register(self, database: str) -> None:
        """Offer the tables as views in the session's catalog, for all its sessions. Whoever changes
        a table renews its view; that is one change of the catalog, so the switch is one there, too."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        with _publishing[self.root]:
            number, state = self.version() + 1, self.state()
            if state["database"] != database:
                state |= {"database": database, "at": datetime.now(UTC).isoformat()}
                self._write_version(number, state)
        for name in LAYOUTS:
            self.spark.sql(self.view_sql(name, f"{database}.{name}"))


class Run:
    """One change of one or more tables that takes effect as a whole, at the end of its ``with``."""

    def __init__(self, tables: Tables, run_id: str | None = None):
        self.tables = tables
        self.run_id = run_id
        self.name = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        self._added: dict[str, list[str]] = {}
        self._dropped: dict[str, list[str]] = {}
        self._replaced: set[str] = set()
        self._written: list[tuple[str, str]] = []
        self._scratch = 0

    def add(self, name: str, rows: DataFrame, rebalance: bool = True) -> None:
        """Write rows for a table."""
        self.add_folder(name, self.write(name, rows, rebalance=rebalance))

    def _new_folder(self, name: str) -> str:
        """A folder below a table that this run alone writes."""
        self._written.append((name, f"run={self.name}-{len(self._written) + 1}"))
        return self._written[-1][1]

    def path(self, name: str, folder: str) -> str:
        return f"{self.tables.root}/{name}/{folder}"

    def adopt(self, name: str, written: str) -> None:
        """Make a written folder, in the table's partitions, a folder of a table, if it is there."""
        if self.tables.storage.exists(written):
            folder = self._new_folder(name)
            self.tables.storage.make_folder(f"{self.tables.root}/{name}")
            self.tables.storage.move(written, self.path(name, folder))
            self.add_folder(name, folder)

    def write(self, name: str, rows: DataFrame, extra: Sequence[str] = (),
              rebalance: bool = True) -> str:
        """Write rows in a table's layout without making them part of it; returns the folder.

        Rows are sorted by the clustering columns within each partition. Rebalancing gives files
        of even size: adaptive execution splits a heavy date over many tasks and joins small ones.
        Without it each task writes what it has.
        Keys get Bloom filters, by which an upsert finds the row groups that may hold its keys.
        """
        layout = LAYOUTS[name]
        derived = {c: F.expr(e) for c, (_, e) in layout.partitions.items()}
        rows = rows.select(*layout.schema.names, *extra).withColumns(derived)
        if layout.partitions and rebalance:
            rows = rows.hint("rebalance", *layout.partitions)
        if layout.cluster:
            rows = rows.sortWithinPartitions(*layout.partitions, *layout.cluster)
        folder = self._new_folder(name)
        writer = rows.write.partitionBy(*layout.partitions)
        if layout.key:
            writer = (writer.option(f"parquet.bloom.filter.enabled#{layout.key}", "true")
                      .option("parquet.bloom.filter.adaptive.enabled", "true"))
        writer.parquet(self.path(name, folder))
        return folder

    def add_folder(self, name: str, folder: str) -> None:
        """Register a folder below a table as rows of it. It may stay empty."""
        self._added.setdefault(name, []).append(folder)

    def drop(self, name: str, files: Iterable[str]) -> None:
        """Files, given by the ``_file`` of their rows, that are no longer part of a table."""
        self._dropped.setdefault(name, []).extend(files)

    def replace(self, name: str) -> None:
        """Nothing of a table stays but what this run adds."""
        self._replaced.add(name)

    def scratch(self, label: str) -> str:
        """A folder for intermediate rows, gone when the run has ended."""
        self._scratch += 1
        return f"{self.tables.root}/scratch/{self.name}/{label}-{self._scratch}"

    def __enter__(self) -> Run:
        return self

    def __exit__(self, failure: type[BaseException] | None, *_: object) -> None:
        tables = self.tables
        if failure is None and (self._added or self._dropped or self._replaced):
            tables.publish(self._added, self._dropped, self._replaced, self.run_id)
        else:
            for name, folder in self._written:
                tables.storage.remove(self.path(name, folder), whole_folder=True)
        if self._scratch:
            tables.storage.remove(f"{tables.root}/scratch/{self.name}", whole_folder=True)


def rows_that_may_match(tables: Tables, name: str, changes: DataFrame, key: str, version: str,
                        span) -> DataFrame:
    """Key, version and file of the table's rows that a batch may replace.

    A small batch is looked up by its keys: Spark hands them to Parquet, which skips the row groups
    whose statistics, dictionary or Bloom filter do not have them. A large batch is looked up
    by the range of its keys; its keys would be found in nearly every row group.
    """
    keys = tables.read(name, with_files=True).select(key, version, "_file")
    if span["rows"] > LOOKUP_KEYS:
        return keys.filter(F.col(key).between(F.lit(span["low"]), F.lit(span["high"])))
    wanted = [r[0] for r in changes.filter(F.col(key).isNotNull()).select(key).distinct().collect()]
    return keys.filter(_any_of(key, sorted(wanted)))


def _any_of(key: str, wanted: Sequence[str]) -> str:
    """SQL that ``key`` is in a list: as one list, which is quick for a row, and as a balanced tree
    of short ones for Parquet. As text, since columns made one by one take seconds for so many."""
    lists = [f"`{key}` IN ({', '.join(map(_quoted, some))})"
             for some in batched(wanted, CHAINED_KEYS)] or ["FALSE"]
    whole = f"`{key}` IN ({', '.join(map(_quoted, wanted))})" if wanted else "FALSE"
    while len(lists) > 1:
        lists = [f"({' OR '.join(pair)})" for pair in batched(lists, 2)]
    return f"{whole} AND {lists[0]}"


def merge_into(run: Run, name: str, source: DataFrame, key: str, version: str = "_ingested_at",
               newer: Sequence[Column] = (), on_duplicate: str = "error") -> int:
    """Stage the upsert of ``source`` into a table; returns the number of source rows kept.

    The batch is computed once and written in the table's layout, so that a batch of which every
    row takes effect, the usual case, is part of the table as it is. Of the table only key and
    version are read, see :func:`rows_that_may_match`. Full rows are read only from files that hold
    replaced rows.
    """
    tables = run.tables
    schema = LAYOUTS[name].schema
    batch = newest_per_key(source, key, version, newer, on_duplicate, schema.names)
    extra = [c for c in batch.columns if c not in schema.names]
    folder = run.write(name, batch, extra)
    marks = [batch.schema[c] for c in extra]
    changes = (tables.spark.read.schema(StructType([*LAYOUTS[name].stored, *marks]))
               .parquet(run.path(name, folder)))
    span = changes.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed"),
                       F.min(key).alias("low"), F.max(key).alias("high")).first()
    if not span["rows"]:
        return 0
    whole = not extra  # copies to insert need a look at every match
    if whole and (span["low"] is None or tables.is_empty(name)):
        run.add_folder(name, folder)
        return span["rows"]
    with pushed_keys(tables.spark):
        matches = materialized(
            find_matches(changes, rows_that_may_match(tables, name, changes, key, version, span),
                         key, version), run.scratch("matches"))
    found = matches.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_newer").alias("newer"),
                        F.count_distinct(key).alias("keys")).first()
    # as many names as Spark itself holds when it lists the table's files
    touched = [r["_file"] for r in matches.filter("_newer").select("_file").distinct().collect()]
    kept = (survivors(tables.read_files(name, touched).select(*schema.names), changes, key,
                      version) if touched else None)
    if whole and found["rows"] == found["newer"] == found["keys"]:
        run.add_folder(name, folder)
        if kept is not None:
            run.add(name, kept)
    else:
        if whole and not found["newer"] and found["keys"] == span["keyed"]:
            rows = changes.filter(F.col(key).isNull())  # no key is new or newer: nothing to join
        else:
            rows = rows_to_write(changes, matches, key)
        rows = rows.select(*schema.names)
        run.add(name, rows if kept is None else rows.unionByName(kept))
    run.drop(name, touched)
    return span["rows"]


class pushed_keys:
    """While open, lists of up to ``CHAINED_KEYS`` values reach Parquet as lists, not as ranges."""

    _SETTING = "spark.sql.parquet.pushdown.inFilterThreshold"

    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.before = self.conf.get(self._SETTING)
        self.conf.set(self._SETTING, str(CHAINED_KEYS))

    def __exit__(self, *_: object) -> None:
        self.conf.set(self._SETTING, self.before)


def replace_all(run: Run, name: str, rows: DataFrame) -> None:
    """Stage ``rows`` as the whole new content of a table."""
    run.add(name, rows)
    run.replace(name)
