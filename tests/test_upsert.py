from __future__ import annotations

import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import newest_per_key, upsert
from tidemark.schemas import LAYOUTS
from tidemark.sources.storage import Storage
from tidemark.sources.tables import Tables, merge_into

BASE = datetime(2026, 3, 1, tzinfo=UTC)
SCHEMA = "k string, v string, _ingested_at timestamp"


def _at(day):
    return None if day is None else BASE + timedelta(days=day)


def _frame(spark, rows):
    return spark.createDataFrame([(k, v, _at(d)) for k, v, d in rows], SCHEMA)


def _bag(df, columns=("k", "v", "_ingested_at")):
    micros = [F.unix_micros(c).alias(c) if c == "_ingested_at" else F.col(c) for c in columns]
    day = 86_400_000_000
    start = int(BASE.timestamp()) * 1_000_000
    return Counter(
        tuple((x - start) // day if c == "_ingested_at" and x is not None else x
              for c, x in zip(columns, r, strict=True)) for r in df.select(*micros).collect())


def _newer(a, b):
    return a is not None and b is not None and a > b


def model(target, source):
    """The upsert, row by row, for a source with one row per key."""
    by_key = {k: (k, v, d) for k, v, d in source if k is not None}
    known = {k for k, _, _ in target if k is not None}
    out = Counter()
    for row in target:
        new = by_key.get(row[0]) if row[0] is not None else None
        out[new if new and _newer(new[2], row[2]) else row] += 1
    for row in source:
        if row[0] is None or row[0] not in known:
            out[row] += 1
    return out


TARGET = [("a", "old", 1), ("b", "old", 5), ("c", "old", 3), ("n", "no version", None),
          ("d", "twice", 1), ("d", "twice newer", 9), (None, "no key", 1)]
SOURCE = [("a", "new", 2), ("b", "older", 4), ("c", "equal", 3), ("n", "new", 9),
          ("d", "new", 5), ("e", "insert", 1), ("f", "no version", None),
          (None, "no key", 2), (None, "no key", 2)]


def test_upsert_rules(spark):
    found = _bag(upsert(_frame(spark, TARGET), _frame(spark, SOURCE), "k"))
    assert found == model(TARGET, SOURCE)
    assert found[("a", "new", 2)] and found[("b", "old", 5)] and found[("c", "old", 3)]
    assert found[("n", "no version", None)] and found[("d", "new", 5)]
    assert found[("d", "twice newer", 9)] and found[(None, "no key", 2)] == 2


def test_rerun_changes_nothing(spark):
    source = [r for r in SOURCE if r[0] is not None]
    once = upsert(_frame(spark, TARGET), _frame(spark, source), "k")
    again = upsert(once, _frame(spark, source), "k")
    assert _bag(again) == _bag(once)


def test_newest_version_of_a_batch_wins(spark):
    source = [("a", f"v{d}", d) for d in (3, 7, 5, None)] + [("b", "only", None)]
    rows = _bag(newest_per_key(_frame(spark, source), "k"))
    assert rows == Counter({("a", "v7", 7): 1, ("b", "only", None): 1})
    tied = _frame(spark, [("a", "x", 3), ("a", "y", 3)])
    assert _bag(newest_per_key(tied, "k", newer=[F.col("v")])) == Counter({("a", "y", 3): 1})


def test_duplicates_within_a_file(spark):
    twice = _frame(spark, [("a", "x", 3), ("a", "x", 3), ("b", "y", 1)])
    with pytest.raises(Exception, match="duplicate k in one file: a"):
        newest_per_key(twice, "k").collect()
    with pytest.raises(Exception, match="duplicate k in one file: a"):
        newest_per_key(twice, "k").count()
    with pytest.raises(ValueError):
        newest_per_key(twice, "k", on_duplicate="drop")
    # An older duplicate is superseded together with its copy.
    fine = _frame(spark, [("a", "x", 3), ("a", "x", 3), ("a", "z", 4)])
    assert _bag(newest_per_key(fine, "k")) == Counter({("a", "z", 4): 1})


def test_only_the_highest_rows_are_shuffled_and_without_copies_of_their_rank(spark):
    rows = [("a", "x", 3), ("a", "y", 3), ("a", "z", None), (None, "n", 1), (None, "n", 1),
            ("b", None, None)]
    source = _frame(spark, rows).withColumn("_nested", F.struct(F.col("v").alias("of")))
    best = newest_per_key(source, "k", newer=[F.col("_nested.of")])
    assert _bag(best) == Counter({("a", "y", 3): 1, (None, "n", 1): 2, ("b", None, None): 1})
    plan = best._jdf.queryExecution().executedPlan().toString()
    # an aggregate of structs sorts and shuffles each row with its rank beside it, twice
    assert plan.count("WindowGroupLimit") == 2 and "Aggregate" not in plan


def test_duplicates_can_be_inserted_but_not_update(spark):
    twice = _frame(spark, [("a", "x", 3), ("a", "y", 3), ("b", "z", 1), (None, "n", 1)])
    empty = _frame(spark, [])
    assert _bag(upsert(empty, twice, "k", on_duplicate="insert")) == Counter(
        {("a", "x", 3): 1, ("a", "y", 3): 1, ("b", "z", 1): 1, (None, "n", 1): 1})
    kept = upsert(_frame(spark, [("a", "t", 3)]), twice, "k", on_duplicate="insert")
    assert _bag(kept) == Counter({("a", "t", 3): 1, ("b", "z", 1): 1, (None, "n", 1): 1})
    with pytest.raises(Exception, match="several source rows update one row: a"):
        upsert(_frame(spark, [("a", "t", 1)]), twice, "k", on_duplicate="insert").collect()


@pytest.mark.parametrize("seed", range(3))
def test_random_upserts(spark, seed):
    rng = random.Random(seed)

    def rows(count, keys):
        return [(rng.choice(keys), rng.choice("xyz"), rng.choice([None, *range(6)]))
                for _ in range(count)]

    keys = [None, *(f"k{i}" for i in range(15))]
    target = rows(40, keys)
    source = list({r[0] or i: r for i, r in enumerate(rows(30, keys))}.values())
    assert _bag(upsert(_frame(spark, target), _frame(spark, source), "k")) == model(target, source)


# The same rules through the table writer.

NAME, KEY = "silver_customers", "customer_id"


def _customers(spark, rows):
    schema = LAYOUTS[NAME].schema
    made = [(k, v, "mail", _at(d), BASE, ("audit", "m", "customers", "f", "p", BASE))
            for k, v, d in rows]
    return spark.createDataFrame(made, schema)


def _merge(spark, tables, rows, **options):
    with tables.run() as run:
        return merge_into(run, NAME, _customers(spark, rows), KEY, **options)


def _stored(tables):
    return _bag(tables.read(NAME), ("customer_id", "customer_name", "_ingested_at"))


def test_table_merge_follows_the_same_rules(spark, tables):
    with tables.run() as run:
        run.add(NAME, _customers(spark, TARGET))
    assert _stored(tables) == Counter(TARGET)
    assert _merge(spark, tables, SOURCE) == len(SOURCE)
    assert _stored(tables) == model(TARGET, SOURCE)
    before = set(tables.files(NAME))
    _merge(spark, tables, [r for r in SOURCE if r[0] is not None])
    assert _stored(tables) == model(TARGET, SOURCE)
    assert before <= set(tables.files(NAME))


def test_updated_rows_move_to_their_new_partition(spark, tables):
    _merge(spark, tables, [("a", "old", 1), ("b", "old", 2)])
    untouched = {f for f in tables.files(NAME) if "2026-03-03" in f}
    assert len(untouched) == 1
    _merge(spark, tables, [("a", "new", 4)])
    assert _stored(tables) == Counter({("a", "new", 4): 1, ("b", "old", 2): 1})
    files = set(tables.files(NAME))
    assert untouched <= files and not [f for f in files if "2026-03-02" in f]
    days = {str(r[0]) for r in tables.read(NAME).select("_ingested_date").distinct().collect()}
    assert days == {"2026-03-03", "2026-03-05"}


def test_table_merge_duplicates(spark, tables):
    twice = [("a", "x", 3), ("a", "y", 3), ("b", "z", 1)]
    with pytest.raises(Exception, match="duplicate customer_id in one file"):
        _merge(spark, tables, twice)
    assert tables.storage.children(f"{tables.root}/{NAME}") == []
    _merge(spark, tables, twice, on_duplicate="insert")
    assert _stored(tables) == Counter(twice)
    _merge(spark, tables, twice, on_duplicate="insert")
    assert _stored(tables) == Counter(twice)
    _merge(spark, tables, [("a", "new", 9)])
    assert _stored(tables) == Counter({("a", "new", 9): 2, ("b", "z", 1): 1})


@pytest.mark.parametrize("seed", range(2))
def test_random_table_merges(spark, tables, seed):
    rng = random.Random(seed)
    state = Counter()
    for step in range(3):
        source = [(f"k{rng.randrange(8)}", f"s{step}", rng.choice([None, *range(5)]))
                  for _ in range(6)]
        source = [*{r[0]: r for r in source}.values(), (None, f"s{step}", step)]
        _merge(spark, tables, source)
        state = model(list(state.elements()), source)
        assert _stored(tables) == state


def test_readers_see_a_change_whole(spark, tables, monkeypatch):
    old = Counter({("a", "old", 1): 1, ("b", "old", 2): 1, ("c", "old", 3): 1})
    new = Counter({("a", "new", 5): 1, ("b", "old", 2): 1, ("c", "old", 3): 1, ("d", "new", 6): 1})
    _merge(spark, tables, list(old))
    changes = [("a", "new", 5), ("d", "new", 6)]
    opened = tables.read(NAME)  # before the change, read after it
    write_text = Storage.write_text

    def gone(self, name, text):
        assert _stored(Tables(spark, tables.root)) == old  # all files are written, none counts
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(Storage, "write_text", gone)
        with pytest.raises(OSError):
            _merge(spark, tables, changes)
    reopened = Tables(spark, tables.root)
    assert _stored(reopened) == old and reopened.version() == 1

    def unnamed(self, name, text):  # the version is written but not named before the driver is lost
        write_text(self, f"{name}.part", text)
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(Storage, "write_text", unnamed)
        with pytest.raises(OSError):
            _merge(spark, tables, changes)
    assert _stored(Tables(spark, tables.root)) == old
    _merge(spark, reopened, changes)
    assert _stored(reopened) == new
    assert _bag(opened, ("customer_id", "customer_name", "_ingested_at")) == old
    assert _stored(Tables(spark, tables.root, version=1)) == old
    with pytest.raises(ValueError, match="version 1"):
        _merge(spark, Tables(spark, tables.root, version=1), changes)
    # what is no longer needed goes when it is old enough
    assert tables.vacuum() == 0
    assert tables.vacuum(hours=0) > 0 and _stored(tables) == new
    folders = tables.storage.children(f"{tables.root}/{NAME}")
    assert set(tables.state()["folders"][NAME]) == set(folders)
    assert not tables.state()["dropped"][NAME]
    assert tables.storage.children(f"{tables.root}/versions")[-1] == f"{tables.version()}.json"


def test_changes_of_several_tables_take_effect_together(spark, tables):
    rows = _customers(spark, [("a", "x", 1)])
    with pytest.raises(RuntimeError):
        with tables.run() as run:
            run.add(NAME, rows)
            run.add("gold_transactions", spark.createDataFrame([], LAYOUTS[
                "gold_transactions"].schema))
            raise RuntimeError("stop")
    assert tables.version() == 0 and tables.storage.children(f"{tables.root}/{NAME}") == []


def _rows_read(df):
    """Rows that the scans of a query gave, after skipping row groups."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plans = [leaves.apply(i) for i in range(leaves.size())]
    plans = [p.plan() if "QueryStage" in p.getClass().getSimpleName() else p for p in plans]
    return sum(p.metrics().apply("numOutputRows").value() for p in plans
               if p.metrics().contains("numOutputRows"))


def test_a_batch_of_random_ids_opens_only_row_groups_that_may_hold_them(spark, tables):
    from tidemark.sources.tables import pushed_keys, rows_that_may_match

    def rows(start, count):
        return spark.range(start, start + count).select(
            F.md5(F.col("id").cast("string")).alias("customer_id"), F.lit("n").alias("customer_name"),
            F.lit("m").alias("customer_email"), F.lit(BASE).alias("_ingested_at"),
            F.lit(BASE).alias("_processed_at"),
            F.lit(None).cast(LAYOUTS[NAME].schema["_metadata"].dataType).alias("_metadata"))

    for part in range(6):  # all key ranges overlap: only the Bloom filters tell the parts apart
        with tables.run() as run:
            run.add(NAME, rows(part * 5000, 5000).coalesce(1))
    ids = ["17", "4711", "29999", "no such"]
    changes = rows(0, 1).drop("customer_id").crossJoin(spark.createDataFrame(
        [(i,) for i in ids], "id string").select(F.md5("id").alias("customer_id")))
    span = {"rows": len(ids), "low": None, "high": None}
    with pushed_keys(spark):
        found = rows_that_may_match(tables, NAME, changes, KEY, "_ingested_at", span)
        assert found.count() == 3
        assert 0 < _rows_read(found) <= 3 * 5000
    assert _merge(spark, tables, [(spark.range(1).select(F.md5(F.lit("17"))).first()[0], "new", 9)])
    assert tables.read(NAME).count() == 30_000
    assert tables.read(NAME).filter("customer_name = 'new'").count() == 1


def test_a_batch_of_many_keys_is_looked_up_without_deep_recursion(spark, tables):
    from tidemark.sources.tables import LOOKUP_KEYS

    def batch(name, version):
        return _customers(spark, [(f"k{i}", name, version) for i in range(LOOKUP_KEYS)])

    with tables.run() as run:
        run.add(NAME, batch("old", 1))
    with tables.run() as run:  # one list of this many keys overflows the stack of Parquet's reader
        assert merge_into(run, NAME, batch("new", 2), KEY) == LOOKUP_KEYS
    assert tables.read(NAME).filter("customer_name = 'new'").count() == LOOKUP_KEYS
    assert tables.read(NAME).count() == LOOKUP_KEYS


def test_a_batch_that_changes_nothing_is_not_joined_again(spark, tables, monkeypatch):
    import tidemark.sources.tables as module

    _merge(spark, tables, [("a", "x", 5), ("b", "x", 5), (None, "k", 1)])

    def joined(*_):
        raise AssertionError("joined")

    with monkeypatch.context() as closed:
        closed.setattr(module, "rows_to_write", joined)
        _merge(spark, tables, [("a", "y", 5), ("b", "y", 4), (None, "l", 2)])
    state = {("a", "x", 5): 1, ("b", "x", 5): 1, (None, "k", 1): 1, (None, "l", 2): 1}
    assert _stored(tables) == Counter(state)
    _merge(spark, tables, [("a", "y", 5), ("c", "y", 1)])
    assert _stored(tables) == Counter(state | {("c", "y", 1): 1})


def test_a_heavy_date_is_written_by_many_tasks(spark, tables):
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("customer_id"), F.md5(F.col("id").cast("string"))
        .alias("customer_name"), F.lit("m").alias("customer_email"),
        F.lit(BASE).alias("_ingested_at"), F.lit(BASE).alias("_processed_at"),
        F.lit(None).cast(LAYOUTS[NAME].schema["_metadata"].dataType).alias("_metadata"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "1m")
    try:
        with tables.run() as run:
            run.add(NAME, rows)
    finally:
        spark.conf.unset(size)
    files = tables.files(NAME)
    assert len(files) > 3 and all("_ingested_date=2026-03-01" in f for f in files)
    assert tables.read(NAME).count() == 200_000
