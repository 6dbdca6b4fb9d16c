from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import csv_files, large_files
from tidemark.sources.csv_files import entity_of, parse_files, with_file_identity
from tidemark.sources.large_files import ends_inside, parse_large_files


def _write(folder, files):
    for name, content in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())


def _parse(spark, folder):
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .option("recursiveFileLookup", True).load(str(folder)))
    return {r["path"].split("/")[-1]: r for r in parse_files(files).collect()}


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    _write(tmp_path, {
        "plain.csv": "a,b\n1,2\n",
        "swapped.csv": "b,extra,a\n2,e,1\n",
        "quoted.csv": 'a,b\r\n"x, y","say ""hi"""\r\n"two\nlines",é\r\n',
        "blank.csv": "a,b\n1,2\n\n3,4\n",
        "ragged.csv": "a,b\n,\n1\n1,2,3,4\n",
        "header.csv": "a,b\n",
        "notutf8.csv": b"a,b\n\xff,2\n",
        "loosecr.csv": "a,b\n1\r2,3\n",
        "upper.CSV": "a\n1\n", "other.txt": "a\n1\n",
    })
    found = _parse(spark, tmp_path)
    data = {n: json.loads(r["data"]) if r["data"] else None for n, r in found.items()}
    assert data == {
        "plain.csv": [{"a": "1", "b": "2"}],
        "swapped.csv": [{"b": "2", "extra": "e", "a": "1"}],
        "quoted.csv": [{"a": "x, y", "b": 'say "hi"'}, {"a": "two\nlines", "b": "é"}],
        "blank.csv": [{"a": "1", "b": "2"}, {"a": "3", "b": "4"}],
        "ragged.csv": [{"a": "", "b": ""}, {"a": "1", "b": None},
                       {"a": "1", "b": "2", "null": ["3", "4"]}],
        "header.csv": [], "notutf8.csv": None, "loosecr.csv": None,
    }
    assert "é" in found["quoted.csv"]["data"]
    assert found["notutf8.csv"]["error"].startswith("UnicodeDecodeError")
    assert found["loosecr.csv"]["error"].startswith("Error")


def test_only_leading_entity_folders_count(spark):
    paths = ["entity=customers/year=2026/c.csv", "entity=transactions/t.csv",
             "entity=other/x.csv", "x/entity=customers/c.csv", "entity=customers.csv",
             "ENTITY=customers/c.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r["e"] for r in df.select(entity_of(F.col("p")).alias("e")).collect()] == [
        "customers", "transactions", None, None, None, None]


def test_file_identity_follows_the_upload(spark):
    files = spark.createDataFrame([
        ("file:/l/entity=customers/c.csv", 1, 5), ("file:/l/entity=customers/c.csv", 2, 5)],
        "path string, t long, length long")
    files = files.withColumn("modificationTime", F.timestamp_micros("t"))
    first, second = with_file_identity(files, "file:/l").orderBy("t").collect()
    assert first["source_path"] == "entity=customers/c.csv" and first["source_file"] == "c.csv"
    assert first["entity"] == "customers" and first["audit_id"] != second["audit_id"]
    again = with_file_identity(files, "file:/l").orderBy("t").first()
    assert again["audit_id"] == first["audit_id"]


@pytest.mark.parametrize(("line", "from_outside", "from_inside"), [
    ("a,b", False, True), ('"a,b', True, False), ('a"b,c', False, False),
    ('"a ""b"",c', True, False), ('"a"x"b,"c', True, True), ('a,"b"', False, False),
    ('"', True, False), ('""', False, True), ('"",""', False, True), ("", False, True),
])
def test_quote_state_over_a_line(line, from_outside, from_inside):
    assert ends_inside(line, False) is from_outside
    assert ends_inside(line, True) is from_inside


def _random_csv(rng, rows):
    plain = ["x", "", "12.5", "Łódź", 'in"side', "tail "]
    quoted = ['"a,b"', '"two\nlines"', '"say ""hi"""', '"\n\n"', '"a"b', '"x\n""y"", z\n"', '""']
    lines = ["id,name,note"]
    for i in range(rows):
        fields = [str(i), *(rng.choice(plain if rng.random() < 0.6 else quoted) for _ in "ab")]
        if rng.random() < 0.1:
            fields = fields[:rng.randint(1, 2)] if rng.random() < 0.5 else [*fields, "more"]
        lines.append(",".join(fields))
        if rng.random() < 0.05:
            lines.append("")
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("split", [37, 200, 5000])
def test_large_files_parse_as_whole_ones_do(spark, tmp_path, split):
    rng = random.Random(split)
    whole = {f"f{i}.csv": _random_csv(rng, 60) for i in range(4)}
    whole["crlf.csv"] = whole["f0.csv"].replace("\n", "\r\n")
    whole["marked.csv"] = "﻿" + whole["f1.csv"]
    whole["odd [1]{a} ü%20+.csv"] = '"i\nd",name\n1,2\n3,4\n'
    _write(tmp_path, whole)
    _write(tmp_path, {"bad.csv": whole["f2.csv"].encode() + b"\n9,\xff,z\n",
                      "loose.csv": whole["f3.csv"].replace("12.5", "12\r5", 1)})
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                            "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        paths = [str(p) for p in tmp_path.glob("*.csv")]
        rows = parse_large_files(spark, paths, chunk_bytes=100).collect()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    found = {}
    for row in sorted(rows, key=lambda r: r["part"]):
        found.setdefault(row["path"].split("/")[-1], []).append(row)
    assert set(found) == {*whole, "bad.csv", "loose.csv"}
    for name, text in whole.items():
        assert all(r["error"] is None for r in found[name])
        records = [rec for r in found[name] for rec in json.loads(r["data"])]
        assert records == json.loads(csv_files.records_as_json(text)), name
        assert len({r["part"] for r in found[name]}) == len(found[name])
    assert len(found["f0.csv"]) > 3
    for name, kind in (("bad.csv", "UnicodeDecodeError"), ("loose.csv", "Error")):
        assert [(r["data"], r["error"].split(":")[0]) for r in found[name]] == [(None, kind)]


def test_fields_longer_than_the_parsers_own_limit(spark, tmp_path):
    _write(tmp_path, {"long.csv": "id,note\n1," + "x" * 300_000 + "\n2,y\n"})
    files = spark.read.format("binaryFile").load(str(tmp_path / "long.csv"))
    row = parse_files(files).first()
    assert row["error"] is None and row["records"] == 2
    assert len(json.loads(row["data"])[0]["note"]) == 300_000


def test_large_files_do_not_depend_on_how_they_are_cut(spark, tmp_path, monkeypatch):
    """Settings that change after the scan, as with a changing number of cores, lose no line."""
    text = "id,note\n" + "".join(f'{i},"a\nb ""{i}"""\n' for i in range(2000))
    _write(tmp_path, {"big.csv": text})
    written = large_files.materialized

    def changes_settings(df, folder=None):
        found = written(df, folder)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
        return found

    monkeypatch.setattr(large_files, "materialized", changes_settings)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = parse_large_files(spark, [str(tmp_path / "big.csv")], chunk_bytes=3000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    records = [r for row in sorted(rows, key=lambda r: r["part"]) for r in json.loads(row["data"])]
    assert records == json.loads(csv_files.records_as_json(text))
    assert sum(r["records"] for r in rows) == 2000


def test_records_of_a_whole_file_are_not_held_as_objects_at_once():
    import tracemalloc

    from tidemark.sources.csv_files import counted_records
    text = "a,b,c,d\n" + "".join(f"{i},x,y,\n" for i in range(100_000))  # 1.1 MB, as JSON 4.3 MB
    tracemalloc.start()
    try:
        data, count = counted_records(text)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert count == 100_000 and json.loads(data)[-1] == {"a": "99999", "b": "x", "c": "y", "d": ""}
    assert peak < 4 * len(data)  # with all records as objects, 6.5 times


def test_records_are_those_of_the_csv_module():
    import csv
    import io

    from tidemark.sources.csv_files import counted_records
    for text in ("", "a", "a,b\n", "a,b\n1\n\n2,3,4\r\n", 'a,a\r\n"x\n\ny",2', "a\r1\r2\n3\n",
                 "a,b\n ,\x85\n" * 1500, 'null,b\n1,2,3\n'):
        for header in (None, ["h", "a"]):
            try:
                rows = list(csv.DictReader(io.StringIO(text), fieldnames=header))
            except csv.Error:
                with pytest.raises(csv.Error):
                    counted_records(text, header)
                continue
            assert counted_records(text, header) == (json.dumps(rows, ensure_ascii=False),
                                                     len(rows))


def test_chunks_of_a_large_file_are_not_gathered_by_file(spark, tmp_path):
    _write(tmp_path, {"a.csv": "k,v\n" + "".join(f"{i},x\n" for i in range(2000)),
                      "b.csv": b"k,v\n1,\xff\n"})
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "-1")
    try:
        parsed = parse_large_files(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")],
                                   str(tmp_path / "scratch"), chunk_bytes=1000)
        plan = parsed._jdf.queryExecution().executedPlan().toString()
        found = {r["path"].rpartition("/")[2]: r["n"] for r in
                 parsed.groupBy("path").agg(F.sum("records").alias("n")).collect()}
    finally:
        spark.conf.unset(limit)
    assert "SortMergeJoin" not in plan and found == {"a.csv": 2000, "b.csv": 0}


def test_usual_records_become_json_without_an_object_each(monkeypatch):
    made = []
    dumps = json.dumps
    monkeypatch.setattr(csv_files.json, "dumps", lambda *a, **k: made.append(a) or dumps(*a, **k))
    text = 'a,%s,"q""é"\n' + "1,%d,\\x\n" * 5000 + '"two\nlines",,"\t"\n\n1,2\n1,2,3,4,5\n'
    data, count = csv_files.counted_records(text)
    rows = list(csv.DictReader(io.StringIO(text, newline="")))
    assert (data, count) == (dumps(rows, ensure_ascii=False), 5003)
    assert len(made) == 2  # the short and the long record


def test_each_landed_message_is_a_row_group_of_its_own(spark, tables, tmp_path):
    """Of a row group up to 4096 messages are held at once, and Parquet ends none before 100 rows."""
    import pyarrow.parquet as pq

    from tidemark.streaming import start_landing
    folder = tmp_path / "landing/entity=customers"
    _write(folder, {f"{i}.csv": "customer_id\n" + "C1\n" * 10 for i in range(3)})
    _write(folder, {"big.csv": "customer_id\n" + "C1\n" * 4000})
    start_landing(spark, str(tmp_path / "landing"), tables, str(tmp_path / "stream"),
                  inline_bytes=1000, after_batch=None).awaitTermination()
    footers = [pq.ParquetFile(f).metadata
               for f in (tmp_path / "tables/landing_events").rglob("*.parquet")]
    groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
    assert [g.num_rows for g in groups] == [1] * 4 == [1] * tables.read("landing_events").count()
    codecs = {g.column(i).compression for g in groups for i in range(g.num_columns)}
    assert codecs == {"ZSTD"}  # it streams


def test_tasks_that_chunk_large_files_follow_their_size(spark, tmp_path, monkeypatch):
    text = "id,note\n" + "".join(f'{i},"a\nb"\n' for i in range(4000))
    _write(tmp_path, {"a.csv": text, "b.csv": text})
    monkeypatch.setattr(large_files, "TASK_BYTES", 1000)
    rows = parse_large_files(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv")],
                             str(tmp_path / "scratch"), chunk_bytes=500).collect()
    for name in ("a.csv", "b.csv"):
        mine = sorted((r for r in rows if r["path"].endswith(name)), key=lambda r: r["part"])
        assert [x for r in mine for x in json.loads(r["data"])] == json.loads(
            csv_files.records_as_json(text))
    written = list((tmp_path / "scratch/chunks").glob("*.parquet"))
    assert len(written) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
