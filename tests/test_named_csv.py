"""CSV by header: other orders, fewer and more columns, odd headers, large files, replays."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from lustra.sources.named_csv import NamedCsv

SCHEMA = (
    T.StructType()
    .add("The ID", T.IntegerType())
    .add("Full  Name", T.StringType())
    .add("paid", T.DoubleType())
    .add("day", T.DateType())
)


def ingest(spark, tmp_path, files: dict[str, str], **options):
    landing = tmp_path / "landing"
    landing.mkdir(exist_ok=True)
    for name, text in files.items():
        (landing / name).write_text(text, encoding="utf-8", newline="")
    table = NamedCsv(str(tmp_path / "bronze"), options.pop("schema", SCHEMA), **options)
    table.start(spark, str(landing), str(tmp_path / "cp")).awaitTermination()
    return table


def shown(table, spark):
    rows = table.read(spark).collect()
    return sorted(
        (
            (r.the_id, r.full_name, r.paid, str(r.day) if r.day else None, r.misfit_line, r.rescued_values)
            for r in rows
        ),
        key=str,
    )


def test_other_order_fewer_and_more_columns(spark, tmp_path):
    files = {
        "a.csv": "The ID,Full Name,Paid,Day\n1,ann,1.5,2024-01-02\n2,\"b, \"\"c\"\"\",,\n",
        "b.csv": "﻿ DAY ,paid, the_id,FULL  NAME\r\n2024-03-04,2,3,dee\r\n",
        "c.csv": "full name,the id\ne e,4\n\n",
        "d.csv": "the_id,Shoe Size,full_name,paid,day,hat\n5,44,f,3,2024-05-06,\n6,,g,4,,x\n",
    }
    table = ingest(spark, tmp_path, files, files_per_batch=3)
    d = json.dumps
    assert shown(table, spark) == sorted(
        [
            (1, "ann", 1.5, "2024-01-02", None, None),
            (2, 'b, "c"', None, None, None, None),
            (3, "dee", 2.0, "2024-03-04", None, None),
            (4, "e e", None, None, None, None),
            (5, "f", 3.0, "2024-05-06", None, d({"shoe_size": "44"}, separators=(",", ":"))),
            (6, "g", 4.0, None, None, d({"hat": "x"}, separators=(",", ":"))),
        ],
        key=str,
    )


def test_misfits_are_kept_and_no_file_fails(spark, tmp_path):
    files = {
        "short.csv": "the_id,full_name,paid\n1,a\n2,b,3\n",
        "long.csv": "full_name,the_id\na,1,2,3,4,5,6,7,8\nb,2\n",
        "type.csv": "paid,the_id\nmuch,1\n\"1,5\",2\n 3,x\n",
        "twice.csv": "the_id,paid,The ID\n1,2.5,3\n",
        "torn.csv": "the_id,full_name\n1,\"open\n2,fine\n",
        "again.csv": "the_id,full_name\n1,a\nthe_id,full_name\n2,b\n",
        "nothing.csv": "",
        "header.csv": "the_id,full_name\n",
        "strange.csv": "colour\nred\n",
    }
    rows = shown(ingest(spark, tmp_path, files), spark)
    fits = [r for r in rows if r[4] is None]
    assert fits == sorted(
        [
            (2, "b", 3.0, None, None, None),
            (2, "b", None, None, None, None),
            (2, "fine", None, None, None, None),
            (1, "a", None, None, None, None),
            (2, "b", None, None, None, None),
            (None, None, None, None, None, '{"colour":"red"}'),
        ],
        key=str,
    )
    misfits = {r[4] for r in rows if r[4] is not None}
    assert misfits == {"1,a", "a,1,2,3,4,5,6,7,8", "much,1", '"1,5",2', " 3,x", "1,2.5,3", '1,"open'}


def test_header_reaches_every_block_of_a_file(spark, tmp_path):
    """A file cut into many blocks, among small files that share a task."""
    n = 20_000
    files = {
        "big.csv": "full_name,the_id\n" + "".join(f"name {i},{i}\n" for i in range(n)),
        "small.csv": "the_id,full_name\n-1,one\n",
        "tiny.csv": "paid,the_id\n1,-2\n",
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        table = ingest(spark, tmp_path, files)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = table.read(spark)
    assert rows.filter("misfit_line IS NOT NULL").count() == 0
    assert rows.filter("full_name = concat('name ', the_id)").count() == n
    assert rows.count() == n + 2


def test_files_are_ingested_once_and_batches_replay(spark, tmp_path):
    table = ingest(spark, tmp_path, {"a.csv": "the_id\n1\n"})
    ingest(spark, tmp_path, {"b.csv": "full_name,the_id\nx,2\n"})
    ingest(spark, tmp_path, {})
    assert [r[0] for r in shown(table, spark)] == [1, 2]
    lines = spark.createDataFrame([("full_name,the_id", "f", 0), ("x,2", "f", 0)], "value string, file string, block long")
    table.apply(lines.coalesce(1), 1)
    assert [r[0] for r in shown(table, spark)] == [1, 2]


def test_names_that_clash_raise_and_no_batch_reads_empty(spark, tmp_path):
    with pytest.raises(ValueError):
        NamedCsv("x", T.StructType().add("A b", "int").add("a_b", "string"))
    with pytest.raises(ValueError):
        NamedCsv("x", T.StructType().add("ingested_file", "string"))
    assert NamedCsv(str(tmp_path / "none"), SCHEMA).read(spark).count() == 0


def test_lines_are_not_shuffled(spark, tmp_path):
    table = NamedCsv(str(tmp_path / "t"), SCHEMA)
    lines = spark.range(10).selectExpr("concat(id, ',x') AS value", "concat('f', id % 2) AS file", "0L AS block")
    headers = spark.createDataFrame([("f", "the_id,full_name")], "file string, header string")
    plan = table.placed(lines, headers, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
