"""Readers, writers and streams."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from nomina import shipped_anchors, shipped_rules
from nomina.operators import cascade
from nomina.scratch import scratch_dir, scratch_scope
from nomina.sources import csv, tables
from nomina.streaming import labelling as streams


def test_raw_csv(spark, tmp_path, request):
    lines = ["id;DESCRIPTION;x", '1;"болт;m', "2;гайка", "3;a;b;c", "4; винт ;NA", "5;;z"]
    (tmp_path / "raw.csv").write_text("\n".join(lines), encoding="cp1251")
    with pytest.raises(ValueError):
        csv.read_raw_csv(spark, str(tmp_path / "raw.csv"), ";", "windows-1251")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.legacy.javaCharsets"))
    df = csv.read_raw_csv(spark, str(tmp_path / "raw.csv"), ";", "windows-1251")
    assert df.count() == 4
    assert [r.id for r in df.select("id").collect()] == ["1", "2", "4", "5"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", '"болт', "m"), ("2", "гайка", None), ("4", " винт ", None), ("5", None, "z"),
    ]


def test_text_column_reads_one_column(spark, tmp_path):
    content = 'id,DESCRIPTION,x\n1,"молоко, 3,2%",a\n2,"труба ""ПНД""",b\n3,,c\n'
    (tmp_path / "q.csv").write_text(content, encoding="utf-8")
    df = csv.read_text_column(spark, str(tmp_path / "q.csv"), line_breaks=True)
    assert [r.DESCRIPTION for r in df.collect()] == ["молоко, 3,2%", 'труба "ПНД"', None]
    assert "ReadSchema: struct<DESCRIPTION:string>" in df._jdf.queryExecution().toString()


def test_count_list_is_one_file_in_rank_order(spark, tmp_path):
    counts = spark.createDataFrame([("a", 1), ("c", 3), ("b", 3)], "token string, cnt long")
    path = tmp_path / "list"
    tables.write_count_list(counts.repartition(3), "token", str(path))
    (part,) = path.glob("part-*")
    assert part.read_text().splitlines() == ["b: 3", "c: 3", "a: 1"]
    tables.write_count_list(counts, "token", str(path), "\t")
    (part,) = path.glob("part-*")
    assert part.read_text().splitlines()[0] == "b\t3"


def test_tables_and_review_sample(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y", z', "rules"), ("b", "w", "ml")], "t string, c string, source string")
    path = str(tmp_path / "t")
    for _ in range(2):  # a second write replaces the first
        tables.write_table(df, path, ["source"])
    assert tables.read_table(spark, path).where("source = 'ml'").count() == 1
    sample = tmp_path / "sample"
    tables.write_review_sample(df, str(sample))
    assert len(list(sample.glob("part-*"))) == 1
    back = spark.read.options(header=True, escape='"').csv(str(sample))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("\n".join(lines), encoding="utf-8")


def run(writer, state):
    query = writer.option("checkpointLocation", str(state)).trigger(availableNow=True).start()
    query.awaitTermination()


def scratch_folders(spark):
    place = Path(scratch_dir(spark)) / "nomina" / spark.sparkContext.applicationId
    return sorted(p.name for p in place.iterdir()) if place.exists() else []


def test_a_scope_deletes_its_intermediates(spark):
    before = scratch_folders(spark)
    with scratch_scope(spark):
        rows = cascade.label_rows(
            spark.createDataFrame([("болт",)], "t string"), "t", shipped_rules(), shipped_anchors()
        ).collect()
        assert len(scratch_folders(spark)) > len(before)
    assert len(rows) == 1 and scratch_folders(spark) == before


def test_distinct_texts_with_event_time_forget(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:20:00")]
    for i, part in enumerate((rows, [("a", "2024-01-01 05:00:00")], [("a", "2024-01-01 09:00:00"), ("b", "2024-01-01 09:00:00")])):
        df = spark.createDataFrame(part, "t string, ts string").selectExpr("t", "timestamp(ts) AS ts")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("t string, ts timestamp").parquet(str(tmp_path / "in"))
        texts = streams.stream_distinct_texts(source, "t", "ts", "1 hour")
        run(texts.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "state")
    found = [r["t"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    # Copies within the hour are dropped. A text is forgotten once the watermark, which
    # follows a batch behind, has passed it by an hour: at 9:00, not yet at 5:00.
    assert sorted(found) == ["a", "a", "b", "b"]


def test_streams_equal_batches(spark, tmp_path):
    before = scratch_folders(spark)
    folder = tmp_path / "in"

    def stream():
        return spark.readStream.schema("value string").text(str(folder))

    def label():
        writer = streams.label_stream(
            stream(), "value", shipped_rules(), shipped_anchors(), str(tmp_path / "labels")
        )
        run(writer, tmp_path / "s1")

    def distinct():
        texts = streams.stream_distinct_texts(stream(), "value")
        run(texts.writeStream.format("parquet").option("path", str(tmp_path / "d")), tmp_path / "s2")

    def count():
        counts = streams.stream_token_counts(stream(), "value")
        run(streams.write_latest_counts(counts, str(tmp_path / "c")), tmp_path / "s3")

    for name, lines in (("1", ["болт м10", "болт м12", "тест"]), ("2", ["болт м10", "аренда офиса"])):
        drop(folder, name, lines)
        label(), distinct(), count()

    assert scratch_folders(spark) == before
    batch = cascade.label_rows(
        spark.read.text(str(folder)), "value", shipped_rules(), shipped_anchors()
    )
    columns = ["value", "clean", "label", "reason"]
    streamed = spark.read.parquet(str(tmp_path / "labels"))
    assert sorted(streamed.select(columns).collect()) == sorted(batch.select(columns).collect())
    texts = [r.value for r in spark.read.parquet(str(tmp_path / "d")).collect()]
    assert sorted(texts) == ["аренда офиса", "болт м10", "болт м12", "тест"]
    # The latest counts only, and nothing that a batch needed on the way.
    assert len(list((tmp_path / "c").glob("batch=*"))) == 1
    with pytest.raises(StreamingQueryException):
        writer = streams.label_stream(
            stream(), "value", shipped_rules(), shipped_anchors(), str(tmp_path / "labels")
        )
        run(writer, tmp_path / "fresh")
    written = spark.read.parquet(str(tmp_path / "c"))
    last = written.where(F.col("batch") == written.agg(F.max("batch")).first()[0])
    assert {r.token: r.cnt for r in last.collect()} == {
        "болт": 3, "м10": 2, "м12": 1, "тест": 1, "аренда": 1, "офиса": 1,
    }
