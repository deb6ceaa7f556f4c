"""Queries through readers, writers and streams; files go to the scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from nomina.operators.rules import shipped_anchors, shipped_rules
from nomina.scratch import scratch_path
from nomina.sources import csv, tables
from nomina.streaming import labelling as streams
from workload import sql
from workload.label_queries import pseudo_label_table
from workload.names import name_column, names, read
from workload.registry import ORACLES, register


@register(
    "raw_csv",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS \"DESCRIPTION\", "
    "CASE WHEN p_partkey % 10 <> 1 THEN p_brand END AS brand FROM part WHERE p_partkey % 10 <> 0",
)
def raw_csv(spark, sf_dir):
    """Lines with a field too many are skipped, with one too few filled up."""
    key = F.col("p_partkey") % 10
    line = F.concat_ws(
        ";",
        "p_partkey",
        "p_name",
        F.when(key != 1, F.col("p_brand")),
        F.when(key == 0, F.lit("surplus")),
    )
    path = scratch_path(spark, "raw")
    read(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    return csv.read_raw_csv(spark, path, ";", names=["id", "DESCRIPTION", "brand"])


@register(
    "text_column",
    sql.with_ctes(
        sql.NAMES,
        "SELECT nullif(name, '') AS \"DESCRIPTION\" FROM names",
    ),
)
def text_column(spark, sf_dir):
    path = scratch_path(spark, "names")
    rows = names(spark, sf_dir).select(F.col("name").alias("DESCRIPTION"), "l_orderkey")
    rows.write.options(
        header=True, escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return csv.read_text_column(spark, path, line_breaks=False)


@register("table_scan", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def table_scan(spark, sf_dir):
    rows = tables.read_table(spark, f"{sf_dir}/documents.parquet")
    return rows.where(F.col("lang") == "en").select("doc_id", "lang")


@register(
    "written_table",
    sql.with_ctes(sql.V1, "SELECT text, category, source FROM v1 WHERE source = 'rules'"),
)
def written_table(spark, sf_dir):
    path = scratch_path(spark, "labels")
    tables.write_table(pseudo_label_table(spark, sf_dir), path, ["source"])
    rows = tables.read_table(spark, path).where(F.col("source") == "rules")
    return rows.select("text", "category", F.col("source").cast("string").alias("source"))


def name_stream(spark, sf_dir):
    schema = read(spark, sf_dir, "lineitem").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet")
    return source.parquet(sf_dir).select("l_orderkey", name_column().alias("name"))


def _run(writer, spark) -> None:
    checkpoint = scratch_path(spark, "stream-state")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@register(
    "stream_labels",
    sql.with_ctes(
        sql.CASCADE,
        "SELECT l_orderkey, name, clean, label, reason, rule FROM names JOIN labelled USING (name)",
    ),
)
def stream_labels(spark, sf_dir):
    path = scratch_path(spark, "stream-labels")
    stream = name_stream(spark, sf_dir)
    _run(streams.label_stream(stream, "name", shipped_rules(), shipped_anchors(), path), spark)
    return spark.read.parquet(path).drop("batch")


@register(
    "stream_token_counts",
    sql.with_ctes(
        sql.TEXTS + f", cut AS (SELECT n, unnest({sql.tokens('clean')}) AS token FROM texts)",
        "SELECT token, CAST(sum(n) AS BIGINT) AS cnt FROM cut GROUP BY token",
    ),
)
def stream_token_counts(spark, sf_dir):
    path = scratch_path(spark, "stream-counts")
    counts = streams.stream_token_counts(name_stream(spark, sf_dir), "name")
    _run(streams.write_latest_counts(counts, path), spark)
    written = spark.read.parquet(path)
    last = written.agg(F.max("batch")).first()[0]
    return written.where(F.col("batch") == last).drop("batch")


@register("stream_distinct_texts", sql.with_ctes(sql.NAMES, "SELECT DISTINCT name FROM names"))
def stream_distinct_texts(spark, sf_dir):
    path = scratch_path(spark, "stream-distinct")
    texts = streams.stream_distinct_texts(name_stream(spark, sf_dir), "name")
    _run(texts.writeStream.format("parquet").option("path", path), spark)
    return spark.read.parquet(path)


def name_batches(spark, sf_dir):
    """The names as a stream of eight micro-batches."""
    path = scratch_path(spark, "name-files")
    names(spark, sf_dir).select("name").repartition(8).write.parquet(path)
    source = spark.readStream.schema("name string").option("maxFilesPerTrigger", 1)
    return source.parquet(path)


@register("running_counts", ORACLES["stream_token_counts"])
def running_counts(spark, sf_dir):
    """Word counts kept over micro-batches that write only their own words."""
    path = scratch_path(spark, "running-counts")
    _run(streams.write_running_counts(name_batches(spark, sf_dir), "name", path), spark)
    return streams.running_counts(spark, path).table()


@register("new_texts", ORACLES["stream_distinct_texts"])
def new_texts(spark, sf_dir):
    """Each name once, told by digests of earlier micro-batches."""
    path = scratch_path(spark, "new-texts")
    _run(streams.write_new_texts(name_batches(spark, sf_dir), "name", path), spark)
    return spark.read.parquet(f"{path}/texts").drop("batch")
