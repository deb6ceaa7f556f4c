"""Streams of names: labelling, running word counts, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from nomina.functions.cleaning import cast_text, clean
from nomina.operators.cascade import label_rows
from nomina.operators.mining import token_counts
from nomina.operators.memory import DIGEST, text_digest
from nomina.operators.rules import RuleSet
from nomina.operators.texts import clean_distinct
from nomina.scratch import attach, delete_path, materialise, scratch_scope
from nomina.sources.runs import Runs


def _batches(batch: DataFrame, path: str) -> list[int]:
    """The numbers of the batches that have been written to ``path``."""
    spark = batch.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
    return [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]


def _refuse_foreign(batch: DataFrame, path: str, batch_id: int) -> None:
    if batch_id == 0 and any(n > 0 for n in _batches(batch, path)):
        raise ValueError(f"{path} holds the batches of another stream")


def label_stream(
    stream: DataFrame, text: str, rules: RuleSet, anchors: RuleSet, path: str
) -> DataStreamWriter:
    """Label each micro-batch with the batch operator and write it to ``path``.

    A batch writes a folder of its own, so a batch that is run again after a
    failure replaces its own output only. What it needed on the way is deleted
    afterwards. A new stream does not write into the folder of another one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _refuse_foreign(batch, path, batch_id)
        with scratch_scope(batch.sparkSession):
            labelled = label_rows(batch, text, rules, anchors)
            labelled.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write)


def stream_token_counts(stream: DataFrame, text: str) -> DataFrame:
    """Running word counts of a stream; the state grows with the vocabulary."""
    texts = stream.select(cast_text(F.col(text)).alias(text))
    return token_counts(texts.withColumn("clean", clean(F.col(text))), "clean")


def write_latest_counts(counts: DataFrame, path: str) -> DataStreamWriter:
    """Write the full counts after every micro-batch to a folder of its own and
    delete the one before, so the folder with the largest number is the latest."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _refuse_foreign(batch, path, batch_id)
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for old in _batches(batch, path):
            if old < batch_id:
                delete_path(batch.sparkSession, f"{path}/batch={old}")

    return counts.writeStream.outputMode("complete").foreachBatch(write)


def stream_distinct_texts(
    stream: DataFrame, text: str, event_time: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Each text once. Without an event time the state keeps every text seen;
    with one it forgets texts older than the watermark."""
    if event_time is None:
        return stream.select(text).dropDuplicates([text])
    timed = stream.select(text, event_time).withWatermark(event_time, delay)
    return timed.dropDuplicatesWithinWatermark([text])


def running_counts(spark: SparkSession, path: str) -> Runs:
    """The word counts that ``write_running_counts`` keeps: ``.table()`` has (token, cnt)."""

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("token").agg(F.sum("cnt").alias("cnt"))

    return Runs(spark, path, "token string, cnt long", summed)


def write_running_counts(stream: DataFrame, text: str, path: str) -> DataStreamWriter:
    """Running word counts kept in ``path`` instead of in executors: a micro-batch
    writes the counts of its own words, merged now and then with earlier ones, not the
    whole vocabulary. A batch that is run again after a failure counts once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            counts = token_counts(clean_distinct(batch, text), "clean", "n")
            running_counts(batch.sparkSession, path).write(counts, batch_id)

    return stream.writeStream.foreachBatch(write)


def seen_texts(spark: SparkSession, path: str) -> Runs:
    """The digests of the texts that ``write_new_texts`` has met, each once."""
    return Runs(spark, f"{path}/seen", "h1 long, h2 long")


def write_new_texts(stream: DataFrame, text: str, path: str) -> DataStreamWriter:
    """Write each text the first time it comes, null as well, to ``path/texts``, without
    an event time and without state in executors.

    A text goes by 128 bits of hash, 16 bytes on shared files. A micro-batch looks its
    digests up among those of earlier batches: the digests in store are scanned where
    they lie while the batch's measure small enough to be sent to every task. A batch
    that is run again after a failure sees only batches before it and replaces its own
    output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = seen_texts(spark, path)
        seen.check(batch_id)
        with scratch_scope(spark):
            texts = materialise(batch.select(text).distinct().select(text, *text_digest(F.col(text))), "texts")
            earlier = seen.table(batch_id - 1).select(*DIGEST)
            met = materialise(attach(earlier, texts.select(*DIGEST), DIGEST, "left_semi"), "met")
            new = materialise(attach(texts, met, DIGEST, "left_anti"), "new")
            new.select(text).write.mode("overwrite").parquet(f"{path}/texts/batch={batch_id}")
            seen.write(new.select(*DIGEST), batch_id)

    return stream.writeStream.foreachBatch(write)
