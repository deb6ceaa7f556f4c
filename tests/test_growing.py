"""Tables that grow by batches: runs, streams on them, document frequencies."""

from __future__ import annotations

import math
import os
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from nomina.operators import tfidf
from nomina.operators.growing import GrowingFrequencies
from nomina.sources.runs import Runs, covering, merged_into
from nomina.streaming import labelling as streams


def test_runs_cover_every_batch_once():
    for last in range(300):
        runs = covering(last)
        assert len(runs) <= math.log2(last + 1) + 1
        batches = [b for r in runs for b in range(r - ((r + 1) & -(r + 1)) + 1, r + 1)]
        assert sorted(batches) == list(range(last + 1))
        assert set(merged_into(last)) <= set(covering(last - 1))
        assert set(covering(last - 1)) - set(merged_into(last)) == set(runs) - {last}


def summed(rows):
    return rows.groupBy("k").agg(F.sum("v").alias("v"))


def sizes(runs):
    return {n: runs._read([n]).count() for n in runs.numbers()}


def test_runs_add_up_whatever_fails(spark, tmp_path):
    """Random batches, some of them written twice, one broken off half-way."""
    draw = random.Random(7)
    runs = Runs(spark, str(tmp_path / "r"), "k string, v long", summed)
    assert runs.latest() == -1 and runs.table().collect() == []
    expected = Counter()
    for number in range(9):
        batch = Counter(draw.choice("abcdefgh") + str(number % 3) for _ in range(draw.randrange(12)))
        rows = spark.createDataFrame(list(batch.items()), "k string, v long")
        if number == 5:  # a folder without its end mark counts for nothing
            rows.write.parquet(f"{runs.path}/run=5")
            (Path(runs.path) / "run=5" / "_SUCCESS").unlink()
            assert runs.latest() == 4
        for _ in range(draw.randrange(1, 3)):
            runs.write(rows, number)
        expected.update(batch)
        assert {r.k: r.v for r in runs.table().collect()} == dict(expected)
        assert len(runs.numbers()) <= 2 * (math.log2(number + 1) + 1)
    for foreign in (0, 7, 10):
        with pytest.raises(ValueError, match="another table"):
            runs.write(rows, foreign)


def test_a_batch_writes_little(spark, tmp_path):
    """After a large first batch small ones write few rows, until it is merged."""
    runs = Runs(spark, str(tmp_path / "r"), "k string, v long", summed)
    runs.write(spark.range(1000).select(F.concat(F.lit("w"), "id").alias("k"), F.lit(1).cast("long").alias("v")), 0)
    written = []
    for number in range(1, 8):
        runs.write(spark.createDataFrame([("w1", 1), (f"n{number}", 1)], "k string, v long"), number)
        written.append(sizes(runs)[number])
    assert written[1::2] == [2, 2, 2]  # batches 2, 4 and 6
    assert sum(n > 900 for n in written) == 3  # batches 1, 3 and 7
    assert runs.table().where("k = 'w1'").first().v == 8


def lines(folder: Path, batches) -> None:
    folder.mkdir()
    for i, batch in enumerate(batches):
        (folder / f"{i}.txt").write_text("\n".join(batch) + "\n", encoding="utf-8")
        os.utime(folder / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))  # files are read in this order


BATCHES = [["Кофе молотый", "кофе", "Болт М10"], ["Болт М10", "болт", ""], ["чай", "Кофе молотый"], ["болт"], ["чай"]]


def run(writer, state):
    query = writer.option("checkpointLocation", str(state)).trigger(availableNow=True).start()
    query.awaitTermination()


def forget(state, batch):
    for mark in (f"{batch}", f".{batch}.crc"):
        (state / "commits" / mark).unlink()


def source(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))


def test_running_counts_over_batches_and_restarts(spark, tmp_path):
    lines(tmp_path / "in", BATCHES)
    path = str(tmp_path / "counts")
    run(streams.write_running_counts(source(spark, tmp_path / "in"), "value", path), tmp_path / "state")
    expected = {"кофе": 3, "молотый": 2, "болт": 4, "м10": 2, "чай": 2}
    counts = streams.running_counts(spark, path)
    assert counts.latest() == 4 and {r.token: r.cnt for r in counts.table().collect()} == expected
    # The commit mark of the last batch is lost, so it is run again and counts once.
    forget(tmp_path / "state", 4)
    run(streams.write_running_counts(source(spark, tmp_path / "in"), "value", path), tmp_path / "state")
    assert {r.token: r.cnt for r in counts.table().collect()} == expected
    (tmp_path / "in" / "9.txt").write_text("чай\n", encoding="utf-8")
    run(streams.write_running_counts(source(spark, tmp_path / "in"), "value", path), tmp_path / "state")
    assert {r.token: r.cnt for r in counts.table().collect()} == {**expected, "чай": 3}
    with pytest.raises(Exception, match="another table"):
        run(streams.write_running_counts(source(spark, tmp_path / "in"), "value", path), tmp_path / "other")


def test_new_texts_over_batches_and_restarts(spark, tmp_path, force_shuffle):
    lines(tmp_path / "in", BATCHES)
    path = str(tmp_path / "new")
    blank = F.when(F.col("value") != "", F.col("value")).alias("value")  # the empty line is null
    stream = lambda: source(spark, tmp_path / "in").select(blank)
    run(streams.write_new_texts(stream(), "value", path), tmp_path / "state")
    written = lambda: sorted(((r.batch, r.value) for r in spark.read.parquet(f"{path}/texts").collect()), key=str)
    expected = sorted(
        [(0, "Болт М10"), (0, "Кофе молотый"), (0, "кофе"), (1, None), (1, "болт"), (2, "чай")], key=str
    )
    assert written() == expected
    forget(tmp_path / "state", 4)
    run(streams.write_new_texts(stream(), "value", path), tmp_path / "state")
    assert written() == expected
    with pytest.raises(Exception, match="another table"):
        run(streams.write_new_texts(stream(), "value", path), tmp_path / "other")
    assert written() == expected


def test_frequencies_after_additions_and_removals(spark, tmp_path):
    draw = random.Random(3)
    vocabulary = ["болт", "гайка", "шайба", "винт", "кофе", "чай"]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(0, 6))) for _ in range(60)] + [None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, clean string")
    counts = GrowingFrequencies(spark, str(tmp_path / "df"))
    assert counts.texts() == 0 and counts.table().collect() == []
    for part in range(4):
        number = counts.add(rows.where(F.col("id") % 4 == part), "clean")
    counts.add(rows.where(F.col("id") % 4 == 3), "clean", batch=number)  # once more changes nothing
    everything = {tuple(r) for r in tfidf.document_frequency(rows, "clean").collect()}
    assert {tuple(r) for r in counts.table().collect()} == everything and counts.texts() == 62
    counts.remove(rows.where("id < 50"), "clean")
    left = rows.where("id >= 50")
    assert {tuple(r) for r in counts.table().collect()} == {tuple(r) for r in tfidf.document_frequency(left, "clean").collect()}
    assert counts.texts() == 12
    ours = counts.vocabulary(min_df=2, max_df=0.9, max_features=5)
    theirs = tfidf.tfidf_vocabulary(left, "clean", min_df=2, max_df=0.9, max_features=5)
    assert sorted(ours.table.collect()) == sorted(theirs.table.collect())
    counts.remove(left, "clean")
    assert counts.texts() == 0 and counts.table().collect() == [] and counts.vocabulary().size == 0
