"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs; all but the last return the columns
of documents, any others that the input has included.

Edge cases: null texts are empty texts; rows without an id are never copies of
others; rows that share an id are judged each by its own text; rows that repeat id
and text stay or go together; columns of the input may have any names; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.llm import minhash, mixing, pieces, quality, substrings
from nomina.llm.queries import QUALITY_THRESHOLD, fold, piece_digests, table, tokenizer_file
from nomina.scratch import attach, materialise


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learnt from the labels
    outside the held-out fold."""
    learn = fold("doc_id", 4) != 2
    labels = table(spark, sf_dir, "labels").where(learn)
    model = quality.fit(docs.where(learn), "doc_id", "text", labels, "quality")
    return docs.where(quality.quality_score(docs, "text", model) >= QUALITY_THRESHOLD)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 80 % alike."""
    found = minhash.near_duplicates(docs, "doc_id", "text", tag="tag")
    copies = materialise(found.where("NOT kept").select("doc_id", "tag").distinct(), "copies")
    rows = docs.select(packed(docs), "doc_id", F.xxhash64("text").alias("tag"))
    return attach(rows, copies, ["doc_id", "tag"], "left_anti").select("row.*")


def packed(docs: DataFrame, *but: str):
    """The columns of docs as one, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in but]).alias("row")


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of an earlier document; others stay as they are."""
    cut = substrings.cut_repeats(docs.select(packed(docs, "text"), "doc_id", "text"), "doc_id", "text")
    less = F.col("n_removed") > 0
    changed = {
        "text": F.when(less, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(less, F.length("kept_text")).otherwise(F.col("row.n_chars")),
    }
    return cut.select(
        *[changed.get(c, F.col("row").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, by tempered weights of the sources:
    the files written from it follow each other in that order."""
    return mixing.in_mixed_order(docs, "doc_id", "source", "text", mixing.mix(docs, "doc_id", "source"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, with digests of them and of their decoding, and
    its position in the mix, which is its place in the files of the stage before."""
    rows = mixing.in_stored_order(docs.select("doc_id", "lang", "source", "text"), "position")
    coded = pieces.encode(rows, "text", tokenizer_file("piece_bpe_32k.model"), "ids", "decoded")
    return piece_digests(coded.drop("text").withColumn("piece_ids", F.col("ids")))


STAGES = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_each),
    ("substring_dedup", cut_passages),
    ("source_mixing", mix_sources),
    ("piece_encoding", encode_pieces),
]
# SQL cannot express the classifier; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
