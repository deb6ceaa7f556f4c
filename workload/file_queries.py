"""Queries through files the library writes and reads back, and over texts whose
number grows with the data."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from nomina.functions.cleaning import clean
from nomina.functions.tokens import tokenize
from nomina.operators import mining, sampling
from nomina.operators.cascade import label_rows
from nomina.operators.rules import Rule, RuleSet
from nomina.operators.textmodel import load_model, train_text_model
from nomina.plans import datasets
from nomina.scratch import materialise, scratch_path
from nomina.sources import rules as rule_files
from nomina.sources import tables
from nomina.streaming import labelling as streams
from workload import dataset_queries, sql
from workload.io_queries import _run
from workload.mining_queries import prose
from workload.names import read
from workload.registry import ORACLES, register

PART_RULES = [
    {"pattern": "bolt|ring", "category": "fasteners", "priority": 1},
    {"pattern": "^cold", "category": "cold", "priority": 5, "exclude_if": ["gear"]},
    {"pattern": "(?P<name>plate)\\Z", "category": "left out: no Java pattern", "priority": 9},
    {"w.*t$": "widgets"},
]


@register(
    "loaded_rules",
    "SELECT p_partkey, CASE WHEN starts_with(p_name, 'cold') AND NOT contains(p_name, 'gear') THEN 'cold' "
    "WHEN regexp_matches(p_name, 'bolt|ring') THEN 'fasteners' "
    "WHEN regexp_matches(p_name, 'w.*t$') THEN 'widgets' END AS category FROM part",
)
def loaded_rules(spark, sf_dir):
    """A rule file applied to part names; a pattern Java cannot run is left out."""
    path = scratch_path(spark, "rules")
    rule_files.write_rules(spark, PART_RULES, path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rules = rule_files.load_rules(path)
    first = rules.first_match(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", rules.pick(first, "category").alias("category"))


@register(
    "rule_drafts_file",
    sql.with_ctes(
        f"cut AS (SELECT {sql.tokens(sql.clean('text'))} AS w FROM documents), "
        f"grams AS (SELECT unnest({sql.ngrams('w', 2)}) AS ngram FROM cut), "
        "top AS (SELECT ngram, count(*) AS cnt FROM grams GROUP BY ngram ORDER BY cnt DESC, ngram LIMIT 40)",
        "SELECT replace(ngram, ' ', '.*') AS pattern, '???' AS category, 10 AS priority, "
        "string_split(ngram, ' ')[1] AS apply_if FROM top",
    ),
)
def rule_drafts_file(spark, sf_dir):
    """Drafts of the most frequent word pairs, written as a rule file and loaded."""
    cleaned = read(spark, sf_dir, "documents").select(clean(F.col("text")).alias("clean"))
    pairs = mining.ngram_counts(cleaned, "clean", 2, 2)
    path = scratch_path(spark, "drafts")
    rule_files.write_rule_drafts(mining.draft_rules(pairs, 40, 0), path)
    loaded = rule_files.load_rules(path).table(spark)
    return loaded.select("pattern", "category", "priority", F.array_join("apply_if", "|").alias("apply_if"))


@register("review_sample_file", f"SELECT doc_id, lang, source FROM documents ORDER BY {sql.md5_order('doc_id')} LIMIT 200")
def review_sample_file(spark, sf_dir):
    path = scratch_path(spark, "review")
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    tables.write_review_sample(sampling.sample_n(rows, 200, ["doc_id"]), path)
    return spark.read.schema(rows.schema).options(header=True, escape='"').csv(path)


@register("finetune_files", ORACLES["finetune_dataset"])
def finetune_files(spark, sf_dir):
    train, val = scratch_path(spark, "train"), scratch_path(spark, "val")
    datasets.write_finetune_dataset(dataset_queries.finetune_dataset(spark, sf_dir), train, val)
    parts = [spark.read.parquet(p).withColumn("is_val", F.lit(p == val)) for p in (train, val)]
    return parts[0].unionByName(parts[1])


@register(
    "count_list_file",
    f"WITH t AS (SELECT unnest({sql.tokens(sql.clean('text'))}) AS token FROM documents) "
    "SELECT token || chr(9) || CAST(count(*) AS VARCHAR) AS line FROM t GROUP BY token "
    "ORDER BY count(*) DESC, token LIMIT 500",
)
def count_list_file(spark, sf_dir):
    path = scratch_path(spark, "list")
    cleaned = read(spark, sf_dir, "documents").select(clean(F.col("text")).alias("clean"))
    counts = mining.item_counts(cleaned, tokenize(F.col("clean")), "token")
    tables.write_count_list(mining.top_k(counts, "token", 500), "token", path, "\t")
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("model_roundtrip", "SELECT doc_id, true AS same FROM documents")
def model_roundtrip(spark, sf_dir):
    """A saved model labels every document as the fitted one does, whether its
    coefficients are sent to every task or joined."""
    rows = materialise(prose(spark, sf_dir), "prose")
    model = train_text_model(rows, "clean", "lang")
    path = scratch_path(spark, "model")
    model.save(path)
    again = load_model(spark, path)
    sent = model.predict(rows, "clean", "sent", by_join=False).select("doc_id", "sent")
    joined = again.predict(rows, "clean", "joined", by_join=True).select("doc_id", "joined")
    return sent.join(joined, "doc_id").select("doc_id", (F.col("sent") == F.col("joined")).alias("same"))


@register("distinct_events", "SELECT DISTINCT CAST(user_id AS VARCHAR) || ':' || event_type AS text FROM events")
def distinct_events(spark, sf_dir):
    """Each kind of event of each user once, with a watermark wider than the data."""
    path = scratch_path(spark, "events")
    source = spark.readStream.schema(read(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet")
    text = F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("text")
    stream = source.parquet(sf_dir).select(text, F.col("ts").cast("timestamp").alias("ts"))
    single = streams.stream_distinct_texts(stream, "text", "ts", "400 days").select("text")
    _run(single.writeStream.format("parquet").option("path", path), spark)
    return spark.read.schema("text string").parquet(path)


LINE_ANCHORS = RuleSet([Rule("token|password", "secrets")])
LINE_RULES = RuleSet(
    [
        Rule("the|and", "english", 0, [], ["que"]),
        Rule("worthless|pathetic", "rude", 5),
        Rule("[0-9]{3}", "numbers", 1),
        Rule("und|der", "german"),
        Rule("que|les", "romance"),
    ]
)
LINES_SQL = sql.with_ctes(
    "lines AS (SELECT kind, id, i - 1 AS i, line FROM (SELECT kind, id, unnest(a) AS line, "
    "unnest(range(1, len(a) + 1)) AS i FROM ("
    "SELECT 'document' AS kind, doc_id AS id, string_split(text, chr(10)) AS a FROM documents "
    "UNION ALL SELECT 'turn', conv_id * 1000 + turn, string_split(text, chr(10)) FROM conversations))), "
    f"texts AS MATERIALIZED (SELECT line, {sql.clean('line')} AS clean FROM (SELECT DISTINCT line FROM lines)), "
    f"ranked AS (SELECT line, clean, {sql.first_match(LINE_ANCHORS, 'clean')} AS a, "
    f"{sql.first_match(LINE_RULES, 'clean')} AS r FROM texts)",
    f"SELECT kind, id, CAST(i AS INTEGER) AS i, clean, CASE WHEN clean = '' THEN {sql.EMPTY} ELSE "
    f"coalesce({sql.pick(LINE_ANCHORS, 'a', 'category')}, {sql.pick(LINE_RULES, 'r', 'category')}, {sql.FALLBACK}) "
    "END AS label FROM lines JOIN ranked USING (line)",
)


@register("labelled_lines", LINES_SQL)
def labelled_lines(spark, sf_dir):
    """Every line of the documents and turns labelled; nearly every line differs."""
    docs = read(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    turns = read(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"
    )
    lines = docs.unionByName(turns).select("kind", "id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return label_rows(lines, "line", LINE_RULES, LINE_ANCHORS).select("kind", "id", "i", "clean", "label")
