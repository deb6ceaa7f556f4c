"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.llm import (
    cap_filters,
    host_rules,
    impact_index,
    minhash,
    mixing,
    multi_index,
    ngram_trie,
    pieces,
    quality,
    quote_links,
    source_audit,
    substrings,
    token_counts,
)
from nomina.llm.registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES"]


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


SUBSTRING_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
win AS (
    SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM win),
first AS (SELECT s, min(doc_id) AS least FROM h GROUP BY s HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i
    FROM h JOIN first USING (s) WHERE doc_id > least),
cut AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
        list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1])
        END, ' ')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""


NEAR_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
s AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w
        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
u AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b USING (g) WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM s JOIN reach USING (doc_id) GROUP BY doc_id, s
"""


# Rows that Spark hands to a Python worker at once. Texts are long: with Spark's
# default of 10,000 a batch takes tens of megabytes several times over.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in a session set up for rows of long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op2_piece_codec")
def piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to piece ids and decoded again, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, "text", tokenizer_file("piece_bpe_32k.model"), "ids", "decoded")
    return piece_digests(coded.drop("text"))


def piece_digests(coded: DataFrame) -> DataFrame:
    """Replace the columns ids and decoded by their length and digests."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    kept = [c for c in coded.columns if c not in ("ids", "decoded")]
    return coded.select(
        *kept,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op7_substring_dedup", SUBSTRING_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages an earlier one has, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.cut_repeats(docs, "doc_id", "text")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op5_minhash_dedup", NEAR_SQL)
def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are 80 % alike."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", width=2)


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


@register("op10_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_trie.train(docs.where(fold("doc_id", 10) != 0), "text")
    scored = ngram_trie.score(docs, "doc_id", "text", model)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 10) == 0, F.lit(True)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


QUALITY_THRESHOLD = 0.7


@register("op3_quality_scores")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learnt from the labels outside one of four folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    learnt = docs.where(fold("doc_id", 4) != 2)
    model = quality.fit(learnt, "doc_id", "text", labels, "quality")
    scored = docs.withColumn("score", quality.quality_score(docs, "text", model))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


VECTOR_LINKS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
    SELECT vec_id, vec_id AS other FROM v
    UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links,
    min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id
"""


@register("op9_vector_dedup", VECTOR_LINKS_SQL)
def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors with a cosine of at least 0.9."""
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


TOP_K = 5
VECTOR_TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e FROM embeddings),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@register("op4_exact_top_vectors", VECTOR_TOP_SQL)
def exact_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best integer inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), impact_index.whole_numbers(F.col("embedding")).alias("vector")
    )
    rows = vectors.where("id IS NOT NULL AND vector IS NOT NULL")
    found = impact_index.search(impact_index.build_index(rows), rows.where("id % 50 = 0"), TOP_K)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@register("op1_token_counts")
def document_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, word-piece tokens and unknown words of every document."""
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.token_counts(F.col("text"), tokenizer_file("piece_bpe_32k.model"))
    return docs.select("doc_id", counts.alias("_c")).select("doc_id", "_c.*")


@register("op8_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mix of the sources, by tempered weights."""
    placed = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "source")
    return placed.withColumnRenamed("mix_key", "doc_id")


REPLIES_SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
a AS (SELECT conv_id, turn, role, regexp_split_to_array(text, '\r?\n') AS a FROM m),
l AS (SELECT conv_id, turn, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS line FROM a),
p AS (
    SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')) AS level,
        regexp_replace(line, '^((?:[ \t]*>)*)', '') AS body FROM l),
own AS (
    SELECT conv_id, turn,
        regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0), ''), '^\s+|\s+$', '', 'g') AS content,
        count(*) FILTER (level > 0) AS n_quoted_lines FROM p GROUP BY ALL),
r AS (SELECT *, i - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY i) AS run FROM p WHERE level > 0),
q AS (
    SELECT conv_id, turn, level, trim(regexp_replace(lower(string_agg(body, ' ' ORDER BY i)), '\s+', ' ', 'g')) AS t
    FROM r GROUP BY conv_id, turn, level, run),
o AS (
    SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) AS t FROM (
        SELECT conv_id, turn, unnest(list_concat([content], list_concat(
            regexp_split_to_array(content, '\n\s*\n'), string_split(content, chr(10))))) AS t FROM own)),
k AS (
    SELECT q.conv_id, q.turn, q.level, q.t, max(o.turn) AS answers
    FROM (SELECT *, row_number() OVER () AS n FROM q WHERE t <> '') q
    JOIN o ON o.conv_id = q.conv_id AND o.t = q.t AND o.turn < q.turn GROUP BY q.n, q.conv_id, q.turn, q.level, q.t),
linked AS (
    SELECT conv_id, turn, arg_max(answers, -level * 1000000000 + answers) AS linked_turn, count(*) AS linked_passages
    FROM k GROUP BY ALL),
b AS (
    SELECT own.conv_id, own.turn, lag(own.turn) OVER (PARTITION BY own.conv_id ORDER BY own.turn) AS previous,
        linked_turn, linked_passages FROM own LEFT JOIN linked USING (conv_id, turn)),
s AS (
    SELECT *, max(turn) FILTER (linked_turn < previous) OVER (PARTITION BY conv_id ORDER BY turn) AS start FROM b),
path AS (
    SELECT conv_id, turn, start, []::BIGINT[] AS path, 0 AS depth FROM s WHERE start IS NULL
    UNION ALL
    SELECT s.conv_id, s.turn, s.start, list_concat(path.path, [1, -head.linked_turn, s.start]), path.depth + 1
    FROM path JOIN s head ON head.conv_id = path.conv_id AND head.turn = head.start AND head.linked_turn = path.turn
    JOIN s ON s.conv_id = head.conv_id AND s.start = head.start)
SELECT conv_id, turn, role, content, n_quoted_lines, coalesce(linked_turn, previous) AS answers_turn,
    coalesce(linked_passages, 0) AS linked_passages, depth::BIGINT AS depth,
    array_to_string(list_concat(path, [0, turn]), ',') AS reply_key,
    '<|' || coalesce(role, '') || '|>' || chr(10) || content || chr(10) || '<|end|>' || chr(10) AS message
FROM m JOIN own USING (conv_id, turn) JOIN s USING (conv_id, turn) JOIN path USING (conv_id, turn)
"""


@register("op6_reply_order", REPLIES_SQL)
def reply_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, in chat form, with its place in the reply order."""
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    placed = quote_links.reply_ordered(talks, "conv_id", "turn", "text").drop("text")
    message = quote_links.formatted(F.col("role"), F.col("content"))
    return placed.withColumns(
        {"reply_key": F.concat_ws(",", F.col("reply_key").cast("array<string>")), "message": message}
    )


HOST_SQL = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
win AS (
    SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, unnest(list_transform(range(1, len(w) - 3),
        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])) AS s
    FROM w WHERE len(w) >= 5),
often AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS uses FROM win),
covered AS (
    SELECT doc_id, count(DISTINCT i) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(p, p + 5)) AS i FROM often WHERE uses > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
    SELECT doc_id, host, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN dup USING (doc_id)),
f AS (
    SELECT host, unnest([
        n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > n_words,
        10 * n_dup_lines > n_words, word_chars > 20 * n_words]) AS failed, unnest(range(5)) AS rule
    FROM m WHERE host IS NOT NULL),
h AS (SELECT host, rule, count(*)::DOUBLE AS n, count(*) FILTER (failed)::DOUBLE AS k FROM f GROUP BY host, rule),
s AS (
    SELECT rule, count(*) AS hosts, sum(n) AS n, sum(n * n) AS n2, sum(k) AS k, sum(k * k / n) AS ratio, sum(k) / sum(n) AS rate
    FROM h GROUP BY rule),
b AS (
    SELECT *, rate * (1 - rate) * (n - n2 / n - (hosts - 1)) AS weight,
        ratio - k * k / n - rate * (1 - rate) * (hosts - 1) AS between_hosts FROM s),
prior AS (
    SELECT rule, rate, CASE WHEN rate IN (0, 1) THEN 0 ELSE 1 / least(greatest(
        CASE WHEN weight > 0 THEN between_hosts / weight ELSE 0 END, 1e-9), 1 - 1e-9) - 1 END AS strength FROM b),
rejected AS (
    SELECT DISTINCT host FROM h JOIN prior USING (rule) WHERE (k + rate * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    rejected.host IS NOT NULL AS host_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND rejected.host IS NULL AS kept
FROM m LEFT JOIN rejected USING (host)
"""


@register("op12_host_rules", HOST_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether it and its source pass the rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules.judge(docs, "text", "source").drop("source")


AUDIT_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
    SELECT lang, gn.source, k.term, coalesce(c, 0) AS c,
        1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (gn.n + v.v) AS p,
        1 + (1000000000::HUGEINT * (k.total + 1)) // (v.n + v.v) AS q
    FROM gn JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q),
r AS (
    SELECT lang, source, part, item, value::BIGINT AS value,
        row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM u)
SELECT * FROM r WHERE part = 'pair' OR rank <= 200
"""


@register("op13_source_audit", AUDIT_SQL)
def divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source of a language differs from the others, and in which terms."""
    return source_audit.audit(table(spark, sf_dir, "documents"), "text", "lang", "source")


HARD_NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT)::DOUBLE[] AS e
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
n AS (
    SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
        AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@register("op11_hard_negatives", HARD_NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels just below the best ones of the own label, for every
    fiftieth vector; every seventh vector is labelled wrongly."""
    wrong = (F.col("label") + 1) % 10
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, wrong).otherwise(F.col("label")).alias("label"),
        impact_index.whole_numbers(F.col("embedding")).alias("vector"),
    )
    return multi_index.mine(rows.where("vector IS NOT NULL"), F.expr("id % 50 = 0"))
