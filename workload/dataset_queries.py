"""Queries on sampling, splits, data sets, TF-IDF, the text model and its quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.labels import hash_order, is_labeled
from nomina.functions.tokens import tfidf_terms
from nomina.operators import dataset, growing, reports, sampling, tfidf
from nomina.operators.textmodel import train_text_model
from nomina.plans import datasets, labelling
from nomina.scratch import materialise, scratch_path
from workload import sql
from workload.label_queries import backfilled, pseudo_label_table, STUB
from workload.mining_queries import prose
from workload.names import read
from workload.registry import ORACLES, register

# Class bounds of the queries, so that the filters and caps do bite.
MIN_ROWS, MAX_ROWS = 30, 100


def documents(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "lang", "source")


@register(
    "frequent_classes",
    sql.with_ctes(
        sql.V1,
        "SELECT category, count(*) AS cnt FROM v1 GROUP BY category "
        f"HAVING count(*) >= {MIN_ROWS}",
    ),
)
def frequent_classes(spark, sf_dir):
    return dataset.frequent_classes(pseudo_label_table(spark, sf_dir), MIN_ROWS)


@register(
    "keep_frequent",
    sql.with_ctes(
        sql.V1,
        "SELECT text, category FROM v1 "
        f"QUALIFY count(*) OVER (PARTITION BY category) >= {MIN_ROWS}",
    ),
)
def keep_frequent(spark, sf_dir):
    kept = dataset.keep_frequent_classes(pseudo_label_table(spark, sf_dir), MIN_ROWS)
    return kept.select("text", "category")


@register(
    "cap_per_class",
    sql.with_ctes(
        sql.V1,
        "SELECT text, category FROM v1 QUALIFY row_number() OVER (PARTITION BY category "
        f"ORDER BY {sql.md5_order('text')}) <= {MAX_ROWS}",
    ),
)
def cap_per_class(spark, sf_dir):
    capped = sampling.cap_per_class(pseudo_label_table(spark, sf_dir), MAX_ROWS, ["text"])
    return capped.select("text", "category")


@register(
    "cap_documents",
    "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang "
    f"ORDER BY {sql.md5_order('doc_id')}) <= {MAX_ROWS}",
)
def cap_documents(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return sampling.cap_per_class(rows, MAX_ROWS, ["doc_id"], by="lang").select("doc_id", "lang")


@register(
    "sample_rows",
    f"SELECT doc_id, lang FROM documents ORDER BY {sql.md5_order('doc_id', 7)} LIMIT 150",
)
def sample_rows(spark, sf_dir):
    return sampling.sample_n(documents(spark, sf_dir), 150, ["doc_id"], seed=7).select(
        "doc_id", "lang"
    )


@register(
    "shuffle_rows",
    f"SELECT doc_id, {sql.md5_order('doc_id')} AS place FROM documents ORDER BY place",
)
def shuffle_rows(spark, sf_dir):
    rows = sampling.shuffle_rows(documents(spark, sf_dir), ["doc_id"])
    return rows.select("doc_id", hash_order("doc_id", seed=fixed.SEED).alias("place"))


_SPLIT = (
    "row_number() OVER (PARTITION BY {by} ORDER BY {order}) <= "
    "round(count(*) OVER (PARTITION BY {by}) * 0.1)"
)


@register(
    "stratified_split",
    sql.with_ctes(
        sql.V1,
        "SELECT text, category, "
        f"{_SPLIT.format(by='category', order=sql.md5_order('text'))} AS is_val FROM v1",
    ),
)
def stratified_split(spark, sf_dir):
    split = sampling.stratified_split(pseudo_label_table(spark, sf_dir), ["text"])
    return split.select("text", "category", "is_val")


@register(
    "document_split",
    "SELECT doc_id, lang, "
    f"{_SPLIT.format(by='lang', order=sql.md5_order('doc_id'))} AS is_val FROM documents",
)
def document_split(spark, sf_dir):
    split = sampling.stratified_split(documents(spark, sf_dir), ["doc_id"], by="lang")
    return split.select("doc_id", "lang", "is_val")


@register(
    "ordered_holdout",
    "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, "
    "row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.95) AS is_train "
    "FROM documents",
)
def ordered_holdout(spark, sf_dir):
    split = sampling.ordered_holdout(documents(spark, sf_dir), ["doc_id"])
    return split.select("doc_id", "row_index", "is_train")


@register(
    "label_index",
    sql.with_ctes(
        sql.V1,
        "SELECT category, row_number() OVER (ORDER BY category) - 1 AS label_id "
        "FROM (SELECT DISTINCT category FROM v1)",
    ),
)
def label_index(spark, sf_dir):
    return sampling.label_index(pseudo_label_table(spark, sf_dir))


@register(
    "concat_parts",
    sql.with_ctes(sql.V1, "SELECT text, category, source FROM v1"),
)
def concat_parts(spark, sf_dir):
    v1 = pseudo_label_table(spark, sf_dir)
    known = is_labeled(F.col("category"))
    return v1.where(known).unionByName(v1.where(~known))


@register(
    "usable_rows",
    f"SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL AND NOT starts_with(source, 'w') "
    f"AND {sql.clean('text')} <> ''",
)
def usable_rows(spark, sf_dir):
    from nomina.functions.cleaning import clean

    rows = read(spark, sf_dir, "documents")
    present = dataset.drop_junk(dataset.drop_nulls(rows, "text", "lang"), "source", "w")
    cleaned = present.withColumn("clean", clean(F.col("text")))
    return dataset.drop_empty_clean(cleaned).select("doc_id", "lang")


TRAINING = (
    f"{sql.V1}, frequent AS (SELECT * FROM v1 WHERE NOT starts_with(category, 'МУСОР') "
    f"QUALIFY count(*) OVER (PARTITION BY category) >= {MIN_ROWS}), "
    "capped AS (SELECT * FROM frequent QUALIFY row_number() OVER (PARTITION BY category "
    f"ORDER BY {sql.md5_order('text')}) <= {MAX_ROWS}), "
    "training AS MATERIALIZED (SELECT * FROM capped WHERE clean <> '')"
)


def training_table(spark, sf_dir):
    rows = datasets.training_set(pseudo_label_table(spark, sf_dir), MIN_ROWS, MAX_ROWS)
    return materialise(rows, "training")


@register(
    "training_set", sql.with_ctes(TRAINING, "SELECT text, category, source, clean FROM training")
)
def training_set(spark, sf_dir):
    return datasets.training_set(pseudo_label_table(spark, sf_dir), MIN_ROWS, MAX_ROWS)


@register(
    "finetune_dataset",
    sql.with_ctes(
        STUB + ", usable AS (SELECT * FROM v2 WHERE NOT starts_with(category, 'МУСОР') "
        f"AND clean <> '' QUALIFY count(*) OVER (PARTITION BY category) >= {MIN_ROWS}), "
        "capped AS (SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY category "
        f"ORDER BY {sql.md5_order('text')}) <= {MAX_ROWS})",
        "SELECT text, category, source, clean, "
        f"{_SPLIT.format(by='category', order=sql.md5_order('text'))} AS is_val FROM capped",
    ),
)
def finetune_dataset(spark, sf_dir):
    v2 = backfilled(spark, sf_dir)[1]
    return datasets.finetune_dataset(v2, MIN_ROWS, MAX_ROWS).select(
        "text", "category", "source", "clean", "is_val"
    )


# ---- TF-IDF ----------------------------------------------------------------


def _tfidf(base: str, key: str, min_df: int, max_features: int) -> str:
    """base holds (key, clean); gives vocab and weights."""
    return (
        f", word_lists AS MATERIALIZED (SELECT {key}, {sql.words('clean')} AS words FROM {base}), "
        f"term_rows AS (SELECT {key}, unnest(list_concat(words, {sql.ngrams('words', 2)})) AS term "
        "FROM word_lists), "
        f"freqs AS MATERIALIZED (SELECT {key}, term, count(*) AS tf FROM term_rows "
        f"GROUP BY {key}, term), "
        "doc_freqs AS MATERIALIZED (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total "
        "FROM freqs GROUP BY term), "
        f"size AS (SELECT count(*) AS n FROM {base}), "
        "bounded AS (SELECT term, df, total, n FROM doc_freqs CROSS JOIN size "
        f"WHERE df >= {min_df} AND df <= 0.9 * n ORDER BY total DESC, term LIMIT {max_features}), "
        "vocab AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df, "
        "ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM bounded), "
        f"raw AS (SELECT {key}, term, idx, (1 + ln(tf)) * idf AS w FROM freqs JOIN vocab "
        "USING (term)), "
        f"weights AS MATERIALIZED (SELECT {key}, term, idx, "
        f"w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM raw)"
    )


NAME_TFIDF = TRAINING + _tfidf("training", "text", 5, 200_000)
PROSE_TFIDF = (
    f"prose AS MATERIALIZED (SELECT doc_id, lang, {sql.clean('text')} AS clean FROM documents)"
    + _tfidf("prose", "doc_id", 5, 200_000)
)


def prose_table(spark, sf_dir):
    return materialise(prose(spark, sf_dir), "prose")


@register(
    "tfidf_terms",
    sql.with_ctes(
        sql.TEXTS + f", cut AS (SELECT name, {sql.words('clean')} AS words FROM texts)",
        f"SELECT name, array_to_string(list_concat(words, {sql.ngrams('words', 2)}), '|') AS terms "
        "FROM cut",
    ),
)
def terms(spark, sf_dir):
    from nomina.functions.cleaning import clean
    from nomina.operators.texts import distinct_texts
    from workload.names import names

    texts = distinct_texts(names(spark, sf_dir), "name")
    cleaned = texts.select("name", clean(F.col("name")).alias("clean"))
    listed = F.array_join(tfidf_terms(F.col("clean")), "|")
    return cleaned.select("name", listed.alias("terms"))


@register("doc_freq", sql.with_ctes(NAME_TFIDF, "SELECT term, df, total FROM doc_freqs"))
def doc_freq(spark, sf_dir):
    return tfidf.document_frequency(training_table(spark, sf_dir), "clean")


@register(
    "document_doc_freq",
    sql.with_ctes(
        PROSE_TFIDF, "SELECT term, df, total FROM doc_freqs WHERE df >= 5"
    ),
)
def document_doc_freq(spark, sf_dir):
    counts = tfidf.document_frequency(prose(spark, sf_dir), "clean")
    return counts.where(F.col("df") >= 5)


@register(
    "tfidf_vocab",
    sql.with_ctes(
        NAME_TFIDF, "SELECT term, CAST(idx AS INTEGER) AS idx, df, round(idf, 6) AS idf FROM vocab"
    ),
)
def tfidf_vocab(spark, sf_dir):
    vocabulary = tfidf.tfidf_vocabulary(training_table(spark, sf_dir), "clean")
    return vocabulary.table.select("term", "idx", "df", F.round("idf", 6).alias("idf"))


@register(
    "document_tfidf_vocab",
    sql.with_ctes(
        PROSE_TFIDF, "SELECT term, CAST(idx AS INTEGER) AS idx, df, round(idf, 6) AS idf FROM vocab"
    ),
)
def document_tfidf_vocab(spark, sf_dir):
    vocabulary = tfidf.tfidf_vocabulary(prose_table(spark, sf_dir), "clean")
    return vocabulary.table.select("term", "idx", "df", F.round("idf", 6).alias("idf"))


@register("growing_vocabulary", ORACLES["document_tfidf_vocab"])
def growing_vocabulary(spark, sf_dir):
    """The vocabulary of all documents, counted in batches by language of which one is
    taken out and put back; no batch reads the texts of another."""
    rows = materialise(prose_table(spark, sf_dir), "prose")
    counts = growing.GrowingFrequencies(spark, scratch_path(spark, "frequencies"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    counts.add(rows.where(~english), "clean")
    counts.add(rows.where(english), "clean")
    counts.remove(rows.where(~english), "clean")
    counts.add(rows.where(~english), "clean")
    return counts.vocabulary().table.select("term", "idx", "df", F.round("idf", 6).alias("idf"))


@register(
    "tfidf_weights",
    sql.with_ctes(NAME_TFIDF, "SELECT text, term, round(weight, 6) AS weight FROM weights"),
)
def tfidf_weights(spark, sf_dir):
    rows = training_table(spark, sf_dir)
    vocabulary = tfidf.tfidf_vocabulary(rows, "clean")
    weights = tfidf.tfidf_weights(rows, "text", "clean", vocabulary)
    return weights.select("text", "term", F.round("weight", 6).alias("weight"))


@register(
    "document_tfidf_weights",
    sql.with_ctes(PROSE_TFIDF, "SELECT doc_id, term, round(weight, 6) AS weight FROM weights"),
)
def document_tfidf_weights(spark, sf_dir):
    rows = prose_table(spark, sf_dir)
    vocabulary = tfidf.tfidf_vocabulary(rows, "clean")
    weights = tfidf.tfidf_weights(rows, "doc_id", "clean", vocabulary)
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register(
    "sparse_vectors",
    sql.with_ctes(
        PROSE_TFIDF,
        "SELECT doc_id, (SELECT count(*) FROM vocab) AS size, count(weight) AS filled, "
        "round(coalesce(sum(weight), 0), 6) AS mass, "
        "round(coalesce(sum(weight * idx), 0), 3) AS moment "
        "FROM prose LEFT JOIN weights USING (doc_id) GROUP BY doc_id",
    ),
)
def sparse_vectors(spark, sf_dir):
    rows = prose_table(spark, sf_dir)
    vocabulary = tfidf.tfidf_vocabulary(rows, "clean")
    weights = tfidf.tfidf_weights(rows, "doc_id", "clean", vocabulary)
    vectors = tfidf.to_sparse_vector(rows.select("doc_id"), "doc_id", weights, vocabulary.size)
    parts = vectors.select("doc_id", F.unwrap_udt("features").alias("v"))

    def total(array):
        return F.aggregate(array, F.lit(0.0), lambda a, x: a + x)

    return parts.select(
        "doc_id",
        F.col("v.size").cast("long").alias("size"),
        F.size("v.indices").cast("long").alias("filled"),
        F.round(total(F.col("v.values")), 6).alias("mass"),
        F.round(total(F.zip_with("v.values", "v.indices", lambda x, i: x * i)), 3).alias("moment"),
    )


@register(
    "class_weights",
    sql.with_ctes(
        TRAINING,
        "SELECT category, count(*) AS cnt, round(sum(count(*)) OVER () / "
        "(count(*) OVER () * count(*)), 6) AS weight FROM training GROUP BY category",
    ),
)
def class_weights(spark, sf_dir):
    weights = reports.class_weights(training_table(spark, sf_dir))
    return weights.select("category", "cnt", F.round("weight", 6).alias("weight"))


# ---- quality ---------------------------------------------------------------

# Each document's language against a guess by common words.
COMMON_WORDS = [("fr", " les "), ("de", " und "), ("es", " los "), ("en", " the ")]
_GUESS = (
    "CASE "
    + " ".join(f"WHEN contains(text, '{word}') THEN '{lang}'" for lang, word in COMMON_WORDS)
    + " ELSE 'none' END"
)
PAIRS = (
    f"pairs AS (SELECT lang AS truth, {_GUESS} AS predicted FROM documents), "
    "matrix AS MATERIALIZED (SELECT truth, predicted, count(*) AS cnt FROM pairs "
    "GROUP BY truth, predicted), "
    "classes AS (SELECT truth AS category FROM matrix UNION SELECT predicted FROM matrix), "
    "sums AS (SELECT category, "
    "coalesce(sum(cnt) FILTER (WHERE truth = category), 0) AS support, "
    "coalesce(sum(cnt) FILTER (WHERE predicted = category), 0) AS called, "
    "coalesce(sum(cnt) FILTER (WHERE truth = category AND predicted = category), 0) AS tp "
    "FROM classes CROSS JOIN matrix GROUP BY category), "
    "report AS MATERIALIZED (SELECT category, "
    "CASE WHEN called > 0 THEN tp / called ELSE 0 END AS precision, "
    "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, "
    "CASE WHEN called + support > 0 THEN 2 * tp / (called + support) ELSE 0 END AS f1, "
    "CAST(support AS BIGINT) AS support, tp FROM sums)"
)


def _pair_matrix(spark, sf_dir):
    guess = F.lit("none")
    for lang, word in reversed(COMMON_WORDS):
        guess = F.when(F.contains("text", F.lit(word)), lang).otherwise(guess)
    pairs = read(spark, sf_dir, "documents").select("lang", guess.alias("guess"))
    return reports.confusion(pairs, "lang", "guess")


@register("confusion", sql.with_ctes(PAIRS, "SELECT truth, predicted, cnt FROM matrix"))
def confusion(spark, sf_dir):
    return _pair_matrix(spark, sf_dir)


@register(
    "class_report",
    sql.with_ctes(
        PAIRS,
        "SELECT category, round(precision, 6) AS precision, round(recall, 6) AS recall, "
        "round(f1, 6) AS f1, support FROM report",
    ),
)
def class_report(spark, sf_dir):
    report = reports.class_report(_pair_matrix(spark, sf_dir))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("category", *rounded, "support")


_AVERAGES = ", ".join(
    [f"round(avg({c}), 6) AS {c}_macro" for c in ("precision", "recall", "f1")]
    + [
        f"round(sum({c} * support) / sum(support), 6) AS {c}_weighted"
        for c in ("precision", "recall", "f1")
    ]
)


@register(
    "scores",
    sql.with_ctes(
        PAIRS,
        "SELECT CAST(sum(support) AS BIGINT) AS support, round(sum(tp) / sum(support), 6) "
        f"AS accuracy, {_AVERAGES} FROM report",
    ),
)
def scores(spark, sf_dir):
    found = reports.scores(reports.class_report(_pair_matrix(spark, sf_dir)))
    return found.select("support", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


# ---- the text model --------------------------------------------------------


@register(
    "svm_names",
    sql.with_ctes(
        TRAINING + ", split AS (SELECT category, "
        f"{_SPLIT.format(by='category', order=sql.md5_order('text'))} AS is_val FROM training)",
        "SELECT category, count(*) AS support, true AS accuracy_above_floor, "
        "true AS f1_macro_above_floor FROM split WHERE is_val GROUP BY category",
    ),
)
def svm_names(spark, sf_dir):
    """Validation rows per class and whether the scores reach the published ones;
    only metrics can be compared, the solvers differ."""
    _, report, found = datasets.train_and_evaluate(training_table(spark, sf_dir))
    score = found.first()
    return report.where(F.col("support") > 0).select(
        "category",
        "support",
        F.lit(score["accuracy"] >= 0.98).alias("accuracy_above_floor"),
        F.lit(score["f1_macro"] >= 0.96).alias("f1_macro_above_floor"),
    )


@register(
    "svm_documents",
    "WITH split AS (SELECT lang, "
    f"{_SPLIT.format(by='lang', order=sql.md5_order('doc_id'))} AS is_val FROM documents) "
    "SELECT count(*) AS support, true AS accuracy_above_floor, true AS f1_macro_above_floor "
    "FROM split WHERE is_val",
)
def svm_documents(spark, sf_dir):
    rows = prose(spark, sf_dir).withColumnRenamed("lang", "category")
    _, _, found = datasets.train_and_evaluate(
        materialise(rows, "prose"), "doc_id"
    )
    return found.select(
        "support",
        (F.col("accuracy") >= 0.96).alias("accuracy_above_floor"),
        (F.col("f1_macro") >= 0.95).alias("f1_macro_above_floor"),
    )


@register(
    "svm_backfill",
    sql.with_ctes(
        sql.V1,
        f"SELECT CASE WHEN category = {sql.FALLBACK} AND clean <> '' THEN 'ml' ELSE source END "
        "AS source, count(*) AS cnt, 0 AS unlabelled FROM v1 GROUP BY 1",
    ),
)
def svm_backfill(spark, sf_dir):
    """The whole second layer: train on the rule labels, fill what they left."""
    v1 = pseudo_label_table(spark, sf_dir)
    rows = materialise(datasets.training_set(v1, MIN_ROWS, MAX_ROWS), "training")
    model = train_text_model(rows, "clean")
    v2 = labelling.backfill_with_ml(v1, model.predict_clean)
    return v2.groupBy("source").agg(
        F.count("*").alias("cnt"),
        F.count_if(F.col("category").isNull()).cast("int").alias("unlabelled"),
    )
