"""Queries on cleaning, tokens and label columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from nomina.functions import cleaning as C
from nomina.functions import labels as L
from nomina.functions import tokens as T
from nomina.operators.texts import clean_by_text, clean_rows, distinct_texts
from workload import sql
from workload.names import decomposed_names, names, read
from workload.registry import register

DECOMPOSED = (
    f"{sql.NAMES}, odd AS (SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 1 "
    "THEN replace(name, chr(1081), chr(1080) || chr(774)) ELSE name END AS name FROM names)"
)


@register(
    "nfc_text",
    sql.with_ctes(
        DECOMPOSED,
        "SELECT l_orderkey, nfc_normalize(name) AS composed, "
        f"length(name) AS chars, {sql.clean('name')} AS clean FROM odd",
    ),
)
def nfc_text(spark, sf_dir):
    name = F.col("name")
    return decomposed_names(spark, sf_dir).select(
        "l_orderkey",
        C.compose(name).alias("composed"),
        F.length(name).cast("long").alias("chars"),
        C.clean(name).alias("clean"),
    )


@register(
    "clean_raw",
    sql.with_ctes(
        sql.NAMES,
        f"SELECT l_orderkey, {sql.dashes('name')} AS dashes, {sql.slashes('name')} AS slashes, "
        f"{sql.clean_raw('name')} AS raw FROM names",
    ),
)
def clean_raw(spark, sf_dir):
    name = F.col("name")
    return names(spark, sf_dir).select(
        "l_orderkey",
        C.unify_dashes(name).alias("dashes"),
        C.unify_slashes(name).alias("slashes"),
        C.clean_raw(C.compose(name)).alias("raw"),
    )


@register(
    "strip_code",
    sql.with_ctes(sql.NAMES, f"SELECT l_orderkey, {sql.strip_code('name')} AS text FROM names"),
)
def strip_code(spark, sf_dir):
    text = C.strip_leading_code(F.col("name"))
    return names(spark, sf_dir).select("l_orderkey", text.alias("text"))


@register(
    "date_tail",
    sql.with_ctes(sql.NAMES, f"SELECT l_orderkey, {sql.date_tail('name')} AS text FROM names"),
)
def date_tail(spark, sf_dir):
    text = C.strip_date_tail(F.col("name"))
    return names(spark, sf_dir).select("l_orderkey", text.alias("text"))


@register(
    "char_filter",
    sql.with_ctes(
        sql.NAMES,
        f"SELECT l_orderkey, {sql.filter_chars('name')} AS kept, "
        f"{sql.squeeze('name')} AS squeezed FROM names",
    ),
)
def char_filter(spark, sf_dir):
    name = F.col("name")
    return names(spark, sf_dir).select(
        "l_orderkey", C.filter_chars(name).alias("kept"), C.squeeze_space(name).alias("squeezed")
    )


@register(
    "clean_text",
    sql.with_ctes(
        sql.NAMES, f"SELECT l_orderkey, name, {sql.clean('name')} AS clean FROM names"
    ),
)
def clean_text(spark, sf_dir):
    return clean_by_text(names(spark, sf_dir), "name").select("l_orderkey", "name", "clean")


@register(
    "clean_documents",
    f"SELECT doc_id, md5({sql.clean('text')}) AS digest, length({sql.clean('text')}) AS chars "
    "FROM documents",
)
def clean_documents(spark, sf_dir):
    cleaned = clean_rows(read(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return cleaned.select(
        "doc_id", F.md5("clean").alias("digest"), F.length("clean").cast("long").alias("chars")
    )


@register(
    "clean_turns",
    f"SELECT conv_id, turn, role, {sql.clean('text')} AS clean FROM conversations",
)
def clean_turns(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return clean_rows(rows, "text").drop("text")


@register(
    "tokens",
    sql.with_ctes(
        sql.TEXTS + f", cut AS (SELECT name, {sql.tokens('clean')} AS words FROM texts)",
        "SELECT name, len(words) AS n_tokens, array_to_string(words, '|') AS tokens, "
        "array_to_string(list_filter(words, lambda t: length(t) > 2 AND NOT "
        "regexp_full_match(t, '[0-9]+')), '|') AS informative, "
        f"array_to_string({sql.ngrams_2_3('words')}, '|') AS ngrams FROM cut",
    ),
)
def tokens(spark, sf_dir):
    texts = distinct_texts(names(spark, sf_dir), "name")
    words = T.tokenize(C.clean(F.col("name")))
    cut = texts.select("name", words.alias("words"))
    listed = F.col("words")
    return cut.select(
        "name",
        F.size(listed).cast("long").alias("n_tokens"),
        F.array_join(listed, "|").alias("tokens"),
        F.array_join(T.informative_tokens(listed), "|").alias("informative"),
        F.array_join(T.word_ngrams(listed), "|").alias("ngrams"),
    )


@register(
    "label_columns",
    sql.with_ctes(
        sql.CASCADE,
        "SELECT name, 'rules' AS source, label, "
        f"CASE WHEN label = {sql.EMPTY} THEN {sql.FALLBACK} ELSE label END AS category, "
        f"label <> {sql.FALLBACK} AS labeled, label = {sql.FALLBACK} AS unmatched, "
        "starts_with(label, 'МУСОР') AS junk, clean <> '' AS has_text, "
        "contains(clean, 'масло') AND contains(clean, 'мотор') AS has_all, "
        "NOT contains(clean, 'офис') AND NOT contains(clean, 'шина') AS has_none, "
        "regexp_matches(clean, 'кабель.*ввг|^тест$') AS matched, "
        "string_split(label, ' → ')[1] AS level1, len(string_split(label, ' → ')) AS depth "
        "FROM labelled",
    ),
)
def label_columns(spark, sf_dir):
    from workload.label_queries import labelled_names

    label, text = F.col("label"), F.col("clean")
    levels = L.category_levels(label)
    return labelled_names(spark, sf_dir).select(
        "name",
        F.lit("rules").alias("source"),
        "label",
        L.normalize_label(label).alias("category"),
        L.is_labeled(label).alias("labeled"),
        L.is_unmatched(label).alias("unmatched"),
        L.is_junk(label).alias("junk"),
        L.has_text(text).alias("has_text"),
        L.contains_all(text, ["масло", "мотор"]).alias("has_all"),
        L.contains_none(text, ["офис", "шина"]).alias("has_none"),
        text.rlike("кабель.*ввг|^тест$").alias("matched"),
        F.get(levels, 0).alias("level1"),
        F.size(levels).cast("long").alias("depth"),
    )


@register(
    "cast_text",
    "SELECT doc_id, coalesce(CAST(CASE WHEN n_chars % 3 <> 0 THEN n_chars END AS VARCHAR), '') "
    "AS text FROM documents",
)
def cast_text(spark, sf_dir):
    value = F.when(F.col("n_chars") % 3 != 0, F.col("n_chars"))
    rows = read(spark, sf_dir, "documents")
    return rows.select("doc_id", C.cast_text(value).alias("text"))


@register(
    "keep_options",
    sql.with_ctes(
        sql.TEXTS,
        f"SELECT name, {sql.squeeze(sql.filter_chars(sql.date_tail(sql.clean_raw('name'))))} "
        f"AS with_codes, {sql.clean(sql.clean('name'))} AS twice FROM texts",
    ),
)
def keep_options(spark, sf_dir):
    name = F.col("name")
    return distinct_texts(names(spark, sf_dir), "name").select(
        "name",
        C.clean(name, keep_codes=True).alias("with_codes"),
        C.clean(name, passes=2).alias("twice"),
    )
