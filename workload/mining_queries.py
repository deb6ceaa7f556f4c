"""Queries on token and n-gram counts, keyword lists and rule drafts, over the
short names and over long prose."""

from __future__ import annotations

from pyspark.sql import functions as F

from nomina import fixed
from nomina.operators import lemmas, mining
from nomina.operators.terms import distinct_words
from nomina.operators.texts import clean_rows
from nomina.plans.mining import mine
from nomina.scratch import materialise
from nomina.sources.tables import count_line
from workload import sql
from workload.label_queries import clean_names, pseudo_label_table
from workload.names import names, read
from workload.registry import register

# Names cleaned twice, as mining does.
MINED = (
    f"{sql.NAMES}, mined AS (SELECT count(*) AS n, {sql.clean(sql.clean('name'))} AS clean "
    f"FROM names GROUP BY name), cut AS MATERIALIZED (SELECT n, {sql.tokens('clean')} AS words "
    "FROM mined)"
)
TOKEN_COUNTS = (
    f"{MINED}, token_counts AS MATERIALIZED (SELECT token, CAST(sum(n) AS BIGINT) AS cnt FROM "
    "(SELECT unnest(words) AS token, n FROM cut) GROUP BY token)"
)
NGRAM_COUNTS = (
    f"{MINED}, ngram_counts AS MATERIALIZED (SELECT ngram, CAST(sum(n) AS BIGINT) AS cnt FROM "
    f"(SELECT unnest({sql.ngrams_2_3('words')}) AS ngram, n FROM cut) GROUP BY ngram)"
)
PROSE = (
    f"prose AS MATERIALIZED (SELECT doc_id, {sql.tokens(sql.clean('text'))} AS words "
    "FROM documents)"
)


def prose(spark, sf_dir):
    rows = read(spark, sf_dir, "documents")
    return clean_rows(rows.select("doc_id", "lang", "text"), "text").drop("text")


@register("token_counts", sql.with_ctes(TOKEN_COUNTS, "SELECT token, cnt FROM token_counts"))
def token_counts(spark, sf_dir):
    return mine(names(spark, sf_dir), "name").tokens


@register("ngram_counts", sql.with_ctes(NGRAM_COUNTS, "SELECT ngram, cnt FROM ngram_counts"))
def ngram_counts(spark, sf_dir):
    return mine(names(spark, sf_dir), "name").ngrams


@register(
    "document_token_counts",
    sql.with_ctes(
        PROSE,
        "SELECT token, count(*) AS cnt FROM (SELECT unnest(words) AS token FROM prose) "
        "GROUP BY token",
    ),
)
def document_token_counts(spark, sf_dir):
    return mining.token_counts(prose(spark, sf_dir), "clean")


@register(
    "document_top_ngrams",
    sql.with_ctes(
        PROSE,
        f"SELECT ngram, count(*) AS cnt FROM (SELECT unnest({sql.ngrams_2_3('words')}) AS ngram "
        "FROM prose) GROUP BY ngram ORDER BY cnt DESC, ngram LIMIT 500",
    ),
)
def document_top_ngrams(spark, sf_dir):
    return mining.top_ngrams(materialise(prose(spark, sf_dir), "prose"), "clean", fixed.TOP_NGRAMS)


@register(
    "vocabulary_size",
    sql.with_ctes(
        f"{TOKEN_COUNTS}, {NGRAM_COUNTS.removeprefix(MINED + ', ')}",
        "SELECT (SELECT count(*) FROM token_counts) AS tokens, "
        "(SELECT count(*) FROM ngram_counts) AS ngrams",
    ),
)
def vocabulary_size(spark, sf_dir):
    mined = mine(names(spark, sf_dir), "name")
    return mining.vocabulary_size(mined.tokens, mined.ngrams)


@register(
    "top_keywords",
    sql.with_ctes(
        TOKEN_COUNTS,
        "SELECT token, cnt FROM (SELECT * FROM token_counts ORDER BY cnt DESC, token LIMIT 3000) "
        "WHERE cnt >= 25",
    ),
)
def top_keywords(spark, sf_dir):
    return mining.top_keywords(mine(names(spark, sf_dir), "name").tokens)


@register(
    "keyword_lines",
    sql.with_ctes(
        TOKEN_COUNTS,
        "SELECT token || ': ' || CAST(cnt AS VARCHAR) AS line FROM "
        "(SELECT * FROM token_counts ORDER BY cnt DESC, token LIMIT 3000) WHERE cnt >= 25",
    ),
)
def keyword_lines(spark, sf_dir):
    return top_keywords(spark, sf_dir).select(count_line("token").alias("line"))


@register(
    "draft_rules",
    sql.with_ctes(
        NGRAM_COUNTS,
        "SELECT ngram, cnt, replace(ngram, ' ', '.*') AS pattern, '???' AS category, "
        "10 AS priority, string_split(ngram, ' ')[1] AS apply_if FROM "
        "(SELECT * FROM ngram_counts ORDER BY cnt DESC, ngram LIMIT 500) WHERE cnt >= 80",
    ),
)
def draft_rules(spark, sf_dir):
    texts = mining.mining_texts(names(spark, sf_dir), "name")
    drafts = mining.draft_rules(mining.top_ngrams(texts, "clean", fixed.TOP_NGRAMS, weight="n"))
    first = F.array_join("apply_if", "|").alias("apply_if")
    return drafts.select("ngram", "cnt", "pattern", "category", "priority", first)


UNMATCHED = (
    f"{sql.V1}, unmatched AS (SELECT unnest({sql.tokens('clean')}) AS token FROM v1 "
    f"WHERE category IS NULL OR category IN ('', {sql.FALLBACK}))"
)


@register(
    "unmatched_words",
    sql.with_ctes(
        UNMATCHED,
        "SELECT token, count(*) AS cnt FROM unmatched GROUP BY token "
        "ORDER BY cnt DESC, token LIMIT 400",
    ),
)
def unmatched_words(spark, sf_dir):
    counts = mining.unmatched_token_counts(pseudo_label_table(spark, sf_dir), "text")
    return mining.top_unmatched(counts)


# A stand-in dictionary made of the words in use: endings are cut off.
_LEMMA = "regexp_replace({word}, '(ый|ое|ая|ная|ние|ка|и|ы|а|s|es|ed)$', '')"
LEMMAS = (
    f"{sql.TEXTS}, cleans AS (SELECT DISTINCT clean FROM texts), "
    f"cut AS (SELECT clean, {sql.tokens('clean')} AS words FROM cleans)"
)


def _dictionary(texts):
    """(word, lemma) for the words of five or more letters."""
    return _stems(distinct_words(texts, "clean"))


def _stems(words):
    lemma = F.regexp_replace("word", "(ый|ое|ая|ная|ние|ка|и|ы|а|s|es|ed)$", "")
    return words.where(F.length("word") >= 5).select("word", lemma.alias("lemma"))


def _lemma_sql(word: str) -> str:
    return f"CASE WHEN length({word}) >= 5 THEN {_LEMMA.format(word=word)} ELSE {word} END"


@register(
    "lemma_join",
    sql.with_ctes(
        LEMMAS,
        "SELECT clean, array_to_string(list_transform(words, "
        f"lambda w: {_lemma_sql('w')}), ' ') AS lemmas FROM cut",
    ),
)
def lemma_join(spark, sf_dir):
    cleans = clean_names(spark, sf_dir)
    return mining.lemma_normalize(cleans, "clean", "clean", _dictionary(cleans))


@register(
    "document_lemmas",
    sql.with_ctes(
        PROSE,
        "SELECT doc_id, md5(array_to_string(list_transform(words, "
        f"lambda w: {_lemma_sql('w')}), ' ')) AS digest FROM prose",
    ),
)
def document_lemmas(spark, sf_dir):
    cleaned = materialise(prose(spark, sf_dir), "prose")
    lemmas = mining.lemma_normalize(cleaned, "doc_id", "clean", _dictionary(cleaned))
    return lemmas.select("doc_id", F.md5("lemmas").alias("digest"))


@register(
    "mined_lemmas",
    sql.with_ctes(
        MINED,
        f"SELECT {_lemma_sql('token')} AS token, CAST(sum(n) AS BIGINT) AS cnt "
        "FROM (SELECT unnest(words) AS token, n FROM cut) GROUP BY 1",
    ),
)
def mined_lemmas(spark, sf_dir):
    rows = names(spark, sf_dir)
    texts = materialise(mining.mining_texts(rows, "name"), "texts")
    return mine(rows, "name", _dictionary(texts)).tokens


# Three in four words are in the dictionary; the others are guessed.
ENDINGS = (
    f"{PROSE}, used AS MATERIALIZED (SELECT DISTINCT unnest(words) AS word FROM prose), "
    f"dict AS MATERIALIZED (SELECT word, {_LEMMA.format(word='word')} AS lemma FROM used "
    "WHERE length(word) >= 5 AND md5(word) >= '4'), "
    "same AS (SELECT *, len(list_filter(range(0, least(length(word), length(lemma)) + 1), "
    "lambda i: left(word, i) = left(lemma, i))) - 1 AS n FROM dict), "
    "changes AS (SELECT word, length(word) - n AS cut, substr(lemma, n + 1) AS tail FROM same), "
    "votes AS (SELECT right(word, k) AS ending, cut, tail FROM (SELECT *, "
    "unnest(range(greatest(cut, 1), least(6, length(word) - 2) + 1)) AS k FROM changes)), "
    "counted AS (SELECT ending, cut, tail, count(*) AS agree FROM votes GROUP BY ALL), "
    "endings AS MATERIALIZED (SELECT ending, CAST(cut AS INTEGER) AS cut, tail, "
    "CAST(sum(agree) OVER (PARTITION BY ending) AS BIGINT) AS words, agree FROM counted "
    "QUALIFY row_number() OVER (PARTITION BY ending ORDER BY agree DESC, cut, tail) = 1)"
)
GUESSED = (
    f"{ENDINGS}, parts AS (SELECT word, k, right(word, k) AS ending FROM (SELECT word, "
    "unnest(range(1, least(6, length(word) - 2) + 1)) AS k FROM used ANTI JOIN dict USING (word))), "
    "longest AS (SELECT word, substr(word, 1, length(word) - cut) || tail AS lemma FROM parts "
    "JOIN endings USING (ending) WHERE words >= 3 QUALIFY row_number() OVER (PARTITION BY word ORDER BY k DESC) = 1), "
    "lemmas AS MATERIALIZED (SELECT word, coalesce(d.lemma, g.lemma, word) AS lemma, CASE WHEN d.lemma IS NOT NULL "
    "THEN 'dictionary' WHEN g.lemma IS NOT NULL THEN 'ending' ELSE 'unknown' END AS source "
    "FROM used LEFT JOIN dict d USING (word) LEFT JOIN longest g USING (word))"
)


def _known_words(texts):
    return _dictionary(texts).where(F.md5("word") >= "4")


@register("learned_endings", sql.with_ctes(ENDINGS, "SELECT ending, cut, tail, words, agree FROM endings"))
def learned_endings(spark, sf_dir):
    return lemmas.learn_endings(_known_words(materialise(prose(spark, sf_dir), "prose")))


@register("guessed_lemmas", sql.with_ctes(GUESSED, "SELECT word, lemma, source FROM lemmas"))
def guessed_lemmas(spark, sf_dir):
    """The lemma of every word of the documents and where it is from."""
    texts = materialise(prose(spark, sf_dir), "prose")
    words = materialise(distinct_words(texts, "clean"), "words")
    known = materialise(_stems(words).where(F.md5("word") >= "4"), "dictionary")
    return lemmas.lemma_table(words, known, lemmas.learn_endings(known))


@register(
    "document_guessed_lemmas",
    sql.with_ctes(
        f"{GUESSED}, placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM prose), "
        "joined AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY i) AS text FROM placed JOIN lemmas USING (word) "
        "GROUP BY doc_id)",
        "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM prose LEFT JOIN joined USING (doc_id)",
    ),
)
def document_guessed_lemmas(spark, sf_dir):
    """Documents with their words replaced by known and guessed lemmas."""
    texts = materialise(prose(spark, sf_dir), "prose")
    done = lemmas.lemmatise(texts, "doc_id", "clean", _known_words(texts))
    return done.select("doc_id", F.md5("lemmas").alias("digest"))
