"""Queries on rules, the label cascade, coverage and review samples."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from nomina import fixed
from nomina.functions.cleaning import clean
from nomina.functions.labels import is_labeled
from nomina.functions.tokens import tokenize
from nomina.operators import cascade, matching, reports
from nomina.operators.dataset import dedupe_prefer_labeled
from nomina.operators.memory import LabelMemory, rematch
from nomina.operators.rule_index import match_indexed
from nomina.operators.rules import Rule, RuleSet, shipped_anchors, shipped_rules
from nomina.operators.texts import clean_distinct, clean_rows
from nomina.plans import labelling
from nomina.scratch import attach, materialise, scratch_path
from workload import sql
from workload.names import names, read
from workload.registry import register

RULES, ANCHORS = shipped_rules(), shipped_anchors()


def labelled_names(spark, sf_dir):
    return cascade.label_distinct(names(spark, sf_dir), "name", RULES, ANCHORS)


def clean_names(spark, sf_dir):
    """Distinct cleaned names with row counts, as a written table."""
    cleaned = clean_distinct(names(spark, sf_dir), "name")
    return materialise(cleaned.groupBy("clean").agg(F.sum("n").alias("n")), "cleans")


def pseudo_label_table(spark, sf_dir):
    """v1 as a written table."""
    v1 = labelling.pseudo_labels(names(spark, sf_dir), "name", RULES, ANCHORS)
    return materialise(v1, "v1")


@register(
    "anchor_match",
    sql.with_ctes(
        sql.CLEANS,
        f"SELECT clean, {sql.pick(sql.ANCHORS, 'anchor_id', 'category')} AS anchor, "
        "anchor_id IS NOT NULL AS is_example FROM ranked",
    ),
)
def anchor_match(spark, sf_dir):
    text = F.col("clean")
    return clean_names(spark, sf_dir).select(
        "clean",
        matching.match_anchors(text, ANCHORS).alias("anchor"),
        matching.is_anchor_example(text, ANCHORS).alias("is_example"),
    )


@register(
    "rule_match",
    sql.with_ctes(
        sql.CLEANS,
        f"SELECT clean, {sql.pick(sql.RULES, 'any_rule_id', 'category')} AS category FROM ranked",
    ),
)
def rule_match(spark, sf_dir):
    category = matching.match_rules(F.col("clean"), RULES)
    return clean_names(spark, sf_dir).select("clean", category.alias("category"))


@register(
    "rule_explain",
    sql.with_ctes(
        sql.CLEANS + ", " + sql.rule_table(sql.RULES),
        "SELECT clean, category, pattern, priority, apply_if, exclude_if "
        "FROM ranked LEFT JOIN rules ON any_rule_id = rule_id",
    ),
)
def rule_explain(spark, sf_dir):
    explained = matching.match_rules_explain(clean_names(spark, sf_dir), "clean", RULES)
    return explained.select(
        "clean",
        "match.category",
        "match.pattern",
        "match.priority",
        F.array_join("match.apply_if", "|").alias("apply_if"),
        F.array_join("match.exclude_if", "|").alias("exclude_if"),
    )


@register(
    "rule_matches",
    sql.with_ctes(
        sql.CLEANS,
        f"SELECT clean, unnest({sql.all_matches(sql.RULES, 'clean')}) AS rule_id FROM cleans",
    ),
)
def rule_matches(spark, sf_dir):
    return matching.all_rule_matches(clean_names(spark, sf_dir), "clean", RULES).select(
        "clean", "rule_id"
    )


@register(
    "rule_best_match",
    sql.with_ctes(
        sql.CLEANS + ", hits AS (SELECT clean, list_min("
        f"{sql.all_matches(sql.RULES, 'clean')}) AS best FROM cleans)",
        f"SELECT clean, {sql.pick(sql.RULES, 'best', 'pattern')} AS triggered_pattern, "
        f"{sql.pick(sql.RULES, 'best', 'category')} AS triggered_rule_category FROM hits",
    ),
)
def rule_best_match(spark, sf_dir):
    return matching.best_rule_match(
        clean_names(spark, sf_dir).select("clean"), "clean", RULES
    )


@register(
    "rule_stats",
    sql.with_ctes(
        sql.CASCADE + ", per_clean AS (SELECT clean, rule_id, sum(n) AS n FROM labelled "
        "GROUP BY clean, rule_id)",
        "SELECT rule_id, CAST(sum(n) AS BIGINT) AS hits, count(*) AS distinct_texts, "
        f"{sql.pick(sql.RULES, 'rule_id', 'pattern')} AS pattern, "
        f"{sql.pick(sql.RULES, 'rule_id', 'category')} AS category "
        "FROM per_clean WHERE rule_id IS NOT NULL GROUP BY rule_id",
    ),
)
def rule_stats(spark, sf_dir):
    labelled = cascade.label_clean_texts(clean_names(spark, sf_dir), RULES, ANCHORS)
    return matching.rule_hit_stats(labelled.where(F.col("clean") != ""), RULES)


@register(
    "rule_audit",
    sql.with_ctes(
        sql.CLEANS + ", " + sql.rule_table(sql.RULES)
        + f", hits AS (SELECT n, {sql.all_matches(sql.RULES, 'clean')} AS ids FROM cleans), "
        "each_hit AS (SELECT n, list_min(ids) AS best, unnest(ids) AS id FROM hits)",
        "SELECT rule_id, pattern, category, CAST(coalesce(sum(n), 0) AS BIGINT) AS matches, "
        "CAST(coalesce(sum(n) FILTER (WHERE best = id), 0) AS BIGINT) AS wins "
        "FROM rules LEFT JOIN each_hit ON id = rule_id GROUP BY rule_id, pattern, category",
    ),
)
def rule_audit(spark, sf_dir):
    return matching.rule_audit(clean_names(spark, sf_dir), "clean", RULES)


MATCHED = f"{sql.CLEANS}, matched AS MATERIALIZED (SELECT clean, n, {sql.all_matches(sql.RULES, 'clean')} AS ids FROM cleans)"


@register(
    "rule_cover",
    sql.with_ctes(
        MATCHED + ", pairs AS (SELECT n, unnest(ids) AS rule_id, list_min(ids) AS cover_id FROM matched)",
        "SELECT rule_id, cover_id, CAST(sum(n) AS BIGINT) AS rows, count(*) AS texts, "
        "round(sum(n) / sum(sum(n)) OVER (PARTITION BY rule_id), 6) AS share FROM pairs GROUP BY rule_id, cover_id",
    ),
)
def rule_cover(spark, sf_dir):
    """Which rules take the texts of each rule."""
    cover = matching.rule_cover(clean_names(spark, sf_dir), "clean", RULES)
    return cover.withColumn("share", F.round("share", 6))


@register(
    "rule_overlap",
    sql.with_ctes(
        MATCHED + ", hits AS MATERIALIZED (SELECT clean, unnest(ids) AS r FROM matched), "
        "sizes AS (SELECT r, count(*) AS n FROM hits GROUP BY r), "
        "pairs AS (SELECT a.r AS rule_a, b.r AS rule_b, count(*) AS common FROM hits a JOIN hits b USING (clean) "
        "WHERE a.r < b.r GROUP BY ALL)",
        "SELECT rule_a, rule_b, common, x.n - common AS only_a, y.n - common AS only_b FROM pairs "
        "JOIN sizes x ON x.r = rule_a JOIN sizes y ON y.r = rule_b",
    ),
)
def rule_overlap(spark, sf_dir):
    """Rules that match names in common."""
    return matching.rule_overlap(clean_names(spark, sf_dir), "clean", RULES)


@register(
    "cascade_label",
    sql.with_ctes(
        sql.CASCADE,
        "SELECT l_orderkey, l_linenumber, name AS input, clean, label, reason, rule "
        "FROM names JOIN labelled USING (name)",
    ),
)
def cascade_label(spark, sf_dir):
    rows = cascade.label_rows(names(spark, sf_dir), "name", RULES, ANCHORS)
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("name").alias("input"), "clean", "label", "reason", "rule"
    )


@register(
    "prediction_rows",
    sql.with_ctes(
        sql.CASCADE,
        "SELECT label, reason, rule, count(*) AS cnt FROM names JOIN labelled USING (name) "
        "GROUP BY label, reason, rule",
    ),
)
def prediction_rows(spark, sf_dir):
    rows = cascade.label_rows(names(spark, sf_dir), "name", RULES, ANCHORS)
    packed = cascade.with_prediction(rows, "name")
    return packed.groupBy(
        "label", F.col("explanation.reason").alias("reason"), F.col("explanation.rule").alias("rule")
    ).agg(F.count("*").alias("cnt"))


@register(
    "empty_policy",
    sql.with_ctes(
        sql.CASCADE,
        "SELECT name, label AS by_clean, "
        f"CASE WHEN {sql.strip('name')} = '' THEN {sql.EMPTY} "
        f"ELSE coalesce(cascade.rule, {sql.FALLBACK}) END AS by_raw "
        "FROM labelled JOIN cascade USING (clean)",
    ),
)
def empty_policy(spark, sf_dir):
    rows = names(spark, sf_dir)
    by_clean = cascade.label_distinct(rows, "name", RULES, ANCHORS)
    by_raw = cascade.label_distinct(rows, "name", RULES, ANCHORS, empty_on="raw")
    return by_clean.select("name", F.col("label").alias("by_clean")).join(
        by_raw.select("name", F.col("label").alias("by_raw")), "name"
    )


@register(
    "label_distinct",
    sql.with_ctes(sql.CASCADE, "SELECT name, n, clean, label, reason, rule, rule_id FROM labelled"),
)
def label_distinct(spark, sf_dir):
    return labelled_names(spark, sf_dir).select(
        "name", "n", "clean", "label", "reason", "rule", "rule_id"
    )


@register("pseudo_labels", sql.with_ctes(sql.V1, "SELECT text, category, source FROM v1"))
def pseudo_labels(spark, sf_dir):
    return labelling.pseudo_labels(names(spark, sf_dir), "name", RULES, ANCHORS)


@register(
    "dedupe_prefer_labeled",
    sql.with_ctes(
        sql.V1 + ", mixed AS (SELECT name AS text, CASE WHEN l_linenumber % 3 = 0 THEN category "
        f"ELSE {sql.FALLBACK} END AS category, source FROM names JOIN v1 ON name = text)",
        "SELECT text, category, source FROM mixed QUALIFY row_number() OVER (PARTITION BY text "
        f"ORDER BY category = {sql.FALLBACK}, category, source) = 1",
    ),
)
def dedupe(spark, sf_dir):
    rows = cascade.label_rows(names(spark, sf_dir), "name", RULES, ANCHORS)
    known = (F.col("l_linenumber") % 3 == 0) & (F.col("label") != fixed.EMPTY_LABEL)
    mixed = rows.select(
        F.col("name").alias("text"),
        F.when(known, F.col("label")).otherwise(fixed.FALLBACK_LABEL).alias("category"),
        F.lit("rules").alias("source"),
    )
    return dedupe_prefer_labeled(mixed)


@register(
    "pseudo_label_coverage",
    sql.with_ctes(
        sql.V1,
        "SELECT category, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) "
        f"AS share, category <> {sql.FALLBACK} AS labeled FROM v1 GROUP BY category",
    ),
)
def pseudo_label_coverage(spark, sf_dir):
    v1 = pseudo_label_table(spark, sf_dir)
    total = v1.count()
    counts = reports.category_counts(v1)
    share = F.round(F.col("cnt") * 100.0 / F.lit(total), 6)
    labeled = is_labeled(F.col("category"))
    return counts.select("category", "cnt", share.alias("share"), labeled.alias("labeled"))


_COVERAGE = (
    f"SELECT count(*) AS total, count(*) FILTER (WHERE category <> {sql.FALLBACK}) AS labeled, "
    f"round(count(*) FILTER (WHERE category <> {sql.FALLBACK}) / count(*) * 100, 6) AS coverage, "
    f"count(*) FILTER (WHERE category = {sql.FALLBACK}) AS unmatched FROM "
)


@register("coverage", sql.with_ctes(sql.V1, _COVERAGE + "v1"))
def coverage(spark, sf_dir):
    found = reports.coverage(pseudo_label_table(spark, sf_dir))
    return found.withColumn("coverage", F.round("coverage", 6))


@register(
    "category_counts",
    sql.with_ctes(sql.V1, "SELECT category, count(*) AS cnt FROM v1 GROUP BY category"),
)
def category_counts(spark, sf_dir):
    return reports.category_counts(pseudo_label_table(spark, sf_dir))


@register(
    "top_categories",
    sql.with_ctes(
        sql.V1,
        "SELECT category, count(*) AS cnt FROM v1 GROUP BY category "
        "ORDER BY cnt DESC, category LIMIT 20",
    ),
)
def top_categories(spark, sf_dir):
    return reports.top_categories(pseudo_label_table(spark, sf_dir))


@register(
    "distinct_categories",
    sql.with_ctes(sql.V1, "SELECT count(DISTINCT category) AS categories FROM v1"),
)
def distinct_categories(spark, sf_dir):
    return reports.distinct_categories(pseudo_label_table(spark, sf_dir))


@register(
    "level_rollup",
    sql.with_ctes(
        sql.V1 + ", parts AS (SELECT string_split(category, ' → ')[1] AS level1, "
        "coalesce(string_split(category, ' → ')[2], '') AS level2, source FROM v1)",
        "SELECT level1, level2, source, count(*) AS cnt, "
        "CAST(GROUPING(level1, level2, source) AS INTEGER) AS depth "
        "FROM parts GROUP BY ROLLUP (level1, level2, source)",
    ),
)
def level_rollup(spark, sf_dir):
    return reports.level_rollup(pseudo_label_table(spark, sf_dir))


@register(
    "qa_sample",
    sql.with_ctes(
        sql.V1 + f", drawn AS (SELECT * FROM v1 WHERE category <> {sql.FALLBACK} "
        f"ORDER BY {sql.md5_order('text')} LIMIT 1000)",
        "SELECT text, category, source, clean AS clean_text, "
        f"{sql.pick(sql.RULES, 'any_rule_id', 'pattern')} AS triggered_pattern, "
        f"{sql.pick(sql.RULES, 'any_rule_id', 'category')} AS triggered_rule_category, "
        "reason FROM drawn JOIN cascade USING (clean)",
    ),
)
def qa_sample(spark, sf_dir):
    return labelling.qa_sample(pseudo_label_table(spark, sf_dir), RULES, ANCHORS)


def stub_model(v1):
    """A model tier SQL can express: the most frequent rule category among the
    names with the same first word, else the fallback."""
    known = v1.where(is_labeled(F.col("category")))
    word = F.get(F.split(clean(F.col("text")), " "), 0)
    counts = known.select(word.alias("word"), "category").groupBy("word", "category").count()
    best = counts.groupBy("word").agg(F.min(F.struct(-F.col("count"), "category")).alias("best"))
    answers = materialise(best.select("word", F.col("best.category").alias("answer")), "stub")

    def predict(cleans):
        first = cleans.withColumn("word", F.get(F.split("clean", " "), 0))
        label = F.coalesce("answer", F.lit(fixed.FALLBACK_LABEL)).alias("ml_label")
        return first.join(answers, "word", "left").select("clean", label)

    return predict


STUB = (
    f"{sql.V1}, firsts AS (SELECT *, string_split(clean, ' ')[1] AS word FROM v1), "
    "word_counts AS (SELECT word, category, count(*) AS cnt FROM firsts "
    f"WHERE category <> {sql.FALLBACK} GROUP BY word, category), "
    "answers AS (SELECT word, category AS answer FROM word_counts QUALIFY row_number() OVER "
    "(PARTITION BY word ORDER BY cnt DESC, category) = 1), "
    "v2 AS MATERIALIZED (SELECT text, clean, firsts.category AS category_before, "
    f"CASE WHEN category = {sql.FALLBACK} AND clean <> '' "
    f"THEN coalesce(answer, {sql.FALLBACK}) ELSE category END AS category, "
    f"CASE WHEN category = {sql.FALLBACK} AND clean <> '' THEN 'ml' ELSE source END AS source "
    "FROM firsts LEFT JOIN answers USING (word))"
)


def backfilled(spark, sf_dir):
    v1 = pseudo_label_table(spark, sf_dir)
    return v1, materialise(labelling.backfill_with_ml(v1, stub_model(v1)), "v2")


@register("ml_backfill", sql.with_ctes(STUB, "SELECT text, category, source FROM v2"))
def ml_backfill(spark, sf_dir):
    return backfilled(spark, sf_dir)[1]


@register(
    "coverage_delta",
    sql.with_ctes(
        STUB + ", counts AS (SELECT count(*) AS total, "
        f"count(*) FILTER (WHERE category_before = {sql.FALLBACK}) AS fallback_before, "
        f"count(*) FILTER (WHERE category = {sql.FALLBACK}) AS fallback_after FROM v2)",
        "SELECT *, round((total - fallback_before) / total * 100, 6) AS coverage_before, "
        "round((total - fallback_after) / total * 100, 6) AS coverage_after, "
        "round((fallback_before - fallback_after) / total * 100, 6) AS gain FROM counts",
    ),
)
def coverage_delta(spark, sf_dir):
    delta = reports.coverage_delta(*backfilled(spark, sf_dir))
    rounded = [F.round(c, 6).alias(c) for c in ("coverage_before", "coverage_after", "gain")]
    return delta.select("total", "fallback_before", "fallback_after", *rounded)


@register(
    "source_counts",
    sql.with_ctes(STUB, "SELECT source, count(*) AS cnt FROM v2 GROUP BY source"),
)
def source_counts(spark, sf_dir):
    return reports.source_counts(backfilled(spark, sf_dir)[1])


@register(
    "cascade_with_model",
    sql.with_ctes(
        STUB + ", firsts2 AS (SELECT *, string_split(clean, ' ')[1] AS word FROM labelled)",
        "SELECT name, clean, CASE WHEN reason = 'fallback_other' "
        f"THEN coalesce(answer, {sql.FALLBACK}) ELSE label END AS label, "
        "CASE WHEN reason = 'fallback_other' THEN 'ml_model' ELSE reason END AS reason, rule "
        "FROM firsts2 LEFT JOIN answers USING (word)",
    ),
)
def cascade_with_model(spark, sf_dir):
    model = stub_model(pseudo_label_table(spark, sf_dir))
    labelled = cascade.label_distinct(names(spark, sf_dir), "name", RULES, ANCHORS, model)
    return labelled.select("name", "clean", "label", "reason", "rule")


# Ten thousand rules over parts: a colour or size, a thing, a brand and a type.
THINGS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
TRAITS = ["blue", "cold", "hot", "large", "new", "old", "red", "small"]
TYPES = ["economy", "large", "medium", "promo", "small", "standard"]
PART_TEXT = "lower(concat(p_name, ' ', p_brand, ' ', p_type, ' ', p_partkey))"


def part_rules() -> RuleSet:
    rules = []
    for i in range(9600):
        trait, thing = TRAITS[i % 8], THINGS[i // 8 % 8]
        brand, kind = i // 64 % 25 + 1, TYPES[i // 1600]
        rules.append(Rule(f"{thing}.*brand#{brand} .*{kind}", f"c{i}", i * 7919 % 13, [trait], ["77"] if i % 3 else []))
    rules += [Rule(f"(?i)(^| ){i}$", f"c{i}", 20) for i in range(9600, 9900)]
    # Two words of which one is enough, and signs alone.
    rules += [Rule(f"(brand#{i % 25 + 1} small|{THINGS[i % 8]} .*{i % 100} promo)", f"c{i}", -1) for i in range(9900, 9990)]
    return RuleSet(rules + [Rule(rf"^.{{{i - 9960}}}$", f"c{i}", -2) for i in range(9990, 10000)])


@register(
    "many_rules",
    f"""
WITH parts AS MATERIALIZED (SELECT DISTINCT {PART_TEXT} AS text FROM part),
n AS (SELECT range AS i FROM range(9990)),
words AS (SELECT {TRAITS} AS traits, {THINGS} AS things, {TYPES} AS types),
rules AS MATERIALIZED (
    SELECT i, CASE WHEN i < 9600 THEN i * 7919 % 13 WHEN i < 9900 THEN 20 ELSE -1 END AS priority,
        CASE WHEN i < 9600 THEN '%' || things[i // 8 % 8 + 1] || '%brand#' || (i // 64 % 25 + 1) || ' %' || types[i // 1600 + 1] || '%'
            WHEN i < 9900 THEN '% ' || i ELSE '%brand#' || (i % 25 + 1) || ' small%' END AS pattern,
        CASE WHEN i < 9900 THEN NULL ELSE '%' || things[i % 8 + 1] || ' %' || (i % 100) || ' promo%' END AS other,
        CASE WHEN i < 9600 THEN traits[i % 8 + 1] ELSE '' END AS needed,
        CASE WHEN i < 9600 AND i % 3 > 0 THEN '77' END AS barred
    FROM n, words),
hits AS (
    SELECT text, arg_max(i, priority * 100000 - i) AS i FROM parts JOIN rules
    ON contains(text, needed) AND (text LIKE pattern OR coalesce(text LIKE other, false))
        AND NOT coalesce(contains(text, barred), false) GROUP BY text)
SELECT text, coalesce('c' || i, CASE WHEN length(text) BETWEEN 30 AND 39 THEN 'c' || (length(text) + 9960) END) AS category
FROM parts LEFT JOIN hits USING (text)
""",
)
def many_rules(spark, sf_dir):
    """The first of 10,000 rules for every distinct description of a part."""
    parts = read(spark, sf_dir, "part").select(F.expr(PART_TEXT).alias("text")).distinct()
    rules = part_rules()
    table = rules.table(spark).select("rule_id", "category")
    return match_indexed(parts, "text", rules).join(table, "rule_id", "left").select("text", "category")


# Phrases of two words from the documents themselves, 10,000 at most.
PHRASES = (
    f"prose AS MATERIALIZED (SELECT doc_id, {sql.clean('text')} AS clean FROM documents), "
    "cut AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda w: w <> '') AS words FROM prose), "
    "phrases AS MATERIALIZED (SELECT DISTINCT words[p] || ' ' || words[p + 1] AS phrase FROM "
    "(SELECT words, unnest(range(1, len(words), 7)) AS p FROM cut) "
    "ORDER BY md5(phrase) LIMIT 10000)"
)


def phrase_rules(spark, sf_dir) -> tuple:
    prose = materialise(clean_rows(read(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text"), "prose")
    split = prose.select(tokenize(F.col("clean")).alias("words")).where("size(words) > 1")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("words") - 2, F.lit(7)), lambda p: F.concat_ws(" ", F.get("words", p), F.get("words", p + 1))
    )
    some = materialise(split, "words").select(F.explode(pairs).alias("phrase")).distinct()
    chosen = some.orderBy(F.md5("phrase")).limit(10_000).collect()
    return prose, RuleSet(Rule(re.escape(r["phrase"]), r["phrase"]) for r in sorted(chosen, key=lambda r: r["phrase"].encode()))


@register(
    "many_rules_documents",
    sql.with_ctes(
        PHRASES,
        "SELECT doc_id, min(phrase) AS phrase FROM prose LEFT JOIN phrases ON contains(clean, phrase) GROUP BY doc_id",
    ),
)
def many_rules_documents(spark, sf_dir):
    """The first of 10,000 phrases, in their order, that each document holds."""
    prose, rules = phrase_rules(spark, sf_dir)
    table = rules.table(spark).select("rule_id", F.col("category").alias("phrase"))
    found = match_indexed(prose, "clean", rules)
    return attach(found, materialise(table, "phrases"), ["rule_id"], "left").select("doc_id", "phrase")


# Parts in two halves, as two runs meet them.
PART_NAMES = "concat(p_name, ' ', p_brand, ' ', p_type)"
PART_RULES = RuleSet(
    [Rule(f"{thing}.*brand#{i % 5}", f"Parts → {thing}", i % 3) for i, thing in enumerate(THINGS)]
    + [Rule(f"{kind}$", f"Type → {kind}", -1, [], ["red"]) for kind in TYPES]
)
PART_ANCHORS = RuleSet([Rule("^old .*", "Parts → old")])


@register(
    "label_memory",
    f"""
WITH seen AS (SELECT {PART_NAMES} AS text, count(*) AS n, bool_or(p_partkey % 2 = 0) AS before FROM part GROUP BY 1),
cleans AS (SELECT *, {sql.clean("text")} AS clean FROM seen),
ranked AS (
    SELECT *, {sql.first_match(PART_ANCHORS, "clean")} AS anchor_id, {sql.first_match(PART_RULES, "clean")} AS any_rule FROM cleans)
SELECT text, n, coalesce({sql.pick(PART_ANCHORS, "anchor_id", "category")}, {sql.pick(PART_RULES, "any_rule", "category")},
    {sql.FALLBACK}) AS label, (SELECT count(*) FROM seen WHERE NOT before) AS labelled_anew FROM ranked
""",
)
def label_memory(spark, sf_dir):
    """Parts labelled by a run that remembers what a run over half of them labelled."""
    parts = read(spark, sf_dir, "part").select("p_partkey", F.expr(PART_NAMES).alias("text"))
    memory = LabelMemory(spark, scratch_path(spark, "memory"), PART_RULES, PART_ANCHORS)
    memory.label(parts.where("p_partkey % 2 = 0"), "text")
    found, anew = memory.label(parts, "text")
    return found.select("text", "n", "label", F.lit(anew).cast("long").alias("labelled_anew"))


def edited_rules() -> RuleSet:
    """The shipped rules with some of them removed, changed, moved and added."""
    rules = list(RULES.rules)
    changed = [r for i, r in enumerate(rules) if i % 23 != 5]
    changed[3] = Rule(changed[3].pattern, "Changed", changed[3].priority, changed[3].apply_if, changed[3].exclude_if)
    changed += [Rule("(кабель|труба)", "Added", 300), Rule("офис", "Added last", -5), Rule("бумага.*а4", "Added", 60)]
    return RuleSet(changed[10:] + changed[:10])


EDITED = edited_rules()


@register(
    "relabel_after_edit",
    sql.with_ctes(
        sql.CLEANS,
        f"SELECT clean, {sql.first_match(EDITED, 'clean')} AS rule_id, {sql.pick(EDITED, sql.first_match(EDITED, 'clean'), 'category')} "
        "AS category FROM ranked",
    ),
)
def relabel_after_edit(spark, sf_dir):
    """The rules of all distinct names after an edit of the rule set, from those before."""
    before = clean_names(spark, sf_dir).select("clean", RULES.first_match(F.col("clean")).alias("rule_id"))
    after = rematch(materialise(before, "before"), "clean", RULES, EDITED)
    return after.select("clean", "rule_id", EDITED.pick(F.col("rule_id"), "category").alias("category"))
