"""Building blocks of the SQL twins (DuckDB dialect).

Written apart from the library: RE2 has no look-around, ASCII-only classes and
no Java flags, so cleaning and the rule CASE are spelled out here for it.
"""

from __future__ import annotations

from nomina import fixed
from nomina.operators.rules import Rule, RuleSet, shipped_anchors, shipped_rules
from workload.names import PHRASES, PREFIXES, SUFFIXES

# Characters that count as white space.
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS = f"[{_SPACE}]"
_WORD = r"\p{L}\p{N}_"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick(values: list[str], key: str) -> str:
    listed = ", ".join(quote(v) for v in values)
    return f"list_extract([{listed}], CAST({key} % {len(values)} AS INTEGER) + 1)"


NAME = (
    f"{_pick(PREFIXES, 'l_orderkey')} || {_pick(PHRASES, 'l_partkey')} || "
    f"{_pick(SUFFIXES, 'l_suppkey')}"
)
NAMES = f"names AS MATERIALIZED (SELECT l_orderkey, l_linenumber, {NAME} AS name FROM lineitem)"


def nfc(x: str) -> str:
    return f"nfc_normalize({x})"


def dashes(x: str) -> str:
    return f"regexp_replace({x}, '[‐-–—−]+', '-', 'g')"


def slashes(x: str) -> str:
    return f"translate({x}, '⁄∕', '//')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def clean_raw(x: str) -> str:
    return strip(slashes(dashes(nfc(f"coalesce({x}, '')"))))


def strip_code(x: str) -> str:
    """The word boundaries around the optional sign, without look-around."""
    code = "[A-Z0-9]{4,}|[0-9]{3,}|[A-Z]{2,}[0-9]{2,}|[0-9]{2,}[A-Z]{2,}"
    rest = f"(?:[-/]([{_WORD}])|([^{_WORD}])|$)"
    return f"regexp_replace({x}, '^{_WS}*(?:{code}){rest}', ' \\1\\2')"


def date_tail(x: str) -> str:
    digits = r"\p{Nd}{4}|\p{Nd}{2}\.\p{Nd}{2}\.\p{Nd}{4}"
    tail = (
        f"(?i){_WS}+(?:за|от|по|на){_WS}+(?:период{_WS}+)?"
        f"(?:{fixed.DATE_MONTHS}|{digits})[^\\n]*$"
    )
    return f"regexp_replace({x}, '{tail}', '', 'g')"


def filter_chars(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Zа-яА-Я0-9.,%+/()\\-{_SPACE}]', ' ', 'g')"


def squeeze(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '{_WS}+', ' ', 'g')))"


def clean(x: str) -> str:
    return squeeze(filter_chars(date_tail(strip_code(clean_raw(x)))))


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def ngrams(tokens_sql: str, n: int) -> str:
    if n == 1:
        return tokens_sql
    return (
        f"list_transform(range(1, len({tokens_sql}) - {n} + 2), "
        f"lambda i: array_to_string(list_slice({tokens_sql}, i, i + {n - 1}), ' '))"
    )


def ngrams_2_3(tokens_sql: str) -> str:
    return f"list_concat({ngrams(tokens_sql, 2)}, {ngrams(tokens_sql, 3)})"


def words(x: str) -> str:
    """Words of two or more characters of a cleaned text."""
    return f"regexp_extract_all({x}, '[a-zа-я0-9]{{2,}}')"


def md5_order(key: str, seed: int = fixed.SEED) -> str:
    return f"md5(CAST({key} AS VARCHAR) || ':{seed}')"


# The two patterns with look-ahead, rewritten for RE2.
_REWRITTEN = {
    "сбор(?!ник).*(?!мусор|тбо|отход)": (
        "regexp_matches({t}, 'сбор([^н]|н[^и]|ни[^к]|н?$|ни$)')"
    ),
    "билет(?!.*парковк)": (
        "(contains({t}, 'билет') AND NOT "
        "contains(regexp_extract({t}, '^.*билет(.*)$', 1), 'парковк'))"
    ),
}


def rule_test(rule: Rule, t: str) -> str:
    pattern = rule.pattern.removeprefix("(?i)")
    if pattern in _REWRITTEN:
        tests = [_REWRITTEN[pattern].format(t=t)]
    else:
        tests = [f"regexp_matches({t}, {quote(pattern)})"]
    tests += [f"contains({t}, {quote(w)})" for w in rule.apply_if]
    tests += [f"NOT contains({t}, {quote(w)})" for w in rule.exclude_if]
    return " AND ".join(tests)


def first_match(rules: RuleSet, t: str) -> str:
    branches = [f"WHEN {rule_test(r, t)} THEN {rank}" for rank, r in enumerate(rules.rules)]
    return "CASE " + " ".join(branches) + " END"


def all_matches(rules: RuleSet, t: str) -> str:
    tests = [f"CASE WHEN {rule_test(r, t)} THEN {rank} END" for rank, r in enumerate(rules.rules)]
    return f"list_filter([{', '.join(tests)}], lambda r: r IS NOT NULL)"


def pick(rules: RuleSet, rank: str, attribute: str) -> str:
    values = ", ".join(quote(str(getattr(r, attribute))) for r in rules.rules)
    return f"list_extract([{values}], {rank} + 1)"


def rule_table(rules: RuleSet) -> str:
    rows = [
        f"({rank}, {quote(r.pattern)}, {quote(r.category)}, {r.priority}, "
        f"{quote('|'.join(r.apply_if))}, {quote('|'.join(r.exclude_if))})"
        for rank, r in enumerate(rules.rules)
    ]
    return (
        "rules(rule_id, pattern, category, priority, apply_if, exclude_if) AS "
        f"(VALUES {', '.join(rows)})"
    )


RULES, ANCHORS = shipped_rules(), shipped_anchors()
FALLBACK = quote(fixed.FALLBACK_LABEL)
EMPTY = quote(fixed.EMPTY_LABEL)

# texts: distinct names with row counts; labelled: one row per distinct name.
TEXTS = (
    f"{NAMES}, texts AS MATERIALIZED (SELECT name, count(*) AS n, {clean('name')} AS clean "
    "FROM names GROUP BY name)"
)
CLEANS = (
    f"{TEXTS}, cleans AS MATERIALIZED (SELECT clean, sum(n) AS n FROM texts GROUP BY clean), "
    f"ranked AS MATERIALIZED (SELECT clean, n, {first_match(ANCHORS, 'clean')} AS anchor_id, "
    f"{first_match(RULES, 'clean')} AS any_rule_id FROM cleans)"
)
CASCADE = (
    f"{CLEANS}, cascade AS MATERIALIZED (SELECT clean, anchor_id, "
    "CASE WHEN anchor_id IS NULL THEN any_rule_id END AS rule_id, any_rule_id, "
    f"coalesce({pick(ANCHORS, 'anchor_id', 'category')}, "
    f"{pick(RULES, 'any_rule_id', 'category')}) AS rule, "
    "CASE WHEN anchor_id IS NOT NULL THEN 'anchor_match' "
    "WHEN any_rule_id IS NOT NULL THEN 'rule_match' ELSE 'fallback_other' END AS reason "
    "FROM ranked), "
    "labelled AS MATERIALIZED (SELECT name, n, clean, "
    f"CASE WHEN clean = '' THEN {EMPTY} ELSE coalesce(rule, {FALLBACK}) END AS label, "
    "CASE WHEN clean <> '' THEN reason END AS reason, "
    "CASE WHEN clean <> '' THEN rule END AS rule, "
    "CASE WHEN clean <> '' THEN rule_id END AS rule_id "
    "FROM texts JOIN cascade USING (clean))"
)
# v1: the pseudo-labels.
V1 = (
    f"{CASCADE}, v1 AS MATERIALIZED (SELECT name AS text, CASE WHEN label = {EMPTY} "
    f"THEN {FALLBACK} ELSE label END AS category, 'rules' AS source, clean FROM labelled)"
)


def with_ctes(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"
