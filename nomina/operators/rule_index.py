"""First matches of rule sets of any size, by an index of the literals that rules need.

A pattern can only match a text that holds one of a few strings: the longest run of
plain characters that every match must have, or one such run of each alternative.
A word of ``apply_if`` must occur as well. Of each rule the best of these
requirements is indexed, every string of it.

While the strings measure small they are looked for where the text lies, all at once
(see ``strings``). A rule that is a plain string without conditions matches where it is
found, so of the others only those that rank before the first such rule go on: their
conditions and patterns are run. Then a number a text moves.

Beyond that, texts are unfolded into their distinct n-grams, of which only those of the
index go on; an equi-join gives the rules that may match a text, the whole strings are
looked for in it, and only then the rules' conditions and patterns are run. Each string
is indexed by its rarest n-gram (three characters, or all of it where it is shorter),
rarest by the number of texts that hold it. An n-gram that a third of all texts hold has
its rows dealt over salted parts.

The first rule in the order of the set wins. Rules without any plain character in common
run on every text as one CASE expression. So the work for a text grows with the rules
that share something with it, not with the set, and no text meets all rules. As
everywhere, rules meet cleaned texts, which are lower case.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nomina import scratch
from nomina.operators.rules import Rule, RuleSet, java_pattern
from nomina.operators.strings import Strings
from nomina.scratch import attach, attach_by_weight, materialise

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    from re import _constants as ops
    from re import _parser as parser

GRAM = 3
# Bytes of texts that are searched at a time, or one longer text.
LOAD_BYTES = 4 << 20
# More alternatives than this are no requirement worth an index.
MOST_STRINGS = 64


def required_strings(pattern: str) -> list[str] | None:
    """Strings of which every text that the pattern matches holds at least one; None
    if there are none to be told."""
    body = re.sub(r"^\(\?i\)", "", pattern)
    # Java runs the patterns. What it reads in another way than this parser, classes
    # within classes, or what the parser does not know, has no index.
    if "&&" in body or re.search(r"\[[^\]]*\[", body):
        return None
    try:
        parsed = parser.parse(body)
    except re.error:
        return None
    if parsed.state.flags & (re.VERBOSE | re.LOCALE):
        return None
    return _best(_requirements(parsed))


def _best(options: list[list[str]]) -> list[str] | None:
    """The requirement whose shortest string is longest; of equals the one with fewer."""
    good = [o for o in options if o and len(o) <= MOST_STRINGS and all(o)]
    return min(good, key=lambda o: (-min(map(len, o)), len(o))) if good else None


def _requirements(parsed) -> list[list[str]]:
    """Every requirement of a sequence of parts."""
    found: list[list[str]] = []
    run = ""
    for op, value in parsed:
        if op is ops.LITERAL:
            folded = chr(value).lower()
            # Texts are lower case; a letter without a single lower one ends the run.
            if len(folded) == 1 and folded.upper().lower() == folded:
                run += folded
                continue
        if run:
            found.append([run])
            run = ""
        if op is ops.SUBPATTERN:
            _, on, off, inner = value
            if not on and not off:
                found += _requirements(inner)
        elif op is ops.BRANCH:
            branches = [_best(_requirements(b)) for b in value[1]]
            if all(branches):
                found.append(sorted({s for b in branches for s in b}))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            least, _, inner = value
            if least > 0:
                found += _requirements(inner)
        elif op is ops.ATOMIC_GROUP:
            found += _requirements(value)
    if run:
        found.append([run])
    return found


def rule_strings(rule: Rule) -> list[str] | None:
    """The best requirement of a rule: of its pattern or a word it applies to."""
    own = required_strings(rule.pattern)
    words = [[w] for w in rule.apply_if if w]
    return _best(words + ([own] if own else []))


def is_plain(rule: Rule, need: list[str] | None) -> bool:
    """Whether a text that holds the rule's required string is all that it takes."""
    body = re.sub(r"^\(\?i\)", "", rule.pattern)
    signs = r"(?:[^\\.^$*+?{}\[\]()|]|\\[^\w])+"
    if rule.apply_if or rule.exclude_if or not re.fullmatch(signs, body):
        return False
    return need == [re.sub(r"\\(.)", r"\1", body, flags=re.DOTALL)]


class _Finder:
    """The ranks of the rules whose strings texts hold."""

    def __init__(self, strings: list[tuple[int, str]], plain: list[int], rules: int):
        distinct = sorted({s for _, s in strings})
        place = {s: at for at, s in enumerate(distinct)}
        self.strings = Strings(distinct)
        owner = np.array([place[s] for _, s in strings])
        order = np.argsort(owner, kind="stable")
        self.ranks = np.array([rank for rank, _ in strings])[order]
        self.counts = np.bincount(owner, minlength=len(distinct))
        self.starts = np.cumsum(self.counts) - self.counts
        self.plain, self.rules = np.zeros(rules, bool), rules
        self.plain[plain] = True

    def found(self, texts: pa.Array, all_of_them: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, rank), in order, and the first plain rule of each text, or how many
        rules there are. Unless all are asked for, those after it are left out."""
        text, string = self.strings.found(texts)
        many = self.counts[string]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        rank = self.ranks[np.repeat(self.starts[string], many) + within]
        text, first = np.repeat(text, many), np.full(len(texts), self.rules)
        sure = self.plain[rank]
        np.minimum.at(first, text[sure], rank[sure])
        if not all_of_them:
            before = rank <= first[text]
            text, rank = text[before], rank[before]
        return *np.divmod(np.unique(text * self.rules + rank), self.rules), first


def _grams(text: Column, sizes: list[int]) -> Column:
    """Distinct n-grams of a text, of several sizes."""

    def cut_size(chars: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0)))
        grams = F.transform(starts, lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))
        return F.when(F.size(chars) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))

    def cut(chars: Column) -> Column:
        return F.concat(*[cut_size(chars, n) for n in sizes])

    # As a lambda variable the characters are told apart once per text; a place in a
    # string is found by counting from its start, one in an array is not.
    return F.get(F.transform(F.array(F.split(text, "")), cut), 0)


class RuleIndex:
    """A rule set that is matched by joins."""

    def __init__(self, rules: RuleSet):
        self.rules = rules
        needs = [rule_strings(r) for r in rules.rules]
        self.plain = [rank for rank, (r, need) in enumerate(zip(rules.rules, needs)) if is_plain(r, need)]
        self.open = [rank for rank, need in enumerate(needs) if need is None]
        self.strings = [(rank, s) for rank, need in enumerate(needs) if need for s in need]

    @cached_property
    def sizes(self) -> list[int]:
        """Lengths of the n-grams in use."""
        return sorted({min(GRAM, len(s)) for _, s in self.strings})

    def _entries(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """(gram, n, entries) as a written table: the rules and strings that an n-gram
        stands for, and how many texts hold it."""
        spark = texts.sparkSession
        strings = spark.createDataFrame(self.strings, "rule_id int, string string")
        chars = F.char_length("string")
        whole = F.when(chars < GRAM, F.array("string")).otherwise(_grams(F.col("string"), [GRAM]))
        choices = materialise(strings.select("rule_id", "string", F.explode(whole).alias("gram")), "choices")
        found = texts.select(key, F.explode(_grams(F.col(text), self.sizes)).alias("gram"))
        wanted = materialise(choices.select("gram").distinct(), "grams")
        uses = materialise(attach(found, wanted, ["gram"], "left_semi").groupBy("gram").agg(F.count("*").alias("n")), "uses")
        rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("g")
        index = choices.join(uses, "gram", "left").groupBy("rule_id", "string").agg(rarest)
        # One row per n-gram with all it stands for, and the texts it will meet.
        index = index.select("g.*", F.struct("rule_id", "string").alias("entry")).where("n > 0")
        return materialise(index.groupBy("gram", "n").agg(F.collect_list("entry").alias("entries")), "index")

    def few(self) -> bool:
        """Whether the strings are few enough to be sent to every task."""
        size = sum(len(s.encode()) + 16 for _, s in self.strings)
        return len(self.strings) <= scratch.BROADCAST_ROWS and size <= scratch.BROADCAST_BYTES

    def _found(self, texts: DataFrame, key: str, text: str, all_of_them: bool) -> DataFrame:
        """(key, text, plain, rule_ids): of each text that holds a string the first plain
        rule, if any, and the rules that it may match by rank. Unless all are asked for
        those after the plain one are left out, and the text where no other is left."""
        finder = _Finder(self.strings, self.plain, len(self.rules))
        shared = texts.sparkSession.sparkContext.broadcast(finder)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
                at = 0
                while at < batch.num_rows:
                    end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LOAD_BYTES, side="right"))
                    some = batch.slice(at, max(end, at + 1) - at)
                    at += some.num_rows
                    row, rank, first = shared.value.found(some.column(1), all_of_them)
                    starts = np.flatnonzero(np.diff(row, prepend=-1))
                    rows, sizes = row[starts], np.diff(starts, append=len(row))
                    plain = first[rows]
                    needed = all_of_them | (sizes > (plain < len(shared.value.plain)))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)).astype(np.int32)), pa.array(rank.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column(0).take(pa.array(rows)),
                            some.column(1).take(pa.array(rows, mask=~needed)),
                            pa.array(plain.astype(np.int32), mask=plain == len(shared.value.plain)),
                            lists,
                        ],
                        names=names,
                    )

        fields = [texts.schema[key], texts.schema[text]]
        fields += [T.StructField("plain", T.IntegerType()), T.StructField("rule_ids", T.ArrayType(T.IntegerType()))]
        names = [f.name for f in fields]
        return texts.select(key, text).mapInArrow(run, T.StructType(fields))

    def held(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """(key, text, rule_id): rules of which a text holds a required string, once or
        more often. ``texts`` is a written table, ``key`` identifies a row."""
        if self.few():
            # The strings are looked for beside the text, so nothing moves before that.
            found = self._found(texts, key, text, all_of_them=True)
            return found.select(key, text, F.explode("rule_ids").alias("rule_id"))
        index = self._entries(texts, key, text)
        grams = F.explode(_grams(F.col(text), self.sizes)).alias("gram")
        found = attach_by_weight(texts.select(key, grams), index, "gram", "n").select(key, F.explode("entries").alias("e"))
        met = texts.join(found.groupBy(key).agg(F.collect_set("e").alias("met")), key)
        strings = F.filter("met", lambda e: F.contains(text, e["string"]))
        return met.select(key, text, F.explode(F.array_distinct(strings["rule_id"])).alias("rule_id"))

    def first_match(self, df: DataFrame, text: str) -> DataFrame:
        """Add ``rule_id``, the rank of the first rule that matches (null: none)."""
        spark = df.sparkSession
        # The input's columns are one struct while columns of our own are about.
        packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        rows = materialise(packed.withColumn("no", F.monotonically_increasing_id()), "numbered")
        rows = rows.withColumn("text", F.col("row").getField(text).cast("string"))
        hits = rows.select("no", F.lit(None).cast("int").alias("indexed")).limit(0)
        if self.strings:
            slim = rows.select("no", "text")
            if self.few():
                tried = self._found(slim, "no", "text", all_of_them=False)
                tried = tried.select("no", "text", F.explode("rule_ids").alias("rule_id"), "plain")
            else:
                tried = self.held(slim, "no", "text").withColumn("plain", F.lit(None).cast("int"))
            patterns = [(rank, java_pattern(r.pattern)) for rank, r in enumerate(self.rules.rules)]
            table = self.rules.table(spark).select("rule_id", "apply_if", "exclude_if")
            table = materialise(table.join(spark.createDataFrame(patterns, "rule_id int, regex string"), "rule_id"), "rules")
            holds = F.forall("apply_if", lambda w: F.contains("text", w)) & ~F.exists(
                "exclude_if", lambda w: F.contains("text", w)
            )
            sure = F.when(F.col("rule_id") == F.col("plain"), True)
            matches = sure.when(holds, F.regexp_like("text", F.col("regex"))).otherwise(False)
            tried = attach(tried, table, ["rule_id"]).where(matches)
            hits = materialise(tried.groupBy("no").agg(F.min("rule_id").alias("indexed")), "hits")
        found = attach(rows, hits, ["no"], "left")
        rule_id = F.col("indexed")
        if self.open:
            rest, ordered = None, self.rules.rules
            for rank in self.open:
                test = ordered[rank].matches(F.col("text"))
                rest = F.when(test, F.lit(rank)) if rest is None else rest.when(test, F.lit(rank))
            rule_id = F.least("indexed", rest)
        # A column of that name is replaced.
        kept = [F.col("row").getField(c).alias(c) for c in df.columns if c != "rule_id"]
        return found.select(*kept, rule_id.alias("rule_id"))


def match_indexed(df: DataFrame, text: str, rules: RuleSet) -> DataFrame:
    """Add ``rule_id`` of the first matching rule, for rule sets of any size."""
    return RuleIndex(rules).first_match(df, text)
