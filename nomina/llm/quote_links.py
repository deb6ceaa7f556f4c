"""Reply-ordered conversations from quotations, with DataFrame functions only.

The quote level of a line is the number of ``>`` signs in front of it. Lines of
level 0 are a message's own; consecutive lines of one higher level are a quoted
passage. Passages are normalised (lower case, single spaces) and hashed, and joined
to the messages of the same conversation whose whole own text, or a paragraph or
line of it, has that hash; of several the latest earlier one is meant. The
shallowest linked passage tells which message is answered (the latest one, if it
quotes several); a message without a link answers the one before it.

Reply order is the preorder of that tree: a message, what follows it directly,
then the branches that quote it by their turn. Every message gets a key whose
lexicographic order is the reply order of its conversation; conversations are rows
of messages, never one row, so a conversation with a third of all messages needs
no task of its own. "Latest earlier" is found in stretches of STRETCH turns whose
results are carried on, not by pairing messages.

Edge cases: a null text is an empty text; rows without conversation or turn keep
their own lines and have no place (null key, null answered turn); rows that
repeat conversation and turn share one place, quotes of either count; blank and
empty passages link with nothing; an empty table gives an empty table; extra
columns stay, an output replaces one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.llm.columns import without
from nomina.scratch import materialise

STRETCH = 4096
PREFIX = r"^((?:[ \t]*>)*)"
OUTPUTS = ["content", "n_quoted_lines", "answers_turn", "linked_passages", "depth", "reply_key"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\r?\n")


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, PREFIX, 1), "[^>]", ""))


def unquoted(line: Column) -> Column:
    return F.regexp_replace(line, PREFIX, "")


def own_text(text: Column) -> Column:
    """The lines of level 0, without white space around the whole."""
    own = F.filter(lines_of(text), lambda line: quote_level(line) == 0)
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def latest_before(rows: DataFrame, keys: list[str], at: str, flag: str, out: str, own: bool = False) -> DataFrame:
    """Add the largest ``at`` below (or, with ``own``, up to) that of each row
    among the rows of its group with ``flag``. ``at`` is unique in a group."""
    cut = materialise(rows.withColumn("_stretch", F.floor(F.col(at) / STRETCH)), "stretches")
    flagged = F.when(F.col(flag), F.col(at))
    within = Window.partitionBy(*keys, "_stretch").orderBy(at).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    last = cut.groupBy(*keys, "_stretch").agg(F.max(flagged).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carried", F.max("_last").over(earlier)).drop("_last")
    near = cut.withColumn("_near", F.max(flagged).over(within))
    joined = near.join(carried, [*keys, "_stretch"])
    return joined.select(*rows.columns, F.coalesce("_near", "_carried").alias(out))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, hash) of every quoted passage."""
    quoting = messages.where(F.exists(lines_of(F.col("text")), lambda line: quote_level(line) > 0))
    lines = quoting.select("conv", "turn", F.xxhash64("text").alias("_row"), F.posexplode(lines_of(F.col("text"))).alias("i", "line"))
    lines = lines.withColumn("level", quote_level(F.col("line")))
    # Lines of one level in a row have the same distance to their running number.
    run = F.row_number().over(Window.partitionBy("conv", "turn", "_row", "level").orderBy("i"))
    runs = lines.withColumn("_run", F.col("i") - run).where("level > 0")
    texts = runs.groupBy("conv", "turn", "_row", "level", "_run").agg(
        F.array_sort(F.collect_list(F.struct("i", unquoted(F.col("line")).alias("body")))).alias("_lines")
    )
    whole = normal(F.array_join(F.col("_lines.body"), " "))
    return texts.select("conv", "turn", "level", whole.alias("_text")).where("_text <> ''").select(
        "conv", "turn", "level", F.md5("_text").alias("hash")
    )


def originals(messages: DataFrame) -> DataFrame:
    """(conv, turn, hash) of every message's own text, paragraphs and lines."""
    own = own_text(F.col("text"))
    parts = F.concat(F.array(own), F.split(own, r"\n\s*\n"), F.split(own, "\n"))
    texts = F.array_distinct(F.transform(parts, normal))
    return messages.select("conv", "turn", F.explode(texts).alias("_text")).where("_text <> ''").select(
        "conv", "turn", F.md5("_text").alias("hash")
    )


def links(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, answers): quoted passages and the turn they are from."""
    quoted = materialise(passages(messages), "passages")
    places = quoted.select("conv", "hash", "turn", F.lit(False).alias("original"))
    asked = quoted.select("conv", "hash").distinct()
    sources = originals(messages.join(quoted.select("conv").distinct(), "conv", "left_semi"))
    sources = sources.join(asked, ["conv", "hash"], "left_semi")
    places = places.unionByName(sources.select("conv", "hash", "turn", F.lit(True).alias("original")))
    single = places.groupBy("conv", "hash", "turn").agg(F.max("original").alias("original"))
    found = latest_before(single, ["conv", "hash"], "turn", "original", "answers").where("answers IS NOT NULL")
    return quoted.join(found.select("conv", "hash", "turn", "answers"), ["conv", "hash", "turn"])


def reply_places(messages: DataFrame) -> DataFrame:
    """(conv, turn, answers_turn, linked_passages, depth, reply_key) of every
    message of a conversation in which something is linked or not."""
    turns = messages.select("conv", "turn").distinct()
    linked = materialise(links(messages), "links").groupBy("conv", "turn").agg(
        F.max(F.struct(-F.col("level"), "answers"))["answers"].alias("linked_turn"),
        F.count("*").alias("linked_passages"),
    )
    linked = materialise(linked, "linked")
    before = latest_before(turns.withColumn("_any", F.lit(True)), ["conv"], "turn", "_any", "previous").drop("_any")
    known = before.join(linked, ["conv", "turn"], "left")
    branches = F.coalesce(F.col("linked_turn") < F.col("previous"), F.lit(False))
    known = materialise(known.withColumn("branch", branches), "known")
    placed = materialise(latest_before(known, ["conv"], "turn", "branch", "start", own=True), "placed")

    # The key of a branch's start: that of the branch it leaves, and where it does.
    starts = placed.where("branch").select("conv", F.col("turn").alias("start"), F.col("linked_turn").alias("left"))
    of = placed.select("conv", F.col("turn").alias("left"), F.col("start").alias("up"))
    step = F.array(F.lit(1).cast("long"), -F.col("left"), F.col("start"))
    paths = materialise(starts.join(of, ["conv", "left"]).select("conv", "start", "up", step.alias("path")), "paths")
    while not paths.where("up IS NOT NULL").isEmpty():
        above = paths.select("conv", F.col("start").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        longer = F.concat(F.coalesce("_path", F.array().cast("array<bigint>")), "path")
        joined = paths.join(above, ["conv", "up"], "left")
        paths = materialise(joined.select("conv", "start", F.col("_up").alias("up"), longer.alias("path")), "paths")
    whole = placed.join(paths.select("conv", "start", "path"), ["conv", "start"], "left")
    path = F.coalesce("path", F.array().cast("array<bigint>"))
    return whole.select(
        "conv",
        "turn",
        F.coalesce("linked_turn", "previous").alias("answers_turn"),
        F.coalesce("linked_passages", F.lit(0)).cast("long").alias("linked_passages"),
        (F.size(path) / 3).cast("long").alias("depth"),
        F.concat(path, F.array(F.lit(0).cast("long"), F.col("turn"))).alias("reply_key"),
    )


def reply_ordered(df: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """Add content (the text without quotes), n_quoted_lines, answers_turn,
    linked_passages, depth (branches above) and reply_key to every message."""
    plain = without(df, OUTPUTS, [conv, turn, text])
    placeable = plain.where(F.col(conv).isNotNull() & F.col(turn).isNotNull())
    messages = placeable.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(text).alias("text")
    )
    # The input's columns are one struct while columns of our own are about.
    rows = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("row"),
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
    )
    joined = rows.join(reply_places(messages), ["conv", "turn"], "left")
    own = F.col("row")[text]
    return joined.select(
        "row.*",
        own_text(own).alias("content"),
        F.size(F.filter(lines_of(own), lambda line: quote_level(line) > 0)).cast("long").alias("n_quoted_lines"),
        "answers_turn",
        F.coalesce("linked_passages", F.lit(0)).cast("long").alias("linked_passages"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "reply_key",
    )


def formatted(role: Column, content: Column) -> Column:
    """One message in chat form."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), content, F.lit("\n<|end|>\n"))
