"""How the sources of a language differ in their words: a divergence audit.

Terms are counted by sorting pointers. A task gathers texts to a shard of bounded
bytes, finds where words start in the Arrow buffer, and sorts the pointers to these
places by multikey quicksort: a range of pointers is parted in three by the eight
bytes at its current depth (below, equal to, above a pivot), the equal part goes on
eight bytes deeper, and ranges of at most LEAF pointers are sorted by whole chunks.
Words are never copied; after the sort equal words are runs, and a run gives the
occurrences by group and the number of documents.

A group is a language and source. Spark adds up the shards' runs, and a language
keeps the terms that enough of its documents hold. Every group and every language
then gives each kept term a smoothed whole-number share, and shares are compared
with a chi-square-like divergence in whole numbers throughout:

    share = 1 + floor(SCALE * (count + 1) / (total + kept terms))
    divergence = floor((p - q) ** 2 / q)

Part ``pair`` compares a group with every other source of its language, part
``term`` its terms with the whole language. Pairs are summed over terms inside
tasks: kept terms are cut into parts of a bounded number of (term, source) cells,
and a part sends one number per pair of sources, never a row per term and pair. The
pairs of sources themselves are the result, as many as it has rows.

A source or term with a third of all rows is one row a task after the first
combine; the first terms of a group come from the first of every task.

Edge cases: null text, language and source are empty ones; a group without terms is
a group; a language without kept terms has pairs of value 0 and no terms; repeated
rows are documents each; texts of any length are read whole, a text longer than a
shard is sorted in slices whose runs are added up; an empty table gives an empty
table; other columns, whatever their names, are not looked at. Of terms, only A-Z
are lower-cased. A term is in one piece of memory of a task, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.scratch import attach, materialise

# Text bytes of a shard, pointers of a range that is sorted at once, and (term,
# source) cells of a part.
SHARD_BYTES, LEAF, CELLS = 8 << 20, 1 << 15, 1 << 20
SCALE = 1_000_000_000
MIN_DOCUMENTS, TOP_TERMS = 3, 200

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of consecutive texts start and end."""
    letter = np.concatenate(([False], _LETTER[data], [False]))
    begins, ends = letter[1:] & ~letter[:-1], letter[:-1] & ~letter[1:]
    # Terms of neighbouring texts may touch.
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    touch = inner[letter[inner] & letter[inner + 1]]
    begins[touch] = ends[touch] = True
    return np.flatnonzero(begins[:-1]), np.flatnonzero(ends)


def _chunks(wide: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes of each word from ``depth`` on as a number in byte order; zeros
    follow the end of a word, and no word holds a zero byte."""
    found = wide[starts + depth].byteswap()
    over = np.clip(8 - (lengths - depth), 0, 8).astype(np.uint64) * np.uint64(8)
    # A shift by 64 is undefined, so it is done in two steps.
    half = over >> np.uint64(1)
    return (found >> half >> (over - half)) << half << (over - half)


def sort_pointers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words that pointers show, and whether a word differs from
    the one before it in that order."""
    lengths = ends - starts
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    wide = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data) + 8, 8), (1, 1))
    wide = np.ascontiguousarray(wide).view(np.uint64).ravel()
    order, new = np.arange(len(starts)), np.zeros(len(starts), bool)
    ranges = [(0, len(starts), 0)] if len(starts) else []
    while ranges:
        low, high, depth = ranges.pop()
        new[low] = True
        part = order[low:high]
        if high - low <= LEAF:
            ranked, first = _sort_leaf(wide, starts[part], lengths[part], depth)
            order[low:high] = part[ranked]
            new[low:high] |= first
            continue
        keys = _chunks(wide, starts[part], lengths[part], depth)
        pivot = np.partition(keys[:: len(keys) // 9], 4)[4]
        below, equal = keys < pivot, keys == pivot
        pieces = part[below], part[equal], part[~(below | equal)]
        order[low:high] = np.concatenate(pieces)
        at = low + np.cumsum([0, *map(len, pieces)])
        for i, deeper in enumerate((depth, depth + 8, depth)):
            if at[i] < at[i + 1]:
                ended = i == 1 and not int(pivot) & 0xFF
                if ended:  # equal to the end of the word
                    new[at[i]] = True
                else:
                    ranges.append((int(at[i]), int(at[i + 1]), deeper))
    return order, new


def _sort_leaf(wide: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of a small range, chunk after chunk: only runs of words that are
    equal so far and go on are sorted by their next chunk."""
    keys = _chunks(wide, starts, lengths, depth)
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    ranked = keys[order]
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(ranked & np.uint64(0xFF))
    while len(at):
        depth += 8
        run = np.cumsum(new)[at]
        inside = order[at]
        keys = _chunks(wide, starts[inside], np.maximum(lengths[inside], depth), depth)
        by = np.lexsort((keys, run))
        order[at] = inside[by]
        ranked = keys[by]
        differ = np.ones(len(at), bool)
        differ[1:] = (run[by][1:] != run[by][:-1]) | (ranked[1:] != ranked[:-1])
        new[at] |= differ
        at = at[(ranked & np.uint64(0xFF)) != 0]
    return order, new


class _Shard:
    """Texts waiting to be sorted, with the group of each."""

    def __init__(self) -> None:
        self.texts: list[np.ndarray] = []
        self.groups: list[tuple[str, str]] = []
        self.size = 0

    def add(self, text: np.ndarray, group: tuple[str, str]) -> None:
        self.texts.append(text)
        self.groups.append(group)
        self.size += len(text)


SHARD_ROWS = "lang string, source string, term string, n long, docs long"


def _runs(texts: list[np.ndarray], group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, and (term, group, occurrences, documents) of every pair."""
    data = _LOWER[np.concatenate(texts)]
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends = term_pointers(data, offsets)
    order, new = sort_pointers(data, starts, ends)
    term = np.cumsum(new) - 1
    doc = np.searchsorted(offsets, starts[order], "right") - 1
    # One entry per term and document, then per term and group.
    pair, uses = np.unique(term * len(texts) + doc, return_counts=True)
    term, doc = pair // len(texts), pair % len(texts)
    groups = int(group.max()) + 1
    spot, at = np.unique(term * groups + group[doc], return_inverse=True)
    at = at.ravel()
    n = np.bincount(at, weights=uses, minlength=len(spot)).astype(np.int64)
    raw, first = data.tobytes(), order[new]
    words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return words, spot // groups, spot % groups, n, np.bincount(at, minlength=len(spot))


def _shard_batch(shard: _Shard) -> pa.RecordBatch:
    names = {g: i for i, g in enumerate(dict.fromkeys(shard.groups))}
    group = np.array([names[g] for g in shard.groups])
    words, term, of, n, docs = _runs(shard.texts, group)
    return _batch(words, term, list(names), of, n, docs)


def _batch(words: list[bytes], term: np.ndarray, groups: list, of: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
    terms = pa.array(words, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(of)), sources.take(pa.array(of)), terms.take(pa.array(term)), pa.array(n), pa.array(docs.astype(np.int64))],
        names=["lang", "source", "term", "n", "docs"],
    )


def _long_text(text: np.ndarray, group: tuple[str, str]) -> pa.RecordBatch:
    """A text of more than a shard: slices that end between words, added up."""
    found: dict[bytes, int] = {}
    start = 0
    while start < len(text):
        end = min(start + SHARD_BYTES, len(text))
        while end < len(text) and _LETTER[text[end]] and _LETTER[text[end - 1]]:
            end += 1
        words, term, _, n, _ = _runs([text[start:end]], np.zeros(1, np.int64))
        for i, count in zip(term.tolist(), n.tolist()):
            found[words[i]] = found.get(words[i], 0) + count
        start = end
    some = np.arange(len(found))
    return _batch(list(found), some, [group], np.zeros(len(found), np.int64), np.array(list(found.values()), np.int64), np.ones(len(found)))


def _count_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        column = batch.column(2).cast(pa.large_string())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        buffer = column.buffers()[2]
        whole = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
            group = langs[i], sources[i]
            if b - a > SHARD_BYTES:
                yield _long_text(whole[a:b], group)
                continue
            if shard.size + b - a > SHARD_BYTES:
                yield _shard_batch(shard)
                shard = _Shard()
            shard.add(whole[a:b], group)
    if shard.size:
        yield _shard_batch(shard)


def term_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of rows (lang, source, text)."""
    texts = rows.select("lang", "source", "text").where(F.length("text") > 0)
    found = texts.mapInArrow(_count_shards, SHARD_ROWS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term, exact for any counts."""
    wide = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return (1 + F.call_function("div", wide, (total + kept).cast("decimal(19,0)"))).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


PAIR_SUMS = "lang string, no int, other int, value long"


def _pair_part(terms: pa.Table, heads: pa.Table) -> pa.Table:
    """Of one part of a language's terms and one block of its sources: the summed
    divergences of these sources from all others."""
    head = heads.slice(0, 1).to_pylist()[0]
    totals, kept = np.array(head["totals"], object), head["kept"]
    size, n = len(totals), len(terms)
    lists = terms["counts"].combine_chunks()
    entries = lists.flatten()
    column = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False)) if n else np.zeros(0, np.int64)
    counts = np.zeros((size, n), np.int64)
    if n:
        no, value = (entries.field(f).to_numpy(zero_copy_only=False) for f in ("no", "n"))
        counts[no, column] = value
    shares = np.empty((size, n), np.int64)
    for g in range(size):
        # Whole numbers of any size, for each distinct count once.
        some, at = np.unique(counts[g], return_inverse=True)
        exact = [1 + SCALE * (c + 1) // (totals[g] + kept) for c in some.tolist()]
        shares[g] = np.array(exact, np.int64)[at.ravel()] if n else 0
    own = np.arange(head["block"], size, head["blocks"])
    out = np.zeros((len(own), size), np.int64)
    for i, g in enumerate(own):
        step = shares[g] - shares
        out[i] = ((step * step) // shares).sum(axis=1)
    no, other = np.nonzero(own[:, None] != np.arange(size))
    return pa.table(
        {
            "lang": pa.array([head["lang"]] * len(no), pa.string()),
            "no": pa.array(own[no], pa.int32()),
            "other": pa.array(other, pa.int32()),
            "value": out[no, other],
        }
    )


def audit(
    df: DataFrame, text: str, lang: str, source: str, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) of every language and source."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    rows = df.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))
    counts = materialise(term_counts(rows), "counts")
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = rows.select("lang", "source").distinct()
    groups = materialise(groups.withColumn("no", F.row_number().over(numbered) - 1), "groups")

    placed = attach(counts, groups, ["lang", "source"])
    terms = placed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("no", "n")).alias("counts")
    )
    terms = materialise(terms.where(F.col("docs") >= min_documents).drop("docs"), "terms")
    entries = terms.select("lang", "term", "total", F.explode("counts").alias("c")).select(
        "lang", "term", "total", "c.no", "c.n"
    )
    group_totals = entries.groupBy("lang", "no").agg(F.sum("n").alias("group_total"))
    lang_totals = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    sized = groups.join(group_totals, ["lang", "no"], "left").join(lang_totals, "lang", "left")
    sized = materialise(sized.fillna(0, ["group_total", "kept", "lang_total"]), "sized")

    # Parts of a language's terms, each with the totals of all its sources. A unit of
    # work holds CELLS cells of terms and sources, and CELLS pairs of sources.
    sources = F.count("*")
    heads = sized.groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("no", "group_total"))), lambda x: x["group_total"]).alias("totals"),
        F.first("kept").alias("kept"),
        F.greatest(F.lit(1), F.ceil(F.first("kept") * sources / CELLS)).cast("int").alias("parts"),
        F.ceil(sources * sources / CELLS).cast("int").alias("blocks"),
    )
    heads = materialise(heads, "heads")
    cut = attach(terms.select("lang", "term", "counts"), heads.select("lang", "parts", "blocks"), ["lang"])
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    cut = cut.select("lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"), blocks, "counts")
    heads = heads.select("lang", "totals", "kept", "blocks", "parts", blocks)
    heads = heads.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    unit = ["lang", "part", "block"]
    sums = cut.groupBy(*unit).cogroup(heads.groupBy(*unit)).applyInArrow(_pair_part, PAIR_SUMS)
    sums = sums.groupBy("lang", "no", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", F.col("no").alias("other"), F.col("source").alias("item"))
    pairs = attach(attach(sums, groups, ["lang", "no"]), names, ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    joined = attach(entries, sized, ["lang", "no"])
    p = share(F.col("n"), F.col("group_total"), F.col("kept"))
    q = share(F.col("total"), F.col("lang_total"), F.col("kept"))
    compared = joined.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    found = compared.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)
    return pairs.unionByName(found)
