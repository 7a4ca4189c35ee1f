"""Source divergence audit: how each source's terms differ from those of its language.

Kept terms are found by iceberg prefix refinement. Level by level, terms are cut to a byte
prefix, and the documents that hold each prefix are counted. A prefix held by too few
documents can have no kept term behind it and is discarded; what is left is extended by the
next level. A term shorter than a level's prefix is complete there. It ends when no kept
prefix can be extended. What passed a level reaches the tasks as a bitmap of bounded size
(``sieve``), which may let a little more through; the last pass counts whole terms by their text.

Probabilities are smoothed counts in whole billionths, so every figure is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm import sieve, tokens
from shopledger.llm.common import by_batch, stored

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Bytes of the first level's prefixes; each level doubles them.
FIRST_PREFIX = 4
# Prefixes that are merged before they leave a task.
MERGE = 1 << 19
# Terms of groups that are held before they leave a task.
HELD = 1 << 19
# A bit of the keys that are sent and that the bitmap does not read.
OPEN = 1 << 16
# Cells (terms x sources) of a block of the comparison of sources.
CELLS = 1 << 17

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_INNER = "lang", "source", "term"


def _read(documents: DataFrame) -> DataFrame:
    return documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _cut(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``tokens.BLOCK`` bytes that end at a term's end."""
    at = 0
    while len(text) - at > tokens.BLOCK:
        end = at + tokens.BLOCK
        while end < len(text) and _LETTER[text[end]]:
            rest = np.frombuffer(text, np.uint8, min(tokens.BLOCK, len(text) - end), end)
            outside = np.flatnonzero(~_LETTER[rest])
            end += int(outside[0]) if len(outside) else len(rest)
        yield text[at:end]
        at = end
    yield text[at:]


def _blocks(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows and texts, packed into blocks of bounded size; a long text comes in several."""
    rows: list[int] = []
    held: list[bytes] = []
    size = 0
    for row, text in enumerate(texts):
        for part in _cut(text):
            if held and size + len(part) > tokens.BLOCK:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(part)
            size += len(part)
    if held:
        yield rows, held


def _terms_of(rows: list[int], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """The terms of a block in order: row and number of each, and the different terms by number."""
    joined = tokens.LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    letters = _LETTER[joined]
    starts, ends = tokens.edges(letters)
    heads = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    row = np.asarray(rows)[np.searchsorted(heads, starts, "right") - 1]
    numbers, words = tokens.encoded(joined, letters, starts, ends)
    return row, numbers, words


def _flat(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of an array of terms."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    return np.frombuffer(words.buffers()[2], np.uint8), offsets[:-1], offsets[1:]


def _level_of(sizes: np.ndarray) -> np.ndarray:
    """The level at which terms of these sizes are complete."""
    level = np.zeros(len(sizes), np.int64)
    while (open_ := sizes >= (FIRST_PREFIX << level)).any():
        level += open_
    return level


def _keys(values: np.ndarray, langs: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """Keys of prefixes from the values of their text; language and level take part."""
    step = np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return tokens.mixed(values + langs + step)


def _seeds(langs: list[bytes]) -> np.ndarray:
    known = {lang: xxhash.xxh64_intdigest(lang, 42) for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """The different rows of small whole numbers, sorted."""
    joint, sizes = np.zeros(len(columns[0]), np.int64), [int(c.max(initial=0)) + 1 for c in columns]
    for column, size in zip(columns, sizes):
        joint = joint * size + column
    joint = np.unique(joint)
    found = []
    for size in reversed(sizes):
        found.append(joint % size)
        joint = joint // size
    return found[::-1]


def _prefixes(documents: DataFrame, level: int, bits: np.ndarray, min_docs: int) -> DataFrame:
    """``key``: the prefixes of a level that at least ``min_docs`` documents of a language hold.

    A prefix is known by its key; keys that collide and texts that span blocks only make a
    count larger. The bit ``OPEN`` of a key is set if the prefix has the level's full size, so
    that it may be extended. ``bits`` tells which prefixes of the level before are.
    """
    size = FIRST_PREFIX << level

    def counted(langs: list, texts: list) -> Iterator[tuple]:
        names = sorted(set(langs))
        seeds, lang_of = _seeds(names), np.array([names.index(lang) for lang in langs], np.int64)
        for rows, held in _blocks(texts):
            row, number, words = _terms_of(rows, held)
            text, starts, ends = _flat(words)
            long = ends - starts >= (size // 2 if level else 1)
            fine = long[number]
            row, number = row[fine], number[fine]
            if level:
                before = tokens.text_values(text, starts, np.minimum(ends, starts + size // 2))
                pairs = _distinct(lang_of[row], number)
                passed = np.zeros((len(names), len(words)), bool)
                passed[pairs[0], pairs[1]] = sieve.may_hold(bits, _keys(before[pairs[1]], seeds[pairs[0]], level - 1))
                fine = passed[lang_of[row], number]
                row, number = row[fine], number[fine]
            values = tokens.text_values(text, starts, np.minimum(ends, starts + size))
            _, prefix = np.unique(values, return_inverse=True)
            first = np.zeros(int(prefix.max(initial=-1)) + 1, np.int64)
            first[prefix] = np.arange(len(prefix))
            row, number = _distinct(row, prefix[number])
            keys = _keys(values[first[number]], seeds[lang_of[row]], level) & np.uint64((1 << 64) - 1 - OPEN)
            yield np.unique(keys | (ends - starts >= size)[first[number]].astype(np.uint64) * np.uint64(OPEN), return_counts=True)

    return tokens.frequent_keys(documents, ["lang", "text"], counted, min_docs, MERGE)


def kept_terms(documents: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, count, total``: occurrences per source, and in all, of the terms that at
    least ``min_docs`` documents of the language hold.

    A null lang or source is read as empty, a null text too.
    """
    chosen = _read(documents)
    bits, level, more = sieve.empty(), 0, True
    while more:
        prefixes = stored(_prefixes(chosen, level, bits, min_docs))
        bits |= sieve.bitmap(prefixes)
        more = bool(prefixes.where(F.col("key").bitwiseAND(F.lit(OPEN).cast("long")) != 0).take(1))
        level += 1
    buckets = tokens.buckets_of(chosen)

    def work(langs: list, sources: list, texts: list) -> Iterator[dict]:
        names = sorted(set(zip(langs, sources)))
        place = {name: i for i, name in enumerate(names)}
        group_of = np.array([place[g] for g in zip(langs, sources)], np.int64)
        seeds = _seeds([lang for lang, _ in names])
        made: list[pa.Table] = []
        last, seen = -1, set()
        for rows, held in _blocks(texts):
            row, number, words = _terms_of(rows, held)
            text, starts, ends = _flat(words)
            values, levels = tokens.text_values(text, starts, ends), _level_of(ends - starts)
            joint, counts = np.unique(number.astype(np.int64) * len(texts) + row, return_counts=True)
            number, row = joint // len(texts), joint % len(texts)
            fine = sieve.may_hold(bits, _keys(values[number], seeds[group_of[row]], levels[number]))
            number, row, counts = number[fine], row[fine], counts[fine]
            # A document that spans blocks holds a term once.
            new = np.ones(len(row), np.int64)
            if rows[0] == last:
                for i in np.flatnonzero(row == last).tolist():
                    new[i] = words[int(number[i])].as_py() not in seen
            else:
                seen = set()
            if rows[-1] != last:
                last, seen = rows[-1], set()
            if len(texts[last]) > tokens.BLOCK:
                seen.update(words.take(pa.array(number[row == last])).to_pylist())
            heads = np.flatnonzero(np.diff(number * len(names) + group_of[row], prepend=-1))
            if len(heads):
                made.append(
                    pa.table(
                        {
                            "group": group_of[row[heads]],
                            "value": values[number[heads]],
                            "term": words.take(pa.array(number[heads])),
                            "docs": np.add.reduceat(new, heads),
                            "count": np.add.reduceat(counts, heads),
                        }
                    )
                )
            if sum(map(len, made)) > HELD:
                made = [_added(pa.concat_tables(made), ["group", "value", "term"])]
                if len(made[0]) > HELD // 2:
                    yield _sent(made[0], names, seeds, buckets)
                    made = []
        if made:
            yield _sent(_added(pa.concat_tables(made), ["group", "value", "term"]), names, seeds, buckets)

    def decided(bucket: pa.Table) -> pa.Table:
        per_source = _added(tokens.unpacked(bucket), list(_INNER))
        total = per_source.group_by(["lang", "term"], use_threads=False).aggregate([("docs", "sum"), ("count", "sum")])
        total = total.filter(pa.compute.greater_equal(total["docs_sum"], min_docs)).select(["lang", "term", "count_sum"])
        kept = per_source.join(total.rename_columns(["lang", "term", "total"]), ["lang", "term"], join_type="inner", use_threads=False)
        return kept.select([*_INNER, "count", "total"])

    sent = by_batch(chosen, ["lang", "source", "text"], work, "bucket int, rows binary")
    found = sent.groupBy("bucket").applyInArrow(decided, "lang binary, source binary, term binary, count long, total long")
    return found.select(*[F.col(c).cast("string").alias(c) for c in _INNER], "count", "total")


def _added(rows: pa.Table, keys: list[str]) -> pa.Table:
    # One thread, as a task has one core; each further one would build tables of its own.
    summed = rows.group_by(keys, use_threads=False).aggregate([("docs", "sum"), ("count", "sum")])
    return summed.rename_columns([*keys, "docs", "count"])


def _sent(rows: pa.Table, names: list[tuple[bytes, bytes]], seeds: np.ndarray, buckets: int) -> dict:
    """Rows packed per bucket of language and term, so that a bucket decides about its terms alone."""
    group = rows["group"].to_numpy()
    whole = pa.table(
        {
            "lang": pa.array([lang for lang, _ in names], pa.binary()).take(pa.array(group)),
            "source": pa.array([source for _, source in names], pa.binary()).take(pa.array(group)),
            **{c: rows[c] for c in ("term", "docs", "count")},
        }
    )
    return tokens.packed_rows(whole, tokens.mixed(rows["value"].to_numpy() + seeds[group]), buckets)


def _share(count: Column, all_counts: Column, vocabulary: Column) -> Column:
    """The smoothed share of a term in whole billionths, plus one; exact at any count."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = (all_counts + 2 * vocabulary).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(cells: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """The distances of all pairs of a language's sources, summed over the terms of one block."""
    names = sources.sort_values("source")["source"].to_numpy()
    base = sources.sort_values("source")["base"].to_numpy(np.int64)
    if cells.empty or len(names) < 2:
        return pd.DataFrame()
    row, _ = pd.factorize(cells["term"])
    column = np.searchsorted(names, cells["source"].to_numpy())
    shares = np.repeat(base[None, :], row.max() + 1, axis=0)
    shares[row, column] = cells["p"].to_numpy(np.int64)
    one, other, value = [], [], []
    for i in range(len(names) - 1):
        value.append(_distance(shares[:, i, None], shares[:, i + 1 :]).sum(axis=0))
        one.append(np.full(len(names) - i - 1, i))
        other.append(np.arange(i + 1, len(names)))
    lang = cells["lang"].iloc[0]
    return pd.DataFrame(
        {"lang": lang, "one": names[np.concatenate(one)], "other": names[np.concatenate(other)], "value": np.concatenate(value)}
    )


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how a source differs from others of its language.

    Part ``pair`` has each other source of the language, by the distance of the two over all
    kept terms. Part ``term`` has the ``top_terms`` terms that the source uses more than its
    language does. Ranks go by value, ties by item in byte order.

    A null text, lang or source is empty. A source without terms has its pairs, with zero
    distances if the language keeps no term; a language with one source has no pair. Repeated
    rows are documents of their own; an empty table gives no row. Texts of any length are
    read whole, in pieces. Other columns are ignored, whatever their names.
    """
    entries = stored(kept_terms(documents, min_docs))
    per_term = entries.select("lang", "term", "total").distinct()
    of_lang = per_term.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    occurring = _read(documents).select("lang", "source").distinct()
    sums = entries.groupBy("lang", "source").agg(F.sum("count").alias("n_source"))
    groups = stored(
        occurring.join(sums, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .na.fill(0, ["v", "n_lang", "n_source"])
        .withColumn("base", F.when(F.col("v") > 0, _share(F.lit(0).cast("long"), F.col("n_source"), F.col("v"))))
    )
    shares = (
        entries.join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("count"), F.col("n_source"), F.col("v")))
        .withColumn("q", _share(F.col("total"), F.col("n_lang"), F.col("v")))
    )
    return _pairs(groups, shares).unionByName(_terms(shares, top_terms))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Blocks of terms against all sources of their language, so that only sums per pair leave a task."""
    sizes = groups.groupBy("lang").agg((F.count("*") * F.max("v")).alias("cells")).where("cells > 0")
    blocks = sizes.select("lang", F.ceil(F.col("cells") / CELLS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    cells = shares.join(blocks, "lang").select("lang", "source", "term", "p", block)
    bases = groups.join(blocks, "lang").select("lang", "source", "base", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    summed = (
        cells.groupBy("lang", "block")
        .cogroup(bases.groupBy("lang", "block"))
        .applyInPandas(_pair_sums, "lang string, one string, other string, value long")
    )
    both = F.explode(F.array(F.struct("one", "other"), F.struct(F.col("other").alias("one"), F.col("one").alias("other"))))
    mirrored = summed.groupBy("lang", "one", "other").agg(F.sum("value").alias("value")).select("lang", both.alias("pair"), "value")
    # A pair of a language without kept terms has no block.
    bare = groups.where("v = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("item")).join(bare, "lang").where(F.col("item") != F.col("source"))
    found = mirrored.select("lang", F.col("pair.one").alias("source"), F.col("pair.other").alias("item"), "value").unionByName(
        others.select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    )
    return _ranked(found, "pair")


def _terms(shares: DataFrame, top_terms: int) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    value = F.call_function("div", (p - q) * (p - q), p + q)
    used_more = shares.where(p > q).select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    return _ranked(used_more, "term").where(F.col("rank") <= top_terms)


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
