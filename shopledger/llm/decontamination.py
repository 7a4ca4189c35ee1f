"""Benchmark passages in documents, also with other numbers, names and units in them.

Texts become templates: numbers, names and units are replaced by a placeholder of their
kind. Windows of five template tokens are joined by hash. A window that meets counts
only if its slots are consistent: what stands for one value of the item must be one value of
the document, across all windows of the document or of one occurrence of the item in it; or
the values must be the item's own. A document with enough of an item's windows holds that
item. Items are also indexed with their names folded to
lower case, so that a copy in lower or upper case, which shows no names, is met as well.

Items with few windows (short ones, or with too many numbers and names) are met as a whole,
all their words in order: with their own values, or, if they have at least two literal words,
with other numbers and units in consistent slots. Names count as words there, since a short
item's first word cannot be told from one. Scripts without spaces are cut into characters.

Everything is built-in expressions. Windows of all documents are not shuffled: a bitmap of
the benchmark's window hashes, of bounded size, lets pass those that can meet, and few
others; only these go into the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import stored

WINDOW = 5
MIN_LITERALS = 3
# A document holds an item with this share of its windows, or with this many that follow one another.
MIN_COVERAGE = 0.5
LONG_RUN = 20
# Fewer windows than this are no evidence, whatever their share: items that have fewer are met as a whole.
LEAST_WINDOWS = 5
# Words of such an item that are neither numbers nor units, if its slots may hold other values.
LEAST_WORDS_AROUND_SLOTS = 2
# Windows of a pair within about so many tokens of one diagonal (or half an item) are one occurrence.
DRIFT = 16
# Texts are cut into blocks of this many characters, which overlap by so many.
BLOCK, OVERLAP = 1 << 16, 1 << 13
# Words of the bitmap, of 64 bits each, at least and at most.
LEAST_WORDS, MOST_WORDS = 1 << 8, 1 << 18

# A token is a run of letters, a number, or a sign of a unit.
TOKEN = r"\p{L}+|\p{N}+(?:[.,]\p{N}+)*|[%$€£°]"
# For items met word by word a letter of a script without spaces is a token of its own.
SPACELESS = "".join(rf"\p{{Is{script}}}" for script in "Han Hiragana Katakana Thai Lao Khmer Myanmar Tibetan".split()) + "ー"
WORD = rf"[{SPACELESS}]|[\p{{L}}&&[^{SPACELESS}]]+|\p{{N}}+(?:[.,]\p{{N}}+)*|[%$€£°]"
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "% $ € £ ° km cm mm kg mg lb lbs oz ml mph kmh mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "centimeter centimeters centimetre centimetres inch inches foot feet yard yards gram grams kilogram kilograms pound pounds "
    "ounce ounces ton tons tonne tonnes liter liters litre litres gallon gallons second seconds minute minutes hour hours day "
    "days week weeks month months year years cent cents dollar dollars euro euros degree degrees percent"
).split()


def _kind(token: Column) -> Column:
    """``#`` a number, ``~`` a unit, ``@`` a name: some letters upper case, some not; else null."""
    folded = F.lower(token)
    plain = F.when(token.isin(UNITS), F.lit("~")).when(token.isin(NUMBER_WORDS), F.lit("#"))
    return (
        F.when(token.isin(UNITS[:5]), F.lit("~"))
        .when(token.rlike(r"^\p{N}"), F.lit("#"))
        .when(folded == token, plain)
        .when(F.upper(token) != token, F.lit("@"))
    )


def _template(token: Column) -> Column:
    return F.coalesce(_kind(token), F.lower(token))


def _folded(token: Column) -> Column:
    """The template of a token in a text that shows no names."""
    kind = _kind(token)
    return F.when(kind == "@", F.lower(token)).otherwise(F.coalesce(kind, F.lower(token)))


def _blocks(texts: DataFrame, *keys: str, token: str = TOKEN, overlap: int = OVERLAP) -> DataFrame:
    """``keys, start, tokens``: the tokens of each block of ``text``; positions from ``start`` differ between blocks."""
    length = F.length("text")
    # One walk over the text: each match moves on by a block, and looks ahead over the overlap too.
    cut = F.regexp_extract_all("text", F.lit(rf"(?s)(?=(.{{1,{BLOCK + overlap}}}+)).{{1,{BLOCK}}}+"), F.lit(1))
    blocks = F.when(length <= BLOCK + overlap, F.array("text")).otherwise(cut)
    # Outer generators and no condition on an array, here and below: Spark would push such a
    # condition below the steps that make the array, and make it again there.
    return texts.where(length > 0).select(*keys, F.posexplode_outer(blocks).alias("start", "block")).select(
        *keys, (F.col("start").cast("long") * (BLOCK + overlap)).alias("start"), F.regexp_extract_all("block", F.lit(token), F.lit(0)).alias("tokens")
    )


def _hashes(marks: str) -> Column:
    """Hash of each window over an array of token hashes; null if there is none."""
    each = F.transform(
        F.sequence(F.lit(0), F.size(marks) - WINDOW), lambda i: F.xxhash64(*[F.get(marks, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(marks) >= WINDOW, each)


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_hash"), "text").distinct()


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_hash, n_windows, span, rank, place, hash, slots`` of each window with enough literal words.

    ``rank`` numbers an item's windows by place, ``span`` is where the last one ends. A template that an item repeats counts once, at its first place. Each place comes once more
    with its names folded, where it has any.
    """
    item = ["item_id", "item_hash"]
    marked = _blocks(_items(benchmark), *item).select(
        *item, "start", "tokens",
        F.transform("tokens", lambda t: F.xxhash64(_template(t))).alias("marks"),
        F.transform("tokens", lambda t: F.xxhash64(_folded(t))).alias("plain"),
    )
    places = (
        marked.select(*item, "start", "tokens", _hashes("plain").alias("folded"), _hashes("marks").alias("hashes"))
        .select(*item, "start", "tokens", "folded", F.posexplode_outer("hashes").alias("place", "hash"))
        .where(F.col("hash").isNotNull())
        .select(
            *item, (F.col("start") + F.col("place")).alias("place"), "hash", F.get("folded", F.col("place")).alias("folded"),
            F.slice("tokens", F.col("place") + 1, F.lit(WINDOW)).alias("words"),
        )
        .where(F.size(F.filter("words", lambda t: _kind(t).isNull())) >= MIN_LITERALS)
        .groupBy(*item, "hash")
        .agg(F.min(F.struct("place", "words", "folded")).alias("first"))
        .groupBy(*item)
        .agg(F.sort_array(F.collect_list(F.struct("first.place", "hash", "first.words", "first.folded"))).alias("all"))
        .select(
            *item, F.size("all").cast("long").alias("n_windows"), (F.element_at("all", -1)["place"] + WINDOW).alias("span"),
            F.posexplode_outer("all").alias("rank", "one"),
        )
        .select(*item, "n_windows", "span", "rank", "one.*")
    )
    both = F.array(
        F.struct("hash", _slots(F.col("words")).alias("slots")),
        F.struct(F.col("folded").alias("hash"), _slots(F.col("words"), names=False).alias("slots")),
    )
    kept = [*item, "n_windows", "span", "rank", "place"]
    return places.select(*kept, F.explode_outer(F.array_distinct(both)).alias("form")).select(*kept, "form.*")


def _slots(words: Column, names: bool = True) -> Column:
    """Kind and value of each placeholder, in order."""
    kinds = ["#", "~", "@"] if names else ["#", "~"]
    return F.transform(F.filter(words, lambda t: _kind(t).isin(kinds)), lambda t: F.concat(_kind(t), F.lower(t)))


def _bitmap(index: DataFrame, words: int) -> DataFrame:
    """One row: the bits of two hashes of each window, as an array of ``words`` longs."""
    bit = F.explode(F.array(*_bits(F.col("hash"), words)))
    marked = index.select(bit.alias("bit")).select(
        F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits")
    )
    every = index.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = marked.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("bitmap"))


def _bits(mark: Column, words: int) -> list[Column]:
    size = F.lit(words * 64).cast("long")
    return [F.pmod(mark, size), F.pmod(F.shiftright(mark, 32), size)]


def _passes(index: DataFrame) -> Column:
    """Whether ``hash`` can be one of the index: all of its are let pass, and few others."""
    count = index.count()
    words = LEAST_WORDS
    while words < MOST_WORDS and words * 4 < count:
        words *= 2
    bitmap = stored(_bitmap(index, words)).scalar()
    passes = F.lit(True)
    for bit in _bits(F.col("hash"), words):
        word = F.get(bitmap, F.shiftright(bit, 6).cast("int"))
        passes &= F.call_function("getbit", word, bit.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1
    return passes


def hits(documents: DataFrame, index: DataFrame) -> DataFrame:
    """Windows of documents that meet windows of the benchmark, with the slots and the places (``at``) of both."""
    passes = _passes(index)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marked = _blocks(texts, "doc_id", "text_hash").withColumn("marks", F.transform("tokens", lambda t: F.xxhash64(_template(t))))
    passed = (
        marked.select("doc_id", "text_hash", "start", "tokens", _hashes("marks").alias("hashes"))
        .select("doc_id", "text_hash", "start", "tokens", F.posexplode_outer("hashes").alias("at", "hash"))
        .where(passes)
        .select(
            "doc_id", "text_hash", "hash", (F.col("start") + F.col("at")).alias("at"),
            _slots(F.slice("tokens", F.col("at") + 1, F.lit(WINDOW))).alias("doc_slots"),
        )
        .distinct()
    )
    return passed.join(index, "hash")


def _forms(tokens: Column | str) -> dict[str, Column]:
    """Hashes of the words in lower case, and of the template in which only numbers and units are placeholders."""
    return {
        "own": F.transform(tokens, lambda t: F.xxhash64(F.lower(t))),
        "template": F.transform(tokens, lambda t: F.xxhash64(_folded(t))),
    }


def benchmark_sequences(benchmark: DataFrame, index: DataFrame) -> DataFrame:
    """``item_id, item_hash, n_chars, n_windows, size, form, slots, head, hash, whole`` of each item that is met as a whole.

    ``hash`` is that of its first ``head`` words in its form, ``whole`` that of all its ``size`` words.
    """
    item = ["item_id", "item_hash"]
    sizes = index.select(F.col("item_id").alias("i"), F.col("item_hash").alias("h"), F.col("n_windows").alias("n")).distinct()
    same = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_hash") == F.col("h"))
    slots = _slots(F.col("tokens"), names=False)
    none = F.array().cast("array<string>")
    forms = [
        F.struct(F.lit(name).alias("form"), (none if name == "own" else slots).alias("slots"), marks.alias("marks"))
        for name, marks in _forms("tokens").items()
    ]
    around = F.size("tokens") - F.size("slots")
    return (
        _items(benchmark)
        .join(sizes, same, "left")
        .where(F.coalesce("n", F.lit(0).cast("long")) < LEAST_WINDOWS)
        .select(
            *item, F.length("text").alias("n_chars"), F.coalesce("n", F.lit(0).cast("long")).alias("n_windows"),
            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("tokens"),
        )
        .select(*item, "n_chars", "n_windows", "tokens", F.explode(F.array(*forms)).alias("f"))
        .select(*item, "n_chars", "n_windows", "tokens", F.size("tokens").alias("size"), "f.*")
        .withColumn("head", F.least("size", F.lit(WINDOW)))
        .where((F.col("size") > 0) & ((F.col("form") == "own") | ((F.size("slots") > 0) & (around >= LEAST_WORDS_AROUND_SLOTS))))
        .select(
            *item, "n_chars", "n_windows", "size", "form", "slots", "head",
            F.xxhash64(F.slice("marks", F.lit(1), F.col("head"))).alias("hash"), F.xxhash64("marks").alias("whole"),
        )
    )


def _as_a_whole(documents: DataFrame, sequences: DataFrame) -> DataFrame:
    """``doc_id, text_hash, item_id, item_hash, n_windows, coverage``: documents with all words of an item in order."""
    pair = ["doc_id", "text_hash", "item_id", "item_hash"]
    result = [*pair, "n_windows", F.lit(1.0).alias("coverage")]
    sizes = sorted(tuple(r) for r in sequences.groupBy("form", "head", "size").agg(F.max("n_chars")).collect())
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    if not sizes:
        return texts.where(F.lit(False)).join(sequences).select(*result)
    passes = _passes(sequences)
    overlap = max(OVERLAP, 2 * max(n_chars for *_, n_chars in sizes))
    blocks = _blocks(texts, "doc_id", "text_hash", token=WORD, overlap=overlap)

    def heads(head: int) -> Column:
        last = F.size("marks") - head
        each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("marks", i + 1, F.lit(head))))
        # An item of one word says nothing inside of a text; it must be all of the text.
        return F.when(last == 0 if head == 1 else last >= 0, each)

    found = None
    for form, head in sorted({(form, head) for form, head, _, _ in sizes}):
        marked = blocks.select("doc_id", "text_hash", "tokens", _forms("tokens")[form].alias("marks"))
        longer = F.array(*[F.lit(size) for f, h, size, _ in sizes if (f, h) == (form, head)])
        values = _slots(F.col("tokens"), names=False) if form == "template" else F.array().cast("array<string>")
        wholes = F.transform(
            F.filter(longer, lambda n: n <= F.size("marks") - F.col("at")),
            lambda n: F.struct(F.xxhash64(F.slice("marks", F.col("at") + 1, n)).alias("whole"), n.alias("size")),
        )
        passed = (
            marked.select("doc_id", "text_hash", "tokens", "marks", F.posexplode_outer(heads(head)).alias("at", "hash"))
            .where(F.col("hash").isNotNull() & passes)
            .select("doc_id", "text_hash", "tokens", "at", F.explode_outer(wholes).alias("w"))
            .withColumn("tokens", F.slice("tokens", F.col("at") + 1, F.col("w.size")))
            .select("doc_id", "text_hash", F.lit(form).alias("form"), F.lit(head).alias("head"), F.col("w.whole").alias("whole"), values.alias("ours"))
            .distinct()
        )
        found = passed if found is None else found.unionByName(passed)
    # One value of the item is one value of the document.
    bound = F.arrays_zip(F.col("slots").alias("theirs"), F.col("ours"))
    consistent = F.size(F.array_distinct(bound)) == F.size(F.array_distinct("slots"))
    return found.join(sequences, ["form", "head", "whole"]).where(consistent).select(*result).distinct()


def _parts(met: DataFrame) -> DataFrame:
    """The hits of each part of a document: all of it (kind 0), and the occurrences of the item.

    An occurrence is what lies near one diagonal, the place in the document less that in the
    item: in cells of a grid and of one moved by half a cell, so that neither copies in a row
    share a cell nor a copy with some words more or less is cut by both grids.
    """
    diagonal = F.col("at") - F.col("place")
    half = F.floor(F.col("span") / 2)
    near, cells = F.least(half, F.lit(DRIFT)), [F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("cell"))]
    for kind, width in ((1, near), (3, half)):
        for moved in (0, 1):
            cell = F.floor((diagonal + moved * F.floor(width / 2)) / width)
            cells.append(F.struct(F.lit(kind + moved).alias("kind"), cell.alias("cell")))
    # Wide cells say nothing new about short items.
    parts = F.when(half <= DRIFT, F.array(*cells[:3])).otherwise(F.array(*cells))
    columns = [c for c in met.columns if c not in ("at", "place", "span", "hash")]
    return met.select(*columns, F.explode(parts).alias("part")).select(*columns, "part.*").distinct()


def _consistent(met: DataFrame) -> DataFrame:
    """Per pair and part: the ranks of the windows that agree with one binding, and of those with the item's own values."""
    pair = ["doc_id", "text_hash", "item_id", "item_hash", "kind", "cell"]
    met = stored(_parts(met))
    zipped = F.explode(F.zip_with("slots", "doc_slots", lambda a, b: F.struct(a.alias("theirs"), b.alias("ours"))))
    bound = (
        met.where(F.size("slots") > 0)
        .select(*pair, zipped.alias("z"))
        .groupBy(*pair, F.col("z.theirs").alias("theirs"), F.col("z.ours").alias("ours"))
        .agg(F.count("*").alias("n"))
        # What stands for a value most often, the first in order among equals.
        .groupBy(*pair, "theirs")
        .agg(F.min(F.struct(-F.col("n"), F.col("ours").alias("ours")))["ours"].alias("ours"))
        .groupBy(*pair)
        .agg(F.map_from_entries(F.collect_list(F.struct("theirs", "ours"))).alias("binding"))
    )
    same = F.lit(True)
    for c in pair:
        same &= F.col(f"m.{c}").eqNullSafe(F.col(f"b.{c}"))
    kept = met.alias("m").join(bound.alias("b"), same, "left")
    agree = F.forall(F.zip_with("slots", "doc_slots", lambda a, b: F.element_at("binding", a) == b), lambda ok: ok)
    agrees = (F.size("slots") == 0) | agree
    own = F.col("slots") == F.col("doc_slots")
    return (
        kept.where(agrees | own)
        .groupBy(*[F.col(f"m.{c}") for c in pair])
        .agg(
            F.collect_set(F.when(agrees, F.col("rank"))).alias("agreeing"),
            F.collect_set(F.when(own, F.col("rank"))).alias("own"),
            F.first("n_windows").alias("all_windows"),
        )
    )


def _run(ranks: Column) -> Column:
    """The most windows that follow one another; one changed word, which no window around it survives, does not end a run."""
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("now"), F.lit(-2 * WINDOW).alias("last"))

    def step(so_far: Column, rank: Column) -> Column:
        now = F.when(rank - so_far["last"] <= WINDOW + 1, so_far["now"] + 1).otherwise(F.lit(1))
        return F.struct(F.greatest(so_far["best"], now).alias("best"), now.alias("now"), rank.alias("last"))

    return F.aggregate(F.sort_array(ranks), start, step, lambda end: end["best"])


def contaminated(
    documents: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, long_run: int = LONG_RUN
) -> DataFrame:
    """``doc_id, text_hash, items, coverage, n_windows`` of each document that holds an item.

    ``items`` lists the ids of all items held; ``coverage`` and ``n_windows`` are the largest
    share and number of an item's windows found. An item is held with at least
    ``min_coverage`` of its windows, at least ``LEAST_WINDOWS``, or with ``long_run`` that follow
    one another in both. An item with fewer windows (of five tokens, three of them literal
    words) is held where all its words stand in order, numbers and units possibly others in
    consistent slots; one of a single word where the document is nothing else. Null and empty texts
    hold nothing and are held by nothing. Repeated rows give one row; rows with a null id are
    told apart by their text. Other columns are ignored, whatever their names.
    """
    index = stored(benchmark_windows(benchmark))
    pair = ["doc_id", "text_hash", "item_id", "item_hash"]
    found = (
        _consistent(hits(documents, index.where(F.col("n_windows") >= LEAST_WINDOWS)))
        .select(
            *pair, F.greatest(F.size("agreeing"), F.size("own")).cast("long").alias("n_windows"), "all_windows",
            F.when(F.col("kind").isin(1, 2), F.greatest(_run(F.col("agreeing")), _run(F.col("own")))).otherwise(0).alias("run"),
        )
        .withColumn("coverage", F.col("n_windows") / F.col("all_windows"))
        .where(((F.col("coverage") >= min_coverage) & (F.col("n_windows") >= LEAST_WINDOWS)) | (F.col("run") >= long_run))
        .select(*pair, "n_windows", "coverage")
        .unionByName(_as_a_whole(documents, stored(benchmark_sequences(benchmark, index))))
    )
    return found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"),
        F.max("coverage").alias("coverage"),
        F.max("n_windows").alias("n_windows"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all columns, that hold no item of the benchmark."""
    bad = stored(contaminated(documents, benchmark).select(F.col("doc_id").alias("__bad"), F.col("text_hash").alias("__hash")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__bad")) & (F.xxhash64("text") == F.col("__hash"))
    return documents.join(bad, same, "left_anti")
