"""Near-duplicate documents by SimHash, found through deletion-variant signatures.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``distance`` bits are
linked. The bits are cut into few segments, so few that by the pigeonhole principle one of
them differs in at most one bit: ``distance // 2 + 1`` segments, three for a distance of
four. Each segment is indexed under one variant per bit, with that bit deleted. Two
segments that differ in at most one bit share a variant, so an equality join on the
variants meets every pair within the distance; the pair is then verified on all 64 bits.
A pair that meets under many variants is made once, under its first variant.

Classes need no pair inside a group that is known to hang together. So each fingerprint is
first linked to the smallest one with which it shares a whole segment, if within the
distance: at most one link per fingerprint and segment, which joins a crowd of near
fingerprints into one group. The join on the variants then gives links between different
groups only, one row per two groups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, components, stored

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
# A long text is read in pieces of about so many bytes, which bounds the memory of a task.
PIECE = 1 << 20

_SPACE = re.compile(rb"[ \t-\r]")


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; a piece ends at white space."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of a UTF-8 text; null or no word: zero."""
    counts, total, held = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces(text or b""):
        held += piece
        if len(held) >= words:
            counts += _bit_counts(held, words)
            total += len(held) - words + 1
            # The next shingle starts within the last words of this piece.
            held = held[len(held) - words + 1 :]
    if not total:
        if not held:
            return 0
        counts, total = _bit_counts(held, len(held)), 1
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def _bit_counts(tokens: list[bytes], words: int) -> np.ndarray:
    """For each bit the shingles of ``tokens`` whose hash has it."""
    joined = b" ".join(tokens)
    ends = list(accumulate(map(len, tokens[1:]), lambda end, size: end + size + 1, initial=len(tokens[0])))
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row ``(id, text_hash, fingerprint)``; the id keeps its value, null included.

    ``text_hash`` tells rows with one id (or none) and different texts apart.
    """

    def work(ids: list, hashes: list, texts: list) -> Iterator[dict]:
        yield {"id": ids, "text_hash": hashes, "fingerprint": [fingerprint(t) for t in texts]}

    chosen = documents.select(
        F.col(id_column).cast("long").alias("id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).alias("text"),
    )
    return by_batch(chosen, ["id", "text_hash", "text"], work, "id long, text_hash long, fingerprint long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    count = distance // 2 + 1
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def variants(marks: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``place, kept`` per bit, its segment without that bit, beside the columns of ``marks``."""
    made = [
        F.struct(
            F.lit(bit).alias("place"),
            F.col("fingerprint").bitwiseAND(_signed(_mask(first, width) & ~(1 << bit))).alias("kept"),
        )
        for first, width in _segments(distance)
        for bit in range(first, first + width)
    ]
    return marks.select(F.explode(F.array(*made)).alias("v"), *marks.columns).select("v.*", *marks.columns)


def links(marks: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints within the distance, each once.

    ``marks`` has a column ``fingerprint`` of distinct values. Copies are no pairs here.
    """
    return _met(marks.select("fingerprint"), distance).select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))


def _met(marks: DataFrame, distance: int) -> DataFrame:
    """Rows ``x`` and ``y`` of ``marks`` within the distance, each pair once."""
    index = variants(marks, distance)
    x, y = index.alias("x"), index.alias("y")
    differ = F.col("x.fingerprint").bitwiseXOR(F.col("y.fingerprint"))
    place = F.col("x.place")
    first_meeting = F.lit(True)
    for first, width in _segments(distance):
        here = differ.bitwiseAND(_signed(_mask(first, width)))
        # Earlier segments must not have met; within a segment, equal bits meet at its first place.
        first_meeting &= (place < first + width) | (F.bit_count(here) > 1)
        first_meeting &= (place <= first) | (place >= first + width) | (here != 0)
    return x.join(
        y,
        (F.col("x.place") == F.col("y.place"))
        & (F.col("x.kept") == F.col("y.kept"))
        & (F.col("x.fingerprint") < F.col("y.fingerprint"))
        & (F.bit_count(differ) <= distance)
        & first_meeting,
    )


def stars(marks: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``(a, b)``: each fingerprint and the smallest with the same segment, for each segment, if within the distance."""
    made = [
        F.struct(F.lit(first).alias("place"), F.col("fingerprint").bitwiseAND(_signed(_mask(first, width))).alias("kept"))
        for first, width in _segments(distance)
    ]
    each = marks.select(F.explode(F.array(*made)).alias("v"), "fingerprint").select("v.*", "fingerprint")
    # Stored, so that the join stands between exchanges and splits a segment that very many share.
    low = stored(each.groupBy("place", "kept").agg(F.min("fingerprint").alias("low")))
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("low"))) <= distance
    return (
        each.join(low, ["place", "kept"])
        .where(near & (F.col("fingerprint") != F.col("low")))
        .select(F.col("low").alias("a"), F.col("fingerprint").alias("b"))
        .distinct()
    )


def links_between(marks: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``(a, b)`` of different groups with fingerprints within the distance, each once.

    ``marks`` has columns ``fingerprint``, of distinct values, and ``member``, its group.
    """
    met = _met(marks.select("fingerprint", "member"), distance).where(F.col("x.member") != F.col("y.member"))
    return met.select(
        F.least("x.member", "y.member").alias("a"), F.greatest("x.member", "y.member").alias("b")
    ).distinct()


def groups(marks: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``marks`` with ``root``: equal where a chain of links joins two fingerprints."""
    starred = stored(components(stars(marks, distance)))
    member = F.coalesce("root", "fingerprint").alias("member")
    known = stored(marks.join(starred, F.col("fingerprint") == F.col("node"), "left").select(*marks.columns, member))
    joined = stored(components(links_between(known, distance)))
    return known.join(joined, F.col("member") == F.col("node"), "left").select(
        *marks.columns, F.coalesce("root", "member").alias("root")
    )


def classes(prints: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``prints`` with ``component_id``, the smallest id reachable by links, itself included.

    Equal fingerprints are linked. A class of rows without any id has a null component.
    """
    marks = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("first_id")))
    grouped = stored(groups(marks, distance))
    names = stored(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")))
    # Stored, so that the last join stands between exchanges and splits a fingerprint of very many copies.
    known = stored(grouped.join(names, "root").select(F.col("fingerprint").alias("mark"), "component_id"))
    return prints.join(known, F.col("fingerprint") == F.col("mark")).drop("mark")


def near_duplicates(documents: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Per row of ``documents(doc_id, text, ...)``: ``doc_id, fingerprint, component_id``.

    Words are what stands between ASCII white space after lower-casing A-Z; a shingle is four
    words joined by one space, repeats included, or the whole sequence if shorter. A bit is one
    if set in over half of the shingles' XXH64 hashes (seed 42). Null and empty texts and
    texts without words have fingerprint zero, which links like any other. Repeated rows stay
    repeated. Rows with a null ``doc_id`` take part; their component is null only if no row of
    the class has an id. Other columns are ignored, whatever their names.
    """
    found = classes(stored(fingerprints(documents)), distance)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(documents: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``documents`` that stay: one of each class, with all columns.

    The row with the smallest id stays (of a class without ids, the smallest text hash), once
    if it is repeated. The texts move once, and only to meet the ids that stay.
    """
    prints = stored(fingerprints(documents))
    found = classes(prints, distance)
    # Classes without ids are told apart by their fingerprints alone.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint"))]
    stay = found.groupBy(*[c.alias(f"g{i}") for i, c in enumerate(group)]).agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("text_hash"))).alias("s")
    )
    stay = stay.select(F.col("s.id").alias("__keep_id"), F.col("s.text_hash").alias("__keep_hash"))
    mine = documents.withColumn("__text_hash", F.xxhash64("text"))
    kept = mine.join(
        stay,
        mine["doc_id"].cast("long").eqNullSafe(stay["__keep_id"]) & (mine["__text_hash"] == stay["__keep_hash"]),
        "left_semi",
    )
    return kept.dropDuplicates(["doc_id", "__text_hash"]).drop("__text_hash")
