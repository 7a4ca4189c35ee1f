"""Phrase collocation mining by Rabin-Karp fingerprints.

A text is read as bytes in blocks. Prefix polynomials over the bytes give a value to every
word, and prefix polynomials over these values a 64-bit fingerprint to every n-gram, all in
numpy and modulo 2^64. The lengths are counted one after the other: an n-gram is counted only
where the two shorter ones in it may be frequent, which a bitmap of bounded size tells
(``sieve``). Fingerprints can only be too frequent, never too rare, so no phrase is lost.

A last pass returns to the text. In each task the occurrences of a frequent fingerprint are
compared with the first one, word by word, and split where they differ; then the phrase is
written out, once per task or so, with its count and a pointer to an occurrence. The shuffle
adds up counts by the text itself, so collisions change no number, and only phrases whose
fingerprint is frequent are ever written out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm import sieve, tokens
from shopledger.llm.common import by_batch, stored

UNDETERMINED = "und"
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
# A phrase goes if a longer one has this share of its occurrences (in hundredths).
COVERED = 100
# The best phrases of a language are first found within so many parts of them.
SALT = 64

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
_WORD = re.compile(rb"[^ \t]+")
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(_BREAKS)] = 2


def parts(text: bytes, words: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``tokens.BLOCK`` bytes, each with the number of its leading words that
    belong to the part before; these are what an n-gram over the cut needs."""
    at, head, again = 0, b"", 0
    while True:
        cut = _GAP.search(text, at + tokens.BLOCK) if len(text) - at > tokens.BLOCK else None
        part = head + text[at : cut.start() if cut else len(text)]
        yield part, again
        if cut is None:
            return
        piece = part[max(part.rfind(c) for c in _BREAKS) + 1 :]
        last = _WORD.findall(piece)[-(words - 1) :] if words > 1 else []
        head, again, at = b" ".join(last) + b" ", len(last), cut.start()


def _seeds(langs: list[bytes]) -> np.ndarray:
    known = {lang: xxhash.xxh64_intdigest(lang) for lang in set(langs)}
    return np.array([known[lang] for lang in langs], np.uint64)


@dataclass
class Block:
    """The words of some texts: where they are, and which of them may be counted as the last of an n-gram."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    part: np.ndarray
    counted: np.ndarray
    order: np.ndarray  # place of a word in its text
    values: np.ndarray
    seeds: np.ndarray  # of the language of a word's text

    @classmethod
    def of(cls, texts: list[bytes], again: list[int], before: list[int], langs: list[bytes]) -> Block:
        joined = tokens.LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = _KIND[joined]
        starts, ends = tokens.edges(kind == 0)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        heads = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        part = np.searchsorted(heads, starts, "right") - 1
        within = np.arange(len(starts)) - np.searchsorted(starts, heads)[part]
        repeated = np.asarray(again)[part]
        seed = _seeds(langs)[part]
        order = within - repeated + np.asarray(before)[part]
        return cls(joined, starts, ends, piece, part, within >= repeated, order, tokens.text_values(joined, starts, ends), seed)

    def whole(self, n: int) -> np.ndarray:
        """For each word, whether the ``n`` words from it lie in one piece."""
        found = np.zeros(len(self.starts), bool)
        if n <= len(found):
            found[: len(found) - n + 1] = self.piece[: len(found) - n + 1] == self.piece[n - 1 :]
        return found

    def new(self, n: int) -> np.ndarray:
        """As ``whole``, without the n-grams that the part before has counted."""
        found = self.whole(n)
        found[: max(0, len(found) - n + 1)] &= self.counted[n - 1 :]
        return found

    def fingerprints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Of the n-grams that start at the given words; language and length take part."""
        return tokens.mixed(tokens.polynomials(self.values, at, at + n) + self.seeds[at] + np.uint64(n * 0x632BE59BD9B4E019 % (1 << 64)))

    def possible(self, n: int, bits: np.ndarray) -> np.ndarray:
        """Places of n-grams to count: those whose two shorter n-grams may be frequent."""
        if n == 1:
            return np.flatnonzero(self.new(1))
        shorter = np.flatnonzero(self.whole(n - 1))
        frequent = np.zeros(len(self.starts) + 1, bool)
        frequent[shorter] = sieve.may_hold(bits, self.fingerprints(n - 1, shorter))
        return np.flatnonzero(self.new(n) & frequent[:-1] & frequent[1:])

    def word_ids(self) -> tuple[np.ndarray, list[bytes]]:
        """A number per word, by the text itself, and the text of each number."""
        ids, words = tokens.encoded(self.text, _KIND[self.text] == 0, self.starts, self.ends)
        return ids, words.to_pylist()


@dataclass
class Found:
    """Occurrences of n-grams as rows: fingerprint, language, word numbers, count and a pointer each."""

    keys: np.ndarray
    langs: np.ndarray
    words: np.ndarray  # rows x n
    counts: np.ndarray
    docs: np.ndarray
    places: np.ndarray

    def merged(self) -> Found:
        """One row per different n-gram. Rows with equal fingerprints are compared with the first
        of them, word by word, and told apart by the words where they differ."""
        _, first, number = np.unique(self.keys, return_index=True, return_inverse=True)
        heads = first[number]
        if (self.langs != self.langs[heads]).any() or (self.words != self.words[heads]).any():
            rows = np.column_stack([self.langs, self.words])
            _, first, number = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            number = number.ravel()
        counts = np.bincount(number, self.counts, minlength=len(first)).astype(np.int64)
        return Found(self.keys[first], self.langs[first], self.words[first], counts, self.docs[first], self.places[first])

    @classmethod
    def all_of(cls, parts: list[Found]) -> Found:
        names = ("keys", "langs", "words", "counts", "docs", "places")
        return cls(*[np.concatenate([getattr(p, name) for p in parts]) for name in names])


def _blocks(langs: list, texts: list, words: int) -> Iterator[tuple[Block, list[int]]]:
    """All texts, packed into blocks; with each block the row of each of its parts."""
    rows: list[int] = []
    held: list[bytes] = []
    again: list[int] = []
    before: list[int] = []
    size = 0

    def made() -> tuple[Block, list[int]]:
        return Block.of(held, again, before, [langs[r] for r in rows]), rows

    for row, text in enumerate(texts):
        seen = 0
        for part, repeated in parts(text or b"", words):
            if held and size + len(part) > tokens.BLOCK:
                yield made()
                rows, held, again, before, size = [], [], [], [], 0
            for column, value in zip((rows, held, again, before), (row, part, repeated, seen)):
                column.append(value)
            size += len(part)
            if len(text or b"") > tokens.BLOCK:
                seen += sum(1 for p in re.split(rb"[.,;:!?\n-\r]", part) for _ in _WORD.finditer(p)) - repeated
    if held:
        yield made()


def _level(documents: DataFrame, n: int, bits: np.ndarray, min_count: int) -> DataFrame:
    """Fingerprints of length ``n`` with at least ``min_count`` occurrences in all texts."""

    def counted(langs: list, texts: list) -> Iterator[tuple]:
        for block, _ in _blocks(langs, texts, n):
            yield np.unique(block.fingerprints(n, block.possible(n, bits)), return_counts=True)

    return tokens.frequent_keys(documents, ["lang", "text"], counted, min_count)


def _written(n: int, found: Found, names: list[bytes], words: list[bytes], ids: list) -> pa.Table:
    """Phrases as text."""
    return pa.table(
        {
            "lang": pa.array(names, pa.binary()).take(pa.array(found.langs)),
            "phrase": pa.array([b" ".join([words[w] for w in row]) for row in found.words.tolist()], pa.binary()),
            "words": np.full(len(found.keys), n, np.int32),
            "n": found.counts,
            "first_doc": pa.array(ids, pa.int64()).take(pa.array(found.docs)),
            "first_word": found.places,
        }
    )


def frequent(documents: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, words, n, first_doc, first_word``: every phrase of 1 to ``max_words`` words with
    at least ``min_count`` occurrences, and per language the count of all words as a phrase of none."""
    chosen = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), "text"
    )
    bits = sieve.empty()
    longest = 0
    for n in range(1, max_words + 1):
        level = sieve.bitmap(_level(chosen, n, bits, min_count))
        if not level.any():
            break
        bits |= level
        longest = n

    buckets = tokens.buckets_of(chosen)

    def work(ids: list, langs: list, texts: list) -> Iterator[dict]:
        order = sorted(range(len(ids)), key=lambda r: (ids[r] is None, ids[r] or 0))
        ids, langs, texts = ([column[r] for r in order] for column in (ids, langs, texts))
        names = sorted(set(langs))
        lang_of = np.array([names.index(lang) for lang in langs], np.int64)
        vocabulary: dict[bytes, int] = {}
        totals = np.zeros(len(names), np.int64)
        found: dict[int, list[Found]] = {n: [] for n in range(1, longest + 1)}
        zeros = np.zeros(len(names), np.int64)
        held = 0

        def sent(n: int, rows: Found, words: list[bytes]) -> dict:
            return tokens.packed_rows(_written(n, rows, names, words, ids), rows.keys, buckets)

        for block, rows in _blocks(langs, texts, max(1, longest)):
            row = np.asarray(rows)[block.part]
            totals += np.bincount(lang_of[row[block.counted]], minlength=len(names))
            numbers, words = block.word_ids()
            numbers = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)[numbers]
            for n in found:
                at = block.possible(n, bits)
                keys = block.fingerprints(n, at)
                fine = sieve.may_hold(bits, keys)
                at, keys = at[fine], keys[fine]
                grams = np.column_stack([numbers[at + t] for t in range(n)])
                here = Found(keys, lang_of[row[at]], grams, np.ones(len(at), np.int64), row[at], block.order[at]).merged()
                found[n].append(here)
                held += len(here.keys) * (n + 5)
            if held > tokens.MERGE * 4:
                found = {n: [Found.all_of(parts).merged()] for n, parts in found.items()}
                held = sum(len(p[0].keys) * (n + 5) for n, p in found.items())
                if held > tokens.MERGE * 2:
                    for n, parts in found.items():
                        yield sent(n, parts[0], list(vocabulary))
                    found, vocabulary, held = {n: [] for n in found}, {}, 0
        yield sent(0, Found(_seeds(names), np.arange(len(names)), np.zeros((len(names), 0), int), totals, *[zeros] * 2), [])
        for n, parts in found.items():
            if parts:
                yield sent(n, Found.all_of(parts).merged(), list(vocabulary))

    def summed(bucket: pa.Table) -> pa.Table:
        rows = tokens.unpacked(bucket).sort_by([("first_doc", "ascending"), ("first_word", "ascending")])
        first = pa.compute.ScalarAggregateOptions(skip_nulls=False)
        parts = [("n", "sum"), ("first_doc", "first", first), ("first_word", "first", first)]
        added = rows.group_by(["lang", "phrase", "words"], use_threads=False).aggregate(parts)
        added = added.rename_columns(["lang", "phrase", "words", "n", "first_doc", "first_word"])
        enough = pa.compute.or_(pa.compute.equal(added["words"], 0), pa.compute.greater_equal(added["n"], min_count))
        return added.filter(enough)

    packed = by_batch(chosen, ["doc_id", "lang", "text"], work, "bucket int, rows binary")
    schema = "lang binary, phrase binary, words int, n long, first_doc long, first_word long"
    texts = [F.col(c).cast("string").alias(c) for c in ("lang", "phrase")]
    return packed.groupBy("bucket").applyInArrow(summed, schema).select(*texts, "words", "n", "first_doc", "first_word")


def _times(*columns: str):
    """An exact product of counts."""
    product = F.col(columns[0]).cast("decimal(20,0)")
    for c in columns[1:]:
        product = (product * F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)")
    return product


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of each phrase of two words or more, by its worst cut."""
    counts = phrases.where("words > 0").select("lang", F.col("phrase").alias("_part"), F.col("n").alias("_count"))
    totals = phrases.where("words = 0").select("lang", "n")
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = (
        candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("right", F.expr("substring_index(phrase, ' ', k - words)"))
    )
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("_part").alias(side), F.col("_count").alias(count)), ["lang", side])
    # A language with most of the phrases is dealt over many tasks.
    dealt = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = cuts.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)).cast("int"))
    whole = salted.join(dealt, ["lang", "_salt"]).withColumn("above", (_times("a", "n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"))
    score = whole.withColumn("below", _times("l", "r")).withColumn("score", F.expr("above div below"))
    return (
        score.groupBy("lang", "phrase", "words", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def collocations(
    documents: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, first_doc, first_word``: each language's best phrases.

    A phrase of two words or more is scored by the cut that explains it best, in whole
    numbers. It goes if a longer phrase around it has ``covered`` hundredths of its
    occurrences. Ties fall to the more frequent and then to the smaller phrase in byte order.

    A null text is empty, a null language ``und``. Repeated rows count each; an empty table,
    or one without a frequent phrase, has no row. Texts of any length are read whole, in
    blocks. Other columns are ignored, whatever their names. ``first_doc`` and ``first_word``
    point to an occurrence, the one with the smallest id.
    """
    phrases = stored(frequent(documents, max_words, min_count))
    candidates = phrases.where("words > 1")
    # A longer phrase is at most as frequent as any phrase in it, so if one of any length covers
    # a phrase, then so does one that is longer by a word.
    inner = F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))
    around = (
        candidates.where("words > 2")
        .select("lang", F.explode(inner).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )
    kept = (
        scored(phrases)
        .join(around, ["lang", "phrase"], "left")
        .where(F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True)))
        .join(candidates.select("lang", "phrase", "first_doc", "first_word"), ["lang", "phrase"])
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)))
    some = some.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc", "first_word")
