"""SentencePiece encoding and decoding by a max-plus parallel scan.

A segmentation's score is the sum of its pieces' scores, so the best one is a shortest path
in the max-plus algebra. A long document is cut into chunks of equal length, wherever the cuts
fall. What a chunk does to the score depends on two states only: how far before its first
character the last piece had ended, and how far before its last one. Each chunk gives a small
matrix of such transfers. Matrices are combined associatively, in groups, level by level,
which gives the best state at every cut; then each chunk is backtraced on its own.

No piece may hold a space after another character, so every path has an end before a word.
Inside a chunk this makes nearly all of the matrix a sum of words, and words are solved
once each, many at a time.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import in_parts, stored

# Characters in a chunk, and matrices multiplied by one task at a time.
CHUNK = 1 << 16
FAN_IN = 64
# Words up to this length are solved many at a time.
SHORT = 40
TOGETHER = 2_048
# Words kept for the next texts, and their characters; with more, all are forgotten.
MEMO_WORDS = 100_000
MEMO_CHARACTERS = 1 << 22
# Bytes of the texts whose words are solved together.
TEXTS = 1 << 19
SPACE = "▁"
LOW = -1e18


@dataclass
class Vocabulary:
    """Pieces with a space as a space, their scores, and the pieces of single bytes."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    usable: list[bool]
    ids: dict[str, int] = field(init=False)
    longest: int = field(init=False)
    unknown: float = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, self.usable)) if ok}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        if any(re.search("[^ ] ", p) for p in self.ids):
            raise ValueError("a piece holds a space after another character")
        # A character of no longer piece ends a word on both sides, as white space does.
        lone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        self.splitter = re.compile(f" +[^ {lone}]*|[{lone}]|[^ {lone}]+" if lone else " +[^ ]*|[^ ]+")
        self.lone = frozenset(lone)
        self.raw = [p.encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([value])


def load(model_file: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model.

    A model of the unigram kind has log probabilities as scores, which are taken as they are. A
    model of the merge kind has only ranks; there a piece of rank r scores -log(r + 2), the
    log probability that Zipf's law gives it but for a constant.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    count = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in count]
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in count]
    scores = [model.get_score(i) for i in count]
    ranked = sorted(-s for s, ok in zip(scores, plain) if ok)
    # Merge ranks are whole numbers counted from zero; log probabilities are not.
    if ranked and all(r == int(r) for r in ranked) and ranked[0] >= 0:
        scores = [-math.log(2.0 - min(s, 0.0)) for s in scores]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary([p.replace(SPACE, " ") for p in pieces], scores, byte_ids, plain)


class Encoder:
    """Best segmentations of texts under a vocabulary, with a bounded memory of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.memo: dict[str, bytes] = {}
        self.held = 0  # characters of the words in the memory
        self._index()

    # --- words, many at a time -------------------------------------------------------

    def _index(self) -> None:
        """Two tables from a hash of a piece to its number; the second for what collides in the first."""
        ids = np.fromiter(self.v.ids.values(), np.int64, len(self.v.ids))
        keys = np.fromiter(map(self._hash, self.v.ids), np.uint64, len(self.v.ids))
        if len(set(keys.tolist())) != len(keys):
            raise ValueError("two pieces have one hash")
        self.keys = np.zeros(len(self.v.pieces) + 1, np.uint64)
        self.keys[ids] = keys
        self.score = np.append(np.array(self.v.scores), LOW)
        # What an id adds to a score: an unknown character counts once, at its first byte.
        self.cost = self.score.copy()
        for value, i in enumerate(self.v.byte_ids):
            self.cost[i] = 0.0 if value & 0xC0 == 0x80 else self.v.unknown
        self.first = np.full(1 << _TABLE_BITS, len(self.v.pieces), np.int32)
        self.second = np.full(1 << _TABLE_BITS, len(self.v.pieces), np.int32)
        at = _slot(keys, _MIX_1)
        _, lead = np.unique(at, return_index=True)
        self.first[at[lead]] = ids[lead]
        rest = np.setdiff1d(np.arange(len(ids)), lead)
        at = _slot(keys[rest], _MIX_2)
        _, lead = np.unique(at, return_index=True)
        self.second[at[lead]] = ids[rest[lead]]
        # What collides in both is looked up by bisection.
        left = rest[np.setdiff1d(np.arange(len(rest)), lead)]
        order = np.argsort(keys[left])
        self.third = (keys[left][order], ids[left][order].astype(np.int32))

    @staticmethod
    def _hash(piece: str) -> int:
        found = 0
        for c in reversed(piece):
            found = (found * _BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return found

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, or the number of pieces where there is none."""
        found = self.first[_slot(hashes, _MIX_1)]
        wrong = self.keys[found] != hashes
        if wrong.any():
            missed = hashes[wrong]
            other = self.second[_slot(missed, _MIX_2)]
            off = self.keys[other] != missed
            other[off] = len(self.v.pieces)
            if len(self.third[0]) and off.any():
                at = np.minimum(np.searchsorted(self.third[0], missed[off]), len(self.third[0]) - 1)
                other[off] = np.where(self.third[0][at] == missed[off], self.third[1][at], len(self.v.pieces))
            found[wrong] = other
        return found

    def _solve(self, words: list[str]) -> None:
        """Segmentations of words of one length, into the memory."""
        size, count, none = len(words[0]), len(words), len(self.v.pieces)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(count, size).T.astype(np.uint64) + np.uint64(1)
        # Piece and score by its characters less one and its first place; hashes grow by one
        # character a round.
        longest = min(self.v.longest, size)
        pieces = np.full((longest, size, count), none, np.int32)
        hashes, power = np.zeros((size, count), np.uint64), np.uint64(1)
        for n in range(1, longest + 1):
            with np.errstate(over="ignore"):
                hashes = hashes[: size - n + 1] + codes[n - 1 :] * power
                power = power * np.uint64(_BASE)
            pieces[n - 1, : size - n + 1] = self._numbers(hashes)
        scores = self.score[pieces]
        scores[0][pieces[0] == none] = self.v.unknown
        best = np.zeros((size + 1, count))
        piece = np.zeros((size + 1, count), np.int32)
        back = np.zeros((size + 1, count), np.int32)
        every = np.arange(count)
        for end in range(1, size + 1):
            # Longest first: among equal sums the longer last piece wins.
            n = np.arange(min(longest, end), 0, -1)
            total = scores[n - 1, end - n] + best[end - n]
            how = total.argmax(axis=0)
            best[end] = total[how, every]
            back[end] = n[how]
            piece[end] = pieces[back[end] - 1, end - back[end], every]
        # All backtraces at once, from the right; a word's ids are the last ones of its row.
        ids, at, counts = np.zeros((count, size), np.int32), np.full(count, size), np.zeros(count, np.int32)
        for step in range(1, size + 1):
            open_ = at > 0
            if not open_.any():
                break
            ids[open_, size - step] = piece[at, every][open_]
            at -= back[at, every]
            counts += open_
        strange = ((ids == none) & (np.arange(size) >= size - counts[:, None])).any(axis=1)
        raw = ids.tobytes()
        ends = range(4 * size, 4 * size * (count + 1), 4 * size)
        self.memo.update((w, raw[e - 4 * c : e]) for w, e, c in zip(words, ends, counts.tolist()))
        for k in np.flatnonzero(strange).tolist():
            self.memo[words[k]] = self._with_bytes(words[k], ids[k, size - counts[k] :].tolist())

    def _with_bytes(self, word: str, numbers: list[int]) -> bytes:
        """Ids of a word in which unknown characters still stand as the number of pieces."""
        ids, at = [], 0
        for number in numbers:
            if number < len(self.v.pieces):
                ids.append(number)
                at += len(self.v.pieces[number])
            else:
                ids += [self.v.byte_ids[b] for b in word[at].encode()]
                at += 1
        return _pack(ids)

    def _learn(self, texts: list[list[str]]) -> None:
        """Solves the words of several texts that are not in the memory yet."""
        words = set(chain.from_iterable(texts))
        new = words.difference(self.memo)
        if new and (len(self.memo) > MEMO_WORDS or self.held > MEMO_CHARACTERS):
            self.memo.clear()
            self.held, new = 0, words
        self.held += sum(map(len, new))
        by_size: dict[int, list[str]] = {}
        for word in new:
            by_size.setdefault(len(word), []).append(word)
        for size, alike in by_size.items():
            if size <= SHORT:
                for at in range(0, len(alike), TOGETHER):
                    self._solve(alike[at : at + TOGETHER])
            else:
                for word in alike:
                    self.memo[word] = self._long_word(word)

    def _long_word(self, word: str) -> bytes:
        """A word of any length, piece by piece."""
        best, back = [0.0], [(0, -1)]
        get, scores, longest = self.v.ids.get, self.v.scores, self.v.longest
        for end in range(1, len(word) + 1):
            top, how = best[end - 1] + self.v.unknown, (end - 1, -1)
            for start in range(max(0, end - longest), end):
                number = get(word[start:end])
                if number is not None and best[start] + scores[number] > top:
                    top, how = best[start] + scores[number], (start, number)
            best.append(top)
            back.append(how)
        numbers, at = [], len(word)
        while at:
            at, number = back[at]
            numbers.append(number if number >= 0 else len(self.v.pieces))
        return self._with_bytes(word, numbers[::-1])

    # --- texts -----------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        return self.v.splitter.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that start and end at piece ends; they hold their spaces as they are."""
        words = [self.words(t) for t in texts]
        self._learn(words)
        ids = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(ids, own)), np.int32) for own in words]

    def learn(self, texts: list[str]) -> None:
        self._learn([self.words(t) for t in texts])

    def score_of(self, text: str) -> float:
        return math.fsum(self.cost[self.encode([text])[0]])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.v.raw.__getitem__, ids.tolist()))

    # --- chunks ----------------------------------------------------------------------

    def transfer(self, before: str, chunk: str) -> np.ndarray:
        """Best scores from a piece end s characters before the chunk to one t before its end.

        ``before`` is up to ``longest - 1`` characters of what precedes the chunk.
        """
        states, text, offset = self.v.longest, before + chunk, len(before)
        ends = [m.start() for m in self.v.splitter.finditer(text)]
        inner = [e for e in ends if e > offset and self._is_end(text, e)]
        out = np.full((states, states), LOW)
        if not inner:
            self._paths(text, offset, len(text), states, out)
            return out
        head = np.full((states, 1), LOW)
        self._paths(text[: inner[0]], offset, inner[0], states, head)
        tail = np.full((1, states), LOW)
        last = inner[-1]
        self._paths(text[last:], 0, len(text) - last, 1, tail)
        if len(text) - last < states:
            tail[0, len(text) - last] = 0.0  # no further end after the last one before a word
        return np.maximum(head + self.score_of(text[inner[0] : last]) + tail, LOW)

    def _is_end(self, text: str, at: int) -> bool:
        return (text[at] == " " and text[at - 1] != " ") or text[at] in self.v.lone or text[at - 1] in self.v.lone

    def _paths(self, text: str, offset: int, size: int, entries: int, out: np.ndarray) -> None:
        """Fills ``out[s, t]``: paths from ``offset - s`` to ``size - t`` whose first piece ends after ``offset``."""
        best = {offset - s: _unit(entries, s) for s in range(min(entries, offset + 1))}
        get, longest = self.v.ids.get, self.v.longest
        for end in range(offset + 1, size + 1):
            top = np.full(entries, LOW)
            for start in range(max(0, end - longest), end):
                if (number := get(text[start:end])) is not None and start in best:
                    top = np.maximum(top, best[start] + self.v.scores[number])
                elif start == end - 1 and start in best:
                    top = np.maximum(top, best[start] + self.v.unknown)
            best[end] = top
            if end - longest >= 0:
                best.pop(end - longest - 1, None)
        for t in range(out.shape[1]):
            if size - t > offset:
                out[:, t] = np.maximum(best[size - t], LOW)


_TABLE_BITS = 19
_BASE = 0x9E3779B97F4A7C15
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"={len(ids)}i", *ids)


def _slot(hashes: np.ndarray, mix: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (hashes ^ (hashes >> np.uint64(29))) * mix
    return (mixed >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _unit(size: int, at: int) -> np.ndarray:
    found = np.full(size, LOW)
    found[at] = 0.0
    return found


def product(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Max-plus product: the best way through two chunks."""
    return np.maximum((first[:, :, None] + then[None, :, :]).max(axis=1), LOW)


def path(matrices: list[np.ndarray], start: int, end: int) -> list[int]:
    """Best state at each cut, the given ones at both ends included."""
    forward = [_unit(len(matrices[0]), start)]
    for m in matrices:
        forward.append(np.maximum((forward[-1][:, None] + m).max(axis=0), LOW))
    states = [end]
    for vector, m in zip(reversed(forward[:-1]), reversed(matrices)):
        states.append(int((vector + m[:, states[-1]]).argmax()))
    return states[::-1]


# --- Spark -----------------------------------------------------------------------------

_IDS = pa.list_(pa.int32())


def encode(documents: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, part, n_tokens, token_ids, exact`` per row of ``documents(doc_id, text, ...)``.

    A text gets one space in front, as SentencePiece does, and is then cut into pieces with the
    largest sum of scores; an unknown character becomes its bytes. A text of up to ``chunk``
    characters is one part (0). A longer one has a part per chunk, whose ids follow one
    another; each is solved on its own after the scan. ``exact`` tells that the ids decode to
    the very text of the part. Null and empty texts have one part without ids. Rows stay as they
    are, repeated ones and null ids too; other columns are ignored, whatever their names.
    """
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small = chosen.where(F.col("text").isNull() | (F.length("text") <= chunk))
    whole = small.mapInArrow(_whole(vocabulary), _RESULT)
    large = chosen.where(F.length("text") > chunk)
    return whole.unionByName(_scan(large, vocabulary, chunk))


_RESULT = "doc_id long, part int, n_tokens int, token_ids array<int>, exact boolean"


def _batch(ids: list, parts: list, tokens: list[np.ndarray], exact: list) -> pa.RecordBatch:
    sizes = np.array([len(t) for t in tokens], np.int32)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *tokens])
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
    columns = [pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(sizes), lists, pa.array(exact, pa.bool_())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "n_tokens", "token_ids", "exact"])


def _whole(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part in in_parts(batches, "text", TEXTS):
            ids, texts = part.column("doc_id").to_pylist(), [" " + t if t else "" for t in part.column("text").to_pylist()]
            tokens = encoder.encode(texts)
            exact = [encoder.decode(i) == t.encode() for i, t in zip(tokens, texts)]
            yield _batch(ids, [0] * len(ids), tokens, exact)

    return run


def _scan(large: DataFrame, vocabulary: Vocabulary, chunk: int) -> DataFrame:
    """Long texts, chunk by chunk."""
    context = vocabulary.longest - 1
    spaced = F.concat(F.lit(" "), F.col("text"))
    # Cut once per text by one expression, so that the time grows with the length only. What stands
    # before a chunk comes from the chunks before it.
    cut = large.select(
        "doc_id", F.expr("uuid()").alias("row"), F.regexp_extract_all(spaced, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("cut")
    )
    reach = -(-context // chunk)
    before = f"array_join(slice(cut, greatest(i + 1 - {reach}, 1), least(i, {reach})), '')" if reach else "''"
    parts = F.expr(f"transform(cut, (c, i) -> struct(i as part, right({before}, {context}) as before, c as chunk))")
    chunks = stored(cut.select("doc_id", "row", F.explode(parts).alias("p")).select("doc_id", "row", "p.part", "p.before", "p.chunk"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for some in in_parts(batches, "chunk", TEXTS):
            texts = list(zip(*[some.column(n).to_pylist() for n in ("before", "chunk")]))
            encoder.learn([b + c for b, c in texts])
            found = [encoder.transfer(b, c).tobytes() for b, c in texts]
            yield pa.RecordBatch.from_arrays([some.column("row"), some.column("part"), pa.array(found, pa.binary())], ["row", "place", "matrix"])

    levels = [stored(chunks.select("row", "part", "before", "chunk").mapInArrow(matrices, "row string, place int, matrix binary"))]
    most = levels[0].agg(F.max("place")).first()[0] or 0
    while most:
        levels.append(stored(_combined(levels[-1], vocabulary.longest)))
        most //= FAN_IN
    states = levels[-1].select("row", "place", F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    for level in reversed(levels[:-1]):
        states = stored(_spread(level, states, vocabulary.longest))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for some in in_parts(batches, "chunk", TEXTS):
            names = ("doc_id", "part", "before", "chunk", "enter", "leave")
            ids, parts, *rest = [some.column(n).to_pylist() for n in names]
            texts = [b[len(b) - s :] + c[: len(c) - t] for b, c, s, t in zip(*rest)]
            tokens = encoder.encode(texts)
            yield _batch(ids, parts, tokens, [encoder.decode(i) == t.encode() for i, t in zip(tokens, texts)])

    placed = chunks.join(states.withColumnRenamed("place", "part"), ["row", "part"])
    return placed.select("doc_id", "part", "before", "chunk", "enter", "leave").mapInArrow(solve, _RESULT)


def _matrix(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(size, size)


def _combined(level: DataFrame, size: int) -> DataFrame:
    """One matrix for each group of neighbours."""

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for raw in group.sort_values("place")["matrix"]:
            total = _matrix(raw, size) if total is None else product(total, _matrix(raw, size))
        above = group["place"].iloc[0] // FAN_IN
        return pd.DataFrame({"row": [group["row"].iloc[0]], "place": [above], "matrix": [total.tobytes()]})

    above = F.floor(F.col("place") / FAN_IN)
    return level.groupBy("row", above).applyInPandas(multiply, "row string, place int, matrix binary")


def _spread(level: DataFrame, states: DataFrame, size: int) -> DataFrame:
    """From the states at the ends of each group those at the ends of its members."""

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        matrices = [_matrix(raw, size) for raw in group["matrix"]]
        at = path(matrices, int(group["enter"].iloc[0]), int(group["leave"].iloc[0]))
        return pd.DataFrame({"row": group["row"], "place": group["place"], "enter": at[:-1], "leave": at[1:]})

    above = states.withColumnRenamed("place", "above")
    joined = level.withColumn("above", F.floor(F.col("place") / FAN_IN).cast("int")).join(above, ["row", "above"])
    return joined.groupBy("row", "above").applyInPandas(inside, "row string, place int, enter int, leave int")


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, part, text`` from ``(doc_id, part, token_ids, ...)``: the texts again.

    Only a document's first part loses the space in front. A null list gives a null text; bytes
    that are no UTF-8 become U+FFFD. Parts stay apart, so that no text outgrows a row.
    """
    v = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, texts = batch.column("part").to_pylist(), []
            for part, ids in zip(parts, batch.column("token_ids").to_pylist()):
                raw = None if ids is None else b"".join([v.raw[i] for i in ids])
                texts.append(raw if raw is None else (raw[1:] if part == 0 and raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(texts, pa.string())], ["doc_id", "part", "text"])

    return tokens.select("doc_id", "part", "token_ids").mapInArrow(run, "doc_id long, part int, text string")
