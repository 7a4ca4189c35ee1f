"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams, hashed into a fixed number of buckets.
Document frequencies come from all labelled rows given; the classifier is fitted on a
bounded sample of them. The sample is dealt into shards. Each shard is trained in one task
by follow-the-regularised-leader with L1 and L2 penalties; the shards' weights are then
averaged. A part of the sample that no shard has seen sets one temperature, by which the
scores become calibrated probabilities.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, in_parts, stored

UNDETERMINED = "und"
NGRAMS = (1, 2, 3)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
# The fitted sample holds about this many rows, the same share for each language.
FIT_ROWS = 6_000
SHARDS = 8
EPOCHS = 5
# Labels that are trained together, which bounds a task's memory; with more, each group learns its labels against the rest.
GROUP = 400
# Labels that the fitted sample has rows of, the most frequent ones. Rarer ones are not learned, and so never predicted.
MAX_LANGUAGES = 1_000
# Characters of a long text that are counted at a time.
PIECE = 1 << 20
# FTRL: learning rate and its smoothing, L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MIX = np.uint32(0x9E3779B1)
_STEP = np.uint32(0x01000193)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def letters(text: bytes | None) -> str:
    """Lower case, with each run of other characters as one space; empty if there is no letter."""
    found = _NOT_LETTERS.sub(" ", (text or b"").decode().lower()).strip()
    return f" {found} " if has_letter(found) else ""


def counts(clean: str) -> np.ndarray:
    """How often each bucket occurs among the n-grams of a text."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(clean), PIECE):
        total += np.bincount(_buckets(clean[at : at + PIECE + max(NGRAMS) - 1], PIECE), minlength=BUCKETS)
    return total


def _buckets(clean: str, starts: int) -> np.ndarray:
    """Bucket of each n-gram that starts within the first ``starts`` characters, repeats included."""
    codes = np.frombuffer(clean.encode("utf-32-le"), np.uint32)
    found, rolled = [], np.zeros(len(codes), np.uint32)
    for size in range(1, max(NGRAMS) + 1):
        rolled = rolled[: len(codes) - size + 1] * _STEP + codes[size - 1 :]
        if size in NGRAMS:
            found.append(((rolled[:starts] + np.uint32(size)) * _MIX) >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found)


def features(clean: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text: (1 + log count) x idf, scaled to length one."""
    found = counts(clean)
    at = np.flatnonzero(found)
    weights = (1.0 + np.log(found[at])) * idf[at]
    return at, weights / max(float(np.sqrt(weights @ weights)), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, most of them zero
    temperature: float

    def predict(self, text: bytes | None) -> tuple[str, float]:
        """Language and its probability; undetermined and zero without a letter or any learned language."""
        clean = letters(text)
        if not clean or not self.languages:
            return UNDETERMINED, 0.0
        chances = softmax(self.logits(clean) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])

    def logits(self, clean: str) -> np.ndarray:
        at, values = features(clean, self.idf)
        return values @ self.weights[at]


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max())
    return raised / raised.sum()


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after passing ``(class, buckets, values)`` rows in order, epochs times."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    for _ in range(epochs):
        for label, at, values in rows:
            weights = _weights(z[at], n[at])
            error = softmax(values @ weights)
            error[label] -= 1.0
            gradient = np.outer(values, error)
            grown = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * weights
            n[at] = grown
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader in closed form: zero within the L1 penalty, shrunk by L2 beyond it."""
    beyond = np.sign(z) * L1 - z
    return np.where(np.abs(z) <= L1, 0.0, beyond / ((BETA + np.sqrt(n)) / ALPHA + L2))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def document_frequencies(labelled: DataFrame) -> np.ndarray:
    """Rows that hold each bucket, over all rows; as many numbers as buckets."""

    def work(texts: list) -> Iterator[dict]:
        total = np.zeros(BUCKETS, np.int64)
        for text in texts:
            if clean := letters(text):
                total += counts(clean) > 0
        at = np.flatnonzero(total)
        yield {"bucket": at, "n": total[at]}

    rows = by_batch(labelled, ["text"], work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(BUCKETS)
    for bucket, n in rows:
        found[bucket] = n
    return found


def _sample(labelled: DataFrame, rows_of: dict[str, int], fit_rows: int) -> DataFrame:
    """About ``fit_rows`` rows, the same number of each language where it has them.

    Rows are chosen and dealt by a hash of text and id, so that copies count like other rows.
    """
    share = fit_rows / max(1, len(rows_of))
    draw = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 20))
    limits = [(language, math.ceil(min(1.0, share / n) * (1 << 20))) for language, n in rows_of.items()]
    # One row per learned label, a thousand at most.
    limited = labelled.join(F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, limit int")), "lang")
    slot = F.pmod(F.xxhash64("doc_id", "text", F.lit("slot")), F.lit(SHARDS + 2))
    return limited.where(draw < F.col("limit")).select("text", "lang", slot.cast("int").alias("slot"))


def train(documents: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled rows ``(doc_id, text, lang)``: those with a text and a language.

    What the driver receives is bounded: one number per bucket, the weights that are not zero as
    one packed row per shard and language, and the calibration rows' logits, a fifth of
    ``fit_rows`` x languages. The sample has rows of ``MAX_LANGUAGES`` labels at most; document
    frequencies are counted over all labelled rows. With more than ``GROUP`` labels, groups of
    them are trained on the whole sample, each against one class for all other labels, whose
    weights are taken off; all labels then share one softmax.
    """
    labelled = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    named = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    rows_of = {r["lang"]: r["count"] for r in named}
    languages = sorted(rows_of)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    frequencies = document_frequencies(labelled)
    all_rows = labelled.count() if len(languages) == MAX_LANGUAGES else sum(rows_of.values())
    idf = np.log((1.0 + all_rows) / (1.0 + frequencies)) + 1.0
    number = {language: i for i, language in enumerate(languages)}

    def vectors(texts: list, langs: list, slots: list) -> Iterator[dict]:
        made: dict[str, list] = {"label": [], "slot": [], "at": [], "values": []}
        for text, lang, slot in zip(texts, langs, slots):
            if clean := letters(text):
                at, values = features(clean, idf)
                for name, value in zip(made, (number[lang.decode()], slot, at, values)):
                    made[name].append(value)
        yield made

    chosen = _sample(labelled, rows_of, fit_rows)
    rows = stored(by_batch(chosen, ["text", "lang", "slot"], vectors, "label int, slot int, at array<int>, values array<double>"))

    firsts = range(0, len(languages), GROUP)

    def train_shard(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        order = sorted(zip(shard["label"], shard["at"], shard["values"]), key=lambda r: (zlib.crc32(r[2].tobytes()), r[0]))
        first = key[1]
        size = min(GROUP, len(languages) - first)
        # One more class stands for the labels of other groups.
        own = [(label - first if first <= label < first + size else size, at, values) for label, at, values in order]
        found = ftrl(own, size + (len(firsts) > 1))
        if len(firsts) > 1:
            found = found[:, :size] - found[:, size:]
        at = [np.flatnonzero(found[:, i]).astype(np.int32) for i in range(size)]
        made = {"slot": key[0], "label": range(first, first + size), "at": at, "weight": [found[x, i] for i, x in enumerate(at)]}
        return pd.DataFrame(made)

    grouped = rows.where(F.col("slot") < SHARDS).withColumn("first", F.explode(F.array(*[F.lit(i) for i in firsts])))
    packed = "slot int, label int, at array<int>, weight array<double>"
    trained = grouped.groupBy("slot", "first").applyInPandas(train_shard, packed).collect()
    weights = np.zeros((BUCKETS, len(languages)), np.float32 if len(firsts) > 1 else np.float64)
    for _, label, at, weight in sorted(trained, key=lambda r: (r["slot"], r["label"])):
        weights[at, label] += np.asarray(weight) / SHARDS
    unseen = rows.where(F.col("slot") >= SHARDS)
    return Model(languages, idf, weights.astype(np.float32), _temperature(unseen, weights))


def _temperature(unseen: DataFrame, weights: np.ndarray) -> float:
    """The temperature with the least log loss on rows the shards have not seen; 1 without any.

    The target is not quite one (Platt, 1999), so that rows without an error still give a
    finite temperature.
    """

    def score(labels: list, ats: list, values: list) -> Iterator[dict]:
        logits = [(np.asarray(v) @ weights[np.asarray(a)]).tolist() for a, v in zip(ats, values)]
        yield {"label": labels, "logits": logits}

    found = by_batch(unseen, ["label", "at", "values"], score, "label int, logits array<double>").collect()
    if not found:
        return 1.0
    labels = np.array([r["label"] for r in found])
    logits = np.array([r["logits"] for r in found])

    rows, classes = logits.shape
    targets = np.full((rows, classes), 1.0 / (rows + classes))
    targets[np.arange(rows), labels] = (rows + 1.0) / (rows + classes)

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        scaled -= scaled.max(axis=1, keepdims=True)
        logs = scaled - np.log(np.exp(scaled).sum(axis=1, keepdims=True))
        return -float((targets * logs).sum())

    grid = np.exp(np.linspace(math.log(0.02), math.log(20.0), 200))
    return float(min(grid, key=loss))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``documents(doc_id, text, ...)``.

    Only the text decides. A null or empty text and a text without a letter are ``und`` with
    score 0, and so is all if nothing was learned. ``held_out`` is false for a null id.
    Rows stay as they are, repeated ones too; other columns are ignored, whatever their names.
    """

    def work(ids: list, outs: list, texts: list) -> Iterator[dict]:
        found = [model.predict(t) for t in texts]
        yield {"doc_id": ids, "held_out": outs, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return by_batch(chosen, ["doc_id", "held_out", "text"], work, "doc_id long, held_out boolean, lang_pred string, score double")


def least_score(of_four: float, languages: int) -> float:
    """The score that lies as far above chance among so many languages as ``of_four`` does among four."""
    above = (of_four - 0.25) / 0.75
    return 1.0 / max(1, languages) * (1.0 - above) + above


def identified(documents: DataFrame, model: Model, min_score: float) -> DataFrame:
    """The rows of ``documents``, with all columns, whose language is known with at least ``min_score``."""

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in in_parts(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            found = [model.predict(t) for t in texts]
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= min_score for lang, score in found], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)


def labelled_part(documents: DataFrame) -> DataFrame:
    """The rows a model may learn from."""
    return documents.where(~held_out())
