"""URL filtering: rules by host and path first, then logistic regression on character n-grams.

A url is cut into host and path. The longest rule that fits decides; where none does, a
logistic regression on hashed character n-grams of host and path does. It is trained from a
small labelled URL table, which is a parameter; ``labelled`` gives a public-word default.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch

BLOCK, ALLOW = "block", "allow"
NGRAMS = (3, 4, 5)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
# Rows of the labelled table that are fitted at most, chosen by a hash of the url.
FIT_ROWS = 5_000
STEPS, RATE, L2 = 1000, 8.0, 1e-5
# Both labels weigh the same when fitting. Where a quarter of the urls at most is unwanted, one is
# more likely unwanted than not from this chance on.
THRESHOLD = 0.75
# Bytes whose n-grams are held at a time.
PIECE = 1 << 20

_END = re.compile(rb"[/?#]")
_QUERY = re.compile(rb"[?#]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Numbers say little about a url: all digits are one.
_DIGITS = bytes.maketrans(b"123456789", b"0" * 9)


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and the start of a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)

# Names of invented sites that say what the site is about. The first group is unwanted.
UNWANTED = """
adult-videos xxx-cams hot-sex-chat porn-tube adultdating free-porn sexy-girls-live adult-toys nude-pics escort-girls
online-casino royal-casino-bonus casino-slots pokerstars poker-cash slots-jackpot win-big-lottery sports-bets
free-bet-tips betting-odds bets-bonus roulette-win casinogames bingo-win
cheap-viagra pills-online discount-pills cheap-meds diet-pills-fast no-prescription-pharmacy cheap-cialis
cheap-watches-replica cheap-handbags herbal-pills
link-farm spam-links seo-spam spammer-mail linkfarm-seo buy-backlinks spam-blog content-farm article-spinner
ads-server adserver-click track-ads banner-ads ad-tracker click-track pixel-tracking popup-ads adtrack-pixel
tracker-beacon doubleclick-ads ads-popunder clickbait
free-iphone-winner claim-your-prize get-rich-fast payday-loans quick-cash-loan crypto-doubler warez-cracks
torrent-crack-keygen phishing-login-verify malware-download free-gift-cards
""".split()
WANTED = """
daily-news city-library weather-today history-museum science-review open-lectures garden-notes cooking-recipes
mathforum physics-notes health-research travel-journal the-reader northern-times evening-standard nature-walks
parliament-records court-opinions census-tables public-radio university-press student-essays software-manual
python-docs linux-howto encyclopedia dictionary thesaurus astronomy-club birdwatching railway-history
chess-openings film-reviews music-theory painting-gallery poetry-archive short-stories translation-notes
grammar-guide language-lessons local-government fire-station hospital-info school-board teachers-forum
parenting-advice knitting-patterns woodworking bicycle-repair hiking-trails kitchen-table another-notebook
other-thoughts on-reading transport-info engineering statistics institution weathering threshold understanding
""".split()
_FRONTS, _ENDS = ("", "www.", "blog.", "m."), (".example.com", ".example.org", ".example.net")
_PATHS = ("/en/12", "/index.html", "/de/7/", "/fr/300.html", "/", "/es/41")


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def chances(self, urls: list[tuple[bytes, bytes]]) -> np.ndarray:
        """Of each ``(host, path)`` to be unwanted."""
        total, size = np.zeros(len(urls)), np.zeros(len(urls))
        for row, bucket in ngrams(urls):
            total += np.bincount(row, self.weights[bucket], minlength=len(urls))
            size += np.bincount(row, minlength=len(urls))
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + total / np.sqrt(np.maximum(size, 1.0)), -500, 500)))


def split(url: bytes | None) -> tuple[bytes, bytes]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    _, found, rest = (url or b"").partition(b"://")
    if not found:
        return b"", b""
    end = _END.search(rest)
    host, tail = (rest[: end.start()], rest[end.start() :]) if end else (rest, b"")
    stop = _QUERY.search(tail)
    return host.translate(_LOWER), tail[: stop.start()] if stop else tail


def _pieces(urls: list[tuple[bytes, bytes]]) -> Iterator[list[tuple[int, int, bytes, int]]]:
    """``(row, side, text, starts)`` of hosts (side 1) and paths (side 2), in lists of bounded size.

    A long text comes in several pieces, each with the number of n-grams that start in it.
    """
    made: list[tuple[int, int, bytes, int]] = []
    held = 0
    for row, url in enumerate(urls):
        for side, text in enumerate(url, 1):
            if not text:
                continue
            text = bytes([side]) + text.translate(_DIGITS) + b"\x03"
            for at in range(0, len(text), PIECE):
                made.append((row, side, text[at : at + PIECE + max(NGRAMS) - 1], min(PIECE, len(text) - at)))
                held += len(made[-1][2])
                if held >= PIECE:
                    yield made
                    made, held = [], 0
    if made:
        yield made


def ngrams(urls: list[tuple[bytes, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every n-gram of hosts and paths; the ends of both are marked."""
    for made in _pieces(urls):
        rows, sides, texts, starts = zip(*made)
        sizes = np.array([len(t) for t in texts])
        heads = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(part)) - heads[part]
        codes = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
        side = np.array(sides, np.uint64)[part]
        rolled = np.zeros(len(codes), np.uint64)
        for n in range(1, max(NGRAMS) + 1):
            rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
            if n in NGRAMS:
                at = np.arange(len(rolled))
                fits = (place[at] + n <= sizes[part[at]]) & (place[at] < np.asarray(starts)[part[at]])
                at = at[fits]
                mixed = (rolled[at] * np.uint64(4) + side[at]) * np.uint64(0x9E3779B97F4A7C15)
                yield np.asarray(rows)[part[at]], (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def labelled(spark: SparkSession) -> DataFrame:
    """The default labelled table: ``url, blocked``; each name with every ending, fronts and paths in turn."""
    rows = []
    for names, unwanted in ((UNWANTED, True), (WANTED, False)):
        for i, name in enumerate(names * len(_ENDS)):
            host = _FRONTS[i % len(_FRONTS)] + name + _ENDS[i // len(names)]
            rows.append((f"https://{host}{_PATHS[i % len(_PATHS)]}", unwanted))
    return spark.createDataFrame(rows, "url string, blocked boolean")


def train(table: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the rows ``(url, blocked)`` with both known, at most ``fit_rows`` different ones.

    The driver receives each fitted row's buckets, ``BUCKETS`` at most. Without rows, or with
    one label only, nothing is learned and every url is allowed.
    """

    def work(urls: list, labels: list) -> Iterator[dict]:
        made: dict[str, list] = {"blocked": labels, "at": [], "count": []}
        for url in urls:
            total: dict[int, int] = {}
            for _, bucket in ngrams([split(url)]):
                for b, n in zip(*np.unique(bucket, return_counts=True)):
                    total[int(b)] = total.get(int(b), 0) + int(n)
            made["at"].append(sorted(total))
            made["count"].append([total[b] for b in sorted(total)])
        yield made

    rows = table.where("url is not null and blocked is not null").select("url", "blocked").distinct()
    chosen = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(fit_rows)
    found = by_batch(chosen, ["url", "blocked"], work, "blocked boolean, at array<int>, count array<int>").collect()
    found.sort(key=lambda r: (r["blocked"], r["at"], r["count"]))
    labels = np.array([r["blocked"] for r in found], float)
    if not 0 < labels.sum() < len(labels):
        return Model(np.zeros(BUCKETS), -1.0)
    row = np.repeat(np.arange(len(found)), [len(r["at"]) for r in found])
    at = np.concatenate([np.asarray(r["at"], np.int64) for r in found])
    values = np.concatenate([np.asarray(r["count"], float) / np.sqrt(max(1, sum(r["count"]))) for r in found])
    return _fitted(labels, row, at, values)


def _fitted(labels: np.ndarray, row: np.ndarray, at: np.ndarray, values: np.ndarray) -> Model:
    """Full-batch gradient steps on the log loss with an L2 penalty; both labels weigh the same."""
    used, column = np.unique(at, return_inverse=True)
    weights, bias = np.zeros(len(used)), 0.0
    balance = np.where(labels > 0, 0.5 / labels.sum(), 0.5 / (1.0 - labels).sum())
    for _ in range(STEPS):
        logits = bias + np.bincount(row, values * weights[column], minlength=len(labels))
        error = (1.0 / (1.0 + np.exp(-np.clip(logits, -500, 500))) - labels) * balance
        gradient = np.bincount(column, values * error[row], minlength=len(used))
        weights -= RATE * (gradient + L2 * weights)
        bias -= RATE * error.sum()
    whole = np.zeros(BUCKETS)
    whole[used] = weights
    return Model(whole, float(bias))


def ruled(host: bytes, path: bytes, rules: Sequence[Rule]) -> Rule | None:
    """The longest rule that fits; of equally long ones the first by name."""
    fitting = [r for r in rules if path.startswith(r.path.encode()) and (host == r.host.encode() or host.endswith(b"." + r.host.encode()))]
    return min(fitting, key=lambda r: (-len(r.name.encode()), r.name), default=None)


def judged(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row of ``pages(page_id, url, ...)``.

    ``score`` is the model's chance that the url is unwanted, whoever decides. A null url and
    one without ``://`` have an empty host and path, fit no rule that has a host, and score by
    the model's bias. Rows stay as they are, repeated ones too; an empty table gives no row.
    Urls of any length are read whole. Other columns are ignored, whatever their names. The
    rules travel with the tasks and are tried one by one: they are meant to be a short list.
    """

    def work(ids: list, urls: list) -> Iterator[dict]:
        parts = [split(u) for u in urls]
        found = [ruled(*p, rules) for p in parts]
        chances = model.chances(parts)
        yield {
            "page_id": ids,
            "host": [p[0] for p in parts],
            "path": [p[1] for p in parts],
            "rule": [r.name if r else None for r in found],
            "verdict": [r.verdict if r else BLOCK if c >= threshold else ALLOW for r, c in zip(found, chances)],
            "score": chances,
        }

    schema = "page_id long, host binary, path binary, rule string, verdict string, score double"
    rows = by_batch(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), ["page_id", "url"], work, schema)
    return rows.withColumn("host", F.col("host").cast("string")).withColumn("path", F.col("path").cast("string"))
