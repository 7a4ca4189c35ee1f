"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs,
digits, ``://`` and cue words. Around each anchor a small deterministic parser finds the
boundaries of what may stand there and validates it. Parsers never start inside what
their kind has already read, so that every kind is leftmost and non-overlapping.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, in_parts

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("login", "iban", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

# Cue words, as they stand before a value.
CUES = {
    "iban": ("iban", "IBAN", "Iban"),
    "account": (
        "account", "Account", "ACCOUNT", "acct", "Acct", "ACCT", "ssn", "SSN", "passport", "Passport", "PASSPORT",
    ),
    "secret": (
        "token", "Token", "TOKEN", "secret", "Secret", "SECRET", "password", "Password", "PASSWORD", "passwd", "api_key",
        "apikey", "API_KEY", "access_key", "ACCESS_KEY",
    ),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"[^\s/?#@\"'<>]+@")
_IBAN = re.compile(r"[\s:#.=]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?: (?:number|no\.?|nr\.?|id))?[\s:#=]{1,3}([0-9][0-9-]{5,}[0-9])(?![A-Za-z0-9])", re.I)
_SECRET = re.compile(r"\s{0,2}[=:]\s{0,2}[\"']?([A-Za-z0-9_./+-]{12,}={0,2})")


def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign, kind in (("@", "email"), ("+", "phone"), ("://", "login"), *((str(d), "digit") for d in range(10))):
        found.add_word(sign, kind)
    for kind, words in CUES.items():
        for word in words:
            found.add_word(word, kind)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _small(digits: str) -> bool:
    """Whether a number without leading zeros is at most 255; it may have any number of digits."""
    return len(digits) <= 3 and int(digits or "0") <= 255


def _iban_ok(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _has_digit(value: str) -> bool:
    return any(c.isdigit() for c in value)


_VALID = {"iban": _iban_ok, "account": _has_digit, "secret": _has_digit}


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind as listed, then by start."""
    read = dict.fromkeys(KINDS, 0)
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    for at, anchor in anchors.iter(text):
        if anchor == "digit":
            if at >= read["ip"]:
                if quad := _QUAD.match(text, at):
                    read["ip"] = quad.end()
                    if all(_small(p.lstrip("0")) for p in quad.groups()):
                        spans["ip"].append(quad.span())
                else:
                    # No later start in these digits can do better.
                    read["ip"] = _DIGITS.match(text, at).end()
            if at >= read["card"]:
                chain = _DIGIT_CHAIN.match(text, at)
                read["card"] = chain.end()
                if chain.end() - at >= 16:
                    digits = chain[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(chain.span())
        elif anchor == "email":
            start = at
            while start > read["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (domain := _DOMAIN.match(text, at + 1)):
                read["email"] = domain.end()
                spans["email"].append((start, domain.end()))
        elif anchor == "phone":
            if at >= read["phone"] and (number := _PHONE.match(text, at)):
                read["phone"] = number.end()
                if 8 <= sum(c.isdigit() for c in number[0]) <= 15:
                    spans["phone"].append(number.span())
        elif anchor == "login":
            if at + 1 >= read["login"] and (user := _USERINFO.match(text, at + 1)):
                read["login"] = user.end()
                spans["login"].append((at + 1, user.end() - 1))
        else:
            rule = {"iban": _IBAN, "account": _ACCOUNT, "secret": _SECRET}[anchor]
            value = rule.match(text, at + 1)
            if value and value.start(1) >= read[anchor] and _VALID[anchor](value[1]):
                read[anchor] = value.end(1)
                spans[anchor].append(value.span(1))
    return [(kind, start, end) for kind in KINDS for start, end in spans[kind]]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(documents: DataFrame) -> DataFrame:
    """Personal data per row of ``documents(doc_id, text, ...)``.

    Columns: ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone``; ``base_sha256``, the
    lower-case SHA-256 of the base spans as ``kind:start:end`` by kind, then start,
    comma-joined, in code points; ``spans``, all spans joined likewise: also logins in
    addresses of pages, bank accounts, account numbers and secrets after their cue words.

    Null and empty texts hold nothing. Rows stay as they are, repeated ones and null ids too;
    other columns are ignored, whatever their names.
    """
    anchors = _anchors()

    def work(ids: list, texts: list) -> Iterator[dict]:
        made = {"doc_id": ids, **{f"n_{k}": [] for k in BASE_KINDS}, "base_sha256": [], "spans": []}
        for text in texts:
            spans = find((text or b"").decode("utf-8", "replace"), anchors)
            base = [s for s in spans if s[0] in BASE_KINDS]
            for kind in BASE_KINDS:
                made[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            made["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            made["spans"].append(_joined(spans))
        yield made

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return by_batch(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id", "text"], work, schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    parts, done = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, -end)
    return "".join(parts) + text[done:]


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of its texts replaced by its kind, and ``n_chars`` to match.

    All rows and columns stay in place. A text without personal data stays as it is, null too,
    and so does its ``n_chars``.
    """
    anchors = _anchors()

    def clean(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in in_parts(batches, "text"):
            texts, counts = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := find(text, anchors)):
                    texts[i] = redact(text, spans)
                    counts[i] = len(texts[i])
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns |= {n: pa.array(v, batch.column(n).type) for n, v in (("text", texts), ("n_chars", counts))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return documents.mapInArrow(clean, documents.schema)
