import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from shopledger.llm import pii

SCHEMA = "doc_id long, text string, lang string, n_chars long, spans string"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ANCHORS = pii._anchors()


def brute_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    found += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and brute_luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def base(text):
    return [s for s in pii.find(text, ANCHORS) if s[0] in pii.BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+1290 ()é%", max_size=60))
def test_base_spans_against_regexes(text):
    assert base(text) == brute(text)


def test_numbers_against_regexes():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(["4111 1111 1111 1111", "+1 (555) 010-9999 ", "10.0.0.1", "7", "-", " ", ".", "x", "00"]) for _ in range(8))
        assert base(text) == brute(text)


ROWS = [
    (1, "Mail a.b+c@x-y.org or é +49 (30) 1234-567, 4111 1111 1111 1111 from 10.0.0.255.1"), (2, None), (3, ""),
    (4, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" at https://me:pw@host.example/x'),
    (5, "iban GB82 WEST 1234 5698 7654 32 and Account number: 00123-45678"), (5, "clean words, nothing else. Token of thanks"),
    (5, "clean words, nothing else. Token of thanks"), (None, "x@y.z"), (6, "a@b." * 20000 + "1.2.3.4"),
]


def test_rows_and_digests(spark):
    frame = spark.createDataFrame([(d, t, "en", 1, "x") for d, t in ROWS], SCHEMA)
    got = pii.personal_data(frame).collect()
    want = []
    for d, t in ROWS:
        spans = sorted(brute(t or ""), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((str(d), *[sum(s[0] == k for s in spans) for k in pii.BASE_KINDS], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == sorted(want)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[4] == "email:65:80,login:62:67,secret:9:49"
    assert [s.split(":")[0] for s in spans[5].split(",")] in ([""], ["iban", "account"])


def test_redaction_leaves_clean_rows(spark):
    frame = spark.createDataFrame([(d, t, "en", 1, "x") for d, t in ROWS], SCHEMA)
    out = pii.redacted(frame)
    assert out.columns == frame.columns and out.count() == len(ROWS)
    for r in out.collect():
        assert not brute(r.text or "")
    texts = [r.text for r in out.collect()]
    assert texts.count("clean words, nothing else. Token of thanks") == 2 and None in texts and "" in texts
    assert "Mail [EMAIL] or é [PHONE], [CARD] from [IP].1" in texts
    assert pii.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_numbers_of_any_length(spark):
    zeros = "0" * 5000
    texts = [f"ip {'.'.join(parts)} end" for i in range(4) for parts in [[zeros * (i == k) + str(k + 1) for k in range(4)]]]
    texts += [f"ip 1.2.3.{zeros}", f"ip 1.2.3.{'9' * 5000}", f"card {zeros}", f"+{zeros}", "IBAN DE" + zeros]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {r.doc_id: r.n_ip for r in pii.personal_data(frame).collect()}
    assert [counts[i] for i in range(len(texts))] == [1, 1, 1, 1, 1, 0, 0, 0, 0]
    docs = frame.selectExpr("*", "length(text) as n_chars")
    assert {r.text for r in pii.redacted(docs).collect()} >= {"ip [IP] end"}


def test_random_digits_and_signs_never_raise():
    rng, anchors = random.Random(9), pii._anchors()
    for _ in range(20000):
        text = "".join(rng.choice(["0" * 30, "1", "25", "256", ".", "@", "+", " ", "-", "IBAN ", "key=", "://u:p@", "é", "a.b"]) for _ in range(rng.randrange(12)))
        for kind, start, end in pii.find(text, anchors):
            assert 0 <= start < end <= len(text)
