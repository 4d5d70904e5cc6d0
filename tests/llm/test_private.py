"""Spans of personal data: base patterns against the plain regular expressions, further ones by hand."""

import hashlib
import random
import re
import time

import pytest

from leksika.llm import private

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def right(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(kind, m.start(), m.end()) for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if right(kind, m[0])]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def made(n, seed=1):
    rng = random.Random(seed)
    parts = ["a.b@c.de", "@", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "+1 (555) 010-2030", "+49", " ", "-", ".", "é", "𝒳", "x", "0", "7", "+", "(", ":"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_base_spans_are_those_of_the_plain_patterns():
    for text in made(20_000):
        assert list(private.base_spans(text)) == brute(text), text


def test_query_columns(spark):
    texts = [*made(300, 2), None, "", "word " * 200_000 + "x@y.zz", "Konto DE89 3704 0044 0532 0130 00, a@b.cd"]
    rows = [(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)] * 2
    df = private.digests(spark.createDataFrame(rows, "doc_id long, text string, spans string, n_ip int").repartition(3))
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    found = sorted((tuple(r) for r in df.collect()), key=repr)
    expected = []
    for i, text, *_ in rows:
        base = brute(text)
        spans = [(s.kind, s.start, s.end) for s in private.spans_of(text or "")]
        assert [s for s in spans if s in base] == base
        expected.append((i, *(sum(k == kind for k, _, _ in base) for kind in PLAIN), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
    assert found == sorted(expected, key=repr)
    assert private.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("Konto DE89 3704 0044 0532 0130 00 bei", "iban", "DE89 3704 0044 0532 0130 00"), ("GB82WEST12345698765432", "iban", "GB82WEST12345698765432"),
        ("GB82WEST12345698765433", None, ""), ("IBAN GB82 WEST 1234 5698 7654 32 OK", "iban", "GB82 WEST 1234 5698 7654 32"), ("XX82WEST12345698765432", None, ""),
        ("my SSN is 123-45-6789.", "ssn", "123-45-6789"), ("part 123-45-6789", None, ""), ("ssn 000-45-6789", None, ""), ("ssn 123-00-6789", None, ""),
        ("call (555) 123-4567 now", "phone", "(555) 123-4567"), ("(555) 123-4567", None, ""), ("version 1: call 555 123 4567", None, ""),
        ("joe [at] mail [dot] example [dot] com", "email", "joe [at] mail [dot] example [dot] com"), ("look [at] this", None, ""),
        ("host 2001:db8::ff00:42:8329 up", "ip", "2001:db8::ff00:42:8329"), ("at 12:30:45:10", None, ""), ("std::vector::x", None, ""),
        ("7536784127813050 4845168114407329", "card", "4845168114407329"), ("1234 5678", None, ""), ("0000 4111 1111 1111 1111", None, ""), ("credit card 0000 4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
    ],
)
def test_further_spans(text, kind, span):
    found = [(s.kind, text[s.start : s.end]) for s in private.spans_of(text) if not s.base]
    assert found == ([(kind, span)] if kind else [])


def test_context_weighs_and_base_stays():
    score = lambda text: private.spans_of(text)[0].score
    assert score("version 1.2.3.4") < score("1.2.3.4") < score("server 1.2.3.4")
    assert [s.kind for s in private.spans_of("version 1.2.3.4")] == ["ip"]


def test_redacted(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd or 4111111111111111!"), (2, None), (3, "clean")], "doc_id long, text string")
    assert sorted(tuple(r) for r in private.redacted(df).collect()) == [(1, "mail [email] or [card]!"), (2, None), (3, "clean")]


@pytest.mark.parametrize("text", ["a" * 1_000_000 + "@", "1" * 1_000_000, "+1" * 300_000, "a@" * 300_000, "+" + "1(" * 300_000, "DE89 " * 100_000, ":" * 500_000, "a(at)" * 100_000, "1.1." * 20_000])
def test_long_runs_take_linear_time(text):
    began = time.process_time()
    private.spans_of(text)
    assert time.process_time() - began < 10
