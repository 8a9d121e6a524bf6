import hashlib
import re
from collections import Counter

from gaugeworks.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        worth = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(worth) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    found = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if holds(k, m[0])] for k, p in PATTERNS.items()}
    return tuple(map(len, found.values())), ",".join(x for v in found.values() for x in v)


def check(docs):
    rows = pii.found(docs).collect()
    expected = Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
    hashed = Counter({(i, n, hashlib.sha256(s.encode()).hexdigest()): c for (i, n, s), c in expected.items()})
    assert Counter((r.doc_id, (r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) for r in rows) == hashed
    starts = {hashlib.sha256(s.encode()).hexdigest(): s for _, _, s in expected}
    assert all(r.spans.startswith(starts[r.base_sha256]) for r in rows)
    return {r.doc_id: r.spans for r in rows}


TRICKY = ["a@b.c_d@e.f", "x@y", "a.b@c-d.e.f. next", "é😀 a@b.cc", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004", "0.0.0.0000", "1.2.3", "4111 1111-1111 1111", "4111111111111111",
          "4111111111111112 4111111111111111", "1 2 3 4 5 6 7 8 9 0 " * 2000, "+1 (555) 010-0199", "+1-2", "+12345678901234567890", "++49 30 123456 +49 30 1234567", "9" * 9000, "a" * 9000 + "@b.c",
          "a@b.c@d.e", "%+-@a.b", "5555 5555 5555 4444 12", "1..2.3.4.5", "\n+1 234 567 890\n", "+1.2.3.4.5.6.7.8.9.10"]


def test_base_against_brute_force(documents):
    check(documents)


def test_odd_rows(odd, none):
    check(odd)
    assert pii.found(none).count() == 0


def test_tricky_matches(spark):
    check(spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string"))


def test_weak_supervision_adds_secrets_only(spark):
    key = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(40)]
    docs = [(i, f"some words here token = \"{k}\" and more") for i, k in enumerate(key)] + [(100 + i, f"averyveryverylongword{'abcdefgh'[i % 8]} follows plain words") for i in range(60)]
    found = check(spark.createDataFrame(docs, "doc_id long, text string"))
    assert all(found[i] == "secret:25:65" for i in range(40)) and not any(found[100 + i] for i in range(60))


def test_reliabilities(spark):
    """Votes of known quality on known truth; the estimates come near them."""
    import random

    rnd, rows = random.Random(1), Counter()
    quality = (0.9, 0.8, 0.85, 0.7)
    for _ in range(20_000):
        truth, code = rnd.random() < 0.3, 0
        for q in quality:
            vote = -1 if rnd.random() < 0.1 else int(truth if rnd.random() < q else not truth)
            code = code * 3 + vote + 1
        rows[code] += 1
    _, found = pii.reliabilities(spark.createDataFrame(list(rows.items()), "pattern int, n long"), rounds=40)
    assert abs(found["prior"] - 0.3) < 0.03
    for name, q in zip(pii.LABELERS, quality, strict=True):
        assert abs(found[f"{name}_yes"] - q) < 0.05 and abs(found[f"{name}_no"] - (1 - q)) < 0.05


def test_no_python_in_the_plan(spark, documents):
    plan = pii.found(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_tokens_are_candidates(spark):
    """Runs of 16 characters and more, whatever their length."""
    key = {n: (hashlib.sha256(str(n).encode()).hexdigest() * (n // 64 + 1))[:n] for n in (15, 16, 40, 128, 129, 400, 20_000)}
    docs = spark.createDataFrame([(n, f'token = "{k}" and more') for n, k in key.items()], "doc_id long, text string")
    spans = docs.select("doc_id", pii.candidates(docs.text).alias("c")).collect()
    found = {r.doc_id: [(c.start, c.end) for c in r.c if c.kind == "secret"] for r in spans}
    assert found == {n: [(9, 9 + n)] if n >= 16 else [] for n in key}
