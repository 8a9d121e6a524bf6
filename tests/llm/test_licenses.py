import random
import re
import string
from collections import Counter

from gaugeworks.llm import licenses

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        own = phrase.split()
        for i in range(len(w) - len(own) + 1):
            if w[i:i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(docs):
    rows = licenses.scanned(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == Counter((r.doc_id, *base(r.text)) for r in docs.select("doc_id", "text").collect())
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    return {r.doc_id: (r.labels, r.score) for r in rows}


def test_base_against_brute_force(documents):
    check(documents)


def test_odd_rows(odd, none):
    check(odd)
    assert licenses.scanned(none).count() == 0


def test_diagonals(spark):
    filler = " ".join(f"w{i}" for i in range(300))
    docs = [(1, "CC by cc BY-cc/by"), (2, "all rights reserved " * 3), (3, f"{filler} Released under the MIT License. {filler}"),
            (4, f"{filler} redistribution and use in both source and binary forms with or without small modification are permitted {filler}"),
            (5, f"{filler} permission to use the source and the license in binary is granted of charge {filler}"), (6, "general public x license general public license"),
            (7, "apache " + filler + " license " + filler + " version 2 0"), (2, "all rights reserved " * 3), (8, "CCÉ by")]
    found = check(spark.createDataFrame(docs, "doc_id long, text string"))
    assert found[3] == ("mit", 1.0) and found[4][0] == "bsd" and 0.6 <= found[4][1] < 1
    assert found[5] == found[7] == found[8] == ("", 0.0) and found[1][0] == "cc-by"


def labels(text):
    """All labels and the score, from the words' positions."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    named, score = set(filter(None, base(text)[4].split(","))), 0.0
    score = 1.0 if named else 0.0
    for template, label in licenses.TEMPLATES:
        own = template.split()
        n, at = len(own), {}
        for i, pair in enumerate(zip(w, w[1:])):
            for j, other in enumerate(zip(own, own[1:])):
                if pair == other:
                    at.setdefault(i - j, set()).add(j)
        for window in {d // n + x for d in at for x in (0, -1)}:
            inside = sorted(d for d in at if window * n <= d < (window + 2) * n)
            band = []
            for d, after in zip(inside, [*inside[1:], 10**9]):
                band.append(d)
                if after - d > licenses.DRIFT:
                    share = len(set().union(*(at[x] for x in band))) / (n - 1)
                    band = []
                    if share >= licenses.COVER:
                        named, score = named | {label}, max(score, share)
    return ",".join(sorted(named)), score


def test_repeated_pairs_after_a_statement_take_nothing_from_it(spark):
    exact = "You may not use this file except in compliance with the License"
    docs = [(1, f"{exact} " + "the license " * 30), (2, exact), (3, "the license " * 500 + exact + " the license" * 500), (4, "the license " * 30), (5, f"{exact}, {exact}" * 200)]
    found = check(spark.createDataFrame(docs, "doc_id long, text string"))
    assert found == {1: ("apache", 1.0), 2: ("apache", 1.0), 3: ("apache", 1.0), 4: ("", 0.0), 5: ("apache", 1.0)}


def test_labels_and_scores_by_brute_force(spark, documents):
    rng = random.Random(4)
    text = [t for t, _ in licenses.TEMPLATES]
    docs = []
    for i in range(200):
        own = " ".join(rng.choice([*text, "the license", "gnu general", "x y z"]) for _ in range(rng.randrange(6))).split()
        for _ in range(rng.randrange(6)):
            own.insert(rng.randrange(len(own) + 1), rng.choice(["and", "the", "license", "q"]))
        docs.append((i, " ".join(w for w in own if rng.random() > 0.1)))
    got = check(spark.createDataFrame(docs, "doc_id long, text string"))
    assert got == {i: labels(t) for i, t in docs} and len({x for x, _ in got.values()}) > 10
    assert check(documents) == {r.doc_id: labels(r.text) for r in documents.collect()}
