"""Personal data: fixed patterns, and further spans by weak supervision.

Four kinds have fixed patterns (email, ip, card, phone). Further candidates, such as secrets, account and identity numbers, are
judged by labelers: the shape of the span (regex), key words before it (gazetteer), the characters around it
(context), and what it is made of. A labeler votes 1, 0 or abstains (-1). Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is; its posteriors train a logistic classifier of spans.

There are at most 3^labelers vote patterns, whatever the corpus, so the estimation runs on a table of fixed size.
Positions come from split and extract with the same pattern, in code points. There is no Python in the tasks.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.sources.scratch import materialise

#: The fixed patterns. Possessive repeats match the same as greedy ones here and need no stack, and a
#: match may begin only where a run begins or the last match ended, which keeps long runs linear.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates for the method, by kind.
FURTHER = {
    "account": r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?|[0-9]{13,19})(?![A-Za-z0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+(?![A-Za-z0-9_-])",
}
#: Strict shapes, key words (in lower case, up to BEFORE characters before the span) and assignments.
SHAPES = {"account": r"^[A-Z]{2}[0-9]{2}", "identity": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
          "secret": r"^(?:[0-9a-f]{24,}|[0-9A-F]{24,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|(?=[^0-9]*[0-9])(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])[A-Za-z0-9_-]{24,})$"}
GAZETTEER = {"account": ("iban", "account", "konto", "compte", "cuenta", "card", "karte", "carte", "tarjeta"),
             "identity": ("ssn", "social security", "tax id", "passport", "identity"),
             "secret": ("token", "secret", "password", "passwd", "api key", "api_key", "apikey", "access key", "credential", "bearer", "private key")}
BEFORE = 24
LABELERS = ("shape", "gazetteer", "context", "makeup")


def spans(text: Column, pattern: str, needs: str) -> Column:
    """All leftmost non-overlapping matches as structs (start, end, match), end exclusive, in code points.

    needs: a string without which there is no match, or an empty one.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    sized = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("b"), F.length(m).alias("n"), m.alias("m")))
    walked = F.aggregate(sized, F.struct(F.lit(0).alias("at"), none.alias("all")), lambda s, x: F.struct(
        (s["at"] + x["b"] + x["n"]).alias("at"),
        F.concat(s["all"], F.array(F.struct((s["at"] + x["b"]).alias("start"), (s["at"] + x["b"] + x["n"]).alias("end"), x["m"].alias("match")))).alias("all")))["all"]
    return F.when(F.contains(text, F.lit(needs)) & F.rlike(text, F.lit(pattern)), walked).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' check sum is a multiple of ten."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.try_to_number(F.ltrim(p, F.lit("0")), F.lit("999")), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(match)).between(13, 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed patterns' matches that hold up, per kind; a failing match is dropped without another try."""
    return {kind: _filtered(kind, spans(text, pattern, NEEDS[kind])) for kind, pattern in BASE.items()}


def _filtered(kind: str, found: Column) -> Column:
    return F.filter(found, lambda x: _valid(kind, x["match"]))


def votes(kind: str, text: Column, x: Column) -> dict[str, Column]:
    """The labelers' votes on a candidate span: 1 personal, 0 not, -1 no opinion."""
    m = x["match"]
    before = F.lower(F.substring(text, F.greatest(F.lit(1), x["start"] + 1 - BEFORE), F.least(x["start"], F.lit(BEFORE))))
    after = F.substring(text, x["end"] + 1, F.lit(1))
    digits, letters = F.length(_digits(m)), F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    named = F.lit(False)
    for word in GAZETTEER[kind]:
        named = named | F.contains(before, F.lit(word))
    assigned = F.rlike(before, F.lit("""[=:]\\x20?["']?$""")) | (F.rlike(before, F.lit("""["'(]$""")) & F.rlike(after, F.lit("""["')]""")))
    prose = F.rlike(before, F.lit(r"[\p{L},.]\x20$"))
    return {"shape": F.when(F.rlike(m, F.lit(SHAPES[kind])), 1).otherwise(0 if kind == "secret" else -1),
            "gazetteer": F.when(named, 1).otherwise(-1),
            "context": F.when(assigned, 1).when(prose, 0).otherwise(-1),
            "makeup": F.when((digits > 0) & (letters > 0), 1).when(digits == 0, 0).otherwise(-1)}


def candidates(text: Column) -> Column:
    """Candidate spans of the method, with the vote pattern of each as a number in base 3."""
    parts = []
    for kind, pattern in FURTHER.items():
        parts.append(_voted(kind, text, spans(text, pattern, "")))
    return F.concat(*parts)


def _voted(kind: str, text: Column, found: Column) -> Column:
    def one(x: Column) -> Column:
        code = F.lit(0)
        for vote in votes(kind, text, x).values():
            code = code * 3 + vote + 1
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), code.cast("int").alias("pattern"))

    return F.transform(found, one)


def reliabilities(patterns: DataFrame, rounds: int = 20) -> tuple[DataFrame, dict]:
    """EM on (pattern, n): patterns with the posterior ``p`` of a span being personal, and the estimates.

    The model is the one of Dawid and Skene with two classes, smoothed by one vote. It starts from the
    majority of the votes. Each round is one aggregate over at most 3^labelers rows.
    """
    table = patterns
    for k, name in enumerate(LABELERS):
        table = table.withColumn(name, F.floor(F.col("pattern") / 3 ** (len(LABELERS) - 1 - k)) % 3 - 1)
    ones = sum((F.col(c) == 1).cast("double") for c in LABELERS)
    cast = sum((F.col(c) >= 0).cast("double") for c in LABELERS)
    table = table.withColumn("p", (ones + 0.5) / (cast + 1))
    found = {}
    sums = [((F.sum(F.col("n") * F.col("p")) + 1) / (F.sum("n") + 2)).alias("prior")]
    for c in LABELERS:
        for side, weight in (("yes", F.col("n") * F.col("p")), ("no", F.col("n") * (1 - F.col("p")))):
            sums.append(((F.sum(F.when(F.col(c) == 1, weight).otherwise(0)) + (0.8 if side == "yes" else 0.2))
                         / (F.sum(F.when(F.col(c) >= 0, weight).otherwise(0)) + 1)).alias(f"{c}_{side}"))
    for _ in range(rounds):
        found = table.agg(*sums).first().asDict()
        odds = F.lit(math.log(found["prior"] / (1 - found["prior"])))
        for c in LABELERS:
            yes, no = (min(max(found[f"{c}_{s}"], 1e-3), 1 - 1e-3) for s in ("yes", "no"))
            odds = odds + F.when(F.col(c) == 1, math.log(yes / no)).when(F.col(c) == 0, math.log((1 - yes) / (1 - no))).otherwise(0.0)
        table = table.withColumn("p", 1 / (1 + F.exp(-odds)))
    return table, found


def train(docs: DataFrame, threshold: float = 0.5) -> tuple[list[int], dict]:
    """The vote patterns that the final classifier takes for personal data, and the labelers' estimates.

    Counts of patterns come from all texts. The classifier is a logistic regression of the votes, fitted on
    every pattern twice, as personal and as not, weighted by count and posterior.
    """
    counted = (docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c"))
               .groupBy(F.col("c.pattern").alias("pattern")).agg(F.count(F.lit(1)).alias("n")))
    patterns = materialise(counted, "patterns")
    if patterns.isEmpty():
        return [], {}
    table, found = reliabilities(patterns)
    inputs = [(F.col(c) == v).cast("double").alias(f"{c}{v}") for c in LABELERS for v in (0, 1)]
    flat = table.select("pattern", "n", "p", *inputs)
    both = flat.withColumn("y", F.lit(1.0)).withColumn("w", F.col("n") * F.col("p")).union(
        flat.withColumn("y", F.lit(0.0)).withColumn("w", F.col("n") * (1 - F.col("p")))).where("w > 1e-9")
    assemble = VectorAssembler(inputCols=[f"{c}{v}" for c in LABELERS for v in (0, 1)], outputCol="x")
    fitted = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1e-4, maxIter=50).fit(assemble.transform(both))
    judged = fitted.transform(assemble.transform(flat)).where(vector_to_array("probability")[1] >= threshold)
    return sorted(r.pattern for r in judged.select("pattern").collect()), found


def found(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with all personal data in it.

    doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of kind:start:end of the base spans, by kind as listed, then
    start, comma-joined) and spans (all, the method's after the base ones; those that overlap a base span
    are left out). Null and empty texts have no spans. Identical rows get identical results. Other columns are
    ignored; an empty table gives an empty result.

    Texts are read twice, once for the counts and once for the result, and are never shuffled.
    """
    accepted, _ = train(docs)
    text = F.coalesce("text", F.lit(""))
    base = base_spans(text)
    rows = docs.select("doc_id", *[v.alias(k) for k, v in base.items()],
                       F.filter(candidates(text), lambda x: x["pattern"].isin(accepted) if accepted else F.lit(False)).alias("more"))

    def listed(spans: Column, kind: Column | None = None) -> Column:
        return F.transform(spans, lambda x: F.concat_ws(":", kind if kind is not None else x["kind"], x["start"].cast("string"), x["end"].cast("string")))

    taken = F.concat(*[F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for k in base])
    free = F.filter("more", lambda x: ~F.exists(taken, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    own = F.concat(*[listed(F.col(k), F.lit(k)) for k in base])
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
                       F.sha2(F.array_join(own, ",").cast("binary"), 256).alias("base_sha256"),
                       F.array_join(F.concat(own, listed(free)), ",").alias("spans"))
