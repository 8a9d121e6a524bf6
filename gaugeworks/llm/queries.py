"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from gaugeworks.llm import convnet, fingerprints, hosts, jaccard, licenses, mixing, nra, packing, periods, pii, prefixes, simhash, suffixes
from gaugeworks.llm.common import LOWER, UPPER, table, tokenizer_path
from gaugeworks.llm.registered import query


@query("op2_exact_dedup", f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op3_mixing")
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("places")).alias("taken"))


@query("op1_packing")
def pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = convnet.train(docs, table(spark, sf_dir, "labels"))
    return convnet.scored(docs, model).select("doc_id", convnet.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op9_ngram_join", rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM d),
e AS (SELECT doc_id, unnest(g) AS gram, len(g) AS n FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b USING (gram) WHERE a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, len(s.g) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id
FROM s LEFT JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, s.g""")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op7_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def _hosts_sql() -> str:
    """The filter in SQL: what arrives after each number of links, summed."""
    host = f"translate(regexp_extract({{0}}, '^[\\s\\S]*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    ordered = sorted(hosts.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True)) + " END"
    ruling = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True)) + " END"
    d = hosts.DAMPING
    return f"""
WITH RECURSIVE u AS (SELECT page_id, coalesce(html, '') AS html, {host.format("coalesce(url, '')")} AS host,
    regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, {rule} AS rule, {ruling} AS ruling FROM u),
h AS (SELECT host AS source, unnest(regexp_extract_all(html, '{hosts.LINK.replace("'", "''")}', 1)) AS link FROM p),
g AS (SELECT source, {host.format("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS target FROM h),
e AS (SELECT source, target, count(*) AS w FROM g WHERE source <> target AND source <> '' AND target <> '' GROUP BY ALL),
k AS (SELECT source AS host, target AS dest, w / sum(w) OVER (PARTITION BY source) AS t, 0.0::DOUBLE AS d FROM e
  UNION ALL SELECT target, source, 0.0::DOUBLE, w / sum(w) OVER (PARTITION BY target) FROM e),
n AS (SELECT host, count(*) FILTER (ruling = 'allow') / count(*) AS trust FROM p WHERE ruling IS NOT NULL AND host <> '' GROUP BY host),
x AS (SELECT 0 AS i, host, trust * {1 - d} AS trust, (1 - trust) * {1 - d} AS distrust FROM n
  UNION ALL SELECT i + 1, k.dest, sum(x.trust * k.t * {d}), sum(x.distrust * k.d * {d}) FROM x JOIN k USING (host)
  WHERE i < 300 GROUP BY i, k.dest HAVING sum(x.trust * k.t * {d}) + sum(x.distrust * k.d * {d}) > 0),
r AS (SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM x GROUP BY host)
SELECT page_id, host, path, rule, coalesce(ruling, CASE WHEN n.trust = 0 OR (r.distrust > 0 AND r.distrust >= {hosts.THRESHOLD} * (r.trust + r.distrust)) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN r USING (host) LEFT JOIN n USING (host)"""


@query("op6_url_filter", _hosts_sql())
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op8_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query("op10_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


@query("op5_repeats")
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents"))


#: crc32 of a number's decimal digits in SQL: a step per bit; a digit's code comes in with the first of its eight steps.
_CRC = ("xor(list_reduce(flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])), "
        "lambda s, x: xor((xor(s, x)) >> 1, 3988292384 * ((xor(s, x)) & 1)), 4294967295::BIGINT), 4294967295)")


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's text: a tenth of the documents repeat a few of their words to the end. Documents without an id stay."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


@query("op11_periods", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o, {_CRC.format("doc_id")} AS h FROM documents),
c AS (SELECT *, CAST(len(o) AS BIGINT) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM c),
b AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (SELECT doc_id, n, CASE WHEN a < n THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN o[i + 1] ELSE o[a + (i - a) % p + 1] END) ELSE o END AS w FROM b),
e AS (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(w) AS word FROM t),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, word ORDER BY i) AS k,
  hash(word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS five FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM f x JOIN f y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i < x.i AND 4 * (x.i - y.i) <= x.n
  WHERE x.i + 4 < x.n),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
z AS (SELECT doc_id, q, min(i) - q AS start, max(i) + 5 - min(i) + q AS length FROM s GROUP BY doc_id, q, island HAVING length >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM z GROUP BY doc_id, start, length),
g AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256 FROM r GROUP BY doc_id),
best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed_sha256 FROM e ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed_sha256, sha256('')) AS collapsed_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.strongest(periods.periodic(table(spark, sf_dir, "documents"), _planted))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_simhash")
def simhash_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op13_prefix_trie", rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC.format("conv_id")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
u AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base WHERE pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos > h),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d, length(role) || ':' || role || text AS turn,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM u),
p AS (SELECT conv_id, d, words, string_agg(md5(turn), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM o
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
k AS (SELECT conv_id, max(d) AS ending FROM p GROUP BY conv_id),
n AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CASE WHEN d = ending THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM p JOIN k USING (conv_id) GROUP BY path, d),
x AS (SELECT *, left(path, 32 * (depth - 1)) AS up, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND left(m.path, 32 * n.depth) = n.path) AS n_children FROM n),
s AS (SELECT left(path, 32 * top) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM x) GROUP BY ALL)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, CASE WHEN x.depth > 0 THEN n.conv_id END AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM x JOIN s USING (path) LEFT JOIN n ON n.path = x.up AND x.depth > 0""")
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.numbered(table(spark, sf_dir, "conversations"))
    turns, members = prefixes.rebuilt(turns, 20, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4, 3)
    return prefixes.trie(turns, members).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
