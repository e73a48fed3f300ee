"""Registered queries of the operators, each over its whole table, with SQL
where DuckDB can say the same."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (decontam, neardup, packing, periodic, quality, repeats, secrets, sharding, spelling, tokens, topk,
                          toxicity, warc)
from tillroll.llm.common import crc_fold, read_table
from tillroll.session import shared_path


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def _hex(text) -> F.Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark n-gram hits of every document."""
    marked = decontam.scan_benchmark(_docs(spark, sf_dir, "doc_id", "text"),
                                     read_table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        _hex(F.array_join("hit_items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
x AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT x.r, x.i, x.n, g.item FROM x JOIN g ON x.g = g.g AND x.n = g.n),
c AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
t AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM h GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles."""
    found = neardup.near_duplicates(_docs(spark, sf_dir, "doc_id", "text"), k=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return (toxicity.score_toxicity(docs, model)
            .select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: patterns and token efficiency."""
    found = secrets.scan_secrets(_docs(spark, sf_dir, "doc_id", "text"))
    f = F.col("findings")
    n = lambda kind: F.size(F.filter(f, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        _hex(secrets.joined(f, secrets.KINDS[:3])).alias("base_sha256"),
                        secrets.joined(f).alias("spans"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 tokens."""
    pieces = packing.pack(_docs(spark, sf_dir, "doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    docs = _docs(spark, sf_dir, "doc_id", "text").withColumn(
        "n_bytes", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")))
    return tokens.over_limit(tokens.count_tokens(docs)).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = shared_path(spark, "llm", "warc", unique=True)
    warc.write_warc(pages, path)
    back = warc.resolve(warc.read_warc(spark, path, payload=False))
    as_id = lambda c: F.col(c).cast(pages.schema["page_id"].dataType)
    return back.select(as_id("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       as_id("refers_to").alias("refers_to"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return (quality.score_quality(docs, model)
            .select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards along a Hilbert curve over language, source,
    length and id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _docs(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars").select(
        "doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = sharding.hilbert_shards(rows, ["lang", "source", "n_chars", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every query vector by integer inner product."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 50 bytes of earlier documents cover."""
    found = repeats.remove_repeats(_docs(spark, sf_dir, "doc_id", "text"), span=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def one_letter_less(run: str, doc_id: bytes) -> str:
    """The run, without one letter if 31 divides the checksum of id and run."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc_id + b":"))
    at = h % len(run)
    return run if h % 31 else run[:at] + run[at + 1:]


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some of which lose a letter."""
    words = spelling.count_words(_docs(spark, sf_dir, "doc_id", "text"), shortest=7, change=one_letter_less)
    return spelling.group_variants(words, least=2, ratio=10)


def repeated_tail(words: list[bytes], doc_id: bytes) -> list[bytes]:
    """The words, in one document of ten with a tail that repeats its first words."""
    h, n = zlib.crc32(doc_id), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, some of which get a periodic tail."""
    found = periodic.find_runs(_docs(spark, sf_dir, "doc_id", "text"), least=4, shortest=6, change=repeated_tail)
    runs = F.col("runs")
    # the greatest length, then the smallest start and period
    best = F.array_sort(F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    best = F.get(best, 0)
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    return found.withColumn("best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"), F.expr("-1000 * best.l div best.p").alias("exponent_milli"),
        _hex(F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")).alias("runs_sha256"),
        _hex(F.col("collapsed")).alias("collapsed_sha256"))


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT r, doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
  FROM d),
k AS (SELECT s, min(r) AS c, min(doc_id) AS least FROM s WHERE len(s) > 0 GROUP BY s),
e AS (SELECT c, len(s) AS n, unnest(s) AS g FROM k),
p AS (
  SELECT x.c AS a, y.c AS b, x.n AS na, y.n AS nb, count(*) AS shared
  FROM e x JOIN e y ON x.g = y.g AND x.c < y.c AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * shared >= 80 * (na + nb - shared)),
l2 AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(c, o) AS (
  SELECT DISTINCT a, a FROM l2
  UNION
  SELECT t.c, l2.b FROM t JOIN l2 ON t.o = l2.a),
m AS (SELECT t.c, min(k.least) AS g FROM t JOIN k ON t.o = k.c GROUP BY t.c)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(m.g, k.least) END AS component_id,
       s.doc_id IS NOT DISTINCT FROM (CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE coalesce(m.g, k.least) END) AS kept
FROM s LEFT JOIN k ON s.s = k.s LEFT JOIN m ON k.c = m.c
"""

OP10_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS a
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr,
         CAST(list_inner_product(q.a, c.a) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.a) = len(c.a)
  WHERE q.vec_id % 50 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, cr) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""

# base32 of a SHA-1: eight letters for each ten hex digits
OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (
  SELECT page_id, payload, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first
  FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         (CAST('0x' || substr(h, CAST(10 * (j // 8) + 1 AS BIGINT), 10) AS BIGINT) >> (35 - 5 * (j % 8))) & 31
         AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

# texts as hex digits, two for each byte
OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id, hex(encode(coalesce(text, ''))) AS h
  FROM documents),
w AS (
  SELECT r, id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT r, id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
m AS (SELECT s, min(id) AS least FROM w GROUP BY s),
c AS (SELECT r, i FROM w JOIN m USING (s) WHERE least < id),
g AS (
  SELECT r, i, sum(CASE WHEN i <= p + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM c)),
s AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY r, g),
k AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
         string_agg(substr(h, 2 * o + 1, 2 * (a - o)), '' ORDER BY a) AS kept
  FROM (SELECT r, a, b, h, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS o FROM s JOIN d USING (r)) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE kept || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

# crc32 by its table of 256 entries, from the polynomial
CRC_SQL = """
crc_table AS MATERIALIZED (
  SELECT n AS k, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) AS v
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)),
crc(s, h, acc, pos) AS (
  SELECT s, hex(encode(s)), CAST(4294967295 AS BIGINT), 1 FROM crc_input
  UNION ALL
  SELECT s, h, xor(acc >> 8, v), pos + 2
  FROM crc JOIN crc_table ON k = xor(acc & 255, CAST('0x' || substr(h, pos, 2) AS BIGINT)) WHERE pos < len(h)),
crc_of AS MATERIALIZED (SELECT s, xor(acc, CAST(4294967295 AS BIGINT)) AS crc FROM crc WHERE pos > len(h))
"""

OP12_SQL = r"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc, run, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents) WHERE len(run) >= 7 GROUP BY ALL),
crc_input AS (SELECT doc || ':' || run AS s FROM runs),
""" + CRC_SQL + """,
v AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % len(run)) || substr(run, crc % len(run) + 2) ELSE run END AS word, n
        FROM runs JOIN crc_of ON doc || ':' || run = s)
  WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
del AS MATERIALIZED (
  SELECT word, n, i, len(word) AS l, substr(word, 1, i) || substr(word, i + 2) AS d
  FROM (SELECT word, n, unnest(range(0, len(word))) AS i FROM v)),
pair AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM del x JOIN del y ON x.d = y.d AND x.i = y.i AND x.l = y.l AND x.word <> y.word
  UNION SELECT del.word, v.word, v.n FROM del JOIN v ON del.d = v.word
  UNION SELECT v.word, del.word, del.n FROM del JOIN v ON del.d = v.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pair GROUP BY word),
f AS MATERIALIZED (
  SELECT v.word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
up(word, root) AS (
  SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON up.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, up.root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM f JOIN up ON f.word = up.word JOIN (SELECT word FROM f WHERE form IS NULL) e ON up.root = e.word
"""

OP13_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS s,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
crc_input AS (SELECT DISTINCT s FROM d),
""" + CRC_SQL + """,
e AS (
  SELECT r, doc_id, w, len(w) AS n, crc, CASE WHEN crc % 10 = 0 AND len(w) > 0 THEN (crc // 10) % len(w) END AS a
  FROM d LEFT JOIN crc_of USING (s)),
q AS (SELECT *, 1 + (n - a) // (3 + (crc // 10) % 8) AS p FROM e),
t AS MATERIALIZED (
  SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM q),
x AS MATERIALIZED (SELECT r, n, unnest(range(0, n)) AS i, unnest(w) AS w FROM t),
y AS (
  SELECT x.r, x.i, z.i - x.i AS q FROM x JOIN x z ON x.r = z.r AND x.w = z.w AND z.i > x.i AND 4 * (z.i - x.i) <= x.n),
g AS (SELECT r, q, min(i) AS a, count(*) + q AS l
      FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM y) GROUP BY r, q, k),
u AS MATERIALIZED (SELECT r, a, l, min(q) AS q FROM g WHERE l >= greatest(6, 4 * q) GROUP BY r, a, l),
b AS (
  SELECT r, count(*) AS n_runs, first(a ORDER BY l DESC, a, q) AS start, first(l ORDER BY l DESC, a, q) AS length,
         first(q ORDER BY l DESC, a, q) AS period, string_agg(a || ',' || l || ',' || q || chr(10), '' ORDER BY a, q) AS runs
  FROM u GROUP BY r),
o AS (SELECT DISTINCT r, unnest(range(a + q, a + l)) AS i FROM u),
c AS (SELECT x.r, string_agg(x.w, ' ' ORDER BY x.i) AS kept FROM x ANTI JOIN o ON x.r = o.r AND x.i = o.i GROUP BY x.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (r) LEFT JOIN c USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_near_duplicates, op3_toxicity, op4_secrets, op5_packing,
                            op6_token_counts, op7_warc, op8_quality, op9_sharding, op10_top_k, op11_repeats,
                            op12_spelling, op13_periodic)
}

#: DuckDB SQL where it can express the query; the others have brute-force tests
SQL: dict[str, str] = {"op1_decontamination": OP1_SQL, "op2_near_duplicates": OP2_SQL, "op7_warc": OP7_SQL,
                       "op10_top_k": OP10_SQL, "op11_repeats": OP11_SQL, "op12_spelling": OP12_SQL,
                       "op13_periodic": OP13_SQL}
