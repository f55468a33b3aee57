"""Registered corpus queries: each applies one operator, with its production
parameters, to the whole of its table, and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


# Every 50-byte window by its hex digits; removed runs are islands of windows that an earlier document has.
OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 49 + 1)) AS i FROM d),
k AS (SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS s FROM w),
f AS (SELECT s, min(doc_id) AS m FROM k GROUP BY s),
g AS (SELECT k.doc_id, k.i FROM k JOIN f ON k.s = f.s WHERE f.m < k.doc_id),
n AS (SELECT *, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50 AS gap FROM g),
r AS (SELECT *, count(*) FILTER (WHERE gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM n),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 49 AS b FROM r GROUP BY doc_id, run),
pieces AS (SELECT s.doc_id, s.a, s.b, coalesce(lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0) AS before FROM spans s),
kept AS (SELECT p.doc_id, sum(p.b - p.a + 1) AS gone, count(*) AS spans, max(p.b) AS last,
                string_agg(substr(d.h, 2 * p.before + 1, 2 * (p.a - p.before - 1)), '' ORDER BY p.a) AS h
         FROM pieces p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN d.h ELSE k.h || substr(d.h, 2 * k.last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@query("op6_suffix_dedup", OP6_SQL)
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat a 50-byte string of an earlier one, removed."""
    from adlake.llm.repeats import remove_repeats

    kept = remove_repeats(documents(spark, sf_dir), min_bytes=50)
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (
  SELECT DISTINCT doc_id, l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] AS g FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM w WHERE len(l) >= 3)
  UNION ALL SELECT doc_id, array_to_string(l, ' ') FROM w WHERE len(l) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM o JOIN n p ON o.x = p.doc_id JOIN n q ON o.y = q.doc_id WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT w.doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM w JOIN reach r ON w.doc_id = r.x LEFT JOIN n ON w.doc_id = n.doc_id GROUP BY w.doc_id
"""


@query("op10_ngram_jaccard_join", OP10_SQL)
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 3-word shingle sets of Jaccard similarity 0.9 or more."""
    from adlake.llm.jaccard import exactly, ngram_jaccard_join

    found = ngram_jaccard_join(documents(spark, sf_dir), k=3, similarity=exactly("0.9"))
    return found.select(F.col("id").alias("doc_id"), F.col("n_ngrams").alias("n_shingles"), F.col("component").alias("component_id"))


TOKENIZER = "byte_bpe_50k.json"


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    from adlake.llm.packing import pack_documents

    return pack_documents(documents(spark, sf_dir), TOKENIZER, 2048)


@query("op5_length_histogram")
def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, quantiles and truncated totals of encoded lengths for every context limit."""
    from adlake.llm.tokens import length_histogram, token_lengths

    return length_histogram(token_lengths(documents(spark, sf_dir), TOKENIZER))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text, the base rule and the learned list's verdict."""
    from adlake.llm.common import stage
    from adlake.llm.quality_rules import judged, learn_rules, with_stats

    stats = stage(with_stats(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "__stats.*"), "quality-stats")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rules = learn_rules(stats.join(labels, "doc_id"), "quality")
    return judged(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query("op8_toxic_segments")
def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, from its significant segments."""
    from adlake.llm.common import unstage
    from adlake.llm.toxicity import fold, labelled_rows, learn, score_documents

    docs = documents(spark, sf_dir)
    rows = labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = learn(rows)
    unstage(rows)
    scored = score_documents(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"), (fold("id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_tokens", "n_passages", "best_place"
    )


@query("op9_improbable_features")
def op9_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text and its edited text, and their likenesses."""
    from adlake.llm.fingerprint import edit_likeness, entropy_histogram, ranks

    docs = documents(spark, sf_dir)
    found = edit_likeness(docs, ranks(entropy_histogram(docs)))
    return found.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


# Base32 by five bits of the hex digest at a time.
OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
e AS (SELECT page_id, n, x, min(page_id) OVER (PARTITION BY x) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(x, 5 * j // 4 + 1, 2) AS INTEGER) >> CAST(3 - 5 * j % 4 AS INTEGER)) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM e
"""


@query("op7_warc_round_trip", OP7_SQL)
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    from adlake.llm.warc import read_archives, write_archives
    from adlake.session import scratch_dir

    path = scratch_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, min_bytes=0)
    found = read_archives(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


@query("op1_role_repair")
def op1_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation repaired to legal turns at the least cost, and rendered."""
    from adlake.llm.chat import repair_conversations

    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op2_soft_mixing")
def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors and rates of every document, for the target weights of the domains."""
    from adlake.llm.common import stage
    from adlake.llm.mixing import TARGETS, domain_posteriors, with_rates

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = stage(domain_posteriors(documents(spark, sf_dir), labels), "mixing-posteriors")
    found = with_rates(rows, TARGETS)
    return found.select("doc_id", "n_tokens", "p_high", "p_low", "p_toxic", "rate")


def _op13_sql(rounds: int = 3) -> str:
    """The rounds one after another; ties by the smaller number in the low digits of the least distance."""
    steps = ["""v0 AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT vec_id, i, CAST(floor(64 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM v0)),
c0 AS (SELECT j, i, x FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j FROM v0 QUALIFY j < 16) JOIN v USING (vec_id))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, min(16 * d + j) % 16 AS j, min(16 * d + j) // 16 AS d FROM (
  SELECT vec_id, j, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d FROM v JOIN c{r} c USING (i) GROUP BY ALL) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT j, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN v USING (vec_id) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT j, i, CAST(CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x FROM c{r} c LEFT JOIN m{r} USING (j, i))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN (SELECT j, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j) h ON a.j = h.j
"""


@query("op13_shallot_clusters", _op13_sql())
def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors clustered by three exact integer rounds about 16 centroids."""
    from adlake.llm.centroids import shallot_clusters

    return shallot_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, dim=64, scale=64, rounds=3, seed=1).withColumnRenamed("id", "vec_id")


# crc32 byte by byte from its table; near words by strings that leave out a place, instead of trie nodes.
OP11_SQL = r"""
WITH RECURSIVE tbl AS MATERIALIZED (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t FROM (SELECT unnest(range(256)) AS n)),
r AS (SELECT doc_id, run, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || run, ''),
        lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) AS BIGINT) - 64] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM r, tbl),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
s AS MATERIALIZED (SELECT word, n, substr(word, 1, i) || '?' || substr(word, i + 2) AS k, substr(word, 1, i) || substr(word, i + 2) AS short FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n FROM s a JOIN s b ON a.k = b.k AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM s JOIN w ON s.short = w.word UNION SELECT w.word, s.word, s.n FROM s JOIN w ON s.short = w.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, {'fewer': -n, 'word': other}) AS form FROM near GROUP BY word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, g.word AS form, g.n AS form_n FROM w LEFT JOIN best b ON w.word = b.word LEFT JOIN w g ON b.form = g.word AND g.n >= 5 * w.n),
chain AS (SELECT word, word AS at, form FROM f UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN f ON c.form = f.word)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""


@query("op11_spelling_variants", OP11_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the corpus, their near words and the forms that they vary."""
    from adlake.llm.spellings import spelling_variants

    return spelling_variants(documents(spark, sf_dir), min_letters=6, min_count=5, factor=5)


@query("op12_web_quality")
def op12_web_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by positive-unlabelled learning."""
    from adlake.llm.web_quality import quality_scores

    found = quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
