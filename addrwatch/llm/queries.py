"""The numbered operators as registered queries, with comparison SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from addrwatch.llm import (
    decontamination, hamming, labelled, lexical, lines, near, packing, quality, repeats, secrets, token_files, toxicity, vector_codes, vector_links,
)
from addrwatch.session import scratch_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    items = pieces.select("row", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(items).drop("row")


@query("op2_token_files")
def token_id_files(spark: SparkSession, sf: str) -> DataFrame:
    ids = token_files.token_table(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    folder = scratch_dir(spark, "token-files")
    token_files.write(ids, folder)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
hits AS (SELECT doc_id, i, n, t FROM (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n))
  WHERE t IN (SELECT t FROM bw)),
n_hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS ids FROM hits JOIN bw USING (t) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_benchmark_decontamination", _DECONTAMINATION)
def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf, "labels"), labelled.remainder("doc_id", 4) != 2)
    return _judged(toxicity.scored(docs, lexicon), labelled.remainder("doc_id", 4) == 2)


@query("op9_quality")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf, "labels"), labelled.remainder("doc_id", 5) != 0)
    return _judged(quality.scored(docs, model), labelled.remainder("doc_id", 5) == 0)


def _judged(scores: DataFrame, held_out: Column) -> DataFrame:
    return scores.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op7_secrets")
def secret_spans(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *map(count, secrets.BASE),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query("op6_repeated_substrings")
def repeated_substrings(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_near_duplicates")
def near_duplicate_classes(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf, "documents")).select("doc_id", "class_id", "n_links")


@query("op5_line_dedup")
def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    listed = F.transform("line_classes", lambda x: F.concat_ws(":", x["line"], x["class_id"], x["links"]))
    return found.select("doc_id", "n_lines", "n_removed", "n_links", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
                        F.array_join(listed, ",").alias("line_classes"))


_NEAREST = """
WITH c AS (SELECT vec_id, CAST(array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END FOR x IN embedding], '') AS BIT) AS code
  FROM embeddings WHERE len(embedding) = 64),
d AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, CAST(bit_count(xor(q.code, r.code)) AS BIGINT) AS distance
  FROM c q JOIN c r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d) WHERE rank <= 10
"""


@query("op3_hamming_top_k", _NEAREST)
def hamming_top_k(spark: SparkSession, sf: str) -> DataFrame:
    codes = hamming.sign_codes(table(spark, sf, "embeddings"), bits=64)
    return hamming.nearest(codes, F.col("id") % 20 == 0, k=10, bits=64)


_RANKED = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
scored AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * tf.n * s.N) // s.L)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""


@query("op11_lexical_search", _RANKED)
def lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)


_LINKED = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
  coalesce(len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([1 FOR x IN embedding IF x <> 0]) > 0, false) AS fit
  FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.fit AND b.fit AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""


@query("op12_embedding_near_duplicates", _LINKED)
def embedding_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return vector_links.near_vectors(table(spark, sf, "embeddings"), threshold=0.95)


def _codes_sql(rounds: int = 4) -> str:
    """Each round as two tables: the nearest entry of every part, and the averages that become the next entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, p, x, min_by(i, (dist, i)) AS i, min(dist) AS dist FROM (
  SELECT vec_id, parts.p, x, i, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, e)]) AS BIGINT) AS dist
  FROM parts JOIN b{r} ON parts.p = b{r}.p) GROUP BY vec_id, p, x)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT b{r}.p, b{r}.i, coalesce(m.e, b{r}.e) AS e FROM b{r} LEFT JOIN (
  SELECT p, i, list(mean ORDER BY place) AS e FROM (
    SELECT p, i, place, CAST(floor(sum(c) / count(*)) AS BIGINT) AS mean
    FROM (SELECT p, i, unnest(range(1, len(x) + 1)) AS place, unnest(x) AS c FROM a{r}) GROUP BY ALL) GROUP BY p, i) m
  ON b{r}.p = m.p AND b{r}.i = m.i)""")
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, e[p * len(e) // 4 + 1:(p + 1) * len(e) // 4] AS x FROM v, range(4) AS t(p)),
b0 AS MATERIALIZED (SELECT p, x AS e, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i FROM parts
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 256)),
{", ".join(steps)},
coded AS (SELECT vec_id, string_agg(lpad(lower(hex(i)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), books
"""


@query("op13_vector_codes", _codes_sql())
def vector_code_compression(spark: SparkSession, sf: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf, "embeddings"))
    found = vector_codes.with_label_errors(coded)
    return found.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))
