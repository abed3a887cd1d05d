"""The operators as queries over ``documents``, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia import configure
from retentia.llm import cotrain, divergence, exact_dedup, language, mixing, packing, pii, resampling, rules, simhash, substrings, tokens, topk
from retentia.llm.common import documents

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}


def query(build: Build) -> Build:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return cotrain.scored(docs, cotrain.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicated(documents(spark, sf_dir))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(documents(spark, sf_dir), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(documents(spark, sf_dir))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(documents(spark, sf_dir)))


@query
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(documents(spark, sf_dir), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer(), capacity=1024)


@query
def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir), least=10, top=10)


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resampled(documents(spark, sf_dir), target, share=(25, 100), buckets=10_000, longest=2, least_words=20, seed=7)


SQL = {
    "op2_mixing": """
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
    SELECT source, (SELECT sum(n) FROM counts)::DOUBLE * (1.0::DOUBLE / (SELECT count(*) FROM counts)) / n AS rate FROM counts
), parts AS (
    SELECT source, rate, greatest(1, ceil(rate / 16.0::DOUBLE))::INT AS parts FROM rates
), steps AS (
    SELECT source, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS cdf FROM parts
    UNION ALL
    SELECT source, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM steps WHERE k < 100
), cdfs AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM steps GROUP BY source),
drawn AS (
    SELECT d.*, list_sum(list_transform(range(1, p.parts + 1), lambda j:
        len(list_filter(c.cdf, lambda x: x <= ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '') || ':' || j), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)))) AS copies
    FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT * EXCLUDE (copies), unnest(range(1, copies::BIGINT + 1)) AS copy FROM drawn WHERE copies > 0
""",
    "op5_exact_dedup": r"""
WITH digests AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM digests
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
""",
    "op11_topk": """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.ints, c.ints)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
""",
    "op12_divergence": r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
pairs_of AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM pairs_of LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
    SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (t.total + 2 * l.v) AS p,
           1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
    FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
    FROM pairs_of a JOIN pairs_of b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), both_parts AS (
    SELECT * FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 10
""",
    "op13_resampling": r"""
WITH RECURSIVE steps AS (
    SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8),
texts AS (
    SELECT 'documents' AS of, row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL
    SELECT 'benchmark', 0, NULL, text FROM benchmark
), words AS (
    SELECT of, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), features AS (
    SELECT of, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words
), counts AS (SELECT of, row, feature, count(*) AS n FROM features GROUP BY ALL),
bytes AS (
    SELECT feature, list_transform(range(0, octet_length(encode(feature))), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i + 1, 2))::BIGINT) AS b
    FROM (SELECT DISTINCT feature FROM counts)
), buckets AS (
    SELECT feature, xor(list_reduce(list_concat([4294967295::BIGINT], b),
        lambda a, x: xor(a >> 8, crcs[1 + (xor(a, x) & 255)])), 4294967295::BIGINT) % 10000 AS bucket
    FROM bytes, crc
), placed AS (SELECT of, row, bucket, sum(n) AS n FROM counts JOIN buckets USING (feature) GROUP BY ALL),
totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (of = 'documents'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (of = 'benchmark'), 0)::DOUBLE AS t
    FROM placed GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000) / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000))))::HUGEINT AS gain
    FROM totals
), sums AS (SELECT row, sum(n) AS n_features, sum(n * gain) AS gain FROM placed JOIN gains USING (bucket) WHERE of = 'documents' GROUP BY row),
scored AS (
    SELECT row, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
           -- a floor, although // cuts towards zero
           coalesce((gain - ((gain % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
           ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM words LEFT JOIN sums USING (row) WHERE of = 'documents'
), noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
placed_docs AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, row) AS place,
           count(*) FILTER (n_words >= 20) OVER () AS eligible
    FROM noisy
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank FROM placed_docs
""",
}
