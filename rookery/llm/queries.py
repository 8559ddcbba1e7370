"""Registered queries of the operators, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm import (
    byte_cnn,
    hard_negatives,
    merkle,
    mixing,
    packing,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    topk,
    unit_dedup,
    url_rules,
    warc_zip,
)
from rookery.llm.ship import ship
from rookery.plans.registry import query

TOKENIZER = "word_bpe_49k.json"
# Production settings of the mixture: all but even sources, none read more than four times.
MIX_ENTROPY, MIX_REPEATS = 0.9999, 4.0


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules")
def _(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.quality_verdicts(docs, model).withColumnRenamed("id", "doc_id")


@query("op2_quality_classifier")
def _(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = byte_cnn.fit_quality(docs, _table(spark, sf_dir, "labels"))
    return byte_cnn.quality_scores(docs, model).withColumnRenamed("id", "doc_id")


@query("op3_best_fit_packing")
def _(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


@query("op4_suffix_array_dedup")
def _(spark, sf_dir):
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


_MIX_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents
), totals AS (
  SELECT source, sum(tokens)::BIGINT AS total FROM docs GROUP BY source
), live AS (
  SELECT source, total, total / (SELECT sum(total) FROM totals)::DOUBLE AS share FROM totals WHERE total > 0
), seek(step, lo, hi, lo2, hi2) AS (
  SELECT 0, 0, 1048577, 0, 1048576
  UNION ALL
  SELECT step + 1,
    CASE WHEN (SELECT ln(sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE)))
      - sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE) * (((lo + hi) // 2) / 1048576.0::DOUBLE) * ln(share))
        / sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE)) >= {MIX_ENTROPY} * ln(count(*)) FROM live)
      THEN (lo + hi) // 2 ELSE lo END,
    CASE WHEN (SELECT ln(sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE)))
      - sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE) * (((lo + hi) // 2) / 1048576.0::DOUBLE) * ln(share))
        / sum(share ** (((lo + hi) // 2) / 1048576.0::DOUBLE)) >= {MIX_ENTROPY} * ln(count(*)) FROM live)
      THEN hi ELSE (lo + hi) // 2 END,
    CASE WHEN (SELECT max(share ** (((lo2 + hi2) // 2) / 1048576.0::DOUBLE) / total)
        / sum(share ** (((lo2 + hi2) // 2) / 1048576.0::DOUBLE)) * sum(total) <= {MIX_REPEATS} FROM live)
      THEN lo2 ELSE least((lo2 + hi2) // 2 + 1, hi2) END,
    CASE WHEN (SELECT max(share ** (((lo2 + hi2) // 2) / 1048576.0::DOUBLE) / total)
        / sum(share ** (((lo2 + hi2) // 2) / 1048576.0::DOUBLE)) * sum(total) <= {MIX_REPEATS} FROM live)
      THEN (lo2 + hi2) // 2 ELSE hi2 END
  FROM seek WHERE step < 24
), chosen AS (
  SELECT greatest(lo, hi2) / 1048576.0::DOUBLE AS a FROM seek WHERE step = 24
), deal AS (
  SELECT source, total,
    CASE WHEN a = 1 THEN total
      ELSE floor(share ** a / (SELECT sum(share ** a) FROM live, chosen) * (SELECT sum(total) FROM totals)::DOUBLE)::BIGINT
    END AS tokens
  FROM live, chosen
), plan AS (
  SELECT t.source, t.total, coalesce(d.tokens // d.total, 1) AS full_blocks, coalesce(d.tokens % d.total, 0) AS rest
  FROM totals t LEFT JOIN deal d ON t.source IS NOT DISTINCT FROM d.source
), partial AS (
  SELECT doc_id, source, tokens, full_blocks, rest, md5('mix-' || full_blocks || '-' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM docs JOIN plan USING (source)
), opened AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM partial
)
SELECT doc_id, source, tokens, full_blocks AS block, place AS "order" FROM opened WHERE rest > 0 AND upto <= rest
UNION ALL
SELECT doc_id, source, tokens, b AS block, md5('mix-' || b || '-' || coalesce(doc_id::VARCHAR, '')) AS "order"
FROM (SELECT doc_id, source, tokens, unnest(range(full_blocks)) AS b FROM docs JOIN plan USING (source))"""


@query("op5_source_mixing", _MIX_SQL)
def _(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, entropy=MIX_ENTROPY, repeats=MIX_REPEATS).withColumnRenamed("id", "doc_id")


@query("op6_warc")
def _(spark, sf_dir):
    return warc_zip.archive_round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op7_substring_dedup")
def _(spark, sf_dir):
    return unit_dedup.repeated_units(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op8_simhash_near_dedup")
def _(spark, sf_dir):
    return simhash.near_groups(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_sharding")
def _(spark, sf_dir):
    return sharding.balanced_shards(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op10_exact_top_k",
    """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
)
def _(spark, sf_dir):
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


# Verdict, host and path of each rule.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
_RULES_SQL = ", ".join(str(rule) for rule in URL_RULES)


@query(
    "op11_url_filters",
    f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, h, p) AS (VALUES {_RULES_SQL})
SELECT page_id, host, path, max_by(h || p, length(h || p) * 1000 + length(h)) AS rule,
  coalesce(max_by(verdict, length(h || p) * 1000 + length(h)), 'allow') AS verdict
FROM (SELECT *, row_number() OVER () AS n FROM parts)
LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY n, page_id, host, path""",
)
def _(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, url_rules.RULES)
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


_LEAF = " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n}", "text")
)
_BITWISE = """list_reduce(list_concat([4294967295], list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda i: ascii(substr(doc_id::VARCHAR, i, 1)))), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""


@query(
    "op12_merkle_manifest",
    f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf, claim FROM (
    SELECT doc_id, lang, sha256({_LEAF.format(n="n_chars")}) AS leaf, sha256({_LEAF.format(n="tampered")}) AS claim
    FROM (SELECT *, CASE WHEN xor({_BITWISE}, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS tampered FROM documents))
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, i) AS n FROM leaves
), lower(level, lang, i, h) AS (
  SELECT 0, lang, i, leaf FROM leaves
  UNION ALL
  SELECT min(level) + 1, lang, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM lower) WHERE n > 1 GROUP BY lang, i // 2
), tops AS (
  SELECT lang, max(level) AS height FROM lower GROUP BY lang
), subroots AS (
  SELECT lang, height, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
  FROM (SELECT l.lang, l.h, t.height FROM lower l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang AND l.level = t.height)
), upper(level, i, h) AS (
  SELECT 0, place, subroot FROM subroots
  UNION ALL
  SELECT min(level) + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY i // 2
), summit AS (
  SELECT h AS root, level AS rise FROM upper ORDER BY level DESC LIMIT 1
), nodes AS (
  SELECT level, lang, true AS below, i, h FROM lower UNION ALL SELECT level, NULL, false, i, h FROM upper
), climb(n, lang, level, below, i, height, place, done, proof) AS (
  SELECT l.n, l.lang, 0, true, l.i, s.height, s.place, l.claim, ''
  FROM numbered l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT n, lang, CASE WHEN turn THEN 0 ELSE level + 1 END, below AND NOT turn,
    CASE WHEN turn THEN place ELSE i // 2 END, CASE WHEN turn THEN (SELECT rise FROM summit) ELSE height END, place,
    CASE WHEN turn THEN done WHEN i % 2 = 1 THEN sha256(sibling || done) ELSE sha256(done || sibling) END,
    CASE WHEN turn THEN proof ELSE proof || sibling END
  FROM (
    SELECT c.*, c.level = c.height AS turn, coalesce(s.h, '') AS sibling
    FROM climb c LEFT JOIN nodes s ON s.below = c.below AND s.level = c.level AND s.i = xor(c.i, 1)
      AND (NOT c.below OR s.lang IS NOT DISTINCT FROM c.lang)
    WHERE c.below OR c.level < c.height)
), ends AS (
  SELECT n, done, proof FROM climb WHERE NOT below AND level = height
)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(proof) AS proof_sha256, done AS folded_root, done = root AS verified
FROM numbered l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN ends USING (n), summit""",
)
def _(spark, sf_dir):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]

    def tampered(cells):
        """The leaf of a row that has gained a character, where 7 divides the CRC-32 of the id."""
        hit = F.crc32(cells["doc_id"].cast("string")) % 7 == 0
        changed = cells | {"n_chars": F.when(hit, cells["n_chars"] + 1).otherwise(cells["n_chars"])}
        return merkle.cells_digest([changed[c] for c in columns])

    rows = merkle.manifest(_table(spark, sf_dir, "documents"), columns, claims=tampered)
    folded = merkle.folded(F.col("claim"), F.col("witness"))
    rows = rows.withColumn("folded_root", folded).withColumn("proof_sha256", merkle.proof_digest(F.col("witness")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query(
    "op13_hard_negatives",
    """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
)
def _(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors)
