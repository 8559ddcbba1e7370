"""DuckDB SQL for the classifier: hashed counts, document frequencies, Naive Bayes, its metrics.

Chains of common table expressions over ``docs(id, label, text, train, fold)``. Terms are hashed by
the 32-bit murmur hash of their UTF-8 bytes, as the feature stage does.
"""

from __future__ import annotations

TOKENS = "string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s')"
# Seed, multipliers and additions of the hash; 32-bit arithmetic in 64 bits.
_SEED, _C1, _C2, _ADD, _F1, _F2 = 42, 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
_M = 1 << 32


def _times(x: str, c: int) -> str:
    return f"(({x}) * {c}::UBIGINT % {_M}::UBIGINT)"


def _turned(x: str, bits: int) -> str:
    return f"((({x}) * {1 << bits}::UBIGINT % {_M}::UBIGINT) + (({x}) // {1 << (32 - bits)}::UBIGINT))"


def _mixed_in(k: str) -> str:
    return _times(_turned(_times(k, _C1), 15), _C2)


def _step(h: str, k: str) -> str:
    return f"(({_turned(f'xor({h}, {k})', 13)} * 5::UBIGINT + {_ADD}::UBIGINT) % {_M}::UBIGINT)"


def _byte(i: str) -> str:
    return f"('0x' || substr(hx, CAST(2 * ({i}) + 1 AS BIGINT), 2))::UBIGINT"


def _word32(first: str) -> str:
    return " + ".join(f"{_byte(f'{first} + {j}')} * {1 << (8 * j)}::UBIGINT" for j in range(4))


def _tail() -> str:
    """The up to three bytes after the last whole block."""
    parts = [
        f"CASE WHEN n % 4 > {j} THEN {_byte(f'n - n % 4 + {j}')} * {1 << (8 * j)}::UBIGINT ELSE 0 END"
        for j in range(3)
    ]
    return " + ".join(parts)


def hashed_terms(stop_words: list[str]) -> str:
    """``words(id, term)``, one row per kept word of ``docs``, and their ``hashes``."""
    listed = ", ".join("'" + w.lower().replace("'", "''") + "'" for w in stop_words)
    return f"""
words AS (
  SELECT id, term FROM (SELECT id, unnest({TOKENS}) AS term FROM docs) WHERE term NOT IN ({listed})),
{hashes()}"""


def hashes() -> str:
    """``hashes(term, h)`` of the terms of ``words``, h signed."""
    return f"""
spelt AS (SELECT term, hex(term) AS hx, strlen(term) AS n FROM (SELECT DISTINCT term FROM words)),
blocks AS (
  SELECT term, n, list_transform(range(n // 4), lambda i: {_word32("4 * i")}) AS ks,
         ({_tail()})::UBIGINT AS rest
  FROM spelt),
folded AS (
  SELECT term, n, xor(list_reduce(
           list_prepend({_SEED}::UBIGINT, list_transform(ks, lambda k: {_mixed_in("k")})),
           lambda h, k: {_step("h", "k")}), {_mixed_in("rest")}) AS h
  FROM blocks),
last1 AS (SELECT term, xor(h, n::UBIGINT) AS h FROM folded),
last2 AS (SELECT term, {_times(f"xor(h, h // {1 << 16}::UBIGINT)", _F1)} AS h FROM last1),
last3 AS (SELECT term, {_times(f"xor(h, h // {1 << 13}::UBIGINT)", _F2)} AS h FROM last2),
last4 AS (SELECT term, xor(h, h // {1 << 16}::UBIGINT)::BIGINT AS h FROM last3),
hashes AS (SELECT term, CASE WHEN h >= {_M // 2} THEN h - {_M} ELSE h END AS h FROM last4)"""


def naive_bayes(fits: str) -> str:
    """``guesses(fit, id, label, prediction, probability)`` for the rows that a fit is tested on.

    ``fits`` is a query for ``(fit, features, min_df)`` and ``uses`` has to hold ``(fit, id, train)``.
    """
    return f"""
fits AS ({fits}),
used AS (SELECT u.fit, u.id, u.train, f.features, f.min_df FROM uses u JOIN fits f USING (fit)),
tf AS (
  SELECT u.fit, u.id, u.train, u.min_df, ((h % u.features) + u.features) % u.features AS bucket,
         count(*)::DOUBLE AS n
  FROM used u JOIN words w ON w.id = u.id JOIN hashes USING (term) GROUP BY ALL),
trained AS (
  SELECT fit, count(*) AS m, count(DISTINCT label) AS classes FROM used JOIN docs USING (id)
  WHERE used.train GROUP BY fit),
df AS (SELECT fit, bucket, count(*) AS df FROM tf WHERE train GROUP BY fit, bucket),
x AS (
  SELECT tf.fit, tf.id, tf.train, tf.bucket,
         CASE WHEN coalesce(df, 0) < min_df THEN 0 ELSE n * ln((m + 1.0) / (coalesce(df, 0) + 1.0)) END AS v
  FROM tf JOIN trained USING (fit) LEFT JOIN df ON df.fit = tf.fit AND df.bucket = tf.bucket),
prior AS (
  SELECT used.fit, label, ln(count(*) + 1.0) - ln(any_value(m) + any_value(classes) * 1.0) AS pi
  FROM used JOIN docs USING (id) JOIN trained ON trained.fit = used.fit WHERE used.train GROUP BY used.fit, label),
mass AS (
  SELECT fit, label, bucket, sum(v) AS s FROM x JOIN docs USING (id) WHERE x.train GROUP BY fit, label, bucket),
whole AS (SELECT fit, label, sum(s) AS s FROM mass GROUP BY fit, label),
shares AS (
  SELECT p.fit, p.label, pi, ln(coalesce(s, 0) + features) AS total
  FROM prior p JOIN fits USING (fit) LEFT JOIN whole w ON w.fit = p.fit AND w.label = p.label),
likely AS (
  SELECT u.fit, u.id, c.label AS class,
         any_value(pi) + coalesce(sum(v * (ln(coalesce(s, 0) + 1.0) - total)), 0) AS raw
  FROM used u JOIN shares c ON c.fit = u.fit
  LEFT JOIN x ON x.fit = u.fit AND x.id = u.id
  LEFT JOIN mass ON mass.fit = u.fit AND mass.label = c.label AND mass.bucket = x.bucket
  WHERE NOT u.train GROUP BY u.fit, u.id, c.label),
best AS (SELECT fit, id, max(raw) AS top FROM likely GROUP BY fit, id),
guesses AS (
  SELECT b.fit, b.id, d.label, min(l.class) FILTER (WHERE raw = top) AS prediction,
         1 / sum(exp(raw - top)) AS probability
  FROM likely l JOIN best b ON b.fit = l.fit AND b.id = l.id JOIN docs d ON d.id = b.id
  GROUP BY b.fit, b.id, d.label)"""


# ``rated(fit, n, accuracy, weighted_precision, weighted_recall, f1)`` from ``guesses``.
METRICS = """
cells AS (SELECT fit, label, prediction, count(*) AS n FROM guesses GROUP BY ALL),
classes AS (
  SELECT fit, class, sum(actual) AS actual, sum(guessed) AS guessed, sum(hit) AS hit FROM (
    SELECT fit, label AS class, n AS actual, 0 AS guessed, CASE WHEN label = prediction THEN n ELSE 0 END AS hit
    FROM cells
    UNION ALL SELECT fit, prediction, 0, n, 0 FROM cells) GROUP BY fit, class),
rated AS (
  SELECT fit, sum(actual)::BIGINT AS n, (sum(hit) / sum(actual))::DOUBLE AS accuracy,
         sum(CASE WHEN guessed > 0 THEN actual * hit / guessed ELSE 0 END) / sum(actual) AS weighted_precision,
         (sum(hit) / sum(actual))::DOUBLE AS weighted_recall,
         sum(2.0::DOUBLE * hit / (actual + guessed) * actual) / sum(actual) AS f1
  FROM classes GROUP BY fit)"""


def weighted_terms(features: int) -> str:
    """``x(id, train, bucket, v)``: weighted hashed counts in standard deviations of the training rows."""
    return f"""
tf AS (
  SELECT d.id, d.train, ((h % {features}) + {features}) % {features} AS bucket, count(*)::DOUBLE AS n
  FROM docs d JOIN words w ON w.id = d.id JOIN hashes USING (term) GROUP BY ALL),
rows AS (SELECT count(*)::DOUBLE AS m FROM docs WHERE train),
df AS (
  SELECT bucket, ln((any_value(m) + 1.0) / (count(*) + 1.0)) AS idf,
         sqrt((sum(n * n) - sum(n) * sum(n) / any_value(m)) / (any_value(m) - 1)) AS spread
  FROM tf, rows WHERE train GROUP BY bucket),
x AS (SELECT id, train, bucket, n / spread AS v FROM tf JOIN df USING (bucket) WHERE idf > 0 AND spread > 0)"""


def logistic(penalty: float, steps: int) -> str:
    """``guesses(id, label, prediction, score, probability)`` for the test rows; needs ``RECURSIVE``.

    The weights are a sum of training rows times ``a``, so all that is asked for is the products of
    rows. Accelerated gradient steps on ``a`` and on the intercept lead to the one least value of mean
    log-loss and ``penalty / 2`` times the squared weights (of the scaled features). The intercept is that of a constant feature
    as long as the rows.
    """
    return f"""
train AS (SELECT id, label, row_number() OVER (ORDER BY id) AS r FROM docs WHERE train),
products AS (
  SELECT p.id, t.r, coalesce(sum(a.v * b.v), 0) AS k
  FROM docs p CROSS JOIN train t
  LEFT JOIN x a ON a.id = p.id LEFT JOIN x b ON b.id = t.id AND b.bucket = a.bucket GROUP BY p.id, t.r),
lines AS (SELECT id, list(k ORDER BY r) AS k FROM products GROUP BY id),
fixed AS (
  SELECT count(*)::DOUBLE AS n, list(l.k ORDER BY r) AS ks, list(t.label ORDER BY r) AS ys, avg(l.k[r]) AS s2,
         max(list_sum(l.k)) / (4 * count(*)) + avg(l.k[r]) / 4 + {penalty} AS steep
  FROM train t JOIN lines l USING (id)),
path(i, a, before, b, b_before) AS (
  SELECT 0, list_transform(ys, lambda y: 0.0::DOUBLE), list_transform(ys, lambda y: 0.0::DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE
  FROM fixed
  UNION ALL
  SELECT i + 1,
    list_transform(ys, lambda y, j: g[j] - ((p[j] - y) / n + {penalty} * g[j]) / steep), a,
    g0 - sqrt(s2) * list_sum(list_transform(ys, lambda y, j: p[j] - y)) / n / steep, b
  FROM (
    SELECT q.*, fixed.*, list_transform(ks, lambda k: 1 / (1 + exp(-list_inner_product(k, g) - sqrt(s2) * g0))) AS p
    FROM (
      SELECT i, a, b, list_transform(a, lambda v, j: v + m * (v - before[j])) AS g, b + m * (b - b_before) AS g0
      FROM (SELECT path.*, (sqrt(steep) - sqrt({penalty})) / (sqrt(steep) + sqrt({penalty})) AS m FROM path, fixed)
    ) q, fixed)
  WHERE i < {steps}),
scored AS (
  SELECT l.id, list_inner_product(l.k, a) + sqrt(s2) * b AS score
  FROM lines l, fixed, (SELECT a, b FROM path ORDER BY i DESC LIMIT 1)),
guesses AS (
  SELECT id, label, CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, score, 1 / (1 + exp(-score)) AS probability
  FROM docs JOIN scored USING (id) WHERE NOT train)"""


def text_clusters(features: int, k: int, iterations: int, seed: int) -> str:
    """``placed(id, cluster)`` of the rows ``asked`` by k-means over the counts of the words of ``ids``.

    Starts are drawn by hashes of ids. Other ids of ``words`` are only placed.
    """
    parts = [f"""
f AS MATERIALIZED (
  SELECT id, ((h % {features}) + {features}) % {features} AS bucket, count(*)::DOUBLE AS n
  FROM words JOIN hashes USING (term) GROUP BY ALL),
texts AS MATERIALIZED (
  SELECT i.id, coalesce(sum(n * n), 0) AS square FROM ids i LEFT JOIN f USING (id) GROUP BY i.id),
near0 AS (SELECT id, 1.0::DOUBLE AS gap FROM texts)"""]
    for j in range(k):
        uniform = f"(('0x' || substr(md5(id || '-{seed}-{j}'), 1, 13))::BIGINT + 0.5) / {1 << 52}::DOUBLE"
        before = "1e308" if j == 0 else "p.gap"
        parts.append(f"""
pick{j} AS MATERIALIZED (SELECT id FROM near{j} WHERE gap > 0 ORDER BY -ln({uniform}) / gap, id LIMIT 1),
near{j + 1} AS MATERIALIZED (
  SELECT p.id, least({before}, t.square + (SELECT square FROM texts JOIN pick{j} USING (id)) - 2 * coalesce(dot, 0)) AS gap
  FROM near{j} p JOIN texts t USING (id) LEFT JOIN (
    SELECT f.id, sum(f.n * c.n) AS dot FROM f JOIN (SELECT bucket, n FROM f JOIN pick{j} USING (id)) c USING (bucket)
    GROUP BY f.id) USING (id))""")
    starts = " UNION ALL ".join(f"SELECT {j} AS cluster, bucket, n AS c FROM f JOIN pick{j} USING (id)" for j in range(k))
    parts.append(f"\ncentres0 AS MATERIALIZED ({starts})")
    for i in range(iterations + 1):
        parts.append(f"""
placed{i} AS MATERIALIZED (
  SELECT id, arg_min(cluster, struct_pack(d := square - 2 * coalesce(dot, 0), j := cluster)) AS cluster
  FROM (SELECT t.id, j.cluster, coalesce(s.square, 0) AS square FROM {"ids" if i < iterations else "asked"} t CROSS JOIN (SELECT unnest(range({k})) AS cluster) j
        LEFT JOIN (SELECT cluster, sum(c * c) AS square FROM centres{i} GROUP BY cluster) s USING (cluster))
  LEFT JOIN (SELECT f.id, cluster, sum(n * c) AS dot FROM f JOIN centres{i} USING (bucket) GROUP BY f.id, cluster)
    USING (id, cluster) GROUP BY id)""")
        if i < iterations:
            parts.append(f"""
centres{i + 1} AS MATERIALIZED (
  SELECT cluster, bucket, sum(n) / any_value(size) AS c
  FROM placed{i} JOIN (SELECT cluster, count(*) AS size FROM placed{i} GROUP BY cluster) USING (cluster) JOIN f USING (id)
  GROUP BY cluster, bucket
  UNION ALL SELECT * FROM centres{i} WHERE cluster NOT IN (SELECT cluster FROM placed{i}))""")
    return ",".join(parts) + f",\nplaced AS (SELECT id, cluster::INTEGER AS cluster FROM placed{iterations})"
