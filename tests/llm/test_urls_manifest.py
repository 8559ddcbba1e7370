"""Url verdicts and the Merkle manifest against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rookery.llm import merkle, url_rules

PAGES = "page_id long, url string, html string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    """Host and path by the letter of the definition."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return rest[:end].translate(LOWER), tail[:stop]


def judged(url, rules, default):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), verdict, h + p)
        for verdict, h, p in ((v, (h or "").translate(LOWER), p or "") for v, h, p in rules if v)
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    _, _, verdict, rule = max(fits)
    return host, path, rule, verdict


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(3)
    labels = ["a", "b", "Ab", "é", "a-b", "", "net"]
    out = [None, "", "no scheme", "://", "http://", "http://a", "http://a?x/y", "http://a#/b", "HTTP://A.NET", "x://a/b://c.d/e", "http://a/\n/b?c"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
        path = "".join(rng.choice(["/", "x", "é", "/x", "/xy"]) for _ in range(rng.randint(0, 5)))
        out.append(f"http://{host}{path}{rng.choice(['', '?q', '#f', '?/x'])}")
    return out + ["http://a.b/x"] * 300 + ["http://a.b/" + "x" * 100_000]


def some_rules(urls, seed):
    rng = random.Random(seed)
    rules = [("block", "net", "/"), ("allow", "a.net", "/x"), (None, "b", "/"), ("block", None, None)]
    for url in rng.sample(urls[11:400], 60):
        host, path = parts(url)
        rules.append((rng.choice(["allow", "block"]), host[rng.randint(0, len(host)) :], path[: rng.randint(0, len(path))]))
    return rules + rules[5:9] + [("block" if v == "allow" else "allow", h, p) for v, h, p in rules[4:12]]


@pytest.mark.parametrize(("seed", "cell_rows", "default"), [(1, 40, "allow"), (2, 100_000, "block")])
def test_urls_are_judged_by_the_longest_rule(spark, urls, seed, cell_rows, default):
    rules = some_rules(urls, seed)
    ids = [None if i % 50 == 7 else i for i in range(len(urls))]
    pages = spark.createDataFrame([(i, u, "") for i, u in zip(ids, urls)], PAGES).repartition(3)
    # The hot url fills many stretches of 40 rows.
    got = url_rules.judge_urls(pages, spark.createDataFrame(rules, url_rules.RULES), default=default, cell_rows=cell_rows)
    want = [(i, *judged(u, rules, default)) for i, u in zip(ids, urls)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert {w[4] for w in want} == {"allow", "block"} and len({w[3] for w in want}) > 20


def test_rules_reach_the_stretches_behind_them(spark):
    """One rule above all rows: it begins in the first stretch and holds in all of them."""
    rows = spark.range(3000).select(F.col("id").alias("page_id"), F.format_string("http://h%04d.net/p", "id").alias("url"))
    rules = spark.createDataFrame([("block", "net", "/"), ("allow", "h0007.net", "/p")], url_rules.RULES)
    got = url_rules.judge_urls(rows, rules, cell_rows=50).groupBy("rule", "verdict").count().collect()
    assert sorted(map(tuple, got)) == [("h0007.net/p", "allow", 1), ("net/", "block", 2999)]


def test_url_filter_keeps_rows_and_columns(spark):
    names = "page_id long, url string, id string, key string, cell string, verdict string, row string, k1 string"
    rows = [(1, "http://a.net/", *"abcdef"), (2, "http://b.org/", *"abcdef"), (2, "http://b.org/", *"abcdef"), (None, None, *"abcdef")]
    pages = spark.createDataFrame(rows, names)
    rules = spark.createDataFrame([("block", "net", "/")], url_rules.RULES)
    kept = url_rules.without_blocked(pages, rules)
    assert kept.schema == pages.schema
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, rows[1:]))
    assert url_rules.without_blocked(pages, rules.limit(0), default="block").count() == 0
    assert url_rules.judge_urls(pages, rules).count() == 4


def test_no_urls_and_no_rules(spark):
    none = spark.createDataFrame([], PAGES)
    rules = spark.createDataFrame([("block", "net", "/")], url_rules.RULES)
    assert url_rules.judge_urls(none, rules).count() == 0
    page = spark.createDataFrame([(1, "http://a.net/b?c", "")], PAGES)
    assert tuple(url_rules.judge_urls(page, rules.limit(0)).first()) == (1, "a.net", "/b", None, "allow")


# --- manifest ---------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if c is None else f"{len(str(c).encode())}:{c}" for c in (row[n] for n in COLUMNS)))


def tree(digests):
    """Levels of digests from the leaves to the root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append(level[i ^ 1] if i ^ 1 < len(level) else "")
        i //= 2
    return out


def fold(digest, i, levels):
    for level in levels[:-1]:
        pair = [digest, level[i ^ 1]] if i ^ 1 < len(level) else [digest]
        digest = sha("".join(reversed(pair) if i % 2 else pair))
        i //= 2
    return digest


def expected(rows, claim):
    groups = sorted({r["lang"] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in groups:
        own = sorted((r for r in rows if r["lang"] == g), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = own, tree([leaf(r) for r in own])
    top = tree([trees[g][1][-1][0] for g in groups])
    out = []
    for place, g in enumerate(groups):
        own, levels = trees[g]
        for i, r in enumerate(own):
            proof = siblings(levels, i) + siblings(top, place)
            root = fold(fold(claim(r), i, levels), place, top)
            out.append((r["doc_id"], leaf(r), levels[-1][0], top[-1][0], sha("".join(proof)), root))
    return out


def manifest_rows(df, **settings):
    rows = merkle.manifest(df, COLUMNS, **settings).select(
        "id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")), merkle.folded(F.col("claim"), F.col("witness"))
    )
    return sorted(map(repr, map(tuple, rows.collect())))


@pytest.fixture(scope="module")
def papers():
    rng = random.Random(9)
    rows = [
        (i, "é" * rng.randint(0, 5) or None, rng.choice(["en", "en", "en", "de", "é", ""]), rng.choice(["s", None]), rng.choice([3, None]))
        for i in range(150)
    ]
    rows += [(500, "alone", "fr", "s", 5), (None, None, None, None, None), (None, "x", None, "-", 1), (7, "x" * 200_000, "en", "", 2)]
    return rows + [rows[0]] * 60 + [rows[3], rows[-1]]


@pytest.mark.parametrize(("bits", "cell_rows"), [(12, 100_000), (2, 20), (3, 1000)])
def test_manifest(spark, papers, bits, cell_rows):
    """Blocks of 4 and 8 leaves need several rounds of block roots; stretches of 20 cut the groups."""
    names = [f.split()[0] for f in DOCS.split(", ")]
    rows = [dict(zip(names, r)) for r in papers]
    claim = lambda r: sha("?") if r["doc_id"] == 5 else leaf(r)
    want = expected(rows, claim)

    def claims(cells):
        own = merkle.cells_digest([cells[c] for c in COLUMNS])
        return F.when(cells["doc_id"] == 5, F.sha2(F.lit("?"), 256)).otherwise(own)

    df = spark.createDataFrame(papers, DOCS).repartition(5)
    assert manifest_rows(df, claims=claims, bits=bits, cell_rows=cell_rows) == sorted(map(repr, want))
    assert {w[0] for w in want if w[5] != w[3]} == {5}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_frontier(n):
    digests = [sha(str(i)) for i in range(n)]
    levels = tree(digests)
    frontier = merkle.Frontier()
    for digest in digests:
        frontier.append(digest)
    assert frontier.close(merkle.levels_of(n, 12)) == levels[-1][0]
    for i, witness in enumerate(frontier.witness):
        assert [part[1:] for part in witness] == siblings(levels, i)


def test_manifest_of_one_row_none_and_clashing_names(spark):
    one = [(1, "t", "en", "s", 1)]
    row = dict(zip([f.split()[0] for f in DOCS.split(", ")], one[0]))
    df = spark.createDataFrame(one, DOCS)
    assert manifest_rows(df) == sorted(map(repr, expected([row], leaf)))
    assert merkle.manifest(df.limit(0), COLUMNS).count() == 0
    names = ", ".join(f"{c} string" for c in ("g", "rank", "digest", "leaf", "claim", "o", "salt", "root"))
    wide = spark.createDataFrame([(*one[0], *"abcdefgh")], f"{DOCS}, {names}")
    assert manifest_rows(wide) == manifest_rows(df)
    twice = df.select("*", F.lit(9).alias("doc_id"), F.lit("other").alias("text"))
    assert manifest_rows(twice) == manifest_rows(df)
