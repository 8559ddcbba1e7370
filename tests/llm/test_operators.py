"""Each operator against brute force on small tables that hold the awkward cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import itertools
import math
import random
import re
import zipfile
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rookery.llm import (
    byte_cnn,
    mixing,
    packing,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    topk,
    unit_dedup,
    warc_zip,
    zip_archive,
)
from rookery.llm.components import components
from rookery.llm.labelled import labelled_sample
from rookery.llm.queries import tokenizer_path
from rookery.llm.word_ids import WordIds
from rookery.llm.zip_archive import ZipRanges

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, nulls, empty and one-letter texts, ties, repeated rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 260)) for _ in range(25)]
    passage = ". ".join(prose(rng, 9) for _ in range(12)) + "."
    texts = [*base, base[0], base[0], base[1] + " tail", "head " + base[2], base[3].replace("a", "b", 2)]
    texts += [f"{prose(rng, 40)}\n{passage}\n{prose(rng, 30)}" for _ in range(4)]
    texts += [f"{prose(rng, 11)} {passage} {prose(rng, 13)}" for _ in range(3)]
    texts += [None, "", "   ", "\n\n", "a" * 3000, "ab" * 900, "x\n" * 500, "of the " * 300, "'s §~ <|endoftext|>", "\U0001F600 ok", prose(rng, 6000)]
    rows = [(i, t, None if i % 7 == 3 else "en", None if i % 11 == 5 else f"s{min(i % 9, 4)}", None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base[4], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def raw(row):
    return (row["text"] or "").encode()


def pairs(rows):
    return sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"] or "") for r in rows)


def removed_windows(texts, length):
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        out.append(np.cumsum(cover)[:-1] > 0)
    return out


@pytest.mark.parametrize("length", [400, 100, 64])
def test_suffix_dedup_is_exact(docs, length):
    rows = docs.collect()
    cover = removed_windows([raw(r) for r in rows], length)
    want = sorted(
        (-1 if r.doc_id is None else r.doc_id, bytes(np.frombuffer(raw(r), np.uint8)[~c]), int(c.sum()),
         int((np.diff(np.concatenate(([0], c.astype(int)))) == 1).sum()))
        for r, c in zip(rows, cover)
    )
    got = suffix_dedup.remove_repeats(docs, length).collect()
    assert want == sorted((-1 if r.id is None else r.id, bytes(r.kept), r.n_removed, r.n_spans) for r in got)
    assert any(w[2] for w in want)


def test_suffix_dedup_of_a_text_of_several_pieces(spark):
    """Nine million bytes are read in two pieces; a passage lies across their border and at the start."""
    rng = np.random.default_rng(3)
    raw_ = rng.integers(97, 123, 9_000_000).astype(np.uint8)
    border = 8 << 20
    raw_[border - 500 : border + 500] = raw_[100:1100]
    raw_[[99, 1100, border - 501, border + 500]] = [65, 66, 67, 68]
    long = raw_.tobytes().decode()
    df = spark.createDataFrame([(1, long), (2, "x" + long[border + 600 : border + 1100] + "y"), (3, "z")], "doc_id long, text string")
    got = {r.id: [(s.a, s.b) for s in r.spans or []] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {1: [(100, 1100), (border - 500, border + 500), (border + 600, border + 1100)], 2: [(1, 501)], 3: []}


def test_suffix_dedup_writes_one_table_a_pass(docs, monkeypatch):
    """Each written file costs the executor a process, so no sums and no classes are written beside the rows."""
    labels, write = [], suffix_dedup.materialise
    monkeypatch.setattr(suffix_dedup, "materialise", lambda df, label: labels.append(label) or write(df, label))
    assert any(r.n_removed for r in suffix_dedup.remove_repeats(docs, 64).collect())
    assert collections.Counter(labels) == {"suffixes": 11, "settled": 2, "texts": 1}


def test_rows_of_a_hot_key_meet_its_sums_in_many_tasks(spark, tmp_path):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "50",
    }
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    spark.range(200_000, numPartitions=16).select(hot.alias("d0"), F.xxhash64("id").alias("k1")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    sums = rows.groupBy("d0").agg(F.count(F.lit(1)).alias("n"))
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = rows.join(suffix_dedup._dealt_anew(sums, ["d0"]), "d0")
        got = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 200_000 and max(r.n for r in got) > 60_000
    assert "skew=true" in plan.split("Initial Plan")[0]


def plain_lines(text):
    """Begin and end of each line; blanks at its start are not part of it, but for the first one."""
    out, place = [], 0
    for i, line in enumerate(text.split(b"\n")):
        blank = len(line) - len(line.lstrip()) if i else 0
        out.append((place + blank, place + len(line)))
        place += len(line) + 1
    return out


def plain_pieces(text, unit):
    """Begin and end of lines, of stretches of lines between empty ones, or of sentences of a line."""
    lines, out = plain_lines(text), []
    if unit == "line":
        out = lines
    elif unit == "paragraph":
        open_at = None
        for a, b in lines:
            if a >= b:
                open_at = None
            elif open_at is None:
                open_at = len(out)
                out.append((a, b))
            else:
                out[-1] = out[-1][0], b
    else:
        for n, (a, b) in enumerate(lines):
            begin = a
            for i in range(a, b):
                if i > begin and text[i : i + 1] in (b" ", b"\t") and text[i - 1 : i] in (b".", b"!", b"?"):
                    out.append((begin, i))
                    begin = i
                    while begin < b and text[begin : begin + 1] in (b" ", b"\t"):
                        begin += 1
            if begin < b:
                end = b if n + 1 == len(lines) else begin + len(text[begin:b].rstrip())
                out.append((begin, end))
    return [(a, b) for a, b in out if text[a:b].split()]


def brute_units(rows, unit, min_words):
    """Spans of later occurrences, by a walk over all texts in the order of ids."""
    first, found = {}, []
    for r in rows:
        text = raw(r)
        pieces = plain_pieces(text, unit)
        counts = [len(text[a:b].split()) for a, b in pieces]
        for i, j in plain_windows(counts, min_words):
            a, b = pieces[i][0], pieces[j][1]
            words = tuple(w for x, y in pieces[i : j + 1] for w in text[x:y].lower().split())
            place = (r.doc_id is None, r.doc_id or 0, a)
            found.append((words, place, r, a, b))
            first[words] = min(first.get(words, place), place)
    spans = collections.defaultdict(set)
    for words, place, r, a, b in found:
        if place != first[words]:
            spans[(r.doc_id, r.text)].add((a, b))
    return spans


@pytest.mark.parametrize(("unit", "min_words"), [("sentence", 8), ("line", 8), ("paragraph", 8), ("line", 1), ("sentence", 1)])
def test_units_keep_the_earliest(docs, unit, min_words):
    rows = docs.filter("doc_id is not null").collect()
    spans = brute_units(rows, unit, min_words)
    want = []
    for r in rows:
        gone = np.zeros(len(raw(r)), bool)
        for a, b in spans[(r.doc_id, r.text)]:
            gone[a:b] = True
        want.append((r.doc_id, bytes(np.frombuffer(raw(r), np.uint8)[~gone]), int(gone.sum())))
    got = unit_dedup.repeated_units(docs.filter("doc_id is not null"), unit, min_words).collect()
    assert sorted(want) == sorted((r.id, bytes(r.kept), r.n_removed) for r in got)
    assert any(w[2] for w in want)


def test_every_line_by_itself_also_short_ones(spark):
    rows = [(1, "Terms apply.\nfirst own line\n\nok"), (2, "second own line\n terms  APPLY.\nOK"), (None, "ok\nterms apply.")]
    got = unit_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), "line", 1).collect()
    assert {r.id: bytes(r.kept).decode().split() for r in got} == {
        1: "Terms apply. first own line ok".split(), 2: "second own line".split(), None: []
    }


def test_unit_stage_keeps_rows_and_columns(docs):
    out = unit_dedup.without_repeated_units(docs)
    assert out.schema == docs.schema
    assert out.count() == docs.count()
    passage = docs.filter("doc_id = 30").first().text.split("\n")[1]
    # The earliest document keeps the passage, the others lose nearly all of it.
    kept = {r.doc_id: r.text for r in out.filter("doc_id between 30 and 36").collect()}
    assert passage in kept[30]
    assert all(len(kept[i]) < len(passage) for i in range(31, 34))


def test_short_units_by_chance_stay(spark):
    docs = spark.createDataFrame([(1, "Yes. One two three."), (2, "Yes. Four five six.")], "doc_id long, text string")
    assert all(r.n_removed == 0 for r in unit_dedup.repeated_units(docs).collect())


def plain_windows(counts, min_words):
    """First and last line of every unit, from the word counts of lines alone."""
    n, out = len(counts), set()
    for i in range(n):
        enough = [j for j in range(i, n) if sum(counts[i : j + 1]) >= min_words]
        back = [j for j in range(n) if sum(counts[j:]) >= min_words]
        out.add((i, enough[0]) if enough else (max(back, default=0), n - 1))
    return out


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_short_tails_and_short_texts_go_with_their_copies(spark, unit):
    rng = random.Random(4)
    lines = [" ".join(rng.choice("abc") + str(k) for _ in range(rng.choice([1, 2, 3, 5, 9, 12]))) for k in range(14)]
    texts = [[rng.choice(lines) for _ in range(rng.randint(1, 5))] for _ in range(120)]
    texts += [["so few words"], ["so few words"], [lines[0] * 9, "a tail"], [lines[0] * 9, "a tail"], [lines[0] * 9, "another"]]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    got = {r.id: bytes(r.kept).decode() for r in unit_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string"), unit).collect()}
    seen, want = set(), {}
    for n, t in enumerate(texts):
        gone = set()
        for i, j in sorted(plain_windows([len(x.split()) for x in t], 8)):
            key = " ".join(t[i : j + 1])
            gone |= set(range(i, j + 1)) if key in seen else set()
            seen.add(key)
        want[n] = [x for k, x in enumerate(t) if k not in gone]
    assert {n: [x for x in kept.split("\n") if x] for n, kept in got.items()} == want
    assert all(not want[n] for n, t in enumerate(texts) if t in texts[:n])


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, bits=3):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("bucket", [1024, 1])
def test_simhash_groups(docs, bucket):
    got = simhash.near_groups(docs, bucket=bucket).collect()
    rows = docs.collect()
    key = lambda i, f: (-1 if i is None else i, f)
    fps = [brute_fingerprint(r.text) for r in rows]
    assert sorted(key(r.id, r.fp & (2**64 - 1)) for r in got) == sorted(key(r.doc_id, f) for r, f in zip(rows, fps))
    groups = collections.defaultdict(list)
    for i, g in enumerate(brute_components(fps)):
        groups[g].append(i)
    want = {}
    for members in groups.values():
        least = min((rows[i].doc_id for i in members if rows[i].doc_id is not None), default=None)
        want |= {key(rows[i].doc_id, fps[i]): least for i in members}
    assert all(want[key(r.id, r.fp & (2**64 - 1))] == r.component_id for r in got)


@pytest.mark.parametrize("bucket", [1024, 40, 2])
def test_links_in_dense_balls(spark, bucket):
    """Hundreds of fingerprints within a few bits of each other, through both levels of buckets."""
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centre for _ in range(150)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r.node: r.component for r in components(simhash.links(df, bucket=bucket)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    roots = collections.defaultdict(set)
    for f, r in zip(signed, brute_components(fps)):
        roots[r].add(f)
    found = collections.defaultdict(set)
    for f in signed:
        found[got.get(f, f)].add(f)
    assert sorted(map(sorted, roots.values())) == sorted(map(sorted, found.values()))


def test_one_of_each_group_stays(docs):
    kept = simhash.drop_near_copies(docs)
    assert kept.schema == docs.schema
    fps = [brute_fingerprint(r.text) for r in docs.collect()]
    assert kept.count() == len(set(brute_components(fps)))
    assert kept.filter("doc_id = 0").count() == 1


def test_rows_that_differ_only_beside_id_and_text(spark):
    """Of such rows the same one stays, however they are partitioned."""
    rows = [(1, "a b c d e f", s) for s in "pqrstuvw"] * 2 + [(2, "a b c d e f", "x"), (3, None, "y"), (3, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {tuple(sorted(map(repr, simhash.drop_near_copies(df.repartition(n)).collect()))) for n in (1, 3, 7)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and got[201] == 200 and 100 not in got


def brute_base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    marked = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(marked), failed


def test_base_rules(docs):
    model = quality_rules.fit([], [])
    got = quality_rules.quality_verdicts(docs, model, keep_at=0.5).collect()
    cells = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted((-1 if r.id is None else r.id, *cells(r)) for r in got) == sorted(
        (-1 if r.doc_id is None else r.doc_id, *brute_base(r.text)) for r in docs.collect()
    )
    assert all(r.kept == (not r.base_failed) for r in got)


@pytest.fixture(scope="module")
def tables(spark):
    at = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")


def area(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_quality_rules_on_held_out_labels(tables):
    docs, labels = tables
    some = labels.filter("doc_id % 3 != 0")
    verdicts = quality_rules.quality_verdicts(docs, quality_rules.fit_quality(docs, some))
    rows = verdicts.join(labels.filter("doc_id % 3 = 0"), verdicts.id == labels.doc_id).collect()
    agree = sum(r.kept == (r.quality == 1 and not r.base_failed) for r in rows) / len(rows)
    assert agree > 0.9
    assert all(0 <= r.probability <= 1 for r in rows)


def test_byte_cnn_on_held_out_labels(tables):
    docs, labels = tables
    scored = byte_cnn.quality_scores(docs, byte_cnn.fit_quality(docs, labels))
    rows = scored.join(labels, scored.id == labels.doc_id).collect()
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert area(np.array([r.score for r in held]), np.array([r.quality for r in held])) > 0.8
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def naive_families(text):
    """Features by their meaning: words, pairs of words, runs of four characters."""
    words = WORD.findall(text)
    return [words, list(zip(words, words[1:])), [text[i : i + 4] for i in range(len(text) - 3)]]


def test_probability_is_that_of_a_plain_forward_pass(spark):
    """Every feature's own weight, looked up by a text of nothing else, then averaged and calibrated."""
    rng = random.Random(4)
    weights = np.random.default_rng(4).normal(0, 1, (3, quality_rules.BUCKETS))
    out = io.BytesIO()
    np.savez(out, weights=weights.astype(np.float32), numbers=np.array([0.2, 0.7, -0.1]))
    weights = weights.astype(np.float32).astype(float)

    def weight(family, feature):
        text = feature if family != 1 else " ".join(feature)
        for found, buckets, _ in quality_rules._features(quality_rules._slab([text.encode()])):
            if found == family:
                assert len(buckets) == 1
                return weights[family][buckets[0]]

    texts = ["", "é", "à la carte, ça va", prose(rng, 40), prose(rng, 1), "\U0001F600\U0001F600 über üb", "a  b\n\tc"]
    got = quality_rules.quality_verdicts(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), out.getvalue()
    ).collect()
    for r in got:
        z = 0.2
        for family, features in enumerate(naive_families(texts[r.id])):
            if features:
                z += 32.0 * sum(weight(family, f) for f in features) / len(features)
        assert r.probability == pytest.approx(1 / (1 + math.exp(-min(max(0.7 * z - 0.1, -40), 40))), rel=1e-6)


def test_score_is_that_of_a_plain_forward_pass():
    rng = np.random.default_rng(2)
    net = byte_cnn.fresh(2)
    net.out[:] = rng.normal(0, 0.3, len(net.out))
    net.shift[:] = rng.normal(0, 0.1, len(net.shift))

    def plain(text):
        tops = []
        for s in byte_cnn.chunk_starts(len(text)):
            chunk = list(text[s : s + byte_cnn.CHUNK])
            chunk += [256] * (byte_cnn.CHUNK - len(chunk))
            best = np.zeros(byte_cnn.FILTERS)
            for place in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STRIDE):
                seen = np.concatenate([net.embed[b] for b in chunk[place : place + byte_cnn.WIDTH]]).astype(float)
                best = np.maximum(best, seen @ net.filters + net.shift)
            tops.append(best)
        z = np.mean(tops, 0) @ net.out[: byte_cnn.FILTERS] + np.max(tops, 0) @ net.out[byte_cnn.FILTERS :] + net.bias[0]
        return 1 / (1 + math.exp(-z))

    texts = [b"", b"x", rng.integers(0, 256, 1024).astype(np.uint8).tobytes(), rng.integers(0, 256, 2500).astype(np.uint8).tobytes()]
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = byte_cnn.scores(net, np.frombuffer(b"".join(texts), np.uint8), at)
    assert got == pytest.approx([plain(t) for t in texts], rel=1e-4)


def test_scores_of_awkward_rows(spark, docs):
    names = "doc_id long, text string, score double, held_out boolean, predicted int, row string, k1 string, id string"
    rows = [(r.doc_id, r.text, 9.0, True, 5, "a", "b", "c") for r in docs.collect()]
    net = byte_cnn.fresh(2)
    net.out[:] = 0.1
    got = byte_cnn.quality_scores(spark.createDataFrame(rows, names), net.dump()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    blank = {r.score for r in got if r.id is None} & {r.score for r in got if r.id is not None}
    assert blank and not any(r.held_out for r in got if r.id is None)
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.id].add(r.score)
    assert len(by_id[0]) == 1


def test_a_hot_id_does_not_fill_the_sample(spark):
    """A labelled id that most rows carry, with copies and with other texts: the sample is bounded and fixed."""
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 100).alias("text"))
    rest = spark.range(2, 60).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), "id").alias("text"))
    docs = hot.union(rest)
    labels = spark.range(1, 60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = lambda df, n, most=1000: sorted(map(tuple, labelled_sample(df, labels, "quality", None, n, most).collect()))
    whole = sample(docs, 1000)
    assert len(whole) == 100 + 58 and len(set(whole)) == len(whole)
    some = sample(docs, 59)
    assert len(some) == 118 and some == sample(docs.repartition(7), 59)
    assert all(len(r[1]) <= 5 for r in sample(docs, 1000, 5))


def test_byte_cnn_sees_the_whole_text():
    net = byte_cnn.fresh()
    net.out[:] = 0.3
    text = b"a" * 5000
    score = lambda t: byte_cnn.scores(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
    for place in (10, 2500, 4990):
        assert score(text) != score(text[:place] + b"\xff\x01|#" + text[place + 4 :])
    for size in (0, 1, 1024, 1025, 1920, 1921, 9000):
        starts = byte_cnn.chunk_starts(size)
        cover = np.zeros(size, bool)
        for s in starts:
            cover[s : s + byte_cnn.CHUNK] = True
        assert cover.all() and (starts[1:] < size).all()


def test_byte_cnn_gradient():
    rng = np.random.default_rng(1)
    net = byte_cnn.fresh(3)
    net.out[:] = rng.normal(0, 0.3, len(net.out))
    for name in ("embed", "filters", "shift", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (300, 1500, 40)]
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        p = byte_cnn.scores(net, np.frombuffer(b"".join(texts), np.uint8), at)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    found = byte_cnn._gradients(net, texts, y)
    for name in ("filters", "shift", "out", "bias", "embed"):
        cells = getattr(net, name)
        at = np.unravel_index(int(np.argmax(np.abs(found[name]))), cells.shape)
        before = cells[at]
        cells[at] = before + 1e-5
        high = loss()
        cells[at] = before - 1e-5
        low = loss()
        cells[at] = before
        assert found[name][at] == pytest.approx((high - low) / 2e-5, rel=2e-2)


def test_models_of_no_rows_and_one_label():
    for labels in ([], [1], [1, 1, 1]):
        texts = [b"one two"] * len(labels)
        words = quality_rules._slab([b"", b"a b c"])
        assert (quality_rules.Model(quality_rules.fit(texts, labels)).probability(words) >= 0.5).all()
        net = byte_cnn.Net.load(byte_cnn.fit(texts, labels))
        assert 0 <= byte_cnn.scores(net, np.zeros(0, np.uint8), np.array([0, 0]))[0] <= 1


def test_word_ids_equal_the_tokenizer(docs):
    encoder = WordIds(tokenizer_path(), memo_words=50)
    texts = [r.text or "" for r in docs.collect()]
    texts += ["naïvé é İstanbul ΑΣ", "a<|endoftext|>b x<|startoftext|>y", "don't 'S ''s a's.'s", "１２ 3½ ²", "\x1c x\x1dy \x85z", "日本語 ﬁ ſ ª º µ ß ẞ"]
    for text in texts:
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.of([text.encode()])[0], "<u4").tolist() == want


def test_packing(docs):
    most = 256
    got = packing.pack(docs, tokenizer_path(), most=most, unit=8, with_ids=True).collect()
    encode = WordIds(tokenizer_path()).tokenizer.encode
    want = []
    for r in docs.collect():
        ids = encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), most)):
            own = np.array(ids[start : start + most], "<u4").tobytes()
            want.append((-1 if r.doc_id is None else r.doc_id, piece, start, len(own) // 4, zlib.crc32(own), own))
    assert sorted(want) == sorted(
        (-1 if r.id is None else r.id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got
    )
    check_sequences([(r.sequence_id, r.offset, r.length) for r in got], most)
    used = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-used // most) * 1.02 + 1


def check_sequences(rows, most):
    sequences = collections.defaultdict(list)
    for sequence, offset, length in rows:
        sequences[sequence].append((offset, length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= most


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_document_once(seed):
    rng = np.random.default_rng(seed)
    most = 512
    histogram = np.zeros(most + 1, np.int64)
    for length in rng.lognormal(4.3, 1, 4000).astype(int).clip(1, most):
        histogram[length] += 1
    histogram[1] += 2000 * (seed % 2)
    histogram[most // 2 + 1] += 1500 * (seed % 3)
    if seed == 5:
        histogram[:] = 0
    plan = packing.planned(histogram, unit=8)
    rows = []
    for length in range(most + 1):
        own = plan[plan[:, 0] == length]
        own = own[np.argsort(own[:, 1])]
        assert own[:, 2].sum() == histogram[length]
        assert (own[:, 1] == np.cumsum(own[:, 2]) - own[:, 2]).all()
        for _, _, count, sequence, offset in own:
            rows += [(sequence + i, offset, length) for i in range(count)]
    check_sequences(rows, most)
    halves = int(histogram[most // 2 + 1 :].sum())
    bound = max(halves, -(-int((histogram * np.arange(most + 1)).sum()) // most))
    assert len({r[0] for r in rows}) <= bound * 1.02 + 1


def test_patterns_and_their_fit():
    patterns = packing.enumerated(12, 3)
    want = [p for n in (2, 3) for p in itertools.combinations_with_replacement(range(11, 0, -1), n) if sum(p) == 12]
    assert sorted(tuple(x for x in p if x) for p in patterns.tolist()) == sorted(want)
    histogram = np.zeros(13)
    histogram[[8, 4, 6]] = [10, 10, 8]
    counts = packing.fitted_counts(patterns, histogram)
    fitted = {tuple(p): c for p, c in zip(patterns.tolist(), counts) if c > 1e-6}
    assert sum(c for p, c in fitted.items()) == pytest.approx(14, rel=0.05)
    assert counts.min() >= 0


def brute_mix(rows, entropy, repeats, seed="mix"):
    tokens = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in rows]
    total = collections.Counter()
    for _, source, n in tokens:
        total[source] += n
    whole = sum(total.values())
    live = [v for v in total.values() if v]

    def weights(step):
        powers = [(v / whole) ** (step / 2**20) for v in live]
        return [p / sum(powers) for p in powers]

    def high(step):
        return -sum(w * math.log(w) for w in weights(step)) >= entropy * math.log(len(live))

    def rare(step):
        return max(w * whole / v for w, v in zip(weights(step), live)) <= repeats

    def least(holds):
        low, top = 0, 2**20
        while low < top:
            middle = (low + top) // 2
            low, top = (low, middle) if holds(middle) else (middle + 1, top)
        return low

    step = 2**20 if high(2**20) else least(lambda s: not high(s)) - 1
    step = max(step, least(rare))
    share = {s: w for s, w in zip([s for s, v in total.items() if v], weights(step))}
    out = []
    for source, v in total.items():
        full, rest = divmod(math.floor(share[source] * whole), v) if v else (1, 0)
        order = lambda i, b: hashlib.md5(f"{seed}-{b}-{'' if i is None else i}".encode()).hexdigest()
        own = [(i, n) for i, s, n in tokens if s == source]
        out += [(i, source, n, b, order(i, b)) for b in range(full) for i, n in own]
        upto = 0
        for place, i, n in sorted((order(i, full), i, n) for i, n in own if rest):
            upto += n
            if upto > rest:
                break
            out.append((i, source, n, full, place))
    return out


@pytest.mark.parametrize(("entropy", "repeats"), [(0.9, 4.0), (0.999, 50.0), (0.5, 1.2)])
def test_mixing(docs, entropy, repeats):
    plain = docs.filter("doc_id is not null and doc_id > 0")
    got = mixing.mix(plain, entropy=entropy, repeats=repeats).collect()
    text = lambda rows: sorted(tuple(str(c) for c in r) for r in rows)
    assert text(tuple(r) for r in got) == text(brute_mix(plain.collect(), entropy, repeats))


def test_shares_as_they_are_take_every_document_once(spark):
    """In doubles one source comes out a token short, and a document would be left out."""
    short = lambda n, m: math.floor(n / (n + m) / (n / (n + m) + m / (n + m)) * (n + m)) < n
    n, m = next((n, m) for n in range(20, 200) for m in range(n, 2 * n) if short(n, m))
    rows = [(i, "a " * size, None, source, None) for i, (source, size) in enumerate([("s", n - 9), ("s", 9), ("t", m - 9), ("t", 9)])]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), entropy=0.5, repeats=None).collect()
    assert sorted((r.id, r.block) for r in got) == [(i, 0) for i in range(4)]
    totals = spark.createDataFrame([("s", n), ("t", m)], "source string, total long")
    twice = mixing.budgets(totals, 1.0, 2 * (n + m) + 1).collect()
    assert all((r.full, r.rest) == divmod(r.total * (2 * (n + m) + 1) // (n + m), r.total) for r in twice)


def test_mixing_of_repeated_rows_null_ids_and_a_very_long_text(spark):
    """Rows equal in id, and rows without one, are dealt one by one; a text longer than a budget goes whole or not."""
    rows = [(1, "a b", None, "s", None)] * 3 + [(None, "c d e", None, "s", None)] * 2 + [(2, "w " * 300_000, None, "t", None)]
    rows += [(i, "x " * 2_000, None, "u", None) for i in range(10, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, entropy=0.9, repeats=1000.0).collect()
    again = mixing.mix(df.repartition(6), entropy=0.9, repeats=1000.0).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    copies = collections.Counter((r.id, r.source) for r in got)
    # The small source is read again and again, each of its rows in every block.
    assert copies[(1, "s")] >= 3 * (copies[(None, "s")] // 2) > 3
    # The text of 300,000 words does not fit the budget of its source, which is the largest.
    assert (2, "t") not in copies


def test_mixing_keeps_awkward_rows(docs, nothing):
    out = mixing.mixed_documents(docs, entropy=0.99)
    assert out.schema == docs.schema and out.count() > 0
    blank = docs.filter("doc_id is null").withColumn("text", F.lit(None).cast("string"))
    assert mixing.mixed_documents(blank).count() == 2
    assert mixing.mix(nothing).count() == 0


@pytest.mark.parametrize("whole_group", [0.0, 0.02, 2.0])
def test_shards(docs, whole_group):
    rows = sharding.balanced_shards(docs, shards=4, whole_group=whole_group).collect()
    source = docs.collect()
    assert sorted((-1 if r.id is None else r.id, r["size"], r.text_crc32) for r in rows) == sorted(
        (-1 if r.doc_id is None else r.doc_id, len(raw(r)) + 1, zlib.crc32(raw(r))) for r in source
    )
    total = sum(r["size"] for r in rows)
    most = max(r["size"] for r in rows)
    for shard in range(4):
        own = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 4) <= most + 2 * whole_group * total / 4
    if whole_group == 2.0:
        shards = collections.defaultdict(set)
        for r in rows:
            shards[r.text_crc32].add(r.shard)
        assert all(len(s) == 1 for s in shards.values())


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 24)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 24), (403, [float("inf")] * 24), (None, [1.0] * 24)]
    rows += [(420, []), (421, [2.0]), rows[5], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(64 * float(np.float32(x))) for x in v]
    want = []
    for q, a in usable.items():
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable.items() if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:20])]
    for sizes in ({}, {"slice_rows": 2048, "query_rows": 4}):
        got = topk.exact_top_k(df, **sizes).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_huge_numbers():
    q_ids, x_ids = np.array([0]), np.array([0, 1, 2])
    huge = np.array([[2**40, 1], [2**40, 2], [1, 2**41]])
    found = list(topk.search(q_ids, huge[:1], x_ids, huge, 20))
    assert found[0][1].tolist() == [1, 2]
    assert found[0][2].tolist() == [2**63 - 1, 2**40 + 2**41]


@pytest.mark.parametrize(("spread", "most"), [(1.0, 0.9), (0.3, 0.7)])
def test_top_k_leaves_work_out_and_loses_nothing(spread, most):
    """Without any structure a tenth of the products goes, around centres a third."""
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 40, (50, 64)) * (spread < 1)
    x = np.floor(centres[rng.integers(0, 50, 40_000)] + rng.normal(0, 40 * spread, (40_000, 64)))
    ids, q, done = np.arange(40_000), x[:128], [0]
    found = list(topk.search(ids[:128], q, ids, x, 20, done=done))
    scores = q @ x.T
    scores[np.arange(128), np.arange(128)] = -np.inf
    for (query, best, values), row in zip(found, scores):
        want = np.lexsort((ids, -row))[:20]
        assert best.tolist() == want.tolist() and values.tolist() == row[want].tolist()
    assert done[0] < most * q.size * 40_000


def test_top_k_with_clashing_names(spark):
    names = "key long, vec array<double>, vec_id string, v string, slice int, block int, score int, rank int, c0 int"
    df = spark.createDataFrame([(20 * i, [float(i), 1.0], "a", "b", 1, 2, 3, 4, 5) for i in range(5)], names)
    got = topk.exact_top_k(df, k=1, id_col="key", vector_col="vec").collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(0, 20), (20, 80), (40, 80), (60, 80), (80, 60)]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i} ü%", f"<p>{'x' * (i % 7) * 50}é</p>") for i in range(60)]
    rows += [(100, None, None), (101, "a\nb", ""), (102, "", " "), (None, "u", "<p>é</p>"), (None, None, "alone"), (0, "again", "<p>é</p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("least", [0, 20])
def test_warc_round_trip(pages, least):
    rows = pages.collect()
    html = lambda r: (r.html or "").encode()
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[html(r)] = min(first.get(html(r), r.page_id), r.page_id)
    want = []
    for r in rows:
        to = first.get(html(r))
        again = to is not None and to != r.page_id and len(html(r)) >= least
        digest = base64.b32encode(hashlib.sha1(html(r)).digest()).decode()
        kind = ("revisit", to, None) if again else ("response", None, html(r))
        want.append((r.page_id, r.url, len(html(r)), digest, *kind))
    got = warc_zip.archive_round_trip(pages, least=least, archive_bytes=4000).collect()
    cells = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in got]
    cells = [(*c[:6], b"" if c[4] == "response" and not c[6] else c[6]) for c in cells]
    assert sorted(map(repr, cells)) == sorted(map(repr, want))


def test_archives_are_read_by_as_many_tasks_as_there_are_cores(spark, tmp_path):
    rows = spark.range(400).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.col("id").cast("string"), F.repeat(F.md5(F.col("id").cast("string")), 20)).alias("html")
    )
    # In a folder that the shared file system names, in ranges of a few records.
    written = warc_zip.write_archives(warc_zip.record_kinds(rows), f"file:{tmp_path}/wacz", archive_bytes=50_000)
    assert all(r.path.startswith("file:") for r in written.collect())
    read = warc_zip.read_archives(written, range_bytes=4_000)
    where = read.select("page_id", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.page_id for r in where) == list(range(400))
    assert len({r.task for r in where}) >= spark.sparkContext.defaultParallelism


def test_archive_paths_belong_to_the_store_of_spark(spark):
    assert zip_archive.qualified(spark, "/a/b") == "file:/a/b"
    assert zip_archive.arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    assert zip_archive.arrow_uri("hdfs://node:8020/x") == "hdfs://node:8020/x"


def test_very_long_pages_and_clashing_columns(spark):
    names = "page_id long, url string, html string, path string, kind string, digest string, first string, n long"
    rows = [(i, "u", "é" * 3_000_000 if i < 2 else "x", *"abcd", 1) for i in range(4)]
    got = warc_zip.archive_round_trip(spark.createDataFrame(rows, names)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [
        (0, 6_000_000, "response", None), (1, 6_000_000, "revisit", 0), (2, 1, "response", None), (3, 1, "revisit", 2)
    ]


def test_zip64_directories_and_compressed_members(tmp_path, monkeypatch):
    path = tmp_path / "a.zip"
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    with zipfile.ZipFile(path, "w") as out:
        for name in ("first", "second é"):
            with out.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                member.write(name.encode() * 9)
        out.writestr(zipfile.ZipInfo("small"), b"z" * 100, zipfile.ZIP_DEFLATED)
        out.comment = b"PK\x05\x06 is no end"
    archive = ZipRanges(str(path))
    assert set(archive.members) == {"first", "second é", "small"}
    member = archive.members["second é"]
    assert archive.read(archive.data_offset(member), member.size) == "second é".encode() * 9
    with pytest.raises(ValueError, match="compressed"):
        archive.data_offset(archive.members["small"])
    (tmp_path / "b.zip").write_bytes(b"no archive at all, " * 3)
    with pytest.raises(ValueError, match="not a ZIP"):
        ZipRanges(str(tmp_path / "b.zip"))


def test_no_rows(nothing, spark):
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert unit_dedup.repeated_units(nothing).count() == 0
    assert simhash.near_groups(nothing).count() == 0
    assert simhash.drop_near_copies(nothing).count() == 0
    assert packing.pack(nothing, tokenizer_path()).count() == 0
    assert sharding.balanced_shards(nothing).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.quality_verdicts(nothing, quality_rules.fit_quality(nothing, labels)).count() == 0
    assert byte_cnn.quality_scores(nothing, byte_cnn.fit_quality(nothing, labels)).count() == 0
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_zip.archive_round_trip(pages).count() == 0


def test_columns_with_clashing_names(spark):
    cells = "doc_id long, text string, source string, id string, k1 string, k2 string, row string, spans string, kept string, block string, c0 string"
    rows = [(i, f"{'word ' * 60}{i}", "s", *"abcdefgh") for i in range(4)]
    docs = spark.createDataFrame(rows, cells)
    model = quality_rules.fit([], [])
    for out in (
        quality_rules.keep_good(docs, model),
        simhash.drop_near_copies(docs),
        unit_dedup.without_repeated_units(docs),
        mixing.mixed_documents(docs),
    ):
        assert out.columns == docs.columns
        out.collect()
    for out in (suffix_dedup.remove_repeats(docs), sharding.balanced_shards(docs), packing.pack(docs, tokenizer_path())):
        assert out.count() == 4
