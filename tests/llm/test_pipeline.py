"""The corpus pipeline: its stages one by one, and the whole against them."""

import collections
import math

import corpus_pipeline
import pytest

from rookery.llm.rows import materialise


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialise(stage(spark, docs, sf_dir), name)
    return out


def test_stages_return_the_columns_of_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert all(stages[name].schema.names == stages[""].schema.names for name in names[:-1])


def test_each_stage_works_on_what_its_predecessor_kept(stages):
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in stages.items()}
    before = set(ids[""])
    for name in ("quality_rules", "simhash_near_dedup"):
        assert len(ids[name]) == len(set(ids[name])) and set(ids[name]) < before
        before = set(ids[name])
    assert sorted(ids["substring_dedup"]) == sorted(ids["simhash_near_dedup"])
    text = lambda name: {r.doc_id: r.text for r in stages[name].collect()}
    before, after = text("simhash_near_dedup"), text("substring_dedup")
    assert all(len(after[i]) <= len(before[i]) for i in after) and before != after
    assert set(ids["mixing_sources"]) <= set(ids["substring_dedup"])
    packed = collections.Counter(r.doc_id for r in stages["best_fit_packing"].filter("piece = 0").collect())
    assert packed == collections.Counter(ids["mixing_sources"])


def test_mixing_makes_sources_more_even(stages):
    """The sources of these documents are less even than the target, so some are read again."""

    def evenness(name):
        total = collections.Counter()
        for r in stages[name].collect():
            total[r.source] += len((r.text or "").split())
        whole = sum(total.values())
        return -sum(n / whole * math.log(n / whole) for n in total.values() if n) / math.log(len(total))

    copies = collections.Counter(r.doc_id for r in stages["mixing_sources"].select("doc_id").collect())
    assert max(copies.values()) > 1
    assert evenness("substring_dedup") < corpus_pipeline.MIX_ENTROPY
    assert evenness("substring_dedup") < evenness("mixing_sources")


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    cells = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: sorted(map(tuple, df.select(cells).collect()))
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(stages["best_fit_packing"])


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, row string, k1 string, id string, spans string, block long"


def landed(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_awkward_documents_without_labels(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, clashing names, no label to learn from."""
    long = " ".join(f"word{i}" for i in range(120))
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (None, long, None, "s", 9), (3, long, "en", "t", 9), (4, long.replace("word7 ", ""), "en", "t", 9)]
    rows += [(5, " ".join(f"other{i}" for i in range(90)), "de", None, 1)] * 2
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", 7) for r in rows], AWKWARD)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sf_dir = landed(spark, tmp_path, docs, labels)
    here, ids = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        here = materialise(stage(spark, here, sf_dir), name)
        assert here.columns == docs.columns
        ids.append(sorted((r.doc_id for r in here.collect()), key=str))
    # Texts without words go; then one of the near copies and one of the repeated rows are left.
    assert ids[:3] == [[3, 4, 5, 5, None], [3, 5], [3, 5]]
    # The larger source has one document, which its even share cannot hold.
    assert set(ids[3]) == {5} == {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    sf_dir = landed(spark, tmp_path, docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
