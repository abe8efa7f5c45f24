"""Stages of the corpus pipeline against brute force, and the whole of it on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from passledger.llm import mixing
from tests.llm.test_exact import R, brute_components, brute_hits

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    words = [f"w{i}" for i in range(400)]
    item = " ".join(words[:15])
    rows = [(i, " ".join(R.choices(words, k=R.choice((3, 30, 90)))), "en", f"s{i % 4}", 0) for i in range(80)]
    rows += [(100 + i, rows[i][1] + (" tail" if i % 2 else ""), "en", "s1", 0) for i in range(20)]
    rows += [(200, item, "en", "s2", 0), (201, item + " " + " ".join(R.choices(words, k=5_000)), "en", "s2", 0), (202, None, None, None, None), (203, "", "en", "s0", 0), (5, rows[5][1], "en", "s1", 0)]
    rows += [(300 + i, f"{rows[i][1]} vile{i % 3}x nasty vile{i % 3}x", "en", "s3", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] >= 300), 0) for r in rows], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def read(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_toxic_documents_go(spark, folder):
    docs = read(spark, folder)
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert not [i for i in ids if i and i >= 300] and {i for i in range(80)} <= ids


def test_one_of_each_group_stays(spark, folder):
    docs = read(spark, folder)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    want = {i for i, (_, _, stays) in brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 80).items() if stays}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and kept.columns == docs.columns


def test_texts_that_share_an_id_are_documents_of_their_own(spark, folder):
    a, b, c = (" ".join(R.choices([f"w{i}" for i in range(400)], k=40)) for _ in range(3))
    rows = [(3, a), (7, a), (7, b), (7, b), (9, b + " tail"), (None, c), (None, c), (11, None), (11, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, folder).collect()), key=str)
    assert kept == sorted([(3, a), (9, b + " tail"), (None, c), (None, c), (11, None), (11, "")], key=str)


def test_columns_named_like_results_pass_through(spark, folder):
    names = ["_Score", "_spans", "_size", "_source_size", "_target", "_copies", "_copy", "_n_words", "_items", "near key", "rest", "row", "key", "near many", "count"]
    docs = read(spark, folder).withColumns({n: F.lit(n) for n in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [out.first()[n] for n in names] == names
    assert "n_tokens" in corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns


def test_contaminated_documents_go(spark, folder):
    docs = read(spark, folder)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, folder).collect())
    hits = [(r.doc_id, *brute_hits(r.text, [(1, item)], 13)) for r in docs.collect()]
    assert kept == sorted(i for i, n, h, _ in hits if not (h and 20 * h >= n))
    assert 200 not in kept and 201 in kept


def test_mix_repeats_rows(spark, folder):
    docs = read(spark, folder)
    want = sorted(r.doc_id for r in mixing.mix(docs).collect() for _ in range(r._copies))
    assert sorted(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, folder).collect()) == want


def test_run(spark, folder):
    rows = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: r.start)
    assert rows and all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert not {r.doc_id for r in rows} & {200, *range(300, 330)}


@pytest.mark.parametrize("stage", range(5))
def test_stages_of_nothing(spark, folder, stage):
    out = corpus_pipeline.STAGES[stage][1](spark, read(spark, folder).limit(0), folder)
    assert out.count() == 0
