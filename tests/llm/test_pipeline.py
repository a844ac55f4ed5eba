import corpus_pipeline
import __spark_entry__
from tabkit.llm import decontamination, near_dedup
from tests.llm.test_decontamination import brute
from tests.llm.test_near_dedup import classes
from tests.llm.test_packing_topk import expected_ids

MEDIUM = "/root/testdata/sf0.01"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = dict(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality").collect())
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").select("item_id", "text").collect()
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = _stored(stage(spark, docs, MEDIUM))
        kept[name] = docs
    texts = {n: dict(d.select("doc_id", "text").collect()) for n, d in kept.items() if n != "packing"}
    for name in list(texts)[1:]:
        assert kept[name].columns == kept["documents"].columns
    assert len(texts["language_id"]) >= 0.99 * len(texts["documents"])
    gone = set(texts["language_id"]) - set(texts["quality"])
    known = [labels[d] for d in gone if d in labels]
    assert known.count(0) >= 0.9 * len(known)
    assert sum(labels.get(d) == 0 for d in texts["quality"]) <= 3
    groups = classes(texts["quality"])
    assert set(texts["near_dedup"]) == {d for d, c in groups.items() if d == c}
    leaks = {d for d, _ in brute(texts["near_dedup"].items(), items, False)}
    assert set(texts["decontamination"]) == set(texts["near_dedup"]) - leaks
    packed = kept["packing"].collect()
    assert sum(r.length for r in packed) == sum(len(expected_ids(t)) for t in texts["decontamination"].values())
    assert {r.doc_id for r in packed} == set(texts["decontamination"])


def _stored(df):
    from tabkit.llm.common import store

    return store(df, "stage")


def test_filters_of_hard_rows(spark, hard, nothing):
    rows = near_dedup.keep_one(hard)
    assert rows.columns == hard.columns
    assert sorted(r.doc_id or 0 for r in rows.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert near_dedup.keep_one(nothing).count() == 0
    items = spark.createDataFrame([(1, "the cat sat on the mat and it s 42 cats")], "item_id long, text string")
    clean = decontamination.without_leaks(hard, items)
    assert clean.columns == hard.columns
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 2, 3, 4, 6, 7, 8]


def test_stages_take_hard_rows(spark, hard, nothing):
    docs = hard.select("doc_id", "text", "lang", "source", "n")
    for _, stage in corpus_pipeline.STAGES:
        docs = _stored(stage(spark, docs, MEDIUM))
    assert docs.count() >= 0
    docs = nothing.select("doc_id", "text", "lang", "source", "n")
    for _, stage in corpus_pipeline.STAGES:
        docs = _stored(stage(spark, docs, MEDIUM))
    assert docs.count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()


def test_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    strange = [
        "Москва является столицей России и крупнейшим городом страны, расположенным на реке Москве. " * 3,
        "東京は日本の首都であり、世界最大の都市の一つです。多くの人々がここに住んでいます。",
        "qwrt zxcv bnmp lkjh gfds qwzx vbnm trwq pplk jjhg zzxx ccvv bbnn " * 4,
        "for (int k = 0; k < kMax; ++k) { buf[k] = fgetc(fp); if (!buf[k]) break; } /* xyz_vec_fmt */ " * 6,
    ]
    rows = [(10**9 + i, text, "en", "planted", len(text)) for i, text in enumerate(strange)]
    planted = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, docs.unionByName(planted), MEDIUM).select("doc_id").collect()}
    assert not kept & {r[0] for r in rows}
    clean = {r.doc_id for r in docs.where("text RLIKE '\\\\p{L}'").select("doc_id").collect()}
    assert kept == clean
