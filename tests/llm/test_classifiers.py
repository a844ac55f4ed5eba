import zlib

import numpy as np
import pyarrow as pa
import pytest

from tabkit.llm import language_id, quality
from tabkit.llm.queries import QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def held(doc, modulus, value):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == value


def test_languages_of_held_out_rows(spark):
    rows = QUERIES["op6_language_family"](spark, MEDIUM).collect()
    lang = dict(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect())
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in tested]) > 0.98


def test_languages_of_hard_rows(spark, hard, nothing):
    rows = language_id.language_predictions(hard).collect()
    assert len(rows) == 10
    without = [r for r in rows if r.doc_id in (2, 3, 4, 6)]
    assert len(without) == 4 and all((r.lang_pred, r.score) == ("und", 0.0) for r in without)
    learned = {"en", "de", "fr", "es"}
    assert all(r.lang_pred in learned for r in rows if r.doc_id in (1, 5, 7, 8, None))
    assert all(r.held_out == held(r.doc_id, 3, 1) for r in rows)
    assert language_id.language_predictions(nothing).count() == 0
    assert {r.lang_pred for r in language_id.language_predictions(hard.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}
    kept = language_id.identify_languages(hard, language_id.fit_language_model(hard), least=0.0)
    assert kept.columns == hard.columns and kept.count() == 6


def test_families_come_before_pairs():
    rng = np.random.default_rng(0)
    centre = {"en": 0, "de": 1, "fr": 2, "es": 3, "xx": 4}
    lang = np.array(list(centre) * 60, object)
    x = rng.normal(0, 0.05, (300, 20)).astype(np.float32)
    x[np.arange(300), [centre[c] for c in lang]] += 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = language_id.LanguageModel.fit(x, lang, language_id.FAMILIES)
    assert model.families == [["de", "en"], ["es", "fr"], ["xx"]]
    assert model.pairs == [(0, 0, 1), (1, 0, 1)]
    found, score = model.predict(x)
    assert (found == lang).all() and (score > 0.5).all()
    alone = language_id.LanguageModel.fit(x[lang == "en"], lang[lang == "en"], language_id.FAMILIES)
    assert set(alone.predict(x)[0]) == {"en"}


def test_quality_of_held_out_rows(spark):
    rows = QUERIES["op7_quality_qda"](spark, MEDIUM).collect()
    labels = dict(spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality").collect())
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in tested]) > 0.95


def test_quality_of_hard_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(1, None, 0), (None, 1, 0), (3, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(hard, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    blank = {round(r.score, 9) for r in rows if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    assert {r.score for r in quality.quality_scores(hard, labels.where("false")).collect()} == {0.5}
    assert quality.quality_scores(nothing, labels).count() == 0
    kept = quality.keep_good(hard, labels)
    assert kept.columns == hard.columns and kept.count() <= 10


def test_density_against_plain_formula():
    rng = np.random.default_rng(1)
    d = 4
    rows = [rng.normal(0, 1, (80, d)), rng.normal(1, 2, (200, d))]
    count = np.array([80.0, 200.0])
    model = quality.QualityModel.fit(count, np.array([r.sum(0) for r in rows]), np.array([r.T @ r for r in rows]), shrink=0.2, floor=0.01)
    own = [np.cov(r.T, bias=True) for r in rows]
    pooled = (own[0] * 80 + own[1] * 200) / 280
    pooled = 0.8 * pooled + 0.2 * np.diag(np.diag(pooled)) + 0.01 * np.eye(d)
    x = rng.normal(0, 2, (50, d))
    log = []
    for k, r in enumerate(rows):
        c = 0.8 * own[k] + 0.2 * pooled
        z = x - r.mean(0)
        log.append(np.log(count[k] / 280) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(c), z))
    assert model.predict(x) == pytest.approx(1 / (1 + np.exp(log[0] - log[1])), abs=1e-9)
    assert quality.QualityModel.fit(np.array([1.0, 9.0]), np.zeros((2, d)), np.zeros((2, d, d))) is None


def test_statistics_of_each_text_stand_alone():
    texts = ["A b c d e f a b c d e f", "", None, "x\nx\ny", "STOP!! it** now", "\n", "1 2 3"]
    together = quality.text_statistics(pa.array(texts))
    alone = np.concatenate([quality.text_statistics(pa.array([t], pa.string())) for t in texts])
    assert together == pytest.approx(alone)
    by = dict(zip(quality.STATISTICS, together.T, strict=True))
    assert by["repeated_lines"][3] == pytest.approx(np.sqrt(1 / 3))
    assert by["marked_words"][4] == pytest.approx(np.sqrt(2 / 3))
    assert by["digits"][6] == 1.0
    assert (together[[1, 2, 5]] == 0).all()
