from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabkit.functions.porter import stem
from tabkit.operators import answers, text as tx
from tabkit.streaming import qa_log
from tests.conftest import rows_of


@pytest.mark.parametrize(
    "word,want",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("feed", "feed"),
        ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
        ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
        ("relational", "relat"), ("vietnamization", "vietnam"), ("triplicate", "triplic"), ("hopefulness", "hope"),
        ("adjustment", "adjust"), ("adoption", "adopt"), ("probate", "probat"), ("cease", "ceas"),
        ("controll", "control"), ("roll", "roll"), ("is", "is"), ("generalizations", "gener"),
    ],
)
def test_porter(word, want):
    assert stem(word) == want


def test_vocabulary_and_bags(spark):
    df = spark.createDataFrame([(1, "The cats, the CATS!"), (2, "a cat 42"), (3, "?!")], "id int, text string")
    words = tx.vocabulary(df, "text")
    assert rows_of(words) == [("42", 0), ("a", 1), ("cat", 2), ("cats", 3), ("the", 4)]
    assert rows_of(tx.bag_of_words(df, "id", "text", words)) == [(1, [3, 4]), (2, [0, 1, 2]), (3, [])]
    assert rows_of(tx.stemmed_tokens(df, "id", "text")) == [(1, "cat"), (1, "the"), (2, "42"), (2, "a"), (2, "cat")]
    assert {r["token"]: r["n"] for r in tx.token_counts(df, "text").collect()}["the"] == 2


def test_grams_are_those_of_spark(spark, monkeypatch):
    from pyspark.ml.feature import HashingTF, NGram

    monkeypatch.setattr(tx, "GRAM_BYTES", 40)
    texts = ["", "a", "ab", "abc", "Ünïcödé ﬁ", "日本語 text 語", "a😀b😀😀😀é", "ß", "\x00\x7f\u0080", "plain words, again and again", "é" * 30, "", "xy", "z\n z"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    chars = df.withColumn("chars", F.split("text", ""))
    want = HashingTF(numFeatures=1 << 14, inputCol="grams", outputCol="tf").transform(NGram(n=3, inputCol="chars", outputCol="grams").transform(chars)).orderBy("id").collect()
    got = [x for _, found, lengths in tx.gram_buckets(pa.array(texts), 1 << 14) for x in np.split(found, np.cumsum(lengths)[:-1])]
    assert [sorted(x.tolist()) for x in got] == [sorted(int(k) for k, n in zip(r["tf"].indices, r["tf"].values) for _ in range(int(n))) for r in want]


def test_language_model_is_naive_bayes_of_texts(spark, monkeypatch):
    """The same chances as NGram, HashingTF and NaiveBayes over single texts, with no string per character."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, NGram, StringIndexer

    monkeypatch.setattr(tx, "HELD_LANGUAGES", 1)
    rows = [("The house is old and the SEA is blue", "en"), ("das Haus ist alt und die See ist blau", "de"), ("la maison est vieille et bleue", "fr"), ("et", "fr"), ("", "de"), (None, "fr")] * 3 + [("a b c", "en")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    asked = spark.createDataFrame([("the old house",), ("und die",), ("",), (None,), ("et",), ("été 😀",)], "text string")
    chars = lambda d: d.withColumn("chars", F.split(F.lower(F.coalesce("text", F.lit(""))), ""))
    stages = [NGram(n=3, inputCol="chars", outputCol="grams"), HashingTF(numFeatures=1 << 14, inputCol="grams", outputCol="tf"), StringIndexer(inputCol="lang", outputCol="y", stringOrderType="alphabetAsc", handleInvalid="keep"), NaiveBayes(featuresCol="tf", labelCol="y")]
    plain = Pipeline(stages=stages).fit(chars(df.where("length(text) > 0")))
    want = {r["text"]: list(r["probability"]) for r in plain.transform(chars(asked).withColumn("lang", F.lit("en"))).collect()}
    model = tx.fit_language_model(df, "text", "lang")
    scored = tx.language_candidates(model, asked, "text")
    assert "UDF" in scored._jdf.queryExecution().executedPlan().toString()
    for r in scored.collect():
        chances = {c["lang"]: c["prob"] for c in r["candidates"]}
        assert [chances[x] for x in ("de", "en", "fr")] == pytest.approx(want[r["text"]], rel=1e-9)
        assert [c["prob"] for c in r["candidates"]] == sorted(chances.values(), reverse=True)


def test_language_rule(spark):
    long, short = "x" * 20, "x" * 19
    cases = [
        (short, [("fr", 0.9)], True),
        (long, [("fr", 0.9)], False),
        (long, [("fr", 0.69), ("en", 0.3)], True),
        (long, [("fr", 0.69), ("de", 0.31)], True),
        (long, [("fr", 0.7), ("en", 0.3)], False),
        (long, [("en", 0.4), ("fr", 0.9)], True),
        (long, [], True),
        (long, None, True),
    ]
    df = spark.createDataFrame(cases, "text string, c array<struct<lang:string,prob:double>>, want boolean")
    got = df.select(tx.language_allowed(F.col("text"), F.col("c")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_routing(spark):
    rows = [
        (1, 0, 0, "hi", 0.9, True), (2, 3, 0, "hi", 0.9, True), (3, 3, 1, "hi", 0.76, True), (4, 3, 1, "hi", 0.75, True),
        (5, 3, 1, "hi", 0.9, False), (6, 3, 1, None, None, True),
    ]
    df = spark.createDataFrame(rows, "id int, n_tokens int, n_known int, tag string, confidence double, ok boolean")
    df = df.withColumn("responses", F.array(F.lit("A"), F.lit("B")))
    got = {r["id"]: r for r in tx.route(df, F.col("ok"), F.col("id"), F.col("responses")).collect()}
    assert [got[i]["tag"] for i in range(1, 7)] == ["empty", "unrecognized", "hi", "hi", "non_english", "error"]
    assert got[3]["answer"] in ("A", "B") and got[4]["answer"] == tx.FALLBACK and got[4]["confidence"] == 0.75
    assert got[5]["answer"] == tx.ENGLISH_ONLY and got[1]["confidence"] == 0.0


@pytest.fixture(scope="module")
def intents(spark):
    rows = [("hello there", "greet"), ("hi hello", "greet"), ("good morning hello", "greet"), ("see you bye", "leave"),
            ("bye bye now", "leave"), ("goodbye bye", "leave")]
    return tx.fit_intents(spark.createDataFrame(rows, "text string, tag string"), "text", "tag", rounds=60)


def test_intents(spark, intents):
    df = spark.createDataFrame([("hello",), ("bye now",), ("zzz",), ("",)], "text string")
    got = tx.classify(intents, df, "text").collect()
    assert [(r["tag"], r["n_known"]) for r in got[:2]] == [("greet", 1), ("leave", 2)]
    assert [(r["n_tokens"], r["n_known"]) for r in got[2:]] == [(1, 0), (0, 0)]


def test_language_model(spark):
    english = ["the quick brown fox jumps over the lazy dog", "this is the way that they have been thinking"]
    german = ["der schnelle braune fuchs springt ueber den faulen hund", "das ist der weg den sie gegangen sind und nicht"]
    df = spark.createDataFrame([(x, "en") for x in english] + [(x, "de") for x in german], "text string, lang string")
    model = tx.fit_language_model(df, "text", "lang")
    got = tx.language_candidates(model, df, "text").select("lang", F.col("candidates")[0]["lang"]).collect()
    assert all(a == b for a, b in got)


def test_stream_log_and_retention(spark, intents, tmp_path):
    inbox, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "check"))
    schema = "id string, ts timestamp, user_id long, username string, question string"

    def send(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        stream = qa_log.message_stream(spark, inbox, schema)
        responses = spark.createDataFrame([("greet", ["hi!"]), ("leave", ["bye!"])], "tag string, responses array<string>")
        qa_log.start_log(qa_log.answer_messages(stream, intents, None, responses), log, checkpoint).awaitTermination()

    send([("1", datetime(2024, 1, 1, 8), 1, "a", "hello"), ("2", datetime(2024, 1, 3, 8), 1, "a", "?!")])
    run()
    send([("3", datetime(2024, 1, 3, 20), 2, "b", "zzz"), ("4", datetime(2024, 4, 2), 2, "b", "bye bye")])
    run()
    run()
    got = {r["id"]: r for r in qa_log.read_log(spark, log).collect()}
    assert {k: r["tag"] for k, r in got.items()} == {"1": "greet", "2": "empty", "3": "unrecognized", "4": "leave"}
    now = datetime(2024, 4, 2, 12)  # ninety days before: 2024-01-03 12:00
    assert qa_log.expire_log(spark, log, now) == 2
    spark.catalog.clearCache()
    assert rows_of(qa_log.read_log(spark, log), "id") == [("3",), ("4",)]
    assert qa_log.expire_log(spark, log, now) == 0


def test_expiry_that_is_cut_off_keeps_its_count(spark, tmp_path, monkeypatch):
    log, stamps = str(tmp_path / "log"), [datetime(2024, 1, 1), datetime(2024, 1, 3, 9), datetime(2024, 1, 3, 15), datetime(2024, 2, 1)]
    rows = spark.createDataFrame([(str(i), t, f"{t:%Y-%m-%d}", 0) for i, t in enumerate(stamps)], "id string, ts timestamp, log_date string, batch long")
    rows.withColumn("log_date", F.to_date("log_date")).write.partitionBy("log_date", "batch").parquet(log)
    drop = qa_log._drop_older

    def cut_off(spark, path, limit):
        drop(spark, path, limit)
        raise RuntimeError("cut off")

    now = datetime(2024, 4, 2, 12)
    monkeypatch.setattr(qa_log, "_drop_older", cut_off)
    with pytest.raises(RuntimeError):
        qa_log.expire_log(spark, log, now)
    monkeypatch.setattr(qa_log, "_drop_older", drop)
    assert qa_log.expire_log(spark, log, now) == 2
    spark.catalog.clearCache()
    assert rows_of(spark.read.parquet(log), "id") == [("2",), ("3",)]
    assert qa_log.expire_log(spark, log, now) == 0


def test_answers(spark):
    df = spark.createDataFrame([("The answer is 45.2 and 7", ["45.2", "ANSWER", "no"], ["sql"], ["stats", "sql"], ["45.2 rows", "x"])],
                               "a string, f array<string>, called array<string>, expected array<string>, src array<string>")
    empty = F.array().cast("array<string>")
    r = df.select(
        answers.fact_match(F.col("a"), F.col("f")).alias("f"),
        answers.fact_match(F.col("a"), empty).alias("f0"),
        answers.tool_match(F.col("called"), F.col("expected")).alias("t"),
        answers.tool_match(empty, F.col("expected")).alias("t0"),
        answers.tool_match(empty, empty).alias("t1"),
        answers.ungrounded_numbers(F.concat("a", F.lit(" or 120")), F.col("src")).alias("u"),
    ).first()
    assert r["f"] == pytest.approx(2 / 3) and (r["f0"], r["t"], r["t0"], r["t1"]) == (1.0, True, False, True)
    assert r["u"] == ["120"]


def test_ungrounded_turns(spark):
    rows = [(1, 0, "user", "got 10 and 5"), (1, 1, "assistant", "10 of 20, 20, 5, 6"), (1, 2, "user", "30"),
            (1, 3, "assistant", "20 30 40"), (2, 0, "assistant", "none")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert rows_of(answers.ungrounded_turns(df)) == [(1, 1, 1), (1, 3, 1), (2, 0, 0)]


def test_intents_know_every_stem(spark):
    from tabkit.catalog import language
    from tabkit.catalog.registry import Tables

    model = language._intents(Tables(spark, "/root/testdata/sf0.001"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["stem"] for r in tx.stem_dictionary(docs, "text").select("stem").distinct().collect()}
    assert len(want) > 2000 and set(model.stages[0].vocabulary) == want
    scored = tx.classify(model, docs.select("doc_id", "text"), "text").filter("n_tokens > 0 AND n_known = 0")
    assert scored.count() == 0


def test_log_gates_other_languages(spark):
    from tabkit.catalog import language  # noqa: F401
    from tabkit.catalog.registry import Tables, QUERIES

    rows = QUERIES["st_qa_log"](spark, "/root/testdata/sf0.001")
    assert rows.filter("tag = 'non_english'").count() > 0


def test_network_on_sparse_bags_is_sparks_own(spark):
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors
    from tabkit.operators.network import fit_network

    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        y = int(rng.integers(0, 3))
        words = sorted({int(x) for x in rng.integers(0, 12, 5)} | ({12 + y} if rng.random() < 0.8 else set()))
        rows.append((Vectors.sparse(15, words if k % 50 else [], [1.0] * (len(words) if k % 50 else 0)), float(y)))
    df = spark.createDataFrame(rows, ["bag", "y"]).coalesce(1)
    for rounds in (1, 5, 60):
        want = MultilayerPerceptronClassifier(featuresCol="bag", labelCol="y", layers=[15, 4, 3, 3], maxIter=rounds, seed=5).fit(df)
        got = fit_network(df, "bag", "y", [15, 4, 3, 3], rounds, 5)
        assert np.allclose(got.weights.toArray(), want.weights.toArray(), rtol=1e-4, atol=1e-4), rounds


def test_network_never_makes_bags_dense(spark):
    """A vocabulary of three million words: dense blocks of 128 rows would take 3 GB each, and 9 GB for the rows."""
    from pyspark.ml.linalg import Vectors
    from tabkit.operators.network import fit_network

    size = 3_000_000
    df = spark.createDataFrame([(Vectors.sparse(size, [k % 2, 10 + 7 * k], [1.0, 1.0]), float(k % 2)) for k in range(400)], ["bag", "y"])
    model = fit_network(df, "bag", "y", [size, 2, 2], 3, 1)
    assert len(model.weights) == size * 2 + 2 + 2 * 2 + 2


def test_characters_are_counted_in_one_pass(spark, monkeypatch):
    letters = "ab zéßñ€😀"
    texts = ["", None, "abba é", "ééß€€😀z", "Ünder ñandú", "x" * 50 + "a€", "b" * 40]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string").coalesce(1)
    for size in (1 << 20, 8):
        monkeypatch.setattr(tx, "COUNTED_BYTES", size)
        got = {r["i"]: r["n"] for r in df.select("i", tx.character_counts(F.col("text"), letters).alias("n")).collect()}
        assert [got[i] for i in range(len(texts))] == [None if x is None else [x.count(c) for c in letters] for x in texts]
    one = lambda c: F.length("text") - F.length(F.translate("text", c, ""))
    assert df.where("text IS NOT NULL").select(F.array(*[one(c).cast("long") for c in letters]) == tx.character_counts(F.col("text"), letters)).distinct().collect() == [(True,)]
