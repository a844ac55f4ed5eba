"""Queries on text, answers, the message stream and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.functions import scalars as fn
from tabkit.operators import answers, text as tx
from tabkit.session import scratch_path
from tabkit.sources import tables as src
from tabkit.streaming import qa_log

_TOKENS = "regexp_extract_all(lower(text), '[a-z0-9]+')"
_WORDS = f"SELECT DISTINCT unnest({_TOKENS}) AS token FROM documents"
_CODES = f"SELECT token, row_number() OVER (ORDER BY token) - 1 AS code FROM ({_WORDS})"


@query(
    "txt_tokenize",
    f"SELECT doc_id, len({_TOKENS})::INT AS n_tokens, md5(array_to_string({_TOKENS}, ' ')) AS digest FROM documents",
)
def _(t: Tables) -> DataFrame:
    rows = tx.tokenize(t.documents, "text")
    return rows.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("txt_stem")
def _(t: Tables) -> DataFrame:
    return tx.stem_dictionary(t.documents, "text")


@query("txt_stem_tokens")
def _(t: Tables) -> DataFrame:
    return tx.stemmed_tokens(t.conversations.withColumn("id", F.concat_ws("-", "conv_id", "turn")), "id", "text")


@query("txt_vocab", f"SELECT token, code::BIGINT AS code FROM ({_CODES})")
def _(t: Tables) -> DataFrame:
    return tx.vocabulary(t.documents, "text")


@query(
    "txt_bow",
    f"""WITH v AS ({_CODES}), w AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS token FROM documents),
        b AS (SELECT doc_id, string_agg(code::VARCHAR, ' ' ORDER BY code) AS codes, count(*) AS n
              FROM w JOIN v USING (token) GROUP BY doc_id)
        SELECT doc_id, coalesce(codes, '') AS codes, coalesce(n, 0)::INT AS n FROM documents LEFT JOIN b USING (doc_id)""",
)
def _(t: Tables) -> DataFrame:
    bags = tx.bag_of_words(t.documents, "doc_id", "text", tx.vocabulary(t.documents, "text"))
    return bags.select("doc_id", F.array_join(F.col("codes").cast("array<string>"), " ").alias("codes"), F.size("codes").alias("n"))


@query(
    "txt_corpus_stats",
    f"""SELECT count(*) AS n_examples, count(DISTINCT lang) AS n_tags, (SELECT count(*) FROM ({_WORDS})) AS n_words
        FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return tx.corpus_stats(t.documents, "text", "lang")


@query("txt_lang_gate")
def _(t: Tables) -> DataFrame:
    model = tx.fit_language_model(t.documents, "text", "lang")
    turns = t.conversations
    scored = tx.language_candidates(model, turns, "text")
    best = F.get("candidates", F.lit(0))
    return scored.select(
        "conv_id",
        "turn",
        best["lang"].alias("lang"),
        tx.language_allowed(F.col("text"), F.col("candidates")).alias("allowed"),
    )


@query(
    "txt_lang_rule",
    """WITH c AS (SELECT doc_id, text, lang, (n_chars % 100) / 100.0 AS p FROM documents)
       SELECT doc_id, length(trim(text)) < 20 OR lang = 'en' OR p < 0.7 AS allowed FROM c""",
)
def _(t: Tables) -> DataFrame:
    p = (F.col("n_chars") % 100) / 100
    first = F.struct(p.alias("prob"), F.col("lang").alias("lang"))
    second = F.struct((1 - p).alias("prob"), F.lit("en").alias("lang"))
    return t.documents.select("doc_id", tx.language_allowed(F.col("text"), F.array(first, second)).alias("allowed"))


def _intents(t: Tables):
    return tx.fit_intents(t.documents, "text", "lang")


@query("txt_intent_model")
def _(t: Tables) -> DataFrame:
    scored = tx.classify(_intents(t), t.documents.select("doc_id", "lang", "text"), "text")
    return scored.select("doc_id", "lang", "tag", F.round("confidence", 3).alias("confidence"))


@query(
    "txt_route",
    f"""WITH m AS (SELECT conv_id, turn, text, len({_TOKENS}) AS n, turn % 3 AS known, (conv_id % 100) / 100.0 AS p,
                          conv_id % 5 <> 0 OR length(trim(text)) < 20 AS ok, role FROM conversations)
        SELECT conv_id, turn,
          CASE WHEN NOT ok THEN 'non_english' WHEN n = 0 THEN 'empty' WHEN known = 0 THEN 'unrecognized' ELSE role END AS tag,
          (CASE WHEN NOT ok OR n = 0 OR known = 0 THEN 0 ELSE p END)::DOUBLE AS confidence,
          CASE WHEN NOT ok THEN '{tx.ENGLISH_ONLY}' WHEN n = 0 OR known = 0 OR p <= 0.75 THEN '{tx.FALLBACK}'
               ELSE 'About ' || role END AS answer
        FROM m""",
)
def _(t: Tables) -> DataFrame:
    given = t.conversations.select(
        "conv_id",
        "turn",
        "text",
        F.size(fn.tokens(F.col("text"))).alias("n_tokens"),
        (F.col("turn") % 3).alias("n_known"),
        F.col("role").alias("tag"),
        ((F.col("conv_id") % 100) / 100).alias("confidence"),
        F.array(F.concat(F.lit("About "), "role")).alias("responses"),
        F.array(F.struct(F.lit(0.9).alias("prob"), F.when(F.col("conv_id") % 5 == 0, "fr").otherwise("en").alias("lang"))).alias("candidates"),
    )
    allowed = tx.language_allowed(F.col("text"), F.col("candidates"))
    return tx.route(given, allowed, F.col("conv_id"), F.col("responses")).select(
        "conv_id", "turn", "tag", "confidence", "answer"
    )


# --- stream -----------------------------------------------------------------------------------


@query("st_qa_log")
def _(t: Tables) -> DataFrame:
    spark = t.spark
    model = _intents(t)
    languages = tx.fit_language_model(t.documents, "text", "lang")
    inbox = scratch_path(spark, "inbox")
    src.write_parquet(t.conversations.repartition(4), inbox)
    stream = qa_log.message_stream(spark, inbox, t.conversations.schema, 2)
    minutes = F.make_interval(hours=F.col("turn").cast("int"), mins=F.col("conv_id").cast("int"))
    messages = stream.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        (F.to_timestamp(F.lit("2024-01-01 00:00:00")) + minutes).alias("ts"),
        F.col("conv_id").alias("user_id"),
        F.col("role").alias("username"),
        F.col("text").alias("question"),
    )
    replies = t.documents.select(F.col("lang").alias("tag")).distinct()
    replies = replies.withColumn("responses", F.array(F.concat(F.lit("reply in "), "tag"), F.concat("tag", F.lit("!"))))
    rows = qa_log.answer_messages(messages, model, languages, replies)
    path = scratch_path(spark, "qa_log")
    qa_log.start_log(rows, path, scratch_path(spark, "qa_checkpoint")).awaitTermination()
    log = qa_log.read_log(spark, path)
    return log.select("id", "username", "tag", F.round("confidence", 3).alias("confidence"), "answer")


# --- answers ----------------------------------------------------------------------------------


@query(
    "eval_fact_match",
    """SELECT conv_id, turn, round((contains(lower(text), 'qu')::INT + contains(lower(text), 'the')::INT
              + contains(lower(text), role)::INT) / 3, 6) AS fact_match FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    facts = F.array(F.lit("QU"), F.lit("The"), F.col("role"))
    return t.conversations.select(
        "conv_id", "turn", F.round(answers.fact_match(F.col("text"), facts), 6).alias("fact_match")
    )


@query(
    "eval_tool_overlap",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN true
              ELSE event_type IN ('click', 'view') END AS matched FROM events""",
)
def _(t: Tables) -> DataFrame:
    none = F.array().cast("array<string>")
    expected = F.when(F.col("event_type") == "error", none).otherwise(F.array(F.lit("click"), F.lit("view")))
    return t.events.select("event_id", answers.tool_match(F.array("event_type"), expected).alias("matched"))


@query(
    "eval_ungrounded",
    r"""WITH n AS (SELECT DISTINCT conv_id, turn, role, unnest(regexp_extract_all(text, '\d+(?:\.\d+)?')) AS num
                   FROM conversations),
        u AS (SELECT a.conv_id, a.turn, count(*) AS c FROM n a WHERE a.role = 'assistant' AND length(a.num) > 1
              AND NOT EXISTS (SELECT 1 FROM n b WHERE b.conv_id = a.conv_id AND b.turn < a.turn AND b.num = a.num)
              GROUP BY 1, 2)
        SELECT conv_id, turn, coalesce(c, 0)::BIGINT AS ungrounded
        FROM (SELECT conv_id, turn FROM conversations WHERE role = 'assistant') LEFT JOIN u USING (conv_id, turn)""",
)
def _(t: Tables) -> DataFrame:
    return answers.ungrounded_turns(t.conversations)


@query(
    "eval_summary",
    """WITH r AS (SELECT turn % 7 = 6 AS failed, round(length(text) % 4 / 4.0, 2) AS fm, role = 'assistant' AS tm,
                         turn AS calls, turn > 4 AS hit, length(text) % 5 AS ug, length(text) / 1000.0 AS s
                  FROM conversations)
       SELECT count(*) AS n_questions, count(*) FILTER (NOT failed) AS n_completed, count(*) FILTER (failed) AS n_failed,
              round(avg(fm) FILTER (NOT failed), 3) AS avg_fact_match,
              round(avg(tm::INT) FILTER (NOT failed), 3) AS avg_tool_match,
              round(avg(calls) FILTER (NOT failed), 2) AS avg_tool_calls,
              count(*) FILTER (NOT failed AND hit) AS n_hit_limit,
              round(avg(ug) FILTER (NOT failed), 2) AS avg_ungrounded,
              round(avg(s::DOUBLE) FILTER (NOT failed), 2) AS avg_seconds FROM r""",
)
def _(t: Tables) -> DataFrame:
    length = F.length("text")
    results = t.conversations.select(
        F.when(F.col("turn") % 7 == 6, "failed").alias("error"),
        F.round(length % 4 / 4, 2).alias("fact_match"),
        (F.col("role") == "assistant").cast("int").alias("tool_match"),
        F.col("turn").alias("tool_calls"),
        (length % 5).alias("ungrounded"),
        (F.col("turn") > 4).alias("hit_limit"),
        (length / 1000).alias("seconds"),
    )
    return answers.summarize(results)


# --- scalar functions -------------------------------------------------------------------------


@query(
    "fn_string",
    r"""SELECT page_id, regexp_extract(url, '([^/]+?)(?:\.[^./]*)?$', 1) AS stem,
         lower(regexp_extract(url, '(\.[^./]+)$', 1)) AS suffix,
         len(regexp_extract_all(url, '\d+(?:\.\d+)?'))::INT AS n_numbers,
         replace(replace(lower(trim(url)), '-', '_'), ' ', '_') AS name,
         contains(lower(html), 'script') AS has_script,
         md5(CASE WHEN length(html) > 300 THEN left(html, 300) || '...' ELSE html END) AS short,
         len(regexp_split_to_array(url, '[^a-z0-9]+'))::INT AS n_parts FROM pages""",
)
def _(t: Tables) -> DataFrame:
    from tabkit.operators.quality import stem_of

    url, html = F.col("url"), F.col("html")
    return t.pages.select(
        "page_id",
        stem_of(url).alias("stem"),
        fn.suffix(url).alias("suffix"),
        F.size(fn.numbers_in(url)).alias("n_numbers"),
        fn.name_part(url).alias("name"),
        F.contains(F.lower(html), F.lit("script")).alias("has_script"),
        F.md5(fn.truncated(html)).alias("short"),
        F.size(F.split(url, "[^a-z0-9]+")).alias("n_parts"),
    )


@query(
    "fn_math",
    """SELECT l_orderkey, l_partkey, l_extendedprice, round(sqrt(l_extendedprice), 4) AS root,
              round(exp(-l_discount), 4) AS decay, abs(l_discount - 0.05) AS gap,
              least(l_extendedprice, 50000.0)::DOUBLE AS upper, greatest(least(l_quantity, 40.0), 5.0)::DOUBLE AS both,
              (l_discount >= 0.05)::INT AS flag FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        F.round(F.sqrt("l_extendedprice"), 4).alias("root"),
        F.round(F.exp(-F.col("l_discount")), 4).alias("decay"),
        F.abs(F.col("l_discount") - 0.05).alias("gap"),
        fn.clipped(F.col("l_extendedprice"), high=50000.0).alias("upper"),
        fn.clipped(F.col("l_quantity"), 5.0, 40.0).alias("both"),
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).alias("flag"),
    )


@query(
    "fn_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
              strftime(ts - INTERVAL 90 DAY, '%Y-%m-%dT%H:%M:%S') AS before,
              strftime(ts, '%Y-%m-%d') AS parsed, ts < TIMESTAMP '2024-02-01 00:00:00' AS early FROM events""",
)
def _(t: Tables) -> DataFrame:
    from tabkit.operators.profiling import parse_date

    ts = F.col("ts")
    day = F.when(F.col("event_id") % 2 == 0, F.date_format(ts, "yyyy-MM-dd")).otherwise(F.date_format(ts, "MM/dd/yyyy"))
    return t.events.select(
        "event_id",
        fn.iso_time(ts).alias("iso"),
        fn.iso_time(fn.days_before(ts, 90)).alias("before"),
        F.date_format(parse_date(day), "yyyy-MM-dd").alias("parsed"),
        (ts < F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))).alias("early"),
    )


@query(
    "fn_array",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS e FROM embeddings)
       SELECT vec_id, (list_position(e, list_max(e)) - 1)::BIGINT AS argmax, round(list_avg(e), 6) AS mean,
              len(list_filter(e, lambda v: v <> 0)) > 0 AS any_nonzero, round(list_reverse_sort(e)[3], 6) AS third,
              list_contains(e, e[1]) AS has_first, len(e)::INT AS size FROM e""",
)
def _(t: Tables) -> DataFrame:
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select(
        "vec_id",
        fn.argmax(e).alias("argmax"),
        F.round(fn.mean(e), 6).alias("mean"),
        fn.any_nonzero(e).alias("any_nonzero"),
        F.round(F.element_at(F.sort_array(e, asc=False), 3), 6).alias("third"),
        F.array_contains(e, F.get(e, F.lit(0))).alias("has_first"),
        F.size(e).alias("size"),
    )


@query(
    "fn_map_json",
    """SELECT event_id, (props::JSON->>'k')::INT AS k, '{"k":' || (props::JSON->>'k') || ',"type":"' || event_type || '"}'
              AS json, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS code FROM events""",
)
def _(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k int")["k"]
    codes = fn.as_map([("click", F.lit(1)), ("view", F.lit(2))])
    return t.events.select(
        "event_id",
        parsed.alias("k"),
        F.to_json(F.struct(parsed.alias("k"), F.col("event_type").alias("type"))).alias("json"),
        F.try_element_at(codes, F.col("event_type")).alias("code"),
    )


@query(
    "fn_null_cond",
    """SELECT l_orderkey, l_partkey, l_extendedprice, coalesce(nullif(l_tax, 0), -1)::DOUBLE AS tax,
              nullif(l_discount, 0) IS NULL AS no_discount, coalesce(l_discount / nullif(l_tax, 0), 0) AS ratio,
              CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'mid' ELSE 'high' END AS band FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        F.coalesce(F.nullif("l_tax", F.lit(0.0)), F.lit(-1.0)).alias("tax"),
        F.nullif("l_discount", F.lit(0.0)).isNull().alias("no_discount"),
        fn.ratio(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
        F.when(q < 10, "low").when(q < 30, "mid").otherwise("high").alias("band"),
    )
