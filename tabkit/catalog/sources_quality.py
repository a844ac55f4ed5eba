"""Queries on sources, sinks, hygiene, projections and joins."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from tabkit.catalog.registry import Tables, query
from tabkit.operators import features, quality, relational
from tabkit.session import scratch_path
from tabkit.sources import tables as src


# --- sources and sinks ------------------------------------------------------------------------


@query(
    "src_csv_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def _(t: Tables) -> DataFrame:
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = t.orders.select(*names)
    path = src.write_csv(orders, scratch_path(t.spark, "orders_csv"))
    return src.read_csv(t.spark, path, schema=orders.schema)


@query(
    "src_csv_inferred",
    "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def _(t: Tables) -> DataFrame:
    path = src.write_csv(t.customer, scratch_path(t.spark, "customer_csv"))
    return src.read_csv(t.spark, path)


@query("src_csv_text", "SELECT doc_id, text, lang FROM documents")
def _(t: Tables) -> DataFrame:
    """Texts with line breaks, through a file and back."""
    docs = t.documents.select("doc_id", "text", "lang")
    path = src.write_csv(docs, scratch_path(t.spark, "texts_csv"))
    return src.read_csv(t.spark, path, schema=docs.schema, multi_line=True)


@query(
    "src_cached_join_again",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables) -> DataFrame:
    """The second call finds the finished cache and does not look at its inputs."""
    path = scratch_path(t.spark, "documents_labels")
    src.cached_join(t.documents.select("doc_id", "lang"), t.labels, "doc_id", path)
    return src.cached_join(t.documents.select("doc_id", "lang").limit(0), None, "doc_id", path)


@query(
    "src_cached_join",
    """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables) -> DataFrame:
    facts = t.documents.select("doc_id", "lang", "source", "n_chars")
    return src.cached_join(facts, t.labels, "doc_id", scratch_path(t.spark, "documents_labels"))


@query(
    "src_json_explode",
    """SELECT role AS tag, unnest(string_split(text, chr(10))) AS pattern FROM conversations""",
)
def _(t: Tables) -> DataFrame:
    docs = t.conversations.select(
        F.col("role").alias("tag"), F.split("text", "\n").alias("patterns"), F.array("role").alias("responses")
    )
    path = src.write_json(docs, scratch_path(t.spark, "intents"))
    schema = "tag string, patterns array<string>, responses array<string>"
    return src.explode_examples(src.read_nested_json(t.spark, path, schema))


_MANIFEST = """SELECT vec_id AS image, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
    CASE WHEN label = 0 THEN 'defect' ELSE 'normal' END AS label, 'obj' || (label % 3) AS object FROM embeddings"""


@query(
    "src_manifest",
    f"""WITH m AS ({_MANIFEST})
        SELECT image, split, label, object FROM m
        WHERE object = 'obj0' AND (split = 'test' OR (split = 'train' AND label = 'normal'))""",
)
def _(t: Tables) -> DataFrame:
    manifest = t.embeddings.select(
        F.col("vec_id").alias(" Image "),
        F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train").alias("Split"),
        F.when(F.col("label") == 0, "defect").otherwise("normal").alias("LABEL "),
        F.concat(F.lit("obj"), (F.col("label") % 3).cast("string")).alias("Object"),
    )
    train = src.manifest_rows(manifest, "train", "obj0")
    return train.unionByName(src.manifest_rows(manifest, "test", "obj0"))


_FILES = """SELECT lang AS split, 'image' AS kind, lang || '/images/' || doc_id || '.jpg' AS path, n_chars AS size
      FROM documents
      UNION ALL
      SELECT d.lang, 'label', d.lang || '/labels/' || d.doc_id || '.txt',
             CASE WHEN l.toxic = 1 THEN 0 ELSE 20 END
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def _files(t: Tables) -> DataFrame:
    """A listing as the file source gives it: one image per document, one label file per label."""
    docs = t.documents.select("doc_id", "lang", "n_chars")
    images = docs.select(
        F.col("lang").alias("split"),
        F.lit("image").alias("kind"),
        F.concat("lang", F.lit("/images/"), "doc_id", F.lit(".jpg")).alias("path"),
        F.col("n_chars").alias("size"),
    )
    labels = docs.join(t.labels, "doc_id").select(
        F.col("lang").alias("split"),
        F.lit("label").alias("kind"),
        F.concat("lang", F.lit("/labels/"), "doc_id", F.lit(".txt")).alias("path"),
        F.when(F.col("toxic") == 1, 0).otherwise(20).cast("long").alias("size"),
    )
    return images.unionByName(labels)


@query(
    "src_label_files",
    f"""WITH f AS ({_FILES})
        SELECT path, size::BIGINT AS size FROM f WHERE kind = 'label' AND size <= 10""",
)
def _(t: Tables) -> DataFrame:
    labels = _files(t).filter(F.col("kind") == "label")
    return src.admissible_files(labels, [".txt"], max_bytes=10).select("path", "size")


# --- hygiene ----------------------------------------------------------------------------------


@query("dq_validate", "SELECT 11 AS n_columns, count(*) > 0 AS has_rows, count(*) > 1000 AS too_large FROM lineitem")
def _(t: Tables) -> DataFrame:
    return quality.size_check(t.lineitem, 1000)


def _with_copies(t: Tables) -> DataFrame:
    rows = t.lineitem
    return rows.unionAll(rows.filter(F.col("l_linenumber") <= 2))


_WITH_COPIES = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber <= 2"


@query(
    "dq_duplicate_rows",
    f"""WITH d AS ({_WITH_COPIES})
        SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)))::BIGINT AS duplicate_rows FROM d""",
)
def _(t: Tables) -> DataFrame:
    return quality.duplicate_rows(_with_copies(t))


def _holes(t: Tables) -> DataFrame:
    """Line items with derived missing values, as the given tables have none."""
    return t.lineitem.select(
        "l_quantity",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("r_price"),
        F.when(F.col("l_linenumber") == 1, F.col("l_linestatus")).alias("first_status"),
        F.lit(None).cast("double").alias("nothing"),
    )


_HOLES = """SELECT l_quantity, nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS r_price,
    CASE WHEN l_linenumber = 1 THEN l_linestatus END AS first_status, NULL::DOUBLE AS nothing FROM lineitem"""
_HOLE_NAMES = ["l_quantity", "l_tax", "l_discount", "r_price", "first_status", "nothing"]
_HOLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS total FROM h" for c in _HOLE_NAMES
)


@query("dq_null_counts", f"WITH h AS ({_HOLES}) {_HOLE_COUNTS}")
def _(t: Tables) -> DataFrame:
    return quality.null_counts(_holes(t))


@query(
    "dq_missing_topn",
    f"""WITH h AS ({_HOLES}), c AS ({_HOLE_COUNTS}), m AS (SELECT * FROM c WHERE missing > 0)
        SELECT "column", round(missing / total * 100, 4) AS missing_pct,
               (SELECT count(*) FROM m) AS columns_with_missing
        FROM m ORDER BY missing_pct DESC, "column" LIMIT 3""",
)
def _(t: Tables) -> DataFrame:
    return quality.missing_top(_holes(t), 3)


@query(
    "dq_drop_sparse_cols",
    """SELECT l_quantity, nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount,
              CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS r_price FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return quality.drop_sparse_columns(_holes(t), 0.70)


_IQR_NAMES = ["l_quantity", "l_extendedprice", "l_discount", "boosted"]
_IQR_INPUT = """SELECT l_quantity, l_extendedprice, l_discount,
    l_extendedprice * l_extendedprice * l_quantity AS boosted FROM lineitem"""
_IQR_FENCE = """quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
    quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi"""


@query(
    "dq_iqr_report",
    f"WITH x AS ({_IQR_INPUT}), r AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < lo OR {c} > hi) AS outliers, count(*) AS total "
        f"FROM x, (SELECT {_IQR_FENCE.format(c=c)} FROM x)"
        for c in _IQR_NAMES
    )
    + ') SELECT "column", outliers, round(outliers / total * 100, 4) AS outlier_pct FROM r WHERE outliers > 0',
)
def _(t: Tables) -> DataFrame:
    boosted = F.col("l_extendedprice") * F.col("l_extendedprice") * F.col("l_quantity")
    return quality.iqr_report(
        t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", boosted.alias("boosted"))
    )


@query(
    "dq_iqr_filter",
    f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS a, l_tax * l_extendedprice AS b
                   FROM lineitem),
        y AS (SELECT x.* FROM x, (SELECT {_IQR_FENCE.format(c="a")} FROM x) WHERE a BETWEEN lo AND hi),
        z AS (SELECT y.* FROM y, (SELECT {_IQR_FENCE.format(c="b")} FROM y) WHERE b BETWEEN lo AND hi)
        SELECT l_linenumber, count(*) AS n, round(max(a), 2) AS max_a, round(max(b), 2) AS max_b
        FROM z GROUP BY l_linenumber""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_linenumber",
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("a"),
        (F.col("l_tax") * F.col("l_extendedprice")).alias("b"),
    )
    return (
        quality.iqr_filter(rows, "a", "b")
        .groupBy("l_linenumber")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.max("a"), 2).alias("max_a"),
            F.round(F.max("b"), 2).alias("max_b"),
        )
    )


def _place_sql(kind: str) -> str:
    return f"""CASE doc_id % 3 WHEN 0 THEN 's0/{kind}/' WHEN 1 THEN '{kind}/s1/' ELSE 's2/' END || (doc_id // 3)"""


@query(
    "dq_drop_empty_pairs",
    f"""SELECT {_place_sql("images")} || '.jpg' AS path, n_chars AS size,
              (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) AS removed
       FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
)
def _(t: Tables) -> DataFrame:
    """Every stem occurs in all three splits, and each split has another layout of folders."""

    def place(kind: str, suffix: str) -> Column:
        stem, split = F.floor(F.col("doc_id") / 3).cast("string"), F.col("doc_id") % 3
        folder = F.when(split == 0, F.lit(f"s0/{kind}/")).when(split == 1, F.lit(f"{kind}/s1/")).otherwise(F.lit("s2/"))
        return F.concat(folder, stem, F.lit(suffix))

    images = t.documents.select(place("images", ".jpg").alias("path"), F.col("n_chars").alias("size"))
    size = F.when(F.col("toxic") == 1, 0).otherwise(20)
    labels = t.documents.join(t.labels, "doc_id").select(place("labels", ".txt").alias("path"), size.alias("size"))
    clean, removed = quality.drop_empty_pairs(images, labels)
    return clean.withColumn("removed", removed.scalar())


@query(
    "dq_split_counts",
    f"""WITH f AS ({_FILES}), c AS (
          SELECT split, count(*) FILTER (kind = 'image') AS n_images, count(*) FILTER (kind = 'label') AS n_labels,
                 count(*) FILTER (kind = 'label' AND size = 0) AS n_empty FROM f GROUP BY split)
        SELECT *, round(100 * n_empty / nullif(n_labels, 0), 4) AS empty_pct FROM c""",
)
def _(t: Tables) -> DataFrame:
    return quality.split_counts(_files(t))


@query(
    "dq_dup_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(t: Tables) -> DataFrame:
    return quality.repeated_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "dq_near_ties",
    """WITH RECURSIVE s AS (SELECT o_totalprice AS v, count(*) AS n FROM orders GROUP BY 1),
       walk(a) AS (
         SELECT min(v) FROM s
         UNION ALL
         SELECT (SELECT min(v) FROM s WHERE v - walk.a >= 25) FROM walk WHERE walk.a IS NOT NULL),
       g AS (SELECT s.v, s.n, (SELECT max(a) FROM walk WHERE a <= s.v) AS anchor FROM s)
       SELECT anchor, count(*) AS n_scores, sum(n)::BIGINT AS n_rows FROM g GROUP BY anchor HAVING sum(n) > 1""",
)
def _(t: Tables) -> DataFrame:
    return quality.near_ties(t.orders, "o_totalprice", 25.0)


@query(
    "dq_retention",
    """SELECT event_id, event_type,
              (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-04-06 00:00:00' - INTERVAL 90 DAY) AS removed
       FROM events WHERE ts >= TIMESTAMP '2024-04-06 00:00:00' - INTERVAL 90 DAY""",
)
def _(t: Tables) -> DataFrame:
    now = F.to_timestamp(F.lit("2024-04-06 00:00:00"))
    kept, counts = quality.apply_retention(t.events, now, 90)
    return kept.select("event_id", "event_type", counts.select("removed").scalar().alias("removed"))


# --- projections and joins --------------------------------------------------------------------


@query(
    "proj_feature_sets",
    """SELECT 'linear' AS feature_set, l_quantity, l_discount, NULL::DOUBLE AS l_tax, l_extendedprice FROM lineitem
       UNION ALL SELECT 'boosted', l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    sets = relational.feature_sets(
        t.lineitem,
        "l_extendedprice",
        {"linear": ["l_quantity", "l_discount"], "boosted": ["l_quantity", "l_discount", "l_tax"]},
    )
    tagged = [df.withColumn("feature_set", F.lit(name)) for name, df in sets.items()]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True)


@query("filter_class_subset", "SELECT l_quantity, l_discount, l_tax FROM lineitem WHERE l_returnflag = 'R'")
def _(t: Tables) -> DataFrame:
    return relational.class_subset(t.lineitem, "l_returnflag", "R", ["l_quantity", "l_discount", "l_tax"])


@query("proj_flag", "SELECT p_partkey, (p_size > 25)::TINYINT AS large FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", features.flag(F.col("p_size") > 25).alias("large"))


@query(
    "join_left",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, p.p_type, p.p_size
       FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size > 10) p ON l.l_partkey = p.p_partkey""",
)
def _(t: Tables) -> DataFrame:
    identity = t.part.filter(F.col("p_size") > 10).select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return relational.left_enrich(facts, identity, "l_partkey")


@query(
    "join_cross_capped",
    """SELECT count(*) AS row_count, true AS truncated FROM (SELECT 1 FROM customer a, customer b LIMIT 500)""",
)
def _(t: Tables) -> DataFrame:
    from tabkit.operators import sqltool

    result = sqltool.run_sql(t.customer, "SELECT a.c_custkey AS k FROM dataset a CROSS JOIN dataset b")
    return result.summary()


@query("join_random_pair")
def _(t: Tables) -> DataFrame:
    return relational.random_pairs(t.embeddings.select("vec_id", "label"), ["vec_id"], seed=7)


@query(
    "prof_schema",
    """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS name,
              CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
                   WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS dtype,
              (SELECT count(*) FROM lineitem) AS n_rows, CAST(count(*) OVER () AS INTEGER) AS n_columns
       FROM (DESCRIBE lineitem)""",
)
def _(t: Tables) -> DataFrame:
    return relational.schema_listing(t.lineitem)


