"""Queries over projections, filters, joins, aggregates, sorts, sampling and
scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.text import csv_field, like_label, path_segment
from corvid.operators import relational as rel
from corvid.operators.text import word_counts
from corvid.plans.registry import SQL_LINES, register
from corvid.session import table
from corvid.sources.files import parse_csv_column

# Fixed parameters of the queries.
ITEM_AVG_THRESHOLD = 26      # mean quantity per part, strict ">"
ORDER_AVG_EQUALS = 25        # mean quantity per order, "="
ROW_THRESHOLD = 45           # l_quantity >= 45
FIRST_N = 5
SAMPLE_N = 100
SAMPLE_FRACTION = 0.01
SAMPLE_SEED = 10
SPLIT_SEED = 12345


def item_avg_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose mean quantity is above the threshold, with their name."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    means = rel.mean_per_key(lines, "l_partkey", "l_quantity", "avg_qty")
    hot = rel.having(means, "avg_qty", ">", ITEM_AVG_THRESHOLD)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rel.join_on_key(parts, hot.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey")


SQL_ITEM_AVG = f"""
SELECT p.p_partkey, p.p_name, a.avg_qty
FROM part p JOIN (
  SELECT l_partkey, avg(l_quantity) AS avg_qty FROM lineitem
  GROUP BY l_partkey HAVING avg(l_quantity) > {ITEM_AVG_THRESHOLD}) a
ON p.p_partkey = a.l_partkey
"""

register("join_item_avg", SQL_ITEM_AVG)(item_avg_above)


@register("join_item_counts", """
SELECT p.p_partkey, p.p_name, c.n_ratings
FROM part p JOIN (SELECT l_partkey, count(*) AS n_ratings FROM lineitem GROUP BY l_partkey) c
ON p.p_partkey = c.l_partkey
""")
def join_item_counts(spark, sf_dir):
    counts = rel.count_per_key(table(spark, sf_dir, "lineitem"), "l_partkey", "n_ratings")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rel.join_on_key(parts, counts.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey")


@register("prj_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def prj_select(spark, sf_dir):
    return rel.project(table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


@register("prj_from_csv", """
SELECT n_nationkey, n_name, n_regionkey, n_name AS name_field FROM nation
""")
def prj_from_csv(spark, sf_dir):
    """Delimited lines parsed back into typed fields (``from_csv``), plus one
    field cut by position."""
    nation = table(spark, sf_dir, "nation")
    lines = nation.select(F.to_csv(F.struct("n_nationkey", "n_name", "n_regionkey")).alias("line"))
    parsed = parse_csv_column(lines, "line", "n_nationkey INT, n_name STRING, n_regionkey INT")
    return parsed.select("parsed.*", csv_field("line", 1).alias("name_field"))


@register("prj_like_label", """
SELECT p_partkey, p_type, CAST(p_type LIKE 'S%' AS DOUBLE) AS label FROM part
""")
def prj_like_label(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_type", like_label("p_type", "S%").alias("label"))


@register("flt_avg_equals", f"""
SELECT l_orderkey, avg(l_quantity) AS avg_qty FROM lineitem
GROUP BY l_orderkey HAVING avg(l_quantity) = {ORDER_AVG_EQUALS}
""")
def flt_avg_equals(spark, sf_dir):
    means = rel.mean_per_key(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", "avg_qty")
    return rel.having(means, "avg_qty", "=", ORDER_AVG_EQUALS)


@register("flt_avg_above", f"""
SELECT l_partkey, avg(l_quantity) AS avg_qty FROM lineitem
GROUP BY l_partkey HAVING avg(l_quantity) > {ITEM_AVG_THRESHOLD}
""")
def flt_avg_above(spark, sf_dir):
    means = rel.mean_per_key(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", "avg_qty")
    return rel.having(means, "avg_qty", ">", ITEM_AVG_THRESHOLD)


@register("flt_row_threshold", f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= {ROW_THRESHOLD}
""")
def flt_row_threshold(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rel.filter_threshold(lines, "l_quantity", ROW_THRESHOLD, ">=")


@register("flt_like_prefix", "SELECT p_partkey, p_type FROM part WHERE p_type LIKE 'S%'")
def flt_like_prefix(spark, sf_dir):
    return rel.filter_prefix(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", "S")


@register("flt_drop_sentinel", "SELECT p_partkey, p_name FROM part WHERE p_partkey > 0")
def flt_drop_sentinel(spark, sf_dir):
    return rel.filter_threshold(table(spark, sf_dir, "part").select("p_partkey", "p_name"),
                                "p_partkey", 0, ">")


def _part_view(spark, sf_dir) -> str:
    name = "corvid_part"
    table(spark, sf_dir, "part").createOrReplaceTempView(name)
    return name


@register("sql_range_and", """
SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 13 AND p_size <= 19
""")
def sql_range_and(spark, sf_dir):
    view = _part_view(spark, sf_dir)
    return spark.sql(f"SELECT p_partkey, p_name, p_size FROM {view} WHERE p_size >= 13 AND p_size <= 19")


@register("sql_between", """
SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19
""")
def sql_between(spark, sf_dir):
    view = _part_view(spark, sf_dir)
    return spark.sql(f"SELECT p_partkey, p_name, p_size FROM {view} WHERE p_size BETWEEN 13 AND 19")


@register("agg_row_counts", """
SELECT 'part' AS table_name, count(*) AS n_rows FROM part
UNION ALL SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
""")
def agg_row_counts(spark, sf_dir):
    return rel.row_counts({"part": table(spark, sf_dir, "part"),
                           "lineitem": table(spark, sf_dir, "lineitem")})


SQL_WORDS = f"""
SELECT unnest(string_split(line, ' ')) AS word
FROM (SELECT unnest({SQL_LINES}) AS line FROM documents)
"""


@register("wordcount", f"SELECT word, count(*) AS count FROM ({SQL_WORDS}) GROUP BY word")
def wordcount(spark, sf_dir):
    """Word count over every line of every document; empty tokens kept."""
    return word_counts(table(spark, sf_dir, "documents").select("text"), "text")


@register("agg_grand_total", f"""
SELECT 'all_times:' AS label, CAST(count(*) AS BIGINT) AS total FROM ({SQL_WORDS})
""")
def agg_grand_total(spark, sf_dir):
    counts = word_counts(table(spark, sf_dir, "documents").select("text"), "text")
    return rel.grand_total(counts, "count", "all_times:", "total")


@register("agg_item_avg", """
SELECT l_partkey, avg(l_quantity) AS avg_qty FROM lineitem GROUP BY l_partkey
""")
def agg_item_avg(spark, sf_dir):
    return rel.mean_per_key(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", "avg_qty")


@register("agg_user_avg", """
SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY user_id
""")
def agg_user_avg(spark, sf_dir):
    means = rel.mean_per_key(table(spark, sf_dir, "events"), "user_id", "value", "avg_value")
    return means.withColumn("avg_value", F.round("avg_value", 6))


@register("agg_item_counts", """
SELECT l_partkey, count(*) AS n_ratings FROM lineitem GROUP BY l_partkey
""")
def agg_item_counts(spark, sf_dir):
    return rel.count_per_key(table(spark, sf_dir, "lineitem"), "l_partkey", "n_ratings")


@register("agg_category_counts", """
SELECT event_type AS category, count(*) AS count FROM events GROUP BY event_type
ORDER BY count DESC, category
""")
def agg_category_counts(spark, sf_dir):
    return rel.category_counts(table(spark, sf_dir, "events"), "event_type")


@register("agg_weekday_counts", """
SELECT dayname(ts) AS category, count(*) AS count FROM events GROUP BY 1
ORDER BY count DESC, category
""")
def agg_weekday_counts(spark, sf_dir):
    return rel.category_counts(table(spark, sf_dir, "events"), F.date_format("ts", "EEEE"))


@register("sql_topic_top5", """
SELECT source AS topic, count(*) AS cnt FROM documents GROUP BY source
ORDER BY cnt DESC, topic LIMIT 5
""")
def sql_topic_top5(spark, sf_dir):
    """Group count, ordered, top 5 (the reference's DISTINCT over GROUP BY is
    a no-op and is left out)."""
    table(spark, sf_dir, "documents").createOrReplaceTempView("corvid_documents")
    return spark.sql("""
        SELECT source AS topic, count(*) AS cnt FROM corvid_documents
        GROUP BY source ORDER BY cnt DESC, topic LIMIT 5""")


@register("agg_distinct", "SELECT DISTINCT lang FROM documents")
def agg_distinct(spark, sf_dir):
    return rel.distinct_values(table(spark, sf_dir, "documents"), "lang")


@register("agg_drop_duplicates", """
SELECT DISTINCT source, lang, text FROM documents
""")
def agg_drop_duplicates(spark, sf_dir):
    """Repeated rows of the whole table once."""
    return rel.drop_duplicates(table(spark, sf_dir, "documents").select("source", "lang", "text"))


def _genres(spark, sf_dir) -> DataFrame:
    """Part names as a ``|``-joined multi-value field (one value per word)."""
    part = table(spark, sf_dir, "part")
    return part.select(F.replace("p_name", F.lit(" "), F.lit("|")).alias("genres"))


@register("agg_multivalue_distinct", """
SELECT count(DISTINCT g) AS n_distinct
FROM (SELECT unnest(string_split(replace(p_name, ' ', '|'), '|')) AS g FROM part)
""")
def agg_multivalue_distinct(spark, sf_dir):
    return rel.multivalue_distinct(_genres(spark, sf_dir), "genres", "|", "n_distinct")


@register("agg_multivalue_counts", """
SELECT g AS value, count(*) AS n
FROM (SELECT unnest(string_split(replace(p_name, ' ', '|'), '|')) AS g FROM part) GROUP BY g
""")
def agg_multivalue_counts(spark, sf_dir):
    return rel.multivalue_counts(_genres(spark, sf_dir), "genres", "|", "value")


@register("srt_first_n", f"{SQL_ITEM_AVG} ORDER BY p.p_partkey LIMIT {FIRST_N}")
def srt_first_n(spark, sf_dir):
    return rel.first_n(item_avg_above(spark, sf_dir), FIRST_N, [F.col("p_partkey")])


SQL_LINE_HASH = f"md5(concat_ws(':', '{SAMPLE_SEED}', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"


@register("smp_n_rows", f"SELECT * FROM lineitem ORDER BY {SQL_LINE_HASH}, l_orderkey, l_linenumber LIMIT {SAMPLE_N}")
def smp_n_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rel.sample_n(lines, SAMPLE_N, SAMPLE_SEED, ["l_orderkey", "l_linenumber"])


@register("smp_fraction", f"SELECT * FROM lineitem WHERE {SQL_LINE_HASH} < '{rel.hash_below(SAMPLE_FRACTION)}'")
def smp_fraction(spark, sf_dir):
    return rel.sample_fraction(table(spark, sf_dir, "lineitem"), SAMPLE_FRACTION, SAMPLE_SEED, ["l_orderkey", "l_linenumber"])


@register("smp_train_test_split", f"""
SELECT doc_id, source, CASE WHEN md5(concat_ws(':', '{SPLIT_SEED}', CAST(doc_id AS VARCHAR))) < '{rel.hash_below(0.8)}'
                            THEN 'train' ELSE 'test' END AS split
FROM documents
""")
def smp_train_test_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return rel.hash_split(docs, ["doc_id"], 0.8, SPLIT_SEED)


@register("fn_path_segments", """
SELECT page_id, string_split(url, '/')[-1] AS id, string_split(url, '/')[-2] AS topic FROM pages
""")
def fn_path_segments(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", path_segment("url", -1).alias("id"),
                        path_segment("url", -2).alias("topic"))


@register("fn_casts", r"""
SELECT event_id,
       CAST(regexp_extract(props, '(-?[0-9]+)', 1) AS INTEGER) AS k,
       CAST(value AS FLOAT) AS value_f,
       TRY_CAST(event_type AS INTEGER) AS type_as_int
FROM events
""")
def fn_casts(spark, sf_dir):
    """Strict casts (ANSI: bad input raises) and ``try_cast`` for dirty input."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.regexp_extract("props", r"(-?[0-9]+)", 1).cast("int").alias("k"),
        F.col("value").cast("float").alias("value_f"),
        F.col("event_type").try_cast("int").alias("type_as_int"),
    )


@register("fn_contains", """
SELECT doc_id, contains(text, 'License') AS has_license FROM documents
""")
def fn_contains(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("text").contains("License").alias("has_license"))

