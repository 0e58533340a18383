"""Document fingerprints: a Merkle tree of pieces, paragraphs and sections.

A paragraph is a line, and its leaves are pieces of up to eight words with the white space around
them, so that all characters are covered. Sections are runs of paragraphs that end after a paragraph
whose hash says so, so an inserted paragraph moves no later section. Every node is the MD5 of its
children: equal roots mean equal texts, and where roots differ, differing sections and leaves locate
the edit. Only SQL functions are used; they work on one text at a time, without a shuffle.

`fingerprint` is `root:sections:leaves` in hexadecimal (32, 16 and 8 digits a node). The likeness of
two fingerprints is the share of common leaves, 2 |A and B| / (|A| + |B|) over distinct ones; equal
roots give 1.

Defined results: null text counts as empty; two empty texts are alike; rows are kept one to one,
repeated rows and null ids included; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewatch.operators.ranking import order_bucket

SPACE, WORD = r"[\t-\r ]", r"[^\t-\r ]"
PIECE = f"{SPACE}*(?:{WORD}+{SPACE}*){{1,8}}|{SPACE}+"
#: A paragraph ends its section if its hash ends with one of these digits: one in four.
SECTION_ENDS = "[0-3]$"
NODE, LEAF = 16, 8


def _node(text: Column) -> Column:
    return F.substring(F.md5(text), 1, NODE)


def with_tree(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`: struct(root, sections, leaves) of a text without nulls.

    Level by level in columns of their own, so that no level is evaluated twice.
    """
    leaves, paragraphs, sections = (f"__{out}_{n}" for n in ("l", "p", "s"))
    df = df.withColumn(leaves, F.transform(F.split(text, "\n", -1), lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), _node)))
    df = df.withColumn(paragraphs, F.transform(leaves, lambda p: _node(F.array_join(p, ","))))
    df = df.withColumn(sections, F.transform(F.split(F.array_join(F.transform(
        paragraphs, lambda h: F.when(h.rlike(SECTION_ENDS), F.concat(h, F.lit("|"))).otherwise(
            F.concat(h, F.lit(",")))), ""), r"\|", -1), _node))
    return df.withColumn(out, F.struct(
        F.md5(F.array_join(sections, ",")).alias("root"), F.col(sections).alias("sections"),
        F.transform(F.flatten(leaves), lambda h: F.substring(h, 1, LEAF)).alias("leaves"))).drop(
        leaves, paragraphs, sections)


def fingerprint(tree: str) -> Column:
    return F.concat_ws(":", F.col(f"{tree}.root"), F.array_join(f"{tree}.sections", ""),
                       F.array_join(f"{tree}.leaves", ""))


def likeness(a: str, b: str) -> Column:
    """Share of common distinct leaves of two trees, 0 to 1."""
    common = F.size(F.array_intersect(f"{a}.leaves", f"{b}.leaves"))
    every = F.size(F.array_distinct(f"{a}.leaves")) + F.size(F.array_distinct(f"{b}.leaves"))
    return F.when(F.col(f"{a}.root") == F.col(f"{b}.root"), F.lit(1.0)).when(
        every == 0, F.lit(0.0)).otherwise(2.0 * common / every)


def first_difference(a: str, b: str, level: str) -> Column:
    """0-based place of the first differing node of a level, null for equal trees."""
    same = F.zip_with(f"{a}.{level}", f"{b}.{level}", lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False) - 1
    return F.when(F.col(f"{a}.root") == F.col(f"{b}.root"), None).otherwise(
        F.when(at >= 0, at))


def with_next_text(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `next_text`: the text of the next row by descending id, null ids last
    and equal ids by text hash; the first follows the last.

    Rows are windowed in ranges of ids; the first rows of a range visit the range above as guests,
    so the texts are shuffled once and no task holds more than a range. Ids should identify rows:
    all rows of one id share a range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = order_bucket(rows, "doc_id", "__range", max(8, 2 * parts))
    cut = cut.withColumn("__range", F.when(F.col("doc_id").isNull(), -1).otherwise(
        F.col("__range")))
    # one row per range; their number is set by the session, not by the data
    heads = sorted(tuple(r) for r in cut.groupBy("__range").agg(F.max("doc_id")).collect())
    spark = docs.sparkSession
    hosts = [heads[(k + 1) % len(heads)][0] for k in range(len(heads))]
    visits = spark.createDataFrame(
        [(head, host) for (_, head), host in zip(heads, hosts, strict=True)],
        "__head long, __host int")
    sent = cut.join(F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("__head")), "left")
    spread = sent.select("doc_id", "text", F.posexplode(
        F.when(F.col("__host").isNull(), F.array("__range")).otherwise(
            F.array("__range", "__host"))).alias("__guest", "__range"))
    order = W.partitionBy("__range").orderBy(
        "__guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return spread.withColumn("next_text", F.lead("text").over(order)).where(
        "__guest = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness.

    The edited form has the last third of the characters replaced by the first as many of the next
    text.
    """
    df = with_next_text(docs).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    df = df.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
        F.substring("next_text", F.lit(1), third)))
    df = with_tree(df, "text", "own")
    df = with_tree(df, "edited", "new")
    df = with_tree(df, "next_text", "next")
    return df.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("new").alias("edited_fingerprint"),
        likeness("own", "new").alias("near_edited"), likeness("own", "next").alias("near_next"),
        first_difference("own", "new", "sections").alias("edited_section"),
        first_difference("own", "new", "leaves").alias("edited_leaf"))


def _tree_sql(text: str) -> str:
    """Expressions of a tree's levels over `text`, as nested select lists."""
    return f"""SELECT doc_id, which, t, leaves, sections, md5(array_to_string(sections, ',')) AS root FROM (
 SELECT *, list_transform(string_split(array_to_string(list_transform(paragraphs, lambda h:
   h || CASE WHEN regexp_matches(h, '{SECTION_ENDS}') THEN '|' ELSE ',' END), ''), '|'),
   lambda x: md5(x)[1:{NODE}]) AS sections FROM (
  SELECT *, list_transform(nested, lambda p: md5(array_to_string(p, ','))[1:{NODE}]) AS paragraphs,
   list_transform(flatten(nested), lambda h: h[1:{LEAF}]) AS leaves FROM (
   SELECT doc_id, which, t, list_transform(string_split(t, chr(10)), lambda p: list_transform(
    regexp_extract_all(p, '{PIECE}'), lambda x: md5(x)[1:{NODE}])) AS nested FROM {text}) a) b) c"""


def _likeness_sql(a: str, b: str) -> str:
    return f"""CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE
 WHEN len({a}.leaves) + len({b}.leaves) = 0 THEN 0.0 ELSE 2.0::DOUBLE *
 len(list_distinct(list_intersect({a}.leaves, {b}.leaves)))
 / (len(list_distinct({a}.leaves)) + len(list_distinct({b}.leaves))) END"""


def _difference_sql(a: str, b: str, level: str) -> str:
    return f"""CASE WHEN {a}.root <> {b}.root THEN list_position(list_transform(
 range(1, greatest(len({a}.{level}), len({b}.{level})) + 1),
 lambda i: {a}.{level}[i] IS NOT DISTINCT FROM {b}.{level}[i]), false) - 1 END"""


def _print_sql(a: str) -> str:
    return (f"{a}.root || ':' || array_to_string({a}.sections, '') || ':' || "
            f"array_to_string({a}.leaves, '')")


#: `fingerprints(documents)` for tables whose ids identify rows.
ORACLE_SQL = f"""WITH pairs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(
  lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS nxt FROM documents),
edits AS (SELECT *, left(text, length(text) - length(text) // 3) || left(nxt, length(text) // 3)
  AS edited FROM pairs),
texts AS (SELECT doc_id, 'own' AS which, text AS t FROM edits UNION ALL
  SELECT doc_id, 'new', edited FROM edits UNION ALL SELECT doc_id, 'next', nxt FROM edits),
trees AS MATERIALIZED ({_tree_sql('texts')}),
o AS (SELECT * FROM trees WHERE which = 'own'), e AS (SELECT * FROM trees WHERE which = 'new'),
n AS (SELECT * FROM trees WHERE which = 'next')
SELECT o.doc_id, CAST(length(o.t) AS BIGINT) AS n_chars, sha256(e.t) AS edited_sha256,
 {_print_sql('o')} AS fingerprint, {_print_sql('e')} AS edited_fingerprint,
 {_likeness_sql('o', 'e')} AS near_edited, {_likeness_sql('o', 'n')} AS near_next,
 {_difference_sql('o', 'e', 'sections')} AS edited_section,
 {_difference_sql('o', 'e', 'leaves')} AS edited_leaf
FROM o JOIN e USING (doc_id) JOIN n USING (doc_id)"""
