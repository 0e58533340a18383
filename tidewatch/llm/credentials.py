"""Secrets in texts, told from widely copied examples by who owns them.

Base patterns give spans of three kinds. A fourth pattern gives further candidates: long tokens of
mixed letters and digits. The hash of every candidate's value is counted over the corpus by distinct
repositories (documents) and owners (sources): a value of many owners or of many repositories is a
copied example, one of one or two owners and of few repositories looks live. Candidates of the fourth pattern become spans of kind `owned` if they
look live and meet no base span; base spans always stay.

A repository is a source and a `doc_id`, so repeated rows count once; rows without an id are told
apart by their texts.

Only SQL functions are used. The texts are read once; hashes, not values, are shuffled, first by
value and repository and then counted by partial aggregates, so a value in a third of the documents
is no hot key.

Defined results: null text counts as empty and has no spans; a null source is one owner; rows are
kept one to one, repeated rows and null ids included; an empty table gives no rows; other columns
play no part. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import settle

# The base patterns and how long a match (for assign: its value) must be.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
KINDS = {"assign": (ASSIGN, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20),
         "hex": (r"[0-9a-f]+", 0, 24)}
#: What a match needs at least, to skip texts without one quickly.
HINTS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
LONG_TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
OWNED = "owned"
NAMES = [*KINDS, OWNED]
#: A value of more owners, or in more documents, is a copied example.
MOST_OWNERS = 2
MOST_REPOSITORIES = 8
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
HELD_FIELDS = ("start", "end", "owners", "repositories")
HELD = "array<struct<start:int,end:int,owners:bigint,repositories:bigint>>"


def _spans(text: Column, pattern: str, group: int, kind: int, keep) -> Column:
    """Spans of the leftmost non-overlapping matches whose value passes `keep`."""
    between = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.arrays_zip(between.alias("gap"), hits.alias("hit"), values.alias("value"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                        F.sha2(x["value"], 256).alias("value"))
        return F.struct(end.alias("at"), F.when(
            x["hit"].isNotNull() & keep(x["value"]),
            F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

    return F.aggregate(steps, none, step, lambda state: state["found"])


def find_candidates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `source`, `unnamed` (text hash if there is no id), `base` and `long`: the spans of
    one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast(SPAN)
    rows = docs.select("doc_id", "source", F.when(F.col("doc_id").isNull(), F.xxhash64(
        "text")).alias("unnamed"), text.alias("text"))
    for k, (name, (pattern, group, least)) in enumerate(KINDS.items()):
        rows = rows.withColumn(name, F.when(F.col("text").rlike(HINTS[name]), _spans(
            F.col("text"), pattern if name != "hex" else r"[0-9a-f]{24,}+", group, k,
            lambda v, n=least: F.length(v) >= n)).otherwise(nothing))
    rows = rows.withColumn(OWNED, F.when(F.col("text").rlike(LONG_TOKEN), _spans(
        F.col("text"), LONG_TOKEN, 0, len(KINDS),
        lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"))).otherwise(nothing)).drop("text")
    rows = rows.withColumn("base", F.concat(*KINDS))
    return rows.select("doc_id", "source", "unnamed", "base", F.filter(OWNED, lambda x: ~F.exists(
        "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))).alias("long"))


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repositories): distinct sources and documents that hold a value."""
    each = found.select("source", "doc_id", "unnamed", F.explode(F.array_distinct(F.transform(
        F.concat("base", "long"), lambda x: x["value"]))).alias("value"))
    return each.distinct().groupBy("value", "source").agg(F.count("*").alias("n")).groupBy(
        "value").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def secrets(docs: DataFrame) -> DataFrame:
    """Per row: counts and digest of base spans, all spans, how many look live or copied, and the
    owners and repositories of every candidate, as start:end:owners:repositories."""
    found = settle(find_candidates(docs).withColumn("__row", F.monotonically_increasing_id()))
    owners = ownership(found)
    spans = found.select("__row", F.explode(F.concat("base", "long")).alias("span"))
    few = (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    live = spans.join(owners, F.col("span.value") == F.col("value")).groupBy("__row").agg(
        F.collect_list(F.when((F.col("span.kind") == len(KINDS)) & few, F.col("span"))).alias("added"),
        F.count_if(few).alias("n_live"), F.count_if(~few).alias("n_copied"),
        F.collect_list(F.struct("span.start", "span.end", "owners", "repositories")).alias("held"))
    base = _joined(F.col("base"))
    every = _joined(F.concat("base", F.coalesce("added", F.array().cast(SPAN))))
    return found.join(live, "__row", "left").select(
        "doc_id",
        *[_count("base", k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(base, 256).alias("base_sha256"), every.alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.array_join(F.transform(F.array_sort(F.coalesce("held", F.array().cast(HELD))),
                                 lambda x: F.concat_ws(":", *[x[c] for c in HELD_FIELDS])),
                     ",").alias("counts"))
