"""Operator 11: what five filters do to each other, in every order of application.

Each text fails some of the filters A to E, which is a mask of five bits. The table
shrinks to cells (part, mask) with counts: at most 32 a part. Each cell folds across
the array of all 120 orders, a literal that travels with the plan: ``transform``
walks the orders, ``aggregate`` walks the five filters of one order, and the cell
becomes 600 structs weighted by its counts. The cells of a part, again at most 32,
merge by elementwise sums, and filters' Shapley sums are read from the merged array.

Filter E (identical to the text of a smaller id) compares SHA-256 digests. Digests are
grouped with their counts before the shuffle, so copies of any number arrive as one
row per input partition, language and mask; texts themselves are never shuffled.

Edge cases: a null text is empty and equals an empty one. A null language is the part
"". A row without an id counts as a document, carries no labels, never fails E and
makes no other fail it. Rows that repeat an id are documents of their own; equal ids
are not smaller than each other. Several labels of one id count as good (toxic) if one
of them says so; null labels say nothing. An empty table has no parts and no rows.
Columns other than doc_id, text, lang, quality and toxic are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
BLANKS = "\t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(text: Column) -> Column:
    """Bits 0 to 3 of the mask: which of the filters A to D a text fails."""
    words = F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " ", -1), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    # One lambda variable each, so that words are cut once and not once a mention.
    mask = F.transform(
        F.array(words),
        lambda w: F.transform(
            F.array(F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("distinct"))),
            lambda s: (s["n"] < 200).cast("int") + 2 * (100 * s["distinct"].cast("bigint") < 50 * s["n"].cast("bigint")).cast("int"),
        )[0],
    )[0]
    return mask + 4 * (100 * capitals.cast("bigint") > 3 * F.length(text).cast("bigint")).cast("int") + 8 * text.rlike("[#$%&*|]").cast("int")


def flagged(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): 1 or 0, one row per labelled id."""
    one = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    flags = labels.where("doc_id is not null").select(ids, *[F.coalesce(v, F.lit(False)).cast("bigint").alias(k) for k, v in one.items()])
    return flags.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the whole table in at most 32 rows a part."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    known = rows.join(flagged(labels), "doc_id", "left")
    zero = F.lit(0).cast("bigint")
    sums = [F.count("*").alias("n"), *[F.coalesce(F.sum(c), zero).alias(c) for c in ("good", "toxic")]]
    # Copies under one id first, then all copies: what the smallest id carries is exempt from E.
    per_id = known.groupBy("digest", "part", "mask", "doc_id").agg(*sums)
    no_id = F.col("doc_id").isNull()
    per_text = per_id.groupBy("digest", "part", "mask").agg(
        F.min("doc_id").alias("first"),
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")],
        *[F.min_by(c, "doc_id").alias(f"{c}_first") for c in ("n", "good", "toxic")],
        F.coalesce(F.sum(F.when(no_id, F.col("n"))), zero).alias("n_free"),
    )
    smallest = F.min("first").over(Window.partitionBy("digest"))  # one row per language of a text
    per_text = per_text.withColumn("smallest", smallest)
    is_first = F.coalesce(F.col("first") == F.col("smallest"), F.lit(False))
    passing = {c: F.when(is_first, F.col(f"{c}_first")).otherwise(0) for c in ("n", "good", "toxic")}
    passing["n"] = passing["n"] + F.col("n_free")

    def side(bit: int) -> Column:
        counts = [(passing[c] if bit == 0 else F.col(c) - passing[c]).cast("bigint").alias(c) for c in ("n", "good", "toxic")]
        return F.struct((F.col("mask") + 16 * bit).alias("mask"), *counts)

    split = per_text.select("part", F.explode(F.array(side(0), side(1))).alias("cell")).select("part", "cell.*")
    return split.where("n > 0").groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


ORDERS = [list(p) for p in permutations(range(len(FILTERS)))]


def folded(cell_mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """The 600 structs of one cell: all orders, filter by filter."""
    zero = F.lit(0).cast("bigint")
    orders = F.lit(ORDERS).cast("array<array<int>>")

    def weight(test: Column, by: Column) -> Column:
        return F.when(test, by).otherwise(zero)

    def fold(order: Column) -> Column:
        start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<{', '.join(f'{c}: bigint' for c in COUNTS)}>>").alias("steps"))

        def step(state: Column, f: Column) -> Column:
            bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), f + 1)
            fails = cell_mask.bitwiseAND(bit) != 0
            here = state["alive"] & fails
            values = [
                weight(state["alive"] & ~fails, n), weight(here, n), weight(~state["alive"] & fails, n),
                weight(cell_mask == bit, n), weight(here, good), weight(here, toxic),
            ]
            counts = F.struct(*[v.alias(c) for v, c in zip(values, COUNTS)])
            return F.struct((state["alive"] & ~fails).alias("alive"), F.array_append(state["steps"], counts).alias("steps"))

        return F.aggregate(order, start, step, lambda state: state["steps"])

    return F.flatten(F.transform(orders, fold))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts: 600 rows for each part."""
    structs = cells(docs, labels).select("part", folded(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps"))

    def added(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    # At most 32 arrays a part meet here, one for each mask.
    merged = structs.groupBy("part").agg(F.collect_list("steps").alias("all")).select(
        "part", F.aggregate(F.slice("all", 2, 32), F.element_at("all", 1), lambda x, y: F.zip_with(x, y, added)).alias("steps")
    )
    letters = F.lit([f for order in ORDERS for f in order]).cast("array<int>")
    removed = F.arrays_zip(F.transform("steps", lambda s: s["removed"]).alias("removed"), letters.alias("f"))

    def removed_by(i: int) -> Column:
        return F.aggregate(removed, F.lit(0).cast("bigint"), lambda total, s: total + F.when(s["f"] == i, s["removed"]).otherwise(0))

    shapley = F.array(*[removed_by(i) for i in range(len(FILTERS))])
    named = merged.select("part", "steps", shapley.alias("shapley")).select("part", "shapley", F.posexplode("steps").alias("at", "s"))
    orders = F.lit(["".join(FILTERS[f] for f in order) for order in ORDERS])
    order = F.element_at(orders, F.floor(F.col("at") / 5).cast("int") + 1)
    f = F.element_at(letters, F.col("at") + 1)
    return named.select(
        "part",
        order.alias("filter_order"),
        (F.col("at") % 5 + 1).cast("int").alias("step"),
        *[F.col(f"s.{c}") for c in COUNTS],
        F.element_at("shapley", f + 1).alias("shapley"),
    )


#: The same counts by one join of cells with orders and steps: parts are few, cells at most 32 a part.
AUDIT_SQL = r"""
WITH
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
m AS (
  SELECT w.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(words) < 200,
     100 * len(list_distinct(words)) < 50 * len(words),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
     regexp_matches(t, '[#$%&*|]'),
     coalesce(w.doc_id > first, false)] AS f
  FROM w JOIN firsts USING (t) LEFT JOIN l ON w.doc_id = l.doc_id),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, f),
e AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT [a.i, b.i, g.i, h.i, k.i] AS p FROM e a, e b, e g, e h, e k
  WHERE a.i NOT IN (b.i, g.i, h.i, k.i) AND b.i NOT IN (g.i, h.i, k.i) AND g.i NOT IN (h.i, k.i) AND h.i <> k.i),
s AS (SELECT p, i AS step, p[i] AS filter, p[1:i - 1] AS earlier FROM o, e),
x AS (
  SELECT part, p, step, filter, n, good, toxic, f[filter] AS fails,
    len(list_filter(earlier, lambda j: f[j])) > 0 AS gone, len(list_filter(f, lambda b: b)) AS failed
  FROM c, s),
r AS (
  SELECT part, p, step, filter,
    sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM x GROUP BY part, p, step, filter)
SELECT part, list_aggregate(list_transform(p, lambda i: substr('ABCDE', i, 1)), 'string_agg', '') AS filter_order,
  CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""
