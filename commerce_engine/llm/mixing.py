"""Operator 4: mixing sources to target weights by Pfair scheduling, in DataFrame functions.

Each source's documents, in a fixed random order, form blocks. A source with
weight w releases block k (from 0) at slot floor(k / w) and must have it placed
before slot ceil((k + 1) / w). Earliest deadline first over one slot at a time
meets every deadline when the weights add up to 1, so after any number of slots
each source is less than one block from its target.

Weights are whole shares s of a hyperperiod H = sum of shares, hence the schedule
repeats every H slots and a template of H slots says it all: block k of a source
stands in slot (k div s) * H + template slot of its block k mod s. The template is
one small row, folded with ``aggregate``; the documents are numbered and joined
to it. When a source has run out, its slots stay empty and the others keep their
proportions; every document is placed.

Numbering the documents of a source splits it into buckets of a hash order, so
that a source with a third of all rows is many groups: counts per bucket give
the number at which each bucket begins.

Edge cases: a null source is a source of its own (shown as null); null ids are
ordered first; repeated rows get places one after the other, in no particular
order among themselves; a null or empty text changes nothing; an empty table
gives an empty table. Sources without a given weight get one share. Extra columns
pass through; columns named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares that the default weights are scaled to.
SHARES = 1000
#: Sources that one template may hold; the template has one row.
MOST_SOURCES = 4096
#: Rows of one bucket of the hash order, about, if all were of one source.
BUCKET_ROWS = 20_000

ADDED = ["block", "release", "deadline", "slot"]


def default_shares(docs: DataFrame, total: int = SHARES) -> DataFrame:
    """(source, share): shares of ``total`` in proportion to the square root of each source's documents, at least 1.

    It flattens a corpus in which one source dominates. The roots are floored, so
    every engine gets the same shares.
    """
    counts = docs.groupBy("source").count()
    roots = counts.select("source", F.floor(F.sqrt("count")).cast("bigint").alias("root"))
    every = F.sum("root").over(Window.partitionBy())  # one row per source
    return roots.select("source", F.greatest(F.lit(1), F.floor(F.col("root") * total / every)).cast("bigint").alias("share"))


def template(shares: DataFrame) -> DataFrame:
    """(source, share, period, kth, release, deadline, at): one row per slot of the hyperperiod.

    A fold over the slots keeps the number of blocks that each source has placed;
    a slot goes to the released block with the earliest deadline, ties to the
    first source in order. ``shares`` must be positive whole numbers.
    """
    ordered = shares.agg(F.sort_array(F.collect_list(F.struct(F.col("source").alias("source"), F.col("share").cast("bigint").alias("share")))).alias("sources"))
    ordered = ordered.withColumn("period", F.aggregate("sources", F.lit(0).cast("bigint"), lambda t, s: t + s["share"]))
    ordered = ordered.where("period > 0").withColumn("sources", F.when(F.size("sources") <= MOST_SOURCES, F.col("sources")).otherwise(F.raise_error(F.lit(f"more than {MOST_SOURCES} sources"))))
    picks = F.expr(
        """
        aggregate(
          sequence(0L, period - 1),
          named_struct('placed', transform(sources, s -> 0L), 'order', cast(array() as array<int>)),
          (state, now) -> transform(
            array(array_min(filter(
              transform(sources, (s, i) -> named_struct(
                'deadline', (state.placed[i] + 1) * period div s.share + if((state.placed[i] + 1) * period % s.share > 0, 1L, 0L),
                'release', state.placed[i] * period div s.share,
                'i', i)),
              c -> c.release <= now))),
            best -> named_struct(
              'placed', transform(state.placed, (n, i) -> if(i = best.i, n + 1L, n)),
              'order', concat(state.order, array(best.i))))[0],
          state -> state.order)
        """
    )
    slots = ordered.select("sources", "period", F.posexplode(picks).alias("at", "i")).select(
        F.expr("sources[i].source").alias("source"), F.expr("sources[i].share").alias("share"), "period", F.col("at").cast("bigint").alias("at")
    )
    kth = F.row_number().over(Window.partitionBy("source").orderBy("at")) - 1
    return slots.withColumn("kth", kth.cast("bigint"))


def key_of(source: Column) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(docs: DataFrame, seed: int) -> DataFrame:
    """docs with ``mix_key`` and ``number``: the place of each row in its source's random order, from 0.

    Rows are dealt once, by source and bucket, to the window and the join alike.
    """
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    # The order is that of a digest, and a bucket is a range of it.
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    keyed = docs.withColumn("mix_digest", digest).withColumn("mix_key", key_of(F.col("source")))
    keyed = keyed.withColumn("mix_bucket", F.floor(F.conv(F.substring("mix_digest", 1, 8), 16, 10).cast("bigint") * buckets / F.lit(1 << 32)).cast("int"))
    counts = keyed.groupBy("mix_key", "mix_bucket").count()
    before = Window.partitionBy("mix_key").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("mix_key", "mix_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("mix_start"))
    inside = F.row_number().over(Window.partitionBy("mix_key", "mix_bucket").orderBy("mix_digest", "doc_id")) - 1
    joined = keyed.withColumn("mix_inside", inside).join(starts, ["mix_key", "mix_bucket"])
    return joined.withColumn("number", F.col("mix_start") + F.col("mix_inside")).drop("mix_digest", "mix_bucket", "mix_start", "mix_inside")


def schedule(docs: DataFrame, shares: DataFrame | None = None, block_docs: int = 1, seed: int = 20) -> DataFrame:
    """docs with block, release, deadline and slot; the mix is the order of (slot, place in the block).

    ``shares``: (source, share), whole numbers; default :func:`default_shares`.
    ``place`` is the document's place within its block of ``block_docs``.
    """
    docs = docs.drop(*ADDED, "place", "number")
    given = default_shares(docs) if shares is None else shares.select("source", "share")
    if shares is not None:  # sources without a weight still get a slot
        known = given.select(key_of(F.col("source")).alias("mix_key")).distinct()
        missing = docs.select("source").distinct().withColumn("mix_key", key_of(F.col("source"))).join(known, "mix_key", "left_anti")
        given = given.union(missing.select("source", F.lit(1).cast("bigint")))
    # At most one row per slot of the hyperperiod: shares and sources are bounded, so is this.
    slots = template(given).select(key_of(F.col("source")).alias("mix_key"), "share", "period", F.col("kth").alias("mix_kth"), "at")
    rows = numbered(docs, seed).withColumn("block", F.floor(F.col("number") / block_docs).cast("bigint")).withColumn("place", F.col("number") % block_docs)
    per_source = slots.groupBy("mix_key").agg(F.first("share").alias("share"), F.first("period").alias("period"))
    rows = rows.join(F.broadcast(per_source), "mix_key").withColumn("mix_kth", F.expr("block % share"))
    rows = rows.join(F.broadcast(slots.select("mix_key", "mix_kth", "at")), ["mix_key", "mix_kth"])
    whole = F.expr("(block div share) * period")
    return (
        rows.withColumn("slot", whole + F.col("at"))
        .withColumn("release", F.expr("block * period div share"))
        .withColumn("deadline", F.expr("(block + 1) * period div share + if((block + 1) * period % share > 0, 1L, 0L)"))
        .drop("mix_key", "mix_kth", "at", "share", "period", "number")
        .select(*docs.columns, "block", "place", "slot", "release", "deadline")
    )


def mixed(docs: DataFrame, shares: DataFrame | None = None, block_docs: int = 1, seed: int = 20) -> DataFrame:
    """The columns of ``docs``, its rows in mixed order over the partitions."""
    columns = docs.columns
    return schedule(docs, shares, block_docs, seed).orderBy("slot", "place").select(*columns)
