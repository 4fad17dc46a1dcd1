"""Mixing sources to target weights by Pareto order sampling.

Targets: the mix takes ``share`` times all sizes; sources share it by weight,
a target stops at ``most`` times its source's size and the excess is reshared
by weight until none is above. With the sources in order of (stop / weight)
that fixed point has a closed form: the level is the largest of
(what is left / weights left) over the prefixes of stopped sources.

Documents: a source that must give ``rho`` times its size takes floor(rho)
certain whole copies of each document; the rest is a Pareto sample with
unequal inclusion. A document's inclusion is proportional to its size, as far
as it stays below 1 (larger ones are certain), and the factor is such that the
expected words are those still due. Documents are ranked by odds(u) /
odds(inclusion), u a hash of the document, certain ones first, and taken in
that order while their words fit into what is due. Then rounds step over what
does not fit and go on down the order, with documents of at most half the
words still missing, or of at most all of them if none is that small; a round
or two halve what is missing, until nothing left fits. The last place goes to
the document whose size comes nearest to the words still missing (if it comes
nearer than taking none), so a heavy-tailed source still meets its target.
Words, not documents, are the fixed size, since targets are in words.

A source's rows are never in one task: positions in the order are found in
blocks of the rank's logarithm, whose density is bounded whatever the sizes,
and shifted by the words of earlier blocks. Equal rows are counted first and
numbered, so copies have draws of their own. Rows: null texts have size 0 and are taken 0; null
sources form one source, the last; ties in rank are broken by key and size;
repeated rows are rows of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import WORD, stage_table, uniform

BLOCK_ROWS = 4096
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """One row per source: source_size, rows, target. ``sizes`` has columns
    source and size. Windows run over one row a source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    s = s.withColumn("at", F.row_number().over(by_name) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                       (F.col("at") % len(weights) + 1).cast("int")))
    s = s.withColumn("stop", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("stop") / F.col("w"), "at")
    every = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(every) \
        - F.coalesce(F.sum("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights_left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", left / weights_left).withColumn("level", F.max("level").over(every))
    return s.select("source", "source_size", "n", F.least("stop", F.col("w") * F.col("level")).alias("target"))


def inclusion_factors(sizes: DataFrame, due: DataFrame) -> DataFrame:
    """Per source (__s): factor, so that the sum of size * min(1, factor *
    size) is ``due``. The windows run over a source's distinct sizes: with the
    sizes from large to small, the first one that its factor leaves below 1
    ends the certain ones."""
    by_size = sizes.where("size > 0").groupBy("__s", "size").agg(F.count(F.lit(1)).alias("__n")).join(due, "__s")
    larger = Window.partitionBy("__s").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("__s").orderBy(F.desc("size")).rowsBetween(0, Window.unboundedFollowing)
    words = F.col("size").cast("double") * F.col("__n")
    factor = (F.col("due") - F.coalesce(F.sum(words).over(larger), F.lit(0.0))) / F.sum(words * F.col("size")).over(rest)
    found = by_size.withColumn("factor", factor).where(F.col("factor") * F.col("size") < 1)
    return found.groupBy("__s").agg(F.max_by("factor", "size").alias("factor"))


def _taken() -> Column:
    """Whether a round took a row: it is no larger than the round's limit and
    stands before the round's end in the order."""
    return F.exists("cuts", lambda c: (F.col("size") <= c["limit"]) & (
        (F.col("block") < c["block"]) | ((F.col("block") == c["block"]) & (F.col("at") < c["at"]))))


def _fill(pool: DataFrame, blocks: DataFrame, missing: DataFrame) -> DataFrame:
    """One row per source: __s, missing (words that no row left fits into) and
    cuts (limit, block, at of each round). ``pool`` holds the rows not yet
    taken; a round sums them by block and looks into one block a source."""
    state = stage_table(missing.select("__s", F.col("missing").cast("double").alias("missing"), F.expr(
        "cast(array() as array<struct<limit: double, block: bigint, at: int>>)").alias("cuts")), "mix-fill")
    source = Window.partitionBy("__s")
    while True:
        rest = pool.join(blocks.join(state, "__s"), ["__s", "block"]).where((F.col("size") <= F.col("missing")) & ~_taken())
        small = F.when(F.col("size") * 2 <= F.col("missing"), F.col("size")).otherwise(0)
        sums = stage_table(rest.groupBy("__s", "block").agg(F.max("missing").alias("missing"), F.sum(small).alias("small"), F.sum("size").alias("all")), "mix-sums")
        if sums.isEmpty():
            return state
        half = F.sum("small").over(source) > 0
        sums = sums.withColumn("limit", F.when(half, F.col("missing") / 2).otherwise(F.col("missing"))).withColumn(
            "in_block", F.when(half, F.col("small")).otherwise(F.col("all")))
        sums = sums.withColumn("before", F.sum("in_block").over(source.orderBy("block")) - F.col("in_block"))
        edge = sums.where((F.col("before") <= F.col("missing")) & (F.col("before") + F.col("in_block") > F.col("missing")))
        within = rest.drop("missing", "cuts").join(edge.select("__s", "block", "missing", "limit", "before"), ["__s", "block"]).where("size <= limit")
        to = F.col("before") + F.sum("size").over(Window.partitionBy("__s", "block").orderBy("at"))
        ends = within.withColumn("to", to).groupBy("__s", "block").agg(
            F.min(F.when(F.col("to") > F.col("missing"), F.col("at"))).alias("at"),
            F.coalesce(F.max(F.when(F.col("to") <= F.col("missing"), F.col("to"))), F.max("before")).alias("got"))
        round_ = sums.groupBy("__s").agg(F.max("limit").alias("limit"), F.sum("in_block").alias("every")).join(ends, "__s", "left")
        # without an end, all rows within the limit were taken
        cut = F.struct("limit", F.coalesce("block", F.lit(2 ** 62)).alias("block"), F.coalesce("at", F.lit(0)).alias("at"))
        round_ = round_.select("__s", F.coalesce("got", "every").alias("got"), cut.alias("cut"))
        state = stage_table(state.join(round_, "__s", "left").select(
            "__s", (F.col("missing") - F.coalesce("got", F.lit(0))).alias("missing"),
            F.when(F.col("cut").isNull(), F.col("cuts")).otherwise(F.array_append("cuts", F.col("cut"))).alias("cuts")), "mix-fill")


def mix_sources(df: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    """One row per input row: key, size, source_size, target, taken (copies
    times size), then source, copies (whole copies the mix takes), inclusion
    (of the copy that is drawn; null where none is), rank and text_hash
    (xxhash64 of the text)."""
    told = df.select(F.col(key).alias("k"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("__hash"))
    # equal rows: counted, dealt in chunks, and numbered inside a chunk
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / BLOCK_ROWS))).alias("__chunk")
    equal = told.groupBy("k", "source", "size", "__hash").agg(F.count(F.lit(1)).alias("__n")).select("*", chunk).repartition("k", "__hash", "__chunk")
    first = F.col("__chunk") * BLOCK_ROWS
    number = F.explode(F.sequence(first, F.least(first + BLOCK_ROWS, F.col("__n")) - 1)).alias("__number")
    docs = stage_table(equal.select("k", "source", "size", "__hash", number), "mix-sizes")
    targets = source_targets(docs, weights, share, most)
    # the name is null-safe: a missing source joins the source of nulls
    named = lambda d: d.withColumn("__s", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rho = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = named(targets).drop("source").withColumn("whole", F.floor(rho)).withColumn(
        "due", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
    t = t.join(inclusion_factors(named(docs), t.select("__s", "due")), "__s", "left")
    # log-odds of a uniform draw have a density of at most 1/4, so a block holds about BLOCK_ROWS rows or fewer
    t = t.withColumn("width", F.least(F.lit(8.0), F.lit(4.0 * BLOCK_ROWS) / F.col("n")))
    u = uniform(F.col("k"), seed, F.col("size"), F.col("__hash"), F.col("__number"))
    # rows meet their source's targets by (source, salt), so a large source is in many tasks
    t = t.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    ranked = named(docs).withColumn("u", u).withColumn("__salt", F.floor(F.col("u") * SALTS).cast("int"))
    ranked = ranked.join(t, ["__s", "__salt"]).drop("__salt")
    ranked = ranked.withColumn("p", F.when(F.col("due") > 0, F.least(F.lit(1.0), F.col("factor") * F.col("size"))))
    odds = F.log(F.col("u") / (1 - F.col("u")))
    ranked = ranked.withColumn("rank", F.when(F.col("p") >= 1, odds - 1000).when(F.col("p") > 0, odds - F.log(F.col("p") / (1 - F.col("p")))))
    ranked = ranked.withColumn("block", F.floor(F.coalesce("rank", odds) / F.col("width")))
    inside = Window.partitionBy("__s", "block").orderBy("rank", "k", "size", "__hash", "__number")
    ranked = ranked.withColumn("at", F.row_number().over(inside)).withColumn(
        "words", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = stage_table(ranked, "mix-ranked")
    blocks = ranked.groupBy("__s", "block").agg(F.sum("size").alias("in_block"))
    earlier = F.sum("in_block").over(Window.partitionBy("__s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("__s", "block", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    fits = (F.col("p") > 0) & (F.col("words") + F.col("earlier") <= F.col("due"))
    placed = ranked.join(blocks, ["__s", "block"]).withColumn("fits", fits)
    missing = placed.groupBy("__s").agg((F.max("due") - F.coalesce(
        F.max(F.when(F.col("fits"), F.col("words") + F.col("earlier"))), F.lit(0))).alias("missing"))
    pool = stage_table(placed.where((F.col("p") > 0) & ~F.col("fits") & (F.col("size") > 0))
                       .select("__s", "block", "at", "rank", "size"), "mix-left")
    state = _fill(pool, blocks.select("__s", "block"), missing)
    last = (pool.join(blocks.select("__s", "block").join(state, "__s"), ["__s", "block"]).where(~_taken())
            .withColumn("off", F.abs(F.col("size") - F.col("missing")))
            .groupBy("__s").agg(F.min(F.struct("off", "rank", "block", "at")).alias("b"), F.max("missing").alias("missing"))
            .where(F.col("b.off") < F.col("missing"))
            .select("__s", F.col("b.block").alias("block"), F.col("b.at").alias("last_at")))
    out = placed.join(blocks.select("__s", "block").join(state.select("__s", "cuts"), "__s"), ["__s", "block"]).join(last, ["__s", "block"], "left")
    chosen = F.col("fits") | ((F.col("p") > 0) & (F.col("size") > 0) & _taken()) | (F.col("at") == F.col("last_at"))
    copies = (F.col("whole") + F.coalesce(chosen, F.lit(False)).cast("long")).cast("long")
    return out.select(F.col("k").alias(key), "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                      F.col("source").alias(source), copies.alias("copies"), F.col("p").alias("inclusion"), "rank", F.col("__hash").alias("text_hash"))
