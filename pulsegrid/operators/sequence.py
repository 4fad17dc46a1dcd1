"""Ordered per-key windows that never put a whole key into one task.

The source computes lags, rolling means, row positions and runs over the
whole series of one subject. A plain ``Window.partitionBy(key)`` would make
one task hold a subject's entire series, and one subject may hold a large
share of all rows. Instead each key is cut into chunks of the (integral,
unique-per-key) ordering column, ``chunk = floor(order / chunk_rows)``:

1. a small chunk table holds per (key, chunk) the row count, the number of
   rows before the chunk (offset) and a dense index of non-empty chunks;
2. window expressions run per (key, chunk), which is bounded by
   ``chunk_rows`` rows;
3. the first ``halo`` rows of each chunk, whose frames reach back into
   earlier chunks, are recomputed on a small side table made of those head
   rows plus the ``halo`` rows that precede the chunk (taken from the tails
   of up to ``halo`` earlier non-empty chunks); the result is the other rows
   plus the recomputed heads (a union: no join back, no second shuffle).

The result is identical to one window over the whole key for frames that
look back at most ``halo`` rows.

Sizing: a key spanning order values [a, b] has (b - a) / chunk_rows chunks,
and the per-key window of the chunk table holds that many (tiny) rows. With
a per-subject step counter (dense order) that is rows / chunk_rows, e.g.
about 3 million chunk rows for a subject with 10^12 rows at the default
chunk size; an order column that is very sparse per key should be
re-based (or chunk_rows raised) so that chunks stay populated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 1 << 18


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def chunk_counts(df: DataFrame, key, order: str, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """(key..., _chunk, _cnt): rows per chunk (a partial aggregate). Where ``df``
    has a ``_chunk`` of its own, rows without order value are in no chunk."""
    keys = _keys(key)
    if "_chunk" in df.columns:
        return df.groupBy(*keys, "_chunk").agg(F.count(order).alias("_cnt")).where(F.col("_cnt") > 0)
    return (df.select(*keys, F.floor(F.col(order) / F.lit(chunk_rows)).alias("_chunk"))
            .groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_cnt")))


def chunk_table(df: DataFrame, key, order: str, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                counts: DataFrame | None = None) -> DataFrame:
    """(key..., _chunk, _cnt, _off, _ci, _nc): rows per chunk, rows before it, dense chunk index (1-based), chunks of the key.

    Built from a partial aggregate (or from ``counts`` computed elsewhere in
    the same pass), so it is tiny next to the rows (one row per
    ``chunk_rows`` order values at most per key)."""
    keys = _keys(key)
    if counts is None:
        counts = chunk_counts(df, keys, order, chunk_rows)
    cw = Window.partitionBy(*keys).orderBy("_chunk")
    return counts.select(
        *keys, "_chunk", "_cnt",
        F.coalesce(F.sum("_cnt").over(cw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("_off"),
        F.row_number().over(cw).alias("_ci"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("int").alias("_nc"),
    )


def ordered_window(df: DataFrame, key, order: str,
                   columns: Callable[[WindowSpec], dict[str, Column]],
                   halo: int, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                   position: str | None = "pos", carry: DataFrame | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """Add window columns ordered by ``order`` within ``key``.

    ``columns(w)`` returns named expressions over the window spec ``w``; their
    frames may look back at most ``halo`` rows (``lag(c, k)`` with k <= halo,
    ``rowsBetween(-k, 0)`` with k <= halo). ``position`` names an optional
    0-based row-position column (``row_number() - 1`` over the whole key).

    ``carry`` is an optional per-key table (one row per key, e.g. per-subject
    statistics) whose columns are attached to every row. It is joined to the
    small chunk table, so it reaches the rows through the (key, chunk)
    exchange the window needs anyway: no extra shuffle of the rows by key.
    ``counts`` optionally supplies the per-chunk row counts (``chunk_counts``)
    when a caller computes them in a shared pass. Rows that come with a
    ``_chunk`` column, dealt by (key, chunk), are not dealt again.
    """
    keys = _keys(key)
    src_cols = [c for c in df.columns if c != "_chunk"]
    chunks = chunk_table(df, keys, order, chunk_rows, counts)
    carried: list[str] = []
    if carry is not None:
        carried = [c for c in carry.columns if c not in keys]
        chunks = chunks.join(carry, keys, "left")
    base = df if "_chunk" in df.columns else df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_rows)))
    w = Window.partitionBy(*keys, "_chunk").orderBy(order)
    rows = base.join(chunks, [*keys, "_chunk"]).withColumn("_rn", F.row_number().over(w) - 1)
    exprs = columns(w)
    names = list(exprs)
    rows = rows.select("*", *[e.alias(n) for n, e in exprs.items()])

    if halo > 0:
        # one pass over the (few) rows near chunk borders emits both the
        # chunk-head rows to recompute and the halo copies for later chunks
        is_head = (F.col("_rn") < halo) & (F.col("_ci") > 1)
        is_tail = (F.col("_rn") >= F.col("_cnt") - halo) & (F.col("_ci") < F.col("_nc"))  # the last chunk's rows precede none
        tgt = F.struct(F.col("_ci").alias("_tci"), F.lit(False).alias("_halo"))
        empty = F.array().cast("array<struct<_tci:int,_halo:boolean>>")
        targets_arr = F.concat(
            F.when(is_head, F.array(tgt)).otherwise(empty),
            F.when(is_tail, F.transform(F.sequence(F.col("_ci") + 1, F.least(F.col("_ci") + halo, F.col("_nc"))),
                                        lambda t: F.struct(t.alias("_tci"), F.lit(True).alias("_halo"))))
            .otherwise(empty))
        border = (rows.where(is_head | is_tail)
                  .select(*src_cols, "_rn", (F.col("_off") + F.col("_rn")).alias("_g"),
                          F.explode(targets_arr).alias("_t"))
                  .select(*src_cols, "_rn", "_g", "_t._tci", "_t._halo"))
        targets = chunks.select(*keys, F.col("_ci").alias("_tci"), F.col("_chunk"), F.col("_off").alias("_toff"),
                                *carried)
        fix_in = (border.join(targets, [*keys, "_tci"])
                  .where(~F.col("_halo") | (F.col("_g") >= F.col("_toff") - halo))
                  .select(*src_cols, *carried, "_chunk", F.col("_toff").alias("_off"),
                          F.when(F.col("_halo"), F.lit(-1)).otherwise(F.col("_rn")).alias("_rn"), "_halo"))
        fixed = (fix_in.select("*", *[e.alias(n) for n, e in columns(w).items()])
                 .where(~F.col("_halo")).select(*src_cols, *carried, "_off", "_rn", *names))
        # rows whose frames stay inside their chunk are final; the chunk heads
        # come from the recomputed side table (a union, so the big side keeps
        # its (key, chunk) partitioning and is not shuffled again)
        kept = rows.where(~is_head).select(*src_cols, *carried, "_off", "_rn", *names)
        rows = kept.unionByName(fixed)
    else:
        rows = rows.select(*src_cols, *carried, "_off", "_rn", *names)

    if position:
        rows = rows.withColumn(position, F.col("_off") + F.col("_rn"))
    return rows.drop("_off", "_rn")


def longest_run(df: DataFrame, key, order: str, member: Column, name: str = "longest_run",
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Per key: length of the longest run of consecutive rows (by ``order``)
    where ``member`` is True. A null ``member`` breaks a run.

    Gaps-and-islands without a whole-key window: per chunk we keep the
    positions of the first/last breaking row and the longest gap between
    breaking rows inside the chunk (running max over the chunk window); the
    gaps that span chunk borders and the key's leading / trailing runs come
    from the small chunk table.
    """
    keys = _keys(key)
    brk = F.coalesce(~member, F.lit(True))
    d = df.select(*keys, order, brk.alias("_brk"))
    chunks = chunk_table(d, keys, order, chunk_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy(order)
    rows = (d.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_rows)))
            .withColumn("_rn", F.row_number().over(w) - 1))
    rows = rows.withColumn(
        "_prev", F.max(F.when(F.col("_brk"), F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    per_chunk = rows.groupBy(*keys, "_chunk").agg(
        F.min(F.when(F.col("_brk"), F.col("_rn"))).alias("_first"),
        F.max(F.when(F.col("_brk"), F.col("_rn"))).alias("_last"),
        F.max(F.when(F.col("_brk") & F.col("_prev").isNotNull(), F.col("_rn") - F.col("_prev") - 1)).alias("_inner"),
    )
    c = chunks.join(per_chunk, [*keys, "_chunk"])
    kw = Window.partitionBy(*keys).orderBy("_chunk")
    # global position of the previous breaking row before this chunk
    c = c.withColumn("_prev_last", F.max(F.when(F.col("_last").isNotNull(), F.col("_off") + F.col("_last")))
                     .over(kw.rowsBetween(Window.unboundedPreceding, -1)))
    c = c.withColumn("_cross", F.when(F.col("_first").isNotNull(),
                                      F.col("_off") + F.col("_first") - F.coalesce(F.col("_prev_last"), F.lit(-1)) - 1))
    out = c.groupBy(*keys).agg(
        F.sum("_cnt").alias("_n"),
        F.max(F.when(F.col("_last").isNotNull(), F.col("_off") + F.col("_last"))).alias("_lastg"),
        F.max("_inner").alias("_inner"),
        F.max("_cross").alias("_cross"),
    )
    trailing = F.col("_n") - 1 - F.coalesce(F.col("_lastg"), F.lit(-1))
    return out.select(*keys, F.greatest(trailing, F.coalesce(F.col("_inner"), F.lit(0)),
                                        F.coalesce(F.col("_cross"), F.lit(0))).cast("long").alias(name))



def attach_by_chunk(df: DataFrame, key, order: str, table: DataFrame,
                    chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Attach a per-key table (one row per key) to every row without a join
    on the key alone: the table is joined to the small (key, chunk) table
    and the rows meet it on (key, chunk), so a hot key's rows are spread
    over its chunks (an explicit, deterministic salt) instead of landing in
    one join partition."""
    keys = _keys(key)
    chunks = (df.select(*keys, F.floor(F.col(order) / F.lit(chunk_rows)).alias("_chunk")).distinct()
              .join(table, keys, "left"))
    return (df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_rows)))
            .join(chunks, [*keys, "_chunk"], "left").drop("_chunk"))
