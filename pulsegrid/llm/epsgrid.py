"""Embedding near-duplicates by an epsilon grid order join.

Vectors of unit length reach a cosine c when they lie within
``eps = sqrt(2 - 2c)``. Equal vectors of a label form one class with a count.
Classes are sorted by label and by the grid cell, of side eps, of their
leading principal coordinates, and the sequence is cut into blocks with their
bounding boxes. Intervals of the sequence are joined recursively: a pair of
intervals is split FAN ways on either side, and pairs whose boxes are more
than eps apart are skipped, down to pairs of blocks, which are compared whole
in double precision. Projections never lengthen a distance, so no link is
lost whatever the basis; the basis alone comes from a bounded sample
(``PCA_ROWS`` vectors by hash of the key).

A block pair returns each vector's number of links and a spanning forest of
them, never the pairs, so a dense group costs rows in proportion to its size.

Rows: vectors that are null, empty, zero or hold a null or non-finite
component, null labels and null keys link with nothing; vectors of different
length do not link; repeated rows are vectors of their own; ties (cosine just
at the threshold) link; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow, stage_table
from pulsegrid.llm.components import connected_components, local_roots

AXES, BLOCK, FAN, PCA_ROWS = 6, 512, 8, 4096


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(vectors: list) -> dict[int, np.ndarray]:
    """Leading principal directions, by the vectors' length."""
    out = {}
    for d in {len(v) for v in vectors}:
        u = _unit(np.array([v for v in vectors if len(v) == d], np.float64))
        u = u - u.mean(0)
        out[d] = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, :AXES].copy()
    return out


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 cosine: float = 0.98) -> DataFrame:
    """One row per input row: key, n_links (other vectors linked directly),
    component_id (smallest key reachable) and kept (key equals it)."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    near = eps * eps + 1e-9
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("k").isNotNull() & F.col("l").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).alias("k"), F.col(label).alias("l"), F.col(vector).alias("v")).select(
        "k", "l", "v", F.coalesce(fine, F.lit(False)).alias("fine"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    wide = df.schema[vector].dataType.elementType.simpleString() != "float"
    kind = np.float64 if wide else np.float32
    classes = stage_table(rows.where("fine").groupBy("l", "h1", "h2").agg(
        F.min("k").alias("low"), F.count(F.lit(1)).alias("n"), F.any_value("v").alias("v")).withColumn("k", F.xxhash64("l", "h1", "h2")), "vector-classes")
    axes = principal_axes([r["v"] for r in classes.select("k", "v").orderBy(F.xxhash64("k"), "k").limit(PCA_ROWS).collect()])
    ltype, ktype = df.schema[label].dataType.simpleString(), "bigint"

    def cells(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.names.index("v"))
            sizes = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            begins = np.concatenate(([0], np.cumsum(sizes)))
            at = [None] * len(batch)
            for d in np.unique(sizes):
                some = np.flatnonzero(sizes == d)
                u = _unit(flat[begins[some][:, None] + np.arange(d)])
                place = u @ axes[int(d)] if int(d) in axes else u[:, :AXES]
                place = np.pad(place, ((0, 0), (0, AXES - place.shape[1])))
                for i, x in zip(some, place, strict=True):
                    at[i] = x
            at = np.array(at, float).reshape(len(batch), AXES)
            arrays = [batch.column(batch.schema.names.index(c)) for c in ("l", "k", "n")] + [pa.array(sizes, pa.int32())]
            arrays += [pa.array(np.floor(at[:, a] / max(eps, 1e-6)).astype(np.int64)) for a in range(AXES)]
            arrays += [pa.array(list(at), pa.list_(pa.float64())), vectors]
            yield pa.RecordBatch.from_arrays(arrays, ["l", "k", "n", "d", *[f"c{a}" for a in range(AXES)], "at", "v"])

    cell_names = [f"c{a}" for a in range(AXES)]
    celled = map_arrow(classes.select("l", "k", "n", "v"), cells,
                       f"l {ltype}, k {ktype}, n long, d int, {', '.join(c + ' long' for c in cell_names)}, at array<double>, v {rows.schema['v'].dataType.simpleString()}")
    order = ["l", "d", *cell_names, "k"]
    sequence = celled.repartitionByRange(*order).sortWithinPartitions(*order)
    box_names = [f"{side}{a}" for side in ("lo", "hi") for a in range(AXES)]

    def blocks(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list = []

        def block():
            nonlocal number
            number += 1
            at = np.array([r[5] for r in held], float)
            out = {"block": [(part << 32) + number], "l": [held[0][0]], "d": [held[0][3]], "size": [len(held)]}
            out |= {f"lo{a}": [at[:, a].min()] for a in range(AXES)} | {f"hi{a}": [at[:, a].max()] for a in range(AXES)}
            out |= {"ks": [[r[1] for r in held]], "ns": [[r[2] for r in held]],
                    "vs": [np.array([r[4] for r in held], kind).tobytes()]}
            held.clear()
            return pa.RecordBatch.from_pydict(out, schema=arrow)

        arrow = pa.schema([("block", pa.int64()), ("l", batch_type["l"]), ("d", pa.int32()), ("size", pa.int32()),
                           *[(c, pa.float64()) for c in box_names], ("ks", pa.list_(batch_type["k"])), ("ns", pa.list_(pa.int64())), ("vs", pa.binary())])
        for batch in batches:
            vectors, at = batch.column("v"), batch.column("at")
            l, k, n, d = (batch.column(c).to_pylist() for c in ("l", "k", "n", "d"))
            for i in range(len(batch)):
                if held and (len(held) == BLOCK or held[0][0] != l[i] or held[0][3] != d[i]):
                    yield block()
                held.append((l[i], k[i], n[i], d[i], vectors[i].values.to_numpy(), at[i].values.to_numpy()))
        if held:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = {"l": to_arrow_type(df.schema[label].dataType), "k": pa.int64()}
    data = stage_table(map_arrow(sequence.select("l", "k", "n", "d", "v", "at"), blocks,
                                 f"block long, l {ltype}, d int, size int, {', '.join(c + ' double' for c in box_names)}, ks array<{ktype}>, ns array<long>, vs binary"), "vector-blocks")

    # intervals of the sequence: level g holds FAN ** g blocks each
    at = F.row_number().over(Window.partitionBy("l", "d").orderBy("block")) - 1
    heads = stage_table(data.select("block", "l", "d", at.cast("long").alias("at"), *box_names), "vector-boxes")
    most = heads.agg(F.max("at")).first()[0]
    levels = 0
    while most is not None and most >= FAN ** levels:
        levels += 1

    def boxes(g: int, i: str) -> DataFrame:
        agg = [F.min(c).alias(f"{c}_{i}") if c.startswith("lo") else F.max(c).alias(f"{c}_{i}") for c in box_names]
        return heads.groupBy("l", "d", F.floor(F.col("at") / FAN ** g).alias(i)).agg(*agg)

    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"lo{a}_i") - F.col(f"hi{a}_j"), F.col(f"lo{a}_j") - F.col(f"hi{a}_i")), 2) for a in range(AXES)), F.lit(0.0))
    pairs = heads.select("l", "d", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j")).distinct()
    for g in range(levels - 1, -1, -1):
        kids = F.sequence(F.lit(0), F.lit(FAN - 1))
        pairs = (pairs.select("l", "d", (F.col("i") * FAN).alias("i"), "j", F.explode(kids).alias("x"))
                 .select("l", "d", (F.col("i") + F.col("x")).alias("i"), (F.col("j") * FAN).alias("j"), F.explode(kids).alias("y"))
                 .select("l", "d", "i", (F.col("j") + F.col("y")).alias("j")).where("i <= j"))
        pairs = pairs.join(boxes(g, "i"), ["l", "d", "i"]).join(boxes(g, "j"), ["l", "d", "j"]).where(gap <= near).select("l", "d", "i", "j")
        pairs = stage_table(pairs, "interval-pairs")
    named = heads.select("l", "d", "at", "block")
    pairs = (pairs.join(named.select("l", "d", F.col("at").alias("i"), F.col("block").alias("a")), ["l", "d", "i"])
             .join(named.select("l", "d", F.col("at").alias("j"), F.col("block").alias("b")), ["l", "d", "j"]).select("a", "b"))
    side = lambda s: data.select(F.col("block").alias(s), F.col("d").alias(f"d{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("ks", "ns", "vs")])
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def compare(batches):
        for batch in batches:
            for row in range(len(batch)):
                get = lambda c: batch.column(c)[row]  # noqa: B023, E731
                d, same = get("da").as_py(), get("a") == get("b")
                ka, kb = (np.asarray(get(c).values.to_pylist(), object) for c in ("ks_a", "ks_b"))
                na, nb = (get(c).values.to_numpy() for c in ("ns_a", "ns_b"))
                ua, ub = (_unit(np.frombuffer(get(c).as_buffer(), kind).reshape(-1, d)) for c in ("vs_a", "vs_b"))
                link = ua @ ub.T >= cosine
                if same:
                    np.fill_diagonal(link, False)
                if not link.any():
                    continue
                left, right = local_roots(link, same)
                every = np.concatenate((ka, kb))
                out = [(k, c, every[r]) for k, c, r in zip(ka, link @ nb, left, strict=True) if c]
                if not same:
                    out += [(k, c, every[r]) for k, c, r in zip(kb, link.T @ na, right, strict=True) if c]
                a, c, r = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, batch_type["k"]), pa.array(c, pa.int64()), pa.array(r, batch_type["k"])], ["k", "links", "root"])

    found = stage_table(map_arrow(joined, compare, f"k {ktype}, links long, root {ktype}"), "vector-links")
    comp = connected_components(found.select(F.col("k").alias("a"), F.col("root").alias("b")), "vector-components")
    counts = found.groupBy("k").agg(F.sum("links").alias("links"))
    classes = stage_table(classes.select("l", "h1", "h2", "low", "k", "n").join(counts, "k", "left")
                          .join(comp.select(F.col("node").alias("k"), F.col("component").alias("c")), "k", "left")
                          .withColumn("c", F.coalesce("c", "k")), "vector-labels")
    names = classes.groupBy("c").agg(F.min("low").alias("component"))
    classes = classes.join(names, "c").select("l", "h1", "h2", F.lit(True).alias("fine"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component")
    out = rows.select("k", "l", "h1", "h2", "fine").join(classes, ["l", "h1", "h2", "fine"], "left")
    out = out.select(F.col("k").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "k").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
