"""Near-duplicate documents by bottom-k sketches from one hash function.

1. Each text's set of word shingles is hashed once; its k smallest values are
   its sketch. Texts with equal sets form a class with one representative.
2. Retained values form inverted lists. Two sets that reach the similarity
   share ``overlap_floor(k)`` of the k smallest values of their union but for
   a probability below MISS, so a representative is listed only under its
   rarest values, as many as leave that overlap no way past them; a value
   that one representative holds lists nothing.
3. Each list pairs its members with two hubs; the sketch of the union
   estimates the similarity and filters; the pairs left are verified on full
   shingle sets and linked. Then members still outside
   the component of their list's hub are paired with all members of other
   components in the list, filtered and verified the same way. Pairs inside a
   component are never formed, so a group of copies costs as many pairs as it
   has members, and no link between different components is missed.

Rows: texts without words are linked with nothing and kept; a row without a
key links like any other but is nobody's component; rows that share a key are
told apart by their texts; repeated rows share their verdict; an empty table gives an empty table; very long texts are hashed
whole, about a megabyte at a time. Only the named columns are read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_arrow, shingle_sets, stage_table
from pulsegrid.llm.components import connected_components, local_roots

K, WIDTH, PERCENT, MISS = 64, 5, 75, 1e-8
SHORT, MEMBERS, MATCHES = 32, 128, 1 << 21
IDS_TO_BROADCAST = 1_000_000


def overlap_floor(k: int, percent: int, miss: float = MISS) -> int:
    """Largest t for which fewer than t common values among the union's k
    smallest have a probability below ``miss`` at the given similarity."""
    p, below, t = percent / 100, 0.0, 0
    while t < k:
        below += comb(k, t) * p ** t * (1 - p) ** (k - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def sketches(df: DataFrame, key: str, text: str, k: int, width: int) -> DataFrame:
    """key, th (hash of the text), n (set size), h1 and h2 (128 bits of the
    whole set), sketch."""
    kind = df.schema[key].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            n, h1, h2, values = [], [], [], []
            for _, s in shingle_sets(batch.column(1), width):
                n.append(len(s))
                h1.append(int(s.sum(dtype=np.uint64)) if len(s) else 0)
                h2.append(int(np.bitwise_xor.reduce(s * np.uint64(0xD6E8FEB86659FD93) ^ (s >> np.uint64(29)))) if len(s) else 0)
                values.append((s[:k] >> np.uint64(1)).astype(np.int64))
            ends = np.cumsum([0, *map(len, values)])
            flat = pa.array(np.concatenate(values) if values else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(np.array(h1, np.uint64).view(np.int64)),
                 pa.array(np.array(h2, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                ["key", "th", "n", "h1", "h2", "sketch"])

    return map_arrow(df.select(key, text, F.xxhash64(text)), rows, f"key {kind}, th long, n long, h1 long, h2 long, sketch array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full sets reach the similarity."""
    both = (pairs.select("a", "b").join(sets.select(F.col("key").alias("a"), F.col("keys").alias("ka")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("keys").alias("kb")), "b"))

    def test(batches):
        for batch in batches:
            names = batch.schema.names
            ka, kb = batch.column(names.index("ka")), batch.column(names.index("kb"))
            hold = []
            for x, y in zip(ka, kb, strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)))
                common = int((both[1:] == both[:-1]).sum())
                hold.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(names.index("a")), batch.column(names.index("b"))], ["a", "b"]).filter(pa.array(hold, pa.bool_()))

    return map_arrow(both, test, f"a {pairs.schema['a'].dataType.simpleString()}, b {pairs.schema['b'].dataType.simpleString()}")


def _overlaps(ka, ra, na: int, kb, rb, nb: int) -> np.ndarray:
    """Sizes of the intersections of na sets with nb sets, given as sorted
    (key, row) lists, a bounded number of matches at a time."""
    out = np.zeros(na * nb, np.int64)
    lo, hi = np.searchsorted(kb, ka, "left"), np.searchsorted(kb, ka, "right")
    size = np.cumsum(hi - lo)
    at = 0
    while at < len(ka):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + MATCHES, "right")))
        n = (hi - lo)[at:to]
        place = np.repeat(lo[at:to] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        out += np.bincount(np.repeat(ra[at:to], n) * nb + rb[place], minlength=na * nb)
        at = to
    return out.reshape(na, nb)


def _family_links(family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """A spanning forest (a, b) of the links between members of a hub's lists
    that lie in different components. Members are cut into blocks by whether
    they are home, by size class and by hash; pairs of blocks that are all
    home, or too unlike in size, are skipped; a pair of blocks gives fewer
    edges than it has members."""
    f = family.withColumn("part", F.floor(F.log2(F.col("n").cast("double")) * 2).cast("int") * 2 + F.col("at_home"))
    blocks = f.groupBy("hub", "part").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("blocks"))
    f = f.join(blocks, ["hub", "part"]).withColumn("block", F.struct("part", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("number")))
    heads = f.groupBy("hub", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("at_home").alias("home"))
    x, y = (heads.select("hub", *[F.col(c).alias(c + s) for c in ("block", "lo", "hi", "home")]) for s in ("_x", "_y"))
    pairs = x.join(y, "hub").where((F.col("block_x") <= F.col("block_y")) & (F.col("home_x") + F.col("home_y") < 2)
                                   & (F.col("hi_x") * 100 >= F.col("lo_y") * percent) & (F.col("hi_y") * 100 >= F.col("lo_x") * percent))
    members = stage_table(f.join(sets, "key").groupBy("hub", "block").agg(F.collect_list(F.struct("key", "c", "keys")).alias("m")), "family-blocks")
    side = lambda s: members.select("hub", F.col("block").alias("block" + s), F.col("m").alias("m" + s))
    both = pairs.select("hub", "block_x", "block_y").join(side("_x"), ["hub", "block_x"]).join(side("_y"), ["hub", "block_y"])
    kind = family.schema["key"].dataType.simpleString()

    def compare(batches):
        for batch in batches:
            for i in range(len(batch)):
                part = []
                for name in ("m_x", "m_y"):
                    m = batch.column(batch.schema.names.index(name)).slice(i, 1).flatten()
                    sizes = np.array([len(b.as_buffer()) // 8 for b in m.field("keys")], np.int64)
                    keys = np.concatenate([np.frombuffer(b.as_buffer(), np.uint64) for b in m.field("keys")])
                    rows = np.repeat(np.arange(len(sizes)), sizes)
                    order = np.argsort(keys, kind="stable")
                    part.append((m.field("key"), np.array(m.field("c").to_pylist(), object), sizes, keys[order], rows[order]))
                (kx, cx, nx, ax, rx), (ky, cy, ny, ay, ry) = part
                common = _overlaps(ax, rx, len(nx), ay, ry, len(ny))
                link = 100 * common >= percent * (nx[:, None] + ny[None, :] - common)
                link &= cx[:, None] != cy[None, :]
                if not link.any():
                    continue
                same = batch.column("block_x")[i] == batch.column("block_y")[i]
                every = kx.to_pylist() + ky.to_pylist()
                left, right = local_roots(link, same)
                roots = left if same else np.concatenate((left, right))
                a, b = zip(*[(every[j], every[r]) for j, r in enumerate(roots) if j != r], strict=True)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, key_type), "b": pa.array(b, key_type)})

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(family.schema["key"].dataType)
    return map_arrow(both.select("block_x", "block_y", "m_x", "m_y"), compare, f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, width: int = WIDTH,
                    percent: int = PERCENT, inner: bool = False) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest key
    reachable by links) and kept (key equals component_id). Classes and links
    go by the texts' hashes, so rows that share a key or have none take part
    as what they are. With ``inner`` also text_hash (xxhash64 of the text) and
    component (a number that a component's rows share, null without words)."""
    floor = overlap_floor(k, percent)
    docs = stage_table(sketches(df, key, text, k, width), "sketches")
    reps = stage_table(docs.where("n > 0").groupBy("n", "h1", "h2").agg(
        F.min("th").alias("key"), F.min("key").alias("low"), F.any_value("sketch").alias("sketch")), "classes")
    need = lambda n: F.least(F.ceil(n * percent / 100), F.lit(floor))

    # inverted lists of the rarest retained values
    listed = reps.select("key", F.explode("sketch").alias("value"))
    shared = listed.groupBy("value").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    mine = (listed.join(shared, "value").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("docs", "value"))).alias("values"))
            .join(reps.select("key", "n"), "key"))  # at most k values a key
    common = F.aggregate("values", F.lit(0.0), lambda x, v: x + F.log(v["docs"].cast("double"))).alias("common")
    lists = stage_table(mine.withColumn("take", F.size("values") - need(F.col("n")) + 1).where("take > 0")
                        .select("key", "n", common, F.explode(F.slice(F.col("values")["value"], F.lit(1), F.col("take"))).alias("value")), "lists")

    fits = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    sk = reps.select("key", "sketch")

    def estimated(pairs: DataFrame, name: str) -> DataFrame:
        """Distinct pairs (a < b) that the union's sketch does not rule out."""
        pairs = pairs.where(fits & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        p = (pairs.join(sk.select(F.col("key").alias("a"), F.col("sketch").alias("sa")), "a")
             .join(sk.select(F.col("key").alias("b"), F.col("sketch").alias("sb")), "b"))
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
        p = p.select("a", "b", F.size(union).alias("of"), F.size(F.array_intersect(F.array_intersect("sa", "sb"), union)).alias("hits"))
        return stage_table(p.where(F.when(F.col("of") < k, F.col("hits") * 100 >= F.col("of") * percent).otherwise(F.col("hits") >= floor)), name)

    def full_sets(pairs: DataFrame, more: DataFrame | None = None) -> DataFrame:
        """Full shingle sets of the documents in ``pairs``, and in ``more``."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
        ids = stage_table((ids.union(more.select("key")) if more is not None else ids).distinct(), "pair-ids")
        side = F.broadcast(ids) if ids.count() <= IDS_TO_BROADCAST else ids
        some = df.select(F.xxhash64(text).alias("id"), F.col(text).alias("t")).join(side, "id").dropDuplicates(["id"])

        def keys(batches):
            for batch in batches:
                sets = [s.tobytes() for _, s in shingle_sets(batch.column(1), width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["key", "keys"])

        return stage_table(map_arrow(some.select("id", "t"), keys, "key long, keys binary"), "full-sets")

    # two hubs of each list: the members whose retained values are the most common, and a member by hash
    hubs = lists.groupBy("value").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.struct(F.col("common").alias("o"), "key", "n")).alias("central"),
        F.min(F.struct(F.xxhash64("key").cast("double").alias("o"), "key", "n")).alias("other"))
    with_hub = lists.join(hubs.select("value", F.explode(F.array("central", "other")).alias("hub")), "value")
    first = estimated(with_hub.select(F.col("key").alias("a"), F.col("hub.key").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb")), "pairs-hub")
    comp = stage_table(connected_components(_verified(first, full_sets(first), percent)), "classes-linked")

    # members outside their hub's component against the other components of the list
    labels = comp.select(F.col("node").alias("key"), "component")
    now = lists.join(labels, "key", "left").withColumn("c", F.coalesce("component", "key")).drop("component")
    heads = now.groupBy("value").agg(
        F.count(F.lit(1)).alias("members"), F.max(F.struct(F.col("common").alias("o"), F.col("key").alias("hub"), F.col("c").alias("home"))).alias("x"),
        F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi").select("value", "members", "x.hub", "x.home")
    split = stage_table(now.join(heads, "value"), "lists-split")
    # short lists: pairs
    short = split.where(F.col("members") <= SHORT)
    apart = short.where("c != home").select("value", F.col("key").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"))
    others = short.select("value", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), "home")
    more = apart.join(others, "value").where(fits & (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("home")) | (F.col("a") < F.col("b"))))
    tested = first.select("a", "b")
    more = estimated(more.select("a", "b", "na", "nb").join(tested, ["a", "b"], "left_anti")
                     .join(tested.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"), "pairs-more")
    # long lists: the members of all lists of a hub are compared in blocks
    family = stage_table(split.where(F.col("members") > SHORT).groupBy("hub", "key").agg(
        F.any_value("n").alias("n"), F.any_value("c").alias("c"), F.max((F.col("c") == F.col("home")).cast("int")).alias("at_home")), "families")
    sets = full_sets(more, family)
    links = _verified(more, sets, percent).union(_family_links(family, sets, percent))
    comp = connected_components(links.union(comp.where("node != component").select("node", "component")))

    found = stage_table(reps.select("n", "h1", "h2", "key", "low").join(comp.select(F.col("node").alias("key"), "component"), "key", "left")
                        .withColumn("component", F.coalesce("component", "key")), "classes-found")
    names = found.groupBy("component").agg(F.min("low").alias("__c"))
    found = found.join(names, "component").select("n", "h1", "h2", "__c", "component")
    out = docs.select("key", "th", "n", "h1", "h2").join(found, ["n", "h1", "h2"], "left")
    # a null component: no words, or no key in the component
    label = F.coalesce("__c", "key")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), label.alias("component_id"), F.col("key").eqNullSafe(label).alias("kept"),
                      *([F.col("th").alias("text_hash"), "component"] if inner else []))
