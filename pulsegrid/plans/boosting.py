"""Boosted and bagged trees of many members and folds in shared passes.

The table is binned once: quantile bins for measures, the codes themselves
for nominal columns, one bin for missing values. It is kept as blocks of
about ``BLOCK_ROWS`` rows with the scores that every learner (a member in a
fold) has so far. A pass adds up gradient sums by (learner, leaf, feature,
bin) over all blocks, the sums of a learner meet by key, and its best splits
are the only thing that reaches the driver; all learners grow one level per
pass. A finished tree is added to the blocks' scores in the next pass. The
blocks are a persisted RDD that is checkpointed every few trees, so a lost
executor costs a few passes. Where the table has few blocks (``ALONE_BLOCKS``,
about 100 bytes a row), nothing has to meet: the same steps run to the end in
one task per learner (or some trees of a bagged one), which reads the blocks
from their store. Those steps are ``Trees.java``, a Java function of the session
that Spark's own compiler makes; such a task returns the scores of its trees,
so trees leave it only where they are asked for.

A split sends a set of bins to the left: a prefix of the bins of a measure,
with the missing rows on the better side, or any subset of a nominal
column's codes (ordered by their mean gradient, the best subset is a prefix).

Rows: null features are missing; null labels never train (give them no
fold); repeated ids are drawn alike when rows are subsampled; ties between
splits go to the first feature and bin; a learner without training rows
scores 0.
"""

from __future__ import annotations

import struct
import tempfile
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.session import ensure_checkpoint_dir, ship_package

BINS = 32
MISSING = BINS - 1
BLOCK_ROWS = 65_536
ALONE_BLOCKS = 16  # tables of up to so many blocks are trained with one task a learner
NODES = 256  # frontier nodes whose sums are held at a time
CUT_EVERY = 16  # score updates between checkpoints of the blocks
BAGGED_TREES = 10  # trees of a bagged learner that a task grows, as they don't build on each other
COPIES = np.cumsum([np.exp(-1) / np.prod(np.arange(1.0, k + 1)) for k in range(12)])  # Poisson(1)


@dataclass(frozen=True)
class Member:
    """Parameters of one tree ensemble. ``rows`` and ``columns`` are the
    shares drawn per tree (``rows_every`` trees share a draw); ``leaf_rows``
    is the least number of rows in a leaf; ``symmetric`` trees use one split
    per level; ``bagged`` trees are averaged, each on a bootstrap sample;
    ``impute`` fills missing values with the medians of the fold's training
    rows; ``nominal`` splits nominal columns by subset, else by code order."""

    rounds: int
    rate: float = 0.1
    depth: int = 6
    rows: float = 1.0
    rows_every: int = 1
    columns: float = 1.0
    leaf_rows: int = 1
    leaves: int = 1 << 30
    l1: float = 0.0
    l2: float = 0.0
    symmetric: bool = False
    bagged: bool = False
    impute: bool = False
    nominal: bool = False
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were made; ``mask`` holds the bins that go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    mask: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, left = np.array(self.feature), np.array(self.left)
        mask = np.array(self.mask, np.uint64)
        node = np.zeros(len(bins), np.int64)
        at = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(at):
            here = node[at]
            goes = (mask[here] >> bins[at, feature[here]].astype(np.uint64)) & np.uint64(1)
            node[at] = left[here] + 1 - goes.astype(np.int64)
            at = at[feature[node[at]] >= 0]
        return node

    def score(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]


@dataclass
class Learner:
    """A member in a fold, and the tree that it grows."""

    number: int
    member: Member
    fold: int
    nominal: tuple[bool, ...]
    fill: np.ndarray | None  # bins of the medians, for members that impute
    ensemble: int = 0
    base: float = 0.0  # where boosting starts: mean label of the fold's training rows
    done: int = 0
    tree: Tree = field(default_factory=Tree)
    frontier: list[int] = field(default_factory=lambda: [0])
    level: int = 0

    def columns(self) -> np.ndarray:
        n = len(self.nominal)
        k = max(1, round(self.member.columns * n))
        if k >= n:
            return np.arange(n)
        return np.sort(np.random.default_rng([self.member.seed, self.number, self.done]).choice(n, k, replace=False))

    def weights(self, block: dict) -> np.ndarray:
        """Training weight of every row for the current tree, a function of
        the row's hash, so blocks and retries agree."""
        own = (block["fold"] >= 0) & (block["fold"] != self.fold)
        m = self.member
        if not m.bagged and m.rows >= 1:
            return own.astype(np.float64)
        salt = np.uint64((m.seed * 1_000_003 + self.done // m.rows_every * 7919 + (self.number + 1) * 104_729) & 0xFFFFFFFFFFFF)
        x = (block["hash"] ^ salt) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        u = ((x ^ (x >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        if not m.bagged:
            return (own & (u < m.rows)).astype(np.float64)
        # Poisson(1) copies of a row are a bootstrap sample of any size
        return own * np.searchsorted(COPIES, u).astype(np.float64)

    def bins(self, block: dict) -> np.ndarray:
        return block["bins"] if self.fill is None else np.where(block["bins"] == MISSING, self.fill[None, :], block["bins"])

    def sums(self, block: dict, nodes: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Gradient sums and weights by (frontier node, column, bin), of some nodes."""
        frontier = self.frontier[nodes]
        at, rows, g, w = self._active(block)
        if len(frontier) < len(self.frontier):
            first = nodes.start or 0
            low, high = np.searchsorted(at, (first, first + len(frontier)))
            at, rows, g, w = at[low:high] - first, rows[low:high], g[low:high], w[low:high]
        by_column, cols = block.get("columns"), self.columns()
        fill, cell = self.fill, at * BINS
        grad, weight = (np.empty((len(frontier), len(cols), BINS)) for _ in range(2))
        for j, c in enumerate(cols.tolist()):  # a column at a time stays in the processor's cache
            bins = (block["bins"][:, c] if by_column is None else by_column[c])[rows]
            if fill is not None:
                bins = np.where(bins == MISSING, fill[c], bins)
            place = cell + bins
            grad[:, j] = np.bincount(place, g, len(frontier) * BINS).reshape(-1, BINS)
            weight[:, j] = np.bincount(place, w, len(frontier) * BINS).reshape(-1, BINS)
        return grad, weight

    def _active(self, block: dict) -> tuple[np.ndarray, ...]:
        """Frontier place, row, gradient and weight of the rows that train the
        frontier, by place where it is held in parts."""
        mark = (id(block["bins"]), self.done, self.level)
        if block.get("active", (None,))[0] == (self.number, *mark):
            return block["active"][1]
        place = np.full(len(self.tree.feature), -1)
        place[self.frontier] = np.arange(len(self.frontier))
        at = place[self.tree.leaf_of(self.bins(block))]
        w = self.weights(block)
        rows = np.flatnonzero((at >= 0) & (w > 0))
        if len(self.frontier) > NODES:
            rows = rows[np.argsort(at[rows], kind="stable")]
        g = w[rows] * (block["y"][rows] - (0.0 if self.member.bagged else block["score"][self.number][rows]))
        found = at[rows], rows, g, w[rows]
        if len(self.frontier) > NODES:
            block["active"] = ((self.number, *mark), found)
        return found

    def step(self, block: dict) -> Tree | None:
        """Grow a level from the sums of one block; a member without shared
        splits takes its nodes in parts."""
        size = len(self.frontier) if self.member.symmetric else NODES
        found = [self.splits(*self.sums(block, slice(i, i + size))) for i in range(0, len(self.frontier), size)]
        return self.grow([x for part in found for x in part])

    def _worth(self, g: np.ndarray, w: np.ndarray) -> np.ndarray:
        g = np.maximum(np.abs(g) - self.member.l1, 0)
        return g * g / np.maximum(w + self.member.l2, 1e-12)

    def _value(self, g: float, w: float) -> float:
        g = np.sign(g) * max(abs(g) - self.member.l1, 0.0)
        return float(g / (w + self.member.l2)) * (1.0 if self.member.bagged else self.member.rate) if w > 0 else 0.0

    def splits(self, grad: np.ndarray, weight: np.ndarray) -> list[tuple]:
        """Per frontier node: (gain, column, bins to the left, gradient and
        weight to the left, gradient and weight of the node)."""
        m, cols = self.member, self.columns()
        n, k, _ = grad.shape
        total_g, total_w = grad[:, 0].sum(-1), weight[:, 0].sum(-1)
        order = np.broadcast_to(np.arange(BINS), (n, k, BINS)).copy()
        subset = np.array(self.nominal)[cols] & m.nominal
        if subset.any():
            g, w = (x[:, subset].sum(0, keepdims=True) if m.symmetric else x[:, subset] for x in (grad, weight))
            order[:, subset] = np.argsort(np.where(w > 0, g / np.maximum(w, 1e-12), np.inf), -1, kind="stable")
        g, w = (np.take_along_axis(x, order, -1) for x in (grad, weight))
        left_g, left_w = np.cumsum(g, -1)[..., :-1], np.cumsum(w, -1)[..., :-1]
        # with the missing rows (the last bin of a measure) on the right, or on the left
        apart = np.where(subset, 0.0, 1.0)[None, :, None]
        left_g = np.stack((left_g, left_g + g[..., -1:] * apart), 2)
        left_w = np.stack((left_w, left_w + w[..., -1:] * apart), 2)
        right_g, right_w = total_g[:, None, None, None] - left_g, total_w[:, None, None, None] - left_w
        gain = self._worth(left_g, left_w) + self._worth(right_g, right_w) - self._worth(total_g, total_w)[:, None, None, None]
        fits = (left_w >= max(m.leaf_rows, 1e-9)) & (right_w >= max(m.leaf_rows, 1e-9))
        gain = np.where(fits, gain, 0.0 if m.symmetric else -1.0)
        if m.symmetric:
            gain = np.broadcast_to(gain.sum(0, keepdims=True), gain.shape)
        flat = gain.reshape(n, -1).astype(np.float32)  # sums in another order give the same splits
        best = flat.argmax(1)
        out = []
        for node in range(n):
            column, side, cut = np.unravel_index(best[node], gain.shape[1:])
            to_left = order[node, column, :cut + 1].tolist() + ([MISSING] if side else [])
            out.append((float(flat[node, best[node]]), int(cols[column]), sum(1 << b for b in set(to_left)), float(left_g[node, column, side, cut]),
                        float(left_w[node, column, side, cut]), float(total_g[node]), float(total_w[node])))
        return out

    def grow(self, splits: list[tuple]) -> Tree | None:
        """Split the frontier; the tree if it is complete."""
        m, tree, ahead = self.member, self.tree, []
        room = m.leaves - sum(f < 0 for f in tree.feature)
        if not self.level and splits:
            tree.value[0] = self._value(*splits[0][5:])
        chosen = [i for i in np.argsort([-s[0] for s in splits], kind="stable").tolist() if splits[i][0] > 1e-9][:max(0, room)]
        for i in sorted(chosen):
            _, column, mask, g, w, total_g, total_w = splits[i]
            node, left = self.frontier[i], len(tree.feature)
            tree.feature[node], tree.mask[node], tree.left[node] = column, mask, left
            for side_g, side_w in ((g, w), (total_g - g, total_w - w)):
                tree.feature.append(-1)
                tree.mask.append(0)
                tree.left.append(0)
                tree.value.append(self._value(side_g, side_w))
                if m.symmetric and side_w > 0 or side_w >= 2 * m.leaf_rows and side_w > 1:
                    ahead.append(len(tree.feature) - 1)
        self.level += 1
        if ahead and self.level < m.depth:
            self.frontier = ahead
            return None
        self.tree, self.frontier, self.level, self.done = Tree(), [0], 0, self.done + 1
        return tree

    @property
    def finished(self) -> bool:
        return self.done >= self.member.rounds


# ---- the binned table -------------------------------------------------------

def _edges(df: DataFrame, features: Sequence[str], nominal: set[str]) -> dict[str, np.ndarray]:
    """Bin edges of measures from one mergeable aggregate over all columns;
    codes of nominal columns by falling frequency (code order on ties)."""
    measures = [f for f in features if f not in nominal]
    probs = [(i + 1) / (MISSING) for i in range(MISSING - 1)]
    out: dict[str, np.ndarray] = {}
    if measures:
        row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, 10_000).alias(f"e{i}") for i, f in enumerate(measures)]).first()
        out = {f: np.unique(np.array(row[f"e{i}"] or [], float)) for i, f in enumerate(measures)}
    for f in features:
        if f in nominal:
            codes = df.where(F.col(f).isNotNull()).groupBy(F.col(f).cast("double").alias("c")).agg(F.count(F.lit(1)).alias("n"))
            out[f] = np.array([r["c"] for r in codes.orderBy(F.desc("n"), "c").limit(MISSING - 1).collect()], float)
    return out


def bin_values(values: np.ndarray, edges: np.ndarray, nominal: bool) -> np.ndarray:
    """Bins of a column: values up to an edge share its bin; a nominal code's
    bin is its place in ``edges``, all other codes share the last one."""
    if nominal:
        place = {c: i for i, c in enumerate(edges.tolist())}
        found = np.array([place.get(v, MISSING - 1) for v in values.tolist()], np.uint8) if len(values) else np.zeros(0, np.uint8)
    else:
        found = np.minimum(np.searchsorted(edges, values, "left"), MISSING - 1).astype(np.uint8)
    return np.where(np.isnan(values), np.uint8(MISSING), found)


BLOCK = ["block", "n", "bins", "hash", "fold", "y", "ids"]  # little-endian arrays, bins row by row; ids as an Arrow stream
BLOCK_SCHEMA = "block int, n int, bins binary, hash binary, fold binary, y binary, ids binary"


def binned_blocks(df: DataFrame, label: str, features: Sequence[str], nominal: Sequence[str] = (), block_rows: int | None = None):
    """``df`` (id, fold, label, features; stored, its fold null where a row
    only gets scores) as a stored table of blocks, one row each, and the edges."""
    spark = df.sparkSession
    edges = _edges(df, features, set(nominal))
    kinds = [f in set(nominal) for f in features]
    parts = max(1, -(-df.count() // (block_rows or BLOCK_ROWS)))

    def pack(batches: Iterator[pa.RecordBatch]):
        held = [b for b in batches if len(b)]
        if held:
            table = pa.Table.from_batches(held)
            bins = np.stack([bin_values(table[f].to_numpy().astype(float), edges[f], k) for f, k in zip(features, kinds, strict=True)], 1)
            ids = pa.BufferOutputStream()
            with pa.ipc.new_stream(ids, pa.schema([table.schema.field("id")])) as to:
                to.write_table(table.select(["id"]))
            parts = [bins.astype(np.uint8), table["__hash"].to_numpy().astype("<i8"), table["__fold"].to_numpy().astype("<i4"), np.nan_to_num(table["__y"].to_numpy()).astype("<f8")]
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(table)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in parts],
                                              pa.array([ids.getvalue().to_pybytes()], pa.binary())], BLOCK)

    rows = df.select("id", F.xxhash64(F.col("id").cast("string")).alias("__hash"), F.coalesce(F.col("fold"), F.lit(-1)).cast("int").alias("__fold"),
                     F.col(label).cast("double").alias("__y"), *[F.col(f).cast("double").alias(f) for f in features])
    ship_package(spark)
    blocks = rows.repartition(parts, "__hash").sortWithinPartitions("__hash", "__fold", "__y").mapInArrow(pack, BLOCK_SCHEMA)
    ensure_checkpoint_dir(spark)
    return blocks.checkpoint(eager=True), edges


# ---- training ---------------------------------------------------------------

def _ids(raw: bytes) -> pa.Array:
    return pa.ipc.open_stream(raw).read_all()["id"].combine_chunks()


def _open(row) -> dict:
    kinds = {"bins": "u1", "hash": "<u8", "fold": "<i4", "y": "<f8"}
    block = {c: np.frombuffer(bytes(row[c]), kind) for c, kind in kinds.items()}
    return block | {"id": _ids(bytes(row["ids"])), "bins": block["bins"].reshape(row["n"], -1)}


def _function(spark: SparkSession, name: str = "pulsegrid_trees") -> str:
    """``Trees.java`` as a function of the session. Spark's own compiler, which
    makes the code of its plans, compiles it; executors get it as a jar."""
    sc = spark.sparkContext
    if not hasattr(sc, "_trees_function"):
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(Path(__file__).with_name("Trees.java").read_text())
        jar = f"{tempfile.mkdtemp(prefix='code-')}/pulsegrid-trees.jar"
        with zipfile.ZipFile(jar, "w") as out:
            for made, code in compiler.getBytecodes().items():
                out.writestr(f"{made.replace('.', '/')}.class", bytes(code))
        sc._jsc.addJar(jar)
        nothing = [sc._gateway.new_array(x, 0) for x in (sc._jvm.java.lang.Class, sc._jvm.java.lang.Object)]
        sc._trees_function = compiler.getClassLoader().loadClass("pulsegrid.Trees").getDeclaredConstructor(nothing[0]).newInstance(nothing[1])
    found = T.ArrayType(T.StructType([T.StructField("place", T.IntegerType()), T.StructField("found", T.BinaryType())]))
    spark._jsparkSession.udf().register(name, sc._trees_function, spark._jsparkSession.parseDataType(found.json()))
    return name


def packed(learner: Learner, first: int, last: int, wants_trees: bool, train_side: bool) -> bytes:
    """A learner and the trees that it is to grow, as ``Trees.java`` reads them."""
    m, k = learner.member, len(learner.nominal)
    drawn = [replace(learner, done=t).columns() if m.columns < 1 else [] for t in range(first, last)]
    return b"".join([
        struct.pack("<15i", learner.number, learner.fold, first, last, min(m.depth, 1 << 30), m.leaves, m.rows_every, m.seed, k,
                    m.symmetric, m.bagged, m.nominal, wants_trees, train_side, learner.fill is not None),
        struct.pack("<6d", m.rate, m.rows, m.l1, m.l2, m.leaf_rows, learner.base), COPIES.astype("<f8").tobytes(), bytes(learner.nominal),
        bytes(k) if learner.fill is None else np.asarray(learner.fill, np.uint8).tobytes(), *[np.array([len(c), *c], "<i2").tobytes() for c in drawn]])


def _unpacked(raw: bytes) -> Tree:
    n = struct.unpack_from("<i", raw)[0]
    feature, mask, left = (np.frombuffer(raw, kind, n, 4 + 4 * n * i).tolist() for i, kind in enumerate(("<i4", "<u4", "<i4")))
    return Tree(feature, mask, left, np.frombuffer(raw, "<f8", n, 4 + 12 * n).tolist())


class Grown(Mapping):
    """Trees by learner number of a table of few blocks, where every task
    reads the whole table. They are grown when asked for; ``scores`` grows
    them and returns what they add up to."""

    def __init__(self, blocks: DataFrame, learners: Sequence[Learner]):
        self.blocks, self.learners, self._trees = blocks, list(learners), None

    def _found(self, wants_trees: bool, train_side: bool = False) -> DataFrame:
        spark = self.blocks.sparkSession
        jobs = []
        for x in self.learners:
            step = BAGGED_TREES if x.member.bagged else max(1, x.member.rounds)
            jobs += [(x.number, t, min(t + step, x.member.rounds), x) for t in range(x.done, x.member.rounds, step)]
        jobs.sort(key=lambda j: -(j[2] - j[1]) * min(j[3].member.depth, 12))  # the longest first
        rows = [(n, first, packed(x, first, last, wants_trees, train_side)) for n, first, last, x in jobs]
        deal = spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), "number int, first int, spec binary")
        table = self.blocks.coalesce(1).agg(F.collect_list(F.struct(*BLOCK[:-1])).alias("data"))
        # every task reads the stored blocks; the other joins would send them through the driver
        found = deal.hint("shuffle_replicate_nl").crossJoin(table).select("number", "first", F.inline(F.call_udf(_function(spark), "data", "spec")))
        return found

    def scores(self, train_side: bool) -> DataFrame:
        """number, first, place (a block), found: sums of the trees from
        ``first`` on, a double for every row of the block that is scored."""
        return self._found(False, train_side)

    def __getitem__(self, number: int) -> list[Tree]:
        if self._trees is None:
            self._trees = {x.number: [] for x in self.learners}
            for r in sorted(self._found(True).collect(), key=lambda r: r["place"]):
                self._trees[r["number"]].append(_unpacked(r["found"]))
        return self._trees[number]

    def __iter__(self):
        return iter([x.number for x in self.learners])

    def __len__(self) -> int:
        return len(self.learners)


def train_learners(blocks: DataFrame, learners: list[Learner], alone_blocks: int = ALONE_BLOCKS) -> Mapping[int, list[Tree]]:
    """Trees by learner number."""
    sc = blocks.sparkSession.sparkContext
    if blocks.count() <= alone_blocks and all(len(x.nominal) < 2048 for x in learners):  # a bounded size: nothing has to meet
        return Grown(blocks, learners)
    rows = blocks.rdd.map(_open)
    trees: dict[int, list[Tree]] = {x.number: [] for x in learners}
    starts = {x.number: x.base for x in learners if not x.member.bagged}
    state = rows.map(lambda b: b | {"score": {n: np.full(len(b["y"]), v) for n, v in starts.items()}}).persist()
    by_number = {x.number: x for x in learners}
    updates, added = 0, {}
    while active := [x for x in learners if not x.finished]:
        if added:
            def update(block, added=added):
                score = dict(block["score"])
                for n, (learner, tree) in added.items():
                    score[n] = score[n] + tree.score(learner.bins(block))
                return block | {"score": score}

            before, state = state, state.map(update).persist()
            updates += 1
            if updates % CUT_EVERY == 0:
                state.checkpoint()
            state.count()
            before.unpersist()

        def partial(part, active=active):
            found: dict[int, list[np.ndarray]] = {}
            for block in part:
                for learner in active:
                    got = learner.sums(block)
                    found[learner.number] = [a + b for a, b in zip(found[learner.number], got, strict=True)] if learner.number in found else list(got)
            yield from found.items()

        def best(item, active=active):
            n, (grad, weight) = item
            return n, next(x for x in active if x.number == n).splits(grad, weight)

        sums = state.mapPartitions(partial).reduceByKey(lambda a, b: [x + y for x, y in zip(a, b, strict=True)], min(len(active), sc.defaultParallelism))
        added = {}
        for n, splits in sums.map(best).collect():
            tree = by_number[n].grow(splits)
            if tree is not None:
                trees[n].append(tree)
                if not by_number[n].member.bagged and not by_number[n].finished:
                    added[n] = (by_number[n], tree)
    state.unpersist()
    return trees


SCORE = ["ensemble", "fold", "id", "side", "y", "score"]


def _sides(fold_of: np.ndarray, fold: int, train_side: bool) -> tuple[np.ndarray, np.ndarray]:
    side = np.where(fold_of < 0, "test", np.where(fold_of == fold, "validation", "train"))
    return side, np.flatnonzero((side != "train") | train_side)


def _scored(ensemble: int, fold: int, ids: pa.Array, side: np.ndarray, rows: np.ndarray, y: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    same = [pa.array(np.full(len(rows), x, np.int32)) for x in (ensemble, fold)]
    return pa.RecordBatch.from_arrays([*same, ids.take(pa.array(rows)), pa.array(side[rows].tolist(), pa.string()), pa.array(y[rows]), pa.array(score)], SCORE)


def ensemble_scores(blocks: DataFrame, learners: list[Learner], trees: Mapping[int, list[Tree]], id_type: str, train_side: bool = False) -> DataFrame:
    """Votes, the plain mean over an ensemble's members in a fold: ensemble,
    fold, id, side, y, score. side is `validation` (rows of that fold), `test`
    (rows without a fold) and, if asked for, `train` (rows of other folds)."""
    schema = f"ensemble int, fold int, id {id_type}, side string, y double, score double"
    if isinstance(trees, Grown):
        who = {x.number: (x.ensemble, x.fold, x.member.bagged, x.member.rounds, x.base) for x in learners}

        def vote(batches):
            for batch in batches:
                for block in batch.to_pylist():
                    ids, fold_of, y = _ids(block["ids"]), np.frombuffer(block["fold"], "<i4"), np.frombuffer(block["y"], "<f8")
                    side, rows = _sides(fold_of, block["of_fold"], train_side)
                    own: dict[int, np.ndarray] = {}
                    for part in sorted(block["parts"], key=lambda p: (p["number"], p["first"])):
                        own[part["number"]] = own.get(part["number"], 0.0) + np.frombuffer(part["found"], "<f8")
                    total = np.zeros(len(rows))
                    members = [n for n, x in who.items() if x[:2] == (block["ensemble"], block["of_fold"])]
                    for n in members:
                        _, _, bagged, rounds, base = who[n]
                        total += own.get(n, 0.0) / max(1, rounds) if bagged else own.get(n, 0.0) + base
                    yield _scored(block["ensemble"], block["of_fold"], ids, side, rows, y, total / len(members))

        spark = blocks.sparkSession
        named = spark.createDataFrame([(n, *x[:2]) for n, x in who.items()], "number int, ensemble int, of_fold int")
        # a row per (ensemble, fold, block) also where no tree was grown
        votes = blocks.select("block", "fold", "y", "ids").crossJoin(named.select("ensemble", "of_fold").distinct())
        found = trees.scores(train_side).withColumnRenamed("place", "block").join(named, "number").groupBy("ensemble", "of_fold", "block").agg(F.collect_list(F.struct("number", "first", "found")).alias("parts"))
        joined = votes.join(found, ["ensemble", "of_fold", "block"], "left").withColumn("parts", F.coalesce("parts", F.array().cast(found.schema["parts"].dataType)))
        ship_package(spark)
        return joined.mapInArrow(vote, schema)
    model = blocks.sparkSession.sparkContext.broadcast([(x, trees[x.number]) for x in learners])  # grows with the rounds, not with the rows

    def run(batches):
        votes: dict[tuple[int, int], list] = {}
        for learner, grown in model.value:
            votes.setdefault((learner.ensemble, learner.fold), []).append((learner, grown))
        for batch in batches:
            for raw in batch.to_pylist():
                block = _open(raw)
                for (ensemble, fold), members in votes.items():
                    side, rows = _sides(block["fold"], fold, train_side)
                    total = np.zeros(len(rows))
                    for learner, grown in members:
                        bins = learner.bins(block)[rows]
                        own = sum((tree.score(bins) for tree in grown), np.zeros(len(rows)))
                        total += own / max(1, len(grown)) if learner.member.bagged else own + learner.base
                    yield _scored(ensemble, fold, block["id"], side, rows, block["y"], total / len(members))

    return blocks.mapInArrow(run, schema)
