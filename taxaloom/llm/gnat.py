"""Hard negatives by a multiway hyperplane tree whose split points keep distance ranges to their siblings' subtrees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from taxaloom.session import freeze

#: Rows that the tree's split points are chosen from, and the most bytes of them; every row is indexed.
SAMPLE, SAMPLE_BYTES = 16_384, 8 << 20
#: Children of a node, sampled rows from which on a node is split, and levels at most.
FANOUT, SPLIT, LEVELS = 8, 512, 4
#: Rows of a leaf that one task compares, and anchors that it compares them with.
LEAF_ROWS, ANCHORS = 65_536, 65_536
#: Products in hand at once: anchors by rows.
STRIPE = 1 << 21
#: Rounding of distances, as a share of the largest norm.
SLACK = 1e-6


# --- vectors


def whole_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Floors of the scaled components one after another, each vector's length, and which vectors are whole.

    Null vectors and those with a null or non-finite component are not whole.
    """
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    first, last = column.offsets[0].as_py(), column.offsets[-1].as_py()
    flat = column.values.slice(first, last - first).to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    starts = column.offsets.to_numpy() - first
    whole = (wrong[starts[1:]] == wrong[starts[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    return flat, np.where(whole, sizes, 0), whole


def padded(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, dims: int) -> np.ndarray:
    """One row per vector; a component that a shorter vector lacks is zero."""
    out = np.zeros((len(sizes), dims))
    if len(sizes) and (sizes == dims).all():
        return flat[starts[:, None] + np.arange(dims)] if dims else out
    for i, (at, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        out[i, :n] = flat[at : at + n]
    return out


def packed(rows: np.ndarray, kind: str) -> pa.Array:
    """Each row as the bytes of its components."""
    rows = np.ascontiguousarray(rows.astype(kind))
    width = rows.shape[1] * rows.dtype.itemsize
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(rows.tobytes())])


def unpacked(column, kind: str, dims: int) -> np.ndarray:
    values = b"".join(v.as_py() for v in column) if dims else b""
    return np.frombuffer(values, kind).astype(np.float64).reshape(len(column), dims)


# --- the tree


class Tree:
    """Split points by node, their children and, once measured, ranges of distances.

    Vectors get one more component that gives all of them the norm of the
    longest; anchors get a zero there. The squared distance of an anchor q and a
    row x is then |q|^2 + longest^2 - 2 q.x, so windows of scores are annuli of
    distances. ``child[node][j]``: the node below, or -1 - cell.
    """

    def __init__(self, sample: np.ndarray, longest: float):
        self.longest = longest
        self.points: list[np.ndarray] = []
        self.child: list[list[int]] = []
        self.cells = 0
        self.root = self._grow(self.lift(sample), 0)
        self.low = self.high = None

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (rows * rows).sum(1), 0.0))
        return np.hstack([rows, rest[:, None]])

    def _grow(self, rows: np.ndarray, level: int) -> int:
        points = _split_points(rows) if len(rows) > SPLIT and level < LEVELS else rows[:0]
        if len(points) < 2:
            self.cells += 1
            return -self.cells
        nearest = (rows @ points.T).argmax(1)
        node = len(self.points)
        self.points.append(points)
        self.child.append([])
        for j in range(len(points)):
            self.child[node].append(self._grow(rows[nearest == j], level + 1))
        return node

    def _walk(self, rows: np.ndarray, node: int, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """Node, rows there, their distances to its split points, and the child of each; leaves with no distances."""
        if not len(at):
            return
        if node < 0:
            yield node, at, None, -1 - node
            return
        products = rows[at] @ self.points[node].T
        nearest = products.argmax(1)
        yield node, at, np.sqrt(np.maximum(2 * self.longest - 2 * products, 0.0)), nearest
        for j, below in enumerate(self.child[node]):
            yield from self._walk(rows, below, at[nearest == j])

    def cell_of(self, rows: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(rows), np.int32)
        for node, at, _, leaf in self._walk(self.lift(rows), self.root, np.arange(len(rows))):
            if node < 0:
                cell[at] = leaf
        return cell

    def measure(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Widen ``low`` and ``high`` (node, split point, child) to the distances of ``rows``."""
        for node, _, distances, nearest in self._walk(self.lift(rows), self.root, np.arange(len(rows))):
            if node < 0:
                continue
            for j in np.unique(nearest):
                mine = distances[nearest == j]
                m = mine.shape[1]
                low[node, :m, j] = np.minimum(low[node, :m, j], mine.min(0))
                high[node, :m, j] = np.maximum(high[node, :m, j], mine.max(0))

    def no_ranges(self) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(self.points), FANOUT, FANOUT)
        return np.full(shape, np.inf), np.full(shape, -np.inf)

    def cells_in(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Which anchors may have a row with a score from ``least`` to ``most`` in which cell.

        A child is left out when, for any split point, the distances that the
        triangle inequality allows between anchor and subtree miss the annulus.
        """
        square = (anchors * anchors).sum(1) + self.longest
        far = np.sqrt(np.maximum(square - 2 * least, 0.0))
        near = np.sqrt(np.maximum(square - 2 * most, 0.0))
        slack = SLACK * np.sqrt(self.longest + square.max(initial=0.0))

        def visit(node: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
            if not len(at):
                return
            if node < 0:
                yield at, -1 - node
                return
            points = self.points[node]
            m = len(points)
            d = np.sqrt(np.maximum(square[at, None] - 2 * anchors[at] @ points[:, :-1].T, 0.0))[:, :, None]
            low, high = self.low[node, :m, :m], self.high[node, :m, :m]
            closest = np.maximum(d - high, low - d).max(1)
            farthest = (d + high).min(1)
            stays = (closest <= far[at, None] + slack) & (farthest >= near[at, None] - slack)
            for j, below in enumerate(self.child[node]):
                yield from visit(below, at[stays[:, j]])

        yield from visit(self.root, np.arange(len(anchors)))


def _split_points(rows: np.ndarray) -> np.ndarray:
    """Up to ``FANOUT`` rows far from each other: each next one is the farthest from those chosen, among candidates."""
    candidates = np.unique(rows[:: max(1, len(rows) // (8 * FANOUT))], axis=0)
    chosen = [0]
    gap = ((candidates - candidates[0]) ** 2).sum(1)
    while len(chosen) < FANOUT and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((candidates - candidates[chosen[-1]]) ** 2).sum(1))
    return candidates[chosen]


# --- the search


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores; of equal ones the first places."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        s = scores[at]
        edge = np.partition(s, len(s) - k)[len(s) - k]
        above, level = at[s > edge], at[s == edge]
        at = np.concatenate([above, level[: k - len(above)]])
    return at


def scan(anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each anchor's place and its scores with all ``rows``, as whole numbers in floats."""
    step = max(1, STRIPE // max(1, len(rows)))
    for i in range(0, len(anchors), step):
        yield from enumerate(anchors[i : i + step] @ rows.T, i)


class Index:
    """All rows of a table by cell of the tree, in a written table, with what the search needs to know of them."""

    def __init__(self, vectors: DataFrame, anchor: Column, id_col: str, label_col: str, vec_col: str, scale: int):
        self.spark = vectors.sparkSession
        clean = vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{label_col}`").cast("long").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
            F.col(f"`{vec_col}`").alias("vec"),
        ).where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
        self.scale = scale
        self._learn(clean)
        self._place(clean)
        self._measure()

    def _learn(self, clean: DataFrame) -> None:
        """Largest sizes of all rows, and a sample that the tree's split points come from."""
        scale = self.scale

        def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat, n, whole = whole_vectors(batch.column(1), scale)
                starts = batch.column(1).offsets.to_numpy()[:-1] - batch.column(1).offsets[0].as_py()
                at = np.flatnonzero(whole)
                ends = np.repeat(np.arange(len(n)), np.diff(batch.column(1).offsets.to_numpy()))
                square = np.bincount(ends, np.nan_to_num(flat, posinf=0, neginf=0) ** 2, len(n))
                picked = batch.column(2).to_numpy(zero_copy_only=False)
                vec = [
                    flat[starts[i] : starts[i] + n[i]].tolist() if picked[i] else None for i in at.tolist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)), pa.array(n[at], pa.int64()), pa.array(square[at]),
                        batch.column(3).take(pa.array(at)), pa.array(vec, pa.list_(pa.float64())),
                    ],
                    names=["id", "dims", "square", "label", "vec"],
                )

        rows = clean.agg(F.count("*"), F.max(F.size("vec"))).first()
        wanted = min(SAMPLE, SAMPLE_BYTES // (8 * max(1, rows[1] or 1)))
        share = min(1.0, wanted / max(1, rows[0]))
        picked = F.rand(11) < share
        found = (
            clean.select("id", "vec", picked.alias("picked"), "label")
            .mapInArrow(sizes, "id long, dims long, square double, label long, vec array<double>")
            .agg(
                F.max("dims"), F.max("square"), F.count("*"),
                F.collect_list(F.when(F.col("vec").isNotNull(), F.struct("id", "label", "vec"))),
            )
            .first()
        )
        self.dims, self.longest, self.rows = found[0] or 0, float(found[1] or 0.0), found[2]
        if self.longest >= 2.0**53:
            raise ValueError("scores of these vectors are beyond whole numbers of 53 bits")
        # A component is at most the norm, so the norm tells how wide a whole number it needs.
        self.kind = "<i2" if self.longest < 2.0**30 else "<i4" if self.longest < 2.0**62 else "<i8"
        sample = sorted(((r.id, r.label, r.vec) for r in found[3]))[: 2 * wanted]
        self.sample_id = np.array([r[0] for r in sample], np.int64)
        self.sample_label = np.array([r[1] for r in sample], np.int64)
        self.sample = np.zeros((len(sample), self.dims))
        for i, (_, _, vec) in enumerate(sample):
            self.sample[i, : len(vec)] = vec
        self.tree = Tree(self.sample, self.longest)

    def _place(self, clean: DataFrame) -> None:
        scale, dims, kind, tree = self.scale, self.dims, self.kind, self.tree

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat, n, whole = whole_vectors(batch.column(3), scale)
                starts = batch.column(3).offsets.to_numpy()[:-1] - batch.column(3).offsets[0].as_py()
                at = np.flatnonzero(whole)
                rows = padded(flat, starts[at], n[at], dims)
                keep = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).take(keep) for i in range(3)]
                    + [packed(rows, kind), pa.array(tree.cell_of(rows), pa.int32())],
                    names=["id", "label", "anchor", "vec", "cell"],
                )

        self.placed = freeze(
            clean.mapInArrow(place, "id long, label long, anchor boolean, vec binary, cell int")
            .withColumn("key", F.monotonically_increasing_id())
        )

    def _measure(self) -> None:
        """Ranges over all rows, rows by cell, and the number of anchors."""
        tree, kind, dims = self.tree, self.kind, self.dims

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = tree.no_ranges()
            for batch in batches:
                tree.measure(unpacked(batch.column(0), kind, dims), low, high)
            node, i, j = np.nonzero(low <= high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (node, i, j, low[node, i, j], high[node, i, j])],
                names=["node", "i", "j", "low", "high"],
            )

        tree.low, tree.high = tree.no_ranges()
        found = self.placed.select("vec").mapInArrow(ranges, "node long, i long, j long, low double, high double")
        # At most FANOUT squared rows per node of the sample's tree.
        for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            tree.low[r.node, r.i, r.j], tree.high[r.node, r.i, r.j] = r.low, r.high
        counts = self.placed.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"))
        by_cell = counts.collect()
        self.leaves = {r.cell: -(-r.n // LEAF_ROWS) for r in by_cell}
        self.blocks = max(1, -(-sum(r.a for r in by_cell) // ANCHORS))

    def anchors(self) -> DataFrame:
        return self.placed.where("anchor").select("key", "id", "label", "vec")

    def search(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``key, w, id, score``: candidates for the ``k`` best rows in every window of every anchor.

        ``asked``: key, id, label, vec, and arrays ``least`` and ``most`` with a
        window's limits each (both included). Rows have the anchor's label if
        ``same``, else another, and another id. Each anchor first meets the
        sample, which raises the lower limits; it then goes to the leaves that
        the tree leaves over, which are compared whole, in stretches of at most
        ``LEAF_ROWS`` rows. The best of all stretches are the caller's to merge.
        """
        tree, kind, dims, leaves = self.tree, self.kind, self.dims, self.leaves
        sample, sample_id, sample_label = self.sample, self.sample_id, self.sample_label
        blocks = self.blocks

        def windows(batch) -> tuple[list[np.ndarray], list[np.ndarray]]:
            return tuple([np.array(x, np.float64) for x in batch.column(c).to_pylist()] for c in ("least", "most"))

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
                vec = unpacked(batch.column("vec"), kind, dims)
                least, most = windows(batch)
                for i, scores in scan(vec, sample):
                    others = ((sample_label == labels[i]) == same) & (sample_id != ids[i])
                    for w in range(len(least[i])):
                        inside = np.sort(scores[others & (scores >= least[i][w]) & (scores <= most[i][w])])
                        if len(inside) >= k:
                            least[i][w] = inside[-k]
                owner = np.repeat(np.arange(len(vec)), [len(x) for x in least])
                visits = set()
                flat = [np.concatenate(x) if x else np.zeros(0) for x in (least, most)]
                for at, cell in tree.cells_in(vec[owner], *flat):
                    if cell in leaves:
                        visits.update((i, cell, p) for i in np.unique(owner[at]).tolist() for p in range(leaves[cell]))
                at, cell, part = (np.array(x, np.int64) for x in zip(*sorted(visits), strict=True)) if visits else [np.zeros(0, np.int64)] * 3
                keep = pa.array(at)
                limits = pa.array([x.tolist() for x in least], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(keep) for c in ("key", "id", "label", "vec")]
                    + [limits.take(keep), batch.column("most").cast(limits.type).take(keep)]
                    + [pa.array(cell, pa.int32()), pa.array(part, pa.int32()), pa.array(batch.column("key").to_numpy()[at] % blocks, pa.int32())],
                    names=["key", "id", "label", "vec", "least", "most", "cell", "part", "block"],
                )

        def compare(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if rows.num_rows and asked.num_rows:
                rows = rows.sort_by("id")
                row_id, row_label = (rows.column(c).to_numpy() for c in ("id", "label"))
                ids, labels, keys = (asked.column(c).to_numpy() for c in ("id", "label", "key"))
                least, most = windows(asked)
                matrix = unpacked(rows.column("vec"), kind, dims)
                for i, scores in scan(unpacked(asked.column("vec"), kind, dims), matrix):
                    others = ((row_label == labels[i]) == same) & (row_id != ids[i])
                    for w, (a, b) in enumerate(zip(least[i], most[i], strict=True)):
                        for at in best(scores, others & (scores >= a) & (scores <= b), k).tolist():
                            out.append((int(keys[i]), w, int(row_id[at]), int(scores[at])))
            columns = zip(*out, strict=True) if out else [[]] * 4
            return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["key", "w", "id", "score"])

        vectors = self.placed.schema["vec"].dataType.simpleString()
        routed = asked.select("key", "id", "label", "vec", "least", "most").mapInArrow(
            route,
            f"key long, id long, label long, vec {vectors}, least array<double>, most array<double>, "
            "cell int, part int, block int",
        )
        parts = self.spark.createDataFrame(sorted(leaves.items()), "cell int, parts int")
        rows = (
            self.placed.join(F.broadcast(parts), "cell")
            .select(
                "id", "label", "vec", "cell", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"),
                F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            )
        )
        names = ("cell", "part", "block")
        schema = StructType([StructField(n, LongType()) for n in ("key", "w", "id", "score")])
        return rows.groupBy(*names).cogroup(routed.groupBy(*names)).applyInArrow(compare, schema)


def _first(candidates: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vec_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(``scale`` * component), scores are whole inner
    products; higher ones come first, then smaller ids. ``anchor`` says which
    rows are anchors. An anchor's positives are its first ``positives`` other
    rows of its label; per positive, the first ``negatives`` rows of other
    labels whose score is from ``percent[0]`` to ``percent[1]`` hundredths of
    the positive's are returned.

    Exact: the tree leaves out only what the triangle inequality rules out.
    Rows with a null id, label or vector, or with a null or non-finite
    component, take no part; shorter vectors end in zeros. Rows that repeat are
    rows of their own, but never positives or negatives of their own id. Empty
    tables, anchors without positives and positives without negatives give no
    rows. Squared norms of 2^53 and more end with an error.
    """
    index = Index(vectors, anchor, id_col, label_col, vec_col, scale)
    edge = float(index.longest) + 1
    everything = index.anchors().select(
        "*", F.array(F.lit(-edge)).alias("least"), F.array(F.lit(edge)).alias("most")
    )
    found = _first(index.search(everything, positives, same=True), positives, "key")
    found = freeze(found.select("key", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    low, high = percent
    limit = lambda hundreds: F.expr(f"transform(p, x -> cast(({hundreds}) div 100 as double))")
    # A key has at most ``positives`` rows here.
    windows = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("w", "positive_score"))).alias("p"))
    asked = freeze(
        index.anchors()
        .join(windows, "key")
        .select(
            "key", "id", "label", "vec",
            limit(f"{low} * x.positive_score + pmod({-low} * x.positive_score, 100)").alias("least"),
            limit(f"{high} * x.positive_score - pmod({high} * x.positive_score, 100)").alias("most"),
        )
    )
    ranked = _first(index.search(asked, negatives, same=False), negatives, "key", "w")
    return (
        ranked.withColumnRenamed("id", "negative_id")
        .withColumnRenamed("score", "negative_score")
        .join(found, ["key", "w"])
        .join(asked.select("key", F.col("id").alias("anchor_id")), "key")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
