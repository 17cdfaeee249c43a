"""Near-duplicates by a chosen-path set similarity join."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from taxaloom.session import broadcast_rows, freeze

from .common import per_text, release, text_of, unused
from .components import components
from .shingles import U, digest_of, linked, mix, sets_of, signature

#: Independent trees, and branches that a document takes at each root.
TREES, BRANCHES = 8, 2
#: Below the roots one branch is taken always and a second one in a quarter of the nodes: 1.25 on average, so that
#: pairs of similarity 0.8 keep their number from level to level and less similar ones die out. Ten levels down a
#: branch still holds such a pair with a chance of 0.36; all 16 miss it with 0.4 % if their tokens are fresh.
SECOND = 4
#: Minwise values to branch by, and values kept as one byte each to compare documents by.
TOKENS, BYTES = 48, 128
#: A node is compared exhaustively when at most so many of its members are outside its largest known component.
SMALL = 32
#: Share of equal tokens from which on comparing a node's members is cheaper than branching.
ALIKE = 0.5
#: Levels after which the nodes left are compared exhaustively, in blocks, whatever their size.
DEPTH = 24
#: Members of a node that are compared in one piece.
BLOCK = 512
#: Bytes of shingle sets, and pairs, that are confirmed in one piece on average; blocks that are dealt into at least.
CELL_BYTES, CELL_PAIRS, FEWEST_BLOCKS = 4 << 20, 50_000, 6
#: Rows of at most some 40 bytes that are joined by a broadcast, 8 MB; more are joined by an exchange.
BROADCAST_KEYS = 200_000

_NODES = StructType().add("node", "long").add("root", "integer").add("cls", "binary").add("label", "binary")
_CHILDREN = StructType([*_NODES.fields]).add("parent", "long")
_PAIRS = StructType().add("a", "binary").add("b", "binary")
_DEALT = StructType().add("cell", "long").add("pairs", "binary").add("classes", "binary")
_NEEDED = StructType().add("cell", "long").add("cls", "binary")
#: Length of a class's name, a digest of its set.
CLASS_BYTES = 16


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _children(node: np.ndarray, coordinate: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    token = tokens[np.arange(len(tokens)), coordinate].astype(U)
    return mix(mix(node ^ (coordinate.astype(U) + U(1)) * U(0xD1B54A32D192ED03)) + token).view(np.int64)


def _branch(nodes: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows that take a branch, and their next nodes, by tokens that the node's hash chooses."""
    at = nodes.view(U)
    first = (mix(at ^ U(1)) % U(TOKENS)).astype(np.int64)
    yield np.arange(len(nodes)), _children(at, first, tokens)
    second = (first + 1 + (mix(at ^ U(2)) % U(TOKENS - 1)).astype(np.int64)) % TOKENS
    taken = np.flatnonzero(mix(at ^ U(3)) % U(SECOND) == 0)
    yield taken, _children(at[taken], second[taken], tokens[taken])


def _root_nodes(tokens: np.ndarray) -> list[np.ndarray]:
    """Next nodes of documents at the roots, by ``BRANCHES`` tokens of each tree."""
    n = len(tokens)
    return [
        _children(np.full(n, mix(np.array([t + 1], U))[0]), np.full(n, BRANCHES * t + j), tokens)
        for t in range(TREES)
        for j in range(BRANCHES)
    ]


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, label, tokens) -> (node, root, cls, label)"""
    for batch in batches:
        if batch.num_rows:
            for root, node in enumerate(_root_nodes(_matrix(batch.column(2), np.uint32, TOKENS))):
                at = pa.array(np.full(len(node), root, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(node), at, batch.column(0), batch.column(1)], schema=_arrow(_NODES))


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, label, tokens, node, root) -> (node, root, cls, label, parent)"""
    for batch in batches:
        if batch.num_rows:
            tokens = _matrix(batch.column(2), np.uint32, TOKENS)
            for at, node in _branch(batch.column(3).to_numpy(), tokens):
                rows = batch.take(pa.array(at))
                columns = [pa.array(node), rows.column(4), rows.column(0), rows.column(1), rows.column(3)]
                yield pa.RecordBatch.from_arrays(columns, schema=_arrow(_CHILDREN))


def _alike(least: int) -> Callable:
    """(a, b, sketch of a, sketch of b) -> (a, b) of those with ``least`` equal bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column(2), np.uint8, BYTES) == _matrix(batch.column(3), np.uint8, BYTES)).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1)], schema=_arrow(_PAIRS)
                ).filter(pa.array(same >= least))

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that agree in the first column, by which they are sorted."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and key[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key[a]
    if held:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _compared(least: int) -> Callable:
    """(a, partners): those of other labels with ``least`` equal sketch bytes within each cell, packed end to end.

    (cell, side, root, deep, done, cls, label, sketch, heads): side 0 are members,
    1 members outside the commonest label, 2 both. ``heads`` are the tokens of the
    roots, ``done`` has the roots whose node is compared whole: a pair that shares
    one of them is left to the first of these.
    """
    bits = np.left_shift(1, np.arange(TREES * BRANCHES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for rows in _runs(batches):
            side = rows.column(1).to_numpy()
            members, others = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            if not len(members) or not len(others):
                continue
            root, deep, done = rows.column(2)[0].as_py(), rows.column(3)[0].as_py(), rows.column(4).to_numpy()
            names, labels = rows.column(5).to_pylist(), rows.column(6).to_pylist()
            code = {x: i for i, x in enumerate(set(labels))}
            label = np.array([code[x] for x in labels])
            sketch, heads = _bytes(rows.column(7), np.uint8, BYTES), _bytes(rows.column(8), np.uint32, TREES * BRANCHES)
            earlier = bits if deep else bits[:root]
            for j in others:
                same = (sketch[members] == sketch[j]).sum(1)
                # Of two members outside the commonest label one is enough to name the pair.
                hits = members[(same >= least) & (label[members] != label[j])]
                if len(hits):
                    shared = ((heads[hits] == heads[j])[:, : len(earlier)] * earlier).sum(1) & done[j]
                    found = {names[i] for i in hits[shared == 0] if side[i] == 0 or names[i] < names[j]}
                    if found:
                        out.append((names[j], b"".join(sorted(found))))
            if len(out) > 1000:
                yield _packed(out)
                out = []
        if out:
            yield _packed(out)
        release()

    return run


def _packed(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], schema=_arrow(_PAIRS))


def _split(packed: bytes) -> list[bytes]:
    return [packed[i : i + CLASS_BYTES] for i in range(0, len(packed), CLASS_BYTES)]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes that the rows of a task name, each once."""
    found: set[bytes] = set()
    for batch in batches:
        found.update(batch.column(0).to_pylist())
        for packed in batch.column(1).to_pylist():
            found.update(_split(packed))
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], names=["cls"])


def _dealt(blocks: int) -> Callable:
    """(a, partners) -> (cell, pairs, classes): by the blocks of both ends; few rows per task and cell, packed."""

    def block(name: bytes) -> int:
        return zlib.crc32(name) % blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[int, bytearray] = defaultdict(bytearray)
        classes: dict[int, set[bytes]] = defaultdict(set)
        held = 0

        def flush() -> pa.RecordBatch:
            columns = [list(pairs), [bytes(x) for x in pairs.values()], [b"".join(classes[c]) for c in pairs]]
            pairs.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _arrow(_DEALT), strict=True)], schema=_arrow(_DEALT)
            )

        for batch in batches:
            for a, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = block(a)
                for b in _split(packed):
                    other = block(b)
                    cell = min(own, other) * blocks + max(own, other)
                    pairs[cell] += a + b
                    classes[cell].add(a)
                    classes[cell].add(b)
                held += len(packed)
            if held > 4 << 20:
                yield flush()
                held = 0
        if pairs:
            yield flush()

    return run


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, classes) -> (cell, cls), each once per cell."""
    for rows in _runs(batches):
        found = {x for packed in rows.column(1).to_pylist() for x in _split(packed)}
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows.column(0)[0].as_py()] * len(found)), pa.array(list(found), pa.binary())], names=["cell", "cls"]
        )


def _confirmed(percent: int) -> Callable:
    """(cell, cls, pairs, shingles): sets have no pairs. Links of each cell by full sets, but for those within what is linked already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            sets: dict[bytes, np.ndarray] = {}
            pairs = []
            for name, packed, shingles in zip(*(rows.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if packed is None:
                    sets[name] = np.frombuffer(shingles, U)
                else:
                    both = _split(packed)
                    pairs += zip(both[::2], both[1::2], strict=True)
            parent = {x: x for x in sets}

            def root(x: bytes, parent: dict = parent) -> bytes:
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x

            links = []
            for a, b in pairs:
                x, y = root(a), root(b)
                if x != y and linked(sets[a], sets[b], percent):
                    parent[x] = y
                    links.append((a, b))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links, strict=True)], schema=_arrow(_PAIRS))
        release()

    return run


def _row_key(id_col: str, text: Column) -> Column:
    """128 bits by which rows of one id and text are known; a null id is apart from any other."""
    own = F.col(f"`{id_col}`").cast("string")
    return F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("+"), own), F.lit("-")), F.lit("\0"), text)))


class _Join:
    """One run over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.k, self.percent = k, percent
        # Similar documents have so many equal sketch bytes, but for a chance of about 3e-6 (4.5 deviations).
        s = percent / 100
        self.least = int(BYTES * s - 4.5 * (BYTES * s * (1 - s)) ** 0.5)
        text = text_of(text_col)
        self.texts = docs.select(
            F.col(f"`{id_col}`").alias("id"),
            text.alias("text"),
            _row_key(id_col, text).alias("key"),
        )

        def work(texts: list[bytes]) -> dict:
            sets = sets_of(texts, k)
            full = [signature(x, BYTES) for x in sets]
            return {
                "n_shingles": [len(x) for x in sets],
                "cls": [digest_of(x) for x in sets],
                "tokens": [x[:TOKENS].tobytes() for x in full],
                "sketch": [(x & 0xFF).astype(np.uint8).tobytes() for x in full],
            }

        self.members = freeze(
            per_text(
                self.texts.select(F.struct("id", "key").alias("row"), "text"), "row", "text", work,
                n_shingles=LongType(), cls=BinaryType(), tokens=BinaryType(), sketch=BinaryType(),
            ).select("row.id", "row.key", "n_shingles", "cls", "tokens", "sketch")
        )
        #: One row per different set; documents with equal sets are one class from here on.
        self.classes = freeze(
            self.members.where(F.col("cls").isNotNull())
            .groupBy("cls")
            .agg(F.min("tokens").alias("tokens"), F.min("sketch").alias("sketch"), F.min("key").alias("key"))
        )

    def _with(self, pairs: DataFrame, sides: DataFrame, column: str) -> DataFrame:
        side = [sides.select(F.col("cls").alias(c), F.col(column).alias(f"{column}_{c}")) for c in ("a", "b")]
        return pairs.join(side[1], "b").join(side[0], "a").select("a", "b", f"{column}_a", f"{column}_b")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links that span what the pairs link by their full sets, made anew from the whole texts of their classes.

        Classes are dealt into blocks and a pair goes to the cell of its two blocks,
        with the sets it needs: a set is sent once per cell, however many pairs it is in.
        """
        k, percent = self.k, self.percent
        pairs = freeze(pairs)
        named = StructType().add("cls", "binary")
        wanted = freeze(pairs.mapInArrow(_named, named).distinct())
        wanted = broadcast_rows(wanted, wanted.count(), BROADCAST_KEYS)
        keys = freeze(self.classes.select("cls", "key").join(wanted, "cls").select("key").distinct())
        texts = self.texts.join(broadcast_rows(keys, keys.count(), BROADCAST_KEYS), "key")

        def work(texts: list[bytes]) -> dict:
            sets = sets_of(texts, k)
            return {"cls": [digest_of(x) for x in sets], "shingles": [x.tobytes() for x in sets]}

        sets = freeze(per_text(texts, "key", "text", work, cls=BinaryType(), shingles=BinaryType()).drop("key"))
        size = sets.agg(F.sum(F.octet_length("shingles"))).first()[0] or 0
        many = (pairs.agg(F.sum(F.octet_length("b"))).first()[0] or 0) / CLASS_BYTES
        blocks = math.ceil(max(size / CELL_BYTES, math.sqrt(2 * many / CELL_PAIRS), FEWEST_BLOCKS))
        dealt = freeze(pairs.mapInArrow(_dealt(blocks), _DEALT))
        by_cell = dealt.select("cell", "classes").repartition("cell").sortWithinPartitions("cell")
        needed = freeze(by_cell.mapInArrow(_distinct, _NEEDED))
        nothing = F.lit(None).cast("binary")
        sent = sets.join(broadcast_rows(needed, needed.count(), BROADCAST_KEYS), "cls").select(
            "cell", "cls", nothing.alias("pairs"), "shingles"
        )
        both = dealt.select("cell", nothing.alias("cls"), "pairs", nothing.alias("shingles")).unionByName(sent)
        return freeze(both.repartition("cell").sortWithinPartitions("cell").mapInArrow(_confirmed(percent), _PAIRS))

    def starred(self) -> DataFrame:
        """Links between the members of each root's children and the child's first member."""
        rows = self.classes.select("cls", F.col("cls").alias("label"), "tokens").mapInArrow(_roots, _NODES)
        rows = rows.select("node", "cls")
        #: Root's children of several members; most have one.
        self.first = freeze(
            rows.groupBy("node").agg(F.min("cls").alias("a"), F.count("*").alias("n")).where("n > 1").select("node", "a")
        )
        self.first = broadcast_rows(self.first, self.first.count(), BROADCAST_KEYS)
        pairs = freeze(
            rows.join(self.first, "node").where(F.col("cls") != F.col("a")).select("a", F.col("cls").alias("b")).distinct()
        )
        pairs = broadcast_rows(pairs, pairs.count(), BROADCAST_KEYS)
        return self.verified(self._with(pairs, self.classes, "sketch").mapInArrow(_alike(self.least), _PAIRS))

    def branched(self, labels: DataFrame) -> DataFrame:
        """Links between different labels, from the recursion over all trees.

        A node whose members all have one label is settled. One with at most
        ``SMALL`` members outside its commonest label is a leaf: those are compared
        with all its members. Any other goes one level deeper, unless its members
        agree in half of the tokens or more: they would not part but multiply, so
        such a node is a leaf too, compared in blocks.
        """
        known = freeze(
            self.classes.join(
                broadcast_rows(labels.select(F.col("node").alias("cls"), "label"), labels.count(), BROADCAST_KEYS), "cls", "left"
            ).select(
                "cls", F.coalesce("label", "cls").alias("label"), "tokens", "sketch"
            )
        )
        rows = known.select("cls", "label", "tokens").mapInArrow(_roots, _NODES)
        rows = rows.join(self.first.select("node"), "node")
        leaves: list[DataFrame] = []
        for level in range(DEPTH):
            per_label = rows.groupBy("node", "label").agg(F.count("*").alias("n"))
            sizes = (
                per_label.groupBy("node")
                .agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
                .where("labels > 1")
                .select("node", "n", (F.col("n") - F.col("top.n")).alias("outside"), F.col("top.label").alias("top"))
            )
            # Joined by broadcast where there are few nodes, so that the rows of a hot node stay spread.
            sizes = freeze(sizes)
            sizes = broadcast_rows(sizes, sizes.count(), BROADCAST_KEYS)
            sized = freeze(rows.join(sizes, "node").withColumn("deep", F.lit(level > 0)))
            if not level:  # the others are settled
                mixed = sized.select("cls").distinct()
                known = freeze(known.join(broadcast_rows(mixed, mixed.count(), BROADCAST_KEYS), "cls"))
            deep = sized.where(F.col("outside") > SMALL)
            if level == DEPTH - 1 or deep.isEmpty():
                leaves.append(sized)
                break
            leaves.append(sized.where(F.col("outside") <= SMALL))
            children = freeze(
                deep.select("cls", "node", "root")
                .join(known.select("cls", "label", "tokens"), "cls")
                .select("cls", "label", "tokens", "node", "root")
                .mapInArrow(_deeper, _CHILDREN)
            )
            # The share of a node's pairs that agree in the token that it branches by.
            spread = children.groupBy("parent", "node").agg(F.count("*").alias("n"))
            together = spread.groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("agree"), F.sum("n").alias("all"))
            members = sizes.select(F.col("node").alias("parent"), F.col("n").alias("members"))
            dense = freeze(
                together.join(members, "parent").where(F.col("agree") >= ALIKE * F.col("members") * F.col("all")).select("parent")
            )
            dense = broadcast_rows(dense, dense.count(), BROADCAST_KEYS)
            leaves.append(deep.join(dense.withColumnRenamed("parent", "node"), "node", "left_semi").select(*sized.columns))
            rows = children.join(dense, "parent", "left_anti").drop("parent")
        members = reduce(DataFrame.unionByName, leaves)
        done = members.where("NOT deep").groupBy("cls").agg(F.bit_or(F.pow(F.lit(2), F.col("root")).cast("int")).alias("done"))
        heads = F.substring(F.col("tokens"), 1, 4 * TREES * BRANCHES)
        members = (
            members.select("node", "root", "deep", "cls", "n", "outside", (F.col("label") != F.col("top")).alias("out"))
            .join(known.select("cls", "label", "sketch", heads.alias("heads")), "cls")
            .join(done, "cls", "left")
            .na.fill(0, ["done"])
            .withColumn("across", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("down", F.ceil(F.col("outside") / BLOCK).cast("int"))
        )
        own = [F.pmod(F.xxhash64("cls", F.lit(i)), F.col(c)).cast("int") for i, c in enumerate(("across", "down"))]
        one = (F.col("across") == 1) & (F.col("down") == 1)
        zero = F.lit(0)
        place = lambda side, a, d: F.struct(side.alias("side"), a.alias("a"), d.alias("d"))
        until = lambda c: F.sequence(zero, F.col(c) - 1)
        whole = F.array(place(F.when(F.col("out"), F.lit(2)).otherwise(zero), zero, zero))
        as_member = F.transform(until("down"), lambda d: place(zero, own[0], d))
        as_other = F.when(F.col("out"), F.transform(until("across"), lambda a: place(F.lit(1), a, own[1])))
        sides = F.when(one, whole).otherwise(F.concat(as_member, F.coalesce(as_other, F.slice(as_member, 1, 0))))
        cells = members.withColumn("at", F.explode(sides)).select(
            F.xxhash64("node", "at.a", "at.d").alias("cell"), "at.side", "root", "deep", "done", "cls", "label", "sketch", "heads"
        )
        return self.verified(
            cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(_compared(self.least), _PAIRS)
        )


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``id, key, n_shingles, label`` per row; ``label`` is null without shingles, ``key`` 128 bits of id and text."""
    join = _Join(docs, id_col, text_col, words, percent)
    stars = join.starred()
    more = join.branched(components(stars))
    labels = components(stars.unionByName(more))
    return freeze(
        join.members.select("id", "key", "n_shingles", "cls")
        .join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left")
        .select("id", "key", "n_shingles", F.coalesce("label", "cls").alias("label"))
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` per row of ``docs``.

    Documents whose sets of ``words``-word shingles have 100 * intersection >=
    ``percent`` * union are linked; ``component_id`` is the smallest id that
    links reach, ``kept`` says that it is the row's own. The join:

    1. Equal sets are one class, by a 128-bit digest.
    2. Classes branch by ``BRANCHES`` minwise tokens at each of ``TREES`` roots. In
       every node the members are compared with the first one; links found make
       first components. This settles groups of near copies of any size with one
       comparison per member and node.
    3. Nodes with several components recurse, by tokens that the node's hash
       selects, until at most ``SMALL`` members are outside the commonest component
       or the members are too alike to part; then those outside are compared with
       all members of other components, in blocks of ``BLOCK``.
    4. Sketches only sort out pairs; every link is confirmed on the full sets.

    Nothing is capped: a node that doesn't get small in ``DEPTH`` levels is compared
    in blocks. Hot nodes are counted per task first and joined, not gathered.

    Texts without words (nulls too) are linked with nothing. Rows that repeat an
    id and text share everything. A null id takes part like any other but can't
    be a ``component_id`` unless all ids of its component are null. An empty table
    gives an empty result.
    """
    rows = _grouped(docs, id_col, text_col, words, percent)
    least = rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("component_id"))
    alone = rows.where(F.col("label").isNull()).select("id", "n_shingles", F.col("id").alias("component_id"))
    return (
        rows.join(least, "label")
        .select("id", "n_shingles", "component_id")
        .unionByName(alone)
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with one row of each group of linked documents, all columns as they are.

    The row with the smallest id stays; rows without an id come after all others.
    Of rows that repeat the id and text of the one that stays, one stays. Rows
    without words stay, each of them.
    """
    rows = _grouped(docs, id_col, text_col, words, percent).where(F.col("label").isNotNull())
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first"))
    gone = freeze(rows.join(first, "label").where(F.col("key") != F.col("first.key")).select("key").distinct())
    again = freeze(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    name = unused(docs, "__key")[0]
    keyed = docs.withColumn(name, _row_key(id_col, text_of(text_col)))
    gone = gone.withColumnRenamed("key", name)
    left = keyed.join(broadcast_rows(gone, gone.count(), BROADCAST_KEYS), name, "left_anti")
    if not again.isEmpty():
        again = again.withColumnRenamed("key", name)
        repeated = left.join(again, name, "left_semi").dropDuplicates([name])
        left = left.join(again, name, "left_anti").unionByName(repeated)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
