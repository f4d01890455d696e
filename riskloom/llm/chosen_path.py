"""Near-duplicate components of documents by a chosen-path set similarity join.

Every set of shingles has a sketch of ``COORDINATES`` minwise tokens; two sets agree in a
coordinate with the probability of their Jaccard similarity. A tree branches the sets from
its root: a node chooses one coordinate that its path has not used, or two so that 1 / t are chosen on
average (t: the least similarity), and hands each set to the child named by its token there. A
pair at the least similarity so keeps one common path on average at any depth, while less
similar pairs die out. All sets are branched ``START`` times, nodes that are still large more often, until they
are small enough to be compared exhaustively. ``TREES`` independent trees are grown; a pair that
links is missed by one tree with 0.27 at most at depth 2 and 0.56 at depth 7, so there all trees find it with over 0.999.

Two sets of a node are a candidate if neither their sketches nor their parities exclude a link.
Sketches that agree in fewer than ``LEAST`` coordinates do (a pair that links is lost by that with less
than 1e-5); parities only exclude what provably differs too much, and little else is left by them. Candidates are
confirmed on full sets.

Only links between different components matter, and a group of near copies must not be expanded
into its pairs. So its candidates are compared in two steps:

* Forests: the members of a node are dealt into blocks of about ``BLOCK``, by another hash in each
  node, and each block hands on a spanning forest of its candidates, the most alike first: fewer rows than members.
  Their links join what is linked at all, but for rare pairs.
* The rest: of nodes whose members are then still in several components, all open candidates,
  those of different components, are handed on. Members outside the node's largest component are compared with
  all members of other components, in cells of two blocks. Nodes of the same members, in several trees, are compared once.

Nodes with over ``OPEN`` open pairs a member branch instead. If any of the next level have over ``STAR``,
these get forests again. Below ``DEPTH`` levels all nodes are compared exhaustively. Nothing is dropped for its size: a
group of copies of any size is one set, a group of near copies one component after its forests.

Frames hold node and set ids; sketches and texts are joined where needed. Every level is written to the shared folder.

Edge cases. A text that is null or has no word has an empty set, links with nothing and is its
own component. With fewer words than a shingle the whole sequence is one. Repeated rows are
equal sets; each row is one of the result, and rows that share an id but not their text keep
their own sets, while a component carries the smallest id of its rows. A null id sorts first
and a component that holds one has a null id; such rows, and rows with the component's id, are kept.
Empty tables stay empty. Other columns are ignored. Sets and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, stored, table
from riskloom.llm.hashing import mix
from riskloom.llm.jaccard import parities, shingle_sets, set_ids
from riskloom.llm.links import LEAST_PARTS, connected, looked_up, parts_for

SHINGLE, PERCENT = 4, 80
COORDINATES = 64  # bits of a long: the coordinates a path has used
TREES, START = 12, 2
STAR, OPEN, BLOCK, DEPTH = 2048, 2048, 1024, 24
LEAST = 36  # of 64 coordinates, at a similarity of 0.8
BROADCAST_KEYS = 500_000
_NULL_ID = np.iinfo(np.int64).min
_SEEDS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | np.uint64(1)
_MEMBERS = "node long, used long, sid long, n long"


def sketches(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Minwise tokens of each set (0 for an empty one): a row of COORDINATES 32-bit numbers."""
    found = np.zeros((len(edges) - 1, COORDINATES), np.uint32)
    filled = np.flatnonzero(np.diff(edges))
    if len(filled):
        for i, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS)):
            least = np.minimum.reduceat((shingles ^ seed) * factor, edges[filled])
            found[filled, i] = (least >> np.uint64(32)).astype(np.uint32)
    return found


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def _described(size: int):
    """(key, sid, n, sketch, bits) of each (key, text); 16 bits of each token are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, shingles, edges in shingle_sets(batch.column(1), size):
                n = np.diff(edges)
                tokens = sketches(shingles, edges).astype(np.uint16)
                rows = [row.tobytes() if full else None for row, full in zip(tokens, n)]
                columns = [batch.column(0).slice(first, len(n)), _long(set_ids(shingles, edges)), _long(n)]
                columns += [pa.array(rows, pa.binary()), parities(shingles, edges)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "sid", "n", "sketch", "bits"])

    return run


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, COORDINATES)


def branched(
    node: np.ndarray, used: np.ndarray, sketch: np.ndarray, percent: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, child, coordinates used) for the first and the second chosen coordinate of each row's node."""
    lines = np.arange(len(node))
    out, taken, rows = [], used.copy(), lines
    for turn in range(2):
        chance = mix(node[rows] + np.uint64(2 * turn + 1))
        at = chance % np.uint64(COORDINATES)
        stride = (chance >> np.uint64(32)) | np.uint64(1)
        while True:
            again = (taken[rows] >> at) & np.uint64(1) == 1
            if not again.any():
                break
            at = np.where(again, (at + stride) % np.uint64(COORDINATES), at)
        taken[rows] |= np.uint64(1) << at
        token = sketch[rows, at.astype(np.int64)].astype(np.uint64)
        child = mix(mix(node[rows] ^ (at << np.uint64(32))) + token)
        out.append((rows, child, used[rows] | np.uint64(1) << at))
        # A second coordinate for a share of the nodes, so that 100 / percent are chosen on average.
        share = (mix(node + np.uint64(7)) >> np.uint64(11)).astype(np.float64) / 2**53
        rows = lines[share < 100 / percent - 1]
    return out


def _roots(trees: list[int], percent: int):
    """Members of the nodes START levels below the roots, of (sid, n, sketch)."""
    seeds = mix(np.array(trees, np.uint64) + np.uint64(0x51ED270B))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                sid, n = (batch.column(i).to_numpy() for i in (0, 1))
                sketch = _matrix(batch.column(2))
                for seed in seeds:
                    row, node, used = np.arange(len(sid)), np.full(len(sid), seed), np.zeros(len(sid), np.uint64)
                    for _ in range(START):
                        parts = branched(node, used, sketch[row], percent)
                        at, node, used = (np.concatenate(part) for part in zip(*parts))
                        row = row[at]
                    yield _members(node, used, sid[row], n[row])

    return run


def _deeper(percent: int):
    """Members of the children, of (node, used, sid, n, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, used = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            sid, n = (batch.column(i).to_numpy() for i in (2, 3))
            for row, child, taken in branched(node, used, _matrix(batch.column(4)), percent):
                yield _members(child, taken, sid[row], n[row])

    return run


def _members(node: np.ndarray, used: np.ndarray, sid: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [_long(node.view(np.int64)), _long(used.view(np.int64)), _long(sid), _long(n)]
    return pa.RecordBatch.from_arrays(columns, names=["node", "used", "sid", "n"])


def _near(x: np.ndarray, y: np.ndarray, n: np.ndarray, bits: pa.ListArray, percent: int) -> np.ndarray:
    """Whether parities allow a link of rows x and y: at least so many shingles are in one set only."""
    ends, flat = bits.offsets.to_numpy(), bits.values.to_numpy().view(np.uint64)
    words = np.diff(ends)
    kept = words[x] != words[y]
    for width in np.unique(words[x[~kept]]):
        same = np.flatnonzero((words[x] == width) & (words[y] == width))
        step = max(1, (1 << 17) // max(int(width), 1))
        for start in range(0, len(same), step):
            part = same[start : start + step]
            left, right = (flat[ends[side[part]][:, None] + np.arange(width)] for side in (x, y))
            apart = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            kept[part] = apart * (100 + percent) <= (n[x[part]] + n[y[part]]) * (100 - percent)
    return kept


def _cell(sid, n, label, main, dealt, outer, sketch, bits, percent: int, least: int, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of a cell, each member of ``outer`` with each of ``dealt`` of another component, or a forest of them."""
    a, b = np.flatnonzero(outer), np.flatnonzero(dealt)
    small, large = np.minimum.outer(n[a], n[b]), np.maximum.outer(n[a], n[b])
    wanted = (label[a][:, None] != label[b]) & (small * 100 >= large * percent)
    once = sid[a][:, None] < sid[b]
    wanted &= once if forest else once | (label[b] == main)
    x, y = np.nonzero(wanted)
    if len(x) * 4 < wanted.size or len(x) <= 1024:
        agree = np.zeros(len(x), np.uint8)
        for start in range(0, len(x), 4096):
            part = slice(start, start + 4096)
            agree[part] = (sketch[a[x[part]]] == sketch[b[y[part]]]).sum(axis=1)
    else:
        every = np.zeros(wanted.shape, np.uint8)
        for left, right in zip(sketch[a].T.copy(), sketch[b].T.copy()):
            every += left[:, None] == right
        agree = every[x, y]
    kept = np.flatnonzero(agree >= least)
    x, y, agree = a[x[kept]], b[y[kept]], agree[kept]
    kept = np.flatnonzero(_near(x, y, n, bits, percent))
    if forest:
        kept = kept[spanning(x[kept], y[kept], agree[kept])]
    return sid[x[kept]], sid[y[kept]]


def spanning(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of these pairs make a spanning forest of greatest weight (Prim's algorithm); weights are positive."""
    if len(x) < 2:
        return np.arange(len(x))
    ends, back = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = back[: len(x)], back[len(x) :]
    place = np.full((len(ends), len(ends)), -1, np.int32)
    place[x, y] = place[y, x] = np.arange(len(x))
    heavy = np.append(weight, 0).astype(np.int16)  # of no pair, -1: 0
    best, via, left = np.zeros(len(ends), np.int16), np.full(len(ends), -1, np.int32), np.ones(len(ends), bool)
    found = []
    for _ in range(len(ends)):
        at = int(np.where(left, best, -1).argmax())
        if best[at]:
            found.append(via[at])
        left[at] = False
        reached = heavy[place[at]]
        closer = left & (reached > best)
        best[closer], via[closer] = reached[closer], place[at][closer]
    return np.array(found, np.int64)


def _compared(percent: int, least: int, forest: bool):
    """Candidates (x, y) of rows (node, i, j, home_i, home_j, main, sid, n, label, sketch, bits) sorted by cell (node, i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if held and batch.num_rows:
                last = [held[-1].column(i)[-1].as_py() for i in range(3)]
                if last != keys[:, 0].tolist():
                    yield from settled(held)
                    held = []
            if len(ends):  # the last cell may go on in the next batch
                yield from settled([*held, batch.slice(0, ends[-1])])
                held, batch = [], batch.slice(ends[-1])
            if batch.num_rows:
                held.append(batch)
        if held:
            yield from settled(held)

    def settled(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        node, i, j, home_i, home_j, main, sid, n, label = (rows.column(k).to_numpy() for k in range(9))
        sketch, bits = _matrix(rows.column(9)), rows.column(10).chunk(0)
        new = (node[1:] != node[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(node)]])
        dealt, outer, found = home_j == j, home_i == i, []
        for start, end in zip(bounds[:-1], bounds[1:]):
            at, own = slice(start, end), bits.slice(start, end - start)
            members = (sid[at], n[at], label[at], main[start], dealt[at], outer[at], sketch[at], own)
            found.append(_cell(*members, percent, least, forest))
        a, b = (np.concatenate(ids) for ids in zip(*found))
        yield pa.RecordBatch.from_arrays([_long(np.minimum(a, b)), _long(np.maximum(a, b))], names=["x", "y"])

    return run


def _own_text(size: int):
    """(sid, text) of those (sid, text) whose set it is: rows may share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [set_ids(shingles, edges) for _, shingles, edges in shingle_sets(batch.column(1), size)]
            own = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield batch.filter(pa.array(own == batch.column(0).to_numpy()))

    return run


def _linked(size: int, percent: int):
    """Those of (x, y, text of x, text of y) whose full sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(texts: pa.Array) -> list[np.ndarray]:
            return [s[a:b] for _, s, e in shingle_sets(texts, size) for a, b in zip(e[:-1], e[1:])]

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                # A text is an end of many pairs: each one is cut into shingles once.
                ends = []
                for side in (0, 1):
                    _, first, back = np.unique(batch.column(side).to_numpy(), return_index=True, return_inverse=True)
                    own = sets(batch.column(side + 2).take(pa.array(first)))
                    ends.append([own[at] for at in back])
                kept = []
                for a, b in zip(*ends):
                    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
                    kept.append(100 * common >= percent * (len(a) + len(b) - common))
                yield batch.select(["x", "y"]).filter(pa.array(kept, pa.bool_()))

    return run


def _once(nodes: DataFrame, most: int | None = None) -> DataFrame:
    """One of the nodes that have the same members; with ``most``, only of nodes of up to so many."""
    same = F.col("digest") if most is None else F.when(F.col("m") <= most, F.col("digest")).otherwise(F.col("node"))
    return nodes.withColumn("same", same).dropDuplicates(["m", "same"]).drop("same")


class Join:
    """One run of the join: the sets, what is known about their links, and the texts."""

    def __init__(self, texts: DataFrame, classes: DataFrame, size: int, percent: int):
        self.texts, self.classes, self.size, self.percent = texts, classes, size, percent
        self.links = self.labels = self.tried = None
        self.parts = LEAST_PARTS

    def labelled(self, members: DataFrame) -> DataFrame:
        """With the label of each member's component, its own id if no link has joined it."""
        if self.labels is None:
            return members.withColumn("label", F.col("sid"))
        known = self.labels.selectExpr("node AS sid", "label AS known")
        return members.join(known, "sid", "left").withColumn("label", F.coalesce("known", "sid")).drop("known")

    def open_nodes(self, labelled: DataFrame) -> DataFrame:
        """node, members, their digest, those outside the largest component, pairs still open, that component; if any are open."""
        held = labelled.groupBy("node", "label").agg(F.count("sid").alias("count"), F.bit_xor(F.xxhash64("sid")).alias("digest"))
        square = F.sum(F.col("count").cast("double") * F.col("count"))
        nodes = held.groupBy("node").agg(
            F.sum("count").alias("m"),
            F.bit_xor("digest").alias("digest"),
            square.alias("square"),
            F.max(F.struct("count", "label")).alias("main"),
        )
        open_pairs = (F.col("m").cast("double") * F.col("m") - F.col("square")) / 2
        outside = (F.col("m") - F.col("main.count")).alias("outside")
        nodes = nodes.select("node", "m", "digest", outside, open_pairs.alias("open"), F.col("main.label").alias("main"))
        return nodes.where("open > 0")

    def cells(self, rows: DataFrame, forest: bool) -> DataFrame:
        """Candidates of rows (node, i, j, home_i, home_j, main, sid, n, label) in their cells."""
        rows = rows.join(self.classes.select("sid", "sketch", "bits"), "sid")
        rows = rows.select("node", "i", "j", "home_i", "home_j", "main", "sid", "n", "label", "sketch", "bits")
        rows = rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
        return rows.mapInArrow(_compared(self.percent, LEAST, forest), "x long, y long").distinct()

    def forests(self, members: DataFrame, nodes: DataFrame) -> DataFrame:
        """Spanning forests of the candidates of each node's blocks."""
        rows = members.join(_once(nodes, BLOCK).select("node", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "node")
        block = F.pmod(F.xxhash64("sid", "node"), "blocks").cast("int")
        homes = [block.alias(name) for name in ("i", "j", "home_i", "home_j")]
        return self.cells(rows.select("node", *homes, F.lit(0).cast("long").alias("main"), "sid", "n", "label"), True)

    def exhaustive(self, members: DataFrame, nodes: DataFrame) -> DataFrame:
        """Open candidates of small nodes: members outside the largest component with all others.

        All members are dealt into blocks j, those outside into blocks i as well; a cell (i, j)
        holds the rows of both, so its size is bounded however large its node is.
        """
        rows = members.join(_once(nodes), "node")
        blocks = {name: F.ceil(F.col(size) / BLOCK).cast("int") for name, size in (("i", "outside"), ("j", "m"))}
        chance = F.xxhash64("sid")
        rows = rows.withColumns({f"blocks_{name}": number for name, number in blocks.items()}).withColumns(
            {
                "home_i": F.when(F.col("label") != F.col("main"), F.pmod(chance, "blocks_i")).otherwise(-1).cast("int"),
                "home_j": F.pmod(chance, "blocks_j").cast("int"),
            }
        )
        dealt = "transform(sequence(0, blocks_i - 1), i -> struct(i, home_j AS j))"
        outer = "transform(filter(sequence(0, blocks_j - 1), j -> j <> home_j AND home_i >= 0), j -> struct(home_i AS i, j))"
        rows = rows.withColumn("cell", F.explode(F.expr(f"concat({dealt}, {outer})")))
        return self.cells(rows.select("node", "cell.i", "cell.j", "home_i", "home_j", "main", "sid", "n", "label"), False)

    def still_open(self, pairs: DataFrame) -> DataFrame:
        """Pairs (x, y) that later levels have not joined."""
        if self.labels is None:
            return pairs
        for end in ("x", "y"):
            known = self.labels.toDF(end, f"of_{end}")
            pairs = pairs.join(known, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
        return pairs.where("of_x <> of_y").select("x", "y")

    def confirm(self, pairs: DataFrame) -> bool:
        """Compare candidates on full sets, once each; their links join components. Whether any linked."""
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["x", "y"], "left_anti")
        alike = stored(pairs, self.parts)
        if alike.isEmpty():
            return False
        self.tried = alike if self.tried is None else self.tried.union(alike)
        wanted = alike.select("x").union(alike.select("y")).distinct().toDF("sid")
        wanted = stored(wanted.join(self.classes.select("sid", "key"), "sid"), self.parts)
        if wanted.count() <= BROADCAST_KEYS:  # then the other texts need not be shuffled
            wanted = F.broadcast(wanted)
        texts = self.texts.join(wanted, "key").select("sid", "text").mapInArrow(_own_text(self.size), "sid long, text string")
        texts = stored(texts.groupBy("sid").agg(F.first("text").alias("text")), self.parts)
        # A set may be an end of many pairs: AQE splits these joins, which copies its text only.
        both = alike.join(texts.toDF("x", "a"), "x").join(texts.toDF("y", "b"), "y").select("x", "y", "a", "b")
        found = stored(both.mapInArrow(_linked(self.size, self.percent), "x long, y long"), self.parts)
        if found.isEmpty():
            return False
        self.links = found if self.links is None else self.links.union(found)
        self.labels = connected(self.links)
        return True

    def grow(self, trees: list[int]) -> None:
        """All levels of some trees, and the links between their sets."""
        self.parts = parts_for(self.classes.count() * len(trees))
        candidates = self.classes.select("sid", "n", "sketch")
        level = stored(candidates.mapInArrow(_roots(trees, self.percent), _MEMBERS))
        pairs: list[DataFrame] = []
        for depth in range(START, DEPTH + 1):
            # Most nodes of a level hold one set, or one component: they go by an aggregate that combines.
            shown = self.labelled(level)
            mixed = shown.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
            members = stored(shown.join(mixed.select("node"), "node", "left_semi"), self.parts)
            nodes = stored(self.open_nodes(members), self.parts)
            large = nodes if depth == START else nodes.where(F.col("open") > STAR * F.col("m"))
            if not large.isEmpty() and self.confirm(self.forests(members, large)):
                members = stored(self.labelled(members.drop("label")), self.parts)
                nodes = stored(self.open_nodes(members), self.parts)
            if nodes.isEmpty():
                break
            small = F.lit(True) if depth == DEPTH else F.col("open") <= OPEN * F.col("m")
            # The only pair of a node of two was its forest.
            near = nodes.where(small).where("m > 2" if depth == START else "true")
            pairs.append(stored(self.exhaustive(members, near), self.parts))
            rest = nodes.where(~small)
            if rest.isEmpty():
                break
            rest = members.join(rest.select("node"), "node", "left_semi").drop("label")
            rest = rest.join(self.classes.select("sid", "sketch"), "sid").select("node", "used", "sid", "n", "sketch")
            level = stored(rest.mapInArrow(_deeper(self.percent), _MEMBERS), self.parts)
        if len(pairs) > 1:
            self.confirm(self.still_open(reduce(DataFrame.union, pairs).distinct()))
        elif pairs:
            self.confirm(pairs[0])


def components(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of (doc_id, text)."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    small_batches(documents.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("key")
    texts = documents.select(key, "text")
    rows = stored(texts.mapInArrow(_described(size), "key long, sid long, n long, sketch binary, bits array<long>"))
    # Only sets that can link with another one: some other size or one replaced shingle must be allowed.
    able = f"n * {percent} <= (n - 1) * 100 OR (n + 1) * {percent} <= n * 100"
    classes = rows.where(f"n > 0 AND ({able})").groupBy("sid")
    first = [F.min("key").alias("key"), *(F.first(name).alias(name) for name in ("n", "sketch", "bits"))]
    classes = stored(classes.agg(*first), parts_for(rows.count()))
    join = Join(texts, classes, size, percent)
    join.grow(list(range(trees)))
    # Copies are one set: the smallest id of every set, then of every component.
    owners = rows.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"))
    owners = join.labelled(owners)
    least = owners.groupBy("label").agg(F.min("key").alias("least"))
    owners = looked_up(owners.select("sid", "label"), "label", "sid", least, "label", "least").select("sid", "least")
    found = rows.where("n > 0").select("key", "sid", "n")
    found = looked_up(found, "sid", "key", owners, "sid", "least").select("key", "n", "least")
    found = found.union(rows.where("n = 0").selectExpr("key", "n", "key AS least"))
    plain = lambda name: F.when(F.col(name) != _NULL_ID, F.col(name))
    return found.select(
        plain("key").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        plain("least").alias("component_id"),
        (F.col("key") == F.col("least")).alias("kept"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by 4-word shingles at 0.8."""
    return components(table(spark, folder, "documents"))
