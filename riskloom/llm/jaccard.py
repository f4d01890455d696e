"""Components of documents whose shingle sets overlap, by a size-aware heavy-light join.

Sets that are equal form a class and are joined once. Two different sets A and B can only link
if they share ``ceil(t * |A|)`` shingles at least, so with shingles in one order for all sets, the
first ``|A| - ceil(t * |A|) + k`` of both share k. The order is from rare to frequent.

* Small sets enumerate all subsets of size 2 of that prefix (k = 2) and meet in them.
* Large sets are found by scanning the inverted lists of their prefix (k = 1). Small sets that
  are large enough to link with a large one are posted in these lists too.
* The boundary minimises the estimated cost, subsets enumerated plus list entries scanned,
  over the histogram of sizes; the mean list length is measured on the data.

No list is expanded into all its pairs. Each list has a hub, the member with the fewest rare
shingles before it, so the least edited copy, and each set is first compared with the hub that
it shares most lists with, which links a group of near copies. Then only lists that still hold several components are joined again:
members outside the most frequent component with members of other components. So all
candidate pairs that could change a component are compared. Pairs whose sets provably differ
too much, by parities of hashed bits, go first; the rest is intersected exactly.

Frequent shingles (at least ``OFTEN`` documents among FLUSH shingles of one task; the FREQUENT
most frequent ones) come last in the order. They are the only statistic that is broadcast,
which changes cost, never results. Intermediate tables go to the shared checkpoint folder.

Edge cases. A text that is null or has no word has an empty set, links with nothing and is its
own component. With fewer words than a shingle the whole sequence is one. Repeated rows are
equal sets; rows that share an id count as one document. A null id sorts first. Empty tables
stay empty. Other columns are ignored. Sets and shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, stored, table, utf8
from riskloom.llm.hashing import mix, row_slices, run_hashes, words
from riskloom.session import pinned

SHINGLE, PERCENT = 3, 90
FREQUENT = 1 << 16
BITS = ((1500, 1024), (12_000, 8192), (1 << 62, 65_536))  # below this size, so many parities
OFTEN = 8
FLUSH = 1 << 20
BROADCAST_KEYS = 500_000
_FIRST = np.iinfo(np.int64).min


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingles of these rows, their n + 1 offsets)."""
    raw, offsets = utf8(texts)
    for first, _, part, own in row_slices(raw, offsets):
        hashed, _, _, bounds = words(part, own, lower=True)
        count = np.diff(bounds)
        runs = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
        edges = np.concatenate([[0], np.cumsum(runs)])
        starts = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], runs)
        shingles = run_hashes(hashed, starts, starts + np.repeat(np.minimum(count, size), runs))
        row = np.repeat(np.arange(len(count)), runs)
        order = np.lexsort((shingles, row))
        shingles, row = shingles[order], row[order]
        once = np.ones(len(row), bool)
        once[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
        yield first, shingles[once], np.searchsorted(row[once], np.arange(len(count) + 1))


def set_ids(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles))])
    sizes = np.diff(edges).astype(np.uint64)
    return mix(sums[edges[1:]] - sums[edges[:-1]] + sizes * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def parities(shingles: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Parities of each set: in how many a hash of its shingles falls, modulo 2.

    Two sets differ in at least as many shingles as their parities do in bits. Larger sets
    have more bits (BITS), or the bits would even out.
    """
    hashed, found = mix(shingles), []
    for a, b in zip(edges[:-1], edges[1:]):
        bits = next(bits for size, bits in BITS if b - a < size)
        odd = np.bincount((hashed[a:b] % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        found.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
    places = np.concatenate([[0], np.cumsum([len(part) for part in found])]).astype(np.int32)
    flat = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(flat))


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def _described(size: int):
    """kind 0: (id, set, size); 1: (shingle, documents); 2: (sum of squares, sum) of lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "a", "b", "c", "bits"]
        nothing = lambda kind: pa.nulls(len(kind), pa.list_(pa.int64()))

        def counted(held):
            found, count = np.unique(np.concatenate(held), return_counts=True)
            often = count >= OFTEN
            rare = count[~often]
            a = np.append(found[often].view(np.int64), (rare * rare).sum())
            return a, np.append(count[often], rare.sum()), np.append(np.ones(often.sum(), int), 2)

        held, total = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, shingles, edges in shingle_sets(batch.column(1), size):
                n = np.diff(edges)
                own = ids[first : first + len(n)]
                columns = [_long(np.zeros(len(n))), _long(own), _long(set_ids(shingles, edges)), _long(n), parities(shingles, edges)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                held.append(shingles)
                total += len(shingles)
                if total >= FLUSH:
                    a, b, kind = counted(held)
                    yield pa.RecordBatch.from_arrays([_long(kind), _long(a), _long(b), _long(b), nothing(kind)], names=names)
                    held, total = [], 0
        if held:
            a, b, kind = counted(held)
            yield pa.RecordBatch.from_arrays([_long(kind), _long(a), _long(b), _long(b), nothing(kind)], names=names)

    return run


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of this size shares with any set it links with."""
    return -(-n * percent // 100)


def boundary(sizes: list[tuple[int, int]], mean_list: float, percent: int) -> int:
    """Size from which sets are scanned: where subsets plus scanned entries cost least."""
    if not sizes:
        return 0
    n, count = (np.array(column, np.float64) for column in zip(*sorted(sizes)))
    prefix = n - needed(n, percent) + 1
    subsets = np.cumsum(count * prefix * (prefix + 1) / 2)
    scans = np.cumsum((count * prefix * (1 + mean_list))[::-1])[::-1]
    limits = np.append(n, n[-1] + 1)
    cost = [
        (subsets[i - 1] if i else 0) + (scans[np.searchsorted(n, limits[i] * percent / 100)] if i < len(n) else 0)
        for i in range(len(limits))
    ]
    return int(limits[int(np.argmin(cost))])


def _postings(frequent, limit: int, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, level = frequent.value
        for batch in batches:
            for _, shingles, edges in shingle_sets(batch.column(0), size):
                sid, n = set_ids(shingles, edges), np.diff(edges)
                order = shingles >> np.uint64(6)
                if len(often):
                    at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
                    order |= np.where(often[at] == shingles, level[at], 0).astype(np.uint64) << np.uint64(58)
                most = needed(n, percent)
                linked = (most < n) | (n * 100 // percent > n)
                out, seen = [], set()
                for row in np.flatnonzero(linked):
                    if sid[row] in seen:
                        continue
                    seen.add(sid[row])
                    a, b = edges[row], edges[row + 1]
                    prefix = int(n[row] - most[row] + 1)
                    first = np.argsort(order[a:b])[: prefix + 1]
                    own = shingles[a:b][first]
                    parts = []
                    if n[row] < limit:
                        i, j = np.triu_indices(len(own), 1)
                        parts.append((mix(own[i] * np.uint64(3) + mix(own[j])), j - 1))
                    if n[row] * 100 >= limit * percent:
                        parts.append((own[:prefix], np.arange(min(prefix, len(own)))))
                    for key, at in parts:
                        out.append((key.view(np.int64), np.full(len(key), sid[row]), at << 32 | n[row]))
                if out:
                    columns = [_long(np.concatenate(column)) for column in zip(*out)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "sid", "spot"])

    return run


def _compared(size: int, percent: int):
    """Those of (x, y, text of x, text of y) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets(texts: pa.Array) -> list[np.ndarray]:
            return [s[a:b] for _, s, e in shingle_sets(texts, size) for a, b in zip(e[:-1], e[1:])]

        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                x, y = (batch.column(i).to_numpy() for i in (0, 1))
                # Rows come in order of x, whose text is hashed once a batch.
                own, first, back = np.unique(x, return_index=True, return_inverse=True)
                left, right = sets(batch.column(2).take(pa.array(first))), sets(batch.column(3))
                common = np.array([len(np.intersect1d(left[i], b, True)) for i, b in zip(back, right)], np.int64)
                total = np.array([len(left[i]) + len(b) for i, b in zip(back, right)], np.int64)
                linked = 100 * common >= percent * (total - common)
                yield pa.RecordBatch.from_arrays([_long(x[linked]), _long(y[linked])], names=["x", "y"])

    return run


def _possible(percent: int) -> str:
    """Sizes and places allow a link of x and y, if this is the first list that they share.

    Before the first shared shingle (of a subset: between its two as well) they have nothing in
    common, so they share ``n - at`` shingles at most. A pair that links passes in its first list.
    """
    return (
        f"x.sid <> y.sid AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent} AND "
        f"least(x.n - x.at, y.n - y.at) * {100 + percent} >= {percent} * (x.n + y.n)"
    )


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(x, y) of those pairs of sets that link, as representatives."""
    known = F.struct("key", "n", "bits")
    first, second = (classes.select(F.col("sid").alias(a), known.alias(b)) for a, b in (("x", "p"), ("y", "q")))
    pairs = pairs.join(first, "x").join(second, "y")
    # At least so many shingles are in one set only; a link allows so many at most.
    apart = F.aggregate(
        F.zip_with("p.bits", "q.bits", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x
    )
    near = apart * (100 + percent) <= (F.col("p.n") + F.col("q.n")) * (100 - percent)
    pairs = pairs.where((F.size("p.bits") != F.size("q.bits")) | near)
    pairs = pairs.selectExpr("p.key AS p", "q.key AS q").where("p <> q").distinct()
    pairs = pinned(pairs)
    wanted = pairs.select("p").union(pairs.select("q")).distinct().toDF("key")
    wanted = pinned(wanted)
    if wanted.count() <= BROADCAST_KEYS:  # then the other texts need not be shuffled
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, "key", "left_semi")
    pairs = pairs.join(texts.toDF("q", "b"), "q").join(texts.toDF("p", "a"), "p").select("p", "q", "a", "b")
    return pinned(pairs.mapInArrow(_compared(size, percent), "x long, y long"))


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links lead to, for every node of a link."""
    edges = links.union(links.select("y", "x")).toDF("x", "y").where("x <> y").distinct()
    edges = pinned(edges)
    labels = pinned(edges.groupBy("x").agg(F.min("y").alias("y")).selectExpr("x AS node", "least(x, y) AS label"))
    while True:
        near = edges.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("label").alias("near"))
        new = labels.join(near, F.col("node") == F.col("x"), "left")
        new = new.selectExpr("node", "label AS old", "least(label, near) AS label")
        far = new.selectExpr("node AS label", "label AS far")
        new = pinned(new.join(far, "label", "left").selectExpr("node", "old", "least(label, far) AS label"))
        changed = new.where("old <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def components(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of (doc_id, text)."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be from 80 to 100")
    spark = documents.sparkSession
    small_batches(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key")
    texts = documents.select(key, "text")
    rows = stored(texts.mapInArrow(_described(size), "kind long, a long, b long, c long, bits array<long>"))
    sets = rows.where("kind = 0").selectExpr("a AS key", "b AS sid", "c AS n")
    described = rows.where("kind = 0").selectExpr("a AS key", "b AS sid", "c AS n", "bits")
    classes = described.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = pinned(classes)
    often = rows.where("kind = 1").groupBy("a").agg(F.sum("b").alias("b"))
    often = often.orderBy(F.desc("b"), "a").limit(FREQUENT).collect()  # FREQUENT rows
    shingles = np.array([row.a for row in often], np.int64).view(np.uint64)
    order = np.argsort(shingles)
    level = np.minimum(np.log2(np.array([row.b for row in often], np.float64) + 1) * 2, 63).astype(np.uint64)
    frequent = spark.sparkContext.broadcast((shingles[order], level[order]))
    square, total = rows.where("kind = 2").agg(F.sum("a"), F.sum("b")).first()
    bins = classes.groupBy(F.floor(F.log("n") * 16)).agg(F.min("n"), F.count(F.lit(1))).collect()  # some hundred
    limit = boundary([(row[1], row[2]) for row in bins], square / total if total else 1.0, percent)

    postings = stored(
        texts.select("text").mapInArrow(_postings(frequent, limit, size, percent), "key long, sid long, spot long")
    )
    places = ("spot >> 32 AS at", f"spot & {(1 << 32) - 1} AS n")
    postings = postings.selectExpr("key", "sid", *places)
    # The smaller set of a pair that links has its first shared shingle among its first ones.
    early = f"(n - at) * {100 + percent} >= {2 * percent} * n"
    lists = postings.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high"), F.max(F.expr(early)).alias("early"))
    members = postings.join(lists.where("low <> high AND early").select("key"), "key", "left_semi")
    members = stored(members.dropDuplicates(["key", "sid"]))
    hubs = members.groupBy("key").agg(F.min(F.struct("at", "sid", "n")).alias("hub"))
    hubs = hubs.selectExpr("key", "hub.sid AS sid", "hub.n AS n", "hub.at AS at")
    star = members.alias("x").join(hubs.alias("y"), "key").where(_possible(percent))
    star = star.groupBy(F.col("y.sid").alias("x"), F.col("x.sid").alias("y")).count()
    # Each set is compared with the hub that it shares most lists with.
    star = star.groupBy("y").agg(F.max(F.struct("count", "x")).alias("most"))
    star = pinned(star.selectExpr("most.x AS x", "y"))
    links = _verified(star, classes, texts, size, percent)
    labels = connected(links)

    # Lists that still hold several components: members outside the main one with all others.
    owners = classes.join(labels, F.col("key") == F.col("node"), "left")
    owners = owners.selectExpr("sid", "coalesce(label, key) AS label")
    labelled = members.join(owners, "sid")
    held = labelled.groupBy("key", "label").count()
    main = held.groupBy("key").agg(F.max(F.struct("count", "label")).alias("main"), F.count(F.lit(1)).alias("kinds"))
    mixed = labelled.join(main.where("kinds > 1").selectExpr("key", "main.label AS main"), "key")
    mixed = stored(mixed)
    outside = mixed.where("label <> main")
    pairs = outside.alias("x").join(mixed.alias("y"), "key")
    pairs = pairs.where("x.label <> y.label").where(_possible(percent))
    pairs = pairs.selectExpr("least(x.sid, y.sid) AS x", "greatest(x.sid, y.sid) AS y").distinct()
    known = star.selectExpr("least(x, y) AS x", "greatest(x, y) AS y")
    pairs = pinned(pairs.join(known, ["x", "y"], "left_anti"))
    more = _verified(pairs, classes, texts, size, percent)
    if more.limit(1).count():
        labels = connected(links.union(more))

    owners = classes.join(labels, F.col("key") == F.col("node"), "left")
    owners = owners.selectExpr("sid", "coalesce(label, key) AS label")
    found = sets.join(owners, "sid", "left").selectExpr("key", "n", "coalesce(label, key) AS label")
    plain = lambda name: F.when(F.col(name) != _FIRST, F.col(name))
    return found.select(plain("key").alias("doc_id"), F.col("n").alias("n_shingles"), plain("label").alias("component_id"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents by 3-word shingles at 0.9."""
    return components(table(spark, folder, "documents"))
