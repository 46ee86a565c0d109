"""Exact n-gram Jaccard self-join in metric space.

Texts are points, the distance of two is 1 - Jaccard of their sets of word shingles, which is a metric. Two texts link
if they are within ``r = 1 - threshold``. The join cuts the space into regions that no link leaves, or that hold a copy
of what lies across their border, and compares inside regions only.

1. Texts with equal sets are one class; the join is over classes.
2. Distances to pivots say nothing about unrelated texts, which are all about 1 away from everything. So texts first
   meet through projections: the shingle universe is cut by hash into ``m`` parts, more than two linked sets can
   differ in, so on one part at least their projections coincide, at radius 0. Classes that coincide on a part are
   tied. Parts in which a set has no element tie nothing, as long as the set has no more such parts than were added
   for that. All classes tied to the same smallest class form a star.
3. Stars whose pairs all meet in another star are left out. In a star, classes come by size and pivots are chosen one
   after another: a class belongs to a pivot that is very near and about as large, else it is the next pivot; it is a
   window's copy in the region of every pivot that is no farther than that and what two sets of their sizes can differ
   in. The distance is the Hamming distance of hashed bitmaps, a metric that is never above the number of shingles in
   which two sets differ; so by the triangle inequality a linked pair shares a pivot. Classes connected through pivots
   form a region.
4. Regions of more than ``LEAF`` classes are cut again the same way, by other parts and larger bitmaps, and then by pivots
   and Jaccard distances themselves: a class belongs to
   its nearest pivot, and is copied to an earlier pivot that is at most 2 r farther. This is done again on regions
   that are still large.
5. In a ball so dense that windows copy nearly everything nearly everywhere, pivots can't help; such a region is dealt
   into pairs of blocks, each compared once.
6. Every region is one task of bounded size: it counts links and returns its linked classes with one root each, no
   pairs. Roots are joined into components.

Every pair of classes within reach meets in one region exactly, so the links are counted once.

Defined cases: texts without words, and null texts, have an empty set, link with nothing and are components of their
own; repeated rows are copies of each other; null ids are ignored for a component's smallest id (null if it has no
other); an empty table gives no rows; columns other than key and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spotgrid.llm.batches import chunks, map_batches
from spotgrid.llm.components import Forest, components
from spotgrid.llm.shingles import mix, shingle_set
from spotgrid.sources.shared import stage

#: Classes, and shingles, of a region that is compared in one task.
LEAF = 512
LEAF_ITEMS = 1 << 19
#: Sizes of sets are cut into bands, each this much larger than the last.
BAND = 1.5
#: Bits of a set's bitmap: for each shingle up to this many while the bitmap has at most ``WIDE`` bits, half as many beyond.
BITS = 8
WIDE = 4096
#: The same for regions that are cut again, and how often they are.
DETAIL_BITS = 32
CUTS = 3
#: In stars of more classes than this, a class within so many percent of a pivot's size belongs to it.
ALL_PIVOTS = 512
SLACK = 5
#: Pivots of a star at a time; classes beyond join the first one unseen.
STAR_PIVOTS = 4096
MOST_PIVOTS = 64
VORONOI_ROUNDS = 2
#: A Voronoi cut is kept if it makes at most so many copies per class.
MOST_COPIES = 1.6
#: Ids are sent to all tasks only up to this many; beyond, the join shuffles.
BROADCAST_IDS = 300_000
COLUMNS = 2048


@cache
def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower edges of the size bands, parts of each, and how many parts of each may be empty.

    Two linked sets of at most ``top`` elements differ in at most 2 top (1 - t) / (1 + t). Sets below the first edge
    link with nothing but their equals.
    """
    edges, parts, spare = [max(1, math.ceil(percent / (100 - percent)))], [], []
    while len(parts) < 63:
        low = edges[-1]
        high = max(math.ceil(low * BAND), low * 100 // percent + 1)
        differ = 2 * (high - 1) * (100 - percent) // (100 + percent)
        empty = math.ceil(2 * (differ + 1) * math.exp(-low / (differ + 1))) + 1
        parts.append(differ + 1 + empty)
        spare.append(empty)
        edges.append(high)
    return np.array(edges), np.array(parts), np.array(spare)


def ties(items: np.ndarray, percent: int, seed: int = 0) -> np.ndarray:
    """What a set ties to: one number for each part it needs of its band, and of the next band if a partner may be there.

    The band stands in the lowest six bits. Another seed cuts the universe into other parts. A set that can differ from
    its partners in ``differ`` elements coincides with each on all but ``differ`` of its parts. So in any order that is
    the same for all sets, the first part they coincide on is among the first ``differ + 1`` of either; the order puts
    parts of many elements first, which unrelated sets hardly share.
    """
    edges, parts, spare = bands(percent)
    size = len(items)
    if size < edges[0]:
        return np.zeros(0, np.uint64)
    band = int(np.searchsorted(edges, size, "right")) - 1
    spread = mix(items ^ np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    found = []
    for b in (band, band + 1):
        if b > band and size * 100 < percent * int(edges[b]):
            break
        m = int(parts[b])
        differ = (size + min(100 * size // percent, int(edges[b + 1]) - 1)) * (100 - percent) // (100 + percent)
        part = ((spread >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        there, first, count = np.unique(part[order], return_index=True, return_counts=True)
        content = np.add.reduceat(mix(spread[order] + np.uint64(1)), first)
        if m - len(there) > spare[b]:
            # A partner may leave out as many empty parts as are spare.
            differ += int(spare[b])
            whole, counts = np.zeros(m, np.uint64), np.zeros(m, np.int64)
            whole[there], counts[there] = content, count
            there, content, count = np.arange(m), whole, counts
        tie = mix(content ^ mix(there.astype(np.uint64) + np.uint64(b * 0xD1B54A32D192ED03 & (1 << 64) - 1)))
        tie = tie & np.uint64((1 << 64) - 64) | np.uint64(b)
        found.append(tie[np.lexsort((tie, -count))[: differ + 1]])
    return np.concatenate(found)


def _bits(size: int, bits: int) -> int:
    return 1 << max(3, max(bits * size // 2, min(bits * size, WIDE)).bit_length() - 1)


def bitmap(items: np.ndarray, per_item: int = BITS) -> np.ndarray:
    """The set's elements hashed into a power of two of bits, packed. Neighbouring bits fold into one for a smaller map."""
    bits = np.zeros(_bits(len(items), per_item), np.uint8)
    bits[(mix(items ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(65 - len(bits).bit_length())).astype(np.int64)] = 1
    return np.packbits(bits)


def _fold(packed: np.ndarray, size: int) -> np.ndarray:
    return packed if 8 * len(packed) == size else np.packbits(np.unpackbits(packed).reshape(size, -1).max(1))


def digest(items: np.ndarray) -> bytes:
    return blake2b(items.tobytes(), digest_size=16).digest()


def _node(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


def describe(docs: DataFrame, key: str, text: str, k: int, percent: int, bits: int = BITS) -> DataFrame:
    """(key, n, digest, node, bitmap) of every row. A task gives the bitmap of equal sets once, and none of sets too small to link."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    least = int(bands(percent)[0][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            n, names, maps = [], [], []
            for texts in chunks(batch.column(1)):
                for t in texts:
                    items = shingle_set(t, k)
                    name = digest(items)
                    n.append(len(items))
                    names.append(name)
                    maps.append(bitmap(items, bits).tobytes() if len(items) >= least and name not in met else None)
                    met.add(name)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(map(_node, names), pa.int64()),
                                              pa.array(maps, pa.binary())], names=["key", "n", "digest", "node", "bitmap"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_batches(rows, run, f"key {kind}, n long, digest binary, node long, bitmap binary")


def tie_rows(docs: DataFrame, text: str, k: int, percent: int, seed: int = 0) -> DataFrame:
    """(node, tie): the ties of every set, those of equal sets once a task. They are too many to be kept, so texts are read again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for texts in chunks(batch.column(0)):
                nodes, tied = [], []
                for t in texts:
                    items = shingle_set(t, k)
                    node = _node(digest(items))
                    if node not in met:
                        met.add(node)
                        tied.append(ties(items, percent, seed))
                        nodes.append(np.full(len(tied[-1]), node, np.int64))
                if tied:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(tied).view(np.int64))], names=["node", "tie"])

    return map_batches(docs.select(text), run, "node long, tie long")


class Star:
    """Pivots of a star, whose classes come in order of their sizes.

    A class belongs to a pivot that is within ``slack`` percent of the pivot's size, and is larger by no more than that.
    A later class that links with a member is then within the slack and the two sets' possible difference of the pivot,
    and meets it; pivots too small for any later class are left. With no slack all differing classes are pivots. Of
    classes beyond ``STAR_PIVOTS`` pivots at a time, those that may link all meet the first of them, unseen.
    """

    def __init__(self, width: int, percent: int, slack: int):
        self.width, self.percent, self.slack = width, percent, slack
        self.nodes: list[int] = []
        self.maps = np.zeros((8, max(1, width // 64)), np.uint64)
        self.sizes = np.zeros(8, np.int64)
        self.low, self.first, self.unseen = 0, None, 0

    def meet(self, node: int, n: int, packed: np.ndarray) -> list[int]:
        """The classes that the next one meets."""
        percent, slack, end = self.percent, self.slack, len(self.nodes)
        own = np.zeros(8 * self.maps.shape[1], np.uint8)
        own[: max(1, self.width // 8)] = _fold(packed, self.width)
        own = own.view(np.uint64)
        while self.low < end and self.sizes[self.low] * (100 + slack) < percent * n:
            self.low += 1
        sizes = self.sizes[self.low : end]
        apart = np.bitwise_count(self.maps[self.low : end] ^ own).sum(1, dtype=np.int64)
        # Two sets that link differ in at most (100 - percent) / (100 + percent) of their summed sizes.
        far = 100 * apart - slack * sizes
        met = [self.nodes[self.low + i] for i in np.flatnonzero(far * (100 + percent) <= (sizes * (100 + slack) + 100 * n) * (100 - percent))]
        if ((far <= 0) & (100 * n <= sizes * (100 + slack))).any():
            return met
        full = end - self.low >= STAR_PIVOTS
        if full and not self.unseen:
            self.first = self.nodes[self.low]
        if full or percent * n <= 100 * self.unseen:
            met.append(self.first)
        if full:
            self.unseen = n
            return met
        if end == len(self.sizes):
            self.maps, self.sizes = (np.concatenate([x[self.low :], np.zeros_like(x)]) for x in (self.maps, self.sizes))
            self.nodes = self.nodes[self.low :]
            end, self.low = len(self.nodes), 0
        self.maps[end], self.sizes[end] = own, n
        self.nodes.append(node)
        return met


def needed_stars(spark: SparkSession, stars: DataFrame) -> DataFrame:
    """Rows (centre, band, node), the centre among its star's nodes, of the stars that are needed, with the star's size.

    Every node has a first star of its band, the one of the smallest centre. If all nodes of a star have the same first
    star, their pairs meet there, and the star is left out, unless it is that star itself.
    """
    whole = stars.unionByName(stars.select("centre", "band", F.col("centre").alias("node")).distinct())
    placed = stage(spark, whole.withColumn("first", F.min("centre").over(Window.partitionBy("node", "band"))), "jaccard_placed")
    sizes = placed.groupBy("centre", "band").agg(F.min("first").alias("low"), F.max("first").alias("high"), F.count("*").alias("size"))
    needed = few(spark, stage(spark, sizes.where("low != high or low = centre").select("centre", "band", "size"), "jaccard_needed"))
    return placed.join(needed, ["centre", "band"]).select("centre", "band", "node", "size")


def regions(spark: SparkSession, tied: DataFrame, maps: DataFrame, percent: int, bits: int = BITS) -> DataFrame:
    """(node, root) of every node that shares a pivot with another, from rows (node, tie) and (node, n, bitmap)."""
    tied = tied.withColumn("centre", F.min("node").over(Window.partitionBy("tie")))
    band = F.col("tie").bitwiseAND(F.lit(63).cast("long"))
    stars = stage(spark, tied.where("node != centre").select("centre", band.alias("band"), "node").distinct(), "jaccard_stars")
    whole = needed_stars(spark, stars)
    # Most texts are tied to no other; their bitmaps stay where they are.
    tied_nodes = few(spark, stage(spark, whole.select(F.col("node").alias("of")).distinct(), "jaccard_tied"))
    maps = maps.where("bitmap is not null").select(F.col("node").alias("of"), "n", "bitmap").join(tied_nodes, "of", "left_semi").dropDuplicates(["of"])
    dealt = whole.join(maps, F.col("node") == F.col("of")).select("centre", "band", "node", "size", "n", "bitmap").repartition("centre", "band").sortWithinPartitions(
        "centre", "band", "n", "node")
    edges, _, _ = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, star, joined = None, None, Forest()
        for batch in batches:
            u, v = [], []
            for centre, band, node, size, n, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != (centre, band):
                    at = (centre, band)
                    star = Star(_bits(-(-percent * int(edges[band]) // 100), bits), percent, 0 if size <= ALL_PIVOTS else SLACK)
                # A class meets the same ones in star after star; an edge is given out only if it joins what the task hasn't joined yet.
                news = [other for other in star.meet(node, n, np.frombuffer(packed, np.uint8)) if joined.join(node, other)]
                u += [node] * len(news)
                v += news
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return components(spark, map_batches(dealt, run, "u long, v long"))


def few(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """Marked to be sent to all tasks if it has few rows; else as it is."""
    return F.broadcast(frame) if frame.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else frame


def texts_of(spark: SparkSession, docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) of the rows that stand for the members' classes."""
    reps = few(spark, members.select("rep").distinct())
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.join(reps, F.col("key").eqNullSafe(F.col("rep")), "left_semi")


def cut_again(spark: SparkSession, docs: DataFrame, members: DataFrame, key: str, text: str, k: int, percent: int, seed: int) -> DataFrame:
    """Members of large regions in the regions that other parts and larger bitmaps leave of them."""
    texts = texts_of(spark, docs, members, key, text)
    found = regions(spark, tie_rows(texts, "text", k, percent, seed), describe(texts, "key", "text", k, percent, DETAIL_BITS), percent, DETAIL_BITS)
    again = members.join(found, "node").withColumn("region", F.concat_ws(":", "region", "root"))
    return stage(spark, again.select("digest", "node", "n", "rep", "copies", "region"), "jaccard_again")


def sets_of(spark: SparkSession, docs: DataFrame, members: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """members (digest, rep, ...) with the items of their sets, read again from the text of the row ``rep``, and an empty mask.

    A member comes more than once if its row is repeated.
    """
    rows = texts_of(spark, docs, members, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                items = [shingle_set(t, k) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(map(digest, items), pa.binary()), pa.array([i.view(np.int64) for i in items], pa.list_(pa.int64()))],
                                                 names=["digest", "items"])

    found = map_batches(rows, run, "digest binary, items array<long>")
    return found.join(few(spark, members.drop("node")), "digest").withColumn("mask", F.lit(0).cast("long"))


def split_by_size(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of regions that fit a task, and those of the others (or None) with their region's classes and shingles."""
    sizes = rows.groupBy("region").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    large = stage(spark, sizes.where((F.col("classes") > LEAF) | (F.col("shingles") > LEAF_ITEMS)), "jaccard_large")
    if not large.count():
        return rows, None
    large = few(spark, large)
    return rows.join(large, "region", "left_anti"), rows.join(large, "region")


def _distances(pivots: list[np.ndarray], items: np.ndarray) -> np.ndarray:
    flat = np.concatenate(pivots)
    at = np.searchsorted(items, flat).clip(max=len(items) - 1)
    both = np.add.reduceat(items[at] == flat, np.cumsum([0, *map(len, pivots[:-1])]), dtype=np.int64)
    return 1 - both / (np.array([len(p) for p in pivots]) + len(items) - both)


def voronoi(rows: DataFrame, percent: int, level: int) -> DataFrame:
    """Rows of large regions, dealt to the regions of their pivots: the nearest, and earlier ones within the window.

    A region's pivots are chosen by a hash. A copy gets the level's bit in ``mask``; two copies needn't be compared.
    """
    base = [c for c in rows.columns if c not in ("classes", "shingles")]
    want = F.least(F.lit(MOST_PIVOTS), F.greatest(2 * F.ceil(F.col("classes") / LEAF), 2 * F.ceil(F.col("shingles") / LEAF_ITEMS)))
    is_pivot = F.pmod(F.xxhash64("digest", F.lit(level)), F.col("classes")) < want
    salts = F.ceil(F.col("classes") / LEAF).cast("int")
    pivots = rows.where(is_pivot & (F.col("mask") == 0)).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("role", F.lit(0))
    points = rows.withColumn("salt", F.pmod(F.xxhash64("digest", F.lit(-level - 1)), salts).cast("int")).withColumn("role", F.lit(1))
    dealt = pivots.unionByName(points).repartition("region", "salt").sortWithinPartitions("region", "salt", "role", "digest").select(*base, "salt", "role")
    window = 2 * (100 - percent) / 100 + 1e-9
    index = {c: i for i, c in enumerate([*base, "salt", "role"])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivots = None, []
        for batch in batches:
            take, regions, masks = [], [], []
            for row in range(len(batch)):
                own = tuple(batch.column(index[c])[row].as_py() for c in ("region", "salt"))
                if own != at:
                    at, pivots = own, []
                items = batch.column(index["items"])[row].values.to_numpy().view(np.uint64)
                if batch.column(index["role"])[row].as_py() == 0:
                    pivots.append(items)
                    continue
                mask = batch.column(index["mask"])[row].as_py()
                home, near = 0, []
                if pivots:
                    far = _distances(pivots, items)
                    home = int(far.argmin())
                    near = np.flatnonzero(far[:home] <= far[home] + window).tolist()
                for pivot in (home, *near):
                    take.append(row)
                    regions.append(f"{own[0]}/{pivot}")
                    masks.append(mask | (1 << level if pivot != home else 0))
            out = batch.take(pa.array(take, pa.int64()))
            columns = [pa.array(regions, pa.string()) if c == "region" else pa.array(masks, pa.int64()) if c == "mask" else out.column(index[c]) for c in base]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r.rpartition("/")[0] for r in regions], pa.string())], names=[*base, "parent"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in base)
    return map_batches(dealt, run, f"{schema}, parent string")


def block_pairs(rows: DataFrame) -> DataFrame:
    """Rows of large regions, dealt to all pairs of their region's blocks. Classes of one block meet in its pair with itself."""
    base = [c for c in rows.columns if c not in ("classes", "shingles")]
    n = F.greatest(F.ceil(2 * F.col("classes") / LEAF), F.ceil(2 * F.col("shingles") / LEAF_ITEMS)).cast("int")
    own = rows.withColumn("own", F.pmod(F.xxhash64("digest", F.lit(99)), n).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    bit = F.when(F.col("own") < F.col("other"), F.lit(1 << 40)).when(F.col("own") > F.col("other"), F.lit(1 << 41)).otherwise(F.lit(0))
    name = F.concat_ws("/", "region", F.least("own", "other"), F.greatest("own", "other"))
    return own.withColumn("mask", F.col("mask").bitwiseOR(bit)).withColumn("region", name).select(*base)


def join_region(items: list[np.ndarray], copies: np.ndarray, mask: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set, copies of its partners counted, and the first set it is connected with."""
    size = np.array([len(i) for i in items])
    owner = np.repeat(np.arange(len(items)), size)
    _, which, often = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    shared = often[which] > 1
    owner, (_, which) = owner[shared], np.unique(which[shared], return_inverse=True)
    both = np.zeros((len(items), len(items)), np.int64)
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, COLUMNS):
        a, b = np.searchsorted(which, [low, low + COLUMNS])
        there = np.zeros((len(items), COLUMNS), np.float32)
        there[owner[a:b], which[a:b] - low] = 1
        both += np.rint(there @ there.T).astype(np.int64)
    link = 100 * both >= percent * (size[:, None] + size - both)
    link &= (mask[:, None] & mask) == 0
    np.fill_diagonal(link, False)
    root = np.arange(len(items))
    while True:  # every set takes the first root among its neighbours, then its root's root
        least = np.where(link, root, len(items)).min(1, initial=len(items))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return link @ copies, root
        root = new


def compare(rows: DataFrame, percent: int) -> DataFrame:
    """(digest, root, links) of classes that link inside their region. Rows come sorted by region; one is held at a time."""
    def judge(held: list[tuple]) -> list[tuple]:
        links, root = join_region([h[4] for h in held], np.array([h[2] for h in held]), np.array([h[3] for h in held]), percent)
        return [(held[i][1], held[root[i]][1], int(links[i])) for i in np.flatnonzero(links)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(found: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)], names=["digest", "root", "links"])

        for batch in batches:
            found = []
            plain = [batch.column(i).to_pylist() for i in range(4)]
            for row, (region, name, copies, mask) in enumerate(zip(*plain, strict=True)):
                if held and held[0][0] != region:
                    found += judge(held)
                    held = []
                if held and held[-1][1] == name:
                    continue
                held.append((region, name, copies, mask, batch.column(4)[row].values.to_numpy().view(np.uint64)))
            yield out(found)
        if held:
            yield out(judge(held))

    dealt = rows.repartition("region").sortWithinPartitions("region", "digest")
    return map_batches(dealt, run, "digest binary, root binary, links long")


def link_classes(spark: SparkSession, docs: DataFrame, members: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """(digest, root, links) from all regions, each pair of classes compared once."""
    leaves, large = split_by_size(spark, members)
    for seed in range(1, CUTS + 1):
        if large is None:
            break
        less, large = split_by_size(spark, cut_again(spark, docs, large, key, text, k, percent, seed))
        leaves = leaves.unionByName(less.select(*leaves.columns))
    ready = [sets_of(spark, docs, leaves, key, text, k)]
    if large is not None:
        large = stage(spark, sets_of(spark, docs, large, key, text, k).dropDuplicates(["digest"]), "jaccard_sets")
    for level in range(VORONOI_ROUNDS):
        if large is None:
            break
        cut = stage(spark, voronoi(large, percent, level), "jaccard_voronoi")
        before = large.select(F.col("region").alias("parent"), "classes").distinct()
        now = cut.groupBy("parent", "region").agg(F.count("*").alias("now")).groupBy("parent").agg(F.sum("now").alias("now"), F.count("*").alias("regions"))
        good = few(spark, stage(spark, now.join(before, "parent").where((F.col("now") <= MOST_COPIES * F.col("classes")) & (F.col("regions") > 1)).select(
            "parent"), "jaccard_cut"))
        ready.append(block_pairs(large.join(good, F.col("region") == F.col("parent"), "left_anti")))
        leaves, large = split_by_size(spark, cut.join(good, "parent", "left_semi").drop("parent"))
        ready.append(leaves)
    if large is not None:
        ready.append(block_pairs(large))
    columns = ("region", "digest", "copies", "mask", "items")
    whole = ready[0].select(*columns)
    for more in ready[1:]:
        whole = whole.unionByName(more.select(*columns))
    return stage(spark, compare(whole, percent), "jaccard_links")


def jaccard_join(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key reachable by links) and n_links.

    Two documents link if 100 times their sets' intersection is at least ``percent`` times the union.
    """
    rows = stage(spark, describe(docs, key, text, k, percent), "jaccard_rows")
    classes = stage(spark, rows.where("n > 0").groupBy("digest", "node", "n").agg(F.min("key").alias("rep"), F.count("*").alias("copies")), "jaccard_classes")
    found = regions(spark, tie_rows(docs, text, k, percent), rows.select("node", "n", "bitmap"), percent)
    members = stage(spark, classes.join(found, "node").select("digest", "node", "n", "rep", "copies", F.col("root").cast("string").alias("region")), "jaccard_members")
    links = link_classes(spark, docs, members, key, text, k, percent)
    roots = components(spark, links.select(F.col("digest").alias("u"), F.col("root").alias("v")))
    named = roots.join(members.select(F.col("digest").alias("node"), "rep"), "node")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    found = named.join(least, "root").select(F.col("node").alias("digest"), "least")
    counted = links.groupBy("digest").agg(F.sum("links").alias("links"))
    known = classes.join(found, "digest", "left").join(counted, "digest", "left").select(
        "digest", F.coalesce("least", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = rows.where("n > 0").select("key", "n", "digest").join(known, "digest").select("key", "n", "component_id", "n_links")
    alone = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", "n_links")


def keep_one(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The first row of every component, with all its columns: the one of the smallest id, null ids last, then of the smallest hash of the text.

    Rows are told apart by id and text, so texts of one id stay or go each on its own, and so do rows of null ids. Of
    rows with one id and one text, one is kept; texts without shingles and without ids link with nothing and all stay.
    """
    name = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("id"), F.xxhash64(F.col(text), F.col(text).isNull()).alias("print"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), name.alias("name"))
    found = stage(spark, jaccard_join(spark, rows.select("name", F.col("row").getField(text).alias("text")), "name", "text", k, percent).select(
        F.col("name").alias("of"), "component_id", "n_shingles"), "jaccard_found")
    gone = few(spark, stage(spark, found.where("of != component_id").select("of").distinct(), "jaccard_gone"))
    same = F.col("name").eqNullSafe(F.col("of"))
    left = rows.join(gone, same, "left_anti")
    again = few(spark, stage(spark, found.where("not of.unknown or n_shingles > 0").groupBy("of").count().where("count > 1").select("of"), "jaccard_again"))
    once = left.join(again, same, "left_anti")
    return once.unionByName(left.join(again, same, "left_semi").dropDuplicates(["name"])).select("row.*")
