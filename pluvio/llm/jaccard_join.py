"""N-gram Jaccard join: an exact self-join of shingle sets in the metric space of the Jaccard distance.

A document is the set of its distinct five-word shingles. Equal sets form a class; classes link when their similarity is
``PERCENT`` or more, that is when their distance is ``REACH`` (0.25) or less. The steps:

1. *Reach.* A class whose shingles occur in other sets for less than ``PERCENT`` of its size can't link; counting each shingle's
   classes once shows which those are. They are outside of every region.
2. *Pivots and first regions.* Unrelated texts all lie at distance 1, so pivots drawn blindly part nothing. Linked sets share one of the
   first n - ceil(PERCENT n) + 1 shingles of any fixed order; the smallest class that holds such a shingle is its pivot, and
   all classes that hold it (and have a partner in the size window) are attached to the pivot's region.
3. *Voronoi regions, windows, recursion.* A region above ``REGION`` members picks pivots among them; each member goes to the
   nearest (its home) and, since the triangle inequality leaves no other place for a partner, to every other pivot at most
   2 * REACH farther. Cells are parted again until they are small. Cells that no pivot parts are joined tile by tile.
4. *Exact join* of each small cell with all intersections at once. A pair counts where the smaller class is at home, in the
   region of the smallest pivot that both are attached to, so once in all.

Cells return link counts and a spanning forest, never their pairs; large-star and small-star rounds join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..stored import keep
from ..workers import portable
from .common import batch_shingles, batch_words, batches, bitmap_bits, bitmap_of, buckets_for, in_bitmap, mapped, materialize, mix64, partitions

WIDTH, PERCENT, REACH = 5, 75, 0.25
REGION, PIVOTS, DEPTH, TILE = 512, 16, 4, 256
HOT = 32
CHUNK_SHINGLES = 1 << 19
BUCKET_BYTES = 4 << 20  # of the documents' files; a bucket's postings are some 10 MB
HUB, HUBS = 256, 100_000  # rows of a node from which on it is a hub, and as many hubs as are sent to every executor
ROUNDS = 60  # of the components at most
_BATCH_BYTES = 1 << 20
_LOW48 = np.uint64((1 << 48) - 1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes; empty without words."""
    h, begin = batch_shingles(*batch_words(texts), WIDTH)
    return [np.unique(h[a:b]) for a, b in zip(begin, begin[1:])]


def class_of(s: np.ndarray) -> bytes:
    """128 bits over the whole set; all zero for the empty one."""
    if not len(s):
        return bytes(16)
    a = mix64(s + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = mix64(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


def needed(n: np.ndarray) -> np.ndarray:
    """The least intersection with any partner: ceil(0.75 n)."""
    return (PERCENT * n + 99) // 100


# --- 1. reach -------------------------------------------------------------------------------------------------------------


def _pack(h: np.ndarray) -> bytes:
    return np.ascontiguousarray((h & _LOW48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _tags(names: np.ndarray, bucket: int) -> np.ndarray:
    """48 bits of each class, others in every bucket: two classes that one bucket takes for one are two in the next."""
    return mix64(names ^ np.uint64((bucket + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & _LOW48


_BLOBS = "bucket int, chunk string, listed boolean, tags binary, at binary, keys binary, known binary, known_n binary, info binary"


def _blobs(buckets: int):
    """Map side: a chunk's shingles, each once, dealt to buckets by hash. Those of two classes here are known to be shared."""

    def emit(ids: list, sets: list[np.ndarray], names: list[bytes], owner: list[int], chunk: str) -> pa.RecordBatch:
        n = np.array([len(s) for s in sets], np.int64)
        h = np.concatenate(sets)
        order = np.argsort(h)
        h, at = h[order], np.repeat(np.arange(len(sets)), n)[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(h)))
        many = np.repeat(count > 1, count)
        local = np.bincount(at[many], minlength=len(sets))
        one, one_at = h[~many], at[~many].astype(np.uint16)
        more, more_n = h[first[count > 1]], np.minimum(count[count > 1], 65535).astype(np.uint16)
        edges = np.array([-(-(b << 32) // buckets) << 32 for b in range(1, buckets)], dtype=np.uint64)
        cut, cut_more = [0, *np.searchsorted(one, edges), len(one)], [0, *np.searchsorted(more, edges), len(more)]
        import pickle

        info = pickle.dumps((ids, owner, names, n.tolist(), local.tolist()))
        lanes = np.frombuffer(b"".join(x[:8] for x in names), np.uint64)
        rows = [
            (b, chunk, j - i >= len(lanes), _pack(_tags(lanes if j - i >= len(lanes) else lanes[one_at[i:j]], b)), one_at[i:j].tobytes(), _pack(one[i:j]), _pack(more[k:m]), more_n[k:m].tobytes(), info if b == 0 else None)
            for b, (i, j, k, m) in enumerate(zip(cut, cut[1:], cut_more, cut_more[1:]))
            if j > i or m > k or b == 0
        ]
        kinds = [pa.int32(), pa.string(), pa.bool_(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in _BLOBS.split(", ")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a chunk is named by its partition and number, so that a task that runs again sends the same ones
        partition, made = TaskContext.get().partitionId(), 0
        ids, sets, owner, where, total = [], [], [], {}, 0
        for batch in batches(it, _BATCH_BYTES):
            for doc_id, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                name = class_of(s)
                if name not in where:
                    where[name] = len(sets)
                    sets.append(s)
                    total += len(s)
                ids.append(doc_id)
                owner.append(where[name])
                if total >= CHUNK_SHINGLES or len(ids) >= 60000:
                    yield emit(ids, sets, list(where), owner, f"{partition}:{made}")
                    made += 1
                    ids, sets, owner, where, total = [], [], [], {}, 0
        if ids:
            yield emit(ids, sets, list(where), owner, f"{partition}:{made}")

    return run


def _by_key(it: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[object, list[dict]]]:
    """Groups of rows with an equal first column, from rows sorted by it."""
    key, rows = None, []
    for batch in it:
        for row in batch.to_pylist():
            k = row[batch.schema.names[column]]
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append(row)
    if rows:
        yield key, rows


def _shared_counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket holds all postings of its shingles: which occur in two different sets, and which in HOT or more?

    A chunk sends the tags of all its classes where it has more postings than classes, else one a posting."""
    for _, rows in _by_key(it):
        keys = np.concatenate([_unpack(r["keys"]) for r in rows])
        at = [np.frombuffer(r["at"], np.uint16).astype(np.int64) for r in rows]
        tags = [_unpack(r["tags"]) for r in rows]
        small = np.concatenate([t[a] if r["listed"] else t for r, t, a in zip(rows, tags, at)])
        known = np.concatenate([_unpack(r["known"]) for r in rows])
        known_n = np.concatenate([np.frombuffer(r["known_n"], np.uint16) for r in rows]).astype(np.int64)
        known_keys, inverse = np.unique(known, return_inverse=True)
        known_n = np.bincount(inverse, weights=known_n, minlength=len(known_keys))
        shared = np.zeros(len(keys), np.bool_)
        hot = known_keys[known_n >= HOT]
        if len(keys):
            order = np.argsort(keys, kind="stable")
            k, c = keys[order], small[order]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            n = np.diff(np.append(first, len(k)))
            differ = np.minimum.reduceat(c, first) != np.maximum.reduceat(c, first)
            if len(known_keys):
                j = np.minimum(np.searchsorted(known_keys, k[first]), len(known_keys) - 1)
                also = known_keys[j] == k[first]
                differ |= also
                n = n + np.where(also, known_n[j], 0)
            shared[order] = np.repeat(differ, np.diff(np.append(first, len(k))))
            hot = np.unique(np.concatenate((hot, k[first][n >= HOT])))
        out, i = [], 0
        for r, a in zip(rows, at):
            own, many = np.unique(a[shared[i : i + len(a)]], return_counts=True)
            out.append((r["chunk"], own.astype(np.uint16).tobytes(), many.astype(np.uint32).tobytes(), r["info"], hot.tobytes() if r is rows[0] else None))
            i += len(a)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), *[pa.binary()] * 4])], names=["chunk", "places", "counts", "info", "hot"])


_NODES = "doc_id long, n_shingles long, class binary, near boolean"


def _nodes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's documents, each with its class and whether that has enough shared shingles."""
    import pickle

    for _, rows in _by_key(it):
        ids, owner, names, n, local = pickle.loads(next(r["info"] for r in rows if r["info"] is not None))
        shared = np.array(local, np.int64)
        for r in rows:
            shared[np.frombuffer(r["places"], np.uint16)] += np.frombuffer(r["counts"], np.uint32)
        n = np.array(n, np.int64)
        near = (n > 0) & (shared >= needed(n))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n[owner], pa.int64()), pa.array([names[i] for i in owner], pa.binary()), pa.array(near[owner])],
            names=["doc_id", "n_shingles", "class", "near"],
        )


def _lanes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for data in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(data, np.int64))], names=["lane"])


# --- 2. pivots and first regions --------------------------------------------------------------------------------------------


def prefix_of(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.75 n) + 1 shingles: those that few sets hold come first, then by hash."""
    m = len(s) - int(needed(np.int64(len(s)))) + 1
    late = in_bitmap(hot, (s & _LOW48).view(np.int64))
    return np.concatenate((s[~late], s[late]))[:m]


def _sets(wanted: np.ndarray, hot: np.ndarray):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, _BATCH_BYTES):
            batch = batch.take(pa.array(np.flatnonzero(in_bitmap(wanted, np.asarray(batch.column(0).fill_null(-1))))))
            out = []
            for doc_id, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1))):
                if len(s):
                    out.append((class_of(s), doc_id, s.tobytes(), prefix_of(s, hot).view(np.int64)))
            if out:
                a, b, c, d = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.binary()), pa.array([x.tolist() for x in d], pa.list_(pa.int64()))], names=["class", "doc_id", "shingles", "prefix"])

    return run


def first_regions(sets: DataFrame) -> DataFrame:
    """region (the pivot's class), class: who is attached to which pivot. Regions of one have gone."""
    n = F.col("n")
    key = Window.partitionBy("key")
    by_size = key.orderBy("n", "class")
    postings = sets.select("class", "n", F.explode("prefix").alias("key"))
    near = (F.lag("n").over(by_size) * 100 >= n * PERCENT) | (n * 100 >= F.lead("n").over(by_size) * PERCENT)
    held = postings.withColumn("near", near).where("near").withColumn("region", F.min("class").over(key))
    regions = held.select("region", "class").distinct()
    return regions.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("region"))).where("members > 1")


# --- 3. Voronoi regions -----------------------------------------------------------------------------------------------------


def intersections(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """The sizes of all intersections: products of incidence matrices over the shingles that two sets or more hold."""
    everyone = sets + (others or [])
    if len(everyone) == 2 and others is None:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    h = np.concatenate(everyone)
    who = np.repeat(np.arange(len(everyone)), [len(s) for s in everyone])
    _, col, count = np.unique(h, return_inverse=True, return_counts=True)
    keep = count[col] > 1
    who, col = who[keep], col[keep]
    dense = np.cumsum(count > 1) - 1
    col = dense[col]
    m, k = len(sets), len(everyone)
    out = np.zeros((m, m if others is None else k - m), np.float64)
    order = np.argsort(col, kind="stable")
    who, col = who[order], col[order]
    width = max(256, (4 << 20) // k)
    for a in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        i, j = np.searchsorted(col, (a, a + width))
        x = np.zeros((k, width), np.float32)
        x[who[i:j], col[i:j] - a] = 1
        out += x[:m] @ (x[:m].T if others is None else x[m:].T)
    out = np.rint(out).astype(np.int64)
    if others is None:
        np.fill_diagonal(out, [len(s) for s in sets])
    return out


_CELLS = "region binary, cell string, class binary, home boolean, depth int, members long"


def _part(key: tuple, left, right):
    """Members of a part of a cell against all its pivots: the nearest is home; windows of 2 * REACH add the others."""
    import pandas as pd

    if not len(left) or not len(right):
        return pd.DataFrame({"region": [], "cell": [], "class": [], "home": []})
    right = right.sort_values("pivot")
    sets = [np.frombuffer(x, np.uint64) for x in left["shingles"]]
    pivots = [np.frombuffer(x, np.uint64) for x in right["shingles"]]
    both = intersections(sets, pivots)
    union = np.array([len(s) for s in sets])[:, None] + np.array([len(p) for p in pivots])[None, :] - both
    away = 1 - both / union
    home = away.argmin(axis=1)
    inside = away <= away.min(axis=1)[:, None] + 2 * REACH + 1e-9
    i, j = np.nonzero(inside)
    cells = left["cell"].to_numpy()
    return pd.DataFrame({"region": left["region"].to_numpy()[i], "cell": [f"{c}/{k}" for c, k in zip(cells[i], j)], "class": left["class"].to_numpy()[i], "home": left["home"].to_numpy()[i] & (home[i] == j)})


def part_cells(large: DataFrame, sets: DataFrame) -> DataFrame:
    """One level of the recursion. A cell's members are dealt to parts of about REGION; its few pivots go to each part."""
    lane = F.xxhash64("class")
    rank = F.row_number().over(Window.partitionBy("region", "cell").orderBy(lane, "class"))
    dealt = large.withColumn("part", F.pmod(lane, F.ceil(F.col("members") / REGION)).cast("int"))
    pivots = large.where("home").withColumn("pivot", rank).where(F.col("pivot") <= PIVOTS).select("region", "cell", "class", "pivot", "members")
    everywhere = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("members") / REGION) - 1).cast("int"))))
    left = dealt.select("region", "cell", "class", "home", "part").join(sets.select("class", "shingles"), "class")
    right = everywhere.select("region", "cell", "part", "class", "pivot").join(sets.select("class", "shingles"), "class")
    key = ["region", "cell", "part"]
    left, right = (x.toDF(*x.columns) for x in (left, right))  # fresh names: both sides come from the same tables
    return left.groupBy(*key).cogroup(right.select(*(F.col(c).alias(c) for c in right.columns)).groupBy(*key)).applyInPandas(portable(_part), "region binary, cell string, class binary, home boolean")


def tiles(rows: DataFrame) -> DataFrame:
    """Cells as tasks: a cell of REGION members or less is one; a larger one becomes pairs of tiles, each pair a task."""
    tile = F.pmod(F.xxhash64("class", F.lit(1)), F.ceil(F.col("members") / TILE)).cast("int")
    n = F.ceil(F.col("members") / TILE).cast("int")
    pair = F.transform(F.sequence(F.lit(0), n - 1), lambda o: F.struct(F.least(tile, o).alias("a"), F.greatest(tile, o).alias("b")))
    task = F.when(F.col("members") <= REGION, F.array(F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b")))).otherwise(pair)
    return rows.withColumn("tile", tile).withColumn("task", F.explode(task))


# --- 4. exact join ------------------------------------------------------------------------------------------------------------

_JOINED = "class binary, other binary, links long"


def _join_cells(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their cell's task. Gives (class, null, links) and the edges (class, other, 0) of a spanning forest."""
    for _, rows in _by_key(it):
        m = len(rows)
        if m < 2:
            continue
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        size = np.array([len(s) for s in sets])
        both = intersections(sets)
        linked = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(linked, False)
        a, b = rows[0]["a"], rows[0]["b"]
        if a != b:  # a pair of tiles joins across only
            tile = np.array([r["tile"] for r in rows])
            linked &= tile[:, None] != tile[None, :]
        i, j = np.nonzero(np.triu(linked))
        if not len(i):
            continue
        yield _forest(rows, i, j)
        name = np.array([r["class"] for r in rows], object)
        at_home = np.array([r["home"] for r in rows])
        lesser = np.where(name[i] < name[j], i, j)
        region = rows[0]["region"]
        first = np.array([r["pivots"][0] == region for r in rows])
        mine = at_home[lesser]
        unsure = np.flatnonzero(mine & ~(first[i] & first[j]))
        for k in unsure:  # this region must be the smallest pivot of both
            mine[k] = min(set(rows[i[k]]["pivots"]) & set(rows[j[k]]["pivots"])) == region
        i, j = i[mine], j[mine]
        copies = np.array([r["copies"] for r in rows])
        links = np.bincount(i, weights=copies[j], minlength=m) + np.bincount(j, weights=copies[i], minlength=m)
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(name[at].tolist(), pa.binary()), pa.nulls(len(at), pa.binary()), pa.array(links[at].astype(np.int64))], names=["class", "other", "links"])


def _forest(rows: list[dict], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    root = np.arange(len(rows))
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(root != np.arange(len(rows)))
    return pa.RecordBatch.from_arrays([pa.array([rows[k]["class"] for k in at], pa.binary()), pa.array([rows[k]["class"] for k in root[at]], pa.binary()), pa.array(np.zeros(len(at), np.int64))], names=["class", "other", "links"])


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows`` (u, v) with ``m`` of their u from ``least`` (u, m, n). ``least`` is written, so that both sides are plain exchanges; rows
    of hubs do not travel at all: while hubs are no more than HUBS, they meet a table of them that every executor holds."""
    hubs = least.where(F.col("n") >= HUB).select("u", "m")
    if hubs.count() > HUBS:
        return rows.join(least.select("u", "m"), "u")
    rest = rows.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(least.where(F.col("n") < HUB).select("u", "m"), "u")
    return rest.unionByName(rows.join(F.broadcast(hubs), "u"))


def components(edges: DataFrame) -> DataFrame:
    """u, root: the smallest node that can be reached, for every node of ``edges`` (u, v). Alternates large-star and
    small-star until nothing changes; each round's edges are a table of at most as many rows, and go when the next one is written.
    ``ROUNDS`` rounds settle far longer chains than any table holds (they grow with the square of a logarithm); if they do not, that is an error."""
    now, held = keep(edges.where("u != v").distinct(), "edges_0")
    mark, rest = None, []

    def written(df: DataFrame, name: str) -> DataFrame:
        out, handle = keep(df, name)
        rest.append(handle)
        return out

    for step in range(1, ROUNDS):
        both = written(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), f"both_{step}")
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n")), f"least_{step}")
        large = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = written(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), f"down_{step}")
        low = written(down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), f"low_{step}")
        small = _with_least(down, low).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        before = held
        now, held = keep(small, f"edges_{step}")
        for handle in (before, *rest):
            handle.release()
        rest.clear()
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components are not settled after {ROUNDS - 1} rounds")
    return now.select("u", F.col("v").alias("root"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, class of every document.

    component_id is the smallest doc_id reachable by links, itself included; n_links the number of other documents it links
    with. Null or wordless texts have no shingle, no link and their own id. Rows with null ids take part and get the smallest
    id of their component, null if there is none. Repeated rows link with each other. An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = buckets_for(docs, max(16, 2 * partitions(spark)), BUCKET_BYTES)
    blobs = rows.transform(mapped, _blobs(buckets), _BLOBS).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counts = materialize(blobs.transform(mapped, _shared_counts, "chunk string, places binary, counts binary, info binary, hot binary"), "shared_shingles")
    frequent = counts.where("hot is not null")
    hot = bitmap_of(frequent.select("hot").transform(mapped, _lanes, "lane long"), F.col("lane"), bitmap_bits(frequent.agg(F.coalesce(F.sum(F.octet_length("hot")), F.lit(0))).first()[0] // 8))
    by_chunk = counts.select("chunk", "places", "counts", "info").repartition(buckets, "chunk").sortWithinPartitions("chunk")
    nodes = materialize(by_chunk.transform(mapped, _nodes, _NODES), "nodes")
    classes = materialize(nodes.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"), F.max("near").alias("near")), "classes")

    near = classes.where("near").select("class", "least", "copies", "n")
    wanted = bitmap_of(near, F.coalesce("least", F.lit(-1)), bitmap_bits(near.count()))
    texts = rows.transform(mapped, _sets(wanted, hot), "class binary, doc_id long, shingles binary, prefix array<long>")
    exact = (texts["class"] == near["class"]) & texts["doc_id"].eqNullSafe(near["least"])
    sets = materialize(texts.join(near, exact).select(texts["class"], "copies", "n", "shingles", "prefix").dropDuplicates(["class"]), "sets")

    regions = materialize(first_regions(sets), "regions")
    pivots = materialize(regions.groupBy("class").agg(F.array_sort(F.collect_list("region")).alias("pivots")), "pivots_of")
    cells = regions.select("region", F.lit("").alias("cell"), "class", F.lit(True).alias("home"), F.lit(0).alias("depth"), "members")
    ready = cells.where(F.col("members") <= REGION)
    large = cells.where(F.col("members") > REGION)
    for depth in range(1, DEPTH + 1):
        if not large.limit(1).count():
            break
        before = large.select("region", "cell", F.col("members").alias("was")).distinct()
        parted = part_cells(large, sets).withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("region", "cell")))
        parted = materialize(parted.withColumn("depth", F.lit(depth)), f"cells_{depth}")
        parent = F.regexp_replace("cell", "/[0-9]+$", "").alias("parent")
        size = parted.select("region", parent, "members").groupBy("region", "parent").agg(F.max("members").alias("most"))
        # pivots that leave some cell nearly whole part nothing: the parent goes to tiles instead
        judged = before.join(size.withColumnRenamed("parent", "cell"), ["region", "cell"])
        stuck = judged.where(F.col("most") > 0.8 * F.col("was")).select("region", "cell")
        whole = large.join(stuck, ["region", "cell"], "left_semi")
        fresh = parted.withColumn("parent", parent).join(stuck.withColumnRenamed("cell", "parent"), ["region", "parent"], "left_anti").select(*large.columns)
        ready = ready.unionByName(whole).unionByName(fresh.where(F.col("members") <= REGION))
        large = fresh.where(F.col("members") > REGION)
    ready = ready.unionByName(large)

    tasks = tiles(ready).select(F.xxhash64("region", "cell", "task.a", "task.b").alias("task"), "region", "class", "home", F.col("task.a").alias("a"), F.col("task.b").alias("b"), "tile")
    full = tasks.join(pivots, "class").join(sets.select("class", "copies", "shingles"), "class")
    dealt = full.select("task", "region", "class", "home", "a", "b", "tile", "pivots", "copies", "shingles").repartition(buckets, "task").sortWithinPartitions("task", "class")
    found = materialize(dealt.transform(mapped, _join_cells, _JOINED), "links")

    roots = components(found.where("other is not null").select(F.col("class").alias("u"), F.col("other").alias("v")))
    links = found.where("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    placed = classes.select("class", "least", "copies").join(roots.withColumnRenamed("u", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = placed.join(least, "root").join(links, "class", "left").select("class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    by_class = materialize(by_class, "class_components")  # then a class of many copies can be split in the join
    linked = nodes.where("n_shingles > 0").join(by_class, "class").select("doc_id", "n_shingles", "component_id", "n_links", "class")
    return linked.unionByName(nodes.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), "class"))
