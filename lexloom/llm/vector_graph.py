"""Approximate nearest neighbours on robust-pruned directed graphs, one a shard.

Within a shard, greedy searches propose neighbours for every vector and pruning keeps
an edge only if no kept neighbour is much closer to its end (a factor ``alpha`` relaxes
this, which leaves long edges in). A query walks each shard's graph with a beam and the
shards' best are merged. Searches of many vectors advance together as array operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, saved, small_batches

#: Vectors of a shard, edges of a vector, beam of a search, relaxation of the pruning, queries searched at once,
#: queries that one task is given.
SHARD, DEGREE, BEAM, ALPHA, BLOCK, TASK = 4096, 24, 64, 1.2, 512, 8192


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances row by row, from differences: close directions keep their order in single precision."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def beam_search(unit: np.ndarray, edges: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ids (-1: none) and squared distances of its beam, nearest first."""
    q, n = len(queries), len(unit)
    ids = np.full((q, beam), -1, np.int64)
    far = np.full((q, beam), np.inf, np.float32)
    done = np.zeros((q, beam), bool)
    first = np.stack([_apart(unit[e], queries) for e in entry], axis=1)
    order = np.argsort(first, axis=1, kind="stable")[:, :beam]
    ids[:, : order.shape[1]], far[:, : order.shape[1]] = entry[order], np.take_along_axis(first, order, 1)
    active = np.arange(q)
    seen = np.zeros((q, n), bool)
    seen[:, entry] = True
    while len(active):
        open_ = ~done[active] & (ids[active] >= 0)
        has = open_.any(axis=1)
        active, open_ = active[has], open_[has]
        if not len(active):
            break
        at = open_.argmax(axis=1)
        done[active, at] = True
        near = edges[ids[active, at]]
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        seen[active[r], near[r, c]] = True
        distance = np.full(near.shape, np.inf, np.float32)
        distance[r, c] = _apart(unit[near[r, c]], queries[active[r]])
        every = np.concatenate([far[active], distance], axis=1)
        keep = np.argsort(every, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1), keep, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1), keep, 1)
        far[active] = np.take_along_axis(every, keep, 1)
    return ids, far


def robust_prune(unit: np.ndarray, points: np.ndarray, found: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Edges (-1: none) of the points, out of candidate ids (-1: none) given for each."""
    found = np.sort(found, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    alive = (found >= 0) & (found != points[:, None])
    vectors = unit[np.maximum(found, 0)]
    away = vectors - unit[points][:, None, :]
    size = np.einsum("bcd,bcd->bc", away, away)
    own = np.where(alive, size, np.inf)
    # From the point's own place: differences of near neighbours don't cancel out.
    between = size[:, :, None] + size[:, None, :] - 2 * away @ away.transpose(0, 2, 1)
    out, rows = np.full((len(points), degree), -1, np.int64), np.arange(len(points))
    for k in range(degree):
        pick = np.where(alive, own, np.inf).argmin(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = found[rows, pick][some]
        alive[rows, pick] = False
        alive &= ~((alpha * alpha * between[rows, pick] <= own) & some[:, None])
    return out


def _with_incoming(unit: np.ndarray, edges: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Add each edge's reverse and prune again where that makes too many."""
    n = len(edges)
    source, target = np.repeat(np.arange(n), edges.shape[1]), edges.ravel()
    real = target >= 0
    source, target = source[real], target[real]
    order = np.lexsort((_apart(unit[source], unit[target]), target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    near = place < 2 * degree
    incoming = np.full((n, 2 * degree), -1, np.int64)
    incoming[target[near], place[near]] = source[near]
    both = np.concatenate([edges, incoming], axis=1)
    return np.concatenate([robust_prune(unit, np.arange(i, min(n, i + 256)), both[i : i + 256], degree, alpha) for i in range(0, n, 256)])


def build(unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, rounds: int = 2, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entry points) of a shard's graph."""
    n, rng = len(unit), np.random.default_rng(seed)
    centre = int((unit @ unit.mean(axis=0)).argmax())
    entry = np.unique(np.append(rng.choice(n, min(n, 16), replace=False), centre))
    if n <= degree + 1:
        edges = np.tile(np.arange(n), (n, 1))
        return np.where(edges == np.arange(n)[:, None], -1, edges), entry
    edges = rng.integers(0, n, (n, degree))
    for round_ in range(rounds):
        new = edges.copy()
        relaxed = alpha if round_ else 1.0
        for i in range(0, n, 256):
            points = np.arange(i, min(n, i + 256))
            found, _ = beam_search(unit, edges, entry, unit[points], beam)
            new[points] = robust_prune(unit, points, np.concatenate([found, edges[points]], axis=1), degree, relaxed)
        edges = _with_incoming(unit, new, degree, relaxed)
    return _linked(unit, edges, entry), entry


def _linked(unit: np.ndarray, edges: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Edges by which every point is reached from the entries: a point that none leads to gets
    one from the nearest reached point that has a place left."""
    reached = np.zeros(len(unit), bool)

    def reach(front: np.ndarray) -> None:
        reached[front] = True
        while len(front):
            near = np.unique(edges[front])
            near = near[near >= 0]
            front = near[~reached[near]]
            reached[front] = True

    reach(entry)
    for point in np.flatnonzero(~reached):
        if reached[point]:
            continue
        places = reached & (edges < 0).any(axis=1)
        if not places.any():
            edges = np.concatenate([edges, np.full((len(edges), 1), -1, edges.dtype)], axis=1)
            places = reached
        at = int(np.where(places, _apart(unit, unit[point]), np.inf).argmin())
        edges[at, int((edges[at] < 0).argmax())] = point
        reach(np.array([point]))
    return edges


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part: an id, and a vector that isn't zero and whose components are all finite."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    narrow = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return narrow.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(finite & F.exists("v", lambda x: x != 0))


def _direction() -> F.Column:
    """A vector's direction to about 12 digits: what differs from it by its length alone falls together."""
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    return F.transform("v", lambda x: F.round(x / top, 12) + F.lit(0.0))


def index(table: DataFrame, shard_rows: int = SHARD, keep: int = 6, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a shard: dim, shard, vectors, ids, edges and entry points.

    Every vector is in the index. Of vectors of one direction (to 12 digits: their cosines with
    any query differ by rounding alone) the ``keep`` smallest ids are held, so a vector that very
    many rows share costs no more than another; a search for the k nearest needs ``keep`` to be
    k + 1 where that many are equal. Vectors that single precision can't tell apart are one
    point of the graph, and all of them are scored where a search meets it."""
    own = vectors(table, id_col, vector_col).distinct().withColumn("way", _direction())
    # Spark keeps the first ranks of a key before the shuffle, too.
    ranked = own.withColumn("r", F.row_number().over(Window.partitionBy("way").orderBy("vec_id"))).where(F.col("r") <= keep)
    points = saved(ranked.groupBy("way", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), (F.max("r") >= keep).alias("full")), "vector-points")
    shards = max(1, -(-points.count() // shard_rows))
    dealt = points.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("way"), F.lit(shards)).cast("long").alias("shard"), "v", "ids", "full")

    def one(part: pa.Table) -> pa.Table:
        part = part.combine_chunks().sort_by([("first", "ascending")])
        x = np.array(part.column("v").to_pylist(), np.float64)
        ids = part.column("ids").to_pylist()
        unit, member = np.unique(_unit(x), axis=0, return_inverse=True)
        edges, entry = build(unit, degree, beam, alpha)
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "shard": pa.array([part.column("shard")[0].as_py()], pa.int64()), "x": pa.array([x.tobytes()], pa.binary()), "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))), "keep": pa.array([keep], pa.int32()), "full": pa.array([any(part.column("full").to_pylist())]), "member": pa.array([member.ravel().astype(np.int32).tobytes()], pa.binary()), "edges": pa.array([edges.astype(np.int32).tobytes()], pa.binary()), "entry": pa.array([entry], pa.list_(pa.int64()))})

    graphs = dealt.withColumn("first", F.col("ids")[0]).groupBy("dim", "shard").applyInArrow(one, "dim int, shard long, x binary, ids array<array<long>>, keep int, full boolean, member binary, edges binary, entry array<long>")
    built = saved(graphs, "vector-index")
    forget(points)
    return built


def _shard_search(row: dict, names: np.ndarray, asked: np.ndarray, k: int, beam: int) -> pa.Table:
    """A shard's k best of some queries, by the scores and ties that count in the end."""
    x = np.frombuffer(row["x"], np.float64).reshape(-1, row["dim"])
    member = np.frombuffer(row["member"], np.int32)
    by = np.argsort(member, kind="stable")
    bounds = np.searchsorted(member[by], np.arange(member.max() + 2))
    unit = _unit(x[by[bounds[:-1]]])
    graph = np.frombuffer(row["edges"], np.int32).reshape(len(unit), -1).astype(np.int64)
    near, _ = beam_search(unit, graph, np.array(row["entry"]), _unit(asked), max(beam, k + 1))
    rows, cols = np.nonzero(near >= 0)
    group = near[rows, cols]
    size = bounds[group + 1] - bounds[group]
    rows = np.repeat(rows, size)
    point = by[np.repeat(bounds[group] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    score = np.empty(len(rows))
    for i in range(0, len(rows), 1 << 18):
        a, b = asked[rows[i : i + (1 << 18)]], x[point[i : i + (1 << 18)]]
        score[i : i + (1 << 18)] = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
    many = [row["ids"][p] for p in point.tolist()]
    size = np.array([len(z) for z in many], np.int64)
    query, vec, score = np.repeat(names[rows], size), np.array([z for ids in many for z in ids], np.int64), np.repeat(score, size)
    order = np.lexsort((vec, -score, query))
    order = order[(query != vec)[order]]
    order = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < k]
    return pa.table([pa.array(query[order]), pa.array(vec[order]), pa.array(score[order])], ["query_id", "vec_id", "score"])


def search(held: DataFrame, queries: DataFrame, k: int = 5, beam: int = 2 * BEAM, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by cosine, itself left out.

    Queries are dealt into parts of about ``TASK``; a task has one part and one shard, and a
    shard's graph is sent once a part. Scores are computed in double precision on the
    original vectors; ties go to the smaller vec_id. Rows with a null, zero or non-finite
    vector or no id have no result; rows that repeat an id are one query; vectors of
    another length are no candidates; fewer candidates give fewer rows; an empty table
    gives none.
    """
    small_batches(held.sparkSession)
    of = vectors(queries, id_col, vector_col).dropDuplicates(["vec_id"]).withColumn("dim", F.size("v"))
    asked = of.groupBy("dim").agg(F.count("*").alias("c"))
    size = held.groupBy("dim").agg((F.max("shard") + 1).alias("shards")).join(asked, "dim").select("dim", "shards", F.expr(f"(c + {TASK - 1}) div {TASK}").alias("parts"))  # one row a length
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = held.join(size.select("dim", "parts"), "dim").withColumn("part", every("parts")).groupBy("dim", "shard", "part")
    right = of.join(size, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts")).withColumn("shard", every("shards")).select("dim", "shard", "part", "vec_id", "v").groupBy("dim", "shard", "part")

    def run(shard: pa.Table, part: pa.Table) -> pa.Table:
        out = [pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()]
        if shard.num_rows and part.num_rows:
            row = shard.to_pylist()[0]
            if k >= row["keep"] and row["full"]:
                raise ValueError(f"an index that keeps {row['keep']} ids of equal vectors can't give {k} nearest: build it with keep={k + 1}")
            names = part.column("vec_id").to_numpy()
            vectors_ = np.array(part.column("v").to_pylist(), np.float64)
            out += [_shard_search(row, names[i : i + block], vectors_[i : i + block], k, beam) for i in range(0, len(names), block)]
        return pa.concat_tables(out)

    found = left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(index(table), table.where("vec_id % 50 = 0"))
