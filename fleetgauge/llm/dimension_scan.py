"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Vectors of one length are turned by a random rotation, after which any few coordinates tell as much as any others, and
dealt to the list of the nearest of about sqrt(n) centers, which are fitted to ``SAMPLE`` vectors of smallest hash (at
most ``SAMPLE_BYTES``). Every vector is in one list. Lists are cut into parts of ``PART`` vectors, the queries that
probe a list into parts of ``ASK``, so a hot list is many tasks' work.

1. Audit: for ``AUDIT`` queries of smallest hash all vectors are compared. The number of lists to probe is the smallest
   that holds ``PROBE_RECALL`` of the neighbours found so.
2. Each query scans its nearest lists, as many as hold k candidates, in full: its radius is the k-th best distance.
3. In the other probed lists, coordinates are read in blocks of ``COLUMNS``. After each, the distance so far stands for
   a sample of the whole one: a candidate is abandoned once that sample would be too large, by ``EPSILON`` standard
   widths, for a distance within the radius. Survivors get their distance from the original vectors.
4. The audited queries' results are compared with what step 1 found. Below ``RECALL`` twice as many lists are probed, in
   the end all, and then without abandoning any. The measured recall is part of the result.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components are neither queries nor
candidates; vectors of different lengths are not compared. Each row is a row of its own, also if another has its id or
vector; a null id is no query unless ``is_query`` says so and comes last among ties. A query with fewer than ``k``
candidates gets all; an empty table gives no rows.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import record_batch
from .scratch import Scratch
from .windows import whole_groups

log = logging.getLogger(__name__)

K = 10
SAMPLE, SAMPLE_BYTES = 16_384, 16 << 20
#: Vectors of the sample for each center, and rounds of fitting.
PER_CENTER, FITTING = 16, 8
PART, ASK = 128, 128
COLUMNS = 16
EPSILON = 2.1
AUDIT, PROBE_RECALL, RECALL = 64, 0.97, 0.9
#: Rounding in a distance, in parts of the squared norms.
ROUNDING = 1e-12


def search(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, audit: int = AUDIT
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (the distance), audited_recall. ``is_query`` is over ``vectors``."""
    scratch = Scratch(vectors.sparkSession, "scan")
    rows = scratch.keep(_usable(vectors, is_query, id_col, vector_col), "usable")
    # numbered in a table of its own, so that a task that is run again gives the same numbers
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    index = _fitted(rows)
    lists = scratch.keep(rows.mapInArrow(_assign(index), _ROWS_TYPE), "lists")
    sizes = {r.list: r.n for r in lists.groupBy("list").agg(F.count("*").alias("n")).collect()}  # one a center
    queries = lists.where("query")
    truth, asked = _audit(queries, lists, k, audit, scratch)
    probes, most = _needed(index, asked, truth), max((len(c) for _, c in index.values()), default=1)
    turn = 0
    while True:
        whole = turn > 0 and probes >= most
        found = scratch.keep(_searched(queries, lists, index, sizes, probes, k, not whole, scratch, turn), f"found{turn}")
        recall = _recall(found, truth)
        log.info("%d of %d lists probed, audited recall %.4f", min(probes, most), most, recall)
        if recall >= RECALL or whole:
            break
        probes, turn = probes * 2, turn + 1
    columns = ("query_id", F.col("place").alias("rank"), F.col("id").alias("vec_id"), "score")
    return found.select(*columns, F.lit(recall).alias("audited_recall"))


def _usable(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(finite & F.exists("v", lambda c: c != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# ---- the index -------------------------------------------------------------------------------
Index = dict[int, tuple[np.ndarray, np.ndarray]]


def _rotation(dim: int) -> np.ndarray:
    """A random rotation, fixed for each length."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _fitted(rows: DataFrame) -> Index:
    """Rotation and centers for each length of vectors in a bounded sample."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("longest")).first()
    if not size.n:
        return {}
    wanted = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * size.longest)))
    sample = rows.orderBy(F.xxhash64("id", "v"), "row").limit(wanted).select("v").toArrow().column(0).combine_chunks()
    length = pc.list_value_length(sample).to_numpy(zero_copy_only=False)
    index = {}
    for dim in np.unique(length).tolist():
        part = sample.filter(pa.array(length == dim))
        rotation = _rotation(dim)
        share = size.n * len(part) / len(sample)
        centers = max(1, min(int(np.ceil(np.sqrt(share))), len(part) // PER_CENTER))
        index[dim] = rotation, _centers(_matrix(part) @ rotation, centers)
    return index


def _centers(x: np.ndarray, n: int) -> np.ndarray:
    """Means of ``n`` groups of neighbours; a group that runs empty keeps its center."""
    centers = x[np.random.default_rng(n).choice(len(x), n, replace=False)]
    for _ in range(FITTING):
        nearest = _to_centers(x, centers).argmin(axis=1)
        sums, counts = np.zeros_like(centers), np.bincount(nearest, minlength=n)
        np.add.at(sums, nearest, x)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _to_centers(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, but for the vector's own square, which is the same for all centers."""
    return (centers * centers).sum(axis=1) - 2 * (x @ centers.T)


def _list_of(dim: int, center: np.ndarray | int):
    return (dim << 32) + center


def _of_length(index: Index, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and centers; a length that the sample lacks has one list."""
    return index[dim] if dim in index else (_rotation(dim), np.zeros((1, dim)))


_ROWS_TYPE = "row long, id long, query boolean, list long, v array<double>, turned array<double>"
_ROWS = pa.schema(
    [("row", pa.int64()), ("id", pa.int64()), ("query", pa.bool_()), ("list", pa.int64())]
    + [("v", pa.list_(pa.float64())), ("turned", pa.list_(pa.float64()))]
)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], m.ravel())


def _by_length(batch: pa.RecordBatch):
    length = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
    for dim in np.unique(length).tolist():
        yield dim, batch.filter(pa.array(length == dim))


def _assign(index: Index):
    def run(batches):
        for batch in batches:
            for dim, part in _by_length(batch):
                rotation, centers = _of_length(index, dim)
                x = _matrix(part.column("v"))
                # of its own shape for each row, so that equal vectors stay equal whatever stands beside them
                turned = np.einsum("ij,jk->ik", x, rotation)
                at = _list_of(dim, _to_centers(turned, centers).argmin(axis=1).astype(np.int64))
                yield record_batch(_ROWS, [*(part.column(c) for c in ("row", "id", "query")), at, _lists(x), _lists(turned)])

    return run


# ---- audit -----------------------------------------------------------------------------------
_FOUND_TYPE = "query_row long, query_id long, row long, id long, score double, list long"
_FOUND = pa.schema([(c, pa.float64() if c == "score" else pa.int64()) for c in ("query_row", "query_id", "row", "id", "score", "list")])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` from those of ``b``."""
    d = a - b
    return np.sqrt((d * d).sum(axis=-1))


def _id_order(rows: pa.RecordBatch) -> np.ndarray:
    """The place of each row by id, nulls last, then by number."""
    ids = rows.column("id")
    order = np.lexsort((rows.column("row").to_numpy(), np.array(ids.fill_null(0)), np.array(ids.is_null())))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place


def _audit(queries: DataFrame, lists: DataFrame, k: int, audit: int, scratch: Scratch) -> tuple[DataFrame, list]:
    """The true neighbours of a few queries, by comparing these with every vector; and these queries."""
    asked = queries.orderBy(F.xxhash64("row"), "row").limit(audit).select("row", "id", "v", "turned").collect()
    few = [(r.row, r.id, np.array(r.v)) for r in asked]

    def run(batches):
        for batch in batches:
            for dim, part in _by_length(batch):
                x, row, place = _matrix(part.column("v")), part.column("row").to_numpy(), _id_order(part)
                for query, query_id, v in few:
                    if len(v) == dim:
                        score = _distances(x, v)
                        best = np.lexsort((place, score))
                        best = best[row[best] != query][:k]
                        ids = pa.array([query_id] * len(best), pa.int64())
                        columns = [np.full(len(best), query), ids, row[best], part.column("id").take(pa.array(best)), score[best]]
                        yield record_batch(_FOUND, [*columns, part.column("list").take(pa.array(best))])

    found = lists.mapInArrow(run, _FOUND_TYPE)
    return scratch.keep(_nearest(found, k), "audit"), asked


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, with their place."""
    order = W.partitionBy("query_row").orderBy("score", F.asc_nulls_last("id"), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _needed(index: Index, asked: list, truth: DataFrame) -> int:
    """Lists to probe, nearest first, that hold the wanted part of the audited neighbours."""
    rank = {}
    for r in asked:
        dim = len(r.v)
        order = np.argsort(_to_centers(np.array([r.turned]), _of_length(index, dim)[1])[0], kind="stable")
        rank |= {(r.row, _list_of(dim, int(c))): i + 1 for i, c in enumerate(order.tolist())}
    needed = sorted(rank[r.query_row, r.list] for r in truth.select("query_row", "list").collect())
    return needed[int(np.ceil(PROBE_RECALL * len(needed))) - 1] if needed else 1


def _recall(found: DataFrame, truth: DataFrame) -> float:
    """The part of the audited neighbours that were found, or others as near."""
    radius = truth.groupBy("query_row").agg(F.max("score").alias("radius"), F.count("*").alias("n"))
    good = found.join(radius, "query_row").groupBy("query_row", "n").agg(F.count_if(F.col("score") <= F.col("radius")).alias("good"))
    row = good.agg(F.sum("good").alias("good")).first()
    total = truth.count()
    return (row.good or 0) / total if total else 1.0


# ---- the scan --------------------------------------------------------------------------------
def _searched(queries, lists, index, sizes, probes, k, adaptive, scratch, turn) -> DataFrame:
    """The nearest of each query in its probed lists, with their place."""
    asking = scratch.keep(queries.mapInArrow(_probe(index, sizes, probes, k), _ASKING_TYPE), f"asking{turn}")
    none = F.lit(float("inf")).alias("radius")
    first = _scanned(asking.where("first").select("*", none), lists, sizes, k, adaptive)
    first = scratch.keep(_nearest(first, k), f"first{turn}")
    radius = first.groupBy(F.col("query_row").alias("row")).agg(
        F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("radius")
    )
    rest = asking.where("NOT first").join(radius, "row", "left").fillna(float("inf"), ["radius"])
    others = _scanned(rest, lists, sizes, k, adaptive)
    return _nearest(first.drop("place").unionByName(others), k)


_ASKING_TYPE = "row long, id long, list long, first boolean, v array<double>, turned array<double>"
_ASKING = pa.schema(
    [("row", pa.int64()), ("id", pa.int64()), ("list", pa.int64()), ("first", pa.bool_())]
    + [("v", pa.list_(pa.float64())), ("turned", pa.list_(pa.float64()))]
)


def _probe(index: Index, sizes: dict[int, int], probes: int, k: int):
    """One row for each query and list it probes; ``first`` lists together hold ``k`` candidates, the query aside."""

    def run(batches):
        for batch in batches:
            for dim, part in _by_length(batch):
                centers = _of_length(index, dim)[1]
                order = np.argsort(_to_centers(_matrix(part.column("turned")), centers), axis=1, kind="stable")
                held = np.array([sizes.get(_list_of(dim, c), 0) for c in range(len(centers))])
                before = np.cumsum(held[order], axis=1) - held[order]
                first = before < k + 1
                probed = (first | (np.arange(len(centers)) < probes)) & (held[order] > 0)
                at, nth = np.nonzero(probed)
                take = lambda c, at=at, part=part: part.column(c).take(pa.array(at))
                columns = [take("row"), take("id"), _list_of(dim, order[at, nth]), first[at, nth]]
                yield record_batch(_ASKING, [*columns, take("v"), take("turned")])

    return run


def _scanned(asking: DataFrame, lists: DataFrame, sizes: dict[int, int], k: int, adaptive: bool) -> DataFrame:
    """The best of each query in each part of the lists it asks."""
    asks = {r.list: r.n for r in asking.groupBy("list").agg(F.count("*").alias("n")).collect()}  # one a center
    known = sorted(asks)
    parts = np.array([-(-sizes[c] // PART) for c in known], dtype=np.int64)
    teams = np.array([-(-asks[c] // ASK) for c in known], dtype=np.int64)
    base = np.cumsum(parts * teams) - parts * teams
    known = np.array(known, dtype=np.int64)
    columns = ["row", "id", "list", "v", "turned"]
    theirs = lists.select(*columns, F.xxhash64("row").alias("deal"), F.lit(float("inf")).alias("radius"), F.lit(False).alias("asking"))
    mine = asking.select(*columns, F.xxhash64("row").alias("deal"), "radius", F.lit(True).alias("asking"))
    mine, theirs = (
        side.mapInArrow(_dealt(known, parts, teams, base, own), f"part long, {_DEALT_TYPE}")
        for side, own in ((mine, True), (theirs, False))
    )
    ordered = mine.unionByName(theirs).repartition("part").sortWithinPartitions("part", "asking")
    return ordered.mapInArrow(_scan(k, adaptive), _FOUND_TYPE)


_DEALT_TYPE = "row long, id long, list long, v array<double>, turned array<double>, radius double, asking boolean"


def _dealt(known: np.ndarray, parts: np.ndarray, teams: np.ndarray, base: np.ndarray, asking: bool):
    """Rows with the part they are in: a vector once for each team of its list's queries, a query for each part."""

    def run(batches):
        for batch in batches:
            of = np.searchsorted(known, batch.column("list").to_numpy())
            there = np.flatnonzero((of < len(known)) & (known[np.minimum(of, len(known) - 1)] == batch.column("list").to_numpy())) if len(known) else np.zeros(0, np.int64)
            of = of[there]
            deal = batch.column("deal").to_numpy()[there].view(np.uint64)
            own = (deal % (teams if asking else parts)[of].astype(np.uint64)).astype(np.int64)
            times = (parts if asking else teams)[of]
            at = np.repeat(np.arange(len(there)), times)
            other = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            part, team = (other, own[at]) if asking else (own[at], other)
            key = base[of[at]] + part * teams[of[at]] + team
            rest = batch.take(pa.array(there[at])).drop_columns(["deal"])
            yield pa.RecordBatch.from_arrays([pa.array(key), *rest.columns], ["part", *rest.schema.names])

    return run


def _scan(k: int, adaptive: bool):
    def run(batches):
        for batch in whole_groups(batches, "part"):
            part = batch.column("part").to_numpy()
            heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for a, b in zip(heads.tolist(), np.append(heads[1:], len(part)).tolist(), strict=True):
                one = batch.slice(a, b - a)
                asks = one.column("asking")
                mine, theirs = one.filter(asks), one.filter(pc.invert(asks))
                if mine.num_rows and theirs.num_rows:
                    yield _found_in(mine, theirs, k, adaptive)

    return run


def _found_in(mine: pa.RecordBatch, theirs: pa.RecordBatch, k: int, adaptive: bool) -> pa.RecordBatch:
    """The best of each query among some vectors."""
    radius = mine.column("radius").to_numpy()
    rows, others = mine.column("row").to_numpy(), theirs.column("row").to_numpy()
    at, to = np.nonzero(rows[:, None] != others)
    if adaptive and np.isfinite(radius).any():
        at, to = _survivors(_matrix(mine.column("turned")), _matrix(theirs.column("turned")), radius, at, to)
    score = _distances(_matrix(mine.column("v"))[at], _matrix(theirs.column("v"))[to])
    order = np.lexsort((_id_order(theirs)[to], score, at))
    sorted_at = at[order]
    head = np.flatnonzero(np.append(True, sorted_at[1:] != sorted_at[:-1])) if len(at) else np.zeros(0, np.int64)
    nth = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    best = order[nth < k]
    at, to = pa.array(at[best]), pa.array(to[best])
    columns = [mine.column("row").take(at), mine.column("id").take(at), theirs.column("row").take(to), theirs.column("id").take(to)]
    return record_batch(_FOUND, [*columns, score[best], theirs.column("list").take(to)])


def _survivors(q: np.ndarray, x: np.ndarray, radius: np.ndarray, at: np.ndarray, to: np.ndarray):
    """Pairs that no block of columns shows to be farther apart than the radius."""
    dim = q.shape[1]
    limit = radius * radius
    slack = ROUNDING * ((q * q).sum(axis=1)[at] + (x * x).sum(axis=1)[to])
    so_far = np.zeros(len(at))
    for lo in range(0, dim, COLUMNS):
        hi = min(lo + COLUMNS, dim)
        d = q[at, lo:hi] - x[to, lo:hi]
        so_far = so_far + (d * d).sum(axis=1)
        share = hi / dim * (1 + EPSILON / np.sqrt(hi)) ** 2 if hi < dim else 1.0
        near = so_far <= limit[at] * share + slack
        at, to, so_far, slack = at[near], to[near], so_far[near], slack[near]
    return at, to
