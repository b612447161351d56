"""Hard negatives for anchors: rows of other labels that score nearly as high as a positive, found by angles.

Components become the integers floor(scale * c), and a score is the integer inner product of two vectors. For each
vector its norm and its angles to ``DIRECTIONS`` reference directions are stored. The angle between two vectors lies
between the difference and the sum of their angles to any direction, so the cosine lies in an interval, and the score
in that times both norms, widened by what rounding can do. Scores outside the interval asked for are never computed.

1. Rows are laid out by label and nearest direction in groups of about ``GROUP`` neighbours, anchors in groups of
   ``ANCHORS``. A group's smallest and largest label, norm and angles bound the scores of all its rows: pairs of
   groups that cannot have a score asked for are dropped before any vector is shuffled.
2. Positives: in a pair of groups, a row of the anchor's label is scored if its upper bound reaches the ``positives``-th
   best lower bound there. Each pair of groups hands on its best, of which the best overall stay.
3. Negatives: a row of another label is scored if its interval meets the window of one of the anchor's positives. Each
   pair of groups hands on the best of each window.

All anchors are compared with all rows, in such groups; a label, a vector or an id may hold any part of the rows.

Directions come from ``SAMPLE`` rows of smallest hash, each farthest from those before it. They decide what is skipped,
never what is found.

Defined cases: a row with a null label or vector, or with null or non-finite components, takes no part. Every row is a
row of its own, also if another has its id or vector; a null id is no anchor (unless ``is_anchor`` says so) and comes
last among ties, where rows equal in id too are told apart by their place in the table. A zero vector scores 0. Vectors
of different lengths are not compared. Scores beyond 2^53 are computed in whole numbers; one beyond a long raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import record_batch
from .scratch import Scratch
from .windows import whole_groups

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
DIRECTIONS = 8
SAMPLE = 1024
GROUP, ANCHORS = 4096, 256
#: Below this part of the pairs of a block, scores are computed one by one instead of as a product.
SPARSE = 0.125
#: Integers up to here are exact as doubles.
EXACT = float(1 << 53)

_VECTOR = "label string, dim int, nearest int, norm double, angles array<double>, x array<double>"


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    group: int = GROUP,
    anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` (by default the column of that name) are expressions over ``vectors``.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    rows = scratch.keep(_usable(vectors, is_anchor, id_col, vector_col, F.col("label") if label is None else label), "usable")
    # numbered in a table of its own, so that a task that is run again gives the same numbers
    rows = scratch.keep(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    directions = _directions(rows)
    rows = rows.mapInArrow(_angles(directions), f"row long, id long, anchor boolean, {_VECTOR}")
    rows = scratch.keep(rows, "angles")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    candidates = scratch.keep(_laid_out(rows, sizes.n, group, "group"), "rows")
    asking = scratch.keep(_laid_out(rows.where("anchor"), sizes.anchors, anchors, "asks").drop("anchor"), "anchors")
    bounds, asking_bounds = _bounds(candidates, "group"), _bounds(asking, "asks")

    same = (F.col("a.least_label") <= F.col("r.most_label")) & (F.col("r.least_label") <= F.col("a.most_label"))
    pairs = _pairs(asking_bounds, bounds, same)
    found = _compared(asking.withColumn("windows", F.lit(None).cast("array<struct<row:long,id:long,score:long>>")), candidates, pairs, _positives(positives))
    best = W.partitionBy("anchor_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    found = scratch.keep(found, "positives")

    # ranges are found in exact integers: the least and the most score of a window
    windows = found.groupBy("anchor_row").agg(F.collect_list(F.struct("row", "id", "score")).alias("windows"))
    asking = scratch.keep(asking.join(windows, F.col("row") == F.col("anchor_row")).drop("anchor_row"), "windows")
    asking_bounds = _bounds(asking, "asks", (F.min(F.array_min("windows.score")), F.max(F.array_max("windows.score"))))
    pairs = _pairs(asking_bounds, bounds, _may_meet(low, high))
    found = _compared(asking, candidates, pairs, _negatives(negatives, low, high))
    best = W.partitionBy("anchor_row", "positive_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _usable(vectors: DataFrame, is_anchor: Column, id_col: str, vector_col: str, label: Column) -> DataFrame:
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        label.cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(finite & F.col("label").isNotNull())


def _integers(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of whole numbers, held as doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values * SCALE).reshape(len(column), -1)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and unit vectors; scaled first, so that no square overflows. A zero vector stays zero."""
    top = np.abs(x).max(axis=1, initial=0.0)
    scaled = x / np.where(top > 0, top, 1)[:, None]
    norm = np.sqrt((scaled * scaled).sum(axis=1))
    return norm * top, scaled / np.where(norm > 0, norm, 1)[:, None]


def _directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors in a bounded sample, unit vectors far from each other."""
    few = rows.orderBy(F.xxhash64("id", "v"), "row").limit(SAMPLE).select("v").collect()
    by_length: dict[int, list] = {}
    for r in few:
        by_length.setdefault(len(r.v), []).append(r.v)
    out = {}
    for dim, listed in by_length.items():
        unit = _unit(np.floor(np.array(listed, dtype=np.float64).reshape(len(listed), dim) * SCALE))[1]
        chosen, nearest = [0], unit @ unit[0]
        while len(chosen) < min(DIRECTIONS, len(unit)):
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
        out[dim] = unit[chosen]
    return out


def _angles(directions: dict[int, np.ndarray]):
    """Rows with integer components, norm, angles, and the nearest direction."""
    schema = pa.schema(
        [("row", pa.int64()), ("id", pa.int64()), ("anchor", pa.bool_()), ("label", pa.string()), ("dim", pa.int32())]
        + [("nearest", pa.int32()), ("norm", pa.float64()), ("angles", pa.list_(pa.float64())), ("x", pa.list_(pa.float64()))]
    )

    def run(batches):
        for batch in batches:
            length = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for dim in np.unique(length).tolist():
                part = batch.filter(pa.array(length == dim))
                x = _integers(part.column("v"))
                norm, unit = _unit(x)
                refs = directions.get(dim, np.zeros((1, dim)))
                cos = np.clip(unit @ refs.T, -1, 1)
                many = part.num_rows
                flat = lambda m: pa.ListArray.from_arrays(np.arange(many + 1, dtype=np.int32) * m.shape[1], m.ravel())
                columns = [part.column("row"), part.column("id"), part.column("anchor"), part.column("label")]
                columns += [np.full(many, dim, dtype=np.int32), cos.argmax(axis=1).astype(np.int32), norm]
                yield record_batch(schema, [*columns, flat(np.arccos(cos)), flat(x)])

    return run


def _laid_out(rows: DataFrame, n: int, size: int, name: str) -> DataFrame:
    """Rows dealt to ranges of about ``size`` neighbours in label, nearest direction and angle, numbered in ``name``."""
    nearest = F.element_at("angles", F.col("nearest") + 1)
    wanted = max(1, -(-n // size))
    dealt = rows.repartitionByRange(wanted, "dim", "label", "nearest", nearest, "row")
    tasks = max(wanted, dealt.rdd.getNumPartitions())
    return dealt.withColumn(name, F.floor(F.spark_partition_id() * F.lit(wanted) / F.lit(tasks)).cast("int"))


def _bounds(rows: DataFrame, name: str, scores: tuple[Column, Column] | None = None) -> DataFrame:
    """What bounds the scores of each group: smallest and largest label, norm and angles.

    A group that holds vectors of two lengths comes once for each.
    """
    angles = [F.try_element_at("angles", F.lit(i + 1)) for i in range(DIRECTIONS)]
    scored = [] if scores is None else [scores[0].alias("least_score"), scores[1].alias("most_score")]
    return rows.groupBy(name, "dim").agg(
        F.min("label").alias("least_label"),
        F.max("label").alias("most_label"),
        F.min("norm").alias("least_norm"),
        F.max("norm").alias("most_norm"),
        F.array(*[F.min(a) for a in angles]).alias("least"),
        F.array(*[F.max(a) for a in angles]).alias("most"),
        *scored,
    )


#: Rows of the smaller list of groups that stand in one bucket while groups are paired.
_LANE = 64


def _pairs(asking: DataFrame, groups: DataFrame, condition: Column) -> DataFrame:
    """The pairs (asks, group) of one length that meet the condition. Only the bounds of groups are paired here."""
    lanes = F.lit(max(1, -(-asking.count() // _LANE)))
    spread = F.explode(F.sequence(F.lit(0), lanes - 1)).alias("lane")
    r = groups.select("*", spread).alias("r")
    a = asking.withColumn("lane", F.pmod(F.xxhash64("asks"), lanes).cast("int")).alias("a")
    on = (F.col("a.lane") == F.col("r.lane")) & (F.col("a.dim") == F.col("r.dim"))
    return r.join(a, on).where(condition).select("a.asks", "r.group", F.col("r.dim").alias("pair_dim")).distinct()


def _may_meet(low: int, high: int) -> Column:
    """A score of the two groups may lie in a window of the anchors' positives."""
    zero, pi = F.lit(0.0), F.lit(float(np.pi))
    apart = lambda least, most: F.greatest(zero, least - most)
    gaps = F.zip_with("r.least", "a.most", apart)
    gaps = F.zip_with(gaps, F.zip_with("a.least", "r.most", apart), lambda x, y: F.greatest(x, y))
    sums = F.zip_with(
        F.zip_with("a.least", "r.least", lambda x, y: x + y),
        F.zip_with("a.most", "r.most", lambda x, y: x + y),
        lambda least, most: F.when(most <= pi, most).when(least >= pi, 2 * pi - least).otherwise(pi),
    )
    # a missing angle bounds nothing
    largest, smallest = F.cos(F.coalesce(F.array_max(gaps), zero)), F.cos(F.coalesce(F.array_min(sums), pi))
    products = [F.col("a.least_norm") * F.col("r.least_norm"), F.col("a.most_norm") * F.col("r.most_norm")]
    slack = products[1] * 1e-5 + 1
    top = F.greatest(*[largest * p for p in products]) + slack
    bottom = F.least(*[smallest * p for p in products]) - slack
    # windows of positives of negative score are empty
    least, most = F.greatest(F.col("a.least_score"), F.lit(0)), F.col("a.most_score")
    return (most >= 0) & (top >= least * (low / 100) - 1) & (bottom <= most * (high / 100) + 1)


def _compared(asking: DataFrame, candidates: DataFrame, pairs: DataFrame, work) -> DataFrame:
    """What ``work`` finds in each pair of groups. Each side travels once for every pair it is in."""
    fields = ["row", "id", "label", "norm", "angles", "x"]
    none = F.lit(None).cast(asking.schema["windows"].dataType).alias("windows")
    part = F.xxhash64("asks", "group", "pair_dim").alias("part")
    keys = [F.col("asks"), F.col("group"), F.col("pair_dim")]
    mine = asking.join(pairs, "asks").where("dim = pair_dim").select(part, *keys, F.lit(True).alias("asking"), *fields, "windows")
    theirs = candidates.join(pairs, "group").where("dim = pair_dim").select(part, *keys, F.lit(False).alias("asking"), *fields, none)

    def run(batches):
        for batch in whole_groups(batches, "part"):
            keys = np.stack([batch.column(c).to_numpy() for c in ("part", "asks", "group", "pair_dim")])
            heads = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            for a, b in zip(heads.tolist(), np.append(heads[1:], batch.num_rows).tolist(), strict=True):
                one = batch.slice(a, b - a)
                asks = one.column("asking")
                left, right = one.filter(asks), one.filter(pc.invert(asks))
                if left.num_rows and right.num_rows:
                    yield from work(Block(left), Block(right), left.column("windows"))

    ordered = mine.unionByName(theirs).repartition("part").sortWithinPartitions("part", "asks", "group", "pair_dim", "asking")
    columns = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, id long, score long"
    return ordered.mapInArrow(run, columns)


class Block:
    """Some rows of one length as arrays."""

    def __init__(self, rows: pa.RecordBatch) -> None:
        self.ids = rows.column("id")
        self.row = rows.column("row").to_numpy()
        self.label = np.array(rows.column("label").to_pylist(), dtype=object)
        self.norm = rows.column("norm").to_numpy()
        flat = lambda name: rows.column(name).flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
        self.x, angles = flat("x"), flat("angles")
        self.cos, self.sin = np.cos(angles), np.sin(angles)

    def take(self, keep: np.ndarray) -> Block:
        out = object.__new__(Block)
        out.ids = self.ids.take(pa.array(keep))
        out.row, out.label, out.norm, out.x = self.row[keep], self.label[keep], self.norm[keep], self.x[keep]
        out.cos, out.sin = self.cos[keep], self.sin[keep]
        return out


def _intervals(a: Block, r: Block) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that the angles allow each pair, with room for rounding.

    A computed cosine is wrong by at most some (d + 8) units in the last place, and so an angle, near 0 and pi, by the
    root of twice that; four such errors cover the sum of two angles and its cosine.
    """
    low, high = np.full((len(a.row), len(r.row)), -1.0), np.full((len(a.row), len(r.row)), 1.0)
    for i in range(a.cos.shape[1]):
        both, side = np.multiply.outer(a.cos[:, i], r.cos[:, i]), np.multiply.outer(a.sin[:, i], r.sin[:, i])
        np.minimum(high, both + side, out=high)
        np.maximum(low, both - side, out=low)
    norms = np.multiply.outer(a.norm, r.norm)
    slack = norms * (4 * np.sqrt(2 * (a.x.shape[1] + 8) * np.finfo(float).eps)) + 0.5
    return low * norms - slack, high * norms + slack


def _scores(a: Block, r: Block, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (at, to)."""
    if len(at) and a.norm.max() * r.norm.max() >= EXACT:
        whole = lambda v: [int(c) for c in v]
        return np.array([sum(p * q for p, q in zip(whole(a.x[i]), whole(r.x[j]), strict=True)) for i, j in zip(at, to, strict=True)], dtype=object)
    if len(at) > SPARSE * len(a.row) * len(r.row):
        return (a.x @ r.x.T)[at, to].astype(np.int64)
    out = np.zeros(len(at), dtype=np.int64)
    for lo in range(0, len(at), 1 << 16):
        hi = lo + (1 << 16)
        out[lo:hi] = np.einsum("ij,ij->i", a.x[at[lo:hi]], r.x[to[lo:hi]])
    return out


_FOUND = pa.schema([(c, pa.int64()) for c in ("anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score", "row", "id", "score")])


def _best(key: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` entries of each key with the highest score; ``place`` orders equal ones."""
    order = np.lexsort((place, -score, key))
    key = key[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
    return order[nth < k]


def _places(r: Block) -> np.ndarray:
    """The rank of each row by id, nulls last, then by place in the table."""
    place = np.empty(len(r.row), dtype=np.int64)
    place[np.lexsort((r.row, np.array(r.ids.fill_null(0)), np.array(r.ids.is_null())))] = np.arange(len(r.row))
    return place


def _positives(k: int):
    def work(a: Block, r: Block, _):
        for label in np.unique(a.label.astype(str)):
            rows = np.flatnonzero(r.label == label)
            if not len(rows):
                continue
            mine, theirs = a.take(np.flatnonzero(a.label == label)), r.take(rows)
            low, high = _intervals(mine, theirs)
            itself = mine.row[:, None] == theirs.row
            low[itself], high[itself] = -np.inf, -np.inf
            if len(rows) > k:
                wanted = high >= np.partition(low, len(rows) - k, axis=1)[:, len(rows) - k][:, None]
            else:
                wanted = np.ones_like(itself)
            at, to = np.nonzero(wanted & ~itself)
            score = _scores(mine, theirs, at, to)
            best = _best(at, score, _places(theirs)[to], k)
            at, to = at[best], to[best]
            none = pa.nulls(len(at), pa.int64())
            ids = [mine.ids.take(pa.array(at)), theirs.ids.take(pa.array(to))]
            yield record_batch(_FOUND, [mine.row[at], ids[0], none, none, none, theirs.row[to], ids[1], score[best]])

    return work


def _negatives(k: int, low: int, high: int):
    def work(a: Block, r: Block, windows: pa.Array):
        of = np.repeat(np.arange(len(a.row)), pc.list_value_length(windows).to_numpy(zero_copy_only=False))
        flat = windows.flatten()
        score = flat.field("score").to_numpy(zero_copy_only=False)
        least, most = np.array([-(-low * int(p) // 100) for p in score]), np.array([high * int(p) // 100 for p in score])
        bottom, top = _intervals(a, r)
        other = a.label[:, None] != r.label
        meets = np.zeros_like(other)
        for w, i in enumerate(of.tolist()):
            meets[i] |= (top[i] >= float(least[w])) & (bottom[i] <= float(most[w])) & bool(least[w] <= most[w])
        at, to = np.nonzero(meets & other)
        scores, places = _scores(a, r, at, to), _places(r)
        first = np.searchsorted(at, np.arange(len(a.row) + 1))
        key, chosen = [], []
        for w, i in enumerate(of.tolist()):
            here = np.arange(first[i], first[i + 1])
            here = here[(scores[here] >= least[w]) & (scores[here] <= most[w])]
            here = here[np.lexsort((places[to[here]], -scores[here]))[:k]]
            key += [w] * len(here)
            chosen += here.tolist()
        if not chosen:
            return
        w, chosen = np.array(key), np.array(chosen)
        at, to = at[chosen], to[chosen]
        take = lambda column, places: column.take(pa.array(places))
        positive = [take(flat.field(c), w) for c in ("row", "id", "score")]
        yield record_batch(_FOUND, [a.row[at], take(a.ids, at), *positive, r.row[to], take(r.ids, to), scores[chosen]])

    return work
