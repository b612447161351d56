"""Embedding near-dedup by NN-descent: a neighbour graph refined through neighbours of neighbours.

Vectors of one label are compared by cosine in double precision. Equal vectors are one class and enter once.

1. Start: ``TREES`` times, the classes of a label are dealt to leaves by the signs of random projections, as many as
   bring a leaf to ``LEAF`` classes; a larger leaf, such as one of near copies, is split by a hash that differs between
   trees, searches and rounds. Within a part of a leaf each class gets its ``k`` best neighbours, and beside them the
   links of a spanning forest of the part: a list full of nearer ones hides no link between groups.
2. Rounds: around every class, its neighbours and the classes that have it as theirs are compared with each other, in
   parts of about ``LEAF``, and each keeps its best ``k``. Lists hold neighbours within twice the threshold's angle:
   what is linked to one end of a link is that near to the other. Ends when few entries are new.
3. Entries that reach the threshold are links and connect classes to components. A list of which all entries reach it
   is saturated: it is enlarged to its component, all of whose members are compared in blocks. So links are counted
   without a cap on partners, and without a row for each pair.
4. Audit: the ``AUDIT`` classes of smallest hash, or as many times that as it takes to see ``AUDIT_LINKS`` links, up to
   ``AUDIT_MOST``, are compared with all vectors. While less than ``RECALL`` of their links lie within a component, the
   search goes on with new trees. The recall and the links it was measured on are part of the result; after ``SEARCHES``
   searches a recall below ``LEAST_RECALL`` is an error.

Defined cases: a vector that is null, zero, or has null or non-finite components, or no label, links with nothing, nor
do vectors of different lengths; every row is a vector, also if another row has its id; a row without id names no
component, and has the smallest id that it reaches, if there is one.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.skew import HeavyKeys, heavy_keys
from .arrays import record_batch
from .components import components
from .scratch import Scratch
from .windows import digest64, whole_groups

log = logging.getLogger(__name__)

THRESHOLD = 0.98
K = 10
TREES = 6
LEAF = 512
ROUNDS = 6
SETTLED = 0.01
AUDIT, AUDIT_LINKS, AUDIT_MOST = 128, 100, 2048
RECALL, LEAST_RECALL = 0.99, 0.9
SEARCHES = 4
BLOCK = 512
#: What a further entry of a saturated list would have to beat: the list is enlarged in the end.
SATURATED = 2.0

EDGE_SCHEMA = "node long, other long, sim double, joins boolean"
_EDGES = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("sim", pa.float64()), ("joins", pa.bool_())])


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    k: int = K,
    leaf: int = LEAF,
) -> DataFrame:
    """For every row: vec_id, n_links (other rows linked directly), component_id, kept, audited_links and recall.

    ``recall`` is null where no audited class has a link.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        F.col(f"`{label_col}`").alias("label"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("v", lambda x: x != 0) & F.col("label").isNotNull()
    node = F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "v"))
    rows = scratch.keep(rows.withColumn("node", node), "rows")
    classes = scratch.keep(
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least"),
            F.first("label").cast("string").alias("label"),
            F.first("v").alias("v"),
        )
        .mapInArrow(_unit, "node long, copies long, least long, label string, v binary"),
        "classes",
    )
    audit, asked = _audited(classes, threshold, scratch)
    held, graph = 0, None
    for search in range(SEARCHES):
        graph = _searched(classes, graph, search, k, leaf, threshold, scratch)
        links = graph.where(F.col("sim") >= threshold).select(F.col("node").alias("a"), F.col("other").alias("b"))
        found = scratch.keep(components(links, scratch, f"hooks{search}"), f"components{search}")
        mine = found.select("node", F.col("component").alias("mine"))
        other = found.select(F.col("node").alias("other"), "component")
        held = audit.join(mine, "node").join(other, "other").where("mine = component").count()
        log.info("search %d: %d of %d audited links held", search + 1, held, asked)
        if held >= RECALL * asked:
            break
    if held < LEAST_RECALL * asked:
        raise ArithmeticError(f"only {held} of {asked} audited links were found in {SEARCHES} searches")
    links = _counted(classes.join(found, "node").select("component", "node", "copies", "v"), threshold)
    named = classes.select("node", "copies", "least").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").join(links, "node", "left")
    n_links = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
    named = named.select("node", "component_id", n_links.alias("n_links"))
    alone = F.col("node").isNull()
    return rows.join(named, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("component_id").eqNullSafe(F.col("vec_id"))).alias("kept"),
        F.lit(asked).cast("long").alias("audited_links"),
        F.lit(held / asked if asked else None).cast("double").alias("recall"),
    )


_CLASSES = pa.schema(
    [("node", pa.int64()), ("copies", pa.int64()), ("least", pa.int64()), ("label", pa.string()), ("v", pa.binary())]
)


def _unit(batches):
    """Vectors as the bytes of unit vectors of doubles; scaled first, so that no square overflows."""
    for batch in batches:
        out = []
        for v in batch.column(4):
            x = v.values.to_numpy(zero_copy_only=False)
            x = x / np.abs(x).max()
            out.append((x / np.sqrt(x @ x)).tobytes())
        yield record_batch(_CLASSES, [*batch.columns[:4], pa.array(out, type=pa.binary())])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _by_part(
    rows: DataFrame, keys: list[str], size: int, search: int, turn: int, heavy: HeavyKeys | None = None
) -> DataFrame:
    """Rows with the column ``part``: rows of equal keys have few values of it, ``size`` rows or so to each.

    Nodes that one key, search or turn parts meet in others. Rows of ``heavy`` keys do not meet to learn their number.
    """
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = F.xxhash64(F.lit(search), F.lit(turn), *keys, "node")
    part = F.xxhash64(*keys, F.pmod(dealt, F.col("parts")))
    if heavy is None or not heavy.parts:
        return rows.join(sizes, keys).withColumn("part", part)
    spread = heavy.split(rows, ["node"], "salt").join(heavy.repeated(sizes, "salt"), [*keys, "salt"])
    return spread.drop("salt").withColumn("part", part)


def _each_part(rows: DataFrame, columns: list[str], work) -> DataFrame:
    """Edges that ``work`` finds in each part, given the columns named."""

    def run(batches):
        for batch in whole_groups(batches, "part"):
            part = batch.column(0).to_numpy()
            heads = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for a, b in zip(heads.tolist(), np.append(heads[1:], len(part)).tolist(), strict=True):
                edges = work(*batch.slice(a, b - a).columns[1:])
                if len(edges[0]):
                    yield record_batch(_EDGES, [*edges])

    ordered = rows.repartition("part").sortWithinPartitions("part").select("part", *columns)
    return ordered.mapInArrow(run, EDGE_SCHEMA)


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best entries of each list, and those that join groups."""
    order = W.partitionBy("node").orderBy(F.desc("sim"), "other")
    once = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.max("joins").alias("joins"))
    return once.withColumn("place", F.row_number().over(order)).where((F.col("place") <= k) | F.col("joins"))


def _searched(classes, graph, search, k, leaf, threshold, scratch) -> DataFrame:
    """The graph after a start from new trees and its rounds: node, other, sim, joins, place."""
    near = 2 * threshold * threshold - 1  # the cosine of twice the angle
    leaves = _by_part(_leaves(classes, search, leaf), ["leaf"], leaf, search, 0)
    start = _each_part(leaves, ["node", "v"], _neighbours_in(k, near, threshold))
    entries = ["node", "other", "sim", "joins"]
    graph = start if graph is None else start.unionByName(graph.select(*entries))
    graph = scratch.keep(_best(graph, k), f"graph{search}-0")
    for turn in range(1, ROUNDS + 1):
        members = graph.select(F.col("node").alias("center"), F.col("other").alias("node"))
        members = members.unionByName(graph.select(F.col("other").alias("center"), "node"))
        members = members.unionByName(graph.select(F.col("node").alias("center"), "node")).distinct()
        least = F.when(F.min("sim") >= threshold, SATURATED).otherwise(F.min("sim"))
        worst = graph.groupBy("node").agg(F.when(F.count("*") >= k, least).otherwise(near).alias("worst"))
        members = members.join(worst, "node", "left").fillna(near, ["worst"]).join(classes.select("node", "v"), "node")
        centers = graph.select(F.explode(F.array("node", "other")).alias("center"))
        around = _by_part(members, ["center"], leaf, search, turn, heavy_keys(centers, ["center"]))
        better = _each_part(around, ["node", "v", "worst"], _better_in(k, near))
        old = graph
        graph = scratch.keep(_best(old.select(*entries).unionByName(better), k), f"graph{search}-{turn}")
        new = graph.join(old, ["node", "other"], "left_anti").count()
        scratch.drop(f"graph{search}-{turn - 1}")
        if new <= SETTLED * graph.count():
            break
    return graph


def _leaves(classes: DataFrame, search: int, leaf: int) -> DataFrame:
    """node, leaf and v for each tree; the number of projections follows the size of the label."""
    sizes = classes.groupBy("label").agg(F.count("*").alias("in_label"))
    schema = pa.schema([("node", pa.int64()), ("leaf", pa.int64()), ("v", pa.binary())])

    def run(batches):
        for batch in batches:
            labels, sizes = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for tree in range(search * TREES, (search + 1) * TREES):
                leaves = []
                for label, n, raw in zip(labels, sizes, batch.column(2), strict=True):
                    v = np.frombuffer(raw.as_buffer())
                    bits = max(0, int(np.ceil(np.log2(n / leaf))))
                    signs = (_planes(tree, len(v))[:bits] @ v > 0).tobytes()
                    leaves.append(digest64(f"{tree} {len(v)} {label} ".encode() + signs))
                yield record_batch(schema, [batch.column(0), np.array(leaves, dtype=np.int64), batch.column(2)])

    dealt = classes.join(sizes, "label").select("node", "label", "v", "in_label")
    return dealt.mapInArrow(run, "node long, leaf long, v binary")


_PLANES: dict[tuple[int, int], np.ndarray] = {}


def _planes(tree: int, dim: int) -> np.ndarray:
    """Fixed random directions of a tree, as many as any label asks for."""
    if (tree, dim) not in _PLANES:
        _PLANES[tree, dim] = np.random.default_rng([tree, dim]).standard_normal((64, dim))
    return _PLANES[tree, dim]


def _top(sims: np.ndarray, k: int, least: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` largest entries above ``least``, the diagonal left out."""
    np.fill_diagonal(sims, -2)
    k = min(k, len(sims) - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    column = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    row = np.repeat(np.arange(len(sims)), k)
    column = column.ravel()
    good = sims[row, column] >= (least if np.isscalar(least) else least[row])
    return row[good], column[good]


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of links that connect all that the symmetric matrix of links does; each row at most once."""
    rest = linked.any(axis=1)
    row, column = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while rest.any():
        front = np.array([rest.argmax()])
        rest[front] = False
        while len(front):
            reached = linked[front] & rest
            new = np.flatnonzero(reached.any(axis=0))
            row.append(new)
            column.append(front[reached[:, new].argmax(axis=0)])
            rest[new] = False
            front = new
    return np.concatenate(row), np.concatenate(column)


def _neighbours_in(k: int, near: float, threshold: float):
    def work(node, v):
        node, x = node.to_numpy(), _matrix(v)
        sims = x @ x.T
        row, column = _top(sims, k, near)
        to, parent = _forest(sims >= threshold)
        joins = np.arange(len(row) + len(to)) >= len(row)
        row, column = np.append(row, to), np.append(column, parent)
        return node[row], node[column], sims[row, column], joins

    return work


def _better_in(k: int, near: float):
    def work(node, v, worst):
        node, x, worst = node.to_numpy(), _matrix(v), worst.to_numpy()
        sims = x @ x.T
        row, column = _top(sims, k, np.maximum(worst, near))
        return node[row], node[column], sims[row, column], np.zeros(len(row), dtype=bool)

    return work


def _audited(classes: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, int]:
    """Links to look for, and their number: of few classes where links are frequent, of more where they are rare."""
    few, all_ = AUDIT, classes.count()
    while True:
        audit = scratch.keep(_audit_links(classes, threshold, few), f"audit{few}")
        found = audit.count()
        if found >= AUDIT_LINKS or few >= min(AUDIT_MOST, all_):
            return audit, found
        few *= 16


def _audit_links(classes: DataFrame, threshold: float, few: int) -> DataFrame:
    """All links of ``few`` classes, by comparing these with every vector."""
    few = classes.orderBy(F.xxhash64("node"), "node").limit(few).select("node", "label", "v").collect()
    queries = [(r.node, r.label, np.frombuffer(bytes(r.v))) for r in few]

    def run(batches):
        for batch in batches:
            label = np.array(batch.column(1).to_pylist(), dtype=object)
            raw = batch.column(2).to_pylist()
            size = np.array([len(x) for x in raw])
            for node, of, v in queries:
                rows = np.flatnonzero((label == of) & (size == v.nbytes))
                if len(rows):
                    sims = np.frombuffer(b"".join([raw[i] for i in rows])).reshape(len(rows), -1) @ v
                    other = batch.column(0).to_numpy()[rows]
                    good = (sims >= threshold) & (other != node)
                    if good.any():
                        n = good.sum()
                        yield record_batch(_EDGES, [np.full(n, node), other[good], sims[good], np.zeros(n, dtype=bool)])

    return classes.select("node", "label", "v").mapInArrow(run, EDGE_SCHEMA)


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """node and others: how many rows of its component (component, node, copies, v) each class is linked with."""
    blocks = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")
    cell = lambda a, b: F.xxhash64("component", a, b).alias("part")
    asking = members.select("*", every).select(cell("block", "at"), "node", "v", "copies", F.lit(True).alias("asks"))
    asked = members.select("*", every).select(cell("at", "block"), "node", "v", "copies", F.lit(False).alias("asks"))

    def work(node, v, copies, asks):
        asks, x, node = asks.to_numpy(zero_copy_only=False), _matrix(v), node.to_numpy()
        linked = (x[asks] @ x[~asks].T >= threshold) & (node[asks][:, None] != node[~asks])
        n = linked @ copies.to_numpy()[~asks].astype(np.float64)
        return node[asks], node[asks], n, np.zeros(len(n), dtype=bool)

    found = _each_part(asking.unionByName(asked), ["node", "v", "copies", "asks"], work)
    return found.groupBy("node").agg(F.sum("sim").cast("long").alias("others"))
