"""Exact top-k by inner product: queries and data are both held in cover trees, which are searched together.

The vectors are cut along a tree of cells, level by level, until a cell is a block of bounded size. Each block of data and
each block of queries is one cover tree. A pair of nodes can be left out when the largest inner product that their centres
and covering radii allow lies below the worst k-th score of the node's queries. Blocks of queries first meet the data of
their own cell, which gives every query a k-th score to start from. Then they go down the tree of cells by the same bound,
so that only pairs of blocks that may matter are formed. Nothing that could hold a result is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import stored

#: Vectors that the centres of a cell are chosen from, about, and how many centres there are at most.
SAMPLE, CENTRES = 2_000, 32
#: Step between the numbers of cells, levels of cells at most, and cells that a level cuts at most.
FAN, DEPTH, CUT_CELLS = CENTRES + 1, 10, 1_000
#: Vectors in a block of data or of queries; cells of more are cut.
BLOCK, QUERY_BLOCK = 8_192, 2_048
#: Blocks of queries that a block of data meets in one group, on average.
TOGETHER = 8
#: Points of a node of a cover tree that is not opened any more.
LEAF = 32
#: Data that the queries of a leaf meet before their k-th scores are looked at again.
MEET = 1_024
#: Beyond this, products and sums of doubles might not be whole numbers any more; such vectors are multiplied as objects.
EXACT = 2**53


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """``id``, ``v`` (floor(scale * x) of each component). Vectors that are null, empty or hold null or non-finite
    components take no part."""
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable & F.col(vec_id).isNotNull())
    return rows.select(F.col(vec_id).alias("id"), whole.alias("v"))


class CoverTree:
    """A simplified cover tree over the rows of ``points``.

    A node of level l is a point that covers all points below it within 2^l. Its children have level l - 1: they are more
    than 2^(l - 1) from one another, and one of them is the node's own point. Levels at which a point has no child but
    itself are left out, so a node has the lowest level at which it covers what is below it. A node of at most ``LEAF``
    points, or of equal points, is not opened. Rows are kept in the order of the leaves, so a node is a range.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.squares = (points**2).sum(axis=1)
        self.centres: list[int] = []
        self.levels: list[int | None] = []  # None where all points are equal
        self.span: list[tuple[int, int]] = []
        self.children: list[np.ndarray] = []
        radius: list[float] = []
        pending = [(None, 0, len(points), 0)]
        while pending:
            parent, low, high, point = pending.pop()
            node = len(self.span)
            if parent is not None:
                self.children[parent] = np.append(self.children[parent], node)
            own = self.order[low:high]
            away = np.sqrt(((points[own] - points[point]) ** 2).sum(axis=1))
            widest = float(away.max(initial=0.0))
            radius.append(widest)
            self.centres.append(point)
            self.levels.append(int(np.ceil(np.log2(widest))) if widest > 0 else None)
            self.span.append((low, high))
            self.children.append(np.zeros(0, np.int64))
            if high - low > LEAF and widest > 0:
                pending += [(node, *below) for below in self._below(low, high, point, away)]
        self.radius = np.array(radius)
        self.middle = points[self.centres] if len(points) else np.zeros((1, points.shape[1]))
        self.norm = np.sqrt((self.middle**2).sum(axis=1))

    def _below(self, low: int, high: int, point: int, away: np.ndarray) -> list[tuple[int, int, int]]:
        """The children of a node: points farthest from all chosen so far, until every row is covered."""
        own = self.order[low:high]
        rows, squares = self.points[own], self.squares[own]
        apart = 2.0 ** (int(np.ceil(np.log2(away.max()))) - 1)
        chosen, nearest, where = [point], away.copy(), np.zeros(len(own), np.int64)
        while nearest.max() > apart:
            far = int(nearest.argmax())
            distance = np.sqrt(np.maximum(squares + squares[far] - 2 * (rows @ rows[far]), 0))
            distance[far] = 0
            closer = distance < nearest
            nearest[closer], where[closer] = distance[closer], len(chosen)
            chosen.append(int(own[far]))
        self.order[low:high] = own[np.argsort(where, kind="stable")]
        ends = low + np.cumsum(np.bincount(where, minlength=len(chosen)))
        return [(int(e) - int(n), int(e), c) for e, n, c in zip(ends, np.bincount(where, minlength=len(chosen)), chosen) if n]


def _bounds(q: CoverTree, above: np.ndarray, d: CoverTree, below: np.ndarray) -> np.ndarray:
    """For nodes of queries (rows) and data (columns): no inner product of points below them is larger."""
    a, b = q.radius[above], d.radius[below]
    most = q.middle[above] @ d.middle[below].T + np.outer(a, d.norm[below]) + np.outer(q.norm[above], b) + np.outer(a, b)
    return most + 1e-9 * (np.abs(most) + 1.0) + 1e-6


class _Best:
    """The k best of each query so far: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int, floor: np.ndarray, kind: type):
        self.score = np.full((n, k), -np.inf) if kind is float else np.full((n, k), None, object)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.filled = np.zeros((n, k), bool)
        self.floor, self.kind = floor, kind  # k-th scores known from elsewhere

    def worst(self, rows: np.ndarray) -> float:
        """The lowest k-th score of ``rows``: below it no product matters to any of them."""
        own = np.where(self.filled[rows, -1], self.score[rows, -1].astype(float), -np.inf) if self.kind is not float else self.score[rows, -1]
        return float(np.maximum(own, self.floor[rows]).min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        k = self.ids.shape[1]
        other = np.broadcast_to(ids, scores.shape)
        valid = other != own[:, None]
        for r, row in enumerate(rows):
            s, i = scores[r][valid[r]], other[r][valid[r]]
            if self.kind is float:
                low = max(float(self.score[row, -1]), float(self.floor[row]))
                chosen = s >= low
                s, i = s[chosen], i[chosen]
            old = self.filled[row]
            s, i = np.concatenate([self.score[row][old], s]), np.concatenate([self.ids[row][old], i])
            best = np.lexsort((i, -s.astype(float)))[:k] if self.kind is float else sorted(range(len(s)), key=lambda x: (-s[x], i[x]))[:k]
            n = len(best)
            self.score[row, :n], self.ids[row, :n], self.filled[row, :n] = s[best], i[best], True


def _meet(best, own_rows, a, b, ids, own, spans: np.ndarray, bound: np.ndarray, slack: float) -> None:
    """Multiplies queries of a leaf with leaves of data, given from the highest bound down, until none can matter."""
    at, sizes = 0, spans[:, 1] - spans[:, 0]
    ends = np.cumsum(sizes)
    while at < len(spans) and bound[at] >= best.worst(own_rows) - slack:
        before = int(ends[at] - sizes[at])
        end = max(at + 1, int(np.searchsorted(ends, before + MEET, side="right")))
        shift = spans[at:end, 0] - (ends[at:end] - sizes[at:end] - before)
        place = np.repeat(shift, sizes[at:end]) + np.arange(int(ends[end - 1]) - before)
        best.add(own_rows, a[own_rows] @ b[place].T, ids[place], own[own_rows])
        at = end


def search(q_ids: np.ndarray, q: np.ndarray, d_ids: np.ndarray, d: np.ndarray, k: int, floor: np.ndarray, tree: CoverTree | None = None) -> list[tuple[int, int, int]]:
    """``(query, id, score)`` of the ``k`` best of each query in a block of data, where they reach the query's ``floor``.
    ``tree`` is that of the data where it is there already."""
    dims = q.shape[1]
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * dims
    kind = float if largest < EXACT else object
    left, right = CoverTree(q.astype(float)), tree or CoverTree(d.astype(float))
    qo, do = left.order, right.order
    a, b = (x.astype(float) if kind is float else x.astype(object) for x in (q[qo], d[do]))
    ids, own, best = d_ids[do], q_ids[qo], _Best(len(q), k, floor[qo], kind)
    rows = np.arange(len(q))
    slack = 1.0 if kind is float else max(1.0, largest * 1e-12)
    spans = np.array(right.span)
    pending = [(0, 0)]
    while pending:  # both nodes are opened; the most promising pairs come first
        i, j = pending.pop()
        above = left.children[i] if len(left.children[i]) else np.array([i])
        below = right.children[j] if len(right.children[j]) else np.array([j])
        leaf = np.array([not len(right.children[y]) for y in below])
        most = _bounds(left, above, right, below)
        opened = []
        for x, bound in zip(above, most):
            own_rows = rows[slice(*left.span[x])]
            open_ = np.flatnonzero(bound >= best.worst(own_rows) - slack)
            open_ = open_[np.argsort(-bound[open_], kind="stable")]
            met = open_ if not len(left.children[x]) else open_[:0]
            _meet(best, own_rows, a, b, ids, own, spans[below[met[leaf[met]]]], bound[met[leaf[met]]], slack)
            opened += [(bound[y], int(x), int(below[y])) for y in open_ if not (leaf[y] and not len(left.children[x]))]
        pending += [(x, y) for _, x, y in sorted(opened)]
    return [
        (int(own[r]), int(best.ids[r, c]), int(best.score[r, c])) for r in rows for c in np.flatnonzero(best.filled[r])
    ]


def _net(points: np.ndarray) -> np.ndarray:
    """At most ``CENTRES`` of ``points``, each the farthest from those before it; equal points give one."""
    chosen = [0]
    nearest = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < CENTRES and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _cell(cell: Column, v: Column, centres: dict[int, np.ndarray]) -> Column:
    """The cell below ``cell`` whose centre is nearest; a cell without centres stays."""

    @F.pandas_udf("long")
    def nearest(cells: pd.Series, vectors: pd.Series) -> pd.Series:
        out = cells.to_numpy(np.int64).copy()
        for one in np.unique(out):
            if one in centres:
                of_cell, net = np.flatnonzero(cells == one), centres[one]
                x = np.array(vectors.iloc[of_cell].tolist(), float)
                out[of_cell] = one * FAN + 1 + ((net**2).sum(axis=1) - 2 * x @ net.T).argmin(axis=1)
        return pd.Series(out)

    return nearest(cell, v)


def _grown(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows``, all of ``cell`` 0, with the cell each lies in, and the depth of the tree of cells.

    Level by level, cells of more than ``BLOCK`` vectors are cut along centres taken from a hash sample of them, of about
    ``SAMPLE`` vectors a cell. Cells n * FAN + 1 and on lie below cell n. A level cuts the ``CUT_CELLS`` largest cells; what
    is still large after ``DEPTH`` levels is cut into slices by hash, which costs time but loses nothing.
    """
    settled, depth = [], 0
    while depth < DEPTH:
        large = rows.where(~F.col("cell").isin(settled)).groupBy("cell").count().where(F.col("count") > BLOCK)
        large = large.orderBy(F.col("count").desc(), "cell").limit(CUT_CELLS).collect()
        if not large:
            break
        counts = F.broadcast(rows.sparkSession.createDataFrame(large, "cell long, n long"))
        sample = rows.join(counts, "cell").where(F.pmod(F.xxhash64("id", "v", "cell"), "n") < SAMPLE)

        def centres(frame: pd.DataFrame) -> pd.DataFrame:
            net = _net(np.array(frame.sort_values("id")["v"].tolist(), float))
            return pd.DataFrame([{"cell": int(frame["cell"].iloc[0]), "centres": net.tolist()}])

        found = sample.select("cell", "id", "v").groupBy("cell").applyInPandas(centres, "cell long, centres array<array<double>>")
        nets = {r.cell: np.array(r.centres) for r in found.collect()}  # at most CUT_CELLS times CENTRES vectors
        settled += [r.cell for r in large if len(nets.get(r.cell, ())) < 2]
        nets = {c: net for c, net in nets.items() if len(net) > 1}
        if nets:
            depth += 1
            rows = stored(rows.withColumn("cell", _cell(F.col("cell"), F.col("v"), nets)), "topk-rows")
    return rows, depth


def _nodes(blocks: DataFrame) -> DataFrame:
    """Every cell that blocks lie in or below, with the cell above it, a centre, and a radius that covers those blocks."""
    steps = [F.floor(F.col("cell") / F.lit(FAN**n)).cast("long") for n in range(DEPTH + 1)]
    paths = blocks.select("block", "centre", "radius", F.explode(F.array_distinct(F.array(*steps))).alias("node"))
    middles = paths.groupBy("node").agg(F.min_by("centre", "block").alias("middle"))
    apart = F.aggregate(F.zip_with("middle", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    reach = F.max(F.sqrt(apart) + F.col("radius")).alias("d_radius")
    nodes = paths.join(middles, "node").groupBy("node").agg(F.first("middle").alias("d_centre"), reach)
    above = F.floor(F.col("node") / FAN).cast("long").alias("above")
    return nodes.where(F.col("node") > 0).select("node", above, "d_centre", "d_radius")


def _may_matter() -> Column:
    """Whether points below the data's node may reach the least k-th score of the block of queries. A block with a query
    of fewer than k results so far needs all data."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, a: s + a)
    norm = lambda c: F.sqrt(total(F.transform(c, lambda a: a * a)))
    dot = total(F.zip_with("q_centre", "d_centre", lambda a, b: a * b))
    wide = F.col("q_radius") * norm("d_centre") + F.col("d_radius") * norm("q_centre") + F.col("q_radius") * F.col("d_radius")
    most = dot + wide
    return F.col("least").isNull() | (most + 1e-9 * (F.abs(dot) + wide) + 1.0 >= F.col("least"))


def _descend(heads: DataFrame, data: DataFrame, depth: int) -> DataFrame:
    """``q_block``, ``d_block``: pairs from different cells that may matter. Blocks of queries go down the tree of cells
    level by level; only pairs of a block and a cell that pass the bound are kept and opened."""
    tops = data.select(F.col("block").alias("d_block"), "cell", F.col("centre").alias("d_centre"), F.col("radius").alias("d_radius"))
    nodes = stored(_nodes(data), "topk-nodes")
    frontier, found = stored(heads.withColumn("at", F.lit(0).cast("long")), "topk-heads"), None
    for level in range(depth + 1):
        if level:
            below = frontier.join(nodes, F.col("at") == F.col("above")).where(_may_matter())
            frontier = stored(below.select(*heads.columns, F.col("node").alias("at")), "topk-frontier")
        met = frontier.join(tops, (F.col("at") == F.col("cell")) & (F.col("q_cell") != F.col("cell"))).where(_may_matter())
        met = met.select("q_block", "d_block")
        found = met if found is None else found.unionByName(met)
    return stored(found, "topk-pairs")


def _blocks(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """``rows`` packed: one row per block with ids, vectors, centre and radius. A block is a cell of the tree; one of more
    than ``size`` vectors is cut into equal slices by hash."""
    counts = rows.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("slices"))
    large = counts.where(F.col("slices") > 1)
    dealt = rows.join(large, "cell", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(kind)), F.col("slices").cast("long")).cast("int"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.array(frame["v"].tolist(), np.int64)
        centre = v.mean(axis=0)
        radius = float(np.sqrt(((v - centre) ** 2).sum(axis=1)).max()) * (1 + 1e-12)
        cell, part = int(frame["cell"].iloc[0]), int(frame["slice"].iloc[0])
        one = {"block": f"{cell}-{part}", "cell": cell, "ids": frame["id"].to_numpy(np.int64).tobytes(), "v": v.tobytes(), "centre": centre.tolist(), "radius": radius}
        return pd.DataFrame([one])

    schema = "block string, cell long, ids binary, v binary, centre array<double>, radius double"
    return stored(dealt.groupBy("cell", "slice").applyInPandas(pack, schema), f"topk-{kind}")


def _searched(pairs: DataFrame, q: DataFrame, d: DataFrame, dims: int, k: int) -> DataFrame:
    """Results of ``pairs`` of ``q_block`` and ``d_block``. ``q`` and ``d`` hold the blocks, ``q`` with the known ``floors`` of
    its queries. A block of data meets about ``TOGETHER`` blocks of queries in a group, and its tree is built once there."""
    parts = pairs.groupBy("d_block").agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    part = F.pmod(F.xxhash64("q_block"), F.col("parts")).alias("part")
    asked = pairs.join(parts, "d_block").select("q_block", "d_block", part).join(q, "q_block").select("d_block", "part", "q_ids", "q_v", "floors")
    data = d.join(parts, "d_block").select("d_block", "d_ids", "d_v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))

    def run(asked: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int, int]] = []
        for block in data.itertuples(index=False):
            d_ids, d = np.frombuffer(block.d_ids, np.int64), np.frombuffer(block.d_v, np.int64).reshape(-1, dims)
            tree = CoverTree(d.astype(float))
            for r in asked.itertuples(index=False):
                q_ids, q = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_v, np.int64).reshape(-1, dims)
                known = {} if r.floors is None else {x["query_id"]: x["floor"] for x in r.floors}
                floor = np.array([float(known.get(x, -np.inf)) for x in q_ids.tolist()])
                rows += search(q_ids, q, d_ids, d, k, floor, tree)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    groups = asked.groupBy("d_block", "part").cogroup(data.groupBy("d_block", "part"))
    return groups.applyInPandas(run, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _of_dims(rows: DataFrame, queries: Column, dims: int, k: int) -> DataFrame:
    # of equal vectors, which have equal scores, only the smallest ids can be found: one more than k, as none finds itself
    equal = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    named = rows.select("id", "v", equal.alias("place")).where(F.col("place") <= k + 1).select("id", "v", F.lit(True).alias("sought"))
    asked_rows = rows.where(queries).select("id", "v", F.lit(True).alias("asks"))
    both = named.join(asked_rows, ["id", "v"], "full").withColumn("cell", F.lit(0).cast("long"))
    rows, depth = _grown(stored(both, "topk-parts"))
    data = _blocks(rows.where("sought"), BLOCK, "data")
    asked = _blocks(rows.where("asks"), QUERY_BLOCK, "queries")
    d = data.select(F.col("block").alias("d_block"), F.col("cell").alias("d_cell"), F.col("ids").alias("d_ids"), F.col("v").alias("d_v"))
    q = asked.select(F.col("block").alias("q_block"), F.col("cell").alias("q_cell"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"))
    near = stored(q.join(d, F.col("q_cell") == F.col("d_cell")).select("q_block", "d_block"), "topk-own")
    unknown = F.lit(None).cast("array<struct<query_id:long,floor:long>>").alias("floors")
    first = stored(_searched(near, q.select("q_block", "q_ids", "q_v", unknown), d, dims, k), "topk-near")
    # the k-th score of each query that has k results already
    floors = _best(first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    places = asked.select(F.col("block").alias("q_block"), "ids")
    per_block = stored(_members(places).join(floors, "query_id").groupBy("q_block").agg(F.collect_list(F.struct("query_id", "floor")).alias("floors"), F.count("*").alias("known"), F.min("floor").alias("least")), "topk-floors")
    heads = asked.select(F.col("block").alias("q_block"), F.col("cell").alias("q_cell"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"), (F.octet_length("ids") / 8).alias("n"))
    heads = heads.join(per_block.select("q_block", "known", "least"), "q_block", "left")
    least = F.when(F.col("known") >= F.col("n"), F.col("least"))
    far = _descend(heads.select("q_block", "q_cell", "q_centre", "q_radius", least.alias("least")), data, depth)
    known = q.join(per_block.select("q_block", "floors"), "q_block", "left").select("q_block", "q_ids", "q_v", "floors")
    return _best(first.unionByName(_searched(far, known, d, dims, k)), k).select("query_id", "rank", "vec_id", "score")


def _members(blocks: DataFrame) -> DataFrame:
    """``q_block``, ``query_id`` of packed blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for block, ids in frame.itertuples(index=False):
                found = np.frombuffer(ids, np.int64)
                yield pd.DataFrame({"q_block": np.full(len(found), block), "query_id": found})

    return blocks.mapInPandas(run, "q_block string, query_id long")


def top(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` largest inner products of each query with others.

    ``vectors`` has ``id`` and ``v`` as ``quantised`` makes them; ``queries`` is a condition on ``id``. Ties go to the
    smaller id; a row never finds its own id. Vectors of one length are compared with each other only. Fewer than ``k``
    others give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.dropDuplicates(["id", "v"]), "topk-all")
    lengths = [r[0] for r in rows.select(F.size("v")).distinct().orderBy(F.size("v")).collect()]  # one for each length
    found = None
    for dims in lengths:
        one = _of_dims(rows.where(F.size("v") == dims), queries, dims, k)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
