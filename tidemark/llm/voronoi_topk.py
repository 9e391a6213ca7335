"""Exact nearest neighbours by inner product, as a Voronoi join.

1. Equal vectors are one class; of its rows the ``k + 1`` smallest ids can be in a
   result at all, and tasks drop the others before the shuffle. Equal queries
   are one query.
2. ``PIVOTS`` query vectors, those of least hash, are pivots (a bounded sample; it
   decides only how much is pruned). Queries and data belong to the cell of their nearest pivot.
   Of each cell of queries a summary is taken: the largest distance r to the
   pivot p, and the least and largest product with every pivot g.
3. For a query q in that cell and a vector x whose pivot is g, with f = x - g,
   q.x = q.g + p.f + (q - p).f, so the product lies within r|f| of p.f plus the
   summary's least or largest q.g. The (k+1)-th largest lower bound over all data is
   a score that every query of the cell reaches.
4. Cells are packed into groups of about ``QUERY_BLOCK`` queries. A vector is
   sent to a group only if it may reach that score in one of its cells. Groups with more
   queries or vectors are cut into blocks; each pair of blocks is solved
   alone, cell by cell, and the blocks' best are merged by rank.

Products are exact integers. Bounds are widened by more than their rounding error.
Nothing is lost to a limit: every vector that a bound cannot exclude is compared.

Vectors that are null, hold null or non-finite entries, or are shorter than the
longest, and rows without vec_id take no part. Rows that repeat a vec_id are rows of
their own; a query leaves out one row, itself. Ties go to the smaller vec_id. An
empty table, or one without queries, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import workspace
from tidemark.llm.vectors import SCALE, integer_vectors, matrix

BEST, EVERY = 5, 50
PIVOTS = 64
#: Queries and vectors that one step compares.
QUERY_BLOCK, DATA_BLOCK = 1024, 4096
RESULT = "query_id long, rank int, vec_id long, score long"
FOUND = "class long, score long, vec_id long, own long"


class Cells:
    """Pivots, and what is known of the queries around each."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        count = len(pivots)
        self.radius = np.full(count, -1.0)  # no query
        self.least = np.zeros((count, count))
        self.most = np.zeros((count, count))
        self.reach = np.full(count, -np.inf)  # a score that every query has
        self.group = np.full(count, -1)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The nearest pivot, the first of equally near ones."""
        return np.argmax(x @ self.pivots.T - (self.pivots**2).sum(1) / 2, axis=1)

    def used(self) -> np.ndarray:
        return np.flatnonzero(self.radius >= 0)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest product of each vector with the queries of each used cell."""
        used, near = self.used(), self.nearest(x)
        rest = x - self.pivots[near]
        length = np.sqrt((rest**2).sum(1))
        middle = rest @ self.pivots[used].T
        room = length[:, None] * self.radius[used]
        slack = 1e-9 * (1 + np.sqrt((x**2).sum(1))[:, None] * (self.radius[used] + np.sqrt((self.pivots[used] ** 2).sum(1))))
        low = middle + self.least[np.ix_(used, near)].T - room - slack
        return low, middle + self.most[np.ix_(used, near)].T + room + slack

    def passes(self, x: np.ndarray) -> np.ndarray:
        """Which used cells may have each vector among a query's best."""
        return self.bounds(x)[1] >= self.reach[self.used()]


def _doubles(column: pa.Array, dims: int) -> np.ndarray:
    return matrix(column, dims).astype(np.float64)


def _query_cells(cells: Cells, dims: int):
    """Each query's cell, and how far it is from the pivot."""

    def run(batches):
        for batch in batches:
            x = _doubles(batch["x"], dims)
            near = cells.nearest(x)
            away = np.sqrt(((x - cells.pivots[near]) ** 2).sum(1))
            columns = [batch["class"], batch["x"], pa.array(near, pa.int32()), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, ["class", "x", "cell", "away"])

    return run


def _query_products(cells: Cells, dims: int):
    """Per task: the least and largest product of each cell's queries with each pivot."""
    count = len(cells.pivots)

    def run(batches):
        least, most = np.full((count, count), np.inf), np.full((count, count), -np.inf)
        for batch in batches:
            near, products = np.asarray(batch["cell"]), _doubles(batch["x"], dims) @ cells.pivots.T
            np.minimum.at(least, near, products)
            np.maximum.at(most, near, products)
        cell, pivot = np.nonzero(np.isfinite(least))
        columns = [pa.array(cell, pa.int32()), pa.array(pivot, pa.int32()), pa.array(least[cell, pivot]), pa.array(most[cell, pivot])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "pivot", "least", "most"])

    return run


def _reached(cells: Cells, dims: int, wanted: int):
    """Per task: the largest lower bounds of each used cell, as often as a class has ids."""
    used = cells.used()

    def run(batches):
        held = np.full((0, len(used)), -np.inf)
        for batch in batches:
            copies = np.asarray(pc.list_value_length(batch["ids"]))
            low = np.repeat(cells.bounds(_doubles(batch["x"], dims))[0], copies, axis=0)
            held = np.sort(np.concatenate([held, low]), axis=0)[-wanted:]
        cell = np.tile(used, len(held))
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(held.ravel())], ["cell", "low"])

    return run


def _sent(cells: Cells, dims: int):
    """Vectors with the groups of queries that may need them."""
    used = cells.used()
    groups = cells.group[used]
    opens = np.flatnonzero(np.diff(groups, prepend=-1))  # groups are runs of cells

    def run(batches):
        for batch in batches:
            needed = np.logical_or.reduceat(cells.passes(_doubles(batch["x"], dims)), opens, axis=1)
            row, place = np.nonzero(needed)
            owner = pa.array(row)
            columns = [pa.array(groups[opens][place], pa.int32())] + [batch[c].take(owner) for c in ("class", "x", "ids")]
            yield pa.RecordBatch.from_arrays(columns, ["part", "class", "x", "ids"])

    return run


def _solved(cells: Cells, dims: int, largest: int, wanted: int):
    """The best of a block of vectors for each query of a block."""
    exact = largest * largest * dims < 1 << 53  # as sums of doubles
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(asked: pa.Table, data: pa.Table) -> pa.Table:
        asked, data = asked.combine_chunks(), data.combine_chunks()
        out = [pa.table({n: pa.array([], pa.int64()) for n in names})]
        if not len(asked) or not len(data):
            return out[0]
        lists = data["ids"].to_pylist()
        order = np.argsort([ids[0] for ids in lists], kind="stable")  # ties go to the smaller id
        lists = [lists[i] for i in order]
        own = np.asarray(data["class"])[order]
        x = matrix(data["x"].combine_chunks(), dims)[order]
        q, cell, names_of = matrix(asked["x"].combine_chunks(), dims), np.asarray(asked["cell"]), np.asarray(asked["class"])
        may = cells.passes(x.astype(np.float64))
        for at, c in enumerate(cells.used()):
            queries, near = np.flatnonzero(cell == c), np.flatnonzero(may[:, at])
            for a in range(0, len(queries) if len(near) else 0, 256):
                some = queries[a : a + 256]
                if exact:
                    scores = (q[some].astype(np.float64) @ x[near].astype(np.float64).T).astype(np.int64)
                else:
                    scores = q[some] @ x[near].T
                rows, places = _best(scores, wanted)
                found = scores[rows, places].tolist()
                ids = [lists[p] for p in near[places].tolist()]
                copies = [len(i) for i in ids]
                columns = [np.repeat(names_of[some][rows], copies), np.repeat(found, copies), sum(ids, []), np.repeat(own[near[places]], copies)]
                out.append(pa.table({n: pa.array(v, pa.int64()) for n, v in zip(names, columns, strict=True)}))
        return pa.concat_tables(out)

    return run


def _best(scores: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the largest scores of each row, the first columns of equal ones."""
    size = scores.shape[1]
    if size > wanted:
        least = np.partition(scores, size - wanted, axis=1)[:, size - wanted]
        rows, places = np.nonzero(scores >= least[:, None])
    else:
        rows, places = (x.ravel() for x in np.indices(scores.shape))
    order = np.lexsort((places, -scores[rows, places], rows))
    rows, places = rows[order], places[order]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    return rows[rank < wanted], places[rank < wanted]


def _packed_groups(sizes: dict[int, int], block: int) -> tuple[dict[int, int], dict[int, int]]:
    """Cells in runs of about ``block`` queries: the group of each cell, the queries of each group."""
    group, held, of_cell, queries = 0, 0, {}, {}
    for cell in sorted(sizes):
        if held and held + sizes[cell] > block:
            group, held = group + 1, 0
        held += sizes[cell]
        of_cell[cell], queries[group] = group, held
    return of_cell, queries


def _blocked(rows: DataFrame, counts: dict[int, int], size: int, name: str) -> DataFrame:
    """Rows with a block within their group (``part``), of about ``size`` rows."""
    blocks = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, -(-n // size))])
    return rows.withColumn(name, F.pmod(F.xxhash64("class"), blocks[F.col("part")]).cast("int"))


def top_k(
    embeddings: DataFrame,
    k: int = BEST,
    every: int = EVERY,
    pivots: int = PIVOTS,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best of every row whose vec_id is divisible by ``every``."""
    spark = embeddings.sparkSession
    work = workspace(spark, "voronoi")
    vectors, dims, largest = integer_vectors(embeddings, work, scale)
    vectors = vectors.where("vec_id IS NOT NULL")
    if largest * largest * max(dims, 1) >= 1 << 63:
        raise ValueError(f"products of {dims} entries up to {largest} do not fit 64 bits")
    wanted = k + 1  # a query meets itself
    ranked = vectors.withColumn("place", F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))).where(F.col("place") <= wanted)
    classes, _ = work.store(
        ranked.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.monotonically_increasing_id().alias("class"), "x", "ids"),
        "classes",
    )
    members, _ = work.store(
        vectors.where(F.col("vec_id") % every == 0).join(classes.select("class", "x"), "x").select("vec_id", "class"), "members"
    )
    asked, seen = work.store(classes.select("class", "x").join(members.select("class").distinct(), "class", "left_semi"), "queries")
    if not seen["rows"] or not dims:
        return spark.createDataFrame([], RESULT)

    sample = asked.orderBy(F.xxhash64("x"), "class").limit(pivots).select("x").toArrow()["x"].combine_chunks()
    cells = Cells(matrix(sample, dims))
    queries, _ = work.store(asked.mapInArrow(_query_cells(cells, dims), "class long, x array<long>, cell int, away double"), "cells")
    sizes = {}
    for row in queries.groupBy("cell").agg(F.max("away").alias("away"), F.count(F.lit(1)).alias("n")).collect():  # one row a pivot
        cells.radius[row["cell"]] = row["away"] * (1 + 1e-12)
        sizes[row["cell"]] = row["n"]
    products = queries.mapInArrow(_query_products(cells, dims), "cell int, pivot int, least double, most double")
    for row in products.groupBy("cell", "pivot").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():  # pivots squared
        cells.least[row["cell"], row["pivot"]], cells.most[row["cell"], row["pivot"]] = row["least"], row["most"]
    lows = classes.mapInArrow(_reached(cells, dims, wanted), "cell int, low double")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("low")))
    for row in lows.withColumn("place", rank).where(F.col("place") == wanted).collect():  # one row a pivot
        cells.reach[row["cell"]] = row["low"]
    of_cell, counts = _packed_groups(sizes, query_block)
    for cell, group in of_cell.items():
        cells.group[cell] = group

    part = F.create_map(*[F.lit(x) for item in of_cell.items() for x in item])[F.col("cell")]
    data, _ = work.store(classes.mapInArrow(_sent(cells, dims), "part int, class long, x array<long>, ids array<long>"), "sent")
    sent = {r["part"]: r["n"] for r in data.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a group
    many = F.create_map(*[F.lit(x) for g in counts for x in (g, -(-sent.get(g, 1) // data_block))])
    left = _blocked(queries.withColumn("part", part), counts, query_block, "query_block")
    left = left.withColumn("data_block", F.explode(F.sequence(F.lit(0), many[F.col("part")] - 1)))
    right = _blocked(data, {g: sent.get(g, 1) for g in counts}, data_block, "data_block")
    blocks = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, -(-n // query_block))])
    right = right.withColumn("query_block", F.explode(F.sequence(F.lit(0), blocks[F.col("part")] - 1)))
    pair = ["part", "query_block", "data_block"]
    found = (
        left.select(*pair, "class", "x", "cell")
        .groupBy(*pair)
        .cogroup(right.select(*pair, "class", "x", "ids").groupBy(*pair))
        .applyInArrow(_solved(cells, dims, largest, wanted), FOUND)
    )
    place = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "vec_id", "own"))
    entry = F.struct("place", "score", "vec_id", "own")
    tops, _ = work.store(
        found.withColumn("place", place).where(F.col("place") <= wanted).groupBy("class").agg(F.sort_array(F.collect_list(entry)).alias("best")),
        "best",
    )
    is_self = F.transform("best", lambda e: (e["own"] == F.col("class")) & (e["vec_id"] == F.col("query_id")))
    itself = F.array_position(is_self, F.lit(True)).cast("int")
    others = F.filter("best", lambda e: e["place"] != F.col("itself"))
    return (
        members.withColumnRenamed("vec_id", "query_id")
        .join(tops, "class")
        .withColumn("itself", itself)
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("before", "entry"))
        .select("query_id", (F.col("before") + 1).alias("rank"), F.col("entry.vec_id").alias("vec_id"), F.col("entry.score").alias("score"))
    )

