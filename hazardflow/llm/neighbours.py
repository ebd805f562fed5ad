"""Approximate nearest neighbours: NN-descent builds the graph, queries walk it greedily."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.llm.common import stored

#: Neighbours kept per vector, reverse edges a vector takes part with, ranks a search keeps,
#: vectors a search opens per step.
DEGREE, REVERSE, BEAM, WIDTH = 32, 16, 128, 24
RUN, TABLES, OFFERS = 256, 3, 4


def _pack(vectors: np.ndarray) -> list[bytes]:
    """Unit vectors in single precision."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return [v.tobytes() for v in unit.astype(np.float32)]


def _unpack(blobs: list[bytes]) -> np.ndarray:
    """Unit vectors, one row each, in double precision, so that sums add no error of their own."""
    return _rows(b"".join(blobs), len(blobs))


def _rows(blob: bytes, count: int) -> np.ndarray:
    x = np.frombuffer(blob, np.float32).reshape(count, -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as doubles, with their packed form; others are left out."""
    for batch in batches:
        ids, out = batch.column("id").to_pylist(), []
        for i, v in zip(ids, batch.column("vector").to_pylist()):
            if i is None or v is None or not v or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and x.any():
                # a scale apart from the square's range, so that no norm overflows or vanishes
                out.append((i, len(x), x.tobytes(), _pack((x / np.abs(x).max())[None, :])[0]))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "size", "exact", "q"])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key after another, from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        if held and held[0].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for c in cuts:
            yield pa.Table.from_batches([*held, batch.slice(at, c - at)])
            held, at = [], c
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


class _Edges:
    """Collects edges and gives them out in batches of bounded size."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]):
        self.names, self.kinds, self.parts, self.rows = names, kinds, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def take(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.rows > least:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(zip(*self.parts), self.kinds)], names=self.names)
            self.parts, self.rows = [], 0


_EDGE = "v bigint, w bigint, sim double"


def _edges() -> _Edges:
    return _Edges(["v", "w", "sim"], [pa.int64(), pa.int64(), pa.float64()])


def _first_guess(degree: int):
    """Best neighbours within runs of rows in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _edges()

        def meet(ids: np.ndarray, blobs: list[bytes]) -> None:
            x = _unpack(blobs)
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            k = min(degree, len(ids) - 1)
            if k < 1:
                return
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            out.add(np.repeat(ids, k), ids[best].ravel(), np.take_along_axis(sims, best, 1).ravel())

        ids, blobs = np.empty(0, np.int64), []
        for batch in batches:
            ids = np.concatenate([ids, batch.column("id").to_numpy()])
            blobs += batch.column("q").to_pylist()
            # a short rest goes with the run before it
            while len(ids) >= 2 * RUN:
                meet(ids[:RUN], blobs[:RUN])
                ids, blobs = ids[RUN:], blobs[RUN:]
            yield from out.take(50_000)
        if len(ids):
            meet(ids, blobs)
        yield from out.take()

    return run


def _codes(dimension: int, table: int):
    """Signs against a table's random directions as one number; near vectors share upper bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(100 + table).normal(size=(dimension, 24)).astype(np.float32)
        for batch in batches:
            if batch.num_rows:
                signs = (_unpack(batch.column("q").to_pylist()) @ planes) > 0
                code = signs @ (1 << np.arange(23, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("q"), pa.array(code)], names=["id", "q", "code"])

    return run


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The neighbours of one vector meet: pairs with a new edge, similar enough to enter a list."""
    out = _edges()
    for group in _groups(batches, "x"):
        ids, at = np.unique(group.column("y").to_numpy(), return_index=True)
        if len(ids) < 2:
            continue
        new = np.zeros(len(ids), bool)
        np.logical_or.at(new, np.searchsorted(ids, group.column("y").to_numpy()), group.column("new").to_numpy().astype(bool))
        x = _unpack([b for b in group.column("q").take(pa.array(at)).to_pylist()])
        floor = group.column("floor").to_numpy()[at]
        sims = x @ x.T
        sims[~(new[:, None] | new[None, :])] = -2
        np.fill_diagonal(sims, -2)
        k = min(OFFERS, len(ids) - 1)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(sims, best, 1)
        good = value > floor[:, None]
        rows, cols = np.nonzero(good)
        out.add(ids[rows], ids[best[rows, cols]], value[rows, cols])
        yield from out.take(50_000)
    yield from out.take()


def _top(edges: DataFrame, degree: int) -> DataFrame:
    """Each vector's best edges; an edge that was there before is not new."""
    best = Window.partitionBy("v").orderBy(F.col("sim").desc(), "w")
    return (
        edges.repartition("v").groupBy("v", "w").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= degree).drop("place")
    )


def _some_reverse(edges: DataFrame, reverse: int, turn: int) -> DataFrame:
    """At most `reverse` of the edges into each vector, new ones first: one from each of so many
    groups of sources, so that a vector in everyone's list stays bounded before any shuffle."""
    lot = F.xxhash64(F.lit(turn), "v")
    return (
        edges.groupBy("w", F.pmod(F.xxhash64("v", F.lit(turn + 1)), F.lit(reverse)).alias("slot"))
        .agg(F.max(F.struct("new", lot.alias("lot"), "v")).alias("e"))
        .select(F.col("e.v").alias("v"), "w", F.col("e.new").alias("new"))
    )


def nn_descent(vectors: DataFrame, dimension: int, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = 12,
               settled: float = 0.005) -> DataFrame:
    """Neighbour graph of distinct packed vectors (id, q): edges (v, w, sim, new), `degree` per
    vector, fewer if there are fewer vectors.

    The first guess sorts the vectors by sign codes of random directions and joins runs of `RUN`
    neighbours in that order, for `TABLES` sets of directions; a run's size is fixed, however many
    vectors share a code. Then each round joins neighbours of neighbours: a bounded number of
    edges out of and into a vector bring their vectors to it, those meet there, and pairs with a
    new edge that beat the worst entry of a list are offered to it. Rounds end when fewer than
    `settled` of all list entries change, or after `rounds`.
    """
    known = vectors.select("id", "q")
    guess = None
    for table in range(TABLES):
        coded = known.mapInArrow(_codes(dimension, table), "id bigint, q binary, code bigint")
        order = ["code", F.xxhash64("id")]
        part = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "q").mapInArrow(_first_guess(degree // 2), _EDGE)
        guess = part if guess is None else guess.unionByName(part)
    graph = stored(_top(guess.withColumn("new", F.lit(1)), degree), "graph")
    for turn in range(rounds):
        floors = graph.groupBy("v").agg(F.min("sim").alias("low"), F.count("*").alias("n")).select(
            F.col("v").alias("y"), F.when(F.col("n") < degree, -2.0).otherwise(F.col("low")).alias("floor")
        )
        nodes = known.withColumnRenamed("id", "y").join(floors, "y")
        edges = _some_reverse(graph, reverse, 2 * turn)
        both = edges.select(F.col("v").alias("x"), F.col("w").alias("y"), "new").unionByName(
            edges.select(F.col("w").alias("x"), F.col("v").alias("y"), "new")
        )
        offers = both.join(nodes, "y").repartition("x").sortWithinPartitions("x").mapInArrow(_local_join, _EDGE)
        old = graph.withColumn("new", F.lit(0))
        graph = stored(_top(old.unionByName(offers.withColumn("new", F.lit(1))), degree), "graph")
        changed, total = graph.agg(F.sum("new"), F.count("*")).first()
        if not total or changed <= settled * total:
            break
    return graph


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per vector: its neighbours' ids and packed vectors."""
    for group in _groups(batches, "x"):
        ids, at = np.unique(group.column("y").to_numpy(), return_index=True)
        blob = b"".join(group.column("q").take(pa.array(at)).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([group.column("x")[0].as_py()]), pa.array([ids.tobytes()]), pa.array([blob])], names=["x", "ids", "blob"]
        )


def adjacency(graph: DataFrame, vectors: DataFrame, reverse: int = REVERSE) -> DataFrame:
    """The graph as the search reads it: per vector the ids and packed vectors of its neighbours
    and of some that list it. A step then sends a query's vector to the node, not many back."""
    back = _some_reverse(graph.withColumn("new", F.lit(1)), reverse, 991)
    edges = graph.select(F.col("v").alias("x"), F.col("w").alias("y")).unionByName(back.select(F.col("w").alias("x"), F.col("v").alias("y")))
    rows = edges.join(vectors.select(F.col("id").alias("y"), "q"), "y").repartition("x").sortWithinPartitions("x")
    return rows.mapInArrow(_adjacent, "x bigint, ids binary, blob binary")


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarities of queries to the neighbours of the nodes they open."""
    out = _Edges(["query", "node", "sim", "opened"], [pa.int64(), pa.int64(), pa.float64(), pa.int32()])
    for batch in batches:
        for query, q, ids, blob in zip(*(batch.column(c).to_pylist() for c in ("query", "q", "ids", "blob"))):
            nodes = np.frombuffer(ids, np.int64)
            x = _unpack([q])[0]
            y = _rows(blob, len(nodes))
            out.add(np.full(len(nodes), query), nodes, y @ x, np.zeros(len(nodes), np.int32))
            yield from out.take(50_000)
    yield from out.take()


_BEAM = "query bigint, node bigint, sim double, opened int"


def greedy_search(links: DataFrame, queries: DataFrame, beam: int = BEAM, width: int = WIDTH) -> DataFrame:
    """Best nodes found for each query: rows (query, node, sim), at most `beam` per query.

    `queries`: (query, q, node), the packed vector and the graph node to start from. Each step
    opens the `width` best unopened nodes of every query's list, all queries at once, and keeps
    the best `beam` of what is known; a query is done when its whole list is opened.
    """
    queries = stored(queries, "queries")
    known = queries.select("query", "node", F.lit(2.0).alias("sim"), F.lit(0).alias("opened"))
    while True:
        turn = Window.partitionBy("query", "opened").orderBy(F.col("sim").desc(), "node")
        marked = stored(known.withColumn("turn", (F.row_number().over(turn) <= width) & (F.col("opened") == 0)), "beam")
        front = marked.where("turn").select("query", "node")
        if front.isEmpty():
            return marked.select("query", "node", "sim")
        steps = front.join(queries.select("query", "q"), "query").withColumnRenamed("node", "x").join(links, "x")
        found = steps.select("query", "q", "ids", "blob").mapInArrow(_open, _BEAM)
        old = marked.select("query", "node", "sim", F.when(F.col("turn"), 1).otherwise(F.col("opened")).alias("opened"))
        best = Window.partitionBy("query").orderBy(F.col("sim").desc(), "node")
        known = (
            old.unionByName(found).repartition("query").groupBy("query", "node")
            .agg(F.max("sim").alias("sim"), F.max("opened").alias("opened"))
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= beam).drop("place")
        )


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for a, b in zip(batch.column("exact").to_pylist(), batch.column("other").to_pylist()):
            x, y = np.frombuffer(a, np.float64), np.frombuffer(b, np.float64)
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            out.append(float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y))))
        yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("node"), pa.array(out, pa.float64())], names=["query", "node", "score"])


def nearest(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = 50, count: int = 5,
            beam: int = BEAM, width: int = WIDTH, **graph) -> DataFrame:
    """The `count` nearest vectors by cosine of every row whose id is divisible by `every`, among
    all other rows: query_id, rank (from 1), vec_id, score, nearest first, ties to smaller ids.

    Every usable vector is in the graph of `nn_descent`; vectors equal in every component are one
    node that keeps the `count` + 1 smallest ids, all that an answer can show of them. A query
    starts at its own node. Graph and search work on unit vectors in single precision; all nodes of a
    query's list are then measured on the original vectors in double precision.

    Null, empty and zero vectors, vectors holding null or non-finite components, and rows with a
    null id take no part; nor do vectors of another length than the most common one (ties: the
    shorter). A doubled id counts as two rows: both may be answers, under the same id, and each is
    asked for, giving two lists; rows of a query's own id are no answers to it. Rows repeated with id
    and vector are asked for once. With fewer candidates than `count`, all are given. Empty input gives
    no rows.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
    rows = stored(rows.mapInArrow(_valid, "id bigint, size int, exact binary, q binary"), "vectors")
    lengths = rows.groupBy("size").count().orderBy(F.col("count").desc(), "size").first()
    size = lengths["size"] if lengths else 1
    rows = rows.where(F.col("size") == size).withColumn("d1", F.xxhash64("exact")).withColumn("d2", F.xxhash64(F.lit(3), "exact"))
    place = Window.partitionBy("d1", "d2").orderBy("id")
    members = stored(
        rows.select("d1", "d2", "id").withColumn("place", F.row_number().over(place)).where(F.col("place") <= count + 1), "members"
    )
    # nodes and queries have numbers of their own: an id may stand for several vectors
    heads = stored(members.where("place = 1").select("d1", "d2", "id", F.monotonically_increasing_id().alias("node")), "heads")
    nodes = stored(
        rows.join(heads, ["id", "d1", "d2"]).select(F.col("node").alias("id"), "q", "exact").dropDuplicates(["id"]), "nodes"
    )
    heads = heads.drop("id")
    links = stored(adjacency(nn_descent(nodes, size, **graph), nodes), "links")
    asked = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "d1", "d2"]).join(heads, ["d1", "d2"])
    asked = stored(asked.select(F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"), "q", "exact", "node"), "asked")
    found = greedy_search(links, asked.select("query", "q", "node"), beam, width)
    scored = (
        found.select("query", "node").join(nodes.select(F.col("id").alias("node"), F.col("exact").alias("other")), "node")
        .join(asked.select("query", "exact"), "query").select("query", "node", "exact", "other")
        .mapInArrow(_cosines, "query bigint, node bigint, score double")
    )
    owner = members.join(heads, ["d1", "d2"]).select("node", F.col("id").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (
        scored.join(owner, "node").join(asked.select("query", "query_id"), "query").where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
