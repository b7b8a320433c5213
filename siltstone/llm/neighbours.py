"""Nearest neighbours by inner product over robust-pruned graphs, one per shard of the vectors.

Equal vectors are one node, which keeps the least ids of its rows. Nodes are
dealt to shards by a hash; each shard becomes a directed graph of at most
``DEGREE`` edges a node. Nodes enter in batches that double: a greedy search
from the entry nodes over the graph so far, and the nearest ones of the same
batch, propose neighbours. Pruning takes the nearest proposal, drops all that
are ``RELAXED`` times nearer to it than to the node itself, and goes on, so few
edges point in many directions. Each edge is offered back to its target, which
prunes again when it has too many.

The largest inner product becomes the least distance by one more component,
which gives all vectors the length of the longest; queries have 0 there. So the
graph is built for one metric whatever the vectors' lengths are. A search keeps
a beam of the best nodes and expands the nearest one not yet expanded until the
beam is done; searches of a block run in step. Scores are computed again from
the vectors themselves.

One shard is built in one task and its size is bounded by ``SHARD_NODES``; the
index is a table, and queries stream past each shard in batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.codes import finite_vectors
from siltstone.llm.common import save

DEGREE = 32
RELAXED = 1.2
# Nodes kept while searching: to propose neighbours, and for a query.
BUILD_BEAM, QUERY_BEAM = 64, 128
# Neighbours proposed out of a node's own batch, and the largest batch.
SAME_BATCH, BATCH = 16, 1024
ENTRY_NODES = 8
# A shard holds about this many nodes at most; small tables still make this many shards, but none of fewer nodes than that.
SHARD_NODES, SHARDS, FEWEST = 32_768, 8, 256
NEAREST = 20
# Searches in step, by numbers held at a time.
STEP = 1 << 22


def _order(d: np.ndarray, take: int) -> np.ndarray:
    """Columns of the ``take`` least of each row, in order."""
    if take < d.shape[1]:
        part = np.argpartition(d, take - 1, axis=1)[:, :take]
        return np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, 1), axis=1, kind="stable"), 1)
    return np.argsort(d, axis=1, kind="stable")


def _distances(q: np.ndarray, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``q`` to its row of nodes; -1 is no node."""
    apart = x[np.maximum(ids, 0)] - q[:, None, :]
    return np.where(ids < 0, np.float32(np.inf), np.einsum("qcd,qcd->qc", apart, apart))


def _products(q: np.ndarray, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products, the largest first: below any distance in the same order, as all nodes are equally long."""
    return np.where(ids < 0, np.float32(np.inf), -np.einsum("qcd,qd->qc", x[np.maximum(ids, 0)], q))


def search(x: np.ndarray, edges: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int, away=_distances) -> np.ndarray:
    """Beam searches in step: the nodes of each query's beam, nearest by ``away`` first; -1 fills up."""
    n, found = len(q), []
    size = max(1, STEP // (x.shape[1] * max(edges.shape[1], len(entry))))
    for at in range(0, n, size):
        part = q[at:at + size]
        ids = np.broadcast_to(entry.astype(np.int32), (len(part), len(entry)))
        d = away(part, x, ids)
        first = _order(d, min(beam, d.shape[1]))
        pad = beam - first.shape[1]
        nodes = np.pad(np.take_along_axis(ids, first, 1), ((0, 0), (0, pad)), constant_values=-1)
        dist = np.pad(np.take_along_axis(d, first, 1), ((0, 0), (0, pad)), constant_values=np.inf)
        done = nodes < 0
        # One bit per query and node: each node is measured once for a query.
        known = np.zeros((len(part), (len(x) + 7) // 8), np.uint8)
        _mark(known, np.arange(len(part))[:, None], ids)
        live = np.arange(len(part))
        while len(live):
            best = np.argmin(np.where(done[live], np.inf, dist[live]), axis=1)
            going = ~done[live, best]
            live, best = live[going], best[going]
            if not len(live):
                break
            done[live, best] = True
            new = edges[nodes[live, best]]
            seen = (known[live[:, None], np.maximum(new, 0) >> 3] >> (np.maximum(new, 0) & 7).astype(np.uint8)) & 1
            new = np.where(seen.astype(bool), -1, new)
            _mark(known, live[:, None], new)
            d = away(part[live], x, new)
            both = np.concatenate([dist[live], d], axis=1)
            order = _order(both, beam)
            dist[live] = np.take_along_axis(both, order, 1)
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], new], axis=1), order, 1)
            closed = np.concatenate([done[live], new < 0], axis=1)
            done[live] = np.take_along_axis(closed, order, 1)
        found.append(nodes)
    return np.concatenate(found) if found else np.zeros((0, beam), np.int32)


def _mark(known: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
    good = ids >= 0
    rows = np.broadcast_to(rows, ids.shape)[good]
    np.bitwise_or.at(known, (rows, ids[good] >> 3), np.uint8(1) << (ids[good] & 7).astype(np.uint8))


def prune(x: np.ndarray, own: np.ndarray, ids: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Diverse neighbours (rows, degree) of the nodes ``own`` out of proposals ``ids``; -1 fills up.

    The nearest proposal left is taken, and all are dropped whose distance to
    it is less than their distance to the node by the factor ``relaxed``.
    """
    out = np.full((len(own), degree), -1, np.int32)
    size = max(1, STEP // (ids.shape[1] * max(x.shape[1], ids.shape[1])))
    for at in range(0, len(own), size):
        rows, some = own[at:at + size], ids[at:at + size]
        some = np.sort(np.where(some == rows[:, None], -1, some), axis=1)
        some[:, 1:][some[:, 1:] == some[:, :-1]] = -1  # each proposal once
        d = _distances(x[rows], x, some)
        order = np.argsort(d, axis=1, kind="stable")
        some, d = np.take_along_axis(some, order, 1), np.take_along_axis(d, order, 1)
        seen = x[np.maximum(some, 0)] - x[rows][:, None, :]  # around the node: little is lost to rounding
        norm = np.einsum("qcd,qcd->qc", seen, seen)
        between = norm[:, :, None] + norm[:, None, :] - 2 * (seen @ seen.transpose(0, 2, 1))
        left = some >= 0
        lines = np.arange(len(rows))
        for j in range(degree):
            first = left.argmax(1)
            any_ = left[lines, first]
            if not any_.any():
                break
            out[at:at + size][:, j] = np.where(any_, some[lines, first], -1)
            left &= relaxed * relaxed * between[lines, first] > d
            left[lines, first] = False
    return out


def build_graph(
    x: np.ndarray, degree: int = DEGREE, relaxed: float = RELAXED, beam: int = BUILD_BEAM, seed: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """(edges, entry nodes) over the rows of ``x``; the same for the same rows."""
    n = len(x)
    edges = np.full((n, degree), -1, np.int32)
    if not n:
        return edges, np.zeros(0, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    middle = np.einsum("nd,nd->n", x - x.mean(0), x - x.mean(0)).argmin()
    order = np.concatenate([[middle], order[order != middle]]).astype(np.int32)
    entry = order[:min(ENTRY_NODES, n)]
    at = 0
    while at < n:
        batch = order[at:at + max(min(at, BATCH), 64)]
        proposed = [_in_batch(x, batch)]
        if at:
            proposed.append(search(x, edges, entry[:at], x[batch], beam))
        edges[batch] = prune(x, batch, np.concatenate(proposed, axis=1), degree, relaxed)
        _offer_back(x, edges, batch, degree, relaxed)
        at += len(batch)
    return edges, entry


def _in_batch(x: np.ndarray, batch: np.ndarray) -> np.ndarray:
    """The nearest nodes of the same batch."""
    some = x[batch] - x[batch].mean(0)
    norm = np.einsum("nd,nd->n", some, some)
    d = norm[:, None] + norm[None, :] - 2 * some @ some.T
    np.fill_diagonal(d, np.inf)
    return batch[_order(d, min(SAME_BATCH, len(batch)))]


def _offer_back(x: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, relaxed: float) -> None:
    """Add the edges of ``batch`` the other way round; a node with too many is pruned again."""
    target, source = edges[batch].ravel(), np.repeat(batch, degree)
    target, source = target[target >= 0], source[target >= 0]
    # Nodes of the batch point at one another already if they do.
    order = np.lexsort((source, target))
    target, source = target[order], source[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    # Like numbers of offers together, so that rows are filled up little.
    for low in (0, 4, 16, 64, 256, 1024, 4096):
        some = np.flatnonzero((count > low) & (count <= (low * 4 if low else 4)) if low < 4096 else count > low)
        if not len(some):
            continue
        wide = int(count[some].max())
        place = np.arange(wide)[None, :]
        offers = np.where(place < count[some, None], source[np.minimum(first[some, None] + place, len(source) - 1)], -1)
        both = np.concatenate([edges[nodes[some]], offers], axis=1)
        if wide > 4 * degree:  # a hub: the nearest offers are enough to choose from
            d = np.concatenate([_distances(x[nodes[some]][i:i + 64], x, both[i:i + 64]) for i in range(0, len(some), 64)])
            both = np.take_along_axis(both, _order(d, 5 * degree), 1)
        ordered = np.sort(both, axis=1)[:, ::-1]
        ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
        full = (ordered >= 0).sum(1) > degree
        kept = np.sort(ordered, axis=1)[:, ::-1][:, :degree]
        if full.any():
            kept[full] = prune(x, nodes[some][full], ordered[full], degree, relaxed)
        edges[nodes[some], :kept.shape[1]] = kept


def vector_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v, key) of the rows that take part: with an id, and a finite vector that isn't zero."""
    v = F.col(vec_col)
    good = finite_vectors(df, vec_col) & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()
    rows = df.filter(good).select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    # Adding 0 makes one of both zeros. Texts of numbers are exact, so equal keys mean equal vectors.
    told = F.array_join(F.transform("v", lambda x: (x + F.lit(0.0)).cast("string")), ",")
    return rows.withColumn("key", F.md5(told))


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """(key, v, ids): one row per different vector with its ``keep`` least ids."""
    # Spark keeps the first ``keep`` rows of a key per task before the shuffle.
    place = Window.partitionBy("key").orderBy("vec_id")
    least = rows.select("key", "vec_id").distinct().withColumn("_n", F.row_number().over(place)).filter(F.col("_n") <= keep)
    ids = least.groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # Copies are brought down to one per task before they move, too.
    return rows.groupBy("key").agg(F.any_value("v").alias("v")).join(ids, "key")


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(values) % len(column) or (np.diff(column.offsets.to_numpy()) != len(values) // len(column)).any():
        raise ValueError("vectors of unequal length")
    return values.reshape(len(column), -1)


def lengthened(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that gives all of them the length ``longest``."""
    rest = np.sqrt(np.maximum(longest * longest - np.einsum("nd,nd->n", v, v), 0))
    return np.concatenate([v, rest[:, None]], axis=1).astype(np.float32)


def _graph(longest: float, degree: int, relaxed: float, beam: int):
    """A whole shard as a graph: (shard, node, key, v, ids, edges, entry)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")  # the order in which rows arrive may differ
        v = _matrix(table.column("v"))
        edges, entry = build_graph(lengthened(v, longest), degree, relaxed, beam)
        first = np.zeros(len(v), bool)
        first[entry] = True
        return pa.table({
            "shard": table.column("shard"), "node": pa.array(np.arange(len(v), dtype=np.int32)),
            "v": table.column("v"), "ids": table.column("ids"),
            "edges": pa.array(list(edges), pa.list_(pa.int32())), "entry": pa.array(first)})

    return run


def build_index(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", keep: int = NEAREST + 1,
    degree: int = DEGREE, relaxed: float = RELAXED, beam: int = BUILD_BEAM, shard_nodes: int = SHARD_NODES,
) -> tuple[DataFrame, float]:
    """(the index, the longest vector's length). The index has one row per different vector:
    shard, node, v, ids (the ``keep`` least), edges, entry.

    Rows without id and vectors that are null, zero, or hold null or non-finite
    components take no part. Repeated rows are one. Vectors of unequal length are an error. An empty table gives
    an empty index.
    """
    spark = vectors.sparkSession
    nodes = save(nodes_of(vector_rows(vectors, id_col, vec_col), keep), "nodes")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    many, longest = nodes.agg(F.count(F.lit(1)), F.max(F.sqrt(square))).first()
    shards = max(-(-many // shard_nodes), min(SHARDS, many // FEWEST), 1)
    # A hash of the vector deals the nodes, so a copy more or less moves no other.
    number = F.pmod(F.conv(F.substring("key", 1, 15), 16, 10).cast("long"), F.lit(shards)).cast("int")
    dealt = nodes.withColumn("shard", number)
    index = dealt.groupBy("shard").applyInArrow(
        _graph(longest or 0.0, degree, relaxed, beam),
        "shard int, node int, v array<double>, ids array<long>, edges array<int>, entry boolean")
    return save(index, "index"), longest or 0.0


def _answers(longest: float, k: int, beam: int):
    """Each query's best ids of each shard. A shard's nodes come first, in their order, then the queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, index = None, [], None
        for batch in batches:
            at = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, int)
            for begin, end in zip(cuts, np.append(cuts[1:], len(at))):
                rows = batch.slice(begin, end - begin)
                if at[begin] != shard:
                    shard, parts, index = at[begin], [], None
                is_node = rows.column("node").is_valid().to_numpy(zero_copy_only=False)
                if is_node.any():
                    parts.append(rows.slice(0, int(is_node.sum())))
                queries = rows.slice(int(is_node.sum()))
                if len(queries):
                    if index is None:
                        if not parts:
                            continue  # a hash left this shard empty
                        index = _loaded(parts, longest)
                        parts = []
                    yield _answered(index, queries, k, beam)

    return run


def _loaded(parts: list[pa.RecordBatch], longest: float):
    table = pa.Table.from_batches(parts).combine_chunks()
    v = _matrix(table.column("v"))
    ids = table.column("ids").combine_chunks()
    edges = table.column("edges").combine_chunks().flatten().to_numpy().reshape(len(v), -1)
    entry = np.flatnonzero(table.column("entry").to_numpy())
    return v, lengthened(v, longest), ids.offsets.to_numpy(), ids.values.to_numpy(), edges, entry


def _answered(index, queries: pa.RecordBatch, k: int, beam: int) -> pa.RecordBatch:
    v, x, offsets, ids, edges, entry = index
    q = _matrix(queries.column("v"))
    if q.shape[1] != v.shape[1]:
        raise ValueError("vectors of unequal length")
    own = queries.column("query_id").to_numpy()
    long_q = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
    found = search(x, edges, entry, long_q, max(beam, k + 1), _products)
    got_ids, got_scores = [], []
    for i in range(len(q)):
        nodes = found[i][found[i] >= 0]
        # Added up from the first component to the last, in doubles, as a plain sum is.
        scores = np.zeros(len(nodes))
        for j in range(v.shape[1]):
            scores += v[nodes, j] * q[i, j]
        count = offsets[nodes + 1] - offsets[nodes]
        place = np.repeat(offsets[nodes] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
        each, score = ids[place], np.repeat(scores, count)
        each, score = each[each != own[i]], score[each != own[i]]
        order = np.lexsort((each, -score))[:k]
        got_ids.append(each[order])
        got_scores.append(score[order])
    return pa.RecordBatch.from_arrays(
        [queries.column("query_id"), queries.column("key"), pa.array(got_ids, pa.list_(pa.int64())),
         pa.array(got_scores, pa.list_(pa.float64()))], names=["query_id", "key", "ids", "scores"])


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = NEAREST,
    beam: int = QUERY_BEAM, index: tuple[DataFrame, float] | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of largest inner product found for each query.

    Queries are the rows of ``vectors`` for which ``is_query`` (over vec_id) holds; every row with
    another id may be an answer, all if there are fewer than ``k``. Nearest
    first, ties to the smaller id. What takes no part: see
    :func:`build_index`; an id with several vectors is a query with each.
    ``index`` is one built before with ``keep`` of at least k + 1. A query visits each shard, so
    the work is queries times shards: large shards make few of them.
    """
    graph, longest = index or build_index(vectors, id_col, vec_col, keep=k + 1)
    asked = vector_rows(vectors, id_col, vec_col).distinct().filter(is_query)
    asked = save(asked.select(F.col("vec_id").alias("query_id"), "key", "v"), "queries")
    number = (graph.agg(F.max("shard")).first()[0] or 0) + 1
    sent = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
    none = F.lit(None)
    rows = graph.select("shard", "node", "v", "ids", "edges", "entry", none.cast("long").alias("query_id"), none.cast("string").alias("key"))
    rows = rows.unionByName(sent, allowMissingColumns=True)
    dealt = rows.repartitionByRange(number, "shard").sortWithinPartitions("shard", F.col("node").asc_nulls_last())
    told = save(dealt.mapInArrow(
        _answers(longest, k, beam), "query_id long, key string, ids array<long>, scores array<double>"), "answers")
    each = told.select("query_id", "key", F.explode(F.arrays_zip("ids", "scores")).alias("a"))
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("a.scores"), "a.ids")
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("a.ids").alias("vec_id"), F.col("a.scores").alias("score"))
