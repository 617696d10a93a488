"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Equal vectors are one node, so a vector that a third of all rows share is one
node, too; a node keeps the smallest ids of its rows, as many as an answer can
name. Nodes are dealt to shards of about ``SHARD_NODES`` by a hash of the
vector. A shard's graph is built in one task and stored as one row of flat
arrays: the vectors, and per layer an array of neighbours (-1 where there are
none). Nodes stand in the order of their layers, so a layer holds a prefix of
them and needs no list of its own.

Building: nodes enter a layer in growing batches. A batch finds its nearest
nodes by a best-first search of ``EF_BUILD`` candidates over the nodes already
there, keeps up to M that are nearer to it than to each other, and links back;
a node with too many links keeps the most varied ones. Searches run over all
queries of a batch at once.

Searching: queries are dealt in blocks to every shard; each block searches a
shard from its entry node down with ``EF_SEARCH`` candidates, and every one of
these is scored exactly, in double precision, on the original vectors. The best
of a query over all shards are its result. Measured recall is in the README.

Cases: rows whose id or vector is null, whose vector is empty, zero or holds
null or non-finite components take no part; rows that share an id are one row,
the smallest vector; vectors meet only those of the same dimension; ties go to
smaller ids; a query without candidates has no rows; an empty table gives none.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, stored

#: Nodes of a shard, queries of a block.
SHARD_NODES, QUERY_BLOCK = 8192, 4096
#: Links of a node above and in the lowest layer.
LINKS, LINKS_LOW = 16, 40
EF_BUILD, EF_SEARCH = 96, 192
#: Nodes that enter a layer at once, and queries searched at once.
BATCH = 256
#: Candidates expanded at once in a search.
WIDTH = 4


# --- graph kernels ----------------------------------------------------------

def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by their largest component first, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision; equal rows give equal values wherever they stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search_layer(units: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest nodes found for each query, nearest first, and their distances (-1 and inf where fewer).

    ``entries`` holds the start nodes of each query (-1: none). A search ends
    when all its candidates have been expanded.
    """
    n, q = len(links), len(queries)
    seen = np.zeros((q, n), bool)
    rows = np.arange(q)
    ids = np.full((q, ef), -1, np.int64)
    near = np.full((q, ef), np.inf, np.float32)
    done = np.ones((q, ef), bool)
    start = entries[:, :ef]
    k = start.shape[1]
    ids[:, :k], done[:, :k] = start, start < 0
    near[:, :k] = np.where(start >= 0, 1 - np.einsum("qkd,qd->qk", units[start], queries), np.inf)
    seen[np.repeat(rows, k)[(start >= 0).ravel()], start[start >= 0]] = True
    order = np.argsort(near, axis=1, kind="stable")
    ids, near, done = (np.take_along_axis(x, order, 1) for x in (ids, near, done))
    active = rows
    while len(active):
        waiting = np.where(done[active], np.inf, near[active])
        width = min(WIDTH, ef)
        at = np.argpartition(waiting, width - 1, axis=1)[:, :width]
        open_ = np.isfinite(np.take_along_axis(waiting, at, 1))
        live = open_.any(axis=1)
        active, at, open_ = active[live], at[live], open_[live]
        if not len(active):
            break
        done[active[:, None], at] = True
        cells = np.where(open_[:, :, None], links[np.where(open_, ids[active[:, None], at], 0)], -1).reshape(len(active), -1)
        new = (cells >= 0) & ~seen[active[:, None], cells]
        who, where = np.nonzero(new)
        found = cells[who, where]
        # a node may be linked from two of the nodes expanded: its first place counts
        _, first = np.unique(who * n + found, return_index=True)
        who, where, found = who[first], where[first], found[first]
        seen[active[who], found] = True
        far = np.full(cells.shape, np.inf, np.float32)
        far[who, where] = 1 - np.einsum("kd,kd->k", units[found], queries[active[who]])
        all_near = np.concatenate([near[active], far], axis=1)
        best = np.argpartition(all_near, ef - 1, axis=1)[:, :ef]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_near, best, 1), axis=1, kind="stable"), 1)
        near[active] = np.take_along_axis(all_near, best, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], cells], axis=1), best, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], np.zeros(cells.shape, bool)], axis=1), best, 1)
        done[active] |= ~np.isfinite(near[active])
    ids[~np.isfinite(near)] = -1
    return ids, near


def select_links(units: np.ndarray, base: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's candidates (nearest first): those nearer to
    the base than to a link already chosen, then the nearest of the rest."""
    valid = (ids >= 0) & np.isfinite(near)
    vectors = units[np.where(valid, ids, 0)]
    between = 1 - np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        nearer = (chosen & (between[:, c, :] < near[:, c, None])).any(axis=1)
        chosen[:, c] = valid[:, c] & ~nearer & (chosen.sum(axis=1) < most)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out


def link_back(units: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Enter the new nodes in the lists of those they chose; full lists keep the most varied."""
    most = links.shape[1]
    target, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
    for size in np.unique(counts):  # nodes with as many new links at once
        some = counts == size
        own = nodes[some]
        added = source[starts[some][:, None] + np.arange(size)]
        for lo in range(0, len(own), BATCH):
            base, more = own[lo : lo + BATCH], added[lo : lo + BATCH]
            ids = np.concatenate([links[base], more], axis=1)
            near = np.where(ids >= 0, 1 - np.einsum("kcd,kd->kc", units[np.where(ids >= 0, ids, 0)], units[base]), np.inf).astype(np.float32)
            by = np.argsort(near, axis=1, kind="stable")
            ids, near = np.take_along_axis(ids, by, 1), np.take_along_axis(near, by, 1)
            full = (ids >= 0).sum(axis=1) > most
            links[base[~full]] = ids[~full, :most]
            if full.any():
                links[base[full]] = select_links(units, base[full], ids[full], near[full], most)


def layer_sizes(n: int) -> list[int]:
    """Nodes of each layer from the lowest up: about one of LINKS stands in the layer above."""
    out = [n]
    while out[-1] > LINKS * 4:
        out.append(max(1, out[-1] // LINKS))
    return out


def descend(units: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, down_to: int) -> np.ndarray:
    """A start node for each query in layer ``down_to``: the nearest found in the layers above it."""
    at = np.zeros((len(queries), 1), np.int64)
    for links in reversed(layers[down_to + 1 :]):
        at = search_layer(units, links, queries, at, WIDTH)[0]
    return at


def build_graph(units: np.ndarray) -> list[np.ndarray]:
    """The layers' flat neighbour arrays, lowest first; layer l holds the first ``layer_sizes(n)[l]`` nodes."""
    sizes = layer_sizes(len(units))
    layers = [np.full((size, LINKS if k else LINKS_LOW), -1, np.int32) for k, size in enumerate(sizes)]
    for k in range(len(sizes) - 1, -1, -1):
        links, most, done = layers[k], LINKS, 1
        while done < sizes[k]:
            new = np.arange(done, min(sizes[k], done + min(done, BATCH)))
            start = descend(units, layers, units[new], k)
            start = np.where(start < done, start, 0)
            ids, near = search_layer(units, links[:done], units[new], start, min(EF_BUILD, done))
            links[new, :most] = select_links(units, new, ids, near, most)
            link_back(units, links, new, links[new, :most].astype(np.int64))
            done += len(new)
    return layers


# --- Spark ------------------------------------------------------------------

GRAPH = "dim int, shard int, n int, vectors binary, ids binary, n_ids binary, links array<binary>"
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part, one for each id."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _nodes(rows: DataFrame, named: int) -> DataFrame:
    """v and its smallest ids, ``named`` at most, of each different vector."""
    first = rows.withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= named)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _built(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """One shard's graph as a row. The order of nodes, and so their layers, is a hash of their smallest id."""
    first = np.array([x[0] for x in nodes["ids"]], np.int64)
    order = np.argsort(mix64(first.view(np.uint64)), kind="stable")
    vectors = np.array(nodes["v"].tolist(), np.float64)[order]
    ids = [np.asarray(nodes["ids"].iloc[k], np.int64) for k in order]
    layers = build_graph(unit(vectors))
    return pd.DataFrame([{
        "dim": key[0], "shard": key[1], "n": len(order), "vectors": vectors.tobytes(), "ids": np.concatenate(ids).tobytes(),
        "n_ids": np.array([len(x) for x in ids], np.int32).tobytes(), "links": [x.tobytes() for x in layers]}])


def index(rows: DataFrame, named: int) -> DataFrame:
    """The stored graphs, a row per shard; ``rows`` as of :func:`usable`."""
    nodes = stored(_nodes(rows, named), "nodes")
    shards = max(1, -(-nodes.count() // SHARD_NODES))
    dealt = nodes.select("v", "ids", F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"))
    return stored(dealt.groupBy("dim", "shard").applyInPandas(_built, GRAPH), "graphs")


def _searched(k: int):
    """Each query's best ``k`` of a shard, its own row not among them."""

    def run(key: tuple, graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if graphs.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": np.int64, "vec_id": np.int64, "score": float})
        graph, dim = graphs.iloc[0], key[0]
        vectors = np.frombuffer(graph["vectors"], np.float64).reshape(-1, dim)
        n_ids = np.frombuffer(graph["n_ids"], np.int32)
        ids, first = np.frombuffer(graph["ids"], np.int64), np.concatenate([[0], np.cumsum(n_ids)])
        layers = [np.frombuffer(x, np.int32).reshape(size, -1) for x, size in zip(graph["links"], layer_sizes(len(vectors)))]
        units, out = unit(vectors), []
        query_ids = queries["vec_id"].to_numpy(np.int64)
        wanted = np.array(queries["v"].tolist(), np.float64)
        for lo in range(0, len(wanted), BATCH):
            own, q = query_ids[lo : lo + BATCH], wanted[lo : lo + BATCH]
            uq = unit(q)
            found = search_layer(units, layers[0], uq, descend(units, layers, uq, 0), min(EF_SEARCH, len(units)))[0]
            who, at = np.nonzero(found >= 0)
            node = found[who, at]
            score = cosine(q[who], vectors[node])
            # every id of a node found, but the query's own
            times = n_ids[node]
            each = np.repeat(np.arange(len(node)), times)
            vec = ids[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + first[node][each]]
            who, score = who[each], score[each]
            other = vec != own[who]
            who, vec, score = who[other], vec[other], score[other]
            order = np.lexsort((vec, -score, who))
            who, vec, score = who[order], vec[order], score[order]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            best = rank < k
            out.append(pd.DataFrame({"query_id": own[who[best]], "vec_id": vec[best], "score": score[best]}))
        return pd.concat(out)

    return run


def nearest(vectors: DataFrame, query_ids, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the ``k`` nearest rows found for
    each row whose id satisfies ``query_ids`` (a function of the id column)."""
    rows = stored(usable(vectors), "rows")
    graphs = index(rows, k + 1)
    queries = rows.where(query_ids(F.col("vec_id")))
    places = graphs.select("dim", F.expr("shard + 0").alias("shard"))  # a column of its own beside the graphs'
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    # every block meets every shard: the stated queries against all rows, in blocks
    asked = queries.select("vec_id", "v", F.size("v").alias("dim"), block.alias("block")).join(places, "dim")
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = served.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_searched(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
