"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

A shard holds a bounded number of distinct vectors and its graph as flat neighbour arrays, one row
of a written table. Queries come in blocks; every block meets every shard, and the shards' nearest
are merged. Inner products become distances of unit-like vectors by one more component, so that the
graph is one of a metric. Searches and insertions run for many vectors in step, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import broadcast_within
from tallyfold.session import staged

_NONE = -1
#: Distinct lengths of vectors that are broadcast; more are joined.
BROADCAST_SIZES = 10_000


def _diverse(near: np.ndarray, vectors: np.ndarray, own: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of ``near``: each closer to ``own`` than to those chosen before; then the nearest left."""
    if len(near) <= most:
        return near
    to_own = vectors[near] @ own
    near = near[np.argsort(-to_own, kind="stable")]
    to_own = vectors[near] @ own
    between = vectors[near] @ vectors[near].T
    blocked = np.zeros(len(near), dtype=bool)
    chosen = []
    for i in range(len(near)):
        if not blocked[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            blocked |= between[i] > to_own
    rest = [i for i in range(len(near)) if i not in set(chosen)]
    return near[(chosen + rest)[:most]]


class Graph:
    """Neighbour arrays by level: row ``i`` of level ``l`` lists the neighbours of node ``i``, padded with -1."""

    def __init__(self, vectors: np.ndarray, links: int = 16, breadth: int = 96, seed: int = 7) -> None:
        n = len(vectors)
        self.vectors, self.links, self.breadth = vectors, links, breadth
        draws = np.random.default_rng(seed).random(n)
        self.levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(links)).astype(int), 8)
        order = np.argsort(-self.levels, kind="stable")  # the top levels first, so that the entry never changes
        self.entry = int(order[0])
        self.arrays = [np.full((n, 2 * links if level == 0 else links), _NONE, dtype=np.int32) for level in range(int(self.levels.max()) + 1)]
        at, size = 0, 1
        while at < n:
            self._insert(order[at : at + size], at == 0)
            at, size = at + size, min(256, max(1, (at + size) // 2))

    def search(self, queries: np.ndarray, breadth: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the ``breadth`` nearest found, nearest first, -1 where there are fewer."""
        found = np.full((len(queries), 1), self.entry, dtype=np.int32)
        for upper in range(len(self.arrays) - 1, level, -1):
            found, _ = self._beam(queries, found, 4, upper)
        return self._beam(queries, found, breadth, level)

    def _beam(self, queries: np.ndarray, starts: np.ndarray, breadth: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        array, rows = self.arrays[level], np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(self.vectors) + 1), dtype=bool)  # the last column takes the padding
        seen[rows, starts] = True
        seen[:, _NONE] = True
        nodes = np.full((len(queries), breadth), _NONE, dtype=np.int32)
        near = np.full((len(queries), breadth), -np.inf, dtype=np.float64)
        width = min(breadth, starts.shape[1])
        nodes[:, :width] = starts[:, :width]
        near[:, :width] = np.where(nodes[:, :width] >= 0, np.einsum("qkd,qd->qk", self.vectors[nodes[:, :width]], queries), -np.inf)
        done = nodes < 0
        step = min(4, breadth)
        while True:
            open_near = np.where(done, -np.inf, near)
            pick = np.argpartition(-open_near, step - 1, axis=1)[:, :step]
            live = np.take_along_axis(open_near, pick, 1) > -np.inf
            active = live.any(axis=1)
            if not active.any():
                break
            who = np.flatnonzero(active)
            pick, live = pick[who], live[who]
            done[who[:, None], pick] = True
            opened = np.where(live, np.take_along_axis(nodes[who], pick, 1), _NONE)
            reached = np.where((opened >= 0)[:, :, None], array[opened], _NONE).reshape(len(who), -1)
            reached = np.where(seen[who[:, None], reached], _NONE, reached)
            reached.sort(axis=1)
            reached[:, 1:][reached[:, 1:] == reached[:, :-1]] = _NONE
            reached = -np.sort(-reached, axis=1)
            most = int((reached >= 0).sum(axis=1).max(initial=0))
            if not most:
                continue
            reached = reached[:, :most]
            seen[who[:, None], reached] = True
            fresh = np.einsum("qkd,qd->qk", self.vectors[reached], queries[who])
            fresh = np.where(reached >= 0, fresh, -np.inf)
            all_nodes, all_near = np.concatenate([nodes[who], reached], 1), np.concatenate([near[who], fresh], 1)
            all_done = np.concatenate([done[who], reached < 0], 1)
            keep = np.argpartition(-all_near, breadth - 1, axis=1)[:, :breadth]
            nodes[who], near[who] = np.take_along_axis(all_nodes, keep, 1), np.take_along_axis(all_near, keep, 1)
            done[who] = np.take_along_axis(all_done, keep, 1) | (nodes[who] < 0)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)

    def _insert(self, batch: np.ndarray, first: bool) -> None:
        own = self.vectors[batch]
        peers = own @ own.T
        found = None if first else np.full((len(batch), 1), self.entry, dtype=np.int32)
        for level in range(len(self.arrays) - 1, -1, -1):
            if found is not None:
                found, _ = self._beam(own, found, self.breadth if (self.levels[batch] >= level).any() else 4, level)
            added: dict[int, list[int]] = {}
            here = np.flatnonzero(self.levels[batch] >= level)
            for i in here:
                node = int(batch[i])
                close = here[np.argsort(-peers[i, here], kind="stable")][: self.links + 1]
                others = batch[close[close != i]]
                known = found[i][found[i] >= 0] if found is not None else np.empty(0, dtype=np.int32)
                known = known[self.levels[known] >= level]
                chosen = _diverse(np.unique(np.concatenate([known, others])).astype(np.int32), self.vectors, self.vectors[node], self.links)
                self.arrays[level][node, : len(chosen)] = chosen
                for other in chosen.tolist():
                    added.setdefault(other, []).append(node)
            for node, fresh in added.items():
                row = self.arrays[level][node]
                both = np.unique(np.concatenate([row[row >= 0], np.array(fresh, dtype=np.int32)]))
                kept = _diverse(both, self.vectors, self.vectors[node], len(row))
                row[:] = _NONE
                row[: len(kept)] = kept

    def to_bytes(self) -> tuple[list[bytes], int]:
        return [a.tobytes() for a in self.arrays], self.entry

    @classmethod
    def from_bytes(cls, vectors: np.ndarray, arrays: list[bytes], entry: int) -> Graph:
        graph = cls.__new__(cls)
        graph.vectors, graph.entry = vectors, int(entry)
        graph.arrays = [np.frombuffer(a, dtype=np.int32).reshape(len(vectors), -1) for a in arrays]
        return graph


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors of one length, whose products with a query extended by 0 are as before.

    In double precision: next to one long vector the products of all others lie close to 1.
    """
    vectors = vectors.astype(np.float64)
    squares = np.einsum("nd,nd->n", vectors, vectors, dtype=np.float64)
    top = float(squares.max(initial=0.0)) or 1.0
    last = np.sqrt(np.maximum(0.0, top - squares))
    scale = 1 / np.sqrt(top)
    return np.column_stack([vectors, last]) * scale


def usable_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Distinct (``vec_id``, ``vector`` of doubles) that have an id and take part."""
    vector = F.col(embedding).cast("array<double>")
    clean = F.transform("vector", lambda x: x + F.lit(0.0))  # one zero, not two
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("vector", lambda x: x != 0)
    narrow = rows.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector"))
    return narrow.where(F.col("vec_id").isNotNull() & finite & some).select("vec_id", clean.alias("vector")).distinct()


def _build(links: int, breadth: int):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["class_id", "class_hash"])
        vectors = np.stack(frame["vector"].to_numpy())
        graph = Graph(_lifted(vectors), links, breadth)
        arrays, entry = graph.to_bytes()
        return pd.DataFrame(
            {
                "dim": [vectors.shape[1]],
                "shard": [int(frame["shard"].iloc[0])],
                "ids": [frame["class_id"].to_numpy(np.int64).tobytes()],
                "hashes": [frame["class_hash"].to_numpy(np.int64).tobytes()],
                "vectors": [vectors.astype(np.float64).tobytes()],
                "arrays": [arrays],
                "entry": [entry],
            }
        )

    return build


def build_index(classes: DataFrame, shard_rows: int = 4096, links: int = 16, breadth: int = 96) -> DataFrame:
    """One row per shard of ``classes`` (``class_id``, ``class_hash``, ``vector``): vectors and neighbour arrays."""
    sizes = classes.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(shard_rows)))
    sized = classes.withColumn("dim", F.size("vector")).join(broadcast_within(staged(sizes, "sizes"), BROADCAST_SIZES), "dim")
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("class_id", "class_hash", F.lit(3)), shards))
    schema = "dim int, shard long, ids binary, hashes binary, vectors binary, arrays array<binary>, entry int"
    return dealt.groupBy("dim", "shard").applyInPandas(_build(links, breadth), schema)


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
    return pd.DataFrame(
        {
            "dim": [vectors.shape[1]],
            "block": [int(frame["block"].iloc[0])],
            "query_ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
            "queries": [vectors.tobytes()],
        }
    )


def _search(k: int, breadth: int):
    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                vectors = np.frombuffer(r.vectors, dtype=np.float64).reshape(-1, r.dim)
                queries = np.frombuffer(r.queries, dtype=np.float64).reshape(-1, r.dim)
                ids, hashes = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.hashes, dtype=np.int64)
                query_ids = np.frombuffer(r.query_ids, dtype=np.int64)
                graph = Graph.from_bytes(_lifted(vectors), list(r.arrays), r.entry)
                for at in range(0, len(queries), 512):
                    part = queries[at : at + 512]
                    lifted = np.column_stack([part, np.zeros(len(part))])
                    nodes, _ = graph.search(lifted, breadth)
                    nodes = nodes[:, : 2 * k]
                    scores = np.where(nodes >= 0, np.einsum("qkd,qd->qk", vectors[nodes], part), -np.inf)
                    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                    nodes, scores = np.take_along_axis(nodes, best, 1), np.take_along_axis(scores, best, 1)
                    q, j = np.nonzero(nodes >= 0)
                    yield pd.DataFrame(
                        {
                            "query_id": query_ids[at + q],
                            "class_id": ids[nodes[q, j]],
                            "class_hash": hashes[nodes[q, j]],
                            "score": scores[q, j],
                        }
                    )

    return scan


def nearest(
    rows: DataFrame,
    k: int = 20,
    every: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = 4096,
    breadth: int = 160,
    query_block: int = 2048,
) -> DataFrame:
    """(``query_id``, ``rank`` from 1, ``vec_id``, ``score``): the ``k`` nearest found of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of the
    query's own id, by the largest inner product in double precision, ties to the smaller id. Vectors
    that are null, zero, or hold null or non-finite components take no part, nor do rows without an
    id or vectors of another length than the query's. Rows equal in id and vector count once; equal
    vectors are one node of the graph, of which the ``k + 1`` least ids can be among the nearest. An
    empty table gives an empty result; other columns are ignored.
    """
    vectors = staged(usable_vectors(rows, vec_id, embedding), "vectors")
    least = Window.partitionBy("vector").orderBy("vec_id")
    members = staged(
        vectors.withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
        .select(F.col("members")[0].alias("class_id"), F.xxhash64("vector").alias("class_hash"), "vector", "members"),
        "vector-classes",
    )
    index = staged(build_index(members.drop("members"), shard_rows), "index")
    queries = vectors.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("vector"))
    total = queries.count()
    blocks = max(1, -(-total // query_block))
    packed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))).groupBy("dim", "block")
    packed = staged(packed.applyInPandas(_pack, "dim int, block long, query_ids binary, queries binary"), "query-blocks")
    pairs = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    met = pairs.join(packed, ["dim", "block"]).repartition("dim", "shard", "block")
    found = met.mapInPandas(_search(k + 1, breadth), "query_id long, class_id long, class_hash long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "class_id")
    classes = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    each = classes.join(members.drop("vector"), ["class_id", "class_hash"]).withColumn("vec_id", F.explode("members"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each.where("vec_id <> query_id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
