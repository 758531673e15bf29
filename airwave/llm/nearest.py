"""Nearest neighbours by cosine, with vantage-point trees per shard.

Vectors are dealt to shards by a hash of their id. Each shard builds a vantage-point tree over its
distinct vectors (copies keep the smallest ids that any query could need): a node is a vector, and
the others are halved by their chord distance to it. All queries run down all shards' trees, in
blocks; a branch is left out if the triangle inequality puts it beyond the k-th best found so far.
``factor`` relaxes that: the bound is multiplied by it, so 1 is exact and more prunes more, at the
cost of recall. Scores are computed anew in double precision from the original vectors.

Chord distance (of vectors of length one) orders like cosine and is a metric, which angle-like
scores are not.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, as
query or candidate; neither do null ids and vectors whose size isn't the most frequent one; rows
repeated with one id are candidates once each; with fewer candidates than k all are returned; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4_096
QUERY_BLOCK = 1_024
LEAF = 64
#: Room for rounding when distances are compared.
EPSILON = 1e-7


class Tree:
    """A vantage-point tree over unit vectors; nodes in arrays, leaves as ranges of ``order``."""

    def __init__(self, unit: np.ndarray, seed: int = 1):
        self.unit, self.order = unit, np.arange(len(unit))
        self.nodes: list[tuple] = []  # (vantage, inner low, inner high, outer low, outer high, inner, outer)
        self.rng = np.random.RandomState(seed)
        self.root = self._build(0, len(unit)) if len(unit) else None

    def _build(self, a: int, b: int) -> tuple:
        """('leaf', a, b) or ('node', index)."""
        if b - a <= LEAF:
            return ("leaf", a, b)
        pick = a + self.rng.randint(b - a)
        self.order[[a, pick]] = self.order[[pick, a]]
        vantage, rest = self.order[a], self.order[a + 1 : b]
        d = chord(self.unit[rest] @ self.unit[vantage])
        by = np.argsort(d, kind="stable")  # halved by rank, so equal distances can't make it lopsided
        self.order[a + 1 : b], d = rest[by], d[by]
        half = len(d) // 2
        inner, outer = self._build(a + 1, a + 1 + half), self._build(a + 1 + half, b)
        self.nodes.append((vantage, d[0], d[half - 1], d[half], d[-1], inner, outer))
        return ("node", len(self.nodes) - 1)

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> list[set[int]]:
        """For each query the rows that may be among its k nearest (all of them, if factor is 1)."""
        self.bound = np.full((len(queries), k), np.inf)  # the k smallest distances so far, sorted
        self.met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.k, self.factor, self.queries = k, factor, queries
        if self.root is not None:
            self._down(self.root, np.arange(len(queries)))
        near: list[set[int]] = [set() for _ in queries]
        for q, row, d in self.met:
            good = d <= self.bound[q, -1] + EPSILON
            for i, r in zip(q[good].tolist(), row[good].tolist(), strict=True):
                near[i].add(r)
        return near

    def _see(self, active: np.ndarray, rows: np.ndarray) -> np.ndarray:
        d = chord(self.queries[active] @ self.unit[rows].T)
        both = np.concatenate([self.bound[active], d], 1)
        both.partition(self.k - 1, axis=1)
        self.bound[active] = np.sort(both[:, : self.k], axis=1)
        q, r = np.nonzero(d <= self.bound[active, -1:] + EPSILON)
        self.met.append((active[q], rows[r], d[q, r]))
        return d

    def _down(self, at: tuple, active: np.ndarray) -> None:
        if not len(active):
            return
        if at[0] == "leaf":
            self._see(active, self.order[at[1] : at[2]])
            return
        vantage, low1, high1, low2, high2, inner, outer = self.nodes[at[1]]
        d = self._see(active, np.array([vantage]))[:, 0]
        # how far at least the vectors of each half are, by the triangle inequality
        to_inner = np.maximum(np.maximum(d - high1, low1 - d), 0)
        to_outer = np.maximum(np.maximum(d - high2, low2 - d), 0)
        first_inner = to_inner <= to_outer
        for branch, gap, turn in ((inner, to_inner, first_inner), (outer, to_outer, ~first_inner), (outer, to_outer, first_inner), (inner, to_inner, ~first_inner)):
            now = active[turn]
            self._down(branch, now[self.factor * gap[turn] <= self.bound[now, -1] + EPSILON])


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision, summed in the order of the components."""
    dot = np.cumsum(q * x, axis=1)[:, -1]
    return np.clip(dot / np.sqrt(np.cumsum(q * q, axis=1)[:, -1] * np.cumsum(x * x, axis=1)[:, -1]), -1, 1)


def usable(vectors: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    zero = F.forall(v, lambda x: x == 0)
    rows = vectors.select(F.col("vec_id").cast("long"), v.cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") == dimensions) & fine & ~zero)


def _distinct(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct rows of ``x`` and for each its smallest k + 1 ids."""
    unique, back = np.unique(x, axis=0, return_inverse=True)
    order = np.lexsort((ids, back.ravel()))
    cuts = np.searchsorted(back.ravel()[order], np.arange(1, len(unique)))
    return unique, [own[: k + 1] for own in np.split(ids[order], cuts)]


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors of each query, itself excluded.

    Both have vec_id and embedding. Each query goes once to each shard, a stated query set against
    all vectors; what comes back is k rows of each.
    """
    sizes = vectors.where("embedding is not null and size(embedding) > 0").groupBy(F.size("embedding").alias("size"))
    most = sizes.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    dimensions = most["size"] if most else 1
    vectors, queries = usable(vectors, dimensions), usable(queries, dimensions).dropDuplicates(["vec_id"])
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def search(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if asked.empty or own.empty:
            return empty
        x, copies = _distinct(own["vec_id"].to_numpy(), np.stack(own["embedding"].to_numpy()), k)
        tree = Tree(x / np.linalg.norm(x, axis=1, keepdims=True))
        parts = [empty]
        for at in range(0, len(asked), QUERY_BLOCK):
            block = asked.iloc[at : at + QUERY_BLOCK]
            ids, q = block["vec_id"].to_numpy(), np.stack(block["embedding"].to_numpy())
            # the query itself may be one of its k + 1 nearest
            near = tree.search(q / np.linalg.norm(q, axis=1, keepdims=True), k + 1, factor)
            row = np.array([r for own in near for r in sorted(own)], np.int64)
            which = np.repeat(np.arange(len(block)), [len(own) for own in near])
            score = cosines(q[which], x[row])
            many = np.array([len(copies[r]) for r in row])
            found = pd.DataFrame(
                {"query_id": np.repeat(ids[which], many), "vec_id": np.concatenate([copies[r] for r in row]), "score": np.repeat(score, many)}
            )
            found = found[found["query_id"] != found["vec_id"]]
            found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            parts.append(found.groupby("query_id").head(k))
        return pd.concat(parts, ignore_index=True)

    found = asked.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
