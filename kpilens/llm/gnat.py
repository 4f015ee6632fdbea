"""GNAT: a multiway hyperplane tree over integer vectors for exact searches by inner product (operator 11's index).

Inner products become distances by one more coordinate: with M the largest norm, a row x is the point
(x, sqrt(M^2 - |x|^2)) and a query a is (a, 0), so d^2 = |a|^2 + M^2 - 2 <a, x>. A window of scores is thus
an annulus around the query.

* Split points are fitted on a bounded sample (`SAMPLE` rows of the smallest hash, 64 MB at most): at each
  node up to `DEGREE` points, each farthest from those before; a row goes to its nearest (the hyperplane cells).
* Every row is indexed. In the same pass each task keeps, for split point i and sibling subtree j, the range of
  the distances from i to the rows under j; Spark joins the ranges (at most DEGREE^2 numbers a node).
* A query leaves out sibling j if for some i the range does not meet what the triangle inequality allows:
  [max(d_i - r2, r1 - d_i), d_i + r2] for an annulus [r1, r2].
* Leaves are exact: blocks of at most about `BLOCK` rows (a leaf of many equal vectors is many blocks); a task holds one block
  and streams the queries past it. Scores are whole numbers, computed in doubles only while they are exact there.
* A search first visits the query's own leaf; its k-th best score narrows the annulus, then all leaves not ruled
  out are visited.

Edge cases: an empty table is an index without leaves; vectors shorter than the longest are filled with zeros;
scores that could exceed 2^63 raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import stored

SAMPLE, SAMPLE_BYTES = 8192, 64 << 20
DEGREE = 16
LEAF_ROWS, BLOCK = 1024, 4096
QUERIES = 256                      # queries scored at once
POINT = "leaf int, block int, kind int, id long, label long, q array<bigint>, lo array<bigint>, hi array<bigint>"


@dataclass
class Node:
    points: np.ndarray                                   # (m, dim + 1)
    children: list[int]                                  # a node, or ~leaf
    low: np.ndarray = None                               # (m, m): least distance from point i to rows under child j
    high: np.ndarray = None


@dataclass
class Tree:
    dim: int
    m2: int                                              # largest squared norm
    exact: bool                                          # doubles hold every score exactly
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 1
    blocks: dict[int, int] = field(default_factory=dict)  # of each leaf that has rows

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + self.m2) ** 0.5

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x.astype(np.float64)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.m2 - (x * x).sum(1)))
        return np.column_stack([x, last])

    def route(self, x: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of each lifted point; `seen(node, cell, distances)` gets what each node saw."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            d = distances(x[rows], node.points)
            cell = d.argmin(1)
            if seen:
                seen(at, cell, d)
            for j, child in enumerate(node.children):
                if len(sub := rows[cell == j]):
                    if child < 0:
                        leaf[sub] = ~child
                    else:
                        todo.append((child, sub))
        return leaf

    def reached(self, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """(query, leaf) pairs that range intersection leaves for scores in [lo, hi]."""
        base = (q.astype(np.float64) ** 2).sum(1) + self.m2
        r1, r2 = np.sqrt(np.maximum(0, base - 2.0 * hi)), np.sqrt(np.maximum(0, base - 2.0 * lo))
        x, out = self.lifted(q, query=True), []
        live = np.flatnonzero(lo <= hi)
        todo = [(0, live)] if self.nodes else []
        if not self.nodes:
            out.append(np.column_stack([live, np.zeros_like(live)]))
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            d = distances(x[rows], node.points)
            near = np.maximum(d - r2[rows, None], r1[rows, None] - d) - self.slack
            far = d + r2[rows, None] + self.slack
            for j, child in enumerate(node.children):
                sub = rows[((node.low[:, j] <= far) & (node.high[:, j] >= near)).all(1)]
                if len(sub) and child < 0:
                    out.append(np.column_stack([sub, np.full(len(sub), ~child)]))
                elif len(sub):
                    todo.append((child, sub))
        return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d2, 0))


def _split_points(x: np.ndarray, m: int) -> np.ndarray:
    """Rows of x: the first, then each the farthest from those chosen; fewer if points coincide."""
    chosen, gap = [0], distances(x, x[:1])[:, 0]
    while len(chosen) < m and gap.max() > 1e-6 * (1 + np.abs(x).max()):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def _grow(tree: Tree, x: np.ndarray, leaves: int) -> None:
    tree.leaves, todo = 0, [(x, leaves, None, 0)]
    while todo:
        x, want, parent, place = todo.pop(0)
        points = _split_points(x[:3 * DEGREE], min(DEGREE, want)) if want > 1 and len(x) > 1 else x[:1]
        if len(points) < 2:
            name, tree.leaves = ~tree.leaves, tree.leaves + 1
        else:
            m = len(points)
            node = Node(points, [0] * m, np.full((m, m), np.inf), np.full((m, m), -np.inf))
            name = len(tree.nodes)
            tree.nodes.append(node)
            cell = distances(x, points).argmin(1)
            for j in range(m):
                part = x[cell == j]
                todo.append((part, round(want * len(part) / len(x)), name, j))
        if parent is not None:
            tree.nodes[parent].children[place] = name


def _vectors(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


@dataclass
class Gnat:
    """A tree and the table of its leaves' rows."""

    tree: Tree
    rows: DataFrame                                      # POINT, kind 0

    def search(self, queries: DataFrame, k: int, same: bool, windows: int) -> DataFrame:
        """(query, id, score): for each query and each of its score windows the k best rows, largest score first, then
        smallest id; of the query's label if `same` (without the row itself), else of other labels.

        `queries`: id, label, q and the windows as arrays lo, hi of the length `windows` (an empty one has lo > hi).
        A row may be there for one window only; `ranked` picks each window's own."""
        q = stored(self._home(queries), "queries")
        found = stored(self._visit(q, k, same, windows), "home")
        best = ranked(found, q, k).groupBy("query").agg(F.map_from_entries(F.collect_list(
            F.when(F.col("rank") == k, F.struct("window", "score")))).alias("kth"))
        narrowed = q.join(best.withColumnRenamed("query", "id"), "id", "left").withColumn(
            "lo", F.transform("lo", lambda x, i: F.greatest(x, F.element_at(F.col("kth"), i))))
        rest = self._visit(self._others(narrowed.drop("kth")), k, same, windows)
        return found.unionByName(rest)

    def _home(self, queries: DataFrame) -> DataFrame:
        """Queries in every block of their own leaf."""
        tree = self.tree

        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = _vectors(b["q"], tree.dim)
                    leaf = tree.route(tree.lifted(x, query=True))
                    yield _copies(b, np.column_stack([np.arange(len(leaf)), leaf]), tree, True)
        return queries.select("id", "label", "q", "lo", "hi").mapInArrow(run, POINT + ", home int")

    def _others(self, queries: DataFrame) -> DataFrame:
        """Queries (each from one of its home rows) in the blocks of all other leaves that are not ruled out."""
        tree = self.tree

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                x, w = _vectors(b["q"], tree.dim), len(b["lo"][0])
                lo, hi = _vectors(b["lo"], w), _vectors(b["hi"], w)
                some = lo <= hi
                low = np.where(some, lo, np.iinfo(np.int64).max).min(1)
                high = np.where(some, hi, np.iinfo(np.int64).min).max(1)
                for s in range(0, len(x), 4 * QUERIES):
                    part = slice(s, s + 4 * QUERIES)
                    pairs = tree.reached(x[part], low[part], high[part])
                    pairs = pairs[np.asarray(b["home"])[s + pairs[:, 0]] != pairs[:, 1]]
                    for t in range(0, len(pairs), 4096):
                        yield _copies(b.slice(s), pairs[t:t + 4096], tree, False)
        one = queries.where("block = 0").drop("leaf", "block", "kind")
        return one.mapInArrow(run, POINT + ", home int")

    def _visit(self, queries: DataFrame, k: int, same: bool, windows: int) -> DataFrame:
        """Candidates (query, id, score): the k best of each block for each window."""
        tree = self.tree

        def run(batches):
            block, held, x = None, [], None
            for b in batches:
                leaf, part, kind = (np.asarray(b[c]) for c in ("leaf", "block", "kind"))
                cuts = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
                for s, e in zip([0, *cuts], [*cuts, b.num_rows]):
                    if s == e:
                        continue
                    if block != (leaf[s], part[s]):
                        block, held, x = (leaf[s], part[s]), [], None
                    rows = b.slice(s, e - s)
                    if kind[s] == 0:
                        held.append(rows)
                        continue
                    if x is None:
                        x = (_scored(np.concatenate([_vectors(r["q"], tree.dim) for r in held]), tree),
                             *(np.concatenate([np.asarray(r[c]) for r in held]) for c in ("id", "label"))) if held else None
                    for t in range(0, e - s if x else 0, QUERIES):
                        out = _best(rows.slice(t, QUERIES), *x, tree, k, same, windows)
                        if out.num_rows:
                            yield out
        both = self.rows.unionByName(queries.select(*self.rows.columns))
        return (both.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "kind")
                .mapInArrow(run, "query bigint, id bigint, score bigint"))


def _scored(x: np.ndarray, tree: Tree) -> np.ndarray:
    return x.astype(np.float64) if tree.exact else x.astype(np.int64)


def _best(queries, x, ids, labels, tree: Tree, k: int, same: bool, windows: int):
    q = _scored(_vectors(queries["q"], tree.dim), tree)
    lo, hi = _vectors(queries["lo"], windows), _vectors(queries["hi"], windows)
    qid, qlabel = np.asarray(queries["id"]), np.asarray(queries["label"])
    score = (q @ x.T).astype(np.int64)
    ok = labels[None, :] == qlabel[:, None]
    ok = ok & (ids[None, :] != qid[:, None]) if same else ~ok
    low = np.where(lo <= hi, lo, np.iinfo(np.int64).max).min(1)
    ok &= (score >= low[:, None]) & (score <= hi.max(1)[:, None])
    a, r = np.nonzero(ok)
    s = score[a, r]
    order = np.lexsort((ids[r], -s, a))
    a, r, s = a[order], r[order], s[order]
    take = np.zeros(len(a), bool)
    for w in range(windows):
        at = np.flatnonzero((s >= lo[a, w]) & (s <= hi[a, w]))
        own = a[at]
        first = np.searchsorted(own, own)                               # where this query's rows begin
        take[at[np.arange(len(at)) - first < k]] = True
    a, r, s = a[take], r[take], s[take]
    return pa.RecordBatch.from_arrays([pa.array(qid[a], pa.int64()), pa.array(ids[r], pa.int64()), pa.array(s, pa.int64())],
                                      names=["query", "id", "score"])


def _copies(b, pairs: np.ndarray, tree: Tree, home: bool):
    """Rows pairs[:, 0] of a batch of queries, one for each block of the leaf pairs[:, 1]."""
    n = np.array([tree.blocks.get(int(x), 1 if home else 0) for x in pairs[:, 1]], np.int64)
    row, leaf = np.repeat(pairs[:, 0], n), np.repeat(pairs[:, 1], n)
    block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    t = b.take(pa.array(row, pa.int64()))
    own = leaf if home else np.asarray(t["home"])
    return pa.RecordBatch.from_arrays(
        [pa.array(leaf, pa.int32()), pa.array(block, pa.int32()), pa.array(np.ones(len(row)), pa.int32()), t["id"], t["label"],
         t["q"], t["lo"], t["hi"], pa.array(own, pa.int32())], names=["leaf", "block", "kind", "id", "label", "q", "lo", "hi", "home"])


def ranked(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, window, rank, id, score): the k best of each window among candidates; `queries` has id, lo, hi."""
    spans = queries.select(F.col("id").alias("query"), F.arrays_zip("lo", "hi").alias("spans")).dropDuplicates(["query"])
    d = found.join(spans, "query").select("query", "id", "score", F.posexplode("spans").alias("window", "span"))
    d = d.where((F.col("score") >= F.col("span.lo")) & (F.col("score") <= F.col("span.hi"))).drop("span")
    d = d.withColumn("rank", F.expr("row_number() over (partition by query, window order by score desc, id)"))
    return d.where(F.col("rank") <= k)


def build(rows: DataFrame, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, block: int = BLOCK) -> Gnat | None:
    """Index of rows (id long, label long, q array<long>), one row an id; None for an empty table."""
    norm = F.aggregate("q", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dim"), F.max(norm).alias("m2"),
                     F.max(F.array_max(F.transform("q", F.abs))).alias("top")).first()
    if not stats["n"]:
        return None
    dim = max(1, stats["dim"])
    bound = dim * (stats["top"] or 0) ** 2
    if bound >= 1 << 63:
        raise ValueError(f"scores up to {bound} do not fit 64 bits")
    tree = Tree(dim, int(stats["m2"] or 0) + 1, bound < 1 << 53)
    rows = rows.select("id", F.col("label").cast("long").alias("label"),
                       F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("q"))).alias("q"))
    bounded = min(sample, max(64, SAMPLE_BYTES // (8 * dim)))
    got = rows.orderBy(F.xxhash64("id"), "id").limit(bounded).select("q").toArrow()
    x = tree.lifted(np.asarray(got["q"].combine_chunks().flatten()).reshape(-1, dim))
    _grow(tree, x, int(min(-(-stats["n"] // leaf_rows), max(1, len(x) // 8))))

    def run(batches):
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def see(at, cell, d):
            low, high = seen.setdefault(at, (tree.nodes[at].low.copy(), tree.nodes[at].high.copy()))
            for j in np.unique(cell):
                part = d[cell == j]
                low[:, j], high[:, j] = np.minimum(low[:, j], part.min(0)), np.maximum(high[:, j], part.max(0))

        for b in batches:
            if b.num_rows:
                leaf = tree.route(tree.lifted(_vectors(b["q"], dim)), see)
                none = pa.nulls(b.num_rows, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), b["id"], b["label"], b["q"], none, none],
                                                 names=["leaf", "id", "label", "q", "low", "high"])
        n = len(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([~at for at in seen], pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
             pa.array([v[0].ravel().tolist() for v in seen.values()], pa.list_(pa.float64())),
             pa.array([v[1].ravel().tolist() for v in seen.values()], pa.list_(pa.float64()))], names=["leaf", "id", "label", "q", "low", "high"])

    routed = stored(rows.mapInArrow(run, "leaf int, id bigint, label bigint, q array<bigint>, low array<double>, high array<double>"), "gnat")
    spans = (routed.where("leaf < 0").select("leaf", F.posexplode(F.arrays_zip("low", "high")).alias("cell", "v"))
             .groupBy("leaf", "cell").agg(F.min("v.low").alias("low"), F.max("v.high").alias("high")).collect())   # DEGREE^2 a node
    for r in spans:
        node = tree.nodes[~r["leaf"]]
        node.low.flat[r["cell"]], node.high.flat[r["cell"]] = r["low"], r["high"]
    kept = routed.where("leaf >= 0")
    tree.blocks = {r["leaf"]: -(-r["count"] // block) for r in kept.groupBy("leaf").count().collect()}             # one row a leaf
    parts = F.element_at(F.split(F.lit(",".join(str(tree.blocks.get(i, 1)) for i in range(tree.leaves))), ",").cast("array<int>"), F.col("leaf") + 1)
    none = F.lit(None).cast("array<bigint>")
    return Gnat(tree, kept.select("leaf", F.pmod(F.xxhash64("id"), parts).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "label", "q",
                                  none.alias("lo"), none.alias("hi")))
