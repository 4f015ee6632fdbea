"""Near-duplicate documents by min-max hashing (operator 9).

A document's set is its distinct 5-word shingles (a-z lower-cased, words between ASCII white
space; fewer words: the whole sequence as one shingle; no words: the empty set, linked with
nothing). Under each of 60 hash permutations both the minimum and the maximum are kept, so 60
evaluations give 120 signature values, which form 24 bands of 5 (12 of minima, 12 of maxima).
A pair at the threshold 0.85 misses all bands with probability (1 - 0.85^5)^24 = 8e-7.

Documents with equal sets form one class (one aggregate, no pairs). Classes that share a band
are compared on full shingle sets. No bucket emits all its pairs: the member with the most
band collisions is the centre and is compared with the others; links are contracted to
components; only members of different components that still share a band go on. After two
rounds of centres the rest is compared pairwise inside the join condition, where a 512-bit
parity sketch of the sets gives a proven lower bound of their difference: only pairs the bound
cannot rule out leave the join and are compared in full. So a bucket of thousands of near
copies costs about one comparison each, and no candidate is dropped.

Edge cases: null, empty and white-space texts have n_shingles 0 and stay; repeated rows and
equal texts are one class; rows with a null doc_id take part and are kept only if nothing else
is in their component; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import stored
from kpilens.llm.components import components

SHINGLE = 5
PERMUTATIONS = 60
ROWS = 5
STAR_ROUNDS = 2
SKETCH = 8                          # longs of the parity sketch: 512 bits
WORD_CACHE = 400_000
_rng = np.random.default_rng(20240607)
MUL = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ROW_MUL = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHash(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > WORD_CACHE:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


_words = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, ws), np.uint64, len(ws))
    n = max(1, len(ws) - SHINGLE + 1)
    s = np.full(n, min(len(ws), SHINGLE), np.uint64)
    for i in range(min(SHINGLE, len(ws))):
        s += h[i:i + n] * PLACE[i]
    return np.unique(_mix(s))


def min_max(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the set under each permutation, in pieces of bounded memory."""
    lo = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    hi = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(s), 4096):
        v = MUL[:, None] * s[None, i:i + 4096] + ADD[:, None]
        np.minimum(lo, v.min(axis=1), out=lo)
        np.maximum(hi, v.max(axis=1), out=hi)
    return lo, hi


def bands(s: np.ndarray) -> np.ndarray:
    lo, hi = min_max(s)
    sig = np.concatenate([lo, hi]).reshape(-1, ROWS)
    code = _mix((sig * ROW_MUL[None, :]).sum(axis=1, dtype=np.uint64) + np.arange(len(sig), dtype=np.uint64))
    return code.view(np.int64)


def parity(s: np.ndarray) -> np.ndarray:
    """Bit b is the parity of the number of items that hash to b. The XOR of two sketches is the
    sketch of the symmetric difference, so its bit count never exceeds the difference's size."""
    bits = (np.bincount((s >> np.uint64(20)).astype(np.int64) & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _signatures(batches):
    for b in batches:
        n, node, band, sketch = [], [], [], []
        for t in b.column("text"):
            s = shingle_set(t.as_py())
            n.append(len(s))
            node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            band.append(bands(s) if len(s) else None)
            sketch.append(parity(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
             pa.array(band, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
            ["id", "n", "node", "bands", "sketch"])


def _sets(batches):
    for b in batches:
        sets = [shingle_set(t.as_py()) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "items"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("items").alias("sb")), "b")
            .select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("n"))
            .where(100 * F.col("c") >= percent * (F.col("n") - F.col("c"))).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sig = stored(base.mapInArrow(_signatures, _ddl(base, "n long, node binary, bands array<long>, sketch array<long>")), "minmax")
    classes = stored(sig.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("id").alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "classes")
    flat = classes.select("node", "n", F.explode("bands").alias("band"))
    crowd = flat.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stored(flat.join(crowd, "band"), "buckets")
    degree = shared.groupBy("node").agg(F.sum("members").alias("degree"))
    open_rows = shared.join(degree, "node").select("band", "node", "n", "degree")
    chosen = classes.join(degree, "node", "left_semi").select(F.col("low").alias("id")).distinct()
    near = base.join(chosen, base["id"].eqNullSafe(chosen["id"]), "left_semi")
    sets = stored(near.mapInArrow(_sets, "node binary, items array<long>").dropDuplicates(["node"]), "sets")

    roots, links, done, k = None, None, None, 0
    while True:
        open_rows = stored(open_rows, "open")
        if open_rows.isEmpty():
            break
        if k < STAR_ROUNDS:
            centre = open_rows.groupBy("band").agg(F.max(F.struct("degree", "node", "n", *(["root"] if roots is not None else []))).alias("c"))
            side = open_rows.join(centre, "band")
            differ = F.col("node") != F.col("c.node")
            if roots is not None:
                differ = differ & (F.col("root") != F.col("c.root"))
            raw = side.where(differ).select("node", "n", F.col("c.node").alias("other"), F.col("c.n").alias("m"))
        else:                       # what is left after the star rounds: pairs across components the sketch allows
            sk = classes.select("node", *[F.col("sketch")[i].alias(f"p{i}") for i in range(SKETCH)])
            mine = stored(open_rows.join(sk, "node").drop("degree"), "rest")
            other = mine.select("band", *[F.col(c).alias(f"o_{c}") for c in mine.columns if c != "band"])
            apart = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"o_p{i}"))) for i in range(SKETCH)), F.lit(0))
            may_link = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("o_n"))
            raw = (mine.join(other, "band")
                   .where((F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")) & may_link
                          & (100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n")))
                   .select("node", "n", F.col("o_node").alias("other"), F.col("o_n").alias("m")))
        pairs = (raw.where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
                 .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(_verified(pairs, sets, percent), "links")
        done = pairs if done is None else done.union(pairs)
        links = found if links is None else links.union(found)
        if roots is None or not found.isEmpty():
            roots = stored(components(links), "roots")
        if k >= STAR_ROUNDS:
            break
        # a centre has met all its bucket and leaves it; buckets of one component are done
        left = open_rows.join(centre.select("band", F.col("c.node").alias("gone")), "band").where("node != gone").drop("gone", "root")
        left = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = left.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("band")
        open_rows = left.join(mixed, "band").select("band", "node", "n", "degree", "root")
        k += 1

    named = classes.select("node", "low")
    if roots is not None:
        named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("low").alias("component_id"))
        named = named.join(least, "root").select("node", "component_id")
    else:
        named = named.select("node", F.col("low").alias("component_id"))
    out = sig.select("id", "n", "node").join(named, "node", "left")
    comp = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.col("id").eqNullSafe(comp).alias("kept"))


def _ddl(base: DataFrame, rest: str) -> str:
    return f"id {base.schema['id'].dataType.simpleString()}, {rest}"


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row of `docs` for each near-duplicate component, with its own columns: the smallest id (null last), then
    the smallest digest of its text, then of equal rows one. Rows without words all stay."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.md5(F.col(text_col)).alias("digest"))
    keyed = docs.select(key.alias("__key"), F.col(text_col).alias("__text"))
    verdict = stored(near_duplicates(keyed, "__key", "__text", percent).where("kept").groupBy("__key")
                     .agg(F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")), "verdict")
    d = docs.withColumn("__key", key)
    alone = d.join(verdict.where("n = 0 OR copies = 1"), "__key", "left_semi").select(*names)
    copied = d.join(verdict.where("n > 0 AND copies > 1"), "__key", "left_semi")
    one = copied.groupBy("__key").agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("__row")).select("__row.*")
    return alone.union(one)
