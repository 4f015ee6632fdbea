"""Exact dedup against immutable snapshots with static binary-fuse filters (operator 5).

A snapshot is written once: its distinct SHA-256 digests in buckets, and per bucket a 3-wise
binary-fuse filter with 16-bit fingerprints (about 18 bits a digest, no false negatives). A new
batch is grouped by digest on its own (duplicates inside the batch meet there), its distinct
digests are screened by the filter of their bucket, and only positives join the snapshot's exact
bucket. Rows of every group of two or more are then compared byte by byte with the text of the
row that stays; a digest whose texts differ is grouped again by the text itself.

Buckets hold about `bucket_keys` distinct digests whatever the input's size, and copies are
counted by partial aggregates, so a digest shared by a third of all rows is one key of one bucket.

Edge cases: a null text counts as empty; repeated rows (same id and text) are one group and each
is kept if its id is the largest; null ids count in group_size, never stay beside a real id, and
stay if the whole group has no id; an empty snapshot or batch is allowed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import stored

FILTER_DDL = "bucket long, n long, seed long, seg long, count long, cells binary"


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _cells(h: np.ndarray, seg: int, count: int) -> np.ndarray:
    """The three cells of each key: one in each of three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(count * seg)) >> np.uint64(32)
    at = np.uint64(seg - 1)
    second = (first + np.uint64(seg)) ^ ((h >> np.uint64(16)) & at)
    third = (first + np.uint64(2 * seg)) ^ (h & at)
    return np.stack([first, second, third]).astype(np.int64)


def _print16(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(37))) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(48)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, segment count, cells) of a binary-fuse filter over int64 keys."""
    keys = np.unique(np.asarray(keys, np.int64))
    n = max(2, len(keys))
    seg = min(1 << 18, 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25)))
    grow = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    count = max(1, -(-int(n * grow) // seg) - 2)
    for seed in range(1, 200):
        h = _mix(keys, seed)
        cells = _cells(h, seg, count)
        size = (count + 2) * seg
        degree = np.bincount(cells.ravel(), minlength=size)
        who = np.zeros(size, np.int64)
        ids = np.arange(len(keys), dtype=np.int64)
        for row in cells:
            np.bitwise_xor.at(who, row, ids)
        order, left = [], len(keys)
        free = np.flatnonzero(degree == 1)
        while len(free):
            key, pick = np.unique(who[free], return_index=True)
            slot = free[pick]
            order.append((key, slot))
            left -= len(key)
            for row in cells[:, key]:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(who, row, key)
            touched = np.unique(cells[:, key])
            free = touched[degree[touched] == 1]
        if left == 0:
            out = np.zeros(size, np.uint16)
            prints = _print16(h)
            for key, slot in reversed(order):
                c = cells[:, key]
                out[slot] = 0
                out[slot] = prints[key] ^ out[c[0]] ^ out[c[1]] ^ out[c[2]]
            return seed, seg, count, out
        if seed % 20 == 0:
            count += max(1, count // 8)
    raise ValueError("no filter found for these keys")


def probe(keys: np.ndarray, seed: int, seg: int, count: int, cells: np.ndarray) -> np.ndarray:
    h = _mix(np.asarray(keys, np.int64), seed)
    c = _cells(h, seg, count)
    return (cells[c[0]] ^ cells[c[1]] ^ cells[c[2]]) == _print16(h)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, seg, count, cells = build_filter(pdf["key"].to_numpy())
    return pd.DataFrame([(int(pdf["bucket"].iloc[0]), len(pdf), seed, seg, count, cells.tobytes())],
                        columns=["bucket", "n", "seed", "seg", "count", "cells"])


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(batch) or not len(filters):
        return batch[["bucket", "sha"]].iloc[:0]
    f = filters.iloc[0]
    hit = probe(batch["key"].to_numpy(), int(f["seed"]), int(f["seg"]), int(f["count"]),
                np.frombuffer(f["cells"], np.uint16))
    return batch.loc[hit, ["bucket", "sha"]]


def digest_groups(rows: DataFrame, buckets: int) -> DataFrame:
    """Distinct digests of (id, sha): bucket, filter key, largest id, copies."""
    g = rows.groupBy("sha").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("copies"))
    return g.select(F.pmod(F.xxhash64(F.lit(11), "sha"), F.lit(buckets)).alias("bucket"), F.xxhash64("sha").alias("key"),
                    "sha", "top", "copies")


def exact_dedup(snapshot: DataFrame, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_keys: int = 16_384, digest_chars: int = 64) -> DataFrame:
    """One row per row of either input: id, keep_id, group_size, kept, text_sha256.

    `digest_chars` shortens the digest that groups rows; the byte check makes any length exact.
    """
    def rows(df: DataFrame, side: int) -> DataFrame:
        text = F.coalesce(F.col(text_col), F.lit(""))
        full = F.sha2(text, 256)
        return df.select(F.col(id_col).alias("id"), F.lit(side).alias("side"), full.alias("text_sha256"),
                         F.substring(full, 1, digest_chars).alias("sha"))

    all_rows = stored(rows(snapshot, 0).union(rows(batch, 1)), "digests")
    buckets = max(1, -(-all_rows.count() // bucket_keys))
    old = stored(digest_groups(all_rows.where("side = 0"), buckets), "snapshot")
    filters = stored(old.select("bucket", "key").groupBy("bucket").applyInPandas(_build, FILTER_DDL), "filters")
    new = stored(digest_groups(all_rows.where("side = 1"), buckets), "batch")
    hits = (new.select("bucket", "key", "sha").groupBy("bucket").cogroup(filters.groupBy("bucket"))
            .applyInPandas(_screen, "bucket long, sha string"))
    seen = old.join(hits, ["bucket", "sha"], "left_semi").select("bucket", "sha", "top", "copies")   # exact bucket
    apart = old.select("bucket", "sha", "top", "copies").join(seen.select("sha"), "sha", "left_anti").select("bucket", "sha", "top", "copies")
    classes = stored(apart.union(new.select("bucket", "sha", "top", "copies").join(
        seen.select("sha", F.col("top").alias("t"), F.col("copies").alias("c")), "sha", "left")
        .select("bucket", "sha", F.greatest("top", "t").alias("top"), (F.col("copies") + F.coalesce("c", F.lit(0))).alias("copies"))),
        "classes")

    # byte check: every row of a group of two or more against the text of the row that stays
    def texts(df: DataFrame) -> DataFrame:
        t = F.coalesce(F.col(text_col), F.lit(""))
        return df.select(F.col(id_col).alias("id"), t.alias("text"), F.substring(F.sha2(t, 256), 1, digest_chars).alias("sha"))

    groups = classes.where("copies > 1").select("sha", "top")
    members = texts(snapshot).union(texts(batch)).join(groups, "sha")
    stays = members.where(F.col("id").eqNullSafe(F.col("top"))).groupBy("sha").agg(F.max("text").alias("stay"))
    broken = stored(members.join(stays, "sha").where(F.col("text") != F.col("stay")).select("sha").distinct(), "broken")
    good, redo = all_rows, None
    if not broken.isEmpty():
        good = all_rows.join(broken, "sha", "left_anti")
        pieces = texts(snapshot).union(texts(batch)).join(broken, "sha", "left_semi")
        per_text = pieces.groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        redo = pieces.join(per_text, "text").select("id", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))
    out = good.join(classes, "sha").select("id", F.col("top").alias("keep_id"), F.col("copies").alias("group_size"), "text_sha256")
    if redo is not None:
        out = out.union(redo)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")
