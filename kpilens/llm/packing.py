"""Best-fit packing of documents into sequences under conflicts (operator 3).

Documents are dealt by hash into packing groups of about `group_tokens` tokens, so no group grows
with the input and no source or cluster of copies is one group. In a group, items go in order of
falling length. Open bins are kept by residual capacity; a bin carries a bitmap of its sources and
one of its duplicate clusters. A successor search starts at the smallest residual that holds the
item and goes on until the tightest bin without a conflict is found; if there is none, a new bin
opens. A document longer than a sequence fills whole sequences and its tail is an item like any.

Two pieces of one duplicate cluster never share a bin. Two documents of one source share none
either if `distinct_sources` (the default); switch it off where one source dominates a corpus.

Edge cases: a document without words is one row with n_tokens 0 and a null bin; a null source or
cluster conflicts with nothing; repeated rows are items of their own (and one cluster, if they
have one); ties go by id, then cluster.
"""

from __future__ import annotations

from bisect import insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import stored

OUT = "piece long, start long, n_tokens long, pack_group long, bin long, bin_offset long"


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per item (length, source bitmap, cluster bitmap), placed in the given order."""
    by_residual: dict[int, list[int]] = {}
    nonempty = 0
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for length, src, clu in items:
        spot = None
        rest = nonempty >> length
        while rest:
            step = rest & -rest
            residual = length + step.bit_length() - 1
            spot = next((b for b in by_residual[residual] if not (sources[b] & src or clusters[b] & clu)), None)
            if spot is not None:
                break
            rest ^= step
        if spot is None:
            spot, residual = len(sources), capacity
            sources.append(0)
            clusters.append(0)
        else:
            row = by_residual[residual]
            row.remove(spot)
            if not row:
                nonempty &= ~(1 << residual)
        sources[spot] |= src
        clusters[spot] |= clu
        placed.append((spot, capacity - residual))
        left = residual - length
        if left:
            insort(by_residual.setdefault(left, []), spot)
            nonempty |= 1 << left
    return placed


def _bits(keys: list, shared_only: bool) -> list[int]:
    """One bit per distinct key (none for null; with `shared_only`, none for a key met once)."""
    seen: dict = {}
    for k in keys:
        seen[k] = seen.get(k, 0) + 1
    bit, out = {}, []
    for k in keys:
        if k is None or k != k or (shared_only and seen[k] < 2):
            out.append(0)
        else:
            out.append(1 << bit.setdefault(k, len(bit)))
    return out


def _pack(capacity: int, distinct_sources: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "id", "cluster"], ascending=[False, True, True], kind="stable", na_position="first")
        ids, ns = pdf["id"].tolist(), [int(x) for x in pdf["n"]]
        group = int(pdf["g"].iloc[0])
        src = _bits([None if pd.isna(x) else x for x in pdf["source"]] if distinct_sources else [None] * len(ids), False)
        clu = _bits([None if pd.isna(x) else x for x in pdf["cluster"]], True)
        tails = sorted((i for i in range(len(ids)) if ns[i] % capacity), key=lambda i: -(ns[i] % capacity))
        spots = dict(zip(tails, best_fit([(ns[i] % capacity, src[i], clu[i]) for i in tails], capacity)))
        full = 1 + max((b for b, _ in spots.values()), default=-1)
        rows = []
        for i, doc in enumerate(ids):
            whole = ns[i] // capacity
            for p in range(whole):
                rows.append((doc, p, p * capacity, capacity, group, full, 0))
                full += 1
            if i in spots:
                rows.append((doc, whole, whole * capacity, ns[i] % capacity, group, *spots[i]))
            elif not ns[i]:
                rows.append((doc, 0, 0, 0, group, None, None))
        out = pd.DataFrame(rows, columns=["id", "piece", "start", "n_tokens", "pack_group", "bin", "bin_offset"])
        return out.astype({"id": "Int64" if pd.api.types.is_integer_dtype(pdf["id"]) else out["id"].dtype,
                           "bin": "Int64", "bin_offset": "Int64"})
    return run


def pack(docs: DataFrame, n_tokens: Column, cluster: Column, id_col: str = "doc_id", source_col: str = "source",
         capacity: int = 2048, group_tokens: int = 1 << 21, distinct_sources: bool = True) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, pack_group, bin, bin_offset (a bin is (pack_group, bin))."""
    light = stored(docs.select(F.col(id_col).alias("id"), n_tokens.cast("long").alias("n"), F.col(source_col).alias("source"),
                               cluster.alias("cluster")), "items")
    total = light.agg(F.sum("n"), F.count(F.lit(1))).first()
    groups = max(1, -(-(total[0] or 0) // group_tokens), -(-total[1] // (group_tokens // 64)))
    # dealt by id and row content: no source, cluster or run of ids shares a group
    dealt = light.withColumn("g", F.pmod(F.xxhash64(F.lit(23), "id", "n"), F.lit(groups)))
    schema = f"id {light.schema['id'].dataType.simpleString()}, {OUT}"
    return dealt.groupBy("g").applyInPandas(_pack(capacity, distinct_sources), schema).withColumnRenamed("id", id_col)
