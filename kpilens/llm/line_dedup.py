"""Line dedup by an exact set-similarity join (operator 7), JVM-side only.

A line is the set of its words. A line goes if an earlier line (smaller document id, then
smaller line number) has Jaccard >= percent / 100 with it; blank lines stay. Equal lines are
settled first by one aggregate (the first occurrence represents them), then:

* rarity order: word counts over all texts in 65,536 hash buckets (a table of fixed size) rank
  each word; ties break by hash. Any order that is the same for all lines gives exact results.
* prefix filter: two lines that reach the threshold share one of the first
  n - ceil(t n) + 1 words in that order, so only those words are join keys.
* length and positional filters, and a 64-bit parity sketch whose bit count is a proven lower
  bound of the symmetric difference, are conditions inside the join.
* both joins are LEFT SEMI: a line only needs one earlier match, so a word shared by m lines
  never makes m^2 rows. The first finds the lines with any plausible partner; the second runs
  on those alone, with their words, and verifies the Jaccard.

The threshold is 0.9 unless given. Edge cases: a null text has no lines and stays null; an empty
text stays; repeated rows (same id, same text) are treated alike; rows with the same id and other
texts are ordered by a hash of the text; null ids come first; other columns are passed through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import HAS_WORD, stored

BUCKETS = 1 << 16
HASH_BITS = 53                     # word hash in the low bits of the sort key, rarity rank above
BROADCAST_DOCS = 100_000           # the plausible lines' documents are broadcast up to here, else shuffled
KEY = ["id", "k"]


def plain(text: Column) -> Column:
    """The text with the rarer separators (not the line break) as spaces: asked once for a text, not for each of its lines."""
    odd = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\v")) | F.contains(text, F.lit("\f")) | F.contains(text, F.lit("\r"))
    return F.when(odd, F.translate(text, "\t\v\f\r", "    ")).otherwise(text)


def line_words(line: Column) -> Column:
    """`words` of a line of a plain text: split at single spaces, since a pattern costs several times as much."""
    return F.array_remove(F.split(F.coalesce(line, F.lit("")), " "), "")


def word_ranks(texts: DataFrame, text_col: str) -> Column:
    """Array literal: rarity rank of each hash bucket, from the word counts of all texts."""
    lines = texts.select(F.explode(F.split(plain(F.col(text_col)), "\n")).alias("s"))
    got = (lines.select(F.explode(F.split("s", " ")).alias("w")).where("w <> ''")
           .groupBy(F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b")).count().collect())
    rank = [0] * BUCKETS
    for r in got:
        rank[r["b"]] = int(16 * math.log2(1 + r["count"]))
    return F.split(F.lit(",".join(map(str, rank))), ",").cast("array<int>")


def _ordered(ws: Column, ranks: Column) -> Column:
    """Distinct words as longs, rarest first: each word is hashed once, and no element is nullable, so
    the sort runs on a primitive array."""
    hashes = F.array_distinct(F.transform(ws, lambda w: F.xxhash64(w)))

    def key(h):
        rank = F.coalesce(F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), F.lit(0)).cast("long")
        return F.shiftleft(rank, HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    return F.sort_array(F.transform(hashes, key))


def _line_rows(docs: DataFrame, numbers: str) -> DataFrame:
    """(id, k, line, words) of the lines whose numbers are in the array column `numbers`."""
    d = docs.withColumn("lines", F.split(plain(F.col("text")), "\n"))
    pick = F.transform(F.col(numbers), lambda i: F.struct(i.alias("line"), F.get(F.col("lines"), i).alias("s")))
    return d.select(*KEY, F.explode(pick).alias("p")).select(*KEY, "p.line", line_words(F.col("p.s")).alias("ws"))


def _entries(lines: DataFrame, ranks: Column, percent: int, carry: tuple[str, ...]) -> DataFrame:
    """One row per prefix word of each line: token, position, line key, size, parity sketch."""
    keys = F.col("keys")
    n = F.size(keys)
    low = F.aggregate(keys, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))))
    prefix = F.slice(keys, F.lit(1), n - F.ceil(n * F.lit(percent) / 100).cast("int") + 1)
    # size and sketch stand before the explode (beside it they would be computed for each prefix word instead of each line)
    # and are never null (else the join infers a filter on them, which is pushed below and computes the keys a second time)
    d = lines.withColumn("keys", _ordered(F.col("ws"), ranks)).withColumns(
        {"n": F.coalesce(n, F.lit(0)), "par": F.coalesce(low, F.lit(0).cast("long"))})
    # columns in the order they have below: another order adds a projection to one side of the self-join, and its exchange
    # is no longer shared
    return d.select(*KEY, "line", *carry, "n", "par", F.posexplode(prefix).alias("pos", "tok"))


def _pairwise(entries: DataFrame, extra, percent: int) -> DataFrame:
    """Entries with a partner entry that passes the filters and `extra(left, right)`."""
    a, b = entries.alias("a"), entries.alias("b")
    total = F.col("a.n") + F.col("b.n")
    apart = F.floor(total * F.lit(100 - percent) / F.lit(100 + percent))     # largest symmetric difference
    ok = ((F.col("a.tok") == F.col("b.tok"))
          & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
          & (F.col("a.pos") + F.col("b.pos") <= apart)
          & (F.bit_count(F.col("a.par").bitwiseXOR(F.col("b.par"))) <= apart) & extra)
    return a.join(b, ok, "left_semi")


def _earlier() -> Column:
    """Line b comes before line a."""
    ids = F.col("b.id") < F.col("a.id")
    same = F.col("b.id") == F.col("a.id")
    return ids | (same & ((F.col("b.k") < F.col("a.k")) | ((F.col("b.k") == F.col("a.k")) & (F.col("b.line") < F.col("a.line")))))


def removed_and_kept(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, k, keep): numbers of the non-blank lines that stay, per document that has any."""
    base = _base(docs, id_col, text_col)
    ranks = word_ranks(docs, text_col)
    occ = (base.select(*KEY, F.posexplode(F.split("text", "\n")).alias("line", "s")).where(F.col("s").rlike(HAS_WORD))
           .select(*KEY, "line", F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(7), "s").alias("h2")))
    first = occ.groupBy("h1", "h2").agg(F.min(F.struct(*KEY, "line")).alias("m")).select("m.*")
    firsts = stored(first.groupBy(*KEY).agg(F.collect_list("line").alias("reps")), "firsts")

    held = base.join(firsts, KEY)
    entries = _entries(_line_rows(held, "reps"), ranks, percent, ())
    other = ~((F.col("a.id") == F.col("b.id")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.line") == F.col("b.line")))
    plausible = (_pairwise(entries, other, percent).select(*KEY, "line").distinct()
                 .groupBy(*KEY).agg(F.collect_list("line").alias("check")))
    plausible = stored(plausible, "plausible")
    few = F.broadcast(plausible) if plausible.count() <= BROADCAST_DOCS else plausible

    # the words go along as one string, several times smaller than an array of strings; pairs that pass the filters split it.
    # The Jaccard test is written with the intersection once, since a join condition computes it as often as it stands there
    checked = (_line_rows(base.join(few, KEY), "check").withColumn("ws", F.array_distinct("ws"))
               .withColumns({"words": F.array_join("ws", " "), "m": F.size("ws").cast("long")}))
    full = _entries(checked, ranks, percent, ("words", "m"))
    common = F.size(F.array_intersect(F.split("a.words", " "), F.split("b.words", " "))).cast("long")
    close = (100 + percent) * common >= percent * (F.col("a.m") + F.col("b.m"))
    gone = (_pairwise(full, _earlier() & close, percent).select(*KEY, "line").distinct()
            .groupBy(*KEY).agg(F.collect_list("line").alias("gone")))
    return (firsts.join(gone, KEY, "left")
            .select(*KEY, F.when(F.col("gone").isNull(), F.col("reps"))
                    .otherwise(F.array_except("reps", "gone")).alias("keep")))


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, text), one row per different (id, text); a null id sorts first."""
    lowest = F.lit(-(1 << 63)).cast("long")
    rid = F.coalesce(F.col(id_col).cast("long"), lowest)
    return docs.select(rid.alias("id"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90) -> DataFrame:
    """`docs` with later similar lines taken out of the text; adds n_lines and n_removed (blank lines count as neither)."""
    keep = stored(removed_and_kept(docs, id_col, text_col, percent), "keep").select(
        F.col("id").alias("__i"), F.col("k").alias("__k"), F.col("keep").alias("__keep"))
    lowest = F.lit(-(1 << 63)).cast("long")
    d = docs.join(keep, (F.coalesce(docs[id_col].cast("long"), lowest) == keep["__i"])
                  & (F.xxhash64(docs[text_col]) == keep["__k"]), "left").drop("__i", "__k")
    d = d.withColumn("__lines", F.split(F.col(text_col), "\n"))
    d = d.withColumn("__blank", F.filter(F.transform("__lines", lambda s, i: F.when(s.rlike(HAS_WORD), F.lit(-1)).otherwise(i)),
                                         lambda i: i >= 0))
    d = d.withColumn("__stay", F.sort_array(F.concat(F.coalesce("__keep", F.array().cast("array<int>")), "__blank")))
    text = F.array_join(F.transform("__stay", lambda i: F.get(F.col("__lines"), i)), "\n")
    n = F.coalesce(F.size("__lines") - F.size("__blank"), F.lit(0)).cast("long")
    d = d.withColumn("n_lines", n).withColumn("n_removed", n - F.coalesce(F.size("__keep"), F.lit(0)))
    return (d.withColumn(text_col, F.when(F.col(text_col).isNotNull(), text))
            .drop("__keep", "__lines", "__blank", "__stay"))
