"""Document fingerprints by winnowing (operator 12), JVM-side only.

A text is read as tokens: up to six characters in a row, or one character of a script that is
written without spaces.
Every run of K tokens is hashed; of every W consecutive hashes the smallest is chosen, the rightmost among
equals. Two texts that share a passage of K + W - 1 tokens share a chosen hash (the match guarantee),
and positions are kept, so a shared hash says where. A text of fewer than K tokens is one run; with
W runs or fewer the smallest of them all is chosen; a text without a token has no fingerprint.

A run's hash (32 bits) and its position (31 bits) are one long: hash above, (2^31 - 1 - position) below, so the
plain minimum is the rightmost smallest hash. Minima over W = 4 are two doublings of `least` over the
array and its own shift. Tokens come from one regular expression, so the work is linear in the text. Runs of characters
instead of tokens (one look-ahead expression, eight characters, three doublings) took three times the CPU.

The next document (descending id, ties by text hash; after the last the first) comes from a window over
buckets of the order: borders are quantiles of the ids (a border met m times means an id of many rows,
which is cut into m parts by text hash), and each bucket also gets a copy of the next bucket's first row, so
no window spans the table. Rows repeated in full are folded into two (the last copy, and the others,
whose next document is the same text) and unfolded at the end; a pass over (id, hash) counts tells if there are any.

Likeness is the Jaccard similarity of the two sets of chosen hashes; 1 for two empty ones.
Edge cases: a null text counts as empty; a null id comes last; a table of one row is its own next
document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import let, stored

K, W = 5, 4                        # tokens in a run, runs in a window (a power of two)
#: Up to six characters in a row (alphabets from Latin to the Indic ones), or any one other character.
TOKEN = r"[\x21-\u0DFF]{1,6}+|[^\x20\x09-\x0D]"
LOW = (1 << 31) - 1
BUCKET_BYTES = 1 << 20             # text in a bucket of the order, which is also the unit of work
MAX_BUCKETS = 1 << 16              # beyond 64 GB of text buckets grow (their windows spill to disk)


def _runs(text: Column) -> Column:
    """Packed (hash, position) of every run of K tokens; a shorter text is one run."""
    def packed(tokens):
        more = [lambda i, k=k: F.get(tokens, i + k) for k in range(1, K)]
        return F.transform(tokens, lambda t, i: F.shiftleft(F.xxhash64(t, *[m(i) for m in more]).bitwiseAND(F.lit(0xFFFFFFFF)), 31)
                           .bitwiseOR(F.lit(LOW) - i))
    every = let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), packed)
    return let(every, lambda a: F.slice(a, 1, F.greatest(F.size(a) - (K - 1), F.lit(1))))


def _least_with(shift: int):
    """Each element's minimum with the one `shift` places on."""
    def of(a):
        return F.zip_with(a, F.slice(a, shift + 1, F.greatest(F.size(a) - shift, F.lit(0))), lambda x, y: F.least(x, y))
    return of


def chosen(text: Column) -> Column:
    """The packed fingerprint: the smallest (hash, position) of every window, each once, by position."""
    minima, span = _runs(text), 1
    while span < W:
        minima, span = let(minima, _least_with(span)), 2 * span
    return let(minima, lambda a: F.array_distinct(F.slice(a, 1, F.greatest(F.size(a) - (W - 1), F.lit(1)))))


def hash_of(chosen: Column) -> Column:
    return F.shiftright(chosen, 31)


def position_of(chosen: Column) -> Column:
    return F.lit(LOW) - chosen.bitwiseAND(F.lit(LOW))


def winnow(text: Column) -> Column:
    """Fingerprint of a text: array<struct<hash long, position long>> by position."""
    return F.transform(chosen(F.coalesce(text, F.lit(""))), lambda x: F.struct(hash_of(x).alias("hash"), position_of(x).alias("position")))


def written(picked: Column) -> Column:
    """A packed fingerprint as a string: per chosen run `1`, eight hex digits of its hash, and the step from
    the run chosen before (from -1 for the first) as one hex digit; a step is at most W."""
    def one(x, i):
        since = F.coalesce(position_of(F.get(picked, i - 1)), F.lit(-1).cast("long"))
        return F.hex(F.lit(1 << 36).bitwiseOR(F.shiftleft(hash_of(x), 4)).bitwiseOR(position_of(x) - since))
    return F.array_join(F.transform(picked, one), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; 1 for two empty ones."""
    total = F.size(a) + F.size(b)
    either = F.size(F.array_distinct(F.concat(a, b)))
    return F.when(total == 0, F.lit(1.0)).otherwise(let(either, lambda n: (total - n) / n))


def _hashes(picked: Column) -> Column:
    return F.array_distinct(F.transform(picked, hash_of))


def _longs(values: list) -> Column:
    """A folded array literal (no expression per element)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _buckets(light: DataFrame, target: int) -> tuple[Column, int]:
    """Bucket of (id, h1) in the order of the rows, and how many buckets there are at most."""
    total = light.agg(F.sum(F.col("bytes") * F.col("n"))).first()[0] or 0
    n = int(min(MAX_BUCKETS, max(total // target, 1)))
    found = []
    if n > 1:
        cuts = F.split(F.lit(",".join(str(k / n) for k in range(1, n))), ",").cast("array<double>")
        found = light.where(F.col("id").isNotNull()).agg(F.percentile_approx("id", cuts, max(10_000, 4 * n)).alias("q")).first()["q"] or []
    bounds = sorted(set(found), reverse=True)                          # an id that is a bound m times has m parts
    if not bounds:
        return F.when(F.col("id").isNull(), 1).otherwise(0), 2
    times = Counter(found)
    parts = [times[b] for b in bounds]
    starts = [0]
    for m in parts:                                                    # ids above bound k and not above the one before it
        starts.append(starts[-1] + m)
    at = F.size(F.filter(_longs(bounds), lambda b: b > F.col("id"))) + 1
    share = (F.shiftright("h1", 32) + F.lit(1 << 31)) / F.lit(1 << 32)
    m = F.element_at(_longs(parts + [1]), at)
    part = F.when(F.get(_longs(bounds), at - 1) == F.col("id"), F.least(F.floor(share * m), m - 1)).otherwise(0)
    place = (F.element_at(_longs(starts), at) + part).cast("int")
    return F.when(F.col("id").isNull(), F.lit(starts[-1] + 1)).otherwise(place), starts[-1] + 2


def _ordered_rows(docs: DataFrame, id_col: str, text_col: str, target: int) -> tuple[DataFrame, int]:
    """(id, h1, h2, text, bucket, mult, real) with each bucket's successor row, and the number of buckets."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")})
    light = stored(d.groupBy("id", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.first(F.octet_length("text")).alias("bytes")), "winnow-keys")
    bucket, count = _buckets(light, target)

    key = ["id", "h1", "h2"]
    d = d.withColumn("mult", F.lit(1).cast("long"))
    many = light.where("n > 1").select(*[F.col(c).alias("m_" + c) for c in key], "n")
    same = F.expr("id <=> m_id and h1 = m_h1 and h2 = m_h2")
    if not many.isEmpty():                                             # fold rows repeated in full
        single = d.join(many, same, "left_anti")
        folded = d.join(many, same, "left_semi").groupBy(*key).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
        folded = folded.select(*key, "text", F.explode(F.array(F.col("n") - 1, F.lit(1).cast("long"))).alias("mult"))
        d = single.select(*key, "text", "mult").unionByName(folded)
    d = d.withColumn("bucket", bucket).withColumn("real", F.lit(True))

    first = F.struct(F.col("id").isNull(), -F.col("id"), "h1", "h2", "id")
    heads = [tuple(r) for r in light.withColumn("bucket", bucket).groupBy("bucket").agg(F.min(first).alias("f"))
             .select("bucket", "f.id", "f.h1", "f.h2").orderBy("bucket").collect()]      # at most 2 MAX_BUCKETS rows
    if not heads:
        return d, count
    successors = [(b, *nxt[1:]) for (b, *_), nxt in zip(heads, heads[1:] + heads[:1])]
    spark = docs.sparkSession
    succ = spark.createDataFrame(successors, "bucket int, m_id long, m_h1 long, m_h2 long")
    copies = d.drop("bucket").join(F.broadcast(succ), same)
    copies = copies.groupBy("bucket", *key).agg(F.first("text").alias("text"))
    copies = copies.withColumns({"mult": F.lit(0).cast("long"), "real": F.lit(False)})
    return d.unionByName(copies), count


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: int = BUCKET_BYTES) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    d, count = _ordered_rows(docs, id_col, text_col, target)
    d = d.repartition(count, "bucket")                                 # a given number: the work is in proportion to text, not to shuffled bytes
    w = "over (partition by bucket order by not real, id desc nulls last, h1, h2, mult desc)"
    cut = F.floor(F.col("n") / 3).cast("int")
    d = d.withColumn("next", F.expr(f"lead(text) {w}")).withColumn("n", F.length("text"))
    d = d.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n") - cut), F.substr(F.coalesce("next", F.lit("")), F.lit(1), cut)))
    d = d.select("bucket", "id", "h1", "h2", "mult", "real", F.col("n").cast("long").alias("n_chars"),
                 F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), chosen(F.col("text")).alias("own"), chosen(F.col("edited")).alias("changed"))
    d = d.withColumn("hashes", _hashes(F.col("own"))).withColumn("next_hashes", F.expr(f"lead(hashes) {w}"))
    d = d.where("real").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("hashes"), _hashes(F.col("changed"))).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"), "mult")
    return d.withColumn("mult", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mult")))).drop("mult")
