"""Quality rules (operator 4): a learned decision list over text statistics, JVM-side only.

`with_stats` turns every whole text into numbers with built-in functions. `learn_rules` runs
sequential covering on the labelled rows: it grows one conjunction of thresholds at a time by
FOIL gain, prunes it on a held-out fold, keeps it while it stays precise, removes the rows it
covers and goes on. Every step is one Spark aggregate over (feature, bin), whose result has at
most features x cuts rows, so all labelled rows take part and nothing grows on the driver.
`apply_rules` emits the list as one ordered CASE WHEN expression.

Edge cases: a null or empty text has no words, all its counts are 0 and it fails the base rule;
no labels (or one class only) give an empty list, which keeps whatever passes the base rule; a
document with several labels counts as bad if one of them is 0; repeated documents are rows of
their own; columns of the input with clashing names are never touched, because the statistics
live in one struct until the end.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import HAS_WORD, let, stored, words

POS_BITS = 24                      # window position in the low bits of the sort key
MASK = (1 << POS_BITS) - 1
KEEP = (1 << 63) - 1 - MASK       # 39 bits of the window hash, sign bit off
FEATURES = ["symbols_per_word", "dup_line_share", "repeat_share", "word_length", "upper_share",
            "bang_share", "digit_share", "distinct_share", "lines_per_word", "n_words_log"]


def _same(ws: Column, p: Column, q: Column) -> Column:
    """The 3-word windows at positions p and q of `ws` hold the same words."""
    return ((F.get(ws, p) == F.get(ws, q)) & (F.get(ws, p + 1) == F.get(ws, q + 1))
            & (F.get(ws, p + 2) == F.get(ws, q + 2)))


def _pos(key: Column) -> Column:
    return key.bitwiseAND(F.lit(MASK)).cast("int")


def _covered(ps: Column) -> Column:
    """Words covered by 3-word windows at the (unordered) positions `ps`."""
    return let(F.sort_array(ps), lambda sp: F.aggregate(
        F.transform(sp, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(sp, i + 1) - p, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x))


def _covered_slow(ws: Column) -> Column:
    """The same count by sorting the windows themselves (hash clashes, enormous texts)."""
    rows = F.array_sort(F.transform(F.slice(ws, 1, F.size(ws) - 2), lambda w, i: F.struct(
        w.alias("a"), F.get(ws, i + 1).alias("b"), F.get(ws, i + 2).alias("c"), i.alias("i"))))

    def equal(r, s):
        return F.coalesce((r["a"] == s["a"]) & (r["b"] == s["b"]) & (r["c"] == s["c"]), F.lit(False))

    return let(rows, lambda rs: _covered(F.transform(
        F.filter(rs, lambda r, k: equal(r, F.get(rs, k - 1)) | equal(r, F.get(rs, k + 1))), lambda r: r["i"])))


def with_stats(docs: DataFrame, text_col: str, out: str = "__stats") -> DataFrame:
    """Add one struct with the base counts and the features of the whole text.

    `n_repeat_words` counts the words in 3-word windows that occur twice or more: the window
    hashes are sorted together with their positions as plain longs (39 bits of hash, 24 of
    position); a text whose hashes are all distinct is done before the sort; equal neighbours
    are compared word by word, and a text in which two different windows share those bits
    takes the slow path. Each step is a column of its own, so arrays are built once and the
    primitive sort runs in generated code.
    """
    t, ws, hs, ks, hits = (F.col(f"`{out}_{n}`") for n in ("t", "ws", "hs", "ks", "hits"))
    n = F.size(ws)
    d = docs.withColumn(f"{out}_t", F.coalesce(F.col(text_col), F.lit("")))
    d = d.withColumn(f"{out}_ws", words(t))
    d = d.withColumn(f"{out}_hs", F.when(n < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice(ws, 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)))))
    d = d.withColumn(f"{out}_ks", F.when(
        (F.size(F.array_distinct(hs)) == F.size(hs)) | (n > MASK), F.array().cast("array<bigint>")).otherwise(
        F.sort_array(F.transform(hs, lambda h, i: h.bitwiseAND(F.lit(KEEP)).bitwiseOR(i.cast("long"))))))
    # sorted, non-negative keys: two neighbours share their hash bits iff their XOR is below 2^POS_BITS
    one = F.lit(1)
    d = d.withColumn(f"{out}_hits", F.filter(ks, lambda x, i: (x.bitwiseXOR(F.get(ks, i - one)) <= MASK)
                                             | (x.bitwiseXOR(F.get(ks, i + one)) <= MASK)))
    clash = F.exists(F.transform(hits, lambda x, i: (
        (x.bitwiseXOR(F.get(hits, i - 1)) <= MASK) & ~_same(ws, _pos(x), _pos(F.get(hits, i - 1))))),
        lambda b: F.coalesce(b, F.lit(False)))
    lines = F.col(f"`{out}_ln`")
    d = d.withColumn(f"{out}_ln", F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD)))
    length = F.length(t)

    def chars(pattern: str) -> Column:
        return length - F.length(F.regexp_replace(t, pattern, ""))

    stats = F.struct(
        n.cast("long").alias("n_words"), F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        chars(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(n > MASK, _covered_slow(ws)).when(F.size(hits) == 0, F.lit(0)).when(clash, _covered_slow(ws))
        .otherwise(_covered(F.transform(hits, _pos))).cast("long").alias("n_repeat_words"),
        F.size(lines).alias("n_lines"), chars(r"\p{Lu}+").alias("n_upper"), chars(r"[!?]+").alias("n_bang"),
        chars(r"[0-9]+").alias("n_digit"), F.size(F.array_distinct(ws)).alias("n_distinct"))
    return d.withColumn(out, stats).drop(*[f"{out}_{c}" for c in ("t", "ws", "hs", "ks", "hits", "ln")])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def features(s: Column) -> dict[str, Column]:
    n = s["n_words"]
    return dict(zip(FEATURES, [
        _ratio(s["n_symbols"], n), _ratio(s["n_dup_lines"], s["n_lines"]), _ratio(s["n_repeat_words"], n),
        _ratio(s["word_chars"], n), _ratio(s["n_upper"], s["word_chars"]), _ratio(s["n_bang"], n),
        _ratio(s["n_digit"], s["word_chars"]), _ratio(s["n_distinct"], n), _ratio(s["n_lines"], n),
        F.log1p(n.cast("double"))]))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass
class Rule:
    """IF every condition holds THEN reject; a condition is (feature, '>=' or '<', threshold)."""
    conditions: list[tuple[str, str, float]] = field(default_factory=list)
    bad: int = 0
    good: int = 0

    def column(self, f: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, cut in self.conditions:
            out = out & ((f[name] >= F.lit(cut)) if op == ">=" else (f[name] < F.lit(cut)))
        return out

    def __str__(self) -> str:
        return "IF " + " AND ".join(f"{n} {o} {c:.6g}" for n, o, c in self.conditions) + f" THEN reject  [{self.bad}/{self.good}]"


def _cuts(rows: DataFrame, per_class: int) -> dict[str, list[float]]:
    """Candidate thresholds: quantiles of the bad and of the good rows (at most 2 x per_class each)."""
    qs = [i / (per_class - 1) for i in range(per_class)]
    got = rows.groupBy("bad").agg(*[F.percentile_approx(n, qs, 10000).alias(n) for n in FEATURES]).collect()
    out = {}
    for n in FEATURES:
        vals = sorted({v for r in got for v in (r[n] or [])})
        # thresholds midway between neighbouring quantiles separate better than the values themselves
        out[n] = sorted({(a + b) / 2 for a, b in zip(vals, vals[1:])} | set(vals[:1]))
    return out


def _bin(name: str, cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(name)))


def learn_rules(labelled: DataFrame, max_rules: int = 8, max_conditions: int = 3, per_class: int = 16,
                min_cover: int = 5, min_precision: float = 0.8) -> list[Rule]:
    """Sequential covering over `labelled` (columns FEATURES, `bad` 0/1, `fold` 0..2; fold 2 prunes)."""
    cuts = _cuts(labelled, per_class)
    names = [n for n in FEATURES if cuts[n]]
    if not names:
        return []
    # the bin of a value is the number of cuts not above it: `value >= cuts[k]` is `bin > k`
    binned = stored(labelled.select("bad", "fold", *[
        _bin(n, cuts[n]).alias(n) for n in names]), "rules")

    def holds(conds) -> Column:
        out = F.lit(True)
        for n, op, k in conds:
            out = out & ((F.col(n) > k) if op == ">=" else (F.col(n) <= k))
        return out

    def tally(where: Column) -> dict[tuple[str, int], list[int]]:
        long = (binned.where(where).select("bad", F.posexplode(F.array(*names)).alias("f", "b"))
                .groupBy("f", "b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")))
        return {(names[r["f"]], r["b"]): [r["p"], r["n"]] for r in long.collect()}

    rules: list[Rule] = []
    open_rows = F.lit(True)
    while len(rules) < max_rules:
        conds: list[tuple[str, str, int]] = []
        p0 = n0 = None
        while len(conds) < max_conditions:
            t = tally(open_rows & (F.col("fold") < 2) & holds(conds))
            if p0 is None:
                p0 = sum(v[0] for (f, _), v in t.items() if f == names[0])
                n0 = sum(v[1] for (f, _), v in t.items() if f == names[0])
            if p0 < min_cover or n0 == 0:
                break
            best, best_gain, stat = None, 1e-9, None
            for n in names:
                per = [t.get((n, b), [0, 0]) for b in range(len(cuts[n]) + 1)]
                below_p = below_n = 0
                for k in range(len(cuts[n])):
                    below_p, below_n = below_p + per[k][0], below_n + per[k][1]
                    for op, p, m in ((">=", p0 - below_p, n0 - below_n), ("<", below_p, below_n)):
                        if p >= min_cover:
                            gain = p * (math.log2(p / (p + m)) - math.log2(p0 / (p0 + n0)))
                            if gain > best_gain:
                                best, best_gain, stat = (n, op, k), gain, (p, m)
            if best is None:
                break
            conds.append(best)
            p0, n0 = stat
            if n0 == 0:
                break
        if not conds:
            break
        # prune on the held-out fold: the prefix with the best (p - n) / (p + n); the shorter one on a tie
        ks = range(1, len(conds) + 1)
        got = binned.where(open_rows & (F.col("fold") == 2)).agg(*[
            F.sum(F.when(holds(conds[:k]), F.col("bad") if c else 1 - F.col("bad")).otherwise(0)).alias(f"x{k}_{c}")
            for k in ks for c in (0, 1)]).first()
        held = [(got[f"x{k}_1"] or 0, got[f"x{k}_0"] or 0) for k in ks]
        worth = [(p - m) / (p + m) if p + m else -2.0 for p, m in held]
        keep = max(ks, key=lambda k: (worth[k - 1], -k)) if any(p + m for p, m in held) else len(conds)
        conds = conds[:keep]
        c = binned.where(open_rows & holds(conds)).agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).first()
        p, m = c["p"] or 0, c["n"] or 0
        if p < min_cover or p < min_precision * (p + m):
            break
        rules.append(Rule([(n, op, float(cuts[n][k])) for n, op, k in conds], p, m))
        open_rows = open_rows & ~holds(conds)
    return rules


def rule_expression(rules: list[Rule], f: dict[str, Column]) -> Column:
    """The ordered list as one CASE WHEN: the number (from 1) of the first rule that rejects, else 0."""
    if not rules:
        return F.lit(0)
    out = F.when(rules[0].column(f), F.lit(1))
    for i, r in enumerate(rules[1:], 2):
        out = out.when(r.column(f), F.lit(i))
    return out.otherwise(F.lit(0))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> tuple[DataFrame, list[Rule]]:
    """(id, base counts, base_failed, rule, kept) per row of `docs`, and the learned list.

    `labels` has (id, quality); all labelled rows that pass the base rule train the list.
    """
    stats = stored(with_stats(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "s")
                   .select("id", "s"), "stats")
    f = features(F.col("s"))
    marks = (labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg((1 - F.min("quality")).cast("int").alias("bad")))
    labelled = (stats.where(~base_failed(F.col("s"))).join(marks, "id")
                .select(*[c.alias(n) for n, c in f.items()], "bad",
                        F.pmod(F.xxhash64("id"), F.lit(3)).cast("int").alias("fold")))
    rules = learn_rules(labelled, **options)
    rule = rule_expression(rules, f)
    out = stats.select(
        F.col("id").alias(id_col), *[F.col(f"s.{c}").alias(c) for c in
                                    ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(F.col("s")).alias("base_failed"), rule.alias("rule"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), rules


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` the base rule and the learned list accept, with their own columns."""
    s = F.col("`__stats`")
    _, rules = quality_verdicts(docs, labels, id_col, text_col)
    good = ~base_failed(s) & (rule_expression(rules, features(s)) == 0)
    # a filter would be pushed below the statistics and compute them again inside their own lambdas;
    # exploding one or no element keeps the rows just the same and stays above them
    once = F.explode(F.when(good, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))).alias("__once")
    return with_stats(docs, text_col, "__stats").select(*[F.col(f"`{c}`") for c in docs.columns], once).drop("__once")
