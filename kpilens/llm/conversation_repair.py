"""Conversation structure repair by grammar-compressed dynamic programming (operator 13).

A conversation's turns become a string of symbols, one per turn: its role class (s, u, a, other) and
its first fault (none, blank, duplicate, truncated). The cheapest edits that give role initials
`(s?(ua)+)?` are a path through the four states of that pattern's automaton. Every symbol has a 4 x 4
transfer matrix whose entries are (cost, audit) with the order "cheaper, then ASCII-least"; a sequence's
matrix is the product of its symbols' matrices. The product is associative: two audits of equal cost over
the same turns are never prefixes of one another (the audit and the turns fix the cost, and further
inserts cost more), so their order survives whatever follows.

* Re-Pair: Spark counts the adjacent pairs of all distinct sequences (weighted by how often each occurs),
  the most frequent pairs become rules, the sequences are rewritten, and so on, `ROUNDS` times. The
  driver sees at most `RULES` pairs a round. The grammar decides the speed only, never the result.
* One matrix per rule, bottom-up, with audits as ropes: a rope is a pair of shared ropes with its length
  and a polynomial hash, so joining costs O(1) and two ropes are compared by descending to where they differ.
* Sequences are cut into pieces of at most `PIECE` turns by the global turn number, whatever a conversation's
  length; a worker evaluates each different piece once and folds the pieces of a conversation.
* Replay streams the turns of a conversation, in order, past its audit. A hot conversation is read by one
  task there (a SHA-256 or a rendering is sequential) in constant memory besides its audit string.

Costs: Keep 0, Rerole 1, Delete 2 (required for blank and duplicate turns), Insert an empty turn 5; a
truncated turn that stays adds 5.

Edge cases: null roles and texts count as one space (role class other, blank text); null ids are one
conversation; turns are ordered by turn (nulls first), then role, then text; equal rows stand side by side and the later ones are
duplicates; roles are told apart by their first character alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import HAS_WORD, stored

ROUNDS, RULES = 6, 24              # bounds of the grammar: at most 144 rules
PIECE = 1024                       # turns in a piece
KEPT_MATRICES = 50_000             # different pieces a worker remembers
BLANK = r"\x20\x09-\x0D"
ROLES, FAULTS = "suao", "kbdt"     # other = o; none = k
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
CUT = 5                            # a truncated turn that stays
STATES = range(4)                  # nothing yet, after s, after u, after a
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPT = (0, 3)
TERMINAL, RULE = 0x100, 0x200      # code points of the symbols in a sequence


# ---- ropes and matrices -------------------------------------------------------------------------

_P, _B = (1 << 61) - 1, 911382323


class Rope:
    """An audit string as a shared binary tree."""

    __slots__ = ("n", "h", "a", "b", "c")

    def __init__(self, a=None, b=None, c: str = ""):
        self.a, self.b, self.c = a, b, c
        if a is None:
            self.n, self.h = len(c), ord(c) if c else 0
        else:
            self.n = a.n + b.n
            self.h = (a.h * pow(_B, b.n, _P) + b.h) % _P

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.a is None:
                out.append(x.c)
            else:
                todo += (x.b, x.a)
        return "".join(out)


EMPTY = Rope()
LEAF = {c: Rope(c=c) for c in "KRDI"}


def join(a: Rope, b: Rope) -> Rope:
    return b if not a.n else a if not b.n else Rope(a, b)


def before(x: Rope, y: Rope) -> bool:
    """x < y in ASCII order: equal subtrees are skipped by hash."""
    xs, ys = [x], [y]
    while xs and ys:
        a, b = xs.pop(), ys.pop()
        if a is b or (a.n == b.n and a.h == b.h):
            continue
        if a.a is not None and (a.n >= b.n or b.a is None):
            xs += (a.b, a.a)
            ys.append(b)
        elif b.a is not None:
            ys += (b.b, b.a)
            xs.append(a)
        else:
            return a.c < b.c
    return bool(ys)


def better(x, y):
    """The smaller of two (cost, rope) entries; None is infinity."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return x if before(x[1], y[1]) else y


def times(m, w):
    """Min-plus product of two matrices given as rows of entries."""
    out = []
    for row in m:
        new = [None] * 4
        for k in STATES:
            if (left := row[k]) is None:
                continue
            for j in STATES:
                if (right := w[k][j]) is not None:
                    cost = left[0] + right[0]
                    if new[j] is None or cost <= new[j][0]:
                        new[j] = better(new[j], (cost, join(left[1], right[1])))
        out.append(new)
    return out


def _inserts():
    m = [[(0, EMPTY) if i == j else None for j in STATES] for i in STATES]
    one = [[None] * 4 for _ in STATES]
    for (i, c), j in STEP.items():
        if c != "s":
            one[i][j] = (INSERT, LEAF["I"])
    step = m
    for _ in STATES:
        step = times(step, one)
        m = [[better(a, b) for a, b in zip(x, y)] for x, y in zip(m, step)]
    return m


INSERTS = _inserts()


def symbol_matrix(code: int):
    """Inserts, then what may happen to one turn of role class and fault `code`."""
    role, fault = ROLES[code // 4], FAULTS[code % 4]
    m = [[None] * 4 for _ in STATES]
    for i in STATES:
        m[i][i] = (DELETE, LEAF["D"])
        if fault not in "bd":
            more = CUT if fault == "t" else 0
            for new, cost, name in [(role, KEEP, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")]:
                if (j := STEP.get((i, new))) is not None:
                    m[i][j] = better(m[i][j], (cost + more, LEAF[name]))
    return times(INSERTS, m)


class Grammar:
    """Re-Pair rules and the transfer matrix of each symbol."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        self.matrix = {chr(TERMINAL + c): symbol_matrix(c) for c in range(16)}
        for r, pair in enumerate(pairs):                              # bottom-up
            self.matrix[chr(RULE + r)] = times(self.matrix[pair[0]], self.matrix[pair[1]])
        self.known: dict[str, list] = {}

    def compress(self, seq: str) -> str:
        for r, pair in enumerate(self.pairs):
            seq = seq.replace(pair, chr(RULE + r))
        return seq

    def transfer(self, seq: str):
        """Matrix of a piece; equal pieces share it."""
        got = self.known.get(seq)
        if got is None:
            level = [self.matrix[x] for x in self.compress(seq)]
            while len(level) > 1:                                     # balanced, so ropes stay shallow
                level = [times(*level[k:k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
            got = level[0]
            if len(self.known) >= KEPT_MATRICES:
                self.known.clear()
            self.known[seq] = got
        return got

    def cheapest(self, pieces: Iterator[str]) -> tuple[int, str]:
        """Cost and audit of the cheapest edits of a conversation given as pieces."""
        row = [[(0, EMPTY), None, None, None]]
        for seq in pieces:
            row = times(row, self.transfer(seq))
        row = times(row, INSERTS)[0]
        best = None
        for j in ACCEPT:
            best = better(best, row[j])
        return best[0], str(best[1])


def learn_grammar(pieces: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[str]:
    """Re-Pair over a column `seq` of sequences: pairs in the order of their rules."""
    counted = stored(pieces.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "sequences")
    pairs: list[str] = []
    for _ in range(rounds):
        now = list(pairs)

        def count(batches):
            for b in batches:
                got: dict[str, int] = {}
                for seq, n in zip(b["seq"], b["n"]):
                    for r, pair in enumerate(now):
                        seq = seq.replace(pair, chr(RULE + r))
                    for k in range(len(seq) - 1):
                        got[seq[k:k + 2]] = got.get(seq[k:k + 2], 0) + n
                yield pd.DataFrame({"pair": list(got), "n": list(got.values())}).astype({"pair": "object", "n": "int64"})

        top = (counted.mapInPandas(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
               .where("n > 1").orderBy(F.desc("n"), "pair").limit(rules).collect())
        if not top:
            break
        pairs += [r["pair"] for r in top]
    return pairs


# ---- turns ---------------------------------------------------------------------------------------

def _no_word(text: Column) -> Column:
    return ~text.rlike(HAS_WORD)


def classified(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, key, turn, role, text, sym, at): one row per turn, `at` is its place in the order of all turns."""
    d = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    d = d.withColumn("key", F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("~")))
    # the n-th turn with this role and text in its conversation; a group is one text said again and again
    w = "row_number() over (partition by key, role, xxhash64(text), xxhash64(7, text) order by turn asc nulls first)"
    last = F.regexp_extract("text", rf"([^{BLANK}])[{BLANK}]*\z", 1)
    fault = (F.when(_no_word(F.col("text")), 1).when(F.col("nth") > 1, 2)
             .when(~last.isin(".", "!", "?"), 3).otherwise(0))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    d = d.withColumn("nth", F.expr(w)).withColumn("sym", (4 * kind + fault).cast("int")).drop("nth")
    # the sampled borders hold a text's first characters only; rows equal in them share a partition
    d = d.repartitionByRange("key", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64)).sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text", F.col("sym") % 4 == 2)
    return stored(d.withColumn("at", F.monotonically_increasing_id()), "turns")


def _pieces(rows: DataFrame) -> DataFrame:
    """(key, piece, seq): the symbols of at most PIECE turns of a conversation as a string."""
    inside = F.sort_array(F.collect_list(F.struct("at", "sym")))
    names = F.lit("".join(chr(TERMINAL + c) for c in range(16)))
    letters = F.transform(inside, lambda x: F.substr(names, x["sym"] + 1, F.lit(1)))
    return (rows.groupBy("key", F.shiftright("at", PIECE.bit_length() - 1).alias("piece"))
            .agg(F.array_join(letters, "").alias("seq")))


def _in_order(frame: DataFrame, *cols: str) -> DataFrame:
    return frame.repartition("key").sortWithinPartitions("key", *cols)


def _evaluated(pieces: DataFrame, pairs: list[str]) -> DataFrame:
    """(key, blank, duplicate, truncated, illegal, cost, audit) per conversation, its pieces folded in order."""
    fault = [{chr(TERMINAL + 4 * r + f) for r in range(4)} for f in range(4)]
    legal = {(x, y) for x in range(16) for y in range(16) if ROLES[x // 4] + ROLES[y // 4] in ("su", "ua", "au")}

    def run(batches):
        grammar = Grammar(pairs)
        key, seqs, out = None, [], []

        def close():
            cost, audit = grammar.cheapest(iter(seqs))
            whole = "".join(seqs)
            n = [sum(whole.count(c) for c in f) for f in fault]
            codes = [ord(c) - TERMINAL for c in whole]
            bad = sum((x, y) not in legal for x, y in zip(codes, codes[1:]))
            out.append((key, n[1], n[2], n[3], bad, cost, audit))

        for b in batches:
            for k, seq in zip(b["key"], b["seq"]):
                if k != key:
                    if key is not None:
                        close()
                    key, seqs = k, []
                seqs.append(seq)
            yield pd.DataFrame(out, columns=["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])
            out = []
        if key is not None:
            close()
            yield pd.DataFrame(out, columns=["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return _in_order(pieces, "piece").mapInPandas(
        run, "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def replay(rows: Iterator[tuple]) -> Iterator[tuple[str, int, str, str, str]]:
    """(key, place, edit, role, text) of the repaired turns, from rows (key, role, text, audit) in order:
    each conversation's audit row (audit not null) stands before its turns."""
    key, audit, at, place, want = None, "", 0, 0, "user"

    def emit(edit, role, text):
        nonlocal place
        place += 1
        return key, place, edit, role, text

    def inserts():
        nonlocal at, want
        while at < len(audit) and audit[at] == "I":
            at += 1
            yield emit("I", want, "")
            want = "assistant" if want == "user" else "user"

    for k, role, text, new in rows:
        if new is not None:
            if key is not None:
                yield from inserts()
            key, audit, at, place, want = k, new, 0, 0, "user"
            continue
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "D":
            continue
        if edit == "K":
            yield emit("K", role, text)
            want = "assistant" if role[:1] == "u" else "user"
        else:
            yield emit("R", want, text)
            want = "assistant" if want == "user" else "user"
    if key is not None:
        yield from inserts()


def _rows_of(batches):
    for b in batches:
        yield from zip(b["key"], b["role"], b["text"], b["audit"])


def _streams(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Audit rows and turns of each conversation, in order."""
    none = F.lit(None).cast("string")
    heads = verdicts.select("key", F.lit(-1).cast("long").alias("at"), none.alias("role"), none.alias("text"), "audit")
    return _in_order(heads.unionByName(rows.select("key", "at", "role", "text", none.alias("audit"))), "at")


class Repair:
    """The repair of a table of turns: `verdicts` (one row per conversation), `turns()` and `digests()`."""

    def __init__(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.rows = classified(turns, conv, turn, role, text)
        pieces = stored(_pieces(self.rows), "pieces")
        self.pairs = learn_grammar(pieces)
        self.verdicts = stored(_evaluated(pieces, self.pairs), "verdicts")

    def turns(self) -> DataFrame:
        """(key, place, edit, role, text): the repaired conversations; edit is K, R or I."""
        def run(batches):
            out = []
            for x in replay(_rows_of(batches)):
                out.append(x)
                if len(out) == 4096:
                    yield pd.DataFrame(out, columns=["key", "place", "edit", "role", "text"])
                    out = []
            yield pd.DataFrame(out, columns=["key", "place", "edit", "role", "text"])
        return _streams(self.rows, self.verdicts).mapInPandas(run, "key string, place long, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """(key, repaired_sha256) of the conversations with a repaired turn: `role:text` joined by newlines."""
        def run(batches):
            key, sha, out = None, None, []
            for k, place, _, role, text in replay(_rows_of(batches)):
                if k != key:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update((("\n" if place > 1 else "") + role + ":" + text).encode("utf-8"))
                if len(out) == 4096:
                    yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
                    out = []
            if key is not None:
                out.append((key, sha.hexdigest()))
            yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
        return _streams(self.rows, self.verdicts).mapInPandas(run, "key string, repaired_sha256 string")


# ---- the query's task ------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """Turns broken by crc32(`conv_id:turn`) % 20: 0 dropped, 1 emptied, 2 without `[.!?]`, 3 repeated, 4 set to user."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                             (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("c"))
    d = d.where("c <> 0").select(
        "conv_id", "turn", F.when(F.col("c") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return d.drop("copy")


def gaps(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, gaps): turn numbers missing between a conversation's first and last; nulls are ignored."""
    seen = turns.groupBy(conv, turn).agg(F.count(F.lit(1)))
    span = F.max(turn) - F.min(turn) + 1 - F.count(turn)
    return seen.groupBy(conv).agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))


def repair_summary(original: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation of `original`: faults of `turns`, the cheapest repair and its digest."""
    fix = Repair(turns)
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("~")).alias("key")
    out = original.select("conv_id", key).distinct()
    out = out.join(gaps(turns).select(key, "gaps"), "key", "left").join(fix.verdicts, "key", "left").join(fix.digests(), "key", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
