"""Chat formatting: roles of raw transcripts by a hidden Markov model (operator 10).

The hidden state of a line is its role and whether it begins a turn (6 states). A line shows a
speaker marker ("User:", "### Assistant", "Q:" ...), whether it or the line before is blank, its length class and whether it asks. Start,
transition and emission probabilities are counts over all training lines, taken by Spark
aggregates of fixed size and smoothed by one.

A marker is a name with its signs: before a colon, or in brackets, or a heading line. Bare words
are none. The lexicon is learned: a role is marked in a conversation if MARKED of its turns begin
with one same token, and a token counts there if another role is marked by another token. It is a
marker if most lines anywhere that show it are turns of one role counted so; "Note:" before one
speaker's replies is text. The lexicon has one entry per speaker name, without a limit, so its
size follows the number of different names.

Viterbi runs on blocks of `BLOCK_TURNS` turn numbers of a conversation. A block of more than
`BLOCK_LINES` lines (one null id for many conversations, repeated or null turns) is cut by row
position into blocks of less than twice that, in the order of turn, text hash, row and line; only a
row with more lines than that is cut inside. Its step is associative in the (max, +)
algebra, so each block first gives a 7 x 6 matrix; a scan over a conversation's matrices fixes
the states at block borders, and every block is then decoded on its own. A conversation that
holds a third of all rows is thus many blocks, and only its small matrices meet.

Each recovered turn is rendered as `<|im_start|>role\\ncontent<|im_end|>`; a turn that a block
border cuts is rendered in pieces (`continues` marks the later ones).

Edge cases: null and empty texts are one blank line; a null conversation id is a conversation of
its own; null turns come first; rows repeated with the same turn follow each other in text order; unknown roles are not
trained on and still decoded; an empty table gives an empty result; no training rows at all make
all states equally likely.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kpilens.llm.common import stored

ROLES = ("system", "user", "assistant")
STATES = [(r, b) for r in ROLES for b in (True, False)]
BLOCK_TURNS = 256
BLOCK_LINES = 8192
BLOCK = ["conv_key", "block", "cut"]
ORDER = ["turn", "tie", "row", "line"]
# The same pattern serves Java and Python: no \\s, no $. A heading is a line of its own or ends in a colon.
_NAME = r"[^ \t\r\n:\uff1a#*<>\[\]|][^\t\r\n:\uff1a<>\[\]|]{0,63}?"
MARKER_SQL = (rf"^[ \t]*(#{{1,6}}[ \t]*{_NAME}(?:[ \t]*[:\uff1a]|(?=[ \t\r]*(?![\s\S])))|<\|?{_NAME}\|?>[:\uff1a]?"
              rf"|\[{_NAME}\][:\uff1a]?|{_NAME}[ \t]*[:\uff1a])(?: |[ \t\r]+(?![\s\S]))?")
MARKER = re.compile(MARKER_SQL)
MARKED = 0.9                        # share of a role's turns in a conversation that its marker begins
FEATURES = ("marker", "blank", "after_blank", "size", "asks")
OUT = "conv_id {id}, start_turn long, start_line int, role string, continues boolean, n_lines int, content string, rendered string"


def transcript_lines(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, line, text, role) of raw transcripts, one row per line.

    The table holds clean turns; a transcript shows them as logs do, in one of four styles by
    conversation: "User: ...", a "### Human" line of its own, "Q: ...", or nothing but a blank line
    between turns. The role column is only used to train and to test.
    """
    style = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), F.lit(4))
    names = {0: ("System: ", "User: ", "Assistant: "), 1: ("### Instructions\n", "### Human\n", "### Bot\n"), 2: ("Context: ", "Q: ", "A: ")}
    head = F.lit("")
    for s, labels in names.items():
        for role, label in zip(ROLES, labels):
            head = F.when((style == s) & (F.col("role") == role), F.lit(label)).otherwise(head)
    body = F.coalesce(F.col("text"), F.lit(""))
    tail = F.when(style == 3, F.lit("\n")).otherwise(F.lit(""))
    raw = F.concat(head, body, tail)
    d = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.xxhash64("text").alias("tie"),
                     F.monotonically_increasing_id().alias("row"), raw.alias("raw"))
    return d.select("conv_id", "turn", "role", "tie", "row", F.posexplode(F.split("raw", "\n")).alias("line", "text"))


def _in_blocks(lines: DataFrame) -> DataFrame:
    """`lines` with conv_key, block and cut. A block of many lines is sorted over all tasks, stored (so
    that a row keeps its place) and cut where the place of a row's first line passes a multiple of BLOCK_LINES."""
    d = lines if "row" in lines.columns else lines.withColumn("row", F.lit(0).cast("long"))
    d = (d.withColumn("conv_key", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")))
         .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))))
    big = stored(d.groupBy("conv_key", "block").count().where(F.col("count") > BLOCK_LINES).select("conv_key", "block"), "chat-big")
    whole = F.lit(0).cast("long")
    if big.isEmpty():
        return d.withColumn("cut", whole)
    keys = F.broadcast(big)                     # at most one for every BLOCK_LINES lines
    cut = (d.join(keys, ["conv_key", "block"], "left_semi").repartitionByRange("conv_key", "block", "turn", "tie", "row")
           .sortWithinPartitions("conv_key", "block", *ORDER).withColumn("at", F.monotonically_increasing_id()))
    cut = stored(cut.withColumn("cut", F.floor((F.col("at") - F.col("line") % BLOCK_LINES) / BLOCK_LINES)).drop("at"), "chat-cut")
    return d.join(keys, ["conv_key", "block"], "left_anti").withColumn("cut", whole).unionByName(cut)


def _marker_col(text: Column) -> Column:
    return F.lower(F.regexp_extract(text, MARKER_SQL, 1))


class Model:
    """Log probabilities of an HMM over STATES."""

    def __init__(self, start, trans, emit, markers):
        self.start, self.trans, self.emit, self.markers = start, trans, emit, markers

    def scores(self, texts: list[str], before: str | None) -> np.ndarray:
        out = np.zeros((len(texts), len(STATES)))
        prev = before
        for i, t in enumerate(texts):
            for f, v in zip(FEATURES, observe(t, prev, self.markers)):
                out[i] += self.emit[f].get(v, self.emit[f][None])
            prev = t
        return out


def marker_of(text: str, markers) -> str:
    m = MARKER.match(text)
    w = m.group(1).lower() if m else ""
    return w if w in markers else ""


def observe(text: str, before: str | None, markers) -> tuple:
    size = min(6, len(text.split()).bit_length())
    return marker_of(text, markers), not text.strip(), before is not None and not before.strip(), size, text.rstrip().endswith("?")


def speaker_markers(known: DataFrame) -> DataFrame:
    """(marker) of the training lines (conv_id, role, line, text): the tokens that tell who speaks."""
    shown = known.select("conv_id", "role", (F.col("line") == 0).alias("begins"), _marker_col(F.col("text")).alias("marker"))
    used = shown.where("begins").groupBy("conv_id", "role", "marker").agg(F.count(F.lit(1)).alias("n"))
    by_role = used.groupBy("conv_id", "role").agg(F.sum("n").alias("turns"), F.max(F.struct("n", "marker")).alias("top"))
    marked = by_role.where((F.col("top.marker") != "") & (F.col("top.n") >= MARKED * F.col("turns")))
    several = marked.groupBy("conv_id").agg(F.count_distinct("top.marker").alias("k")).where("k > 1")
    speaks = (marked.join(several, "conv_id", "left_semi").select(F.col("top.marker").alias("marker"), "role", F.col("top.n").alias("n"))
              .groupBy("marker", "role").agg(F.sum("n").alias("n")).groupBy("marker").agg(F.max("n").alias("n")).where("n > 1"))
    anywhere = shown.where("marker <> ''").groupBy("marker").agg(F.count(F.lit(1)).alias("lines"))
    return speaks.join(anywhere, "marker").where("2 * n > lines").select("marker")


def train(lines: DataFrame) -> Model:
    """Counts over all lines with a known role: aggregates whose size depends on the number of speaker names only."""
    known = lines.where(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull())
    lexicon = stored(speaker_markers(known), "chat-markers")
    markers = {r["marker"] for r in lexicon.collect()}
    # a block is one window, so no conversation's lines need to meet in one task
    known = _in_blocks(known)
    w = Window.partitionBy(*BLOCK).orderBy(*ORDER)
    m = _marker_col(F.col("text"))
    seen = stored(known.select(
        F.concat(F.col("role"), F.when(F.col("line") == 0, F.lit("+")).otherwise(F.lit("-"))).alias("state"),
        F.lag(F.concat(F.col("role"), F.when(F.col("line") == 0, F.lit("+")).otherwise(F.lit("-")))).over(w).alias("prev"),
        m.alias("token"),
        (F.trim("text") == "").alias("blank"), F.coalesce(F.trim(F.lag("text").over(w)) == "", F.lit(False)).alias("after_blank"),
        F.least(F.lit(6), F.when(F.trim("text") == "", F.lit(0)).otherwise(
            F.floor(F.log2(F.size(F.split(F.trim("text"), r"\s+")).cast("double"))) + 1)).cast("int").alias("size"),
        F.rtrim(F.col("text")).endswith("?").alias("asks"))
        .join(F.broadcast(lexicon.withColumn("token", F.col("marker"))), "token", "left").drop("token")
        .withColumn("marker", F.coalesce("marker", F.lit(""))), "chat-lines")
    names = [r + ("+" if b else "-") for r, b in STATES]
    at = {n: i for i, n in enumerate(names)}
    k = len(STATES)
    start, trans = np.ones(k), np.ones((k, k))
    for r in seen.groupBy("prev", "state").count().collect():
        if r["prev"] is None:
            start[at[r["state"]]] += r["count"]
        else:
            trans[at[r["prev"]], at[r["state"]]] += r["count"]
    for i, (_, b) in enumerate(STATES):       # inside a turn only after a line of the same role; nothing starts inside
        for j, (r2, b2) in enumerate(STATES):
            if not b2 and STATES[i][0] != r2:
                trans[i, j] = 1e-9
        if not b:
            start[i] = 1e-9
    emit = {}
    for f in FEATURES:
        table: dict = {}
        for r in seen.groupBy(F.col(f).alias("v"), "state").count().collect():
            table.setdefault(r["v"], np.ones(k))[at[r["state"]]] += r["count"]
        whole = sum(table.values(), np.ones(k))
        emit[f] = {v: np.log(c / whole) for v, c in table.items()}
        emit[f][None] = np.log(np.ones(k) / whole)
    return Model(np.log(start / start.sum()), np.log(trans / trans.sum(axis=1, keepdims=True)), emit, markers)


def transfer(scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(max, +) product of a block: entry state x state of its last line; the last row enters from the start."""
    m = np.vstack([trans, start]) + scores[0]
    for s in scores[1:]:
        m = (m[:, :, None] + trans[None, :, :]).max(axis=1) + s
    return m


def viterbi(first: np.ndarray, scores: np.ndarray, trans: np.ndarray, last: int | None = None) -> list[int]:
    """Best states of a block; `first` are the scores of entering each state, `last` its fixed final state."""
    best = first + scores[0]
    back = []
    for s in scores[1:]:
        step = best[:, None] + trans
        back.append(step.argmax(axis=0))
        best = step.max(axis=0) + s
    state = int(best.argmax()) if last is None else last
    path = [state]
    for b in reversed(back):
        state = int(b[state])
        path.append(state)
    return path[::-1]


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole blocks out of sorted batches; see the head of this file for their size."""
    held: list[pd.DataFrame] = []
    for f in frames:
        ends = (f[BLOCK] != f[BLOCK].shift()).any(axis=1).to_numpy().nonzero()[0].tolist() + [len(f)]
        for a, b in zip(ends, ends[1:]):
            part = f.iloc[a:b]
            if held and (held[-1][BLOCK].iloc[0] != part[BLOCK].iloc[0]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def parse_transcripts(lines: DataFrame, model: Model) -> DataFrame:
    """Recovered turns of raw lines (conv_id, turn, line, text, tie), one row each, rendered canonically."""
    sc = lines.sparkSession.sparkContext
    shared = sc.broadcast(model)                # a few hundred numbers
    d = _in_blocks(lines).select(*BLOCK, "conv_id", *ORDER, "text")
    blocks = d.select(*BLOCK).distinct()
    spread = blocks.groupBy("conv_key").agg(F.count(F.lit(1)).alias("k"))
    many = blocks.join(spread.where("k > 1").select("conv_key"), "conv_key", "left_semi")
    k = len(STATES)

    def matrices(frames):
        m = shared.value
        for g in _blocks(frames):
            t = transfer(m.scores(g["text"].tolist(), None), m.trans, m.start)
            yield pd.DataFrame({"conv_key": [g["conv_key"].iloc[0]], "block": [int(g["block"].iloc[0])],
                                "cut": [int(g["cut"].iloc[0])], "m": [t.ravel().tolist()]})

    def borders(pdf):
        pdf = pdf.sort_values(["block", "cut"])
        mats = [np.array(x).reshape(k + 1, k) for x in pdf["m"]]
        best, back = mats[0][k], []
        for t in mats[1:]:
            step = best[:, None] + t[:k]
            back.append(step.argmax(axis=0))
            best = step.max(axis=0)
        state, ends = int(best.argmax()), []
        for b in reversed([None, *back]):
            ends.append(state)
            state = int(b[state]) if b is not None else -1
        ends = ends[::-1]
        return pd.DataFrame({"conv_key": pdf["conv_key"].to_numpy(), "block": pdf["block"].to_numpy(), "cut": pdf["cut"].to_numpy(),
                             "entry": [-1, *ends[:-1]], "exit": ends})

    mats = (d.join(many, BLOCK, "left_semi").repartition(*BLOCK).sortWithinPartitions(*BLOCK, *ORDER)
            .mapInPandas(matrices, "conv_key string, block long, cut long, m array<double>"))
    edge = mats.groupBy("conv_key").applyInPandas(borders, "conv_key string, block long, cut long, entry int, exit int")
    full = d.join(edge, BLOCK, "left").repartition(*BLOCK).sortWithinPartitions(*BLOCK, *ORDER)

    def decode(frames):
        m = shared.value
        for g in _blocks(frames):
            texts = g["text"].tolist()
            entry, last = g["entry"].iloc[0], g["exit"].iloc[0]
            first = m.start if pd.isna(entry) or entry < 0 else m.trans[int(entry)]
            path = viterbi(first, m.scores(texts, None), m.trans, None if pd.isna(last) else int(last))
            rows = []
            turns, lns, conv = g["turn"].tolist(), g["line"].tolist(), g["conv_id"].tolist()
            for i, s in enumerate(path):
                role, begins = STATES[s]
                text = MARKER.sub("", texts[i], count=1) if begins and marker_of(texts[i], m.markers) else texts[i]
                if begins or i == 0:
                    rows.append([conv[i], turns[i], lns[i], role, not begins, [text]])
                else:
                    rows[-1][5].append(text)
            yield pd.DataFrame([(c, t, n, r, cont, len(p), body := "\n".join(p).strip("\n"), f"<|im_start|>{r}\n{body}<|im_end|>")
                                for c, t, n, r, cont, p in rows],
                               columns=[c.split()[0] for c in OUT.split(", ")])

    return full.mapInPandas(decode, OUT.format(id=lines.schema["conv_id"].dataType.simpleString()))

