"""Language identification by cross-parsing entropy (operator 8).

Per language, a suffix automaton of a bounded sample of labelled text recognises every substring
of that sample. A text is parsed greedily into the longest phrases the automaton knows; texts of
the same language need fewer phrases. The phrases per character, times log2 of the sample's
length (the cost of pointing at a phrase), estimate the cross entropy; the language with the
fewest normalised phrases wins.

Texts are lower-cased; every run of non-letters is one space; the whole text is parsed, in pieces
of at most `PIECE` characters that are parsed side by side (a phrase never crosses pieces). The
greedy step and the restart after a phrase are folded into one transition table per language, so
parsing is one table lookup per character and language over thousands of pieces at once.

Every letter of any sample has a code of its own; a language's table has a column for each letter
of its sample and one for all others, which are phrases of their own there. Tables are dense up to
`DENSE_CELLS` cells over all languages; a language beyond that (large alphabets such as Chinese)
keeps only the transitions its automaton has, as a sorted array, with the same result.

Training sample (`train_docs`, `train_chars`): per language the labelled documents with the
smallest hashes of their ids, joined and cut at `train_chars` characters. That is all that reaches
the driver or is broadcast: languages x train_chars characters. Predictions read whole texts.

Edge cases: a null text or a text without a letter is `und` with score 0; without any labelled
text every document is `und`; ties go to the alphabetically first language; repeated rows are
predicted each; null ids are never trained on; other columns of the input are not read.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 256
DENSE_CELLS = 1 << 24               # cells of 4 bytes over all languages' dense tables
_NON_LETTERS = re.compile(r"[\W\d_]+")


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of `codes` (online construction)."""
    nxt, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """Greedy parse table of one language: state x symbol -> next state * 4 + phrases that ended."""

    def __init__(self, codes: np.ndarray, size: int, cells: int = DENSE_CELLS):
        """`codes` of the sample, out of `size` codes of all samples; at most `cells` cells are stored densely."""
        known = np.unique(codes)
        self.width = len(known) + 1                  # last column: a symbol the sample lacks
        self.column = np.full(size, len(known), np.int32)
        self.column[known] = np.arange(len(known))
        nxt = suffix_automaton(self.column[codes].tolist())
        root = np.zeros(self.width, np.int32)
        for c, t in nxt[0].items():
            root[c] = t
        self.start = root * 4 + (root == 0)          # at the root no phrase is open; an unknown symbol is a phrase of its own
        self.bits = np.log2(max(2, len(codes)))
        self.cells = len(nxt) * self.width
        self.table = None
        if self.cells <= cells:
            table = np.tile(self.start + 1, (len(nxt), 1)).astype(np.int32)
            for s, out in enumerate(nxt):
                for c, t in out.items():
                    table[s, c] = t * 4
            table[0] = self.start
            self.table = table.ravel()
        else:
            own = sorted((s * self.width + c, t * 4) for s, out in enumerate(nxt) if s for c, t in out.items())
            self.keys = np.array([k for k, _ in own] + [np.iinfo(np.int64).max], np.int64)
            self.steps = np.array([t for _, t in own] + [0], np.int32)

    def _step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[state * self.width + column]
        want = state.astype(np.int64) * self.width + column
        at = self.keys.searchsorted(want)
        return np.where(self.keys[at] == want, self.steps[at], self.start[column] + (state > 0))

    def phrases(self, pieces: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each row of `pieces` (sorted by falling length); the open phrase at the end counts."""
        state = np.zeros(len(pieces), np.int32)
        count = np.zeros(len(pieces), np.int32)
        alive = np.searchsorted(-lengths, -np.arange(pieces.shape[1]), side="left")
        for i in range(pieces.shape[1]):
            n = alive[i]
            if not n:
                break
            step = self._step(state[:n], self.column[pieces[:n, i]])
            count[:n] += step & 3
            state[:n] = step >> 2
        return count + (state > 0)


class Model:
    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        clean = {k: normalise(v) for k, v in samples.items()}
        letters = np.unique(np.concatenate([_points(v) for v in clean.values()] or [np.zeros(0, np.uint32)]))
        letters = letters[letters != 32]
        size = len(letters) + 2                      # 0 = space, last = a letter of no sample
        self.code = np.full(0x110000, size - 1, np.min_scalar_type(size))
        self.code[32] = 0
        self.code[letters] = np.arange(1, size - 1)
        self.parsers, left = [], DENSE_CELLS
        for k in self.langs:
            p = Parser(self.code[_points(clean[k])], size, left)
            left -= p.cells if p.table is not None else 0
            self.parsers.append(p)

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per character of each text under each language, has a letter)."""
        codes, owner, lengths = [], [], []
        letters = np.zeros(len(texts), bool)
        for t, text in enumerate(texts):
            c = self.code[_points(normalise(text))]
            letters[t] = bool(c.any())
            for a in range(0, len(c), PIECE) if letters[t] else ():
                codes.append(c[a:a + PIECE])
                owner.append(t)
                lengths.append(len(codes[-1]))
        cost = np.zeros((len(texts), len(self.langs)))
        if codes and self.langs:
            lengths = np.array(lengths)
            order = np.argsort(-lengths, kind="stable")
            grid = np.zeros((len(codes), PIECE), self.code.dtype)
            for row, k in enumerate(order):
                grid[row, :lengths[k]] = codes[k]
            grid = np.asfortranarray(grid)
            owner, lengths = np.array(owner)[order], lengths[order]
            chars = np.bincount(owner, lengths, len(texts))
            for j, p in enumerate(self.parsers):
                n = np.bincount(owner, p.phrases(grid, lengths), len(texts))
                cost[:, j] = n * p.bits / np.maximum(chars, 1)
        return cost, letters


def normalise(text: str | None) -> str:
    return _NON_LETTERS.sub(" ", (text or "").lower()).strip()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) == 2, F.lit(False))


def training_samples(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
                     train_docs: int = 60, train_chars: int = 20_000) -> dict[str, str]:
    """At most `train_chars` characters of labelled text per language."""
    usable = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    spread = F.xxhash64(F.lit(5), id_col)
    counts = usable.groupBy(lang_col).count().collect()
    top = 1 << 63
    pick = F.lit(False)
    for r in counts:      # the smallest hashes: about train_docs documents of each language
        share = min(1.0, train_docs / r["count"])
        pick = pick | ((F.col(lang_col) == r[0]) & (spread <= int(share * 2 * top) - top - (share >= 1)))
    rows = (usable.where(pick).select(F.col(lang_col).alias("lang"), F.col(text_col).substr(1, train_chars).alias("text"), spread.alias("h"))
            .orderBy("h", "text").collect())
    out: dict[str, str] = {}
    for r in rows:
        have = out.get(r["lang"], "")
        if len(have) < train_chars:
            out[r["lang"]] = (have + " " + r["text"])[:train_chars]
    return out


@functools.lru_cache(maxsize=1)
def _model(samples: tuple[tuple[str, str], ...]) -> Model:
    """Automata are built once per Python worker (a module function, so tasks share the cache)."""
    return Model(dict(samples))


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     **sample) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score (0 to 1: lead of the winner over the runner-up)."""
    samples = training_samples(docs, id_col, text_col, lang_col, **sample)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples.items())))    # languages x train_chars characters

    def run(batches):
        m = _model(shared.value)
        for whole in batches:
            for b in _bounded(whole):
                cost, letters = m.costs([t.as_py() for t in b.column("text")])
                lang, score = [], []
                for c, ok in zip(cost, letters):
                    if not ok or not m.langs:
                        lang.append("und")
                        score.append(0.0)
                        continue
                    order = np.argsort(c, kind="stable")
                    lang.append(m.langs[order[0]])
                    second = c[order[1]] if len(order) > 1 else 0.0
                    score.append(float((second - c[order[0]]) / second) if second else 1.0)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())], ["id", "held_out", "lang_pred", "score"])

    base = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return base.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _bounded(batch: pa.RecordBatch, chars: int = 2_000_000):
    """Slices of a batch with about `chars` characters each (one long text may exceed it)."""
    start = size = 0
    for i, n in enumerate(pa.compute.utf8_length(batch.column("text")).to_pylist()):
        size += n or 0
        if size >= chars:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
