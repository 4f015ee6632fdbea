"""Operator 12 against a plain program that walks every window."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from kpilens.llm import winnowing as wn


def fingerprint(text):
    """[(hash, position)] by the definition: every window, smallest hash, rightmost."""
    tokens = re.findall("[\x21-෿]{1,6}|[^\x20\x09-\x0d]", text)
    runs = []
    for i in range(max(len(tokens) - wn.K + 1, min(len(tokens), 1))):
        seed = 42
        for t in tokens[i:i + wn.K]:
            seed = xxhash.xxh64(t.encode(), seed=seed).intdigest()
        runs.append(seed & 0xFFFFFFFF)
    out = set()
    for s in range(max(len(runs) - wn.W + 1, min(len(runs), 1))):
        window = range(s, min(s + wn.W, len(runs)))
        low = min(runs[i] for i in window)
        out.add(max(i for i in window if runs[i] == low))
    return [(runs[i], i) for i in sorted(out)]


def shown(f):
    steps = [b - a for a, b in zip([-1] + [p for _, p in f], [p for _, p in f])]
    return "".join(f"{(1 << 36) | (h << 4) | s:X}" for (h, _), s in zip(f, steps))


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1], 42), signed(r[1], 7)))
    out = []
    for (i, text), (_, nxt) in zip(order, order[1:] + order[:1]):
        text, nxt = text or "", nxt or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + nxt[:cut]
        f, e = fingerprint(text), fingerprint(edited)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(f), shown(e), round(like(f, e), 9), round(like(f, fingerprint(nxt)), 9)))
    return sorted(out, key=repr)


def signed(text, seed):
    """Spark's xxhash64(text), or xxhash64(7, text): the hash of the int 7 seeds the text's."""
    start = 42 if seed == 42 else xxhash.xxh64((7).to_bytes(4, "little"), seed=42).intdigest()
    h = xxhash.xxh64((text or "").encode(), seed=start).intdigest()
    return h - (1 << 64) if h >> 63 else h


def got(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, bucket string, mult int")
    out = wn.edited_likeness(df, **more)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r[:5]) + (round(r[5], 9), round(r[6], 9)) for r in out.collect()), key=repr)


def texts(rng, n):
    words = ["alpha", "beta", "internationally", "x", "é", "数据", "गीत", "\n", "aa,", "🙂", "ไทย", "0000000000"]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 8, 9, 30, 200]))) for _ in range(n)]


def test_against_every_window(spark):
    rng = random.Random(2)
    rows = list(enumerate(texts(rng, 80))) + [(200, None), (201, ""), (202, " \n "), (203, "same " * 400), (204, "a" * 5000)]
    want = expected(rows)
    assert got(spark, rows) == want                                     # one bucket
    assert got(spark, rows, target=200) == want                         # many buckets, borders between neighbours


def test_ties_nulls_and_repeated_rows(spark):
    rng = random.Random(4)
    t = texts(rng, 40)
    rows = [(5, x) for x in t] + [(None, x) for x in t[:6]] + [(9, "again and again and once more for good")] * 60 + [(3, None)] * 2 + [(1, "end of it")]
    rows = list(dict.fromkeys(rows[:46])) + rows[46:]
    assert got(spark, rows, target=300) == expected(rows)


def test_small_tables(spark):
    for rows in ([], [(1, "only this one document is here")], [(1, "twice the very same row")] * 2, [(None, None)]):
        assert got(spark, rows) == expected(rows)


def test_shared_passage_is_always_found(spark):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        words = ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(wn.K + wn.W - 1)]
        def some():
            return ["".join(rng.choice("uvwxyz") for _ in range(5)) for _ in range(rng.randint(0, 30))]
        rows.append((" ".join(some() + words + some()), " ".join(some() + words + some())))
    df = spark.createDataFrame(rows, "a string, b string")
    h = [F.transform(wn.winnow(F.col(c)), lambda x: x["hash"]) for c in "ab"]
    assert df.where(F.size(F.array_intersect(*h)) == 0).count() == 0
