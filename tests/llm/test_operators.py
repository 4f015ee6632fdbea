"""The training-data operators against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import os
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
if ROOT not in os.environ.get("PYTHONPATH", "").split(os.pathsep):      # Python workers import the package too
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

from kpilens.llm import (chat, components, exact_dedup, html_pages, html_tree, language, line_dedup, minmax, mixing,  # noqa: E402
                         packing, quality, warc)
from kpilens.llm.common import table, word_count  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
A = "the quick brown fox jumps over the lazy dog near the old river bank while seven small birds watch it from a tall tree and sing"


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, bands int")


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables here are tiny: two shuffle partitions instead of the session's."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, white space, a very long text, copies, repeated rows, a null id, clashing column names."""
    texts = [None, "", " \t\n ", "one", "one two", A, A, A + " x", A.upper(), LONG, LONG + " tail", "a b c a b c a b c",
             "x\n\nx\ny z\n x", "café  naïve # $ | <b>", "line\r\nline\r\n", A]
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", "k", i) for i, t in enumerate(texts)]
    rows += [rows[5], rows[1], (None, A, "en", "s1", "k", 0), (None, None, None, None, None, None)]
    return docs_frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_frame(spark, [])


def small(spark, name="documents"):
    return table(spark, SF_SMALL, name)


# 1 mixing ------------------------------------------------------------------------------------------------

def test_mixing_meets_the_repetition_limit_and_the_entropy(spark):
    docs = small(spark)
    totals = mixing.source_totals(docs.select("source", word_count(F.col("text")).alias("n_tokens")))
    share = np.array([r["share"] for r in totals.collect()])
    a = mixing.temperature(totals, max_repeat=1.5)
    spread = (share ** (a - 1)).max() / (share ** (a - 1)).min()
    assert spread == pytest.approx(1.5, rel=1e-6)
    half = -(share * np.log(share)).sum() * 0.5 + np.log(len(share)) * 0.5
    b = mixing.temperature(totals, target_entropy=half)
    p = share ** b / (share ** b).sum()
    assert -(p * np.log(p)).sum() == pytest.approx(half, rel=1e-6)
    assert mixing.temperature(totals) == 1.0


def test_mixing_realises_budgets(spark):
    docs = small(spark).select("doc_id", "source", "text")
    rows = mixing.mix(docs, max_repeat=2.0, block_tokens=2000).select("doc_id", "source", "mix.*").collect()
    seen = collections.Counter(r["doc_id"] for r in rows)
    assert set(seen) == {r["doc_id"] for r in docs.select("doc_id").collect()} and max(seen.values()) <= 2
    assert len({(r["doc_id"], r["epoch"]) for r in rows}) == len(rows)
    by = collections.defaultdict(lambda: [0, 0, 0.0])
    longest = collections.Counter()
    for r in rows:
        by[r["source"]][0] += r["n_tokens"]
        by[r["source"]][2] = r["weight"]
        longest[r["source"]] = max(longest[r["source"]], r["n_tokens"])
    total = max(t / w for t, _, w in by.values())
    for s, (t, _, w) in by.items():
        assert t <= round(w * total) + 1 and t >= w * total - longest[s] - 1


def test_mixing_with_a_budget_and_odd_rows(spark, odd, empty):
    few = mixing.mix(odd, budget=20_000, max_repeat=None, target_entropy=None, block_tokens=1 << 12).collect()
    assert sum(r["mix"]["n_tokens"] for r in few) <= 20_000 + 3
    full = mixing.mix(odd, max_repeat=2.0)
    assert full.columns == odd.columns + ["mix"]
    got = collections.Counter((r["doc_id"], r["source"]) for r in full.collect())
    want = collections.Counter((r["doc_id"], r["source"]) for r in odd.collect())
    assert all(want[k] <= got[k] <= 2 * want[k] for k in want) and set(got) == set(want)
    assert mixing.mix(empty).count() == 0


# 2 WARC --------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    big = "<p>" + "äb" * 600 + "</p>"
    rows = [(1, "u1", big), (2, "u2", big), (3, None, big), (4, "u4", None), (5, "u5", ""), (6, "u6", "short"), (7, "u7", "short"),
            (8, "u8", "x" * 1000), (9, "a\nb", "x" * 1000), (9, "a\nb", "x" * 1000), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 90)]
    pages = spark.createDataFrame([(i, u, h, 0) for i, u, h in rows], "page_id long, url string, html string, payload int").repartition(3)
    got = sorted(tuple(r) for r in warc.round_trip(pages).collect())
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = max(k for k, _, g in rows if (g or "") == (h or ""))
        kind = "revisit" if len(b) >= 1000 and i != top else "response"
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), kind, top if kind == "revisit" else None))
    assert got == sorted(want)


def test_warc_index_reads_selected_ranges(spark, tmp_path):
    pages = small(spark, "pages")
    index = warc.write_archives(pages, str(tmp_path / "arc"))
    some = {r["page_id"]: r["payload"] for r in warc.read_records(index.where("page_id % 7 = 3")).collect()}
    want = {r["page_id"]: r["html"].encode() for r in pages.where("page_id % 7 = 3").collect()}
    assert {k: bytes(v) for k, v in some.items()} == want
    reads = list(warc.coalesce_ranges([(0, 10), (12, 5), (100, 5), (104, 4)], gap=4, most=50))
    assert reads == [(0, 17, [0, 1]), (100, 108, [2, 3])]
    assert warc.round_trip(pages.limit(0)).count() == 0


# 3 packing -----------------------------------------------------------------------------------------------

def brute_best_fit(items, capacity):
    bins, out = [], []
    for n, s, c in items:
        fit = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and not (b[1] & s or b[2] & c)]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append([capacity, 0, 0])
        out.append((i, capacity - bins[i][0]))
        bins[i] = [bins[i][0] - n, bins[i][1] | s, bins[i][2] | c]
    return out


def test_best_fit_is_the_sequential_rule():
    rng = np.random.default_rng(4)
    for hot in (0.0, 0.7):
        items = [(int(rng.integers(1, 200)), 1 << (0 if rng.random() < hot else int(rng.integers(0, 9))),
                  0 if rng.random() < 0.6 else 1 << int(rng.integers(0, 5))) for _ in range(600)]
        assert packing.best_fit(items, 256) == brute_best_fit(items, 256)


def test_packing_invariants(spark, odd, empty):
    docs = small(spark).unionByName(odd.drop("kept", "bands").withColumn("n_chars", F.lit(0)))
    rows = packing.pack(docs, word_count(F.col("text")), F.xxhash64("text"), capacity=512, group_tokens=20_000).collect()
    want = collections.Counter()
    for r in docs.collect():
        want[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    got = collections.Counter()
    bins = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        if r["n_tokens"]:
            bins[r["pack_group"], r["bin"]].append(r)
        else:
            assert r["bin"] is None
    assert +got == +want and len(bins) > 10
    meta = {r["doc_id"]: (r["source"], r["text"]) for r in small(spark).collect()}
    for rs in bins.values():
        rs.sort(key=lambda r: r["bin_offset"])
        end = 0
        for r in rs:
            assert r["bin_offset"] == end
            end += r["n_tokens"]
        assert end <= 512
        known = [meta[r["doc_id"]] for r in rs if r["doc_id"] in meta and r["doc_id"] > 20]
        assert len({s for s, _ in known}) == len(known) == len({t for _, t in known})
    assert packing.pack(empty, word_count(F.col("text")), F.xxhash64("text")).count() == 0


# 4 quality -----------------------------------------------------------------------------------------------

def brute_stats(t):
    t = t or ""
    ws = WORD.findall(t)
    win = collections.Counter(zip(ws, ws[1:], ws[2:]))
    hit = {j for i in range(len(ws) - 2) if win[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_counts(spark, odd):
    both = small(spark).select("doc_id", "text").union(odd.select("doc_id", "text"))
    for r in quality.with_stats(both, "text", "s").select("text", "s.*").collect():
        assert tuple(r[c] for c in COUNTS) == brute_stats(r["text"])


def test_repeats_by_the_slow_path(spark, odd, monkeypatch):
    monkeypatch.setattr(quality, "MASK", 2)               # texts of three words count as too long for the packed keys
    rows = quality.with_stats(odd.where("length(text) < 1000"), "text", "s").select("text", "s.*").collect()
    assert rows and all(r["n_repeat_words"] == brute_stats(r["text"])[4] for r in rows)


def test_learned_rules_find_the_bad_rows(spark, odd, empty):
    docs, labels = small(spark), small(spark, "labels")
    out, rules = quality.quality_verdicts(docs, labels)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == 200
    for r in rows.values():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    good = [rows[r["doc_id"]] for r in labels.where("quality = 1").collect()]
    assert sum(not g["kept"] and not g["base_failed"] for g in good) <= 0.02 * len(good)
    none = spark.createDataFrame([], labels.schema)
    free, no_rules = quality.quality_verdicts(odd, none)
    assert no_rules == [] and all(r["kept"] != r["base_failed"] for r in free.collect())
    assert quality.keep_good(odd, none).columns == odd.columns
    assert quality.quality_verdicts(empty, labels)[0].count() == 0


def test_covering_grows_a_conjunction(spark):
    rng = np.random.default_rng(1)
    rows = [[float(x) for x in rng.random(len(quality.FEATURES))] for _ in range(900)]
    data = [(*r, int(r[0] >= 0.7 and r[3] < 0.4), i % 3) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"{f} double" for f in quality.FEATURES) + ", bad int, fold int")
    rules = quality.learn_rules(df, per_class=32)
    used = {(n, op) for n, op, _ in rules[0].conditions}
    assert used == {("symbols_per_word", ">="), ("word_length", "<")} and rules[0].good <= 0.2 * rules[0].bad


# 5 exact dedup -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("chars", [64, 1])
def test_exact_dedup(spark, odd, chars):
    docs = small(spark).select("doc_id", "text").union(odd.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 500))
    half = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True))
    got = exact_dedup.exact_dedup(docs.where(half), docs.where(~half), bucket_keys=32, digest_chars=chars).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    group = collections.defaultdict(list)
    for i, t in rows:
        group[t].append(i)
    want = []
    for i, t in rows:
        top = max((x for x in group[t] if x is not None), default=None)
        want.append((i, top, len(group[t]), i == top, hashlib.sha256(t.encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_exact_dedup_with_an_empty_side(spark, odd, empty):
    a = exact_dedup.exact_dedup(empty, odd).select("doc_id", "keep_id", "group_size").collect()
    b = exact_dedup.exact_dedup(odd, empty).select("doc_id", "keep_id", "group_size").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(a, key=key) == sorted(b, key=key) and len(a) == odd.count()


@pytest.mark.parametrize("n", [0, 1, 2, 17, 1000, 30_000])
def test_fuse_filter_has_no_false_negative(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(1 << 62), 1 << 62, n)
    f = exact_dedup.build_filter(keys)
    assert exact_dedup.probe(keys, *f).all()
    others = rng.integers(-(1 << 62), 1 << 62, 100_000)
    assert exact_dedup.probe(others, *f).mean() < 0.001


# 6 HTML --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tree():
    return html_tree.TreeModel(html_pages.PAGES)


def test_html_marginals_are_exact(tree):
    d = html_tree.Dom("<div><p>One.</p><div class='ad'><a>x</a></div></div>")
    feats = [d.features(i) for i in range(len(d.tag))]
    weight = collections.Counter()
    for s in itertools.product((0, 1), repeat=len(d.tag)):
        if s[0]:
            continue
        e = sum(sum(tree.node.get(f, 0.0) for f in feats[i]) * s[i] + tree.edge[s[d.parent[i]]][s[i]] for i in range(1, len(s)))
        for i, x in enumerate(s):
            weight[i, x] += np.exp(e)
    for i, b in enumerate(tree.marginals(d)):
        assert b == pytest.approx(weight[i, 1] / (weight[i, 0] + weight[i, 1]), abs=1e-6)


def test_html_held_out_layouts(tree):
    s = "The old mill stands by the river, and people still bring their grain to it every autumn."
    page = (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a><li><a href='/x'>More</a></ul></nav>"
            f"<div class='ad'>{s}</div><article><h1>Mill &amp; river</h1><p>{s}  <b>x</b>&nbsp;y\n z</p><p>Of.</p><script>var t='</p>';</script>"
            f"</article><section class='comments'><p>Nice one, I liked it a lot.</p></section><form><p>Mail</p></form><footer>&copy; {s}</footer></body></html>")
    assert tree.main_text(page) == f"Mill & river\n{s} x y z\nOf."
    assert tree.main_text(None) == tree.main_text("") == tree.main_text("<nav>a</nav>") == ""
    assert isinstance(tree.main_text("<div>" * 20_000 + "x"), str)
    hit = all_ = 0
    for p in html_pages.PAGES:                       # leave one page out
        model = html_tree.TreeModel([q for q in html_pages.PAGES if q != p], epochs=60)
        want = html_tree.Dom(p)
        lab = []
        for i in range(len(want.tag)):
            lab.append(int(want.label[i]) if want.label[i] in ("0", "1") else (lab[want.parent[i]] if i else 0))
        belief = model.marginals(want)
        for node, parts in want.blocks:
            if "".join(parts).strip():
                hit += (belief[node] >= 0.5) == bool(lab[node])
                all_ += 1
    assert hit / all_ > 0.85


def test_html_without_head_end_with_closed_svg_and_without_tags(tree):
    s = "The old mill stands by the river, and people still bring their grain to it every autumn."
    body = f"<article><h1>Mill</h1><p>{s}</p><p>{s}</p></article><footer>&copy; x</footer>"
    want = f"Mill\n{s}\n{s}"
    for head in ("<head><title>t</title><body>", "<head><meta charset=x><title>t</title>", "<head><noscript><img src=x></noscript><script>a</script>",
                 "<head><noscript><body>", "<head><title>t</title></head><body><head>", "<head></head><body>"):
        assert tree.main_text(f"<!doctype html>\n<html>{head}{body}") == want, head
    assert tree.main_text(f"<html><head><title>t</title>{s}") == tree.main_text(f"<html>{s}")
    for icon in ("<svg class='i'/>", "<svg><path d='M0'/><g/></svg>", "<math/>", "<svg><title/><path/></svg>"):
        assert tree.main_text(f"<html><body><article><h1>{icon}Mill</h1>{icon}<p>{icon}{s}</p><p>{s}</p></article></body></html>") == want, icon
    assert tree.main_text(s) == s and tree.main_text(f"\n{s} <b>Bold</b> &amp; so on.\n") == f"{s} Bold & so on."
    loose = tree.main_text(f"<nav><a href='/'>a</a></nav>{s}<nav><a href='/'>b</a></nav>{s} {s}")
    assert loose == f"{s}\n{s} {s}"


def test_html_table(spark):
    pages = small(spark, "pages").select("page_id", "url", "html").union(spark.createDataFrame([(-1, None, None), (-2, "u", "")], "a long, b string, c string"))
    rows = html_tree.extract_text(pages).collect()
    assert len(rows) == pages.count() and all(r["n_chars"] == len(r["text"]) for r in rows)
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    right = 0
    for r in rows:
        body = re.search("<article>(.*?)(</article>|$)", html[r["page_id"]] or "", re.S)
        words = " ".join(re.sub("<[^>]+>", " ", body[1]).split()) if body else ""
        right += " ".join(r["text"].split())[:200] == words.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")[:200]
    assert right >= 0.9 * len(rows)


# 7 line dedup --------------------------------------------------------------------------------------------

def brute_lines(rows, percent):
    """Texts in (id, hash-free) order with later similar lines removed; ids are distinct."""
    seen, index, out = [], collections.defaultdict(list), {}
    for i, t in sorted(rows):
        keep = []
        for line in t.split("\n"):
            s = frozenset(WORD.findall(line))
            if not s:
                keep.append(line)
                continue
            common = collections.Counter(j for w in s for j in index[w])
            if not any(100 * c >= percent * (len(s) + len(seen[j]) - c) for j, c in common.items()):
                keep.append(line)
            for w in s:
                index[w].append(len(seen))
            seen.append(s)
        out[i] = "\n".join(keep)
    return out


@pytest.mark.parametrize("percent", [90, 60])
def test_line_dedup(spark, percent):
    extra = [(10_000 + i, "\n".join(" ".join(w if (i * 7 + k * 3 + n) % 11 else f"v{i}" for n, w in enumerate(A.split())) for k in range(3)))
             for i in range(12)]
    docs = small(spark).select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, percent=percent).collect()}
    want = brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()], percent)
    assert got == want


def test_line_dedup_shuffles_words_as_one_string(spark, monkeypatch):
    """The entries of the join that verifies carry their line's words once as a string, not an array of strings each."""
    words = [f"w{i}é" for i in range(20)]
    seps = ["\t", "  ", "\v ", "\r", "\f", " "]
    rows = [(i, "\n".join([sep.join(words[:-1] + [f"x{i}"]) + sep, sep + sep.join(words[i:]) + " y" * i, "", sep]))
            for i, sep in enumerate(seps)]
    seen, pairwise = [], line_dedup._pairwise
    monkeypatch.setattr(line_dedup, "_pairwise", lambda entries, *args: seen.append(dict(entries.dtypes)) or pairwise(entries, *args))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_lines(rows, 90)
    assert len(seen) == 2 and not any(kind.startswith("array") for kinds in seen for kind in kinds.values())


def test_line_dedup_odd_rows(spark, odd, empty):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[0]["text"] is None and by[1]["text"] == "" and by[2]["text"] == " \t\n "
    assert by[12]["text"] == "x\n\ny z" and by[12]["n_removed"] == 2
    assert by[14]["text"] == "line\r\n"
    assert [r["text"] for r in rows if r["doc_id"] is None and r["lang"]] == [A] and by[5]["text"] == by[6]["text"] == ""
    assert line_dedup.dedup_lines(empty).count() == 0


# 8 language ----------------------------------------------------------------------------------------------

def test_cross_parse_is_greedy():
    train = "abracadabra alakazam " * 3
    m = language.Model({"x": train, "y": "zzyzx road " * 5})
    for j, sample in enumerate((train, "zzyzx road " * 5)):
        codes = "".join(chr(c + 65) for c in m.code[language._points(language.normalise(sample))])
        for text in ("abra kazam road", "zzyzx", "qqq abra", "a", "road of abracadabra 中"):
            q = "".join(chr(c + 65) for c in m.code[language._points(language.normalise(text))])
            n = i = 0
            while i < len(q):
                k = i
                while k < len(q) and q[i:k + 1] in codes:
                    k += 1
                n, i = n + 1, max(k, i + 1)
            pts = m.code[language._points(language.normalise(text))]
            assert m.parsers[j].phrases(pts[None, :], np.array([len(pts)]))[0] == n


def test_language_prediction(spark, odd, empty):
    docs = small(spark)
    rows = language.predict_language(docs).collect()
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 200 and held and sum(r["lang_pred"] == want[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    got = language.predict_language(odd).collect()
    assert len(got) == odd.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 1, 2)} == {"und"}
    none = language.predict_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and language.predict_language(empty).count() == 0


def test_languages_of_large_alphabets(monkeypatch):
    rng = np.random.default_rng(8)
    letters = [chr(0x4E00 + i) for i in range(1500)] + [chr(0x0430 + i) for i in range(32)] + [chr(0x03B1 + i) for i in range(17)]

    def speak(words, n):
        return " ".join(words[i] for i in rng.integers(0, len(words), n))

    tongues = {k: ["".join(rng.choice(letters, rng.integers(2, 5))) for _ in range(1500)] for k in ("a", "b", "c")}
    samples = {k: speak(w, 4000) for k, w in tongues.items()}
    texts = [(k, speak(w, 12)) for k, w in tongues.items() for _ in range(40)]
    thin = language.Model(samples)
    assert any(p.table is None for p in thin.parsers)
    cost, ok = thin.costs([t for _, t in texts])
    assert ok.all() and all(thin.langs[int(c.argmin())] == k for c, (k, _) in zip(cost, texts))
    monkeypatch.setattr(language, "DENSE_CELLS", 1 << 40)       # both kinds of table give the same parse
    short = {k: v[:1500] for k, v in samples.items()}
    dense = language.Model(short)
    monkeypatch.setattr(language, "DENSE_CELLS", 0)
    sparse = language.Model(short)
    assert all(p.table is not None for p in dense.parsers) and all(p.table is None for p in sparse.parsers)
    odd = [t for _, t in texts] + ["", "abc 中 я", samples["b"][:3000]]
    assert np.array_equal(dense.costs(odd)[0], sparse.costs(odd)[0])


# 9 near duplicates ---------------------------------------------------------------------------------------

def brute_components(rows, percent=85):
    sets = []
    for _, t in rows:
        ws = (t or "").encode().lower().split()
        sets.append({tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        c = len(sets[i] & sets[j])
        if c and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            up[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(s), low[find(k)], i == low[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates(spark, odd):
    rng = np.random.default_rng(3)
    vocab = [f"t{i}" for i in range(5000)]
    base = [vocab[i] for i in rng.integers(0, 5000, 300)]
    rows = []
    for k in range(60):                              # a crowd around one text, some too far from it and from each other
        w = list(base)
        for at in rng.integers(0, 300, 3 + k % 12):
            w[at] = f"e{k}"
        rows.append((1000 + k, " ".join(w)))
    step = list(base)
    for k in range(8):                               # a chain: each close to the next only
        for at in range(k * 6, k * 6 + 6):
            step[at] = f"c{k}"
        rows.append((2000 + k, " ".join(step)))
    rows += [(r["doc_id"], r["text"]) for r in small(spark).collect()]
    rows += [(3000 + i, r["text"]) for i, r in enumerate(odd.collect())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minmax.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


def test_near_duplicates_odd_rows(spark, odd, empty):
    got = minmax.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert all(r["n_shingles"] == 0 and r["kept"] for r in got if r["doc_id"] in (0, 1, 2))
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["n_shingles"]] == [5]
    assert minmax.keep_one_of_each(odd).columns == odd.columns
    assert minmax.near_duplicates(empty).count() == 0


def test_near_duplicates_keep_one_row_of_each(spark):
    other = " ".join(f"k{i}" for i in range(40))
    third = " ".join(f"m{i}" for i in range(40))
    rows = [(7, A, "a"), (7, A, "a"), (7, A, "b"), (8, A + " x", "a"), (3, other, "a"), (3, third, "a"), (1, third, "a"), (9, A, "a")]
    rows += [(None, "n " + other[::-1], "a")] * 3 + [(5, "", "a")] * 2 + [(None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in minmax.keep_one_of_each(docs).collect()]
    words = sorted((r[0] or 0, r[1]) for r in got if r[1])
    assert words == sorted([(7, A), (3, other), (1, third), (0, "n " + other[::-1])])
    assert sum(not r[1] for r in got) == 3


def test_signature_estimates_jaccard():
    a = minmax.shingle_set(" ".join(f"w{i}" for i in range(3000)))
    b = minmax.shingle_set(" ".join(f"w{i}" for i in range(1000, 4000)))
    j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = np.concatenate([x == y for x, y in zip(minmax.min_max(a), minmax.min_max(b))])
    assert abs(same.mean() - j) < 0.15
    assert int(np.bitwise_count((minmax.parity(a) ^ minmax.parity(b)).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert all(got.get(x, x) == find(x) for x in linked)


# 10 chat -------------------------------------------------------------------------------------------------

def test_chat_recovers_roles(spark):
    turns = table(spark, SF_SMALL.replace("0.001", "0.01"), "conversations")
    lines = chat.transcript_lines(turns)
    model = chat.train(lines.where("conv_id % 2 = 0"))
    got = chat.parse_transcripts(lines, model).collect()
    want = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in turns.collect() if r["conv_id"] % 2}
    right = [want.get((r["conv_id"], r["start_turn"])) == (r["role"], r["content"]) for r in got if r["conv_id"] % 2 and r["start_line"] == 0]
    assert sum(right) >= 0.85 * len(want)
    assert all(r["rendered"] == f"<|im_start|>{r['role']}\n{r['content']}<|im_end|>" for r in got)


def test_chat_blocks_give_the_whole_viterbi_path(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    rows = [(1, t, ("user", "assistant")[t % 2], f"text {t} is this?" if t % 2 == 0 else f"text {t}\nmore of it\n\nend") for t in range(42)]
    rows += [(2, 0, None, None), (2, 1, "user", ""), (None, 0, "user", "hi"), (1, 41, "odd", "again"), (3, 0, "user", A * 30)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = chat.transcript_lines(turns)
    model = chat.train(lines)
    got = chat.parse_transcripts(lines, model).where("conv_id = 1").collect()
    raw = lines.where("conv_id = 1").orderBy("turn", "tie", "line").collect()
    scores = np.concatenate([model.scores([r["text"] for r in g], None)
                             for _, g in itertools.groupby(raw, key=lambda r: r["turn"] // 4) for g in [list(g)]])
    path = chat.viterbi(model.start, scores, model.trans)
    begins = {(r["turn"], r["line"]): chat.STATES[s][0] for r, s in zip(raw, path) if chat.STATES[s][1]}
    assert {(r["start_turn"], r["start_line"]): r["role"] for r in got if not r["continues"]} == begins
    assert sum(r["n_lines"] for r in got) == len(raw)
    assert chat.parse_transcripts(lines.limit(0), chat.train(lines.limit(0))).count() == 0


def test_chat_keeps_text_that_only_looks_like_a_marker(spark):
    rows, want = [], {}
    for c in range(240):
        for t in range(6):
            role = ("user", "assistant")[t % 2]
            text = ("Thanks", "Note: keep it")[t % 2] if t > 1 else (f"what is thing {c} about?", f"It is number {c}.")[t]
            rows.append((c, t, role, text))
            want[c, t] = text
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = chat.transcript_lines(turns)
    style = {r["conv_id"]: r["s"] for r in turns.select("conv_id", F.expr("crc32(string(conv_id)) % 4 AS s")).distinct().collect()}
    model = chat.train(lines)
    assert {"user:", "assistant:", "q:", "a:", "### human", "### bot"} <= model.markers
    assert not any(m.startswith(("thanks", "note")) for m in model.markers)
    text = collections.defaultdict(str)
    for r in chat.parse_transcripts(lines, model).orderBy("conv_id", "start_turn", "start_line").collect():
        text[r["conv_id"]] += r["content"] + "\n"
    for c in range(240):
        if style[c] == 3:
            assert [x for x in text[c].split("\n") if x] == [want[c, t] for t in range(6)]


def test_chat_learns_every_speaker_name(spark):
    names = ["用户", "助手", "Олег", "Dr. O'Neil 2", *(f"name {i}" for i in range(96))]
    rows = [(p, t, ("user", "assistant")[t % 2], line, x) for p in range(50) for t in range(6)
            for line, x in enumerate((f"{names[2 * p + t % 2]}: line {t}", "more"))]
    model = chat.train(spark.createDataFrame(rows, "conv_id long, turn long, role string, line int, text string")
                       .withColumn("tie", F.xxhash64("text")))
    assert model.markers == {n.lower() + ":" for n in names}


def test_chat_blocks_are_bounded_whatever_the_turns(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_LINES", 16)
    rows = [(None, i % 5, ("user", "assistant")[i % 2], f"text {i % 50} is this?\nyes") for i in range(300)]
    rows += [(1, 7, "user", "same") for _ in range(200)] + [(2, None, "user", f"no {i}") for i in range(100)]
    rows += [(3, 0, "user", "\n".join(f"l{i}" for i in range(100)))] + [(4, t, "user", "hi") for t in range(4)]
    lines = chat.transcript_lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    dealt = chat._in_blocks(lines)
    assert dealt.groupBy(*chat.BLOCK).count().agg(F.max("count")).first()[0] < 2 * chat.BLOCK_LINES
    place = F.struct("block", "cut").alias("p")      # blocks follow the order of the lines
    for c in dealt.select("conv_key", place, F.struct(*chat.ORDER).alias("o")).groupBy("conv_key", "p").agg(
            F.min("o").alias("lo"), F.max("o").alias("hi")).withColumn("after", F.expr(
                "lag(hi) OVER (PARTITION BY conv_key ORDER BY p)")).where("after IS NOT NULL").select((F.col("after") < F.col("lo")).alias("ok")).collect():
        assert c["ok"]
    model = chat.train(lines)
    assert chat.parse_transcripts(lines, model).agg(F.sum("n_lines")).first()[0] == lines.count()
