"""The corpus pipeline stage by stage against brute force, and the registered queries."""

import collections

from pyspark.sql import functions as F

import __spark_entry__ as se
import corpus_pipeline
from kpilens.llm.common import stored, table
from tests.conftest import SF_SMALL
from tests.llm.test_operators import WORD, brute_components, brute_lines, brute_stats, few_partitions  # noqa: F401


def test_every_operator_is_registered():
    names = set(se.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)

    def step(name, df):
        return stored(stages[name](spark, df, SF_SMALL), "test")

    good = step(names[0], docs)
    base = {r["doc_id"] for r in docs.collect() if (s := brute_stats(r["text"]))[0] >= 50 and 100 * s[4] <= 50 * s[0]}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert kept <= base and good.columns == columns
    assert all(i in kept for i in base if labels.get(i) == 1)

    lines = step(names[1], good)
    want = {i: t for i, t in brute_lines([(r["doc_id"], r["text"]) for r in good.collect()], 90).items() if WORD.search(t)}
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == want and lines.columns == columns

    single = step(names[2], lines)
    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    assert {r["doc_id"] for r in single.collect()} == {i for i, _, _, k in brute_components(rows) if k} and single.columns == columns

    mixed = step(names[3], single)
    seen = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert set(seen) == {r["doc_id"] for r in single.collect()} and max(seen.values()) <= 2 and mixed.columns == columns

    packed = step(names[4], mixed).collect()
    text = {r["doc_id"]: r["text"] for r in single.collect()}
    words = collections.Counter()
    for r in packed:
        words[r["doc_id"]] += r["n_tokens"]
    assert words == {i: n * len(WORD.findall(text[i])) for i, n in seen.items()}
    bins = collections.defaultdict(list)
    for r in packed:
        bins[r["pack_group"], r["bin"]].append(r)
    assert all(sum(r["n_tokens"] for r in b) <= 2048 for b in bins.values())
    assert all(len({r["doc_id"] for r in b}) == len(b) for b in bins.values())


def test_pipeline_on_an_empty_table_and_extra_columns(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0).withColumn("kept", F.lit(1)).withColumn("mix", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "test")
        assert docs.count() == 0 and docs.columns[-2:] == ["kept", "mix"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0


#: Names the stages use themselves, as columns of the documents.
TAKEN = ["weight", "epoch", "limit", "block_rank", "mix", "mix_", "room", "edge", "block", "full", "rest", "blocks", "n_tokens", "id", "k", "keep",
         "n_lines", "n_removed", "component_id", "n_words", "base_failed", "quality", "a.b"]


def test_pipeline_with_columns_of_taken_names(spark):
    docs = table(spark, SF_SMALL, "documents").where("doc_id < 120")
    extra = docs.select("*", *[F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")).alias(c) for c in TAKEN])
    rows = {}
    for name, frame in (("plain", docs), ("extra", extra)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, SF_SMALL), "test")
            if name == "extra":
                assert frame.columns == extra.columns
                assert frame.where(" or ".join(f"`{c}` is distinct from concat('{c}:', doc_id)" for c in TAKEN)).count() == 0
        rows[name] = sorted(map(tuple, frame.select(*docs.columns).collect()), key=repr)
        rows[name, "packed"] = corpus_pipeline.STAGES[-1][1](spark, frame, SF_SMALL).count()
    assert rows["plain"] == rows["extra"] and rows["plain", "packed"] == rows["extra", "packed"]
