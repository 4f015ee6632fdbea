"""What is published is what is verified; a changed row, table or column shows."""

import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kpilens.session import ensure_checkpoint_dir
from kpilens.sources import snapshot as S
from kpilens.sources.tables import SCHEMAS, Star
from tests.conftest import SF_SMALL


def new_path(spark):
    return f"{ensure_checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def tables(spark):
    return S.cut_tables(Star(spark, SF_SMALL), "2001-07-01")


@pytest.fixture(scope="module")
def path(spark, tables):
    return S.publish_snapshot(tables, new_path(spark))


def test_published_equals_manifest_and_source(spark, path, tables):
    man = S.read_manifest(spark, path)
    assert man.count() == len(SCHEMAS) == 14
    for now in (S.read_snapshot(spark, path, SCHEMAS), tables):
        rows = S.verify_snapshot(man, now).collect()
        assert len(rows) == 14 and all(r.ok for r in rows)
    back = S.read_snapshot(spark, path, SCHEMAS)["events"]
    assert dict(back.dtypes)["ts"] == "timestamp_ntz"
    assert back.filter(F.date_trunc("second", "ts") != F.col("ts")).count() == 0            # A4: to the second
    assert back.count() == tables["events"].count()


@pytest.mark.parametrize("change", ["value", "extra", "less", "column"])
def test_a_change_turns_exactly_its_table_red(spark, path, tables, change):
    c = tables["customer"]
    one = c.agg(F.min("c_custkey")).first()[0]
    edited = {"value": c.withColumn("c_name", F.when(F.col("c_custkey") == one, "Nobody").otherwise(F.col("c_name"))),
              "extra": c.unionByName(c.filter(F.col("c_custkey") == one)),
              "less": c.filter(F.col("c_custkey") != one),
              "column": c.drop("c_acctbal")}[change]
    rows = S.verify_snapshot(S.read_manifest(spark, path), dict(tables, customer=edited)).collect()
    assert {r.table_name for r in rows if not r.ok} == {"customer"}


def test_missing_table_is_red(spark, path, tables):
    some = {n: t for n, t in tables.items() if n != "labels"}
    rows = S.verify_snapshot(S.read_manifest(spark, path), some).collect()
    assert {r.table_name for r in rows if not r.ok} == {"labels"}


def test_half_written_snapshot_has_no_manifest(spark, tables):
    path = new_path(spark)
    broken = {"region": tables["region"], "nation": tables["nation"].withColumn("n_name", F.raise_error(F.lit("gone")).cast("string"))}
    with pytest.raises(Exception, match="gone"):
        S.publish_snapshot(broken, path)
    with pytest.raises(AnalysisException):
        S.read_manifest(spark, path).count()


def test_empty_table(spark, tables):
    path = S.publish_snapshot({"labels": tables["labels"].limit(0)}, new_path(spark))
    got = S.verify_snapshot(S.read_manifest(spark, path), S.read_snapshot(spark, path, {"labels": SCHEMAS["labels"]})).first()
    assert (got.manifest_rows, got.loaded_rows, got.ok) == (0, 0, True)


def test_created_or_referenced_takes_both_branches_and_nulls(spark):
    rows = [(1, "2000-01-01 00:00:00"), (2, "2000-01-02 00:00:00"), (3, None), (4, None), (5, "1999-12-31 23:59:59"),
            (None, "1999-01-01 00:00:00"), (None, None), (3, None)]
    entity = spark.createDataFrame(rows, "id long, at string").selectExpr("id", "cast(at as timestamp_ntz) as created_at")
    refs = spark.createDataFrame([(2,), (2,), (3,), (None,), (9,)], "ref long")
    got = S.created_or_referenced(entity, "2000-01-01", refs)
    assert sorted(((r.id, r.created_at) for r in got.collect()), key=repr) == sorted(
        ((r.id, r.created_at) for r in entity.where("id in (2, 3) or created_at < timestamp_ntz'2000-01-01 00:00:00'").collect()), key=repr)
    assert S.created_or_referenced(entity, "2000-01-01", refs.limit(0)).count() == 2


def test_opening_snapshot_branches_select_alone_and_use_an_existence_join(spark):
    from kpilens.plans.q_snapshot import OPENING_CUTOFF as cut, OPENING_SHIFT_DAYS as days
    star = Star(spark, "/root/testdata/sf0.01")
    owners = {r[0] for r in S.snapshot_orders(star, cut).select("user_id").distinct().collect()}
    used = {r[0] for r in S.snapshot_items(star, cut).select("product_id").distinct().collect()}
    limit = datetime.fromisoformat(cut)
    for got, all_rows, refs in ((S.opening_users(star, cut, days), S.users_with_time(star, days), owners),
                                (S.opening_inventory(star, cut), S.products_with_time(star), used)):
        assert "ExistenceJoin" in got._jdf.queryExecution().optimizedPlan().toString()
        early = {r.id for r in all_rows.collect() if r.created_at is not None and r.created_at < limit}
        kept = [r.id for r in got.collect()]
        assert len(kept) == len(set(kept)) and set(kept) == early | refs
        assert early - refs and refs - early and len(kept) < all_rows.count()


def test_cut_manifest_hashes_before_the_joins(spark, path, tables):
    star = Star(spark, SF_SMALL)
    now = S.cut_manifest(star, "2001-07-01")
    rows = S.verify_snapshot(S.read_manifest(spark, path), now).collect()
    assert len(rows) == 14 and all(r.ok for r in rows)
    want = {tuple(r) for r in S.table_manifest(tables).collect()}
    assert {tuple(r) for r in now.collect()} == want
    joined = [line for line in now._jdf.queryExecution().sparkPlan().toString().splitlines() if "Exchange" in line or "Join" in line]
    assert joined and not any("l_extendedprice" in line for line in joined)
