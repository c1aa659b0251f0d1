"""Landings checked, merged and carried into cubes, against plain definitions."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowcubes import schemas
from flowcubes.operators import cubes, maintain
from flowcubes.operators.quality import PublishError
from order_helpers import FAILED, FF, make_orders

T0 = 1_700_006_400.0
DAY = 86400.0


def landing(spark, pages):
    return spark.createDataFrame([(p, i, lt) for p, lts in pages for i, lt in enumerate(lts)], "page long, pos int, lt string")


def found(spark, pages):
    return sorted(map(tuple, maintain.sequence_violations(landing(spark, pages)).collect()))


def test_a_sound_landing_has_no_violation(spark):
    assert found(spark, [(1, ["1", "2"]), (2, ["3"]), (3, ["10", "11", "200"])]) == []
    assert found(spark, []) == []


@pytest.mark.parametrize("pages, want", [
    ([(1, ["1", "2"]), (2, ["1", "2"])], [(2, "cursor did not advance", 2)]),
    ([(1, ["1", "5"]), (2, ["6"]), (3, ["4"])], [(3, "cursor did not advance", 1)]),
    ([(1, ["1", "1", "0"])], [(1, "not ascending in page", 2)]),
    ([(1, ["1"]), (4, ["9"])], [(4, "pages missing before", 2)]),
    ([(1, ["9"]), (2, ["10", "x"])], [(2, "lt is not a number", 1)]),
    ([(1, ["9"]), (2, [None, "8"])], [(2, "cursor did not advance", 2), (2, "lt is not a number", 1)]),
])
def test_violations_are_found(spark, pages, want):
    assert found(spark, pages) == want


@pytest.mark.parametrize("block", [2, 4096])
def test_violations_agree_with_the_whole_sequence(spark, monkeypatch, block):
    monkeypatch.setattr(maintain, "PAGES_PER_BLOCK", block)
    rng = random.Random(4)
    for _ in range(12):
        pages, at = [], 0
        for p in range(rng.randint(1, 6)):
            lts = []
            for _ in range(rng.randint(1, 4)):
                at += rng.choice([1, 1, 1, 2, 5, 0, -3]) if rng.random() < 0.3 else 1
                lts.append(str(at))
            pages.append((p, lts))
        flat = [int(x) for _, lts in pages for x in lts]
        sound = all(a < b for a, b in zip(flat, flat[1:]))
        assert (found(spark, pages) == []) == sound


def test_upsert_by_key(spark):
    held = maintain.write_bucketed(spark.createDataFrame([(str(i), "old", i) for i in range(50)], "lt string, status string, n int"), "held", 4)
    landed = spark.createDataFrame([(str(i), f"v{k}", None if i == 7 else i * 10, k) for i in range(40, 60) for k in (1, 2)] + [("7", "gone blank", None, 1)], "lt string, status string, n int, landing int")
    got = {r.lt: (r.status, r.n) for r in maintain.upserted(held, landed).collect()}
    want = {str(i): ("old", i) for i in range(40)} | {str(i): ("v2", i * 10) for i in range(40, 60)} | {"7": ("gone blank", None)}
    assert got == want and held.columns == maintain.upserted(held, landed).columns
    with pytest.raises(PublishError):
        maintain.upserted(held, landed.withColumn("lt", F.lit(None).cast("string")))
    with pytest.raises(Exception, match="order without lt"):
        maintain.write_bucketed(held.withColumn("lt", F.lit(None).cast("string")), "bad", 2).count()


def test_the_held_table_is_not_shuffled(spark):
    held = maintain.write_bucketed(spark.range(1000).selectExpr("cast(id as string) lt", "id n"), "still", 8)
    landed = spark.range(10).selectExpr("cast(id as string) lt", "-id n", "1 landing")
    before = spark.conf.get("spark.sql.sources.v2.bucketing.enabled")
    plan = maintain.upserted(held, landed)._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    lines = plan.splitlines()
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    for i in range(scan - 1, -1, -1):
        here = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        if here < depth:
            depth = here
            assert "Exchange" not in lines[i]
            if "SortMergeJoin" in lines[i]:
                break
    assert before is not None


def world(rng, n):
    return [dict(lt=str(i), src_trader_address=rng.choice(["a", "b", "c", None]), dst_chain_id=rng.choice(["bnb", "polygon"]), status=rng.choice([FF, FF, FAILED]),
                 usd=rng.randint(1, 99), order_create_time=T0 + DAY * rng.randint(0, 6), resolver_id=rng.choice(["r1", "r2", None]), integrator_fee_usd=Decimal("0.25")) for i in range(n)]


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


@pytest.mark.parametrize("table", sorted(schemas.CUBE_DIMENSIONS))
def test_a_maintained_cube_is_the_recomputed_one(spark, table):
    rng = random.Random(table)
    before = world(rng, 120)
    first = T0 + DAY * 4
    after = []
    for r in before:
        if r["order_create_time"] < first or rng.random() < 0.6:
            after.append(r)
        elif rng.random() < 0.6:
            after.append(r | dict(status=rng.choice([FF, FAILED]), usd=rng.randint(1, 99), src_trader_address=rng.choice(["a", "new"])))
    after += [r | dict(lt=str(1000 + i), order_create_time=T0 + DAY * rng.randint(4, 8)) for i, r in enumerate(world(rng, 25))]
    held, pulled_all = make_orders(spark, before), make_orders(spark, after)
    day = "2023-11-19"
    pulled = pulled_all.where(f"day >= '{day}'")
    silver, made = maintain.refresh_window(spark, held, pulled, {table: cubes.named_cube(held, table)}, day)
    assert rows(made[table]) == rows(cubes.named_cube(pulled_all, table).select(*made[table].columns))
    assert rows(silver) == rows(pulled_all.select(*silver.columns))


def test_nothing_changes_and_everything_goes(spark):
    held = make_orders(spark, world(random.Random(1), 30))
    cube = {"daily_total": cubes.daily_total(held)}
    _, made = maintain.refresh_window(spark, held, held.where("day >= '2023-11-16'"), cube, "2023-11-16")
    assert rows(made["daily_total"]) == rows(cube["daily_total"])
    silver, made = maintain.refresh_window(spark, held, held.where("false"), cube, "2000-01-01")
    assert silver.count() == 0 and made["daily_total"].count() == 0
    with pytest.raises(PublishError):
        maintain.refresh_window(spark, held, held, cube, "2023-11-17")


def test_changes_are_made_once_and_older_days_not_read(spark, monkeypatch):
    """The re-pulled days alone are counted for wallets, and whole rows are
    compared by digest."""
    seen, made_of = [], maintain.maintained_cube
    monkeypatch.setattr(maintain, "maintained_cube", lambda cube, changes, after, name: seen.append((changes, after)) or made_of(cube, changes, after, name))
    held = make_orders(spark, world(random.Random(2), 40))
    pulled = held.where("day >= '2023-11-18' and lt_num % 3 <> 0")
    _, made = maintain.refresh_window(spark, held, pulled, {"daily_total": cubes.daily_total(held)}, "2023-11-18")
    (changes, after), = seen
    assert changes.inputFiles() and after.where("day < '2023-11-18'").count() == 0
    left = held.where("day < '2023-11-18'").unionByName(pulled)
    assert rows(made["daily_total"]) == rows(cubes.daily_total(left).select(*made["daily_total"].columns))
    plan = maintain.order_changes(held, pulled).select("day", "sign")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_digest" in plan
