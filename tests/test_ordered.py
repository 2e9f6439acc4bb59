import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from riskspark.plans import below_cut, exact_quantiles, hash_cut_table, lowest_hash_cuts, ordered_cumsum, split_points
from riskspark.plans import ordered as O


@pytest.fixture(scope="module")
def values(spark):
    # a third of the rows hold one value
    table = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0.5D ELSE CAST((id * 7919) % 1009 AS DOUBLE) / 1009 END AS x",
        "CASE WHEN id % 7 < 3 THEN 'a' ELSE 'b' END AS k",
    )
    return table.persist()


def cumsum(values, **kw):
    sums = {"n": F.lit(1), "odd": F.col("id") % 2}
    return sorted(rows(ordered_cumsum(values, "x", sums, ["k"], **kw)))


def test_buckets_do_not_change_the_answer(values):
    one = cumsum(values, buckets=1)
    assert one == cumsum(values, cuts=O.Sketch([0.1, 0.2, 0.5, 0.9]))
    # repeated points: the value 0.5 is collapsed first
    assert one == cumsum(values, cuts=O.Sketch([0.1, 0.5, 0.5, 0.5, 0.9]))
    assert one == cumsum(values, cuts=O.Sketch([-5.0, 0.3, 7.0]))
    # many rows per value: all ties are collapsed first
    assert one == cumsum(values, cuts=O.Sketch([0.1, 0.5, 0.5, 0.9], 10.0))
    assert one == cumsum(values)


def test_totals_by_shuffled_join(values, monkeypatch):
    one = cumsum(values, buckets=1)
    monkeypatch.setattr(O, "LITERAL_ROWS", 2)
    monkeypatch.setattr(O, "as_literal", lambda t, most=2: t)
    assert one == cumsum(values, cuts=O.Sketch([0.1, 0.2, 0.5, 0.9]))


def test_against_numpy(values):
    x = np.array([r.x for r in values.where("k = 'a'").collect()])
    found = [r for r in cumsum(values, cuts=O.Sketch([0.25, 0.75])) if r[0] == "a"]
    distinct, counts = np.unique(x, return_counts=True)
    assert [r[1] for r in found] == distinct.tolist()
    assert [r[2] for r in found] == counts.tolist()
    assert [r[4] for r in found] == np.cumsum(counts).tolist()
    assert [r[8] for r in found] == [*distinct[1:].tolist(), None]


def test_null_and_nan_are_left_out(spark):
    table = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,)], "x double")
    assert len(rows(ordered_cumsum(table, "x", {"n": F.lit(1)}, cuts=O.Sketch([1.5])))) == 2


def test_no_row_window_without_a_bucket(values):
    plan = ordered_cumsum(values, "x", {"n": F.lit(1)}, cuts=O.Sketch([0.2, 0.4]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text


def test_split_points_balance_and_flag_heavy_values(values):
    points = split_points(values, "x", 10, share=1.0)
    assert len(points) == 9 and points == sorted(points)
    assert O.heavy_values(points) == [0.5]
    # values are counted per input partition, so the ratio is never overstated
    assert 1.0 < O.sketch(values, "x", 10, share=1.0).rows_per_value <= 3000 / 1001
    tied = values.withColumn("x", F.col("x") > 0.5).withColumn("x", F.col("x").cast("double"))
    assert O.sketch(tied, "x", 10, share=1.0).rows_per_value > O.COLLAPSE_FROM
    assert O.heavy_values(split_points(values.where("x <> 0.5"), "x", 10, share=1.0)) == []


@pytest.mark.parametrize("buckets", [1, 7])
def test_exact_quantiles(values, buckets, monkeypatch):
    monkeypatch.setattr(O, "SKETCH_SHARE", 1.0)
    fractions = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {(r.k, r.fraction): r.quantile for r in exact_quantiles(values, "x", fractions, ["k"], buckets).collect()}
    for k in "ab":
        x = [r.x for r in values.where(F.col("k") == k).collect()]
        for f in fractions:
            assert found[k, f] == pytest.approx(np.quantile(x, f), abs=1e-12)


def test_quantiles_of_nothing(spark):
    assert rows(exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5])) == []


def test_hash_cuts_are_exact_and_stable(values):
    cuts = lowest_hash_cuts(values, "id", lambda t: {c: n // 3 for c, n in t.items()}, by="k")
    chosen = values.where(below_cut(cuts, "id", by="k"))
    sizes = dict(rows(chosen.groupBy("k").count()))
    assert sizes == {c.cls: c.class_rows // 3 for c in cuts}
    again = values.repartition(13).where(below_cut(cuts, "id", by="k"))
    assert sorted(rows(again, "id")) == sorted(rows(chosen, "id"))


def test_large_cells_are_divided_again(values, monkeypatch):
    from riskspark.plans import cuts

    half = lambda totals: {c: n // 2 for c, n in totals.items()}
    one = lowest_hash_cuts(values, "id", half, by="k")
    monkeypatch.setattr(cuts, "HEX_DIGITS", 1)
    monkeypatch.setattr(cuts, "ORDERED_ROWS", 3)
    assert lowest_hash_cuts(values, "id", half, by="k") == one


def test_hash_cuts_take_all_or_nothing(values):
    everything = lowest_hash_cuts(values, "id", lambda t: {c: n + 5 for c, n in t.items()})
    assert values.where(below_cut(everything, "id")).count() == 3000
    nothing = lowest_hash_cuts(values, "id", lambda t: {c: 0 for c in t})
    assert values.where(below_cut(nothing, "id")).count() == 0


def test_cut_tables_equal_cut_lists(values, monkeypatch):
    from riskspark.plans import cuts

    lists = {c.cls: c.digest for c in lowest_hash_cuts(values, "id", lambda t: {"a": t["a"] // 2, "b": 0}, by="k")}
    want = F.when(F.col("cls") == "a", F.floor(F.col("n") / 2)).otherwise(0)
    found = lambda: dict(rows(hash_cut_table(values, "id", lambda t: t.withColumn("want", want), "k")))
    assert found() == lists
    monkeypatch.setattr(cuts, "HEX_DIGITS", 1)
    monkeypatch.setattr(cuts, "ORDERED_ROWS", 3)
    assert found() == lists


def test_stored_rows_give_the_same(spark, values):
    one = cumsum(values, buckets=1)
    for cuts in (O.Sketch([]), O.Sketch([0.1, 0.2, 0.5, 0.9]), O.Sketch([0.1, 0.5, 0.5, 0.5, 0.9]), O.Sketch([0.1, 0.5, 0.9], 10.0)):
        sums = {"n": F.lit(1), "odd": F.col("id") % 2}
        found = ordered_cumsum(values, "x", sums, ["k"], cuts=cuts, store=True)
        assert sorted(rows(found.drop(O.BUCKET))) == one
        assert "Range" not in found._jdf.queryExecution().optimizedPlan().toString()  # the source is not read again
