"""Sources, step lists, versions, k-NN against brute force, streams, plans."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith import streaming
from tablesmith.operators import knn
from tablesmith.operators.eda import corr
from tablesmith.plans import steps
from tablesmith.plans.tables import event_log, gappy_lineitem, table
from tablesmith.plans.versions import VersionStore, descriptive_key
from tablesmith.sources import files
from tablesmith.sources.events import load_event_log
from tests.conftest import SF_SMALL


def test_csv_roundtrip(spark, scratch_dir):
    orders = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = os.path.join(scratch_dir, "orders_csv")
    files.write_csv(orders, path)
    back = files.read_csv(spark, path)
    assert back.count() == orders.count()
    assert back.exceptAll(orders).count() == 0


def test_json_array_and_flatten(spark, scratch_dir):
    path = os.path.join(scratch_dir, "t.json")
    with open(path, "w") as fh:
        json.dump([{"a": 1, "b": {"c": 2.5}}, {"a": 2, "b": {"c": float("nan")}}], fh)
    df = files.read_json(spark, path)
    assert set(df.columns) == {"a", "b_c"}
    assert df.filter(F.col("b_c").isNull()).count() == 1


def test_event_log_csv(spark, scratch_dir):
    path = os.path.join(scratch_dir, "log.csv")
    with open(path, "w") as fh:
        fh.write("timestamp,session_id,ab_group,event_type,clean_action,dataset_key,columns_count,success,"
                 "seconds_since_session_start,details\n")
        fh.write("2026-01-01 10:00:00,s1,a,apply_clean,handle_missing,k,2,True,4.5,\n")
        fh.write("2026-01-01 10:00:01,s1,X,apply_clean,handle_missing,k,2,True,4.5,\n")
    df = load_event_log(spark, path)
    assert df.count() == 1 and df.first()["success_bool"] is True


def test_steps_refused_before_running(spark):
    df = gappy_lineitem(spark, SF_SMALL)
    with pytest.raises(ValueError):
        steps.run_steps(df, [{"action": "no_such_action"}])
    with pytest.raises(ValueError):
        steps.run_steps(df, [{"action": "scale_columns", "columns": ["nope"], "method": "minmax"}])
    with pytest.raises(ValueError):
        steps.run_steps(df, [{"action": "handle_missing", "bogus": 1}])


def test_versions_roundtrip(spark, scratch_dir):
    store = VersionStore(spark, os.path.join(scratch_dir, "versions"))
    df = table(spark, SF_SMALL, "region")
    stem = descriptive_key("handle_missing", ["r_name"], "mean")
    k1 = store.register(df, stem, "first")
    k2 = store.register(df.limit(2), stem, "second", source_key=k1, transform="limit")
    assert k1 != k2
    store.overwrite(k1, df.limit(1), transform="trim")
    assert store.load(k1).count() == 1
    h = store.history().collect()
    assert [r["key"] for r in h] == [k1, k2, k1]


def _brute_knn(pdf, target, feats, k, key):
    ref = pdf[pdf[target].notna() & pdf[feats].notna().all(axis=1)]
    mean, sd = ref[feats].mean().to_numpy(), ref[feats].std(ddof=0).to_numpy()
    sd[sd == 0] = 1
    rz = (ref[feats].to_numpy() - mean) / sd
    out = {}
    for _, row in pdf[pdf[target].isna()].iterrows():
        qz = (row[feats].to_numpy(dtype=float) - mean) / sd
        d = ((rz - qz) ** 2).sum(axis=1)
        order = np.lexsort((ref[key].to_numpy(), d))[:k]
        out[row[key]] = ref[target].to_numpy()[order].mean()
    return out


def test_knn_matches_brute_force(spark):
    part = table(spark, SF_SMALL, "part").select("p_partkey", "p_size", "p_retailprice")
    gappy = part.withColumn("p_retailprice", F.when(F.col("p_partkey") % 7 == 0, None)
                            .otherwise(F.col("p_retailprice")))
    out, warn = knn.knn_impute(gappy, ["p_retailprice"], k=5, tie_key="p_partkey")
    got = {r["p_partkey"]: r["p_retailprice"] for r in out.collect()}
    want = _brute_knn(gappy.toPandas(), "p_retailprice", ["p_partkey", "p_size"], 5, "p_partkey")
    assert warn is None and len(got) == part.count()
    for key, v in want.items():
        assert got[key] == pytest.approx(v)


def test_kendall_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, 60).astype(float)
    y = (x + rng.integers(0, 3, 60)).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    tau, cut = ({(r["col_x"], r["col_y"]): r["tau"] for r in corr.kendall_matrix(df, ["x", "y"], n).collect()}[("x", "y")]
                for n in (50_000, 4))  # one strip, and several that end inside the data
    assert cut == pytest.approx(tau)
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(60) for j in range(i + 1, 60))
    n0 = 60 * 59 / 2
    _, tx = np.unique(x, return_counts=True)
    _, ty = np.unique(y, return_counts=True)
    n1, n2 = (tx * (tx - 1) / 2).sum(), (ty * (ty - 1) / 2).sum()
    assert tau == pytest.approx(s / np.sqrt((n0 - n1) * (n0 - n2)))


def test_stream_matches_batch_sessions(spark):
    batch = streaming.session_metrics_windowed(event_log(spark, SF_SMALL))
    stream = streaming.run_to_table(
        streaming.session_metrics_windowed(streaming.event_log_stream(spark, f"{SF_SMALL}/events*.parquet")),
        "t_stream_sessions")
    # append mode emits sessions whose day closed before the final watermark
    closed = stream.select("session_id", "ab_group", "n_apply", "apply_rate")
    assert closed.count() > 0
    assert closed.exceptAll(batch.select("session_id", "ab_group", "n_apply", "apply_rate")).count() == 0


def test_running_arm_stats_idempotent(spark, scratch_dir):
    sess = spark.createDataFrame([("a", "A", 0.5), ("b", "B", 1.0)], "session_id string, ab_group string, apply_rate double")
    acc = streaming.RunningArmStats(f"{scratch_dir}/sums")
    acc(sess, 0)
    acc(sess, 0)
    again = streaming.RunningArmStats(f"{scratch_dir}/sums")  # as after a restart
    again(sess, 1)
    assert {r["ab_group"]: r["n"] for r in again.totals(spark).collect()} == {"A": 2, "B": 2}
    assert again.alerts(spark).count() == 0


def test_stream_goes_on_after_a_restart(spark, scratch_dir):
    events = table(spark, SF_SMALL, "events")
    half = events.where("event_id % 2 = 0")
    half.write.parquet(f"{scratch_dir}/events/a")
    name = f"restart-{os.path.basename(scratch_dir)}"
    first = streaming.run_to_table(streaming.event_log_stream(spark, f"{scratch_dir}/events/*"), name)
    assert first.count() == half.count()
    events.where("event_id % 2 = 1").write.parquet(f"{scratch_dir}/events/b")
    both = streaming.run_to_table(streaming.event_log_stream(spark, f"{scratch_dir}/events/*"), name)
    assert both.count() == events.count()


def test_filter_pushes_down_without_python(spark):
    from tablesmith.operators import filters
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = table(spark, SF_SMALL, "lineitem")
    plan = filters.filter_rows(df, ("l_linenumber", ">", 3))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_linenumber), GreaterThan(l_linenumber,3)]" in plan
    raw = files.read_parquet(spark, f"{SF_SMALL}/lineitem.parquet", nan_as_null=False)
    plan = filters.filter_rows(raw, ("l_quantity", ">", 10))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    pruned = df.select("l_quantity")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double>" in pruned


def test_two_column_dispatch(spark):
    from tablesmith.operators.eda.dispatch import two_columns
    df = gappy_lineitem(spark, SF_SMALL)
    assert "hue_value" not in two_columns(df, "l_returnflag", "l_quantity").columns   # swapped to box
    assert set(two_columns(df, "l_returnflag", "l_linestatus").columns) == {"x_value", "y_value", "n"}
    assert "bx" in two_columns(df, "l_quantity", "l_discount").columns
    with pytest.raises(ValueError):
        two_columns(df, "l_shipdate", "l_quantity")
