"""Trees of changes: folds by parts, and the stream that keeps them."""

import copy
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from keyflow.functions import trees
from keyflow.operators import folds
from keyflow.streaming import logs, streams

VALUES = [1, "x", None, {}, {"a": {"b": 1}}, {"b": [1]}, [1, 2], [], {"a": 5, "c": [{}]}]


def plain(log):
    """One change after the other, as a user would."""
    out = {}
    for kind, path, value in log:
        if not path:
            continue
        at, value = out, copy.deepcopy(value)
        for name in path[:-1]:
            if not isinstance(at.get(name), dict):
                at[name] = {}
            at = at[name]
        if kind == "append" and isinstance(at.get(path[-1]), list):
            at[path[-1]].append(value)
        else:
            at[path[-1]] = [value] if kind == "append" else value
    return out


def some_log(rng, n):
    return [(rng.choice(["set", "append"]), [rng.choice("ab") for _ in range(rng.randrange(4))], copy.deepcopy(rng.choice(VALUES))) for _ in range(n)]


GOLDEN = [
    ([("set", ["person", "name", "first"], "Alice")], {"person": {"name": {"first": "Alice"}}}),
    ([("set", ["person"], "not a map"), ("set", ["person", "name"], "Alice")], {"person": {"name": "Alice"}}),
    ([("set", ["k"], {"leaf": 123}), ("set", ["k", "leaf"], ["x", "y"])], {"k": {"leaf": ["x", "y"]}}),
    ([("set", ["a"], {"k": 1}), ("set", ["a", "x"], 2)], {"a": {"k": 1, "x": 2}}),
    ([("set", ["k"], True), ("set", [], "ignored"), ("append", [], "x"), ("set", None, 1)], {"k": True}),
    ([("append", ["items"], "a")], {"items": ["a"]}),
    ([("set", ["items"], "no list"), ("append", ["items"], "a")], {"items": ["a"]}),
    ([("set", ["items"], ["a"]), ("append", ["items"], "b")], {"items": ["a", "b"]}),
    ([("append", ["person", "tags"], "new")], {"person": {"tags": ["new"]}}),
]


def test_golden_cases(spark):
    rows = [(f"k{i}", n, kind, path, json.dumps(value)) for i, (log, _) in enumerate(GOLDEN) for n, (kind, path, value) in enumerate(log)]
    df = spark.createDataFrame(rows, "k string, n int, type string, path array<string>, value string").withColumn("value", F.parse_json("value")).repartition(5)
    got = {r["k"]: json.loads(r["state"]) for r in folds.fold_tree(df, "k", ["n"]).collect()}
    assert got == {f"k{i}": want for i, (_, want) in enumerate(GOLDEN)}
    got = {r["k"]: json.loads(r["state"]) for r in folds.tree_snapshot(df, "k", ["n"], '{"items": ["s"], "z": 0}').select("k", F.to_json("state").alias("state")).collect()}
    assert got == {f"k{i}": plain([("set", ["items"], ["s"]), ("set", ["z"], 0), *log]) for i, (log, _) in enumerate(GOLDEN)}


def test_patches_of_parts_are_the_whole():
    rng = random.Random(1)
    for _ in range(3000):
        log = some_log(rng, rng.randrange(1, 9))
        cut = sorted(rng.randrange(len(log) + 1) for _ in range(2))
        parts = []
        for part in (log[: cut[0]], log[cut[0] : cut[1]], log[cut[1] :]):
            one = ("in", {})
            for kind, path, value in copy.deepcopy(part):
                one = trees.then(one, trees.patch(kind, path, value)) if path else one
            parts.append(one)
        entries: dict = {}
        for part in (log[: cut[0]], log[cut[0] :]):
            latest = trees.Latest(copy.deepcopy(entries))
            for change in copy.deepcopy(part):
                latest.add(*change)
            entries = {p: e for p, e in entries.items() if p not in latest.gone} | {p: latest.entries[p] for p in latest.changed}
            assert entries == latest.entries
        assert trees.apply({}, trees.then(parts[0], trees.then(parts[1], parts[2]))) == latest.tree == trees.Latest(entries).tree == plain(log)


def test_a_hot_key_is_folded_by_many_tasks(spark):
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 100 == 0, F.col("id") % 7).alias("k"), "id", F.lit("x").alias("v"))
    keep = folds.Fold(lambda: (0, None, 0), lambda s, r: (s[0] + 1, r["id"], s[2] + (s[1] is not None and r["id"] <= s[1])), lambda a, b: (a[0] + b[0], b[1], a[2] + b[2]), lambda s: json.dumps(s))
    out = folds.fold_log(df, "k", ["id"], keep, ["v"])
    got = {r["k"]: json.loads(r["state"]) for r in out.collect()}
    assert got[None] == [n - n // 100, n - 1, 0] and sum(s[0] for s in got.values()) == n and all(s[2] == 0 for s in got.values())
    assert folds.fold_log(df.where("false"), "k", ["id"], keep, ["v"]).count() == 0
    # the null key's rows are spread over the ranges
    assert df.repartitionByRange(4, "k", "id").where("k is null").select(F.spark_partition_id()).distinct().count() == 4


def rule(row, state):
    """Fails where told to; counts what it has seen under a path, and appends its value to a list."""
    if row["code"] == "bad":
        raise ValueError("told to fail")
    if row["code"] == "odd":
        return "x", [("set", ["kept"], 1), ("swap", ["a"], 1)]  # the second is no change, so the first is none either
    seen = state.get("seen", {}).get("n", 0)
    return {"before": seen}, [("set", ["seen", "n"], seen + 1), ("append", ["values"], row["v"]), ("set", ["last", row["code"]], {"v": row["v"]})]


def batches(spark, path, rows, n):
    df = spark.createDataFrame(rows, "at int, k string, v double, code string")
    size = len(rows) // n
    for i in range(n):
        df.where((F.col("at") >= i * size) & (F.col("at") < (i + 1) * size)).coalesce(1).write.parquet(f"{path}/p={i}")
    return df, spark.readStream.schema("at int, k string, v double, code string").option("maxFilesPerTrigger", 1).parquet(f"{path}/p=*")


def test_log_stream_equals_batch(spark, tmp_path):
    """Three batches: what the stream appends folds to the state that a plain loop has; failing rows leave nothing."""
    rows = [(i, f"k{i % 4}", None if i % 9 == 0 else float(i), "bad" if i % 5 == 3 else "odd" if i % 11 == 7 else "ab"[i % 2]) for i in range(60)]
    df, src = batches(spark, str(tmp_path / "in"), rows, 3)
    sinks = {k: streams.parquet_sink(str(tmp_path / k)) for k in ("value", "error")}
    q = logs.run_log_stream(src, "k", ["at"], lambda x: x, rule, sinks, str(tmp_path / "cp"), {"availableNow": True})
    q.awaitTermination()
    done, failed = spark.read.parquet(str(tmp_path / "value")), spark.read.parquet(str(tmp_path / "error"))
    state, want, kept = {}, {}, {}
    for at, k, v, code in rows:
        now = plain(state.get(k, []))
        try:
            out, changes = rule({"at": at, "k": k, "v": v, "code": code}, now)
            assert all(c[0] in ("set", "append") for c in changes)
            state.setdefault(k, []).extend(changes)
            want[at] = (out, now)
        except (ValueError, AssertionError):
            kept[at] = now
    assert {r["at"]: (json.loads(r["out"]), json.loads(r["state"])) for r in done.collect()} == want
    assert {r["at"]: json.loads(r["state"]) for r in failed.collect()} == kept
    assert {(r["stage"], r["errors"][0], len(r["changes"]), r["out"]) for r in failed.collect()} == {(logs.STAGE, logs.TEXT + "told to fail", 0, None), (logs.STAGE, logs.TEXT + "unknown change swap", 0, None)}
    folded = folds.fold_tree(logs.log_of(done, "k"), "k", ["row_number", "idx"])
    assert {r["k"]: json.loads(r["state"]) for r in folded.collect()} == {k: plain(log) for k, log in state.items()}


def entries(spark, checkpoint, name="paths"):
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def test_state_stops_growing(spark, tmp_path):
    """Ten times the rows leave as many entries: one a path, not one a change."""
    def again(row, state):
        return None, [("set", ["n"], row["at"]), ("set", ["by", row["code"]], row["v"])]

    sizes = []
    for n in (8, 80):
        _, src = batches(spark, str(tmp_path / f"in{n}"), [(i, "k", float(i), "ab"[i % 2]) for i in range(n)], 2)
        out = logs.with_log(src, "k", ["at"], again)
        out.writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"cp{n}")).trigger(availableNow=True).start().awaitTermination()
        sizes.append(entries(spark, str(tmp_path / f"cp{n}")).count())
    assert sizes == [3, 3]


@pytest.mark.parametrize("how", [{"ttl_ms": 1500}, {"idle_ms": 1500}])
def test_state_expires(spark, tmp_path, how):
    """A value that is not written again, or a key without rows, is gone after its time."""
    rows = [(0, "k", 1.0, "a"), (1, "k", 2.0, "a")]
    for i, row in enumerate(rows):
        spark.createDataFrame([row], "at int, k string, v double, code string").coalesce(1).write.parquet(str(tmp_path / "all" / f"p={i}"))
    (tmp_path / "in").mkdir()
    src = spark.readStream.schema("at int, k string, v double, code string").parquet(str(tmp_path / "in" / "p=*"))
    sink, got = streams.parquet_sink(str(tmp_path / "out")), None
    (tmp_path / "all" / "p=0").rename(tmp_path / "in" / "p=0")
    q = logs.run_log_stream(src, "k", ["at"], lambda x: x, rule, {"value": sink}, str(tmp_path / "cp"), {"processingTime": "200 milliseconds"}, **how)
    try:
        for second in (False, True):
            for _ in range(300):
                time.sleep(0.2)
                if q.exception():
                    raise q.exception()
                if (tmp_path / "out").exists():
                    got = {r["at"]: json.loads(r["state"]) for r in spark.read.schema("at int, state string").option("ignoreMissingFiles", "true").parquet(str(tmp_path / "out")).collect()}
                    if len(got) == (2 if second else 1):
                        break
            if not second:
                time.sleep(4)
                (tmp_path / "all" / "p=1").rename(tmp_path / "in" / "p=1")
    finally:
        q.stop()
    assert got == {0: {}, 1: {}}


def test_rows_leave_in_order(spark, tmp_path):
    """Shuffled completions leave by their number; what comes late or twice is told or goes."""
    rng = random.Random(5)
    sent = [(n, k) for k in ("a", "b") for n in range(40)]
    rng.shuffle(sent)
    sent += [(3, "a"), (5, "b"), *[(5 + i, "c") for i in range(18)]]  # a batch of their own
    _, src = batches(spark, str(tmp_path / "in"), [(i, k, float(n), "x") for i, (n, k) in enumerate(sent)], 5)
    src = src.select("at", "k", F.col("v").cast("long").alias("n"), F.when(F.col("v") > 3, F.col("code")).alias("code"))
    number = {}

    def keep(batch, at):
        for r in batch.collect():
            number.setdefault(r["k"], []).append((r["n"], r["late"], r["code"]))

    logs.in_sequence(src, "k", "n").writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    for k, late in (("a", 3), ("b", 5)):
        assert [x for x in number[k] if not x[1]] == [(n, False, "x" if n > 3 else None) for n in range(40)]
        assert [x[0] for x in number[k] if x[1]] == [late]
    assert "c" not in number  # 0 to 4 never came


def test_late_rows_of_a_stream(spark, tmp_path):
    rows = [(0, 1000), (1, 5000), (2, 1000), (3, None), (4, 4990), (5, 100), (6, 9000), (7, 5300)]
    df = spark.createDataFrame(rows, "i int, s long").withColumn("ts", F.timestamp_seconds("s"))
    for n in range(4):
        df.where(f"i in ({2 * n}, {2 * n + 1})").coalesce(1).write.parquet(str(tmp_path / "in" / f"p={n}"))
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "p=*"))
    sinks = [streams.parquet_sink(str(tmp_path / x)) for x in ("ok", "late")]
    logs.split_late(src, "ts", "1 hour", *sinks, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    # batches (0 1)(2 3)(4 5)(6 7): watermarks none, 1400, 1400, 1400; 7 is in the batch of 6 and so not late
    assert [sorted(r["i"] for r in spark.read.parquet(str(tmp_path / x)).collect()) for x in ("ok", "late")] == [[0, 1, 3, 4, 6, 7], [2, 5]]


@pytest.mark.parametrize(("policy", "closed"), [("max", True), ("min", False)])
def test_a_quiet_source(spark, tmp_path, policy, closed):
    """With the policy max a source without rows holds no window back; with min it does."""
    old = spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy")
    for name, seconds in (("busy", [0, 10, 5000, 9000]), ("quiet", [1, 1, 1, 1])):
        for n, s in enumerate(seconds):
            spark.createDataFrame([(name, s)], "name string, s long").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(str(tmp_path / name / f"p={n}"))
    read = lambda name: streams.watermark(spark.readStream.schema("name string, s long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name / "p=*")), "ts", "10 seconds")
    try:
        logs.with_policy(spark, policy)
        counts = read("busy").union(read("quiet")).groupBy(F.window("ts", "100 seconds")).count()
        counts.select(F.col("window.start").alias("start"), "count").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", old)
    got = [r["count"] for r in spark.read.schema("start timestamp, count long").parquet(str(tmp_path / "out")).where("start < timestamp_seconds(50)").collect()]
    assert bool(got) == closed
    with pytest.raises(ValueError, match="min or max"):
        logs.with_policy(spark, "mean")


def test_rules_that_fail(spark):
    """Every kind of value survives being attempted; a failing row keeps its data; a rule of another type is refused."""
    from keyflow.operators import rules

    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (3, None, 2), (4, "none", 3)], "i int, rule_key string, d int")
    kinds = {"timestamp": "timestamp'2024-01-02 03:04:05.123456'", "date": "date'2024-01-02'", "decimal(20,4)": "cast(1.2345 as decimal(20,4))", "double": "cast('NaN' as double)", "binary": "cast('x\\u00fc' as binary)", "map<string,int>": "map('k', cast(null as int))", "array<struct<x:int>>": "array(named_struct('x', 1))", "string": "'q\"uo\\'te'", "boolean": "true", "bigint": "9007199254740993"}
    for kind, text in kinds.items():
        rows = df.withColumn("data", F.lit(None).cast(kind))
        compiled = rules.compile_rules(spark, {"a": f"if(1 div d > 0, {text}, null)", "b": text}, rows.schema, kind)
        got = {r["i"]: r for r in rules.eval_each(rows, compiled).collect()}
        want = spark.sql(f"select {text} as x").first()["x"]
        assert str(got[2]["data"]) == str(want) and got[2]["stage"] is None and got[2]["errors"] == [], kind
        assert (got[1]["data"], got[1]["stage"], got[1]["errors"]) == (None, rules.RULE_STAGE, [f"{rules.RULE_TEXT}rule a failed"])
        assert got[3]["stage"] is None and got[4]["stage"] is None
    with pytest.raises(ValueError, match="a: the result is of type int, not string"):
        rules.compile_rules(spark, {"a": "1", "b": "null", "c": "'x'"}, df.schema, "string")


def test_running_totals_over_days(spark):
    from keyflow.operators import metrics

    rows = [(i, i * 7000) for i in range(200)]
    df = spark.createDataFrame(rows, "n long, s long").withColumn("ts", F.timestamp_seconds("s"))
    out = metrics.running_totals(df, "ts", ["n"]).orderBy("ts").collect()
    assert [r["total_n"] for r in out] == [sum(range(i + 1)) for i in range(200)]
    plan = metrics.running_totals(df, "ts", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__day" in plan


def test_sketches_merge(spark):
    from keyflow.operators import metrics

    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("part"), (F.col("id") - 10).cast("double").alias("ms"))
    got = {r["k"]: r for r in metrics.merged_quantiles(metrics.latency_sketches(df, ["k", "part"], "ms"), ["k"]).collect()}
    assert sum(r["n"] for r in got.values()) == 100_000
    for r in got.values():
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs(r[name] / 100_000 - q) < metrics.RANK_ERROR
