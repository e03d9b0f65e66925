"""Golden rows for what has no table to run on."""

import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keyflow.functions import paths
from keyflow.operators import aspects, configs, depgraph, enrich, routing, rules, state
from keyflow.sources import lookups, records
from keyflow.streaming import streams


def test_csv_lookup(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('﻿k,l,v\n1,a,x\n\n1,a,"y ""q"""\n2,b\n', encoding="utf-8")
    rows = lookups.load_lookup(spark, str(f), ["k", "l"], ["v"]).collect()
    assert {(r["key"], r["v"]) for r in rows} == {("1.a", 'y "q"'), ("2.b", None)}
    with pytest.raises(ValueError, match="unknown columns: z"):
        lookups.load_lookup(spark, str(f), ["z"], ["v"])
    assert [r["name"] for r in lookups.available_lookups(spark, str(tmp_path)).collect()] == ["a"]


def test_config_folder(spark, tmp_path):
    (tmp_path / "prod").mkdir()
    (tmp_path / "prod" / "base.json").write_text('{\n "events":{"e":{"bizlogic":{"all":\n{"type":"cel","cel":"x"}}}},\n "more":1}\n')
    (tmp_path / "prod" / "bad.json").write_text("{")
    rows = {(r["param_key"], r["event_type"], r["type"], r["error"]) for r in configs.load_config(spark, str(tmp_path)).collect()}
    assert rows == {("prod:base", "e", "cel", None), ("prod:bad", None, None, "unreadable or empty")}


def test_notifications_of_all_cases(spark):
    """Four events, four products and four kinds of contacts, as the business test set has them."""
    contacts = {"none": [], "email": [("RECIPIENT_EMAILID", "a")], "mobile": [("RECIPIENT_MOBILENO", "1")], "both": [("RECIPIENT_EMAILID", "a"), ("RECIPIENT_MOBILENO", "1")]}
    events, products = ["EVDAV", "EVIMC", "EVGPD", "ENKDN"], ["Tracked24", "Tracked48", "SpecialDelivery09", "SpecialDelivery13"]
    rows = [(i, e, p, contacts[c]) for i, (e, p, c) in enumerate(itertools.product(events, products, contacts))]
    df = spark.createDataFrame(rows, "id int, event string, category string, contacts array<struct<name: string, value: string>>")
    out = rules.notifications(df, rules.matrix(spark)).groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("m"))
    assert {r["event"]: (r["n"], r["m"]) for r in out.collect()} == {"EVDAV": (8, 7), "EVGPD": (16, 12), "ENKDN": (10, 9)}


def test_rules_fail_together(spark):
    with pytest.raises(ValueError) as e:
        rules.compile_rules(spark, {"a": "nope + 1", "b": "x + 1", "c": "also_not"}, "x int")
    assert "a:" in str(e.value) and "c:" in str(e.value) and "b:" not in str(e.value)


def test_cycle_is_an_error(spark):
    nodes = spark.createDataFrame([("a", [["x"]], [["y"]]), ("b", [["y"]], [["x"]])], "label string, owns array<array<string>>, requires array<array<string>>")
    with pytest.raises(ValueError, match="cycle among a, b"):
        depgraph.topo_levels(nodes, depgraph.derive_edges(nodes))


def test_levels_of_a_chain(spark):
    """The plan of a level has the level before it as a table: work grows with the chain, not with its powers."""
    nodes = spark.createDataFrame([(f"n{i:02d}", [[f"p{i}"]], [[f"p{i - 1}"]] if i else []) for i in range(12)], "label string, owns array<array<string>>, requires array<array<string>>")
    rows = depgraph.topo_levels(nodes, depgraph.derive_edges(nodes)).collect()
    assert sorted((r["label"], r["level"]) for r in rows) == [(f"n{i:02d}", i) for i in range(12)]
    assert depgraph.topo_levels(nodes.where("false"), depgraph.derive_edges(nodes.where("false"))).count() == 0


def test_nested_sets(spark):
    rows = [("k", 1, ["a", "b"], "x"), ("k", 2, ["a"], "y"), ("k", 3, ["c"], "1"), ("k", 4, ["c", "d"], "2"), ("k", 5, [], "z"), ("k", 6, None, "z"), (None, 1, ["a", "b"], "m"), (None, 2, ["a", "c"], "n")]
    log = spark.createDataFrame(rows, "k string, n int, path array<string>, value string")
    got = sorted((r["k"] or "", r["path"], r["value"]) for r in state.fold_set(log, "k", ["n"]).collect())
    assert got == [("", ["a", "b"], "m"), ("", ["a", "c"], "n"), ("k", ["a"], "y"), ("k", ["c", "d"], "2")]


def test_api_is_asked_once_for_each_key(spark):
    def client():
        return lambda key: (200, '{"v":1}') if key == "a" else (404, "") if key == "b" else (500, "down")

    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    rows = {(r["k"], r["o"], r["o_error"]) for r in enrich.enrich_api(df, ["k"], "o", client).collect()}
    assert rows == {("a", '{"v":1}', None), ("b", None, None), ("c", None, "status 500: down"), (None, None, None)}


def test_topic_options():
    assert records.topic_options({"servers": "s", "topic": "t", "starting_offsets": "x"})["startingOffsets"] == "earliest"
    assert records.topic_options({"servers": "s", "topic": "t", "starting_offsets": "latest", "parallelism": 3})["minPartitions"] == "3"


def test_routed_stream_equals_batch(spark, tmp_path):
    rows = [(i, ["value", "error", "odd"][i % 3]) for i in range(30)]
    spark.createDataFrame(rows, "id int, kind string").write.parquet(str(tmp_path / "in"))
    src = streams.watermark(spark.readStream.schema("id int, kind string").parquet(str(tmp_path / "in")))
    q = streams.write_routed(src, {k: streams.parquet_sink(str(tmp_path / k)) for k in ("value", "error")}, str(tmp_path / "cp"), {"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "value")).count() == 10
    assert spark.read.parquet(str(tmp_path / "error")).count() == 20


def test_stateful_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(str(i % 3), i, float(i) if i % 4 else None) for i in range(30)], "k string, at long, v double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = streams.copy_stream(streams.stateful(src, "k", "at", "v"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(180)
    from keyflow.operators.state import running_state

    clean = lambda rows: sorted((r["at"], None if r["state_v"] is None or pd.isna(r["state_v"]) else r["state_v"]) for r in rows)
    assert clean(spark.read.parquet(str(tmp_path / "out")).collect()) == clean(running_state(df, "k", ["at"], ["v"]).collect())


def test_malformed_xml_has_an_error_row(spark):
    bad = ["<a><b>1</b></a>junk", "<a><b>1</b></a><a/>", "<a><b>&x;</b></a>", '<a b="1" b="2"/>', "junk", "<a><b>1</a>", "<a>1 < 2</a>", '<!DOCTYPE a [<!ENTITY x "y">]><a><b>&x;</b></a>', ' <?xml version="1.0"?><a/>']
    rest = [("<a><c><b> 1 </b></c></a> ", "1", None), ("<a/>", None, "not found"), ("<a><b/></a>", None, "empty"), (" ", None, "no xml"), (None, None, "no xml")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(bad + [r[0] for r in rest])], "i int, raw string")
    got = [(r["id"], r["error"]) for r in df.select("i", paths.extract_id("raw", ["a", "b"]).alias("x")).orderBy("i").select("x.*").collect()]
    assert got == [(None, paths.MALFORMED)] * len(bad) + [r[1:] for r in rest]
    assert {r["x"]["error"] for r in df.select(paths.extract_id("raw", []).alias("x")).collect()} == {"no path", "no xml"}


def test_late_rows_over_many_ranges(spark):
    rows = [(i, (i * 7919) % 5000 + i * 3 if i % 11 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "i long, s long").repartition(7).withColumn("ts", F.timestamp_seconds("s"))
    seen, want = None, []
    for i, s in rows:
        if s is not None and seen is not None and s < seen - 3600:
            want.append(i)
        seen = seen if s is None else s if seen is None else max(seen, s)
    late = streams.late_rows(df, "ts", "i", "1 hour")
    assert sorted(r["i"] for r in late.collect()) == want and late.columns == df.columns
    assert streams.late_rows(df.where("false"), "ts", "i", "1 hour").count() == 0
    # one task a range, none that reads the whole table
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__range" in plan


def test_registries(spark):
    registry = {}
    aspects.enricher("fixed", registry)(lambda df, c: df.withColumn(c["out"], F.lit(c["value"])))
    with pytest.raises(ValueError, match="fixed is registered already"):
        aspects.enricher("fixed", registry)(lambda df, c: df)
    df = spark.createDataFrame([("a",), ("b",), (None,)], "event_type string")
    with pytest.raises(ValueError, match="unknown types nope; known: fixed"):
        aspects.run_enrichers(df, [{"type": "nope", "out": "x"}], registry)
    rows = aspects.run_enrichers(df, [{"type": "fixed", "out": "x", "value": "v", "event": "a"}], registry).collect()
    assert {r["event_type"]: r["x"] for r in rows} == {"a": "v", "b": None, None: None}
    said = aspects.apply_aspect(df, "event_type", {"a": F.lit("A")}, "said").collect()
    assert {(r["said"], tuple(r["errors"])) for r in said} == {("A", ()), (None, ("unknown type b; known: a",)), (None, ())}


def test_records_of_all_cases(spark):
    """Counts of records over events, products and contacts, with and without the deployed text's binding."""
    contacts = [[], [("RECIPIENT_EMAILID", "a"), ("RECIPIENT_EMAILID", "z")], [("RECIPIENT_MOBILENO", "1")], [("RECIPIENT_EMAILID", "a"), ("RECIPIENT_MOBILENO", "1")]]
    events, products = ["EVDAV", "EVIMC", "EVGPD", "ENKDN"], ["Tracked24", "Tracked48", "SpecialDelivery09", "SpecialDelivery13"]
    df = spark.createDataFrame([(e, p, c) for e, p, c in itertools.product(events, products, contacts)], "event string, category string, contacts array<struct<name: string, value: string>>")
    empty = ["event_time", "item_id", "upu_number", "product_id", "location_id", "site_id", "postcode_region", "sorting_center", "delivery_office", "delivery_location", "postcode", "country", "user_code", "device_id", "route"]
    df = df.withColumns({c: F.lit(None).cast("string") for c in empty} | {c: F.lit(None).cast("double") for c in ("longitude", "latitude", "altitude", "price")})
    x = df.select("event", F.size(rules.notification_out()).alias("n"), F.size(rules.combined_out()).alias("c"), F.size(rules.deployed_out()).alias("d"), rules.tracking_out().alias("t"), rules.billing_out().alias("b"))
    got = {r["event"]: tuple(r)[1:] for r in x.groupBy("event").agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1)), F.sum("c"), F.sum("d"), F.count("b")).collect()}
    assert got == {"EVDAV": (8, 7, 24, 17, 0), "EVIMC": (0, 0, 16, 16, 0), "EVGPD": (16, 12, 32, 20, 0), "ENKDN": (10, 9, 26, 17, 16)}
    places = x.where("event = 'ENKDN'").select("t.siteId", "t.locationName", "t.longitude", "b.pricePaid", "t.pricePaid").distinct().collect()
    assert [tuple(r) for r in places] == [("", "", 0.0, 0.0, None)]
    assert rules.PLACES.keys() == rules.EVENT_NAMES.keys() == set(events)


def test_failures_keep_the_envelope(spark):
    rows = [(1, "d", "m", "e", "x", "s", [(["p"], "v")], [f"E{i}" for i in range(n)], float(n)) for n in range(5)]
    df = spark.createDataFrame(rows, "id int, domain_id string, domain_type string, event_type string, data string, state string, changes array<struct<path: array<string>, value: string>>, causes array<string>, duration double")
    errors = routing.to_error(df, "rule").orderBy(F.size("errors"), "duration").collect()
    assert [r["errors"] for r in errors] == [["E0"], ["E0", "E1"], ["E0", "E1", "E2", "..."], ["E0", "E1", "E2", "..."]]
    assert {(r["data"], r["state"], r["kind"], r["stage"], len(r["changes"])) for r in errors} == {("x", "s", "error", "rule", 0)}
    assert [(r["duration"], r["retries"], r["kind"], len(r["changes"])) for r in routing.to_retry(df, 3, "rule").collect()] == [(4.0, 0, "retry", 0)]
    assert routing.to_error(df.where("false"), "rule").count() == 0


def test_whole_stream_equals_batch(spark, tmp_path):
    """Enrichment, state, rule and sinks over two batches give what running_state gives over the table."""
    rows = [(i, f"k{i % 3}", float(i) if i % 2 else None, "abc"[i % 3]) for i in range(24)]
    df = spark.createDataFrame(rows, "at int, k string, v double, code string")
    for n, part in enumerate((df.where("at < 12"), df.where("at >= 12"))):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"p={n}"))

    def before(x):
        return enrich.enrich_lookup(x, ["code"], "place", {"a": "north", "b": "south"}).select("at", "k", "v", "place")

    def rule(x):
        return x.withColumn("kind", F.when(F.col("place").isNull(), "error").when(F.col("state_v").isNull(), "retry").otherwise("value"))

    src = spark.readStream.schema("at int, k string, v double, code string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "p=*"))
    kinds = ("value", "error", "retry")
    q = streams.run_stream(src, "k", "at", "v", before, rule, {k: streams.parquet_sink(str(tmp_path / k)) for k in kinds}, str(tmp_path / "cp"), {"availableNow": True})
    q.awaitTermination()
    got = {(k, r["at"], r["state_v"]) for k in kinds for r in spark.read.parquet(str(tmp_path / k)).collect()}
    want = rule(state.running_state(before(df), "k", ["at"], ["v"])).collect()
    assert got == {(r["kind"], r["at"], r["state_v"]) for r in want}


def test_watermarks(spark):
    src = spark.readStream.format("rate").load()
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" not in plan(streams.watermark(src))
    assert "10 seconds" in plan(streams.watermark(src, "timestamp", "10 seconds"))
    assert "EventTimeWatermark" in plan(streams.watermark(src, "timestamp", "0 seconds"))
    assert streams.watermark(src, fn=lambda x: x.where("value > 1").withWatermark("timestamp", "1 hour")).isStreaming


def test_payloads_that_do_not_serialize(spark):
    df = spark.createDataFrame([("d", None)], "domain_id string, out array<string>").withColumns({c: F.lit("") for c in ("traceparent", "cep_entries", "duration")}).withColumn("broker_ts", F.lit("1969-01-01").cast("timestamp"))
    assert [(r["value"], r["timestamp"], len(r["headers"])) for r in records.to_value_records(df).collect()] == [("null", None, 1)]
    assert df.select(records._json(F.lit(None).cast("string"), "error").alias("x")).first()["x"] == '{"kind":"error","error":"serialize"}'
