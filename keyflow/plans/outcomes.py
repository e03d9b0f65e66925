"""Queries of whole output records, failures, retries, hooks and registries, with SQL that has to give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyflow.functions import paths as P
from keyflow.operators import aspects as A
from keyflow.operators import configs as CF
from keyflow.operators import metrics as M
from keyflow.operators import routing as R
from keyflow.operators import rules as RU
from keyflow.operators import state as S
from keyflow.plans.queries import COMPARE, NOTE_SQL, PERF, REC, SCANS, compared, query, records, scans, t


def whole_scans(s, d):
    """scans() with all columns that records need."""
    user = F.col("item_id").cast("long")
    text = lambda when, value: F.when(when, F.concat(F.lit(value), "item_id"))
    return scans(s, d).withColumns({
        "event_time": F.concat(F.lit("t"), F.col("event_id").cast("string")), "upu_number": F.concat(F.lit("YA"), F.lpad("item_id", 9, "0"), F.lit("GB")), "product_id": (100 + user % 4).cast("string"),
        "location_id": text(user % 2 == 0, "L"), "site_id": text(user % 5 != 0, "S"), "postcode_region": F.when(user % 3 == 0, "region"), "sorting_center": F.lit("sort"), "delivery_office": F.when(user % 7 != 0, "office"), "delivery_location": F.lit("door"),
        "postcode": F.lit("AB1"), "country": F.lit("GB"), "user_code": text(user % 2 == 1, "U"), "device_id": F.lit("D"), "route": F.lit(None).cast("string"), "latitude": F.col("price"), "altitude": F.lit(None).cast("double"),
    })


_STAMPS = "'t' || event_id as {}, user_id::varchar as uniqueItemId"
_UPU = "'YA' || lpad(user_id::varchar, 9, '0') || 'GB' as UPUTrackingNumber"
_ID = "(100 + user_id % 4)::varchar as productId"
_LAST = "event in ('EVGPD', 'ENKDN')"
_EVENT_NAME = "case event " + " ".join(f"when '{k}' then '{v}'" for k, v in RU.EVENT_NAMES.items()) + " end"


@query("tracking_out", f"select event_id, 'tracking' as type, event as eventCode, {_EVENT_NAME} as eventName, {_STAMPS.format('eventDateTime')}, {_UPU}, {_ID}, category as productName, case when user_id % 2 = 0 then 'L' || user_id else '' end as functionalLocationId, case when user_id % 5 <> 0 then 'S' || user_id else '' end as siteId, case event when 'EVDAV' then case when user_id % 3 = 0 then 'region' else '' end when 'EVIMC' then 'sort' when 'ENKDN' then 'door' else case when user_id % 7 <> 0 then 'office' else '' end end as locationName, 'AB1' as postcode, 'GB' as destinationCountry, case when {_LAST} then case when user_id % 2 = 1 then 'U' || user_id else '' end end as userId, case when {_LAST} then 'D' end as deviceId, case when {_LAST} then '' end as routeOrWalkNumber, case when {_LAST} then case when user_id % 4 = 0 then value else 0.0 end end as longitude, case when {_LAST} then case when user_id % 3 = 0 then value else 0.0 end end as latitude, case when {_LAST} then 0.0::double end as altitude from {SCANS}")
def _(s, d):
    x = whole_scans(s, d).select("event_id", RU.tracking_out().alias("x"))
    return x.where("x is not null").select("event_id", *[f"x.{f}" for f in [*RU.TRACKING, *RU.ROUND]])


@query("notification_out", f"select event_id, 'notification' as type, code as trackedEventCode, event as originatingTrackedEventCode, destination as notificationDestination, kind::int as notificationDestinationType, 'R' as notificationRecipientType, {_STAMPS.format('eventTimestamp')}, {_UPU} from ({NOTE_SQL}) n join {SCANS} x using (event_id)")
def _(s, d):
    x = whole_scans(s, d).select("event_id", F.explode(RU.notification_out()).alias("x"))
    return x.select("event_id", *[f"x.{f}" for f in RU.NOTIFICATION])


@query("billing_out", f"select event_id, 'billing' as type, 'DELIVERY_COMPLETE' as billingCode, event as eventCode, {_STAMPS.format('eventTimestamp')}, {_ID}, category as productCategory, case when user_id % 3 = 0 then value else 0.0 end as pricePaid from {SCANS} where event = 'ENKDN'")
def _(s, d):
    x = whole_scans(s, d).select("event_id", RU.billing_out().alias("x")).where("x is not null")
    return x.select("event_id", *[f"x.{f}" for f in RU.BILLING])


_NOTES = f"select event_id, (row_number() over (partition by event_id order by kind) - 1)::int as place, 'notification' as type, code, destination from ({NOTE_SQL})"


def _out(s, d, out):
    x = P.explode_out(whole_scans(s, d).select("event_id", out.alias("out")))
    return x.select("event_id", F.col("out_at").alias("place"), "record.type", F.coalesce("record.trackedEventCode", "record.eventCode").alias("code"), F.col("record.notificationDestination").alias("destination"))


@query("combined_out", f"{_NOTES} union all select event_id, coalesce(n, 0)::int, 'tracking', event, null from {SCANS} left join (select event_id, count(*) as n from ({NOTE_SQL}) group by all) using (event_id)")
def _(s, d):
    return _out(s, d, RU.combined_out())


@query("deployed_out", f"{_NOTES} union all select event_id, 0::int, 'tracking', event, null from {SCANS} where event_id not in (select event_id from ({NOTE_SQL}))")
def _(s, d):
    return _out(s, d, RU.deployed_out())


def envelopes(s, d):
    """Records as they stand before a rule: data and state, changes, one to five causes of failure or none, how long it took."""
    n = (F.col("event_id") % 6).cast("int")
    causes = F.slice(F.array(*[F.lit(f"E{i}: bad") for i in range(5)]), 1, n)
    change = F.array(F.struct(F.array(F.lit("seen")).alias("path"), F.col("event_type").alias("value")))
    return records(s, d).select("event_id", "domain_id", F.lit("mail").alias("domain_type"), "event_type", F.col("props").alias("data"), F.concat(F.lit("s"), "domain_id").alias("state"), change.alias("changes"), causes.alias("causes"), F.col("value").alias("duration"))


@query("error_rows", "select event_id, user_id::varchar as domain_id, 'mail' as domain_type, event_type, props as data, 's' || user_id as state, 'error' as kind, 'rule' as stage, 0 as n_changes, case event_id % 6 when 1 then 'E0: bad' when 2 then 'E0: bad|E1: bad' else 'E0: bad|E1: bad|E2: bad|...' end as errors from events where event_id % 6 > 0")
def _(s, d):
    x = R.to_error(envelopes(s, d), "rule")
    return x.select("event_id", "domain_id", "domain_type", "event_type", "data", "state", "kind", "stage", F.size("changes").alias("n_changes"), F.array_join("errors", "|").alias("errors"))


@query("retry_rows", "select event_id, user_id::varchar as domain_id, props as data, 's' || user_id as state, 'retry' as kind, 'rule' as stage_name, 0 as retries, 0 as n_changes from events where value > 50")
def _(s, d):
    x = R.to_retry(envelopes(s, d), 50, "rule")
    return x.select("event_id", "domain_id", "data", "state", "kind", "stage_name", "retries", F.size("changes").alias("n_changes"))


@query("error_recovery", "select event_id, case when event_type = 'error' and value < 10 then 'failed|low' when event_type = 'error' then 'failed' when value < 10 then 'low' else '' end as errors, case when event_type = 'error' or value < 10 then 'none' else event_type end as data from events")
def _(s, d):
    low, failed = F.when(F.col("value") < 10, F.array(F.lit("low"))), F.when(F.col("event_type") == "error", F.array(F.lit("failed")))
    e = t(s, d, "events").withColumn("found", R.all_errors(failed, low))
    return e.select("event_id", F.array_join("found", "|").alias("errors"), R.when_good("found", F.col("event_type"), F.lit("none")).alias("data"))


@query("mismatch_whole", f"select o_orderkey, o_orderkey as input, o_custkey as state, actual as actual_projection, expected as expected_projection, round(s, 4) as actual_output, o_totalprice as expected_output from (select * from {COMPARE}) where actual is distinct from expected".replace("(select o_orderkey,", "(select o_orderkey, o_custkey, o_totalprice, s,"))
def _(s, d):
    x = R.mismatch_record(compared(s, d), F.col("o_orderkey"), F.col("o_custkey"), F.col("s"), F.col("o_totalprice")).where("mismatch")
    r = lambda f, name: F.col(f"mismatch_record.{f}").alias(name)
    return x.select("o_orderkey", r("input", "input"), r("cepState", "state"), r("actualProjection", "actual_projection"), r("expectedProjection", "expected_projection"), F.round("mismatch_record.actualOutput", 4).alias("actual_output"), r("expectedOutput", "expected_output"))


def scheduled(s, d):
    """Errors as retries by stages without jitter, so that SQL can tell when each is due."""
    e = t(s, d, "events").where("event_type = 'error'")
    r = S.with_log_seq(e, "user_id", ["ts", "event_id"]).select("event_id", F.lit("mail").alias("topic"), F.col("user_id").cast("string").alias("domain_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("acquired_ms"), F.least(F.col("seq"), F.lit(3)).cast("int").alias("retries"))
    return R.schedule_retries(r, s.createDataFrame([(0, 500, 0), (1, 1000, 0), (2, 2000, 0)], "retry int, timeout_ms long, jitter_ms long"), 100)


_RETRIES = "(select event_id, user_id, retries, a + 500 * (1 << retries) as due_ms, (a + 500 * (1 << retries)) // 100 * 100 as bucket from (select event_id, user_id, epoch_us(ts) // 1000 as a, (least(row_number() over (partition by user_id order by ts, event_id) - 1, 3))::int as retries from events where event_type = 'error'))"
_NOW = "((select epoch_us(max(ts)) // 1000 from events) - 3600000) // 100 * 100"


@query("retry_due_times", f"select event_id, retries > 2 as give_up, case when retries <= 2 then due_ms end as due_ms, case when retries <= 2 then bucket end as bucket from {_RETRIES}")
def _(s, d):
    return scheduled(s, d).select("event_id", "give_up", "due_ms", "bucket")


@query("retry_survivor", f"select user_id::varchar as domain_id, min(bucket) as bucket, (arg_min(event_id, bucket * 10000000000 + event_id))::bigint as event_id from (select *, bucket::hugeint as b from {_RETRIES}) where retries <= 2 group by user_id".replace("bucket * 10000000000", "b * 10000000000"))
def _(s, d):
    return R.dedupe_retries(scheduled(s, d), "event_id").select("domain_id", "bucket", "event_id")


@query("retry_counts", f"select (select count(*) from {_RETRIES} where retries > 2) as given_up, sum(added)::bigint as added, sum(earlier)::bigint as earlier_exists, sum(moved)::bigint as moved, count(*) filter (where held <= {_NOW}) as removed from (select user_id, count(*) filter (where before is null) as added, count(*) filter (where before <= bucket) as earlier, count(*) filter (where before > bucket) as moved, min(bucket) as held from (select *, min(bucket) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as before from {_RETRIES} where retries <= 2) group by user_id)")
def _(s, d):
    now = t(s, d, "events").agg(F.unix_millis(F.max("ts").cast("timestamp"))).first()[0] or 0
    return R.retry_counts(scheduled(s, d), "event_id", now - 3_600_000, 100)


@query("retry_stages", f"select retries, count(*) as n from {_RETRIES} where retries <= 2 group by retries")
def _(s, d):
    return R.retries_by_stage(scheduled(s, d))


_ALL = "value + error + retry + mismatch"


@query("perf_report", f"select start, value as delta_value, error as delta_error, greatest(coalesce(epoch(start) - epoch((select min(start) from {PERF} where value > 0)), 0), 0)::bigint as elapsed, round(({_ALL}) / 3600.0::double, 9) as rate, round((sum({_ALL}) over (order by start))::double / (epoch(start) + 3600 - epoch(min(start) over ())), 9) as overall_rate from {PERF}")
def _(s, d):
    x = M.perf_report(records(s, d), "ts", "kind", 3600)
    return x.select("start", "delta_value", "delta_error", "elapsed", F.round("rate", 9).alias("rate"), F.round("overall_rate", 9).alias("overall_rate"))


@query("normalize_repeating", "select event_id, case event_id % 4 when 0 then 1 when 1 then 2 end as n, case when event_id % 4 < 2 then event_type end as first, case when event_id % 4 in (0, 1, 3) then 'o' end as other from events")
def _(s, d):
    one, n = F.concat(F.lit('{"name":"'), "event_type", F.lit('","value":"1"}')), F.col("event_id") % 4
    data = F.when(n == 0, one).when(n == 1, F.concat(F.lit("["), one, F.lit(","), one, F.lit("]")))
    aux = F.when(n == 2, '""').otherwise(F.concat(F.lit('{"other":"o"'), F.coalesce(F.concat(F.lit(',"data":'), data), F.lit("")), F.lit("}")))
    e = t(s, d, "events").select("event_id", F.struct(F.struct(F.try_parse_json(aux).alias("aux"), F.lit("x").alias("other")).alias("scan")).alias("message"))
    x = P.after_parse(e, [lambda df: P.normalize_repeating(df, ["scan", "aux", "data"])])
    many = F.try_variant_get("message.scan.aux", "$.data", "array<struct<name: string, value: string>>")
    return x.select("event_id", F.size(many).alias("n"), F.get(many, F.lit(0))["name"].alias("first"), F.try_variant_get("message.scan.aux", "$.other", "string").alias("other"))


@query("unwrap_pair", "select event_id, case when event_id % 4 < 2 then event_type end as input, case event_id % 4 when 0 then 1 when 1 then 2 when 2 then 1 else 0 end as n_expected, case event_id % 4 when 2 then 'no test.input' when 3 then 'no test.output' else '' end as errors from events")
def _(s, d):
    given, n = F.concat(F.lit('"input":{"kind":"'), "event_type", F.lit('"}')), F.col("event_id") % 4
    body = F.when(n == 0, F.concat(given, F.lit(',"output":{"n":1}'))).when(n == 1, F.concat(given, F.lit(',"output":[{"n":1},{"n":2}]'))).when(n == 2, '"output":{"n":1}').otherwise(given)
    x = P.unwrap_pair(t(s, d, "events").select("event_id", F.try_parse_json(F.concat(F.lit('{"test":{'), body, F.lit("}}"))).alias("message")))
    return x.select("event_id", F.try_variant_get("message", "$.kind", "string").alias("input"), F.coalesce(F.size("expected"), F.lit(0)).alias("n_expected"), F.array_join("errors", "|").alias("errors"))


@query("aspect_dispatch", "select event_id, case event_type when 'view' then 'seen ' || user_id when 'click' then 'hit ' || event_id end as said, case when event_type not in ('view', 'click') then 'unknown type ' || event_type || '; known: click, view' else '' end as errors from events")
def _(s, d):
    known = {"view": F.concat(F.lit("seen "), F.col("user_id").cast("string")), "click": F.concat(F.lit("hit "), F.col("event_id").cast("string"))}
    return A.apply_aspect(t(s, d, "events"), "event_type", known, "said").select("event_id", "said", F.array_join("errors", "|").alias("errors"))


@query("enrich_scope", "select event_id, case when event_type = 'view' then 'part ' || user_id % 3 end as of_event, 'part ' || user_id % 3 as of_all from events")
def _(s, d):
    registry = {}

    @A.enricher("part", registry)
    def _part(df, c):
        return df.withColumn(c["out"], F.concat(F.lit("part "), (F.col(c["by"]) % 3).cast("string")))

    both = [{"type": "part", "by": "user_id", "out": "of_event", "event": "view"}, {"type": "part", "by": "user_id", "out": "of_all", "event": "view", "scope": "all"}]
    return A.run_enrichers(t(s, d, "events"), both, registry).select("event_id", "of_event", "of_all")


@query("state_fold", "select user_id, list_reduce(list_prepend(7::bigint, list(last order by last)), lambda a, x: (a * 31 + x) % 1000003) as state from (select user_id, event_type, max(event_id) as last from events group by all) group by user_id")
def _(s, d):
    log = t(s, d, "events").withColumn("v", F.col("event_id"))
    return A.fold_state(log, "user_id", ["event_id"], "event_type", "v", F.lit(7).cast("long"), lambda acc, x: (acc * 31 + x) % 1000003)


@query("duplicate_configs", "select c_mktsegment as param_key, c_nationkey::varchar as event_type, 'bizlogic' as aspect, 'all' as module, count(*) as n from customer group by c_mktsegment, c_nationkey having count(*) > 1")
def _(s, d):
    c = t(s, d, "customer").select(F.col("c_mktsegment").alias("param_key"), F.col("c_nationkey").cast("string").alias("event_type"), F.lit("bizlogic").alias("aspect"), F.lit("all").alias("module"))
    return CF.duplicate_configs(c)


@query("root_errors", "select c_name as name, 'no schema path' as error from customer where c_nationkey % 5 = 0 union all select c_name, 'no parameters' from customer where c_custkey % 3 = 0")
def _(s, d):
    c = t(s, d, "customer").select(F.col("c_name").alias("name"), F.when(F.col("c_nationkey") % 5 == 0, " ").otherwise(F.col("c_mktsegment")).alias("path"), F.when(F.col("c_custkey") % 3 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array("c_mktsegment")).alias("parameters"))
    return CF.root_errors(c)


@query("lines_codec_all", "select doc_id, case when coalesce(text, '') = '' then 0 else len(string_split(regexp_replace(text, '\\n$', ''), chr(10))) end as n, regexp_replace(coalesce(text, ''), '\\n$', '') as again from documents")
def _(s, d):
    x = t(s, d, "documents").withColumn("items", P.decode_lines("text"))
    return x.select("doc_id", F.size("items").cast("long").alias("n"), P.encode_lines("items").alias("again"))


@query("out_explode_all", "select conv_id, (row_number() over (partition by conv_id order by turn, role) - 1)::bigint as out_at, role as record from conversations")
def _(s, d):
    c = t(s, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("o"))
    return P.explode_out(c.select("conv_id", F.col("o.role").alias("out"))).select("conv_id", F.col("out_at").cast("long").alias("out_at"), "record")
