"""Every operator bound to the test tables, each with SQL that has to give the same rows.

Events play the records: user_id is the domain, event_id the offset, user_id % 12 the partition; props and value are
the payload; customers give the product category; nation and region are lookups that need each other; parts give the
paths of the dependency graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions import paths as P
from keyflow.operators import configs as CF
from keyflow.operators import depgraph as G
from keyflow.operators import enrich as E
from keyflow.operators import metrics as M
from keyflow.operators import routing as R
from keyflow.operators import rules as RU
from keyflow.operators import state as S
from keyflow.sources import lookups as L
from keyflow.sources import records as K

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw(spark: SparkSession, d: str) -> DataFrame:
    """Events as rows of a topic: users divisible by 10 have no domain header, errors have no value."""
    c = F.col
    head = F.array(F.struct(F.lit("domainId").alias("key"), F.when(c("user_id") % 10 != 0, c("user_id").cast("string")).otherwise("").cast("binary").alias("value")), F.struct(F.lit("baggage").alias("key"), c("event_type").cast("binary").alias("value")))
    return t(spark, d, "events").select(F.when(c("event_type") != "error", c("props")).cast("binary").alias("value"), head.alias("headers"), (c("user_id") % 12).cast("int").alias("partition"), c("event_id").alias("offset"), c("ts").alias("timestamp"))


def records(spark: SparkSession, d: str) -> DataFrame:
    """Events as parsed records with kind: errors, retries (value over 150), mismatches (value under 5) and values."""
    c = F.col
    kind = F.when(c("event_type") == "error", "error").when(c("value") > 150, "retry").when(c("value") < 5, "mismatch").otherwise("value")
    return t(spark, d, "events").select("event_id", "ts", "user_id", c("user_id").cast("string").alias("domain_id"), "event_type", "value", "props", kind.alias("kind"))


KIND = "case when event_type = 'error' then 'error' when value > 150 then 'retry' when value < 5 then 'mismatch' else 'value' end"
REC = f"(select event_id, ts, user_id, user_id::varchar as domain_id, event_type, value, props, {KIND} as kind from events)"


@query("raw_normalize", "select event_id as \"offset\", props as raw_value, case when user_id % 10 <> 0 then user_id::varchar else 'unknown' end as domain_id, event_type as baggage, (user_id % 12)::int as partition from events where event_type <> 'error' and props is not null")
def _(s, d):
    return K.normalize_raw(raw(s, d)).select("offset", "raw_value", "domain_id", "baggage", "partition")


_AT = "concat_ws(':', 'events', user_id % 12, event_id)"


@query("trace_id", f"select event_id as \"offset\", '00-' || md5({_AT}) || '-' || substr(md5({_AT} || ':span'), 1, 16) || '-01' as traceparent from events where event_type <> 'error' and props is not null")
def _(s, d):
    return K.with_traceparent(K.normalize_raw(raw(s, d)), "events").select("offset", "traceparent")


@query("csv_lookup_load", "select c_nationkey::varchar || '.' || c_mktsegment as key, max_by(c_name, c_custkey) as c_name from customer group by all")
def _(s, d):
    c = t(s, d, "customer").withColumn("key", L.composite_key([F.col("c_nationkey").cast("string"), F.col("c_mktsegment")]))
    return L.last_wins(c, ["key"], "c_custkey", ["c_name"])


@query("sink_value", "select domain_id as key, '[{\"k\":' || floor(value)::bigint || '}]' as value, event_id, len(h) as n_headers from (select *, list_filter([domain_id, event_type], lambda x: x <> '') as h from " + REC + ") where kind = 'value'")
def _(s, d):
    r = R.split(records(s, d))["value"].select(F.col("domain_id"), F.array(F.struct(F.floor("value").alias("k"))).alias("out"), F.lit("").alias("traceparent"), F.lit("").alias("cep_entries"), F.col("event_type").alias("duration"), F.col("ts").alias("broker_ts"), "event_id")
    return _value_rows(r)


def _value_rows(r: DataFrame) -> DataFrame:
    out = K.to_value_records(r.select("*"))
    keyed = r.select(F.col("domain_id").alias("key"), F.col("broker_ts").alias("timestamp"), "event_id")
    return out.join(keyed, ["key", "timestamp"]).select("key", "value", "event_id", F.size("headers").cast("long").alias("n_headers"))


def _failed(s, d, kind):
    return R.split(records(s, d))[kind].withColumns({"domain_type": F.lit("mail"), "errors": F.array(F.lit("bad")), "payload": F.col("props"), "raw_value": F.col("props")})


@query("sink_error", "select domain_id as key, '{\"kind\":\"error\",\"stage\":null,\"domainType\":\"mail\",\"domainId\":\"' || domain_id || '\",\"eventType\":\"error\",\"errors\":[\"bad\"],\"payload\":' || to_json(props)::varchar || '}' as value from events_ where kind = 'error'".replace("events_", REC))
def _(s, d):
    return K.to_error_records(_failed(s, d, "error")).select("key", "value")


def _retry_sql(kind):
    return f"select domain_id as key, '{{\"kind\":\"{kind}\",\"domainType\":\"mail\",\"domainId\":\"' || domain_id || '\",\"eventType\":\"' || event_type || '\",\"stageName\":\"\",\"payload\":' || to_json(props)::varchar || '}}' as value from {REC} where kind = '{kind}'"


@query("sink_retry", _retry_sql("retry"))
def _(s, d):
    return K.to_retry_records(_failed(s, d, "retry")).select("key", "value")


@query("sink_mismatch", _retry_sql("mismatch"))
def _(s, d):
    return K.to_mismatch_records(_failed(s, d, "mismatch")).select("key", "value")


XML = "concat('<m:MPE xmlns:m=\"u\"><m:id> ', event_id, ' </m:id><m:code>', event_type, '</m:code>', if(event_id % 2 = 0, '<m:d>a</m:d>', '<m:d>a</m:d><m:d>b</m:d>'), if(event_id % 7 = 0, '<m:open>', ''), '</m:MPE>')"


def xml(s, d):
    return t(s, d, "events").select("event_id", F.expr(XML).alias("raw_value"))


@query("xml_parse", "select event_id, case when event_id % 7 <> 0 then event_id::varchar end as id, case when event_id % 7 <> 0 then event_type end as code, case when event_id % 7 = 0 then 0 when event_id % 2 = 0 then 1 else 2 end as n_d, (event_id % 7 = 0) as bad from events")
def _(s, d):
    m = P.parse_xml(xml(s, d), "id string, code string, d array<string>")
    return m.select("event_id", "message.id", "message.code", F.coalesce(F.size("message.d"), F.lit(0)).alias("n_d"), (F.size("errors") > 0).alias("bad"))


@query("xml_single_or_list", "select event_id, case when event_id % 7 = 0 then null when event_id % 2 = 0 then 'a' else 'a,b' end as items from events")
def _(s, d):
    return P.parse_xml(xml(s, d), "d array<string>").select("event_id", F.array_join("message.d", ",").alias("items"))


@query("xml_extract_id", "select event_id, case when event_id % 7 <> 0 then event_id::varchar end as id, case when event_id % 7 = 0 then 'malformed or invalid XML' end as error, case when event_id % 7 = 0 then 'malformed or invalid XML' else 'not found' end as missing from events")
@query("xml_extract_id_all", "select event_id, case when event_id % 7 <> 0 then event_id::varchar end as id, case when event_id % 7 = 0 then 'malformed or invalid XML' end as error, case when event_id % 7 = 0 then 'malformed or invalid XML' else 'not found' end as missing from events")
def _(s, d):
    rows = xml(s, d).select("event_id", P.extract_id("raw_value", ["MPE", "id"]).alias("x"), P.extract_id("raw_value", ["MPE", "nope"]).alias("y"))
    return rows.select("event_id", "x.id", "x.error", F.col("y.error").alias("missing"))


@query("path_get", "select event_id, json_extract_string(props, '$.k') as k, null::varchar as none from events")
def _(s, d):
    v = t(s, d, "events").withColumn("v", F.try_parse_json("props"))
    return v.select("event_id", P.path_get("v", ["k"]).alias("k"), P.path_get("v", ["k", "x"]).alias("none"))


@query("path_get_string", "select event_id, event_type as name, null::varchar as number from events")
def _(s, d):
    v = t(s, d, "events").withColumn("v", F.try_parse_json(F.to_json(F.struct("event_type", "value"))))
    return v.select("event_id", P.path_get_string("v", ["event_type"]).alias("name"), P.path_get_string("v", ["value"]).alias("number"))


@query("event_type", "select event_id, event_type, 'mail' as domain_type from events")
def _(s, d):
    v = t(s, d, "events").withColumn("v", F.try_parse_json(F.to_json(F.struct("event_type"))))
    return v.select("event_id", P.path_get_string("v", ["event_type"]).alias("event_type"), F.lit("mail").alias("domain_type"))


@query("parameters", "select event_id, case when event_type = 'view' then event_type else 'all' end || ':' || (user_id % 3)::varchar as param_key from events where event_type <> 'error' union all select event_id, null from events where event_type = 'error'")
def _(s, d):
    e = t(s, d, "events")
    out = P.with_parameters(e, {"kind": F.when(F.col("event_type") != "error", "all"), "part": F.col("user_id") % 3}, {"view": {"kind": F.col("event_type")}})
    return out.select("event_id", "param_key")


@query("json_encode_typed", "select event_id, json_extract(props, '$.k')::bigint as k, '{\"k\":' || json_extract(props, '$.k')::varchar || '}' as again from events")
def _(s, d):
    x = t(s, d, "events").withColumn("x", F.from_json("props", "k long"))
    return x.select("event_id", "x.k", F.to_json("x").alias("again"))


@query("json_polymorphic", "select event_id, case when event_type = 'click' then json_extract(props, '$.k')::bigint end as click_k, case when event_type = 'view' then json_extract(props, '$.k')::bigint end as view_k, case when event_type not in ('click', 'view') then 'unknown type ' || event_type end as error from events")
def _(s, d):
    e = t(s, d, "events").withColumn("raw", F.concat(F.lit('{"type":"'), "event_type", F.lit('","payload":'), "props", F.lit("}")))
    cols, error = P.decode_tagged("raw", {"click": "k long", "view": "k long"})
    return e.select("event_id", cols["click"], cols["view"], error.alias("error")).select("event_id", F.col("click.k").alias("click_k"), F.col("view.k").alias("view_k"), "error")


@query("lines_codec", "select doc_id, case when coalesce(text, '') = '' then 0 else len(string_split(regexp_replace(text, '\\n$', ''), chr(10))) end as n, regexp_replace(coalesce(text, ''), '\\n$', '') as again from documents")
def _(s, d):
    x = t(s, d, "documents").withColumn("items", P.decode_lines("text"))
    return x.select("doc_id", F.size("items").cast("long").alias("n"), P.encode_lines("items").alias("again"))


@query("event_log_codec", "select event_id, 'set' as type, 'user.' || event_type as path, value::varchar as value from (select event_id, event_type, floor(value)::bigint as value from events)")
def _(s, d):
    e = t(s, d, "events").select("event_id", P.encode_log(F.lit("set"), F.array(F.lit("user"), "event_type"), F.floor("value").cast("string")).alias("raw"))
    return e.withColumn("c", P.decode_log("raw")).select("event_id", "c.type", F.array_join("c.path", ".").alias("path"), "c.value")


@query("out_explode", "select conv_id, (row_number() over (partition by conv_id order by turn, role) - 1)::bigint as out_at, turn, role as record from conversations")
def _(s, d):
    c = t(s, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("out"))
    return P.explode_out(c).select("conv_id", F.col("out_at").cast("long").alias("out_at"), "record.turn", F.col("record.role").alias("record"))


CONFIGS = [("view:0", "view"), ("view:1", "view"), ("all:0", "click"), ("all:1", "purchase"), ("all:2", "signup")]
CONFIG_SQL = "(select * from (values " + ", ".join(f"('{p}', '{e}')" for p, e in CONFIGS) + ") as c(param_key, event_type))"


def _keyed(s, d):
    e = t(s, d, "events")
    return P.with_parameters(e, {"kind": F.when(F.col("event_type") == "view", "view").otherwise("all"), "part": F.col("user_id") % 3}).withColumn("domain_id", F.when(F.col("user_id") % 10 == 0, "unknown").otherwise(F.col("user_id").cast("string"))).select("event_id", "event_type", "domain_id", "param_key", "value", "user_id")


KEYED = "(select event_id, event_type, value, user_id, case when user_id % 10 = 0 then 'unknown' else user_id::varchar end as domain_id, case when event_type = 'view' then 'view' else 'all' end || ':' || (user_id % 3) as param_key from events)"


def _configs(s):
    return s.createDataFrame([(p, e, "all", f"{p}::all:bizlogic:{e}") for p, e in CONFIGS], "param_key string, event_type string, module string, rule_key string")


@query("reject_checks", f"select event_id, case when domain_id = 'unknown' then 'DomainId is unknown' when param_key not in (select param_key from {CONFIG_SQL}) then 'no config for ' || param_key || '; legal: ' || (select string_agg(distinct param_key, ', ' order by param_key) from {CONFIG_SQL}) end as error from {KEYED}")
def _(s, d):
    return RU.reject(_keyed(s, d), _configs(s)).select("event_id", "error")


@query("config_dispatch", f"select event_id, c.param_key is not null as rule_matched, c.param_key || '::all:bizlogic:' || c.event_type as rule_key from {KEYED} k left join {CONFIG_SQL} c using (param_key, event_type)")
def _(s, d):
    return RU.dispatch_rules(_keyed(s, d), _configs(s), "all").select("event_id", "rule_matched", "rule_key")


@query("rule_eval", f"select event_id, case when c.event_type = 'view' then 'seen:' || user_id when c.event_type = 'purchase' and value > 20 then 'bought:' || user_id else k.event_type end as data from {KEYED} k left join {CONFIG_SQL} c using (param_key, event_type)")
def _(s, d):
    rows = RU.dispatch_rules(_keyed(s, d), _configs(s), "all").withColumn("data", F.col("event_type"))
    texts = {f"{p}::all:bizlogic:{e}": {"view": "concat('seen:', user_id)", "purchase": "if(value > 20, concat('bought:', user_id), null)"}.get(e, "cast(null as string)") for p, e in CONFIGS}
    return RU.eval_rules(rows, RU.compile_rules(s, texts, rows.schema)).select("event_id", "data")


@query("rule_bindings", "select event_id, (user_id::double * 2 + event_id)::bigint as result from events")
def _(s, d):
    return RU.Rule("a * 2 + b").bind("a", F.lit(0)).bind("b", F.col("event_id"), "double").bind("a", F.col("user_id"), "double").coerce(lambda c: c.cast("long")).apply(t(s, d, "events"), "result").select("event_id", "result")


@query("rule_validation", "select event_id, array_to_string(list_filter([case when value < 10 then 'low' end, case when event_type = 'error' then 'failed' end], lambda x: x is not null), ',') as errors from events")
def _(s, d):
    return t(s, d, "events").select("event_id", F.array_join(RU.validate_rules({"low": F.col("value") < 10, "failed": F.col("event_type") == "error"}), ",").alias("errors"))


@query("facet_validation", "select p_partkey, array_to_string(list_filter([case when not regexp_full_match(p_brand, 'Brand#[1-3].*') then 'p_brand: pattern' end, case when p_size > 25 then 'p_size: too large' end, case when try_cast(p_type as int) is null then 'p_type: not int' end], lambda x: x is not null), ',') as errors from part")
def _(s, d):
    spec = {"p_brand": {"required": True, "pattern": "Brand#[1-3].*"}, "p_size": {"maximum": 25}, "p_type": {"type": "int"}}
    return t(s, d, "part").select("p_partkey", F.array_join(RU.facet_errors(spec), ",").alias("errors"))


EVENT = "case event_type when 'signup' then 'EVDAV' when 'click' then 'EVIMC' when 'view' then 'EVGPD' when 'purchase' then 'ENKDN' end"
CATEGORY = "case c_mktsegment when 'BUILDING' then 'Tracked24' when 'AUTOMOBILE' then 'Tracked48' when 'MACHINERY' then 'SpecialDelivery09' else 'SpecialDelivery13' end"
NAMES = {"EVDAV": "Received", "EVIMC": "In transit", "EVGPD": "Out for delivery", "ENKDN": "Delivered"}


def scans(s, d):
    """Events as scans: contacts by user, category by the customer's segment."""
    e = t(s, d, "events").where("event_type <> 'error'")
    kinds = [F.when(F.col("user_id") % m != 0, F.struct(F.lit(n).alias("name"), F.concat(F.lit(p), F.col("user_id").cast("string")).alias("value"))) for n, p, m in (("RECIPIENT_EMAILID", "e", 2), ("RECIPIENT_MOBILENO", "m", 3), ("RECIPIENT_EMAILID", "x", 5))]
    e = e.withColumn("contacts", F.filter(F.array(*kinds), lambda x: x.isNotNull()))
    c = t(s, d, "customer").select(F.col("c_custkey").alias("user_id"), F.expr(CATEGORY).alias("category"))
    return e.join(c, "user_id").select("event_id", F.expr(EVENT).alias("event"), "category", "contacts", F.col("ts").alias("event_time"), F.col("user_id").cast("string").alias("item_id"), F.when(F.col("user_id") % 4 == 0, F.col("value")).alias("longitude"), F.when(F.col("user_id") % 3 == 0, F.col("value")).alias("price"))


SCANS = f"(select event_id, user_id, value, {EVENT} as event, {CATEGORY} as category from events join customer on c_custkey = user_id where event_type <> 'error')"
MATRIX_SQL = "(select * from (values " + ", ".join(str(r) for r in RU.MATRIX) + ") as m(event, category, code, kind))"
NOTE_SQL = f"select event_id, kind, code, case when kind = 1 then case when user_id % 2 <> 0 then 'e' else 'x' end else 'm' end || user_id as destination from {SCANS} join {MATRIX_SQL} using (event, category) where (kind = 1 and (user_id % 2 <> 0 or user_id % 5 <> 0)) or (kind = 2 and user_id % 3 <> 0)"


@query("notification_matrix", NOTE_SQL)
def _(s, d):
    return RU.notifications(scans(s, d), RU.matrix(s)).select("event_id", "kind", "code", "destination")


_NAME_SQL = "case event " + " ".join(f"when '{k}' then '{v}'" for k, v in NAMES.items()) + " end"


@query("tracking_rule", f"select event_id, 'tracking' as type, event as eventCode, {_NAME_SQL} as eventName, user_id::varchar as uniqueItemId, case when user_id % 4 = 0 then value else 0.0 end as longitude from {SCANS}")
def _(s, d):
    return scans(s, d).select("event_id", RU.tracking_record(NAMES).alias("x")).select("event_id", "x.type", "x.eventCode", "x.eventName", "x.uniqueItemId", "x.longitude")


@query("billing_rule", f"select event_id, 'DELIVERY_COMPLETE' as billingCode, case when user_id % 3 = 0 then value else 0.0 end as pricePaid from {SCANS} where event = 'ENKDN'")
def _(s, d):
    return scans(s, d).select("event_id", RU.billing_record().alias("x")).where("x is not null").select("event_id", "x.billingCode", "x.pricePaid")


def _both(s, d, how):
    rows = scans(s, d).withColumn("n", F.when((F.col("event") == "EVGPD") & (F.size("contacts") > 0), F.array(F.lit("notification"))).otherwise(F.array().cast("array<string>")))
    out = how(F.size("n") > 0, F.col("n"), F.array(F.lit("tracking")))
    return rows.select("event_id", F.array_join(out, ",").alias("out"))


_SOME = "event = 'EVGPD' and (user_id % 2 <> 0 or user_id % 3 <> 0 or user_id % 5 <> 0)"


@query("combined_rule", f"select event_id, case when {_SOME} then 'notification,' else '' end || 'tracking' as out from {SCANS}")
def _(s, d):
    return _both(s, d, lambda c, a, b: RU.combined(a, b))


@query("else_branch_rule", f"select event_id, case when {_SOME} then 'notification' else 'tracking' end as out from {SCANS}")
def _(s, d):
    return _both(s, d, RU.deployed)


@query("identity_rule", "select event_id, event_type as out, 1 as n from events")
def _(s, d):
    x = RU.eval_rules(t(s, d, "events").withColumns({"data": F.array("event_type"), "rule_key": F.lit("id")}), RU.compile_rules(s, {"id": "array(event_type)"}, "event_type string"))
    return x.select("event_id", F.array_join("data", ",").alias("out"), F.size("data").alias("n"))


@query("enrich_fixed", "select event_id, 'north' as place from events")
def _(s, d):
    return E.enrich_fixed(t(s, d, "events"), "place", F.lit("north")).select("event_id", "place")


@query("enrich_lookup", "select event_id, case when user_id % 3 = 0 then null when event_type = 'view' and user_id % 3 = 1 then 'seen once' when event_type = 'click' and user_id % 3 = 2 then 'hit twice' end as said from events")
def _(s, d):
    e = t(s, d, "events").withColumn("n", F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 3))
    return E.enrich_lookup(e, ["event_type", "n"], "said", {"view.1": "seen once", "click.2": "hit twice"}).select("event_id", "said")


@query("enrich_csv", "select event_id, n_name as nation, r_name as region from events left join customer on c_custkey = user_id left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def _(s, d):
    return enriched(t(s, d, "events"), s, d).select("event_id", F.col("n.n_name").alias("nation"), F.col("r.r_name").alias("region"))


def enriched(df, s, d):
    """Three lookups of which each needs the one before, given in the wrong order."""
    c = t(s, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), "c_nationkey", "c_mktsegment")
    n = t(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"), "n_name", "n_regionkey")
    r = t(s, d, "region").select(F.col("r_regionkey").cast("string").alias("key"), "r_name")
    return E.enrich_all(
        df,
        [
            ([["n"]], [["r"]], lambda x: E.enrich_table(x, ["n.n_regionkey"], r, "r")),
            ([["c"]], [["n"]], lambda x: E.enrich_table(x, ["c.c_nationkey"], n, "n")),
            ([["user_id"]], [["c"]], lambda x: E.enrich_table(x, ["user_id"], c, "c")),
        ],
    )


@query("enrich_by_event", "select event_id, case when event_type = 'purchase' then c_mktsegment end as segment from events left join customer on c_custkey = user_id")
def _(s, d):
    c = t(s, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), "c_mktsegment")
    return E.enrich_table(t(s, d, "events"), ["user_id"], c, "c", when=F.col("event_type") == "purchase").select("event_id", F.col("c.c_mktsegment").alias("segment"))


@query("composite_key", "select p_partkey, p_brand || '.' || p_type || '.' || p_size as file_key, case when p_size % 5 = 0 then p_type else p_brand || '.' || p_type end as message_key from part")
def _(s, d):
    p = t(s, d, "part").withColumn("b", F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")))
    return p.select("p_partkey", L.composite_key([F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")]).alias("file_key"), L.message_key([F.col("b"), F.col("p_type")]).alias("message_key"))


@query("csv_lookup_values", "select user_id, coalesce(c_name, '') as said from (select distinct user_id from events) left join customer on c_custkey = user_id")
def _(s, d):
    keys = t(s, d, "events").select(F.col("user_id").cast("string").alias("key")).distinct()
    look = t(s, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"))
    return L.lookup_values(keys, look).select(F.col("key").cast("long").alias("user_id"), F.array_join("values", ",").alias("said"))


@query("params_cross", "select r_name || ':' || n_name as param_key from region, nation")
def _(s, d):
    return CF.permutations([t(s, d, "region").select("r_name"), t(s, d, "nation").select("n_name")])


@query("missing_configs", "select r_name || ':' || n_name as param_key from region, nation where (r_regionkey, n_nationkey) not in (select n_regionkey, n_nationkey from nation)")
def _(s, d):
    n, r = t(s, d, "nation"), t(s, d, "region")
    there = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.concat_ws(":", "r_name", "n_name").alias("param_key"))
    return CF.missing_configs(CF.permutations([r.select("r_name"), n.select("n_name")]), there)


def nodes(s, d):
    """A node for each type, brand of a type, and size of a brand: it owns its path and needs the one above."""
    p = t(s, d, "part").select("p_type", "p_brand", F.col("p_size").cast("string").alias("p_size")).distinct()
    parts = [["p_type"], ["p_type", "p_brand"], ["p_type", "p_brand", "p_size"]]
    all_ = None
    for cols in parts:
        rows = p.select(F.array(*cols).alias("path")).distinct().select(F.array_join("path", "/").alias("label"), F.array("path").alias("owns"), (F.array(F.slice("path", 1, len(cols) - 1)) if len(cols) > 1 else F.array().cast("array<array<string>>")).alias("requires"))
        all_ = rows if all_ is None else all_.unionByName(rows)
    return all_


NODES = "(select distinct [p_type] as path from part union all select distinct [p_type, p_brand] from part union all select distinct [p_type, p_brand, p_size::varchar] from part)"


@query("duplicate_producers", f"select array_to_string(path, '/') as path, array_to_string(path, '/') as first, array_to_string(path, '/') || '+' as second from {NODES} where len(path) = 2")
def _(s, d):
    n = nodes(s, d)
    extra = n.where(F.size(F.get("owns", F.lit(0))) == 2).withColumn("label", F.concat("label", F.lit("+")))
    return G.duplicate_producers(n.unionByName(extra)).select(F.array_join("path", "/").alias("path"), "first", "second")


@query("overlapping_producers", f"select array_to_string(a.path, '/') as outer_label, array_to_string(b.path, '/') as inner_label from {NODES} a join {NODES} b on len(a.path) < len(b.path) and b.path[1:len(a.path)] = a.path")
def _(s, d):
    return G.overlapping_producers(nodes(s, d)).select("outer_label", "inner_label")


@query("nearest_owner_edges", f"select array_to_string(path[1:len(path) - 1], '/') as producer, array_to_string(path, '/') as consumer from {NODES} where len(path) > 1")
def _(s, d):
    return G.derive_edges(nodes(s, d))


@query("topo_levels", f"select array_to_string(path, '/') as label, (len(path) - 1)::int as level from {NODES}")
def _(s, d):
    n = nodes(s, d)
    return G.topo_levels(n, G.derive_edges(n))


def changes(s, d):
    """Each event sets the path of its type and appends its value to a common one; signups set that one anew."""
    e = t(s, d, "events").select("user_id", "event_id", "ts", "event_type", F.round("value", 2).cast("string").alias("value"))
    kind = F.when(F.col("event_type") == "signup", "set").otherwise("append")
    return e.select("user_id", "event_id", F.array(F.struct(F.lit("set").alias("type"), F.col("event_type").alias("path"), "value"), F.struct(kind.alias("type"), F.lit("all").alias("path"), "value")).alias("changes"))


@query("log_append", "select user_id, dense_rank() over (partition by user_id order by event_id) - 1 as seq, i::int as idx, case when i = 0 then event_type else 'all' end as path from events, range(2) as r(i)")
def _(s, d):
    return S.append_log(changes(s, d), "user_id", ["event_id"]).select("user_id", "seq", "idx", "change.path")


@query("fold_set", "select user_id, event_type as path, max_by(event_id, event_id)::varchar as value from events group by all")
def _(s, d):
    log = t(s, d, "events").select("user_id", "event_id", F.col("event_type").alias("path"), F.col("event_id").cast("string").alias("value"))
    return S.fold_set(log, "user_id", ["event_id"])


NESTED_SQL = """with l as (select user_id, event_id, case event_type when 'signup' then ['a'] when 'view' then ['a', 'seen'] when 'click' then ['a', 'seen', 'hit'] else ['b', event_type] end as path from events),
m as (select user_id, path, max(event_id) as last_id from l group by all)
select user_id, array_to_string(path, '/') as path, last_id::varchar as value from m where not exists (select 1 from m o where o.user_id = m.user_id and o.last_id > m.last_id and o.path <> m.path
  and (o.path[1:len(m.path)] = m.path or m.path[1:len(o.path)] = o.path))"""


@query("fold_set_nested", NESTED_SQL)
def _(s, d):
    kind, w = F.col("event_type"), lambda *x: F.array(*map(F.lit, x))
    path = F.when(kind == "signup", w("a")).when(kind == "view", w("a", "seen")).when(kind == "click", w("a", "seen", "hit")).otherwise(F.array(F.lit("b"), kind))
    log = t(s, d, "events").select("user_id", "event_id", path.alias("path"), F.col("event_id").cast("string").alias("value"))
    return S.fold_set(log, "user_id", ["event_id"]).withColumn("path", F.array_join("path", "/"))


FOLD_SQL = "with e as (select *, count(*) filter (where event_type = 'signup') over (partition by user_id order by event_id) as g from events), m as (select user_id, max(g) as g from e group by user_id), x as (select user_id, string_agg(event_id::varchar, ',' order by event_id) filter (where event_type <> 'signup') as added, max(event_id) filter (where event_type = 'signup')::varchar as seed from e join m using (user_id, g) group by user_id)"


def _fold(s, d, strict):
    kind = F.when(F.col("event_type") == "signup", "set").otherwise("append")
    log = t(s, d, "events").select("user_id", "event_id", F.lit("all").alias("path"), kind.alias("type"), F.col("event_id").cast("string").alias("value"))
    return S.fold_append(log, "user_id", ["event_id"], strict=strict)


@query("fold_append", f"{FOLD_SQL} select user_id, coalesce(added, seed) as items from x")
def _(s, d):
    return _fold(s, d, False).select("user_id", F.array_join("items", ",").alias("items"))


@query("strict_append", f"{FOLD_SQL} select user_id, (added is not null and seed is not null) as error from x")
def _(s, d):
    return _fold(s, d, True).select("user_id", "error")


@query("running_state", "select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as state_bought from events")
def _(s, d):
    e = t(s, d, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return S.running_state(e, "user_id", ["ts", "event_id"], ["bought"]).select("event_id", "state_bought")


@query("sticky_enrichment", "select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as sticky_bought from events")
def _(s, d):
    e = t(s, d, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return S.sticky(e, "user_id", ["ts", "event_id"], "bought").select("event_id", "sticky_bought")


@query("ring_log", "select event_id, coalesce(array_to_string(list(event_id) over (partition by user_id order by ts, event_id rows between 6 preceding and 1 preceding), ','), '') as ring from events")
def _(s, d):
    return S.ring_log(t(s, d, "events"), "user_id", ["ts", "event_id"], "event_id").select("event_id", F.array_join(F.col("ring").cast("array<string>"), ",").alias("ring"))


@query("state_snapshot", "select user_id, coalesce(max_by(event_id, event_id) filter (where event_type = 'view'), -1) as viewed, coalesce(max_by(event_id, event_id) filter (where event_type = 'click'), -1) as clicked from events group by user_id")
def _(s, d):
    path = F.when(F.col("event_type") == "view", "viewed").when(F.col("event_type") == "click", "clicked").otherwise("other")
    log = t(s, d, "events").select("user_id", "event_id", path.alias("path"), F.col("event_id").alias("value"))
    return S.state_snapshot(log, "user_id", ["event_id"], {"viewed": -1, "clicked": -1})


@query("log_sequence", "select event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as seq from events")
def _(s, d):
    return S.with_log_seq(t(s, d, "events"), "user_id", ["ts", "event_id"]).select("event_id", "seq")


@query("log_size", "select event_id, 2::bigint as own_entries, (2 * count(*) over (partition by user_id order by event_id))::bigint as log_entries from events")
def _(s, d):
    return S.with_log_size(changes(s, d), "user_id", ["event_id"], "changes").select("event_id", "own_entries", "log_entries")


@query("key_order", "select event_id, row_number() over (partition by user_id order by ts, event_id) - 1 as seq from events")
def _(s, d):
    return S.with_log_seq(S.order_by_key(t(s, d, "events"), "user_id", ["ts", "event_id"]), "user_id", ["ts", "event_id"]).select("event_id", "seq")


@query("discard_failed_changes", f"select user_id, count(*) as n from {REC} where kind = 'value' group by user_id")
def _(s, d):
    return R.split(records(s, d))["value"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("remember_rule_input", "select event_id, event_type as input_data, last_value(case when event_type = 'purchase' then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as input_state_bought, case when event_type = 'error' then event_type else 'seen ' || event_type end as data, case when event_type = 'error' then 'ValueEnvelope.map' end as stage from events")
def _(s, d):
    """Message and state as they were before the rule, also of rows whose rule fails."""
    e = t(s, d, "events").withColumns({"data": F.col("event_type"), "rule_key": F.lit("k"), "bought": F.when(F.col("event_type") == "purchase", F.col("value"))})
    rows = RU.with_rule_input(S.running_state(e, "user_id", ["ts", "event_id"], ["bought"]), ["data", "state_bought"])
    return RU.eval_each(rows, {"k": F.expr("if(data = 'error', raise_error('failed'), concat('seen ', data))")}).select("event_id", "input_data", "input_state_bought", "data", "stage")


@query("split_kinds", f"select kind, count(*) as n from {REC} group by kind")
def _(s, d):
    parts = R.split(records(s, d))
    out = None
    for k, x in parts.items():
        n = x.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
        out = n if out is None else out.unionByName(n)
    return out.where("n > 0")


@query("failure_to_error", "select event_id, case n when 0 then 'a' when 1 then 'a|b' when 2 then 'a|b|c|...' else 'a|b|c|...' end as errors from (select event_id, event_id % 4 as n from events)")
def _(s, d):
    e = t(s, d, "events").withColumn("causes", F.expr("slice(array('a', 'b', 'c', 'd'), 1, cast(event_id % 4 as int) + 1)"))
    return e.select("event_id", F.array_join(R.failure_errors("causes"), "|").alias("errors"))


@query("timeout_to_retry", "select event_id, case when value > 50 then 'retry' else 'value' end as kind from events")
def _(s, d):
    return t(s, d, "events").select("event_id", R.kind_by_time("value", 50).alias("kind"))


@query("error_context", "select event_id, 'ctx: ' || event_type || '|ctx: late' as errors from events")
def _(s, d):
    return t(s, d, "events").withColumn("e", F.array("event_type", F.lit("late"))).select("event_id", F.array_join(R.prefix_errors("e", "ctx: "), "|").alias("errors"))


COMPARE = "(select o_orderkey, round(o_totalprice, 0) as expected, (select 1) as one, round(s, 0) as actual from orders left join (select l_orderkey, sum(l_extendedprice) as s from lineitem group by l_orderkey) on l_orderkey = o_orderkey)"


def compared(s, d):
    li = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s"))
    o = t(s, d, "orders")
    both = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    return R.compare(both, F.round("s", 0), F.round("o_totalprice", 0))


@query("compare_projection", f"select o_orderkey, actual is distinct from expected as mismatch from {COMPARE}")
def _(s, d):
    return compared(s, d).select("o_orderkey", "mismatch")


@query("mismatch_record", f"select o_orderkey, expected as expected_projection from {COMPARE} where actual is distinct from expected")
def _(s, d):
    return compared(s, d).where("mismatch").select("o_orderkey", "expected_projection")


@query("first_hit", f"select min(o_orderkey) as o_orderkey from {COMPARE} where actual is distinct from expected")
def _(s, d):
    return R.first_mismatch(compared(s, d), ["o_orderkey"]).select("o_orderkey")


STAGES = [(0, 500, 100), (1, 1000, 100), (2, 2000, 100)]


def failed(s, d):
    e = t(s, d, "events").where("event_type = 'error'")
    r = S.with_log_seq(e, "user_id", ["ts", "event_id"]).select("event_id", F.lit("mail").alias("topic"), F.col("user_id").cast("string").alias("domain_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("acquired_ms"), F.least(F.col("seq"), F.lit(3)).cast("int").alias("retries"))
    return R.schedule_retries(r, s.createDataFrame(STAGES, "retry int, timeout_ms long, jitter_ms long"), 100)


@query("retry_schedule", "select event_id, retries > 2 as give_up, case when retries <= 2 then acquired_ms + 500 * (1 << retries) end as least_ms, true as within from (select event_id, epoch_us(ts) // 1000 as acquired_ms, least(row_number() over (partition by user_id order by ts, event_id) - 1, 3) as retries from events where event_type = 'error')")
def _(s, d):
    base = F.when(~F.col("give_up"), F.col("acquired_ms") + 500 * F.pow(F.lit(2), F.col("retries")).cast("long"))
    return failed(s, d).select("event_id", "give_up", base.alias("least_ms"), (F.col("give_up") | F.col("due_ms").between(base, base + 100)).alias("within"))


@query("retry_dedupe", "select user_id::varchar as domain_id, 1::bigint as n from events where event_type = 'error' group by user_id")
def _(s, d):
    return R.dedupe_retries(failed(s, d), "event_id").groupBy("domain_id").agg(F.count(F.lit(1)).alias("n"))


@query("retries_due", "select event_id from (select event_id, epoch_us(ts) // 1000 as a, row_number() over (partition by user_id order by ts, event_id) - 1 as retries from events where event_type = 'error') where retries = 0 and a < (select epoch_us(max(ts)) // 1000 from events) - 3600000")
def _(s, d):
    now = t(s, d, "events").agg(F.unix_millis(F.max("ts").cast("timestamp"))).first()[0] - 3_600_000
    return R.retries_due(failed(s, d).where("retries = 0"), now + 600, 100).where(F.col("acquired_ms") < now).select("event_id")


@query("retry_metrics", "select count(*) filter (where retries <= 2) as added, count(*) filter (where retries > 2) as give_up, count(*) filter (where retries = 1) as second_stage from (select row_number() over (partition by user_id order by ts, event_id) - 1 as retries from events where event_type = 'error')")
def _(s, d):
    return failed(s, d).agg(F.count(F.when(~F.col("give_up"), 1)).alias("added"), F.count(F.when(F.col("give_up"), 1)).alias("give_up"), F.count(F.when(F.col("retries") == 1, 1)).alias("second_stage"))


@query("offset_dedupe", "select user_id::varchar as domain_id, event_id as \"offset\" from events where event_type <> 'click'")
def _(s, d):
    r = records(s, d).withColumnRenamed("event_id", "offset")
    return R.dedupe_offsets(r.unionByName(r), r.where("event_type = 'click'").select("domain_id", "offset")).select("domain_id", "offset")


@query("backlog_view", "select event_id as \"offset\", row_number() over (partition by user_id order by event_id) - 1 as place from events")
def _(s, d):
    return R.backlog(records(s, d).withColumnRenamed("event_id", "offset")).select("offset", "place")


@query("outcome_counts", f"select coalesce(kind, 'total') as kind, count(*) as n from {REC} group by rollup(kind)")
def _(s, d):
    return M.outcome_counts(records(s, d))


@query("latency", "select event_type, count(*) as n, round(quantile_cont(greatest(0, value), 0.5), 4) as p50, round(quantile_cont(greatest(0, value), 0.95), 4) as p95, round(quantile_cont(greatest(0, value), 0.99), 4) as p99 from events group by event_type")
def _(s, d):
    return M.latency_quantiles(t(s, d, "events"), "event_type", "value").select("event_type", "n", *[F.round(p, 4).alias(p) for p in ("p50", "p95", "p99")])


@query("latency_last_n", "select event_type, count(*) as n, round(quantile_cont(value, 0.5), 4) as p50 from (select *, row_number() over (partition by event_type order by event_id desc) as k from events) where k <= 2048 group by event_type")
def _(s, d):
    return M.latency_quantiles(M.last_n(t(s, d, "events"), "event_type", "event_id"), "event_type", "value").select("event_type", "n", F.round("p50", 4).alias("p50"))


@query("rate_60s", "select time_bucket(interval 60 seconds, ts) as start, event_type, count(*) as n, count(*) / 60.0::double as rate from events group by all")
def _(s, d):
    return M.rate(t(s, d, "events"), "ts", "event_type")


PERF = f"(select time_bucket(interval 3600 seconds, ts) as start, " + ", ".join(f"count(*) filter (where kind = '{k}') as {k}" for k in R.KINDS) + f" from {REC} group by all)"


@query("perf_windows", "select start, value, error, total_value, round(coalesce(total_error / nullif(total_value + total_error, 0), 0.0), 9) as error_share, round((value + error + retry + mismatch) / 3600.0::double, 9) as rate from (select *, (sum(value) over (order by start))::bigint as total_value, (sum(error) over (order by start))::bigint as total_error from " + PERF + ")")
def _(s, d):
    return M.perf_windows(records(s, d), "ts", "kind", 3600).select("start", "value", "error", "total_value", F.round("error_share", 9).alias("error_share"), F.round("rate", 9).alias("rate"))


@query("throughput_2s", "select start, n, (sum(n) over (order by start))::bigint as total from (select time_bucket(interval 2 seconds, ts) as start, count(*) as n from events group by all)")
def _(s, d):
    return M.throughput(t(s, d, "events"), "ts")


@query("quantile_summary", "select q, round(avg(v), 4) as avg, round(max(v), 4) as max from (select user_id % 4 as k, 'p50' as q, quantile_cont(greatest(0, value), 0.5) as v from events group by all union all select user_id % 4, 'p95', quantile_cont(greatest(0, value), 0.95) from events group by all) group by q")
def _(s, d):
    each = M.latency_quantiles(t(s, d, "events").withColumn("k", F.col("user_id") % 4), "k", "value")
    return M.quantile_summary(each.select(F.expr("stack(2, 'p50', p50, 'p95', p95) as (q, v)")), "q", "v").select("q", F.round("avg", 4).alias("avg"), F.round("max", 4).alias("max"))


@query("metric_name_guard", "select name, legal, legal and row_number() over (partition by legal order by first_seen, name) <= 20 as accepted from (select name, first_seen, regexp_full_match(name, '[A-Za-z0-9_.-]{1,120}') as legal from (select event_type || case when user_id % 2 = 0 then '.' else ' ' end || user_id % 20 as name, min(event_id) as first_seen from events group by all))")
def _(s, d):
    e = t(s, d, "events").select("event_id", F.concat("event_type", F.when(F.col("user_id") % 2 == 0, ".").otherwise(" "), (F.col("user_id") % 20).cast("string")).alias("name"))
    return M.check_metric_names(e, "name", "event_id", 20).select("name", "legal", "accepted")


def aspects(s, d):
    """Nations as aspects: the region says which, the name's first letter which module."""
    n = t(s, d, "nation")
    return n.select(F.element_at(F.array(*map(F.lit, [*CF.ASPECTS, "bizlogic"])), F.col("n_regionkey") + 1).alias("aspect"), F.substring("n_name", 1, 1).alias("module"), "n_name")


@query("module_names", "select distinct substr(n_name, 1, 1) as module from nation where n_regionkey <> 2")
def _(s, d):
    return CF.module_names(aspects(s, d))


@query("rules_override", "select n_name from nation where n_regionkey in (3, 4)")
def _(s, d):
    return CF.override_rules(aspects(s, d)).select("n_name")


@query("config_flatten", "select n_name as param_key, 'seen' as event_type, 'bizlogic' as aspect, 'all' as module, 'cel' as type from nation union all select n_name, 'seen', 'enrichment', 'all', 'fixed' from nation")
def _(s, d):
    body = F.lit('{"events":{"seen":{"bizlogic":{"all":{"type":"cel","cel":"x"}},"enrichment":{"all":{"type":"fixed"}}}}}')
    n = t(s, d, "nation").select(F.col("n_name").alias("param_key"), F.from_json(body, f"events map<string, {CF._EVENT}>").alias("config"))
    return CF.flatten_config(n).select("param_key", "event_type", "aspect", "module", "type")


@query("schema_names", "select distinct trim(x) as name, case when trim(x) = '' then 'blank schema name' end as error from (select case when n_nationkey % 5 = 0 then '  ' else ' ' || n_name || ' ' end as x from nation)")
def _(s, d):
    return CF.schema_names(t(s, d, "nation").select(F.when(F.col("n_nationkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "n_name", F.lit(" "))).alias("x")), "x")


@query("config_errors", "select r_name as name, i::int as at, case when i = 0 and r_regionkey % 2 = 0 then 'no default' else 'default is not legal' end as error from region, range(1) as t(i) where r_regionkey % 2 = 0 or r_regionkey = 1")
def _(s, d):
    n = t(s, d, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("legal"))
    r = t(s, d, "region")
    both = r.join(n, r["r_regionkey"] == n["n_regionkey"])
    default = F.when(F.col("r_regionkey") % 2 == 0, None).when(F.col("r_regionkey") == 1, "nowhere").otherwise(F.get("legal", F.lit(0)))
    return CF.config_errors(both.select(F.col("r_name").alias("name"), "legal", default.alias("default_value")))


@query("late_rows", "select event_id from (select event_id, ts, max(ts) over (order by event_id rows between unbounded preceding and 1 preceding) as seen from (select event_id, ts - case when event_id % 10 = 0 then interval 1 day else interval 0 second end as ts from events)) where ts < seen - interval 1 hour")
@query("late_rows_all", "select event_id from (select event_id, ts, max(ts) over (order by event_id rows between unbounded preceding and 1 preceding) as seen from (select event_id, ts - case when event_id % 10 = 0 then interval 1 day else interval 0 second end as ts from events)) where ts < seen - interval 1 hour")
def _(s, d):
    from keyflow.streaming.streams import late_rows

    e = t(s, d, "events").withColumn("ts", F.col("ts") - F.expr("if(event_id % 10 = 0, interval 1 day, interval 0 second)"))
    return late_rows(e, "ts", "event_id", "1 hour").select("event_id")


def flagship(s: SparkSession, d: str) -> DataFrame:
    """Records through the whole flow: normalize, parse, parameters, dispatch, enrich, state, rule, counts by kind and segment."""
    c = F.col
    e = t(s, d, "events")
    rows = e.select("event_id", "ts", "user_id", "value", F.expr(XML).alias("raw_value"))
    parsed = P.parse_xml(rows, "id string, code string, d array<string>").withColumn("event_type", c("message.code"))
    keyed = P.with_parameters(parsed, {"kind": F.when(c("event_type") == "view", "view").otherwise("all"), "part": c("user_id") % 3})
    full = enriched(RU.dispatch_rules(keyed, _configs(s), "all"), s, d)
    state = S.running_state(full.withColumn("bought", F.when(c("event_type") == "purchase", c("value"))), "user_id", ["ts", "event_id"], ["bought"])
    texts = {f"{p}::all:bizlogic:{e}": "if(state_bought is null, 'new', 'known')" for p, e in CONFIGS}
    done = RU.eval_rules(state.withColumn("data", F.lit("other")), RU.compile_rules(s, texts, state.schema))
    kind = F.when(F.size("errors") > 0, "error").otherwise("value")
    return done.groupBy(kind.alias("kind"), c("c.c_mktsegment").alias("segment"), "data").agg(F.count(F.lit(1)).alias("n"))


QUERIES["flow"] = flagship
ORACLES["flow"] = (
    f"select kind, segment, data, count(*) as n from (select event_id % 7 = 0 as bad, case when event_id % 7 = 0 then 'error' else 'value' end as kind, c_mktsegment as segment, "
    f"case when c.param_key is null or event_id % 7 = 0 then 'other' when last_value(case when k.event_type = 'purchase' and event_id % 7 <> 0 then value end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) is null then 'new' else 'known' end as data "
    f"from (select event_id, ts, user_id, value, event_type, case when event_type = 'view' then 'view' else 'all' end || ':' || (user_id % 3) as param_key from events) k left join {CONFIG_SQL} c using (param_key, event_type) left join customer on c_custkey = user_id) group by all"
)
