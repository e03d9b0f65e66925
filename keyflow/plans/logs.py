"""Queries of change logs folded to trees, folds in order, rules that fail, sketches and overrides, with SQL that has to give the same rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from keyflow.functions import paths as P
from keyflow.functions import schemas as X
from keyflow.operators import configs as CF
from keyflow.operators import folds
from keyflow.operators import metrics as M
from keyflow.operators import rules as RU
from keyflow.plans.queries import query, t


def tree_log(s, d):
    """Events as changes: signups set a map, clicks a name in it, views append below it, errors set a list or a value, purchases append to that."""
    e, kind, c = t(s, d, "events"), F.col("event_type"), F.col("event_id").cast("string")
    path = F.when(kind == "signup", F.array(F.lit("a"))).when(kind == "click", F.array(F.lit("a"), F.lit("last"))).when(kind == "view", F.array(F.lit("a"), F.lit("seen"))).otherwise(F.array(F.lit("b")))
    value = F.when(kind == "signup", F.concat(F.lit('{"n":'), c, F.lit("}"))).when((kind == "error") & (F.col("user_id") % 2 == 0), F.concat(F.lit("["), c, F.lit("]"))).otherwise(c)
    return e.select("user_id", "event_id", F.when(kind.isin("view", "purchase"), "append").otherwise("set").alias("type"), path.alias("path"), F.parse_json(value).alias("value"))


TREE_SQL = """with s as (select user_id, max(event_id) filter (where event_type = 'signup') as n, max(event_id) filter (where event_type = 'error') as e, max(event_id) filter (where event_type = 'purchase') as p from events group by user_id),
x as (select s.user_id, n, e, max(v.event_id) filter (where event_type = 'click' and event_id > coalesce(n, -1)) as last,
  string_agg(event_id::varchar, ',' order by event_id) filter (where event_type = 'view' and event_id > coalesce(n, -1)) as seen,
  string_agg(event_id::varchar, ',' order by event_id) filter (where event_type = 'purchase' and event_id > coalesce(e, -1)) as bought from s join events v using (user_id) group by all),
j as (select user_id, concat_ws(',', '"last":' || last, '"n":' || n, '"seen":[' || seen || ']') as a,
  case when e is null then '[' || bought || ']' when user_id % 2 = 0 then '[' || concat_ws(',', e::varchar, bought) || ']' when bought is null then e::varchar else '[' || bought || ']' end as b from x)
select user_id, '{' || concat_ws(',', case when a <> '' then '"a":{' || a || '}' end, '"b":' || b) || '}' as state from j"""


@query("tree_state", TREE_SQL)
def _(s, d):
    return folds.fold_tree(tree_log(s, d), "user_id", ["event_id"])


@query("tree_snapshot", f"select user_id, json_extract_string(state, '$.a.n')::bigint as signed_up, coalesce(json_array_length(state, '$.a.seen'), 0)::bigint as n_seen, json_extract_string(state, '$.from') as source from (select user_id, json_merge_patch('{{\"from\":\"start\"}}', state) as state from ({TREE_SQL}))")
def _(s, d):
    x = folds.tree_snapshot(tree_log(s, d), "user_id", ["event_id"], '{"from": "start"}')
    seen = F.try_variant_get("state", "$.a.seen", "array<long>")
    return x.select("user_id", F.try_variant_get("state", "$.a.n", "long").alias("signed_up"), F.coalesce(F.size(seen), F.lit(0)).cast("long").alias("n_seen"), P.path_get_string("state", ["from"]).alias("source"))


def _turn(state, row):
    first, last, turns, n = state
    kind = row["event_type"]
    return (kind if first is None else first, kind, turns + (last is not None and last != kind), n + 1)


#: How often the type changes from one event of a key to the next: the ends of two parts decide about the place where they meet.
TURNS = folds.Fold(lambda: (None, None, 0, 0), _turn, lambda a, b: (a[0], b[1], a[2] + b[2] + (a[1] != b[0]), a[3] + b[3]), json.dumps)


@query("log_fold", "select part, arg_min(event_type, event_id) as first, arg_max(event_type, event_id) as last, count(*) filter (where event_type <> before) as turns, count(*) as n from (select *, lag(event_type) over (partition by part order by event_id) as before from (select *, case when user_id % 3 = 0 then 0 else user_id end as part from events)) group by part")
def _(s, d):
    e = t(s, d, "events").withColumn("part", F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")))  # one key has a third of all rows
    state = folds.fold_log(e, "part", ["event_id"], TURNS, ["event_type"]).withColumn("x", F.split(F.translate("state", '[]" ', ""), ","))
    return state.select("part", F.get("x", F.lit(0)).alias("first"), F.get("x", F.lit(1)).alias("last"), F.get("x", F.lit(2)).cast("long").alias("turns"), F.get("x", F.lit(3)).cast("long").alias("n"))


FAILING = {"view": "concat('share ', cast(100 div (user_id % 7) as string))", "purchase": "if(value > 20, concat('bought ', user_id), cast(cast(event_type as int) as string))", "click": "if(event_id % 5 = 0, raise_error('told to'), cast(null as string))", "signup": "element_at(array('a', 'b', 'c'), cast(user_id % 5 as int))"}
_FAILS = "(event_type = 'view' and user_id % 7 = 0) or (event_type = 'purchase' and not value > 20) or (event_type = 'click' and event_id % 5 = 0) or (event_type = 'signup' and user_id % 5 not in (1, 2, 3))"


@query("rule_failures", f"select event_id, case when {_FAILS} then props when event_type = 'view' then 'share ' || (100 // (user_id % 7)) when event_type = 'purchase' then 'bought ' || user_id when event_type = 'signup' then chr((96 + user_id % 5)::int) else props end as data, case when {_FAILS} then 'ValueEnvelope.map' end as stage, case when {_FAILS} then 'Exception in map: ValueEnvelope/rule ' || event_type || ' failed' else '' end as errors from events")
def _(s, d):
    rows = t(s, d, "events").withColumns({"data": F.col("props"), "rule_key": F.col("event_type")})
    out = RU.eval_each(rows, RU.compile_rules(s, FAILING, rows.schema, rows.schema["data"].dataType))
    return out.select("event_id", "data", "stage", F.array_join("errors", "|").alias("errors"))


@query("latency_sketches", "select event_type, count(*) as n, true as p50_fits, true as p95_fits, true as p99_fits from events group by event_type")
def _(s, d):
    """Sketches of a day each, merged: the rank of each quantile among all rows is off by no more than the stated error."""
    e = t(s, d, "events").withColumn("day", F.date_trunc("day", "ts"))
    got = M.merged_quantiles(M.latency_sketches(e, ["event_type", "day"], "value"), ["event_type"])
    both = e.join(F.broadcast(got), "event_type")  # a row a type
    x, out = F.greatest(F.lit(0.0), F.col("value")), []
    for q in (50, 95, 99):
        below, upto = F.avg((x < F.col(f"p{q}")).cast("double")), F.avg((x <= F.col(f"p{q}")).cast("double"))
        out.append(((below <= q / 100 + M.RANK_ERROR) & (upto >= q / 100 - M.RANK_ERROR)).alias(f"p{q}_fits"))
    return both.groupBy("event_type").agg(F.max("n").alias("n"), *out)


@query("path_names", "select event_id, event_type as spaced, user_id::varchar as dotted, 'q' as quoted, case when user_id % 2 = 0 then event_id::varchar end as both, null::varchar as none from events")
def _(s, d):
    """Names with blanks, dots and quotes of both kinds."""
    both = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit(',"\'\\""'), F.lit(":"), F.col("event_id").cast("string"))).otherwise("")
    body = F.concat(F.lit('{"a b":{"c.d":"'), "event_type", F.lit('"},"x.y":'), F.col("user_id").cast("string"), F.lit(',"it\'s":"q"'), both, F.lit("}"))
    v = t(s, d, "events").select("event_id", F.try_parse_json(body).alias("v"))
    return v.select("event_id", P.path_get_string("v", ["a b", "c.d"]).alias("spaced"), P.path_get("v", ["x.y"]).alias("dotted"), P.path_get("v", ["it's"]).alias("quoted"), P.path_get("v", ["'\""]).alias("both"), P.path_get("v", ["x", "y"]).alias("none"))


@query("override_payload", """select c_mktsegment || ':' || c_nationkey as param_key, 'seen' as event_type, 'all' as module, 'cel' as type, 'r' || max(c_custkey) as cel, c_mktsegment || ':' || c_nationkey || '::all:bizlogic:seen' as rule_key, null as error from customer where c_custkey % 10 <> 0 group by c_mktsegment, c_nationkey
union all select null, null, null, null, null, null, 'payload without a config' from customer where c_custkey % 10 = 0""")
def _(s, d):
    key = F.concat_ws(":", "c_mktsegment", F.col("c_nationkey").cast("string"))
    body = F.concat(F.lit('{"celProjection":"p","config":{"'), key, F.lit('":{"events":{"seen":{"bizlogic":{"all":{"type":"cel","cel":"r'), F.col("c_custkey").cast("string"), F.lit('"}},"enrichment":{"all":{"type":"fixed"}}},"empty":{"validation":{"all":{"type":"x"}}}}},"none:'), key, F.lit('":{"events":{"seen":{"bizlogic":{}}}}}}'))
    c = t(s, d, "customer").select(F.col("c_custkey").alias("at"), F.lit("root").alias("root"), F.when(F.col("c_custkey") % 10 != 0, body).otherwise("no json").alias("payload"))
    return CF.override_payload(c).select("param_key", "event_type", "module", "type", "cel", "rule_key", "error")


SCAN_XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:simpleType name="kind"><xs:restriction base="xs:string"><xs:enumeration value="view"/><xs:enumeration value="click"/></xs:restriction></xs:simpleType>
  <xs:simpleType name="user"><xs:restriction base="xs:int"><xs:maxInclusive value="90"/></xs:restriction></xs:simpleType>
  <xs:element name="scan"><xs:complexType><xs:sequence>
    <xs:element name="id" type="xs:long"/><xs:element name="kind" type="kind"/><xs:element name="user" type="user" minOccurs="0" maxOccurs="2"/>
  </xs:sequence></xs:complexType></xs:element>
</xs:schema>"""
_KIND_ERROR = "'[2] line 3, col ' || (7 + len(event_type)) || ': element kind: ' || chr(39) || event_type || chr(39) || ' is not one of view, click'"
_USER_ERROR = "'[2] line 4, col ' || (7 + len(user_id::varchar)) || ': element user: ' || chr(39) || user_id || chr(39) || ' does not fit maxInclusive 90'"


@query("xml_violations", f"select event_id, case when event_id % 5 = 0 then '[2] line 3, col 1: element user is not expected here in element scan' when event_type not in ('view', 'click') then {_KIND_ERROR} when user_id > 90 then {_USER_ERROR} when event_id % 7 = 0 then '[3] line 5, col 3: mismatched tag' end as error from events")
def _(s, d):
    kind = F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("\n<kind>"), "event_type", F.lit("</kind>"))).otherwise("")
    end = F.when(F.col("event_id") % 7 == 0, "</other>").otherwise("</scan>")
    raw = F.concat(F.lit("<scan>\n<id>"), F.col("event_id").cast("string"), F.lit("</id>"), kind, F.lit("\n<user>"), F.col("user_id").cast("string"), F.lit("</user>\n"), end)
    return X.validate_xml(t(s, d, "events").withColumn("raw_value", raw), SCAN_XSD).select("event_id", F.get("errors", F.lit(0)).alias("error"))
