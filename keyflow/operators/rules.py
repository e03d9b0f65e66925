"""Rules: dispatch by configuration, evaluation, validation, and the parcel rules."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.operators.enrich import sized


def dispatch_rules(df: DataFrame, rules: DataFrame, module: str) -> DataFrame:
    """df with the rule_key of (param_key, event_type, module) and rule_matched; rows without a rule pass through."""
    keys = rules.where(F.col("module") == module).select("param_key", "event_type", "rule_key")
    return df.join(sized(keys), ["param_key", "event_type"], "left").withColumn("rule_matched", F.col("rule_key").isNotNull())


def reject(df: DataFrame, configs: DataFrame) -> DataFrame:
    """df with errors for an unknown domain, a missing event type, and a param_key that has no configuration.

    The list of legal keys is one row, which every row that is in error has to name.
    """
    legal = configs.agg(F.array_join(F.array_sort(F.collect_set("param_key")), ", ").alias("legal"))
    known = configs.select("param_key", F.lit(True).alias("__known")).distinct()
    out = df.join(sized(known), "param_key", "left").join(F.broadcast(legal))
    errors = F.when(F.col("domain_id") == "unknown", "DomainId is unknown").when(F.col("event_type").isNull(), "no event type").when(F.col("__known").isNull(), F.concat(F.lit("no config for "), F.coalesce("param_key", F.lit("null")), F.lit("; legal: "), "legal"))
    return out.withColumn("error", errors).drop("__known", "legal")


def compile_rules(spark: SparkSession, rules: dict[str, str], schema: T.StructType | str, result: T.DataType | str | None = None) -> dict[str, Column]:
    """Rule texts as columns, after each has been analysed against the schema; all failures are reported together.

    With ``result`` a rule of another type is a failure too; one that only ever gives null has any type.
    """
    empty, errors = spark.createDataFrame([], schema), []
    wanted = (result if isinstance(result, str) else result.simpleString()) if result is not None else None
    for key in sorted(rules):
        try:
            kind = empty.select(F.expr(rules[key])).schema[0].dataType.simpleString()
            if wanted is not None and kind not in (wanted, "void"):
                errors.append(f"{key}: the result is of type {kind}, not {wanted}")
        except AnalysisException as e:
            errors.append(f"{key}: {str(e).splitlines()[0]}")
    if errors:
        raise ValueError("\n".join(errors))
    return {key: F.expr(rules[key]) for key in sorted(rules)}


def eval_rules(df: DataFrame, compiled: dict[str, Column], data: str = "data", key: str = "rule_key") -> DataFrame:
    """data replaced by what the row's rule gives; a null result or no rule leaves it."""
    result = F.lit(None)
    for k, rule in compiled.items():
        result = F.when(F.col(key) == k, rule).otherwise(result)
    return df.withColumn(data, F.coalesce(result, F.col(data)))


#: How results are kept as text between being made and being read: nothing of a value may be lost.
_KEPT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
RULE_STAGE, RULE_TEXT = "ValueEnvelope.map", "Exception in map: ValueEnvelope/"


def attempt(rule: Column, kind: T.DataType | str) -> Column:
    """A rule's result as bytes, null where it fails: nothing that a row does to a rule ends the query.

    try_to_binary gives null if its argument cannot be made, and the argument is the whole rule, whatever is in it (casts,
    divisions, elements, raise_error). ``attempted`` reads the result.
    """
    return F.try_to_binary(F.to_json(F.struct(rule.cast(kind).alias("v")), _KEPT), F.lit("utf-8"))


def attempted(kept: Column, kind: T.DataType | str) -> Column:
    name = kind if isinstance(kind, str) else kind.simpleString()
    return F.from_json(F.decode(kept, "utf-8"), f"struct<v: {name}>", _KEPT)["v"]


def with_rule_input(df: DataFrame, columns: list[str], prefix: str = "input_") -> DataFrame:
    """df with the message and the state that rules are about to see under names of their own; rows do not change, so no copy is made."""
    return df.withColumns({f"{prefix}{c}": F.col(c) for c in columns})


def eval_each(df: DataFrame, compiled: dict[str, Column], data: str = "data", key: str = "rule_key") -> DataFrame:
    """As eval_rules, with stage and errors: a row whose rule fails keeps its data and has the stage and a text; others have null and no errors."""
    kind, kept = df.schema[data].dataType, F.lit(None).cast("binary")
    for k, rule in compiled.items():
        kept = F.when(F.col(key) == k, attempt(rule, kind)).otherwise(kept)
    rows = df.drop("stage", "errors").withColumn("__kept", kept)
    failed = F.col(key).isin(list(compiled)) & F.col("__kept").isNull()
    rows = rows.withColumn(data, F.coalesce(attempted(F.col("__kept"), kind), F.col(data)))
    text = F.array(F.concat(F.lit(f"{RULE_TEXT}rule "), F.col(key), F.lit(" failed")))
    return rows.withColumns({"stage": F.when(failed, F.lit(RULE_STAGE)), "errors": F.when(failed, text).otherwise(F.expr("cast(array() as array<string>)"))}).drop("__kept")


class Rule:
    """A rule's text with named variables; a later binding of a name replaces an earlier one."""

    def __init__(self, sql: str):
        self.sql, self.names, self.after = sql, {}, lambda c: c

    def bind(self, name: str, value: Column, kind: str | None = None) -> Rule:
        self.names[name] = value.cast(kind) if kind else value
        return self

    def coerce(self, fn) -> Rule:
        self.after = fn
        return self

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        taken = df.withColumn("__row", F.struct("*")).select("__row", *[v.alias(n) for n, v in self.names.items()])
        return taken.select("__row.*", self.after(F.expr(self.sql)).alias(out))


def validate_rules(checks: dict[str, Column]) -> Column:
    """Messages of the conditions that hold; an empty list is valid."""
    return F.filter(F.array(*[F.when(cond, F.lit(message)) for message, cond in checks.items()]), lambda x: x.isNotNull())


def facet_errors(spec: dict[str, dict]) -> Column:
    """Errors of columns by facet: required, pattern (whole value), enum, type, minimum and maximum."""
    found = []
    for name, facets in spec.items():
        c = F.col(name)
        if facets.get("required"):
            found.append(F.when(c.isNull(), F.lit(f"{name}: missing")))
        if "pattern" in facets:
            found.append(F.when(~c.cast("string").rlike(f"^(?:{facets['pattern']})$"), F.lit(f"{name}: pattern")))
        if "enum" in facets:
            found.append(F.when(~c.isin(facets["enum"]), F.lit(f"{name}: not allowed")))
        if "type" in facets:
            found.append(F.when(c.isNotNull() & c.try_cast(facets["type"]).isNull(), F.lit(f"{name}: not {facets['type']}")))
        if "minimum" in facets:
            found.append(F.when(c.try_cast("double") < facets["minimum"], F.lit(f"{name}: too small")))
        if "maximum" in facets:
            found.append(F.when(c.try_cast("double") > facets["maximum"], F.lit(f"{name}: too large")))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


#: Event, product category, code, contact type (1 email, 2 mobile).
MATRIX = [
    ("EVDAV", "Tracked24", "NRARS", 1),
    ("EVDAV", "SpecialDelivery09", "NRGRS", 1),
    ("EVDAV", "SpecialDelivery09", "NRGRS", 2),
    ("EVDAV", "SpecialDelivery13", "NRJRS", 2),
    ("EVGPD", "Tracked24", "NRBRS", 1),
    ("EVGPD", "Tracked24", "NRBRS", 2),
    ("EVGPD", "Tracked48", "NRERS", 1),
    ("EVGPD", "Tracked48", "NRERS", 2),
    ("EVGPD", "SpecialDelivery09", "NRHRS", 1),
    ("EVGPD", "SpecialDelivery09", "NRHRS", 2),
    ("EVGPD", "SpecialDelivery13", "NRKRS", 1),
    ("EVGPD", "SpecialDelivery13", "NRKRS", 2),
    ("ENKDN", "Tracked24", "NRCRS", 1),
    ("ENKDN", "Tracked48", "NRFRS", 2),
    ("ENKDN", "SpecialDelivery09", "NRIRS", 1),
    ("ENKDN", "SpecialDelivery13", "NRLRS", 1),
    ("ENKDN", "SpecialDelivery13", "NRLRS", 2),
]
CONTACTS = {"RECIPIENT_EMAILID": 1, "RECIPIENT_MOBILENO": 2}
MATRIX_SCHEMA = "event string, category string, code string, kind int"


def matrix(spark: SparkSession, rows: list[tuple] = MATRIX) -> DataFrame:
    return spark.createDataFrame(rows, MATRIX_SCHEMA)


def notifications(df: DataFrame, table: DataFrame, contacts: str = "contacts") -> DataFrame:
    """A row for each notification: the first contact of a kind, where the matrix has the row's event and category.

    contacts: array of (name, value). First contacts are found inside the row, so only the small table is joined.
    """
    kinds = "transform(array(" + ", ".join(f"named_struct('kind', {k}, 'name', '{n}')" for n, k in CONTACTS.items()) + f"), k -> named_struct('kind', k.kind, 'to', get(filter({contacts}, d -> d.name = k.name), 0).value))"
    rows = df.withColumn("__to", F.explode(F.expr(kinds))).where("__to.to is not null")
    return rows.select("*", F.col("__to.kind").alias("kind"), F.col("__to.to").alias("destination")).drop("__to").join(sized(table), ["event", "category", "kind"])


def tracking_record(names: dict[str, str], event: str = "event") -> Column:
    """The tracking struct of an event; optional fields are empty text, coordinates 0.0."""
    name = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.struct(F.lit("tracking").alias("type"), F.col(event).alias("eventCode"), F.try_element_at(name, F.col(event)).alias("eventName"), text("event_time").alias("eventDateTime"), text("item_id").alias("uniqueItemId"), F.coalesce(F.col("longitude"), F.lit(0.0)).alias("longitude"))


def billing_record(event: str = "event") -> Column:
    """The billing struct of a delivery; null for other events."""
    return F.when(F.col(event) == "ENKDN", F.struct(F.lit("billing").alias("type"), F.lit("DELIVERY_COMPLETE").alias("billingCode"), F.col("item_id").alias("uniqueItemId"), F.coalesce(F.col("price"), F.lit(0.0)).alias("pricePaid")))


#: Names of events in tracking records, and the enrichment that names the place.
EVENT_NAMES = {"EVDAV": "Accepted at Depot", "EVIMC": "In Transit at Mail Centre", "EVGPD": "Out for Delivery", "ENKDN": "Delivered"}
PLACES = {"EVDAV": "postcode_region", "EVIMC": "sorting_center", "EVGPD": "delivery_office", "ENKDN": "delivery_location"}

#: Fields of the three records in the order of the output. Those of ROUND come only with EVGPD and ENKDN.
TRACKING = ["type", "eventCode", "eventName", "eventDateTime", "uniqueItemId", "UPUTrackingNumber", "productId", "productName", "functionalLocationId", "siteId", "locationName", "postcode", "destinationCountry"]
ROUND = ["userId", "deviceId", "routeOrWalkNumber", "longitude", "latitude", "altitude"]
NOTIFICATION = ["type", "trackedEventCode", "originatingTrackedEventCode", "notificationDestination", "notificationDestinationType", "notificationRecipientType", "eventTimestamp", "uniqueItemId", "UPUTrackingNumber"]
BILLING = ["type", "billingCode", "eventCode", "uniqueItemId", "productId", "productCategory", "eventTimestamp", "pricePaid"]

#: One type for all three, so that they can stand in one list; fields that a record does not have are null.
_NUMBERS = {"longitude": "double", "latitude": "double", "altitude": "double", "pricePaid": "double", "notificationDestinationType": "int"}
FIELDS = list(dict.fromkeys([*TRACKING, *ROUND, *NOTIFICATION, *BILLING]))
RECORD = "struct<" + ", ".join(f"{f}: {_NUMBERS.get(f, 'string')}" for f in FIELDS) + ">"


def _record(values: dict[str, Column]) -> Column:
    return F.struct(*[values.get(f, F.lit(None)).cast(_NUMBERS.get(f, "string")).alias(f) for f in FIELDS])


def _or(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def tracking_out(names: dict[str, str] = EVENT_NAMES, places: dict[str, str] = PLACES) -> Column:
    """The whole tracking record of a scan; null for events without a name. Fields of ROUND only with the last two events.

    Scans have event, event_time, item_id, upu_number, product_id, category, location_id, site_id, the columns of places,
    postcode, country, user_code, device_id, route, longitude, latitude, altitude.
    """
    c = F.col
    name = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    place = F.lit("")
    for e, column in places.items():
        place = F.when(c("event") == e, _or(column, "")).otherwise(place)
    last = c("event").isin("EVGPD", "ENKDN")
    values = {"type": F.lit("tracking"), "eventCode": c("event"), "eventName": F.try_element_at(name, c("event")), "eventDateTime": c("event_time"), "uniqueItemId": c("item_id"), "UPUTrackingNumber": c("upu_number"), "productId": c("product_id"), "productName": c("category"), "functionalLocationId": _or("location_id", ""), "siteId": _or("site_id", ""), "locationName": place, "postcode": c("postcode"), "destinationCountry": c("country")}
    text = {"userId": "user_code", "deviceId": "device_id", "routeOrWalkNumber": "route"}
    values |= {f: F.when(last, _or(n, "")) for f, n in text.items()} | {f: F.when(last, _or(f, 0.0)) for f in ROUND[3:]}
    return F.when(c("event").isin(list(names)), _record(values))


def notification_out(rows: list[tuple] = MATRIX, contacts: str = "contacts") -> Column:
    """List of a scan's notification records, in the order of kinds of contact; the first contact of a kind is told.

    The matrix is part of the expression, a map from event, category and kind to the code: no join and no shuffle.
    """
    code = F.create_map(*[F.lit(x) for e, cat, known, kind in rows for x in (f"{e}|{cat}|{kind}", known)])
    found = []
    for name, kind in CONTACTS.items():
        to = F.expr(f"get(filter({contacts}, d -> d.name = '{name}'), 0).value")
        known = F.try_element_at(code, F.concat_ws("|", "event", "category", F.lit(str(kind))))
        values = {"type": F.lit("notification"), "trackedEventCode": known, "originatingTrackedEventCode": F.col("event"), "notificationDestination": to, "notificationDestinationType": F.lit(kind), "notificationRecipientType": F.lit("R"), "eventTimestamp": F.col("event_time"), "uniqueItemId": F.col("item_id"), "UPUTrackingNumber": F.col("upu_number")}
        found.append(F.when(known.isNotNull() & to.isNotNull(), _record(values)))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def billing_out() -> Column:
    """The whole billing record of a delivery; null for other events."""
    c = F.col
    values = {"type": F.lit("billing"), "billingCode": F.lit("DELIVERY_COMPLETE"), "eventCode": c("event"), "uniqueItemId": c("item_id"), "productId": c("product_id"), "productCategory": c("category"), "eventTimestamp": c("event_time"), "pricePaid": _or("price", 0.0)}
    return F.when(c("event") == "ENKDN", _record(values))


def listed(record: Column) -> Column:
    """A list of a record, or of nothing."""
    return F.when(record.isNotNull(), F.array(record)).otherwise(F.expr(f"cast(array() as array<{RECORD}>)"))


def combined_out() -> Column:
    """A scan's notification records and behind them its tracking record."""
    return combined(notification_out(), listed(tracking_out()))


def deployed_out() -> Column:
    """As the deployed text binds: a scan that is notified of has no tracking record."""
    return deployed(F.size(notification_out()) > 0, notification_out(), listed(tracking_out()))


def combined(first: Column, second: Column) -> Column:
    """Both lists, the first one's records in front."""
    return F.concat(first, second)


def deployed(condition: Column, first: Column, second: Column) -> Column:
    """As the deployed text binds: where the condition holds only the first list, else only the second."""
    return F.when(condition, first).otherwise(second)
