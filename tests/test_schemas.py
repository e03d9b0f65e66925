"""XML against a schema: what is wrong and where; lookups that cannot be read; counts of sinks."""

import pytest
from pyspark.sql import functions as F

from keyflow.functions import schemas
from keyflow.sources import lookups
from keyflow.streaming import counts, streams

XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:p" xmlns:p="urn:p" elementFormDefault="qualified">
  <xs:simpleType name="code"><xs:restriction base="xs:string"><xs:enumeration value="A"/><xs:enumeration value="B"/></xs:restriction></xs:simpleType>
  <xs:simpleType name="short"><xs:restriction base="xs:string"><xs:pattern value="\\d{3}"/></xs:restriction></xs:simpleType>
  <xs:simpleType name="long"><xs:restriction base="xs:string"><xs:pattern value="11\\d{4}"/></xs:restriction></xs:simpleType>
  <xs:simpleType name="either"><xs:union memberTypes="p:short p:long"/></xs:simpleType>
  <xs:simpleType name="few"><xs:restriction base="xs:integer"><xs:minInclusive value="1"/><xs:maxInclusive value="20"/></xs:restriction></xs:simpleType>
  <xs:complexType name="pair"><xs:sequence><xs:element name="name" type="p:code"/><xs:element name="value" type="xs:string" minOccurs="0"/></xs:sequence></xs:complexType>
  <xs:element name="item"><xs:complexType><xs:sequence>
    <xs:element name="id" type="p:either"/>
    <xs:element name="at" type="xs:dateTime" minOccurs="0"/>
    <xs:choice><xs:element name="count" type="p:few"/><xs:element name="price" type="xs:decimal"/></xs:choice>
    <xs:element name="pair" type="p:pair" minOccurs="0" maxOccurs="unbounded"/>
    <xs:element name="size" minOccurs="0"><xs:complexType><xs:simpleContent><xs:extension base="xs:decimal"><xs:attribute name="unit" type="p:code" use="required"/></xs:extension></xs:simpleContent></xs:complexType></xs:element>
  </xs:sequence><xs:attribute name="n" type="xs:int"/></xs:complexType></xs:element>
</xs:schema>"""


def item(body, head=' xmlns="urn:p"'):
    return f"<item{head}>\n{body}</item>"


OK = [item("<id>123</id><count> 7 </count>"), item("<id>112345</id>\n <at>2024-01-02T03:04:05Z</at><price>1.50</price><pair><name>A</name></pair><pair><name>B</name><value/></pair>"), item('<id>123</id><count>1</count><size unit="A">3</size>', ' xmlns="urn:p" n="4"'), '<q:item xmlns:q="urn:p"><q:id>123</q:id><q:count>20</q:count></q:item>', None]
BAD = [
    (item("<id>12</id><count>7</count>"), 2, 2, "element id: '12' is of none of the types short, long"),
    (item("<id>123</id><count>21</count>"), 2, 2, "element count: '21' does not fit maxInclusive 20"),
    (item("<id>123</id><count>x</count>"), 2, 2, "element count: 'x' is no integer"),
    (item("<id>123</id>\n<count>1</count><price>1</price>"), 2, 3, "element price is not expected here in element item"),
    (item("<id>123</id>"), 2, 2, "element item is not complete"),
    (item("<count>1</count>"), 2, 2, "element count is not expected here in element item"),
    (item("<id>123</id><count>1</count><other/>"), 2, 2, "element other is not expected here in element item"),
    (item("<id>123</id><count>1</count><pair><name>C</name></pair>"), 2, 2, "element name: 'C' is not one of A, B"),
    (item("<id>123</id><at>2024-13-02T03:04:05Z</at><count>1</count>"), 2, 2, "element at: '2024-13-02T03:04:05Z' is no dateTime"),
    (item("<id>123</id>text<count>1</count>"), 2, 2, "text is not allowed in element item"),
    (item("<id><b/></id><count>1</count>"), 2, 2, "element b is not allowed in element id, which has no elements"),
    (item("<id>123</id><count>1</count><size>3</size>"), 2, 2, "attribute unit is missing in element size"),
    (item("<id>123</id><count>1</count>", ' xmlns="urn:p" n="x"'), 2, 1, "attribute n: 'x' is no int"),
    (item("<id>123</id><count>1</count>", ' xmlns="urn:p" m="x"'), 2, 1, "attribute m is not allowed in element item"),
    (item("<id>123</id><count>1</count>", ""), 2, 1, "element item is not declared"),
    ("<item xmlns='urn:p'>\n <id>", 3, 2, "no element found"),
    ("<!DOCTYPE a []><a/>", 3, 1, "document type"),
    ("", 3, 1, "no element found"),
]


def test_violations_have_places(spark):
    df = spark.createDataFrame([(i, x, ["before"]) for i, x in enumerate([*OK, *(b[0] for b in BAD)])], "i int, raw_value string, errors array<string>").repartition(3)
    got = {r["i"]: r["errors"] for r in schemas.validate_xml(df, XSD).collect()}
    assert all(got[i] == ["before"] for i in range(len(OK)))
    for i, (text, severity, line, what) in enumerate(BAD, len(OK)):
        assert len(got[i]) == 2 and got[i][1].startswith(f"[{severity}] line {line}, col ") and got[i][1].endswith(f": {what}"), (text, got[i])
    place = schemas.violation(schemas.Schema(XSD), item("<id>123</id>\\n  <count>1</count>\\n  <odd/>".replace("\\\\n", "\\n")))
    assert place.startswith("[2] line 2, col ")


def test_schemas_that_cannot_be_read(spark, tmp_path):
    for text, what in [("<a", "no XML"), ("<a/>", "no schema"), (XSD.replace("p:few", "p:none"), "unknown type none"), (XSD.replace("<xs:sequence>", "<xs:all>").replace("</xs:sequence>", "</xs:all>"), "all in a complex type")]:
        with pytest.raises(schemas.SchemaError, match=what):
            schemas.Schema(text)
    (tmp_path / "a.xsd").write_text(XSD)
    assert schemas.read_schema(spark, str(tmp_path / "a.xsd")) == XSD


def test_lookups_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("a,b\n1,x\n2,y\n1,z\n")
    rows = lookups.load_lookup(spark, str(tmp_path / "ok.csv"), ["a"], ["b"], auth=lookups.bearer("account", "token"))
    assert {(r["key"], r["b"]) for r in rows.collect()} == {("1", "z"), ("2", "y")}
    assert spark.conf.get("fs.azure.account.oauth2.client.secret.account.dfs.core.windows.net", None) is None
    for path in (str(tmp_path / "none.csv"), "abfss://c@account.dfs.core.windows.net/x.csv", "nosuch://x/y.csv"):
        with pytest.raises(lookups.LookupUnreadable, match="cannot read the lookup"):
            lookups.load_lookup(spark, path, ["a"], ["b"], auth=lookups.sas("account", "secret-of-mine"))
    try:
        lookups.load_lookup(spark, "nosuch://x/y.csv", ["a"], ["b"], auth=lookups.sas("account", "secret-of-mine"))
    except lookups.LookupUnreadable as e:
        assert "secret-of-mine" not in str(e)


def test_counts_over_failures_and_restarts(spark, tmp_path):
    rows = [(i, ["value", "error", "retry"][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, kind string")
    for n in range(4):
        df.where((F.col("i") >= n * 15) & (F.col("i") < n * 15 + 15)).coalesce(1).write.parquet(str(tmp_path / "all" / f"p={n}"))
    (tmp_path / "in").mkdir()
    src = lambda: spark.readStream.schema("i int, kind string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "p=*"))
    totals = counts.Totals(spark, str(tmp_path / "totals"))
    assert totals.read() == {}
    failing = {"left": 1}

    def sink(kind):
        inner = streams.parquet_sink(str(tmp_path / kind))

        def put(part, number):
            inner(part, number)
            if number == 2 and kind == "error" and failing["left"]:
                failing["left"] -= 1
                raise RuntimeError("told to fail after writing")

        return put

    def run(upto):
        for n in range(upto):
            if not (tmp_path / "in" / f"p={n}").exists():
                (tmp_path / "all" / f"p={n}").rename(tmp_path / "in" / f"p={n}")
        q = counts.write_counted(src(), {k: sink(k) for k in ("value", "error", "retry")}, str(tmp_path / "cp"), totals, {"availableNow": True})
        q.awaitTermination()

    run(2)
    assert sum(totals.read().values()) == 30
    with pytest.raises(Exception, match="told to fail"):
        run(4)
    assert sum(totals.read().values()) == 30
    run(4)
    assert totals.read() == {"value": 20, "error": 20, "retry": 20}
    assert {k: spark.read.parquet(str(tmp_path / k)).count() for k in totals.read()} == totals.read()
    assert len(list((tmp_path / "totals").glob("*.json"))) == 2
    copied = counts.Totals(spark, str(tmp_path / "copied"))
    counts.copy_counted(src(), str(tmp_path / "copy"), str(tmp_path / "cp2"), copied).awaitTermination()
    assert copied.read() == {"copied": 60} and spark.read.parquet(str(tmp_path / "copy")).count() == 60
