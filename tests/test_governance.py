from pyspark.sql import functions as F

from stratum.operators import governance as gv
from stratum.operators.gold import build_monthly_sales_aggregate, build_sales_fact
from stratum.sources import fixtures as fx
from stratum.sources.tables import read_table
from tests.conftest import MEDIUM


def test_scan_counts_equal_direct_counts(spark):
    docs = read_table(spark, MEDIUM, "documents")
    scan = {(r.column_name, r.pattern): r for r in gv.sensitive_scan(docs, ["text"]).collect()}
    for name, pat in gv.SENSITIVE_PATTERNS.items():
        assert scan[("text", name)].n_flagged == docs.where(F.col("text").rlike(pat)).count()
    assert scan[("text", "email")].n_flagged == 11


def test_scan_finds_values_inside_text(spark):
    df = spark.createDataFrame([("mail me at a.b@x.org please",), ("token = \"abc\"",), (None,)], "t string")
    got = {(r.pattern, r.n_flagged, r.n_values) for r in gv.sensitive_scan(df).collect()}
    assert ("email", 1, 2) in got and ("secret_assignment", 1, 2) in got


def test_lineage_regroups_to_aggregate(spark):
    fact = build_sales_fact(fx.transactions_cleansed(spark, MEDIUM, with_source_file=True),
                            fx.customers_dirty(spark, MEDIUM), fx.products_conformed(spark, MEDIUM),
                            carry=["_source_file"])
    lineage = gv.row_lineage(fact).groupBy("year_month", "store_id", "product_id").count()
    agg = build_monthly_sales_aggregate(fact).select("year_month", "store_id", "product_id",
                                                     F.col("transaction_count").alias("count"))
    assert lineage.exceptAll(agg).count() == 0 and agg.exceptAll(lineage).count() == 0
    files = {r[0] for r in gv.row_lineage(fact).select("source_file").distinct().collect()}
    assert len(files) == 1 and next(iter(files)).endswith("lineitem.parquet")


def test_findings_check_digits_and_octets(spark):
    rows = [(1, "4111 1111-1111 1111 and 4111111111111112"), (2, "10.0.0.1 300.1.1.1"), (3, "nothing"), (None, None), (4, "a@b.de a@b.de token = \"x\"")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {(r.id, r.pattern): (r.n_matches, r.n_valid) for r in gv.sensitive_findings(df, "id").collect()}
    assert got == {(1, "card_number"): (2, 1), (2, "ipv4"): (2, 1), (4, "email"): (2, 2), (4, "secret_assignment"): (1, 1)}
    assert gv.sensitive_findings(df.limit(0), "id").count() == 0


def test_values_inside_nested_columns(spark):
    schema = "id long, s struct<a:string,b:struct<c:array<string>>>, m map<string,array<string>>, j string, x array<struct<y:string>>, d double"
    rows = [(1, ("a1", (["c1", None, "c2"],)), {"k": ["m1"], "l": None}, '{"p": "q", "o": {"r": [1, {"t": "deep"}], "n": null}, "e": []}', [("y1",), None], 1.5),
            (2, None, None, "plain text", None, None), (3, (None, None), {}, "[1, 2", [], 0.5), (None, ("a2", ([],)), None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.path, r.value) for r in gv.nested_values(df, json_columns=["j"], json_depth=5).collect())
    assert got == sorted([("id", "1"), ("id", "2"), ("id", "3"), ("s.a", "a1"), ("s.b.c[]", "c1"), ("s.b.c[]", "c2"), ("m.k[]", "m1"), ("j.p", "q"),
                          ("j.o.r[]", "1"), ("j.o.r[].t", "deep"), ("j", "plain text"), ("j", "[1, 2"), ("x[].y", "y1"), ("s.a", "a2")])
    shallow = {r.path for r in gv.nested_values(df, ["j"], ["j"], 1).collect()}
    assert shallow == {"j.p", "j.o", "j.e", "j"}
    scan = gv.sensitive_scan_nested(spark.createDataFrame([({"card": "4111111111111111", "mail": "a@b.de"},), (None,)], "m map<string,string>"))
    assert {(r.path, r.pattern): (r.n_values, r.n_flagged, r.n_valid) for r in scan.collect() if r.n_flagged} == {
        ("m.card", "card_number"): (1, 1, 1), ("m.mail", "email"): (1, 1, 1)}
