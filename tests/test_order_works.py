import datetime
import json

from pubspark.sources import warehouse as W

LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"


def test_authors_are_made_after_the_shuffle_of_lines(spark, scratch_dir):
    when = datetime.datetime(1995, 3, 4)
    spark.createDataFrame([(1, 5, "O", 10.5, when, "1-URGENT"), (2, 6, "F", 20.0, when, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(f"{scratch_dir}/orders.parquet")
    spark.createDataFrame([(1, 2, 7, 3, 9.0, 0.1, 0.1, "N", "O"), (1, 1, 6, 4, 9.0, 0.1, 0.1, "N", "O"),
                           (1, 3, 6, 4, 9.0, 0.1, 0.1, "R", "F"), (1, 3, 6, 4, None, None, None, None, None)], LINES
                          ).write.parquet(f"{scratch_dir}/lineitem.parquet")
    found = {r.run: json.loads(r.raw_item) for r in W.order_works(spark, scratch_dir, "o_orderkey").collect()}
    assert [(a.get("family"), a.get("name"), a["sequence"]) for a in found["1"]["author"]] == [
        ("Family4", None, "first"), ("Family3", None, "additional"), ("Family4", None, "additional"),
        (None, "Consortium 4", "additional")]
    assert found["1"]["reference-count"] == 4 and "author" not in found["2"] and "reference-count" not in found["2"]
    line = W.lines_per_order(spark, scratch_dir).schema["lines"].dataType.elementType
    assert line.names == LINES.replace("l_orderkey long, ", "").replace(",", "").split()[::2]


def test_authors_are_made_in_generated_code(spark, scratch_dir):
    spark.range(0).selectExpr("id o_orderkey", "id o_custkey", "'' o_orderstatus", "0D o_totalprice", "now() o_orderdate",
                              "'' o_orderpriority").write.parquet(f"{scratch_dir}/orders.parquet")
    spark.createDataFrame([], LINES).write.parquet(f"{scratch_dir}/lineitem.parquet")
    plan = W.order_works(spark, scratch_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan  # a lambda, which is interpreted
    numbers = spark.createDataFrame([(n,) for n in (None, -12345, -5, 0, 7, 999, 9999, 10000, 123456)], "n long")
    for padded, plain in numbers.selectExpr(W._four_digits("n"), "format_string('%04d', n)").collect():
        assert padded == plain
