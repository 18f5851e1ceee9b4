"""What the queries hand to a backfill."""

from pyspark.sql import functions as F

from checks import queries


def write_tables(spark, base):
    """Two customers with an order and a click each."""
    ids = spark.range(2)
    day = F.timestamp_seconds(F.lit(760_000_000))
    tables = {
        "orders": ids.select(
            F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit(100.0).alias("o_totalprice"), day.alias("o_orderdate"),
        ),
        "customer": ids.select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment")),
        "events": ids.select(F.col("id").alias("user_id"), day.alias("ts"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}.parquet")
    return str(base)


def test_raw_files_of_two_runs(spark, tmp_path, monkeypatch):
    """Both runs read all four sources; what does not differ between them is written once."""
    runs = []
    monkeypatch.setattr(queries, "backfill", lambda spark, raw, base, start, end: runs.append((raw, base, start, end)))
    monkeypatch.setattr(queries, "read_features", lambda spark, base, wide: spark.range(1).withColumn("Credit_Behavior_Score", F.lit(1.0)))
    queries.backfill_two_runs(spark, write_tables(spark, tmp_path))
    (one, base, first, until), (two, same_base, change, last) = runs
    assert base == same_base and first < until < change and str(change) == queries.SECOND_RUN and last
    names = {"loans", "clickstream", "attributes", "financials"}
    assert set(one) == set(two) == names and {name for name in names if one[name] != two[name]} == {"clickstream"}
    clicks = [{c for c in spark.read.csv(raw["clickstream"], header=True).columns if c.startswith("fe_")} for raw in (one, two)]
    assert clicks == [{"fe_1", "fe_2", "fe_3", "fe_4"}, {"fe_2", "fe_3", "fe_4", "fe_5"}]
    assert all(spark.read.csv(path, header=True).count() >= 2 for path in one.values())
