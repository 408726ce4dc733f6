from verbarium.sources.readers import unimorph_claims
from verbarium.streaming import ledger


def test_ledger_continues_where_it_stopped(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    kind = "lemma string, surface string, features string"
    spark.createDataFrame([("run", "ran", "V;PST")], kind).write.parquet(src)
    for _ in range(2):  # the second run finds nothing new
        ledger.append_claims(ledger.read_stream(spark, src, kind), lambda d: unimorph_claims(d).drop("x"), out, cp).awaitTermination()
        assert spark.read.parquet(out).count() == 1
    spark.createDataFrame([("go", "went", "V;PST")], kind).write.mode("append").parquet(src)
    ledger.append_claims(ledger.read_stream(spark, src, kind), lambda d: unimorph_claims(d), out, cp).awaitTermination()
    assert {r.subject for r in spark.read.parquet(out).collect()} == {"run", "go"}


def test_sync_and_windows(spark, tmp_path):
    src, state, cp = (str(tmp_path / x) for x in ("in", "state", "cp"))
    kind = "id string, body string, rev long"
    spark.createDataFrame([("a", "old", 1), ("b", "b1", 5)], kind).coalesce(1).write.parquet(src)
    ledger.sync_records(ledger.read_stream(spark, src, kind), "id", "rev", state, cp).awaitTermination()
    spark.createDataFrame([("a", "new", 2), ("b", "late", 4)], kind).coalesce(1).write.mode("append").parquet(src)
    ledger.sync_records(ledger.read_stream(spark, src, kind), "id", "rev", state, cp).awaitTermination()
    assert {r.id: r.body for r in spark.read.parquet(f"{state}/v1").collect()} == {"a": "new", "b": "b1"}
    ev = str(tmp_path / "ev")
    spark.sql("select timestamp'2024-01-01 00:10:00' ts, 'x' kind union all select timestamp'2024-01-01 00:50:00', 'x'").coalesce(1).write.parquet(ev)
    q = ledger.windowed_counts(ledger.read_stream(spark, ev, "ts timestamp, kind string"), "ts", "kind").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.n for r in spark.sql("select n from w").collect()] == [2]
