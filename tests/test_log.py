"""Several writers, merging of commits, files that a read opens, counts kept at commit, streams that start again."""

import random
import threading
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import observe, routing
from tidemark.operators.log import Log
from tidemark.operators.relational import BAR_COLUMNS, BAR_KEY, KeyedTable
from tidemark.operators.store import Store
from tidemark.streaming.ingest import commit_stream

T0 = datetime(2024, 1, 1, tzinfo=UTC)
LMP, DEMAND = "power.lmp", "power.demand"


def lmp(spark, rows, prefix="ERCOT.SPP."):
    df = spark.createDataFrame([(prefix + s, t, float(v)) for s, t, v in rows], "instrument_id string, valid_time timestamp, price double")
    return routing.routed(df.withColumn("settlement_point", F.lit("P")))


def put(store, rows, day, prefix="ERCOT.SPP.", **kw):
    at = T0 + timedelta(days=day)
    return store.commit(lmp(store.spark, rows, prefix), as_of=at, fetched_at=at, source="t", **kw)


def prices(df):
    return sorted((r["symbol"], r["valid_time"], r["price"]) for r in df.collect())


def test_only_one_writer_gets_a_number(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"), "x long")
    done = []
    threads = [threading.Thread(target=lambda i=i: done.append(log.append(spark.createDataFrame([(i,)], "x long"), 1))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(done) == [False, False, False, True] and log.listed()[0] == 1 and log.read().count() == 1
    for n in range(2, 5):
        assert log.append(spark.createDataFrame([(n,)], "x long"), n)
    log.checkpoint()
    assert len(log.listed()[1]) == 1 and log.read().count() == 4 and len(log.listed(2)[1]) == 2
    assert log.append(spark.createDataFrame([(9,)], "x long"), 5) and len(log.listed()[1]) == 2 and log.read().count() == 5


def test_a_writer_that_comes_second_decides_anew(spark, tmp_path):
    """Two writers on one state of the log: the second one's commit builds on the first one's."""
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    put(store, [("A", T0, 1)], 1)
    write, raced = store._write, []

    def late(*args):
        done = write(*args)
        if not raced:
            raced.append(put(other, [("A", T0 + timedelta(hours=1), 2), ("B", T0, 5)], 2))
        return done

    store._write = late
    put(store, [("A", T0 + timedelta(hours=2), 3)], 3)
    assert raced[0] and prices(store.read(LMP)) == [("a", T0.replace(tzinfo=None) + timedelta(hours=h), float(h + 1)) for h in range(3)] + [("b", T0.replace(tzinfo=None), 5.0)]
    assert store.orphans(LMP).count() == 0 and [r["commit_seq"] for r in store.vintages(LMP).orderBy("commit_seq").collect()] == [1, 2, 2, 3]


def test_two_threads_lose_nothing(spark, tmp_path):
    stores, failed = [Store(spark, str(tmp_path)) for _ in range(2)], []

    def work(k):
        try:
            for i in range(3):
                put(stores[k], [("S", T0 + timedelta(hours=10 * k + i), k)], 1 + k, "EIA930.D.")
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and stores[0].read(DEMAND).count() == 6 and stores[0].log(DEMAND).listed()[0] == 6


def test_merged_commits(spark, tmp_path):
    store = Store(spark, str(tmp_path), fold=4)
    model = {}
    for k in range(11):
        rows = [(s, T0 + timedelta(hours=h), 100 * k + h) for s in ("A", "B") for h in range(k, k + 3)]
        put(store, rows, k, "EIA930.D.")
        for s, t, v in rows:
            model.setdefault((s.lower(), t.replace(tzinfo=None)), (k, float(v)))
    want = lambda day: sorted((s, t, v) for (s, t), (k, v) in model.items() if k <= day)
    assert prices(store.read(DEMAND)) == want(99)
    live = lambda: store._live(store._logged(DEMAND)).select("commit_id").distinct().count()
    assert live() == 2  # merged three times on the way
    before = store.read(DEMAND)
    old = store.read(DEMAND, T0 + timedelta(days=5))
    assert store.compact(DEMAND) and live() == 1 and store.compact(DEMAND) is None
    assert prices(before) == want(99) and prices(old) == want(5)  # readers that began before still see their files
    assert len(store.vacuum(DEMAND)) >= 11 and store.unreadable(DEMAND).count() == 0
    assert prices(store.read(DEMAND)) == want(99) and prices(store.read(DEMAND, T0 + timedelta(days=5))) == want(5)
    assert store.vintages(DEMAND).select("as_of").distinct().count() == 11  # what was committed is still known
    assert {r.row_count for r in observe.catalog(store.vintages()).collect()} == {13}
    put(store, [("A", T0, 7), ("A", T0 + timedelta(days=9), 8)], 20, "EIA930.D.")
    assert store.read(DEMAND).where("symbol = 'a'").count() == 14


def test_a_commit_during_a_merge(spark, tmp_path):
    store, other = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    for k in range(3):
        put(store, [("A", T0 + timedelta(hours=k), k)], k, "EIA930.D.")
    write = store._write
    store._write = lambda *args: (write(*args), put(other, [("A", T0 + timedelta(hours=9), 9)], 9, "EIA930.D."))[0]
    assert store.compact(DEMAND)
    assert [r[2] for r in prices(other.read(DEMAND))] == [0.0, 1.0, 2.0, 9.0]


def test_a_read_opens_only_files_of_its_symbols_and_times(spark, tmp_path):
    store = Store(spark, str(tmp_path), file_rows=100)
    hours = [T0 + timedelta(hours=h) for h in range(200)]
    for k in range(2):
        put(store, [(s, t, k + i) for s in "ABCDEFGH" for i, t in enumerate(hours)], 30 + k)
    every = store.read(LMP)
    assert len(every.inputFiles()) >= 24 and every.count() == 1600
    one = store.read(LMP, None, ["c"], hours[50], hours[60])
    assert len(one.inputFiles()) <= 4 and sorted(r[2] for r in prices(one)) == [float(1 + i) for i in range(50, 61)]
    assert len(store.read(LMP, None, ["c"]).inputFiles()) <= 10
    curve = store.curve(LMP, spark.createDataFrame([("c",), ("nothing",)], "symbol string"))
    assert curve.count() == 200 and len(curve.inputFiles()) <= 10
    sizes = [r["n"] for r in spark.read.parquet(*every.inputFiles()).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 400


@pytest.mark.parametrize("prefix", ["ERCOT.SPP.", "EIA930.D.", "NOAA.HDD."])
def test_catalog_counts_without_reading_rows(spark, tmp_path, prefix):
    rng = random.Random(7)
    store = Store(spark, str(tmp_path), fold=3)
    names = ["TEXAS", "SOUTH"] if prefix.startswith("NOAA") else ["A", "B"]
    for day in rng.sample(range(20), 6):  # late ones too
        put(store, [(s, T0 + timedelta(hours=rng.randrange(12)), rng.randrange(9)) for s in names for _ in range(4)], day, prefix)
    (library,) = {r["library"] for r in store.vintages().select("library").distinct().collect()}
    exact = {tuple(r) for r in observe.catalog_of(store.read(library)).select("symbol", "row_count", "latest_valid_time").collect()}
    listed = observe.catalog(store.vintages())
    assert {tuple(r) for r in listed.select("symbol", "row_count", "latest_valid_time").collect()} == exact
    assert not any("observations" in f for f in listed.inputFiles())


def test_streams_that_start_again(spark, tmp_path):
    """Another checkpoint and larger batches; and rows that do not say when they were fetched."""
    src, store = str(tmp_path / "in"), Store(spark, str(tmp_path / "store"))
    schema = "instrument_id string, valid_time timestamp, settlement_point string, price double, fetched_at timestamp"
    for i in range(3):
        spark.createDataFrame([("ERCOT.SPP.A", T0 + timedelta(hours=i), "P", float(i), T0 + timedelta(days=9))], schema).coalesce(1).write.mode("append").parquet(src)
    one = commit_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), store, "s").option("checkpointLocation", str(tmp_path / "c1")).start()
    while (one.lastProgress or {}).get("batchId", -1) < 0 and one.isActive:
        one.awaitTermination(1)
    one.stop()
    commit_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(src), store, "s").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination()
    assert [p for _, _, p in prices(store.read(LMP))] == [0.0, 1.0, 2.0]
    n = store.vintages().count()
    commit_stream(spark.readStream.schema(schema).parquet(src), store, "s").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start().awaitTermination()
    assert store.vintages().count() == n
    spark.createDataFrame([("ERCOT.SPP.A", T0, "P", 1.0, None)], schema).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="without fetched_at"):
        commit_stream(spark.readStream.schema(schema).parquet(src), store, "s").option("checkpointLocation", str(tmp_path / "c4")).trigger(availableNow=True).start().awaitTermination()


def bars(spark, rows):
    return spark.createDataFrame([(t, s, v, v, v, v, 1) for s, t, v in rows], "Datetime timestamp, Symbol string, Open double, High double, Low double, Close double, Volume long")


def test_upserts_rewrite_only_what_they_touch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), BAR_KEY, BAR_COLUMNS, width=4)
    days = [T0 + timedelta(days=d) for d in range(700)]
    everything = [(s, t, float(i)) for s in ("A", "B", "C", "D", "E") for i, t in enumerate(days)]
    n = table.upsert(bars(spark, everything))
    assert n > 40 and table.read().count() == 3500
    last = [(s, days[-1 - d], 9000.0 + d) for s in ("A", "B", "C", "D", "E") for d in range(5)] + [("Z", days[-1], 1.0), ("Z", days[-1], 2.0)]
    assert table.upsert(bars(spark, last)) <= 8 < n / 5  # at most two months, of each at most four hashes
    model = {(s, t): v for s, t, v in everything} | {(s, t): v for s, t, v in last}
    assert {(r.Symbol, r.Datetime.replace(tzinfo=UTC)): r.Close for r in table.read().collect()} == model
    again = KeyedTable(spark, str(tmp_path / "t"), BAR_KEY, BAR_COLUMNS, width=4)
    append, raced = table.log.append, []

    def late(entry, number):
        if not raced:
            raced.append(again.upsert(bars(spark, [("A", days[-1], 5.0), ("B", days[-1], 6.0)])))
        return append(entry, number)

    table.log.append = late
    table.upsert(bars(spark, [("B", days[-1], 7.0)]))
    got = {r.Symbol: r.Close for r in again.read().where(F.col("Datetime") == F.lit(days[-1])).collect()}
    assert raced and got["A"] == 5.0 and got["B"] == 7.0 and again.read().count() == 3501
    assert table.vacuum() and table.read().count() == 3501
