"""The change stream ends at the same table as a batch update plus insert."""


from pyspark.sql import functions as F

from firmalign.functions import vocabulary as v
from firmalign.operators import mutations as mu
from firmalign.sources.fixtures import run_ts
from firmalign.streaming.changes import FIRM_COLS, StreamedFirms


def table(df):
    """Rows without the ids of inserted firms, which depend on the order of arrival."""
    new = F.col("sync_status").eqNullSafe(F.lit(v.NEW_FROM_OA))
    return sorted(map(tuple, df.select(*FIRM_COLS).withColumn(
        "firm_id", F.when(~new, F.col("firm_id"))).collect()), key=repr)


def test_stream_equals_batch(spark, data, tmp_path):
    feed = data.oa.withColumn("seq", F.lit(2).cast("bigint"))
    # A third of the rows first arrive wrong: another name and no ids, then are corrected.
    wrong = feed.where("firm_id % 3 = 0").withColumns({
        "name": F.concat(F.lit("Draft "), F.col("firm_id").cast("string")), "seq": F.lit(1).cast("bigint"),
        **{c: F.lit(None).cast("string") for c in v.ID_COLS}})
    src = str(tmp_path / "src")
    for i, part in enumerate((wrong.unionByName(feed.where("firm_id % 3 = 1")),
                              feed.where("firm_id % 3 = 0"), feed.where("firm_id % 3 = 2"))):
        part.coalesce(1).write.mode("append").parquet(f"{src}/{i}")
    stream = StreamedFirms(spark, data.firm, str(tmp_path / "state"))
    for i in range(3):
        changes = spark.readStream.schema(feed.schema).parquet(f"{src}/{i}")
        if i == 0:   # through a real stream, rerun as a scheduler would
            for _ in range(2):
                stream.start(changes, run_ts()).awaitTermination()
        else:
            batch = spark.read.parquet(f"{src}/{i}")
            stream.apply(batch, i, run_ts())
    once = table(stream.current())
    batch_firms = mu.update_matched(data.firm, data.oa, run_ts())
    assert once == table(mu.insert_new(batch_firms, data.oa, run_ts(), known=data.firm,
                                     numbered_after=data.firm))
    ids = [r[0] for r in stream.current().select("firm_id").collect()]
    assert len(ids) == len(set(ids))

    stream.apply(spark.read.parquet(f"{src}/2"), 2, run_ts())   # replay of the last batch
    assert table(stream.current()) == once
    assert sorted(r[0] for r in stream.current().select("firm_id").collect()) == sorted(ids)

    # One changed row: of each table only the buckets of the row, of its keys and of firms with them.
    read = []
    whole = stream._read

    def noted(name, before, buckets=None):
        read.append((name, None if buckets is None else len(buckets)))
        return whole(name, before, buckets)
    stream._read = noted
    one = spark.read.parquet(f"{src}/2").orderBy("firm_id").limit(1).withColumns(
        {"name": F.lit("Renamed"), "seq": F.lit(9).cast("bigint")})
    stream.apply(one, 3, run_ts())
    stream._read = whole
    most = {"master": 1, "insert": 1, "master_key": 6, "firm_key": 6, "firm": 4, "base": 4}
    first = {name: n for name, n in reversed(read)}
    assert first["master"] == first["insert"] == 1
    assert all(n is not None and n <= most[name] for name, n in first.items())
    master = data.oa.join(one.select("firm_id", F.col("name").alias("_n")), "firm_id", "left").withColumn(
        "name", F.coalesce("_n", "name")).drop("_n")
    assert table(stream.current()) == table(mu.insert_new(
        mu.update_matched(data.firm, master, run_ts()), master, run_ts(), known=data.firm,
        numbered_after=data.firm))


def test_a_batch_keeps_its_time_when_it_is_tried_again(spark, data, tmp_path):
    stream = StreamedFirms(spark, data.firm, str(tmp_path / "state"), buckets=4)
    batch = data.oa.where("firm_id < 20").withColumn("seq", F.lit(1))
    times = []
    for _ in range(2):
        stream.apply(batch, 0)
        times.append({r[0] for r in stream.current().where("sync_status IS NOT NULL").select(
            "last_synced_at").distinct().collect()})
    assert len(times[0]) == 1 and times[0] == times[1]
