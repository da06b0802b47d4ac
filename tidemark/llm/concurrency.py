"""Peak concurrency: how many intervals are open, and what they sum to, at each moment where that changes.

Time is cut into buckets of one width.  Each interval is clipped to every bucket that it overlaps: the copy that holds its start begins
there, those of later buckets begin at the bucket's border, and the copy that holds its end closes there.  So each bucket knows by itself
what is open when it begins, and is swept alone, without a count handed on from the bucket before.  Changes at borders that no real start
or end makes are dropped, and a summary of one row per key and bucket (first moment, largest count) stitches successors and maxima.

What is shuffled is one row per (key, bucket, moment), summed before the shuffle, so a key that holds most intervals costs each task no
more than its moments, and a group that is sorted holds the moments of one bucket.  Copies grow with an interval's length over the width.

Cases: null starts, and ends that are not after their start, take no part; a null end is never; a null value counts as 0; a null key is a
key; equal intervals count each; an empty table gives no row; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .graphs import cut

#: Seconds of a bucket: intervals of some weeks have a few copies, and a bucket holds at most 10,080 minutes.
WIDTH = 7 * 86_400
#: A key with this share of all rows or more is joined by broadcast; there are 1 / SHARE such keys at most.
SHARE = 1 / 256
ALL, NO_NATION = -2, -1


def concurrency(intervals: DataFrame, key: str, until: int | None = None, width: int = WIDTH) -> DataFrame:
    """(key, start, end, value), times as long: a row per key and moment where starts and ends together change the count or the sum.

    ``until`` is the last moment of all intervals; it is read from the table where the caller does not know it (one more job)."""
    rows = intervals.where("start IS NOT NULL AND (end IS NULL OR end > start)").select(key, "start", "end", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    if until is None:
        until = rows.agg(F.max(F.greatest("start", "end"))).first()[0] or 0
    place = lambda t: F.floor(t / F.lit(width)).cast("long") if isinstance(t, Column) else t // width
    first, last = F.col("_first"), F.col("_last")
    rows = rows.withColumns({"_first": place(F.col("start")), "_last": F.coalesce(place(F.col("end")), F.lit(place(until)).cast("long"))})
    zero = F.lit(0).cast("long")
    copy = lambda bucket, at, n, value, held, held_value: F.struct(bucket.alias("bucket"), at.alias("at"), n.alias("n"), value.alias("value"), held.alias("held"), held_value.alias("held_value"))
    one, value = F.lit(1).cast("long"), F.col("value")
    starts = F.array(copy(first, F.col("start"), one, value, zero, zero))
    ends = F.when(F.col("end").isNotNull(), F.array(copy(last, F.col("end"), -one, -value, zero, zero))).otherwise(F.array().cast("array<struct<bucket:bigint,at:bigint,n:bigint,value:bigint,held:bigint,held_value:bigint>>"))
    later = F.when(last > first, F.sequence(first + 1, last)).otherwise(F.array().cast("array<bigint>"))
    borders = F.transform(later, lambda b: copy(b, b * width, zero, zero, one, value))
    copies = rows.select(key, F.inline(F.concat(starts, ends, borders)))
    # Written once: the sweep and the seams both read it, and what led to it is not run again for either, nor after a loss.
    moments = cut(copies.groupBy(key, "bucket", "at").agg(*[F.sum(c).alias(c) for c in ("n", "value", "held", "held_value")]))

    sweep = Window.partitionBy(key, "bucket").orderBy("at")
    upto = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = moments.withColumns({"n_open": F.sum(F.col("n") + F.col("held")).over(upto), "open_value": F.sum(F.col("value") + F.col("held_value")).over(upto)})
    swept = swept.where("n <> 0 OR value <> 0").select(key, "bucket", F.col("at").alias("start"), F.lead("at").over(sweep).alias("end"), "n_open", "open_value", F.max("n_open").over(upto).alias("high_open"))

    along = Window.partitionBy(key).orderBy("bucket")
    seams = swept.groupBy(key, "bucket").agg(F.min("start").alias("_begins"), F.max("n_open").alias("_high"))
    seams = seams.select(
        F.col(key).alias("_key"),
        F.col("bucket").alias("_bucket"),
        F.lead("_begins").over(along).alias("_next"),
        F.max("_high").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.max("_high").over(Window.partitionBy(key)).alias("_most"),
    )
    whole = swept.join(seams, F.col(key).eqNullSafe(F.col("_key")) & (F.col("bucket") == F.col("_bucket")))
    return whole.select(
        key,
        "start",
        F.coalesce("end", "_next").alias("end"),
        "n_open",
        "open_value",
        F.greatest("high_open", "_before").alias("high_open"),
        (F.col("n_open") == F.col("_most")).alias("is_peak"),
    )


def utc_minute(df: DataFrame, name: str) -> Column:
    """A time column as seconds since 1970, rounded down to minutes; times without a zone are taken as UTC whatever the session's zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60
    return F.floor(F.unix_seconds(c) / 60).cast("long") * 60


def nation_of_sales(sales: DataFrame, clients: DataFrame) -> DataFrame:
    """sales with their client's nation_id (-1 without one); of a client's repeated rows the smallest nation counts.

    Clients with many sales are few, by their share of all rows, and are looked up in a broadcast table of these alone; the rest joins by
    client.  Sales that are looked up, or have no client, are spread over the tasks of that join."""
    nations = clients.where("client_id IS NOT NULL").groupBy("client_id").agg(F.min("nation_id").alias("nation_id"))
    least = max(2, int(sales.count() * SHARE))
    hot = sales.where("client_id IS NOT NULL").groupBy("client_id").count().where(F.col("count") >= least).select("client_id")
    hot = hot.join(nations, "client_id", "left").select(F.col("client_id").alias("_hot"), F.col("nation_id").alias("_hot_nation"))
    marked = sales.join(F.broadcast(hot), F.col("client_id") == F.col("_hot"), "left")
    apart = F.col("_hot").isNotNull() | F.col("client_id").isNull()
    key = F.when(apart, F.concat(F.lit("#"), F.pmod(F.xxhash64("sale_id"), F.lit(1 << 20)))).otherwise(F.col("client_id").cast("string"))
    joined = marked.withColumn("_client", key).join(nations.select(F.col("client_id").cast("string").alias("_client"), "nation_id"), "_client", "left")
    return joined.withColumn("nation_id", F.coalesce("_hot_nation", "nation_id", F.lit(NO_NATION)).cast("int")).drop("_client", "_hot", "_hot_nation")


def op11_peak_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = lambda name, *columns: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    sales, lines = table("sales", "sale_id", "client_id", "total", "sold_at"), table("sale_lines", "sale_id", "shipped_at")
    sales = sales.select("sale_id", "client_id", "total", utc_minute(sales, "sold_at").alias("start")).where("start IS NOT NULL")
    shipped = lines.select("sale_id", (utc_minute(lines, "shipped_at") + 7 * 86_400).alias("end"))
    until = max(x or 0 for df, c in ((sales, "start"), (shipped, "end")) for x in df.agg(F.max(c)).first())
    ends = shipped.where("sale_id IS NOT NULL").groupBy("sale_id").agg(F.max("end").alias("end"))
    cents = F.when(F.isnan("total") | (F.abs("total") == float("inf")), 0).otherwise(F.floor(100 * F.col("total") + 0.5))
    each = nation_of_sales(sales, table("clients", "client_id", "nation_id")).join(ends, "sale_id", "left")
    each = each.select(F.explode(F.array("nation_id", F.lit(ALL))).alias("nation_id"), "start", "end", cents.alias("value"))
    found = concurrency(each, "nation_id", until)
    return found.select("nation_id", F.col("start").alias("from_s"), F.col("end").alias("to_s"), "n_open", F.col("open_value").alias("open_cents"), "high_open", "is_peak")


OP11_SQL = r"""
WITH s AS (
  SELECT sale_id, client_id, floor(epoch(sold_at) / 60)::BIGINT * 60 AS a, coalesce(floor(100 * total + 0.5), 0)::BIGINT AS cents
  FROM sales WHERE sold_at IS NOT NULL),
x AS (SELECT sale_id, max(floor(epoch(shipped_at) / 60)::BIGINT * 60 + 604800) AS b FROM sale_lines WHERE sale_id IS NOT NULL GROUP BY 1),
c AS (SELECT client_id, min(nation_id) AS nation FROM clients GROUP BY 1),
i AS (
  SELECT coalesce(nation, -1) AS nation, a, b, cents FROM s LEFT JOIN x USING (sale_id) LEFT JOIN c USING (client_id)
  WHERE b IS NULL OR b > a),
n AS (SELECT * FROM i UNION ALL SELECT -2, a, b, cents FROM i),
e AS (SELECT nation, a AS t, 1 AS k, cents AS v FROM n UNION ALL SELECT nation, b, -1, -cents FROM n WHERE b IS NOT NULL),
m AS (SELECT nation, t, sum(k) AS k, sum(v) AS v FROM e GROUP BY 1, 2 HAVING sum(k) <> 0 OR sum(v) <> 0),
r AS (SELECT nation, t, sum(k) OVER w AS n_open, sum(v) OVER w AS cents FROM m WINDOW w AS (PARTITION BY nation ORDER BY t))
SELECT nation::INTEGER AS nation_id, t AS from_s, lead(t) OVER w AS to_s, n_open::BIGINT AS n_open, cents::BIGINT AS open_cents,
       (max(n_open) OVER w)::BIGINT AS high_open, n_open = max(n_open) OVER (PARTITION BY nation) AS is_peak
FROM r WINDOW w AS (PARTITION BY nation ORDER BY t)
"""
