"""Incremental planning and streaming I1, I2, I4, I5, I7."""


from pyspark.sql import functions as F

from catalog_lake.operators.dedup import dense_ids, keep_one
from catalog_lake.queries.registry import register
from catalog_lake.session import scratch
from catalog_lake.streaming import incremental as inc
from catalog_lake.streaming.keep_first import keep_first
from catalog_lake.streaming.parked import Entity, ParkedUpsert

_SEEN = """(SELECT url FROM (SELECT url, arg_max(status_code, (timestamp, event_id)) AS s
                             FROM fetch_log GROUP BY url) x WHERE s = 200)"""


@register("i1_k6_frontier", f"""
SELECT DISTINCT regexp_replace(url, '\\s+', '', 'g') AS url FROM links
WHERE regexp_replace(url, '\\s+', '', 'g') NOT IN {_SEEN}""", ("links", "fetch_log"))
def i1(t):
    return inc.plan_frontier(t.links, t.fetch_log)


@register("i2_session_plan", f"""
SELECT DISTINCT url, CAST(regexp_extract(url, '(\\d+)', 1) AS BIGINT) % 4 = 0 AS is_nav FROM links
WHERE CAST(regexp_extract(url, '(\\d+)', 1) AS BIGINT) % 4 = 0 OR url NOT IN {_SEEN}""", ("links", "fetch_log"))
def i2(t):
    nav = F.regexp_extract("url", r"(\d+)", 1).cast("bigint") % 4 == 0
    return inc.plan_session(t.links, t.fetch_log, nav)


@register("i4_i5_a2_stream_ingest_dedup", "SELECT DISTINCT pk FROM rounds", ("rounds",))
def i4(t):
    """Round records land as JSON; an availableNow stream converts them to Parquet rounds
    (I4) and a second stream keeps the first record per key (I5)."""
    spark = t.spark
    base = scratch(spark, "stream")
    t.rounds.write.json(f"{base}/landing")
    schema = "pk BIGINT, round_label STRING, crawl_date STRING, row_pos BIGINT, event_type STRING, value DOUBLE"
    inc.ingest_stream(spark, f"{base}/landing", f"{base}/rounds", f"{base}/ckpt-ingest", schema, "events",
                      crawl_date="2024-01-31", max_files=4)
    stream = spark.readStream.schema(schema + ", entity_type STRING, crawl_date_p STRING") \
        .parquet(f"{base}/rounds")
    inc.run_to_table(inc.dedup_stream(stream.select("pk", "round_label", "row_pos"), "pk"),
                     f"{base}/dedup", f"{base}/ckpt-dedup")
    return spark.read.parquet(f"{base}/dedup").select("pk")


_CLEAN = "regexp_replace(url, '\\s+', '', 'g')"
_LINKS = f"""links0 AS (SELECT DISTINCT expected_kind, {_CLEAN} AS url FROM catalog_urls WHERE {_CLEAN} <> ''),
ok AS (SELECT url FROM links0 WHERE length(url) % 3 <> 0)"""
_IN_SCOPE = "regexp_matches(url, '/lang-id-6(/|$)') AND regexp_matches(url, '/country-filter-id-145(/|$)') AND " \
            "(regexp_matches(url, '/type-id-1(/|$)') OR url LIKE '%/passenger-car-type-details/%')"


def _links_and_log(t):
    """The catalogue's own urls as links, and a log in which a third failed at last, after a success."""
    links = t.catalog_urls.select("url", "expected_kind")
    clean = F.regexp_replace("url", r"\s+", "")
    log = links.select(clean.alias("url")).filter("url <> ''").distinct()
    # One row or two per url, made in place: a union would find the urls twice.
    fetch = [F.struct(F.lit(f"2024-01-0{k}").alias("timestamp"), F.lit(k).alias("event_id"), F.lit(status).alias("status_code")) for k, status in ((1, 200), (2, 500))]
    fetched = F.explode(F.when(F.length("url") % 3 == 0, F.array(*fetch)).otherwise(F.array(fetch[0])))
    return links, log.select("url", fetched.alias("f")).select("url", "f.timestamp", "f.event_id", "f.status_code")


@register("i1_frontier_in_scope", f"WITH {_LINKS} SELECT DISTINCT url FROM links0 WHERE {_IN_SCOPE} AND url NOT IN (SELECT url FROM ok)",
          ("catalog_urls",))
def i1_scope(t):
    """Page links of all kinds, in and out of scope, some with blanks inside."""
    links, log = _links_and_log(t)
    return inc.plan_frontier(links, log, {"lang_id": 6, "country_id": 145, "type_id": 1})


@register("i2_session_by_url_kind", f"""
WITH {_LINKS} SELECT DISTINCT url, expected_kind IN ('manufacturer', 'model_series', 'category_page', 'other') AS is_nav FROM links0
WHERE expected_kind IN ('manufacturer', 'model_series', 'category_page', 'other') OR url NOT IN (SELECT url FROM ok)""", ("catalog_urls",))
def i2_kinds(t):
    """Navigation pages by the kind of their url, leaf pages by the log."""
    links, log = _links_and_log(t)
    return inc.plan_session(links, log, inc.is_navigation("url"))


@register("i4_survivors_and_bad_lines", """
SELECT pk, row_pos, value, CAST(NULL AS VARCHAR) AS line FROM (
  SELECT *, row_number() OVER (PARTITION BY pk ORDER BY (CAST(substr(round_label, 2) AS INT) - 1) // 10, row_pos) AS rn FROM rounds) x WHERE rn = 1
UNION ALL SELECT NULL, NULL, NULL, concat('{"pk": ', row_pos, ', cut off') FROM rounds WHERE row_pos % 100 = 0""", ("rounds",))
def i4_survivors(t):
    """Rounds land ten at a time, each landing drained before the next; the first record per key survives, with its
    values, and lines that do not parse are kept as they came."""
    spark = t.spark
    base = scratch(spark, "stream")
    schema = "pk BIGINT, row_pos BIGINT, value DOUBLE"
    drop = F.floor((F.substring("round_label", 2, 9).cast("int") - 1) / 10)
    rounds = keep_one(t.rounds.withColumn("drop", drop), ["pk", "drop"], ["row_pos"])
    broken = t.rounds.withColumn("drop", drop).filter("row_pos % 100 = 0").select("drop", F.concat(F.lit('{"pk": '), "row_pos", F.lit(", cut off")).alias("value"))
    for k in range(10):
        part = rounds.filter(F.col("drop") == k).select(F.to_json(F.struct("pk", "row_pos", "value")).alias("value"))
        if k and part.isEmpty():
            break
        part.unionByName(broken.filter(F.col("drop") == k).select("value")).write.mode("append").text(f"{base}/landing")
        inc.ingest_stream(spark, f"{base}/landing", f"{base}/rounds", f"{base}/ckpt-ingest", schema, "events", crawl_date="2024-01-31")
        stream = inc.good(spark.readStream.schema(f"{schema}, {inc.CORRUPT} STRING").parquet(f"{base}/rounds"))
        inc.run_to_table(inc.dedup_stream(stream, "pk"), f"{base}/dedup", f"{base}/ckpt-dedup")
    kept = spark.read.parquet(f"{base}/dedup").select("pk", "row_pos", "value", F.lit(None).cast("string").alias("line"))
    return kept.unionByName(inc.bad_lines(spark.read.parquet(f"{base}/rounds")), allowMissingColumns=True)


@register("i7_observed_counters", """
SELECT count(*) AS records, count(*) FILTER (WHERE pk IS NULL) AS missing_key FROM rounds""", ("rounds",))
def i7(t):
    df, obs = inc.observe_counters(t.rounds, "round_counters", "pk")
    df.write.format("noop").mode("overwrite").save()
    m = obs.get
    return t.spark.createDataFrame([(int(m["records"]), int(m["missing_key"]))], "records long, missing_key long")


@register("i5_dedup_within_watermark", "SELECT DISTINCT user_id FROM events")
def i5w(t):
    """Event-time variant of I5: one record per user.  The files deal the events in no order, so they
    are out of order by the table's whole span; the delay is just longer, so no record is late, no
    user is forgotten and the answer is the same however many micro-batches the files make (here
    one file each)."""
    spark = t.spark
    base = scratch(spark, "stream")
    events = t.table("events").select("user_id", "ts", "event_type")
    seconds = F.col("ts").cast("timestamp").cast("long")
    span = events.agg(F.max(seconds) - F.min(seconds)).first()[0] or 0
    events.repartition(3).write.json(f"{base}/landing")
    stream = spark.readStream.schema("user_id BIGINT, ts TIMESTAMP, event_type STRING") \
        .option("maxFilesPerTrigger", 1).json(f"{base}/landing")
    inc.run_to_table(inc.dedup_stream(stream, "user_id", event_time="ts", delay=f"{span + 2} seconds"),
                     f"{base}/dedup", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/dedup").select("user_id")


@register("i5_keep_first_evicting", """
WITH RECURSIVE kept AS (
  SELECT user_id, min(ts) AS ts FROM events GROUP BY user_id
  UNION ALL
  SELECT k.user_id, min(e.ts) AS ts FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts > k.ts + INTERVAL 36 HOUR
  GROUP BY k.user_id)
SELECT k.user_id, k.ts, min(e.event_id) AS event_id FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts = k.ts
GROUP BY k.user_id, k.ts""")
def i5_evicting(t):
    """The first event per user that no kept one of the user precedes by 36 hours.  The events land a
    sixth of their days at a time and every landing is drained by its own run of the stream, restarted
    from its checkpoint: the delay is far below the table's span, so users are evicted and come again."""
    spark = t.spark
    base = scratch(spark, "stream")
    events = t.table("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    first, last = events.agg(F.min(F.col("ts").cast("long")), F.max(F.col("ts").cast("long"))).first()
    if first is None:
        return events
    step = (last - first) // 6 + 1
    for k in range(6):
        at = F.col("ts").cast("long")
        events.filter((at >= first + k * step) & (at < first + (k + 1) * step)).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
        inc.run_to_table(keep_first(stream, "user_id", "ts", 36 * 3600), f"{base}/kept", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/kept")


_LINE = "struct<l_linenumber:int,l_partkey:bigint,l_quantity:double>"


@register("i6_parked_upsert_replayed", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, 'loaded' AS state
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(NULL AS BIGINT), 'parked'
FROM lineitem WHERE l_orderkey % 10 = 0""")
def i6(t):
    """Orders and their lines, landed children first in three drops: the lines of every order (one order in
    three first with too few lines), half of the orders with all lines of those, then the other orders but
    for every tenth, whose lines stay parked.  After the second drop its batch is replayed, and the log is
    folded into a base."""
    spark = t.spark
    base = scratch(spark, "parked")
    one = F.struct(F.col("l_linenumber").cast("int").alias("l_linenumber"), F.col("l_partkey").cast("bigint").alias("l_partkey"),
                   F.col("l_quantity").cast("double").alias("l_quantity"))
    lines = t.table("lineitem").groupBy(F.col("l_orderkey").cast("bigint").alias("l_orderkey")).agg(F.collect_list(one).alias("lines"))
    orders = t.table("orders").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"))
    few = F.when(F.col("l_orderkey") % 3 == 0, F.slice("lines", 1, 1)).otherwise(F.col("lines"))
    record, parent = F.lit("record").alias("kind"), F.lit("parent").alias("kind")
    drops = [[lines.select(record, "l_orderkey", few.alias("lines"))],
             [orders.filter("o_orderkey % 2 = 1").select(parent, "*"), lines.filter("l_orderkey % 3 = 0").select(record, "*")],
             [orders.filter("o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0").select(parent, "*")]]
    store = ParkedUpsert(spark, f"{base}/store", Entity("o_orderkey", "o_orderkey bigint, o_custkey bigint"),
                         Entity("l_orderkey", f"l_orderkey bigint, lines array<{_LINE}>"), "l_orderkey")
    schema = f"kind string, o_orderkey bigint, o_custkey bigint, l_orderkey bigint, lines array<{_LINE}>"
    for k, frames in enumerate(drops):
        for frame in frames:
            missing = [c for c in ("o_orderkey", "o_custkey") if c not in frame.columns]
            frame.select("*", *[F.lit(None).cast("bigint").alias(c) for c in missing]).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(schema).parquet(f"{base}/landing")
        store.run(stream, f"{base}/ckpt")
        if k == 1:
            store.handle(spark.read.schema(schema).parquet(f"{base}/landing"), max(store.committed()))
            store.compact()
    child = [F.col(f"line.{c}").alias(c) for c in ("l_linenumber", "l_partkey", "l_quantity")]
    loaded = store.children("lines", "line").join(store.parents(), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("l_orderkey", *child, "o_custkey", F.lit("loaded").alias("state"))
    waiting = store.parked().select("l_orderkey", F.explode("lines").alias("line")) \
        .select("l_orderkey", *child, F.lit(None).cast("bigint").alias("o_custkey"), F.lit("parked").alias("state"))
    return loaded.unionByName(waiting)


@register("w4_dense_ids", "SELECT c_name, row_number() OVER (ORDER BY c_name) AS new_id FROM (SELECT DISTINCT c_name FROM customer) x")
def w4(t):
    return dense_ids(t.table("customer"), "c_name")
