"""Incremental crawl state and Structured Streaming ingest.

The reference resumes crawls through a seen-url store and appends JSONL
files; here that becomes (a) batch planning joins over a fetch log and (b)
streaming jobs over a landing directory with checkpoints in the shared
checkpoint folder.  Streams use ``trigger(availableNow=True)`` so a run
processes what has landed and stops — restartable after executor or driver
loss from the checkpoint, exactly-once into file sinks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_lake.functions.filters import in_scope
from catalog_lake.functions.text import guess_ext, image_path, normalize_url, url_kind
from catalog_lake.operators.dedup import keep_one
from catalog_lake.operators.upsert import latest_per_key


# -- I1 / I2: planning against the fetch log -----------------------------------
def seen_ok(log: DataFrame, url: str = "url", ts: str = "timestamp", tie: str | None = "event_id") -> DataFrame:
    """Urls whose latest fetch status is 200 (``INSERT OR REPLACE`` then ``status = 200``)."""
    last = latest_per_key(log.select(url, ts, *( [tie] if tie else []), "status_code"), url, ts, tie)
    return last.filter(F.col("status_code") == 200).select(url)


def plan_frontier(links: DataFrame, log: DataFrame, scope: dict | None = None, url: str = "url") -> DataFrame:
    """Discovered links, normalised and de-duplicated, in scope, minus urls already fetched OK.

    Failed fetches (latest status != 200) stay eligible.
    """
    l = links.select(normalize_url(url).alias(url)).filter(F.col(url) != "")
    if scope:
        l = l.filter(in_scope(url, scope["lang_id"], scope["country_id"], scope["type_id"]))
    return l.distinct().join(seen_ok(log), url, "left_anti")


#: Pages that only lead to others; they change as the catalogue grows, so every session visits them.
NAVIGATION_KINDS = ("manufacturer", "model_series", "category_page")


def is_navigation(url: Column | str = "url") -> Column:
    """Whether a url is of a navigation page, by its kind; an unknown url is a list of manufacturers."""
    kind = url_kind(url)
    return kind.isNull() | kind.isin(*NAVIGATION_KINDS)


def plan_session(links: DataFrame, log: DataFrame, is_nav: Column, url: str = "url") -> DataFrame:
    """Navigation pages are planned once per session regardless of the log;
    leaf pages only when not yet fetched OK."""
    l = links.select(normalize_url(url).alias(url), is_nav.alias("is_nav")).filter(F.col(url) != "").distinct()
    # One join for both, so links and log are each read once; a url is seen once at most, and a null flag plans nothing.
    seen = seen_ok(log).select(F.col(url), F.lit(True).alias("_seen"))
    return l.filter(F.col("is_nav").isNotNull()).join(seen, url, "left").filter(F.col("is_nav") | F.col("_seen").isNull()).select(url, "is_nav")


# -- I3: link discovery from stored pages ---------------------------------------
LINKS_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                             T.StructField("position", T.LongType()),
                             T.StructField("href", T.StringType()), T.StructField("text", T.StringType())])


def _links_of(html: str) -> list[tuple[str, str]]:
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out: list[list[str]] = []
            self.open: list[list[str]] = []

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                href = dict(attrs).get("href")
                item = [href or "", ""]
                self.out.append(item)
                self.open.append(item)

        def handle_endtag(self, tag):
            if tag == "a" and self.open:
                self.open.pop()

        def handle_data(self, data):
            for item in self.open:
                item[1] += data

    p = P()
    p.feed(html or "")
    p.close()
    return [(h, t.strip()) for h, t in p.out]


def _extract_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
            for i, (h, txt) in enumerate(_links_of(html), start=1):
                rows.append((pid, url, i, h, txt))
        yield pd.DataFrame(rows, columns=["page_id", "url", "position", "href", "text"])


def discover_links(pages: DataFrame, base_url: str | None = None) -> DataFrame:
    """Every ``<a href>`` of every page, absolutised against the page (or ``base_url``)
    and classified by url kind.  (page_id, url, html) cross into Python once; the page url
    rides along, so the page table is not scanned or joined a second time."""
    j = pages.select("page_id", "url", "html").mapInPandas(_extract_links, LINKS_SCHEMA)
    origin = F.regexp_extract("url", r"^(https?://[^/?#]+)", 1) if base_url is None else F.lit(base_url.rstrip("/"))
    h = F.col("href")
    absolute = (F.when(h.startswith("http://") | h.startswith("https://"), h)
                .otherwise(F.concat(origin, F.lit("/"), F.regexp_replace(h, r"^/+", ""))))
    return j.select("page_id", "url", "position", "href", "text", absolute.alias("link"),
                    url_kind(absolute).alias("kind"))


# -- I4 / I5 / I6 / I7: streaming ------------------------------------------------
CORRUPT = "_corrupt_record"


def good(rounds: DataFrame) -> DataFrame:
    """The records of ingested rounds, without the lines that did not parse."""
    return rounds.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(rounds: DataFrame) -> DataFrame:
    """The lines of ingested rounds that did not parse."""
    return rounds.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def ingest_stream(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType | str,
                  entity: str, crawl_date: str | None = None, max_files: int | None = None):
    """I4: landing JSONL -> partitioned Parquet rounds, exactly once, then stop.

    Returns the finished ``StreamingQuery`` (``availableNow`` processes what
    has landed, in as many micro-batches as ``max_files`` allows).  A line that does not
    parse is a row too, with its text in ``_corrupt_record`` (see ``good`` and ``bad_lines``).
    """
    known = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = T.StructType([*known.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.json(src)
    day = F.lit(crawl_date) if crawl_date else F.date_format(F.current_date(), "yyyy-MM-dd")
    out = df.withColumn("entity_type", F.lit(entity)).withColumn("crawl_date", day)
    q = (out.writeStream.format("parquet").option("path", dst).option("checkpointLocation", checkpoint)
         .partitionBy("entity_type", "crawl_date").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def dedup_stream(df: DataFrame, pk: str | Sequence[str], event_time: str | None = None,
                 delay: str = "1 day") -> DataFrame:
    """Keep the first record per key of a stream.

    Without event time the state (seen keys) grows with the key space —
    acceptable for ``availableNow`` batches over bounded key sets; with an
    event-time column the state is bounded by the watermark.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    if event_time:
        return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def run_to_table(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    """Run a streaming frame to completion (``availableNow``) into a file sink."""
    q = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def upsert_batch(handler: Callable[[DataFrame, int], None], df: DataFrame, checkpoint: str):
    """Run ``handler(batch_df, epoch)`` for every micro-batch (``foreachBatch``).

    Handlers must be idempotent per epoch (a replayed epoch after a failure
    re-runs the same batch): the keyed upsert of ``operators.upsert`` is.
    """
    q = (df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def observe_counters(df: DataFrame, name: str = "counters", entity_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach progress counters (rows, rows with a null key column) to a frame.

    For batch frames the returned ``Observation`` is filled when an action
    runs; streaming queries report the same metrics in ``lastProgress``.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("records")]
    if entity_col:
        metrics.append(F.count_if(F.col(entity_col).isNull()).alias("missing_key"))
    return df.observe(obs, *metrics), obs


# -- I8: image plan -------------------------------------------------------------
def image_plan(details: DataFrame) -> DataFrame:
    """I8: images to fetch: exploded lists indexed from 1 (before blanks are dropped),
    first per (article, url), with their file path."""
    e = details.select("article_id", F.posexplode("image_urls").alias("_p", "url")) \
        .withColumn("image_index", (F.col("_p") + 1).cast("bigint")).drop("_p")
    e = e.filter(F.col("url").isNotNull() & (F.col("url") != ""))
    e = keep_one(e, ["article_id", "url"], ["image_index"])
    return e.withColumn("ext", guess_ext("url")).withColumn("path", image_path("article_id", "image_index", "url"))


def split_plan(plan: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I8: (already fetched, still to fetch) against the manifest of earlier runs."""
    done = manifest.filter(F.col("status").isin("downloaded", "cached")).select("article_id", "url").distinct()
    return (plan.join(done, ["article_id", "url"], "left_semi"),
            plan.join(done, ["article_id", "url"], "left_anti"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Downloaded / cached / other-is-error totals of a manifest."""
    s = F.col("status")
    return manifest.agg(F.count_if(s == "downloaded").cast("bigint").alias("downloaded"),
                        F.count_if(s == "cached").cast("bigint").alias("cached"),
                        F.count_if(~s.isin("downloaded", "cached") | s.isNull()).cast("bigint").alias("errors"))


class ProgressCounters:
    """I7 for streams: collect each micro-batch's input rows and observed metrics.

    Register with ``spark.streams.addListener(pc.listener)``; ``pc.batches``
    holds one dict per finished micro-batch (batch id, input rows, metrics of
    every ``observe`` on the stream).
    """

    def __init__(self):
        from pyspark.sql.streaming import StreamingQueryListener
        outer = self
        self.batches: list[dict] = []

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                metrics = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
                outer.batches.append({"batch": p.batchId, "input_rows": p.numInputRows, "metrics": metrics})

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.listener = _L()

    def total(self, name: str, field: str) -> int:
        return sum(int(b["metrics"].get(name, {}).get(field, 0) or 0) for b in self.batches)
