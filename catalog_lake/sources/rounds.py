"""Entity stores, crawl rounds and snapshots.

Layout on shared storage::

    <root>/entity_type=<entity>/crawl_date=<date>/part-*.parquet   one round
    <root>/snapshots/<entity>/v=<n>/part-*.parquet                  one row per key
    <root>/snapshots/<entity>/_CURRENT                              pointer to the live version

Rounds are append-only; a snapshot is rebuilt into a new version directory
and the pointer is swapped, so readers never see a half-written table and a
failed job leaves the previous version live.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_lake.functions.text import json_number_to_int, partition_label, round_number
from catalog_lake.sources.schemas import ENTITIES, PRIMARY_KEYS, SCHEMAS

MAX_RECORDS_PER_FILE = 1000


# -- A1, A2, A15: entity JSONL ------------------------------------------------------
def read_entity(spark: SparkSession, path: str, entity: str | None = None, infer: bool = False,
                corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Read an entity JSONL store.

    Explicit schema by default (A2); ``infer=True`` samples the data (A1).
    Blank lines are skipped by the JSON source (A15); a line that does not
    parse lands in ``_corrupt_record`` (PERMISSIVE) instead of failing the job.
    Records may be large (tens of MiB): the JSON source streams them line by
    line, and ``spark.sql.files.maxPartitionBytes`` bounds a task's input.
    """
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    if infer or entity is None:
        return r.json(path)
    target = SCHEMAS[entity]
    ints = (T.IntegerType, T.LongType)
    # Ids arrive as numbers in some rounds and as quoted text in others: read
    # integer columns as text, then type them leniently in Catalyst.
    text_fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, ints) else f.dataType, True)
                   for f in target.fields]
    raw = r.schema(T.StructType(text_fields + [T.StructField(corrupt_col, T.StringType(), True)])).json(path)
    cols = [json_number_to_int(F.col(f.name)).try_cast(f.dataType).alias(f.name) if isinstance(f.dataType, ints)
            else F.col(f.name) for f in target.fields]
    return raw.select(*cols, corrupt_col)


def append_entity(df: DataFrame, root: str, entity: str) -> None:
    """Append records to an entity store (JSON lines, one directory per entity)."""
    df.write.mode("append").json(f"{root.rstrip('/')}/{entity}")


def sample_raw(df: DataFrame, n: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """A quick look at raw records (the limit is the feature)."""
    return (df.select(*cols) if cols else df).limit(n)


# -- A5, A6, A7: rounds --------------------------------------------------------------
def write_round(df: DataFrame, root: str, entity: str, crawl_date: str | None = None,
                max_records: int | None = None, mode: str = "overwrite") -> str:
    """Write one crawl round as ZSTD Parquet under ``entity_type=/crawl_date=``.

    ``max_records`` caps rows per output file (the reference's 1000-record
    chunks) without any manual chunking.  Re-running a round replaces that
    round's partition and no other (dynamic partition overwrite).
    """
    day = crawl_date or dt.date.today().isoformat()
    w = (df.withColumn("entity_type", F.lit(entity)).withColumn("crawl_date", F.lit(day))
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd"))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.partitionBy("entity_type", "crawl_date").parquet(root)
    return f"{root.rstrip('/')}/entity_type={entity}/crawl_date={day}"


def convert_all(spark: SparkSession, src: str, dst: str, crawl_date: str | None = None,
                entities: Sequence[str] = ENTITIES, max_records: int | None = None) -> DataFrame:
    """Convert each entity's JSONL store into a round; a missing input is skipped and
    a failing entity does not stop the others.  Lines that are no JSON are counted and
    kept under ``_bad/``.  Returns (entity, status, rows, bad_lines), rows of this round.

    One independent Spark job per entity (seven jobs, not a loop over data).
    """
    out = []
    for e in entities:
        path = f"{src.rstrip('/')}/{e}"
        if not _exists(spark, path):
            out.append((e, "missing", 0, 0))
            continue
        try:
            df = read_entity(spark, path, e)
            good = df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
            written = write_round(good, dst, e, crawl_date, max_records)
            # Spark does not read the corrupt column alone from JSON files: parse the bare lines for it.
            check = T.StructType([T.StructField("_corrupt_record", T.StringType())])
            lines = spark.read.text(path).filter(F.trim("value") != "")
            options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
            bad = lines.filter(F.from_json("value", check, options)["_corrupt_record"].isNotNull())
            bad_path = f"{dst.rstrip('/')}/_bad/{written.rsplit('/', 2)[1]}/{written.rsplit('/', 1)[1]}"
            bad.write.mode("overwrite").text(bad_path)
            n = spark.read.parquet(written).count() if _exists(spark, written) else 0
            out.append((e, "converted", n, spark.read.text(bad_path).count()))
        except Exception as exc:  # noqa: BLE001 - one entity's failure is reported, not raised
            out.append((e, f"failed: {type(exc).__name__}", 0, 0))
    return spark.createDataFrame(out, "entity string, status string, rows long, bad_lines long")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# -- A3, A4, U2: reading rounds ---------------------------------------------------------
def read_rounds(spark: SparkSession, root: str, entity: str, ignore_corrupt: bool = True,
                schema: T.StructType | str | None = None) -> DataFrame:
    """Every round of an entity, with provenance for the keep-one order.

    Files are found recursively (no partition columns are injected; the
    round date comes from the path).  Zero-byte and garbage files are
    skipped when ``ignore_corrupt``.  Added columns: ``_file`` (path),
    ``_row`` (row index in the file), ``crawl_date`` (text, D29) and
    ``round_no`` (the date or rN label as a sortable number).
    Without an explicit ``schema`` the footers of all files are merged, so a
    corrupt file that happens to be listed first cannot hide the schema.
    """
    r = spark.read.option("recursiveFileLookup", "true")
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    r = r.schema(schema) if schema is not None else r.option("mergeSchema", "true")
    df = r.parquet(f"{root.rstrip('/')}/entity_type={entity}")
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    label = partition_label(F.regexp_extract("_file", r"crawl_date=([^/]+)", 1))
    num = F.coalesce(F.regexp_replace(label, "-", "").try_cast("bigint"), round_number(label))
    return df.withColumn("crawl_date", label).withColumn("round_no", num)


def listed_files(spark: SparkSession, root: str, entity: str) -> list[tuple[str, int]]:
    """(path, bytes) of an entity's Parquet files as they lie on storage, zero-byte ones too."""
    fs, p, _ = _fs(spark, f"{root.rstrip('/')}/entity_type={entity}")
    files = []
    it = fs.listFiles(p, True)
    while it.hasNext():
        st = it.next()
        if st.getPath().getName().endswith(".parquet"):
            files.append((st.getPath().toUri().toString(), int(st.getLen())))
    return files


def counted(rounds: DataFrame, pk: str) -> tuple[DataFrame, Observation]:
    """A4 inside the caller's own scan: rounds that count, as they are read, the files they come from and
    the records without a key.  A file that gave any row gave one with row index 0."""
    seen = Observation()
    return rounds.observe(seen, F.count_if(F.col("_row") == 0).alias("files"), F.count_if(F.col(pk).isNull()).alias("keyless")), seen


def skipped_files(spark: SparkSession, root: str, entity: str, rounds: DataFrame) -> DataFrame:
    """A4: files present on storage that contributed no row (zero-byte, corrupt or empty).

    The file listing is metadata the driver already fetches to plan any scan
    (the data sources themselves hide zero-byte files, so they cannot list
    them); the comparison against the files rows came from is a join.
    """
    files = listed_files(spark, root, entity)
    # 'file:///x' and 'file:/x' name the same file (empty authority).
    norm = lambda c: F.regexp_replace(c, r"^([a-zA-Z][a-zA-Z0-9+.-]*):///", "$1:/")
    listing = spark.createDataFrame(files, "_file string, length long").withColumn("_key", norm(F.col("_file")))
    seen = rounds.select(norm(F.col("_file")).alias("_key")).distinct()
    return listing.join(seen, "_key", "left_anti").drop("_key")


def dedup_rounds(rounds: DataFrame, pk: str, policy: str = "newest") -> DataFrame:
    """W2 on real files: newest round, then newest file path, then first row in the file."""
    from catalog_lake.operators.dedup import keep_one
    if policy not in ("newest", "oldest"):
        raise ValueError("policy is 'newest' or 'oldest'")
    newest = policy == "newest"
    order = [F.col("round_no").desc_nulls_last() if newest else F.col("round_no").asc_nulls_last(),
             F.col("_file").desc() if newest else F.col("_file").asc(), F.col("_row").asc()]
    return keep_one(rounds, pk, order)


# -- A8, A13, A14: snapshots and publishing ------------------------------------------
def write_snapshot(df: DataFrame, root: str, entity: str, pk: str | Sequence[str] | None = None,
                   num_files: int | None = None) -> str:
    """One row per key, written range-partitioned and sorted by key into a new version.

    Range partitioning by the key makes each file cover a key interval, so
    point lookups and key joins skip files by Parquet min/max statistics.
    Returns the version path; ``publish`` makes it current.
    """
    key = pk or PRIMARY_KEYS[entity]
    keys = [key] if isinstance(key, str) else list(key)
    base = f"{root.rstrip('/')}/snapshots/{entity}"
    version = _next_version(df.sparkSession, base)
    path = f"{base}/v={version}"
    out = df.repartitionByRange(num_files, *keys) if num_files else df.repartitionByRange(*keys)
    out.sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _next_version(spark: SparkSession, base: str) -> int:
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return 1
    vs = [int(s.getPath().getName()[2:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")]
    return max(vs, default=0) + 1


def publish(spark: SparkSession, version_path: str) -> None:
    """Make a written version current by replacing the small pointer file.

    The new pointer is written in full beside the old one and renamed over it in one
    step, so a crash leaves the old pointer or the new one, never none.
    """
    base = version_path.rsplit("/", 1)[0]
    fs, _, jvm = _fs(spark, base)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{base}/_CURRENT.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(version_path.encode("utf-8")))
    out.close()
    cur = jvm.org.apache.hadoop.fs.Path(f"{base}/_CURRENT")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(context.makeQualified(tmp), context.makeQualified(cur), options)


def current(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """The live snapshot of an entity, or None when none was published."""
    base = f"{root.rstrip('/')}/snapshots/{entity}"
    fs, _, jvm = _fs(spark, base)
    cur = jvm.org.apache.hadoop.fs.Path(f"{base}/_CURRENT")
    if not fs.exists(cur):
        return None
    stream = fs.open(cur)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    path = reader.readLine()
    reader.close()
    return spark.read.parquet(path)


def publish_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, mode: str = "append",
                 properties: dict | None = None) -> None:
    """A13 (relational target): batched JDBC insert, one connection per partition."""
    df.write.mode(mode).option("batchsize", batch).jdbc(url, table, properties=properties or {})


LOAD_ORDER = ["manufacturers", "models", "car_types", "car_type_details", "category_groups", "articles",
              "article_details"]


def load_all(spark: SparkSession, root: str, load) -> DataFrame:
    """Load snapshots in dependency order (dimensions, articles, details);
    a missing snapshot is skipped.  ``load(entity, df) -> rows`` does the write."""
    out = []
    for e in LOAD_ORDER:
        df = current(spark, root, e)
        if df is None:
            out.append((e, "missing", 0))
            continue
        out.append((e, "loaded", int(load(e, df))))
    return spark.createDataFrame(out, "entity string, status string, rows long")

