"""Creative assets: specs, object keys, video resolution, skip-existing,
digests, the manifest and its pointer state, and the manifest reports."""

from __future__ import annotations

import mimetypes
import os
import shutil
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.specs import ASSET_KINDS

ASSET_PREFIX = "assets"
_SPEC_FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in
                             ("creative_id", "image_url", "thumbnail_url", "video_id")])


def _mime_extension_map() -> dict[str, str]:
    """MIME type -> extension, from the standard library's built-in table
    (not the host's mime files, so every executor agrees)."""
    mt = mimetypes.MimeTypes(filenames=())
    out = {}
    for t in sorted(set(mt.types_map[True].values())):
        ext = mt.guess_extension(t)
        if ext:
            out[t] = ext
    return out


MIME_EXT = _mime_extension_map()


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def asset_specs(creatives: DataFrame, payload_col: str = "payload", carry: Sequence[str] = ()) -> DataFrame:
    """One row per downloadable asset of an ODS creative: image, thumbnail,
    video (source URL resolved later).  Empty payloads and empty URLs/ids
    yield nothing."""
    p = F.from_json(F.col(payload_col), _SPEC_FIELDS)
    base = creatives.where(_nonempty(F.col(payload_col))).select(
        F.coalesce(F.nullif(p["creative_id"], F.lit("")), F.col("source_id")).alias("creative_id"),
        "client_uid", "org_uid", *carry,
        F.explode(F.array(
            F.struct(F.lit(ASSET_KINDS[0]).alias("asset_kind"), p["image_url"].alias("source_url"),
                     F.lit(None).cast("string").alias("video_id"), _nonempty(p["image_url"]).alias("ok")),
            F.struct(F.lit(ASSET_KINDS[1]).alias("asset_kind"), p["thumbnail_url"].alias("source_url"),
                     F.lit(None).cast("string").alias("video_id"), _nonempty(p["thumbnail_url"]).alias("ok")),
            F.struct(F.lit(ASSET_KINDS[2]).alias("asset_kind"), F.lit("").alias("source_url"),
                     p["video_id"].alias("video_id"), _nonempty(p["video_id"]).alias("ok")),
        )).alias("a"))
    return base.where("a.ok").select("creative_id", "client_uid", "org_uid", "a.asset_kind", "a.source_url",
                                     "a.video_id", *carry)


def specs_by_kind(specs: DataFrame) -> DataFrame:
    """Spec count per asset kind, zero for kinds with no specs."""
    kinds = specs.sparkSession.createDataFrame([(k,) for k in ASSET_KINDS], "asset_kind string")
    counts = specs.groupBy("asset_kind").agg(F.count(F.lit(1)).alias("n_specs"))
    return (F.broadcast(kinds).join(counts, "asset_kind", "left")  # 3-row side
            .select("asset_kind", F.coalesce("n_specs", F.lit(0)).cast("bigint").alias("n_specs")))


def resolve_videos(specs: DataFrame, sources: DataFrame) -> DataFrame:
    """Fill video source URLs from a (video_id, source) table, one lookup per
    distinct id; videos without a source are dropped, other kinds pass.  One
    left join whose condition only videos can meet."""
    per_id = sources.where(_nonempty(F.col("source"))).groupBy(F.col("video_id").alias("_id")).agg(F.min("source").alias("_src"))
    is_video = F.coalesce(F.col("asset_kind") == ASSET_KINDS[2], F.lit(False))
    wanted = specs.withColumn("_wanted", F.when(is_video, F.col("video_id")))
    j = wanted.join(per_id, F.col("_wanted") == F.col("_id"), "left").where(~is_video | F.col("_src").isNotNull())
    return j.withColumn("source_url", F.when(is_video, F.col("_src")).otherwise(F.col("source_url"))).select(*specs.columns)


def clean_content_type(ct: Column) -> Column:
    """Media type before any ';' parameters, trimmed."""
    return F.trim(F.split_part(ct, F.lit(";"), F.lit(1)))


def object_key(client: Column, kind: Column, creative_id: Column, video_id: Column,
               source_url: Column, content_type: Column | None, prefix: str = ASSET_PREFIX) -> Column:
    """``prefix/client=/asset_kind=/stem.ext``: extension from the MIME type,
    else the URL's last path segment suffix, else '.bin'; videos use the
    video id as stem."""
    mime = F.create_map(*[F.lit(x) for kv in MIME_EXT.items() for x in kv])
    by_type = (F.element_at(mime, F.lower(clean_content_type(content_type)))
               if content_type is not None else F.lit(None).cast("string"))
    path = F.try_parse_url(source_url, F.lit("PATH"))
    last = F.regexp_extract(path, r"[^/]*$", 0)
    by_url = F.when(last.contains("."), F.concat(F.lit("."), F.regexp_extract(last, r"\.([^.]*)$", 1)))
    ext = F.coalesce(by_type, by_url, F.lit(".bin"))
    stem = F.when((kind == ASSET_KINDS[2]) & _nonempty(video_id), video_id).otherwise(creative_id)
    return F.concat(F.lit(f"{prefix}/client="), client, F.lit("/asset_kind="), kind, F.lit("/"), stem, ext)


def with_keys(specs: DataFrame, content_type: str | None = "content_type", prefix: str = ASSET_PREFIX) -> DataFrame:
    """Add the tentative key (no content type, used for the existence check)
    and the final key (with the response content type)."""
    args = (F.col("client_uid"), F.col("asset_kind"), F.col("creative_id"), F.col("video_id"), F.col("source_url"))
    return (specs.withColumn("tentative_key", object_key(*args, None, prefix))
                 .withColumn("object_key", object_key(*args, F.col(content_type) if content_type else None, prefix)))


def _stem(key: Column) -> Column:
    return F.regexp_replace(key, r"\.[^./]*$", "")


def with_existing(specs: DataFrame, listing: DataFrame, mode: str = "exact") -> DataFrame:
    """Keyed specs and ``_l``, the stored object (size, content_type, updated,
    object_key) of each, NULL if there is none.  An object counts as existing
    only with size > 0.  ``exact`` looks up the tentative key; ``stem``
    ignores the extension."""
    lst = listing.where(F.col("size") > 0)
    if mode == "stem":
        lst = lst.withColumn("_k", _stem(F.col("object_key")))
        key = _stem(F.col("tentative_key"))
    elif mode == "exact":
        lst = lst.withColumn("_k", F.col("object_key"))
        key = F.col("tentative_key")
    else:
        raise ValueError(mode)
    lst = lst.groupBy("_k").agg(F.max_by(F.struct("size", "content_type", "updated", "object_key"),
                                         F.col("updated")).alias("_l"))
    return specs.withColumn("_k", key).join(lst, "_k", "left").drop("_k")


def _skipped() -> list[Column]:
    return [F.col("_l.size").cast("bigint").alias("byte_size"),
            F.coalesce(F.col("_l.content_type"), F.lit("")).alias("manifest_content_type"),
            F.lit("").alias("sha256"), F.col("_l.updated").alias("downloaded_at"),
            F.lit(True).alias("skipped_existing")]


def skip_existing(specs: DataFrame, listing: DataFrame, mode: str = "exact") -> tuple[DataFrame, DataFrame]:
    """Split keyed specs into (to_fetch, skipped).  Skipped rows carry the
    listing's size, type and time, an empty digest and ``skipped_existing``."""
    j = with_existing(specs, listing, mode)
    hit = F.col("_l").isNotNull()
    skipped = j.where(hit).select(*[c for c in specs.columns if c != "object_key"], F.col("_l.object_key").alias("object_key"), *_skipped())
    return j.where(~hit).drop("_l"), skipped


def fetch_or_skip(specs: DataFrame, listing: DataFrame, fetched: DataFrame, on: Sequence[str], downloaded_at: Column,
                  mode: str = "exact", content_col: str = "content", key: Column | None = None) -> DataFrame:
    """Manifest rows of keyed specs in one pass: stored objects are skipped,
    the others take their content from ``fetched`` (by ``on``; none there:
    no row).  Two left joins, the second of which only misses can meet;
    nothing is planned twice.  ``key``: the object key of a fetched row."""
    j = with_existing(specs, listing, mode)
    hit = F.col("_l").isNotNull()
    got = fetched.select(*[F.col(c).alias(f"_f_{c}") for c in fetched.columns])
    own = [F.when(~hit, F.col(c)).alias(f"_o_{c}") for c in on]
    cond = None
    for c in on:
        same = F.col(f"_o_{c}") == F.col(f"_f_{c}")
        cond = same if cond is None else cond & same
    j = j.select("*", *own).join(got, cond, "left").where(F.col("_l").isNotNull() | F.col(f"_f_{on[0]}").isNotNull())
    taken = [c for c in fetched.columns if c not in (*on, content_col)]
    j = j.select(*[c for c in specs.columns if c not in taken], "_l", *[F.col(f"_f_{c}").alias(c) for c in taken], F.col(f"_f_{content_col}").alias("_content"))
    size, sha = digest(F.col("_content"))
    new = [size, F.coalesce(clean_content_type(F.col("content_type")), F.lit("")), sha, downloaded_at, F.lit(False)]
    names = ["byte_size", "manifest_content_type", "sha256", "downloaded_at", "skipped_existing"]
    keys = F.when(hit, F.col("_l.object_key")).otherwise(F.col("object_key") if key is None else key).alias("object_key")
    return j.select(*[c for c in j.columns if c not in ("_l", "_content", "object_key")], keys,
                    *[F.when(hit, s).otherwise(n).alias(x) for x, s, n in zip(names, _skipped(), new, strict=True)])


def digest(content: Column) -> tuple[Column, Column]:
    """(byte length, sha-256 hex) of binary or text content."""
    return F.octet_length(content).cast("bigint"), F.sha2(content, 256)


def fetched_rows(to_fetch: DataFrame, downloaded_at: Column, content_col: str = "content") -> DataFrame:
    """Manifest rows for fetched assets (content already in ``content_col``)."""
    size, sha = digest(F.col(content_col))
    return to_fetch.select(
        *[c for c in to_fetch.columns if c not in (content_col,)],
        size.alias("byte_size"), F.coalesce(clean_content_type(F.col("content_type")), F.lit("")).alias("manifest_content_type"),
        sha.alias("sha256"), downloaded_at.alias("downloaded_at"), F.lit(False).alias("skipped_existing"))


MANIFEST_COLUMNS = ["creative_id", "client_uid", "org_uid", "asset_kind", "gcs_uri", "original_url",
                    "content_type", "byte_size", "sha256", "video_id", "downloaded_at", "skipped_existing"]


def to_manifest(rows: DataFrame, uri_prefix: str = "lake://") -> DataFrame:
    return rows.select("creative_id", "client_uid", "org_uid", "asset_kind",
                       F.concat(F.lit(uri_prefix), F.col("object_key")).alias("gcs_uri"),
                       F.col("source_url").alias("original_url"),
                       F.col("manifest_content_type").alias("content_type"), "byte_size", "sha256", "video_id",
                       F.col("downloaded_at").cast("timestamp").alias("downloaded_at"), "skipped_existing")


def store_objects(rows: DataFrame, root: str, key: str, text: str = "value") -> None:
    """Put the rows into storage as text objects: each task one for every
    ``key`` that it meets, a line for each of the key's rows.

    Where storage is a mounted folder, tasks write their objects themselves
    (``<root>/part=<task>/<key>=<value>.txt``) into a folder aside, which one
    rename puts in place; a task that runs again finds its place taken and
    leaves it.  Elsewhere Spark's writer does it (``<root>/<key>=<value>/``):
    on a mounted folder it takes tens of milliseconds for each object, as it
    starts a process for every file and folder to set its mode."""
    spark = rows.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    place = fs.makeQualified(p).toUri()
    if place.getScheme() != "file":
        # Tasks put their own objects in place; else the driver renames one after another.
        rows.select(key, text).write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(root)
        return
    fs.mkdirs(p)
    folder = place.getPath()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        here, aside, n = f"{folder}/part={task.partitionId()}", f"{folder}/_part={task.partitionId()}-{task.taskAttemptId()}", 0
        for batch in batches:
            os.makedirs(aside, exist_ok=True)
            for k, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name = "__HIVE_DEFAULT_PARTITION__" if k is None else quote(str(k), safe="")
                with open(f"{aside}/{key}={name}.txt", "ab") as f:
                    f.writelines((line.as_buffer() or b"", b"\n"))
            n += batch.num_rows
        if n:
            try:
                os.rename(aside, here)
            except OSError:
                if not os.path.isdir(here):
                    raise
                shutil.rmtree(aside)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.select(key, text).mapInArrow(put, "n long").agg(F.sum("n")).collect()


def _objects(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def scan_assets(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Objects already in storage: path, size, digest (binaryFile source)."""
    size, sha = digest(F.col("content"))
    return _objects(spark, path, glob).select(F.col("path"), size.alias("byte_size"), sha.alias("sha256"),
                                              F.col("modificationTime").alias("updated"))


def list_assets(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Objects already in storage: path, size, time.  Only what the listing
    says; the content column is pruned, so no object is opened."""
    return _objects(spark, path, glob).select("path", F.col("length").alias("byte_size"), F.col("modificationTime").alias("updated"))


def write_manifest(results: DataFrame, root: str, run_ts) -> bool:
    """Write a manifest run under date=YYYY-MM-DD, stamped with run_ts; nothing
    is left when there are no rows.  ``results`` is computed once (its count is
    observed by the write).  A run is written aside and moved into its date by
    a name of its own, so a retry replaces it instead of adding to it."""
    spark = results.sparkSession
    ts = run_ts.strftime("%Y%m%dT%H%M%SZ")
    seen = Observation(f"manifest_{ts}")
    aside = f"{root}/_staging/{ts}"
    (results.withColumn("run_ts", F.lit(ts)).observe(seen, F.count(F.lit(1)).alias("n"))
            .write.mode("overwrite").parquet(aside))
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    some = seen.get["n"] > 0
    if some:
        day = Path(f"{root}/date={run_ts:%Y-%m-%d}")
        fs.mkdirs(day)
        for old in fs.globStatus(Path(f"{day.toString()}/run-{ts}-*")) or []:
            fs.delete(old.getPath(), False)
        for st in fs.listStatus(Path(aside)):
            name = st.getPath().getName()
            if name.startswith("part-"):
                fs.rename(st.getPath(), Path(f"{day.toString()}/run-{ts}-{name}"))
    fs.delete(Path(aside), True)
    return some


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """All manifest runs; ``date`` surfaces from the path (as text)."""
    return spark.read.option("basePath", root).parquet(root)


def manifest_latest(m: DataFrame) -> DataFrame:
    """Rows of the most recent run: max date, then max run stamp.  The date is
    filtered on its own first, so only the newest folder is read for the rows."""
    day = m.where(F.col("date") == m.select(F.max("date")).scalar())
    return day.where(F.col("run_ts") == day.select(F.max("run_ts")).scalar())


def pointer_state(m: DataFrame, keys: Sequence[str] = ("client_uid", "creative_id", "asset_kind")) -> DataFrame:
    """Newest row per asset across runs, carrying the last non-empty digest
    (a skipped re-run must not erase it).  One partial aggregate per key."""
    ord_ = F.struct("date", "run_ts", "gcs_uri")  # total order: object uri breaks ties
    cols = [c for c in m.columns if c not in keys]
    sha = F.nullif(F.col("sha256"), F.lit(""))
    agg = m.groupBy(*keys).agg(
        F.max_by(F.struct(*cols), ord_).alias("_last"),
        F.max_by(sha, F.when(sha.isNotNull(), ord_)).alias("_sha"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols if c != "sha256"],
                      F.coalesce("_sha", F.lit("")).alias("sha256"))


# ----------------------------------------------------------------- reports

MB = 1024.0 * 1024.0


def manifest_summary(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).alias("n_asset_rows"),
                 F.count_distinct("creative_id").alias("n_creatives"),
                 F.count_distinct("client_uid").alias("n_clients"),
                 F.round(F.sum("byte_size") / F.lit(MB), 1).alias("total_mb"),
                 F.min("downloaded_at").alias("first_download"),
                 F.max("downloaded_at").alias("last_download"))


def manifest_by_client_kind(m: DataFrame) -> DataFrame:
    return (m.groupBy("client_uid", "asset_kind")
             .agg(F.count(F.lit(1)).alias("n_assets"),
                  F.round(F.sum("byte_size") / F.lit(MB), 2).alias("mb"),
                  F.round(F.avg("byte_size") / F.lit(1024.0), 1).alias("avg_kb"))
             .orderBy(F.col("client_uid").asc_nulls_last(), F.col("asset_kind").asc_nulls_last()))


def manifest_top(m: DataFrame, k: int = 10) -> DataFrame:
    return (m.orderBy(F.col("byte_size").desc_nulls_last(), "client_uid", "creative_id", "asset_kind", "gcs_uri")
             .limit(k)
             .select("client_uid", "asset_kind", "creative_id", "content_type", "byte_size", "sha256",
                     "downloaded_at", "gcs_uri"))


def creative_assets(creatives: DataFrame, m: DataFrame, k: int = 15) -> DataFrame:
    """ODS creatives with their manifest assets: count, ordered kind list,
    total bytes; top ``k`` by (n_assets, total_bytes)."""
    pl = F.col("payload")
    c = creatives.select("client_uid", F.col("source_id").alias("creative_id"),
                         F.get_json_object(pl, "$.creative_name").alias("creative_name"),
                         F.get_json_object(pl, "$.media_type").alias("media_type"),
                         F.get_json_object(pl, "$.cta_type").alias("cta_type"))
    # Counted per kind before the join: a hot creative is one row for each kind.
    per_kind = m.groupBy("client_uid", "creative_id", "asset_kind").agg(F.count("asset_kind").alias("_n"), F.sum("byte_size").alias("_b"))
    per = per_kind.groupBy("client_uid", "creative_id").agg(
        F.sum("_n").alias("_n"), F.sum("_b").alias("_b"),
        F.sort_array(F.collect_list(F.when(F.col("asset_kind").isNotNull(), F.struct("asset_kind", "_n")))).alias("_kinds"))
    kinds = F.array_join(F.transform("_kinds", lambda k: F.array_join(F.array_repeat(k["asset_kind"], k["_n"].cast("int")), ", ")), ", ")
    j = c.join(per, ["client_uid", "creative_id"], "left")
    g = j.groupBy("client_uid", "creative_id", F.substring("creative_name", 1, 60).alias("creative_name"),
                  "media_type", "cta_type").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_assets"),
        F.nullif(F.max(kinds), F.lit("")).alias("kinds_present"),
        F.sum("_b").alias("total_bytes"))
    return g.orderBy(F.col("n_assets").desc(), F.col("total_bytes").desc_nulls_last(),
                     "client_uid", "creative_id").limit(k)


def narrative(link: Column, template: Column, video: Column) -> list[Column]:
    """Canonical headline / body / description / destination from the link,
    template or video branch (first non-NULL wins)."""
    return [
        F.coalesce(link["name"], template["name"], video["title"]).alias("headline"),
        F.coalesce(link["message"], template["message"], video["message"]).alias("body"),
        F.coalesce(link["description"], template["description"], video["link_description"]).alias("description"),
        F.coalesce(link["link"], template["link"], video["call_to_action_link"]).alias("destination_url"),
    ]
