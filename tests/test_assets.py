"""Asset specs, object keys, skip-existing and pointer state."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from adlake.operators import assets as A
from adlake.plans import catalog_assets


def _creatives(spark, payloads):
    return spark.createDataFrame([("c", "o", str(i), p) for i, p in enumerate(payloads)],
                                 "client_uid string, org_uid string, source_id string, payload string")


def test_specs_image_and_video_no_thumbnail(spark):
    p = json.dumps({"creative_id": "9", "image_url": "https://x/a.jpg", "thumbnail_url": None, "video_id": "v1"})
    out = A.asset_specs(_creatives(spark, [p, ""])).collect()
    assert sorted(r["asset_kind"] for r in out) == ["image", "video"]
    assert all(r["creative_id"] == "9" for r in out)


def test_object_key_extensions(spark):
    rows = [("c", "image", "1", None, "https://h/a/b.jpg?x=1", None),
            ("c", "image", "2", None, "https://h/a/b", "image/png"),
            ("c", "image", "3", None, "https://h/a/b", None),
            ("c", "video", "4", "v9", "https://h/v", "video/mp4; codecs=x")]
    df = spark.createDataFrame(rows, "client_uid string, asset_kind string, creative_id string, video_id string, "
                                     "source_url string, content_type string")
    keys = [r["object_key"] for r in A.with_keys(df).orderBy("creative_id").collect()]
    assert keys == ["assets/client=c/asset_kind=image/1.jpg", "assets/client=c/asset_kind=image/2.png",
                    "assets/client=c/asset_kind=image/3.bin", "assets/client=c/asset_kind=video/v9.mp4"]


def test_skip_existing_needs_positive_size(spark):
    specs = A.with_keys(spark.createDataFrame(
        [("c", "o", "image", "1", None, "https://h/1.jpg", None), ("c", "o", "image", "2", None, "https://h/2.jpg", None)],
        "client_uid string, org_uid string, asset_kind string, creative_id string, video_id string, "
        "source_url string, content_type string"))
    ts = dt.datetime(2024, 1, 1)
    listing = spark.createDataFrame(
        [("assets/client=c/asset_kind=image/1.jpg", 0, "image/jpeg", ts),
         ("assets/client=c/asset_kind=image/2.jpg", 10, "image/jpeg", ts)],
        "object_key string, size long, content_type string, updated timestamp")
    to_fetch, skipped = A.skip_existing(specs, listing)
    assert [r["creative_id"] for r in to_fetch.collect()] == ["1"]
    s = skipped.collect()
    assert len(s) == 1 and s[0]["sha256"] == "" and s[0]["byte_size"] == 10 and s[0]["skipped_existing"]


def test_pointer_state_carries_last_hash(spark):
    rows = [("c", "1", "image", "h1", "2024-03-01", "20240301T000000Z", "u1"),
            ("c", "1", "image", "", "2024-03-02", "20240302T000000Z", "u2")]
    m = spark.createDataFrame(rows, "client_uid string, creative_id string, asset_kind string, sha256 string, "
                                    "date string, run_ts string, gcs_uri string")
    out = A.pointer_state(m).collect()
    assert len(out) == 1 and out[0]["gcs_uri"] == "u2" and out[0]["sha256"] == "h1"


def test_binary_scan_digest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    r = A.scan_assets(spark, str(tmp_path)).first()
    assert r["byte_size"] == 5
    assert r["sha256"] == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"


def test_manifest_write_skips_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "creative_id string, byte_size long")
    assert A.write_manifest(empty, str(tmp_path / "m"), dt.datetime(2024, 1, 1)) is False
    one = spark.createDataFrame([("1", 3)], "creative_id string, byte_size long")
    assert A.write_manifest(one, str(tmp_path / "m"), dt.datetime(2024, 1, 1, 2, 3, 4))
    r = A.read_manifest(spark, str(tmp_path / "m")).first()
    assert r["date"] == "2024-01-01" and r["run_ts"] == "20240101T020304Z"


def test_build_manifest_job(spark, tmp_path):
    from adlake.plans.jobs import build_manifest
    p1 = json.dumps({"creative_id": "1", "image_url": "https://h/1.jpg", "video_id": "v1"})
    p2 = json.dumps({"creative_id": "2", "image_url": "https://h/2"})
    creatives = spark.createDataFrame([("c", "o", "1", p1), ("c", "o", "2", p2)],
                                      "client_uid string, org_uid string, source_id string, payload string")
    videos = spark.createDataFrame([("v1", "https://v/1.mp4")], "video_id string, source string")
    ts = dt.datetime(2024, 3, 1)
    listing = spark.createDataFrame([("assets/client=c/asset_kind=image/1.jpg", 7, "image/jpeg", ts)],
                                    "object_key string, size long, content_type string, updated timestamp")
    fetched = spark.createDataFrame(
        [("c", "1", "video", bytearray(b"vid"), "video/mp4"), ("c", "2", "image", bytearray(b"png!"), "image/png")],
        "client_uid string, creative_id string, asset_kind string, content binary, content_type string")
    root = str(tmp_path / "manifest")
    m = build_manifest(spark, creatives, videos, listing, fetched, root, dt.datetime(2024, 3, 2, 1, 2, 3)).first()
    assert (m["n_manifested"], m["n_new"], m["n_skipped"]) == (3, 2, 1)
    rows = {(r["creative_id"], r["asset_kind"]): r for r in A.read_manifest(spark, root).collect()}
    assert rows[("2", "image")]["gcs_uri"].endswith("asset_kind=image/2.png")
    assert rows[("1", "video")]["gcs_uri"].endswith("asset_kind=video/v1.mp4")
    assert rows[("1", "image")]["sha256"] == "" and rows[("1", "image")]["byte_size"] == 7


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_listing_sizes_opens_no_object(spark, tmp_path):
    for name in ("a.bin", "b.bin"):
        (tmp_path / name).write_bytes(name.encode() * 5)
    listed = A.list_assets(spark, str(tmp_path), "*.bin")
    assert {r.path.rsplit("/", 1)[1]: r.byte_size for r in listed.collect()} == {"a.bin": 25, "b.bin": 25}
    schema = _plan(listed).split("ReadSchema: ")[1]
    assert "content" not in schema and "length" in schema
    scanned = A.scan_assets(spark, str(tmp_path), "*.bin")
    assert "content" in _plan(scanned).split("ReadSchema: ")[1] and {r.byte_size for r in scanned.collect()} == {25}


def test_fetch_or_skip_is_the_split_in_one_pass(spark):
    specs = spark.createDataFrame([("1", "c", "image", "p/1.jpg", "p/1.jpg"), ("2", "c", "image", "p/2.jpg", "p/2.jpg"), ("3", "c", "image", "p/3.jpg", "p/3.jpg"), ("4", "c", "image", None, "p/4.jpg")],
                                  "creative_id string, client_uid string, asset_kind string, tentative_key string, object_key string").withColumn("content_type", F.lit("image/png; q=1"))
    listing = spark.createDataFrame([("p/1.jpg", 9, "image/jpeg", 1), ("p/2.jpg", 0, "image/jpeg", 1), ("p/9.jpg", 4, "x", 1)], "object_key string, size long, content_type string, updated long")
    fetched = spark.createDataFrame([("2", bytearray(b"two")), ("1", bytearray(b"one")), ("4", bytearray(b""))], "creative_id string, content binary")
    rows = A.fetch_or_skip(specs, listing, fetched, ["creative_id"], F.lit(5).cast("long"))
    got = {r.creative_id: (r.object_key, r.byte_size, r.skipped_existing, r.manifest_content_type, r.downloaded_at) for r in rows.collect()}
    assert got == {"1": ("p/1.jpg", 9, True, "image/jpeg", 1), "2": ("p/2.jpg", 3, False, "image/png", 5), "4": ("p/4.jpg", 0, False, "image/png", 5)}
    to_fetch, skipped = A.skip_existing(specs, listing)
    split = A.fetched_rows(to_fetch.join(fetched, "creative_id"), F.lit(5).cast("long")).unionByName(skipped, allowMissingColumns=True)
    columns = sorted(set(rows.columns) & set(split.columns))
    assert sorted(map(str, rows.select(*columns).collect())) == sorted(map(str, split.select(*columns).collect()))


def test_videos_are_resolved_in_one_join(spark, tmp_path):
    specs = spark.createDataFrame([("1", "image", None, "u1"), ("2", "video", "v", "old"), ("3", "video", "w", None), ("4", "video", None, None), ("5", None, "v", "u5")], "creative_id string, asset_kind string, video_id string, source_url string")
    specs.write.parquet(f"{tmp_path}/s")
    sources = spark.createDataFrame([("v", "b"), ("v", "a"), ("w", ""), (None, "z")], "video_id string, source string")
    out = A.resolve_videos(spark.read.parquet(f"{tmp_path}/s"), sources)
    assert _plan(out).count("FileScan parquet") == 1
    assert {r.creative_id: r.source_url for r in out.collect()} == {"1": "u1", "2": "a", "5": "u5"}


def _pages(spark, tmp_path):
    rows = [(i, f"<p>page {i}</p>") for i in range(40)] + [(7, "again"), (41, None)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(2).write.parquet(f"{tmp_path}/t/pages.parquet")
    return f"{tmp_path}/t"


def test_objects_lie_in_a_folder_of_their_task(spark, tmp_path):
    root = catalog_assets._store_pages(spark, _pages(spark, tmp_path)).removeprefix("file:")
    folders = [x for x in os.listdir(root) if os.path.isdir(f"{root}/{x}")]
    assert 1 <= len(folders) <= 2  # not one for each of 41 ids
    # A key's rows in a task are lines of one object.
    found = {x: open(f"{root}/{f}/{x}").read() for f in folders for x in os.listdir(f"{root}/{f}")}
    assert found["page_id=3.txt"] == "<p>page 3</p>\n" and found["page_id=41.txt"] == "\n"
    assert len(found) == 41 and sum(x.count("\n") for x in found.values()) >= 41


def test_objects_by_scheme_and_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k long, value string").coalesce(1)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.objects.link./at", f"file://{tmp_path}")
    for root in (f"{tmp_path}/own", "viewfs://objects/at/spark"):
        A.store_objects(df, root, "k")
        got = A.scan_assets(spark, root, "*.txt").select(F.regexp_extract("path", "k=([^./]*)[./]", 1).alias("k"), "byte_size")
        assert sorted(map(tuple, got.collect())) == [("1", 4), ("2", 1), ("__HIVE_DEFAULT_PARTITION__", 2)]
    # A task that runs again leaves what is in place.
    A.store_objects(df, f"{tmp_path}/own", "k")
    assert os.listdir(f"{tmp_path}/own") == ["part=0"] and A.list_assets(spark, f"{tmp_path}/own", "*.txt").count() == 3
