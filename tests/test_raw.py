"""Raw layer: keep-latest, decode, union by name, snapshots, retention, error isolation."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat import config as C
from reelstat.operators.dedup import keep_latest
from reelstat.sources import raw as R
from reelstat.sources import versions as V


def test_keep_latest_edge_rows(spark):
    rows = [
        (1, "a", "2026-03-01"), (1, "b", "2026-03-02"),          # later date wins
        (2, "x", "2026-03-02"), (2, "y", "2026-03-02"),          # tie -> larger remaining column
        (None, "n1", "2026-03-01"), (None, "n2", "2026-03-01"),  # NULL keys are one group
        (3, "dated", "2026-03-01"), (3, "zzz", None),             # NULL date loses to a date
    ]
    df = spark.createDataFrame(rows, "id long, v string, _ingestion_date string")
    got = {r.id: r.v for r in keep_latest(df, ["id"], "_ingestion_date").collect()}
    assert got == {1: "b", 2: "y", None: "n2", 3: "dated"}


def test_keep_latest_hot_key_and_column_order(spark):
    df = spark.range(30000).select((F.col("id") % 3 == 0).cast("long").alias("k"),
                                   F.col("id").alias("v"), F.lit("2026-01-01").alias("_ingestion_date"))
    out = keep_latest(df, ["k"], "_ingestion_date")
    assert out.columns == df.columns
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, 29999), (1, 29997)]


def test_keep_latest_skips_tables_without_key(spark):
    df = spark.createDataFrame([(1, "a")], "x long, _ingestion_date string")
    assert keep_latest(df, ["missing"], "_ingestion_date") is df


def test_decode_binary_columns(spark):
    df = spark.createDataFrame([(bytearray(b"plain"),), (bytearray("café".encode()),), (None,)], "b binary")
    assert [r.b for r in R.decode_binary_columns(df).collect()] == ["plain", "café", None]


def test_decode_invalid_utf8_fails_the_table(spark):
    df = spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "b binary")
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        R.decode_binary_columns(df).collect()


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    b = spark.createDataFrame([(2, "y", True)], "id long, v string, extra boolean")
    got = sorted(R.union_snapshots([a, b]).collect(), key=lambda r: r.id)
    assert [tuple(r) for r in got] == [(1, "x", None), (2, "y", True)]


def test_names():
    assert R.column_name("movies.csv/Release Year ") == "release_year"
    assert R.column_name("Plain") == "plain"
    assert R.folder_name("watch history.csv") == "watch_history"
    assert R.folder_name("--Movies!!.parquet") == "movies"
    assert R.folder_name("no suffix") == "no_suffix"
    assert R.folder_name("v1.2 notes.tar.gz") == "v1_2_notes_tar"
    assert R.table_folders(["movies.csv", "README.md", "LICENSE", ""]) == {"movies.csv": "movies"}


def test_wider_type():
    assert R.wider_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert R.wider_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert R.wider_type(T.BinaryType(), T.StringType()) == T.StringType()
    assert R.wider_type(T.NullType(), T.BooleanType()) == T.BooleanType()
    with pytest.raises(TypeError):
        R.wider_type(T.StringType(), T.LongType())


def test_snapshots_with_drifting_types(spark, tmp_dir):
    d1, d2, d3 = (dt.date(2026, 3, d) for d in (26, 27, 28))
    days = [(d1, "movie_id long, title binary, release_year long", [(1, bytearray(b"caf\xc3\xa9"), 2001)]),
            (d2, "movie_id long, title string, release_year double", [(2, "text", None), (3, "more", 1999.5)]),
            (d3, "movie_id int, title binary, release_year long, added boolean", [(1, bytearray(b"new"), 2002, True)])]
    for day, schema, rows in days:
        frame = spark.createDataFrame(rows, schema).withColumn("_ingestion_date", F.lit(str(day)))
        R.write_snapshot(frame, tmp_dir, "movies", day)
    raw = R.read_snapshots(spark, tmp_dir, "movies")
    assert dict(raw.dtypes) == {"movie_id": "bigint", "title": "string", "release_year": "double",
                                "added": "boolean", "_ingestion_date": "string"}
    got = {r.movie_id: (r.title, r.release_year, r.added) for r in R.clean_raw_table(raw, "movies").collect()}
    assert got == {1: ("new", 2002.0, True), 2: ("text", None, None), 3: ("more", 1999.5, None)}


def test_snapshots_without_a_common_type_name_the_column(spark, tmp_dir):
    R.write_snapshot(spark.createDataFrame([(1, "x")], "movie_id long, title string"), tmp_dir, "movies", dt.date(2026, 3, 27))
    R.write_snapshot(spark.createDataFrame([(1, 2)], "movie_id long, title long"), tmp_dir, "movies", dt.date(2026, 3, 28))
    with pytest.raises(TypeError, match="title"):
        R.read_snapshots(spark, tmp_dir, "movies")


def test_snapshot_files_as_pandas_writes_them(spark, tmp_dir):
    """Nanosecond timestamps, byte strings, and a column that is all NULL on one day."""
    stamp = 1_774_656_000_123_456_789
    for day, genre in (("27", pa.array([None], pa.null())), ("28", pa.array(["Drama"]))):
        folder = f"{tmp_dir}/movies/year=2026/month=03/day={day}"
        os.makedirs(folder)
        pq.write_table(pa.table({
            "movie_id": pa.array([int(day)]), "title": pa.array([b"bytes"], pa.binary()), "genre_primary": genre,
            "added_to_platform": pa.array([stamp], pa.timestamp("ns")), "_ingestion_date": pa.array([f"2026-03-{day}"]),
        }), f"{folder}/movies.parquet", version="2.6")
    rows = R.clean_raw_table(R.read_snapshots(spark, tmp_dir, "movies"), "movies").collect()
    assert sorted((r.movie_id, r.title, r.genre_primary, r.added_to_platform) for r in rows) == [
        (27, "bytes", None, stamp), (28, "bytes", "Drama", stamp)]


def test_keep_latest_needs_the_order_column(spark):
    with pytest.raises(ValueError, match="_ingestion_date"):
        keep_latest(spark.createDataFrame([(1, "a")], "id long, v string"), ["id"], "_ingestion_date")


def _snapshot(spark, ids, day, extra=False):
    rows = [(i, f"m{i}-{day}", day) + ((True,) if extra else ()) for i in ids]
    schema = "movie_id long, title string, _ingestion_date string" + (", content_warning boolean" if extra else "")
    return spark.createDataFrame(rows, schema)


def test_snapshot_roundtrip_drift_and_rewrite(spark, tmp_dir):
    d1, d2 = dt.date(2026, 3, 27), dt.date(2026, 3, 28)
    R.write_snapshot(_snapshot(spark, [1, 2], "2026-03-27"), tmp_dir, "movies", d1)
    R.write_snapshot(_snapshot(spark, [9], "2026-03-28"), tmp_dir, "movies", d2)
    # rewriting a day replaces only that day
    R.write_snapshot(_snapshot(spark, [2, 3], "2026-03-28", extra=True), tmp_dir, "movies", d2)
    assert sorted(os.listdir(f"{tmp_dir}/movies/year=2026/month=03")) == ["day=27", "day=28"]
    all_rows = R.read_snapshots(spark, tmp_dir, "movies")
    assert set(all_rows.columns) == {"movie_id", "title", "_ingestion_date", "content_warning"}
    assert all_rows.count() == 4
    latest = {r.movie_id: (r.title, r.content_warning)
              for r in R.clean_raw_table(all_rows, "movies").collect()}
    assert latest == {1: ("m1-2026-03-27", None), 2: ("m2-2026-03-28", True), 3: ("m3-2026-03-28", True)}
    recent = R.read_snapshots(spark, tmp_dir, "movies", run_date=d2, retention_days=1)
    assert sorted(r.movie_id for r in recent.collect()) == [2, 3]


def test_load_raw_layer_isolates_failures(spark, tmp_dir):
    snaps = f"{tmp_dir}/snapshots"
    R.write_snapshot(_snapshot(spark, [1, 1, 2], "2026-03-28"), snaps, "movies", dt.date(2026, 3, 28))
    bad = spark.createDataFrame([(1, bytearray(b"\xff"), "2026-03-28")],
                                "user_id long, gender binary, _ingestion_date string")
    R.write_snapshot(bad, snaps, "users", dt.date(2026, 3, 28))
    cfg = C.BuildConfig(warehouse=f"{tmp_dir}/wh", snapshots=snaps)
    with pytest.raises(RuntimeError, match="users"):
        R.load_raw_layer(spark, cfg)
    movies = V.read_table(spark, cfg.layer_path("raw", "movies"))
    assert movies.count() == 2


def test_ingest_all_skips_empty_and_failing(spark):
    def boom():
        raise ValueError("download failed")
    readers = {
        "movies.csv": lambda: spark.createDataFrame([(1, "x")], ["Movie ID", "Title"]),
        "empty.csv": lambda: spark.createDataFrame([], "a long"),
        "broken.csv": boom,
        "README.md": lambda: spark.createDataFrame([(1,)], "a long"),
    }
    out = R.ingest_all(readers, dt.date(2026, 3, 28), "test")
    assert list(out) == ["movies"]
    row = out["movies"].collect()[0]
    assert row.asDict() == {"movie_id": 1, "title": "x", "_ingestion_date": "2026-03-28",
                            "_record_set": "movies", "_source": "test"}
    with pytest.raises(RuntimeError):
        R.ingest_all({"broken.csv": boom}, dt.date(2026, 3, 28), "test")


def test_column_aliases_rename_or_fill(spark):
    df = spark.createDataFrame([(1, None, 7), (2, 5, 9)], "id long, seen long, given long")
    assert [tuple(r) for r in R.apply_aliases(df, {"given": "seen", "absent": "x"}).orderBy("id").collect()] == [(1, 7), (2, 5)]
    assert R.apply_aliases(df, {"given": "is_original"}).columns == ["id", "seen", "is_original"]
    assert R.apply_aliases(df, {"id": "id"}).columns == df.columns


def test_many_days_of_one_schema_are_one_group_and_a_change_of_type_splits(spark, tmp_dir, monkeypatch):
    paths = []
    for day in range(16):
        frame = spark.range(2).selectExpr("id", "id AS n") if day < 11 else spark.range(2).selectExpr("id", "CAST(id AS STRING) AS n", "1 AS extra")
        frame.coalesce(1).write.parquet(f"{tmp_dir}/{day:02d}")
        paths.append(f"{tmp_dir}/{day:02d}")
    reads = []
    reader = type(spark.read)
    monkeypatch.setattr(reader, "parquet", lambda self, *p, f=reader.parquet, **k: reads.append(p) or f(self, *p, **k))
    assert [p for _, p in R.schema_groups(spark, paths[:11])] == [paths[:11]] and len(reads) == 1
    reads.clear()
    groups = {len(s): sorted(p) for s, p in R.schema_groups(spark, paths)}
    assert groups == {2: paths[:11], 3: paths[11:]} and len(reads) <= 11
    monkeypatch.undo()
    with pytest.raises(Exception):
        R.schema_groups(spark, [*paths[:3], f"{tmp_dir}/missing"])
