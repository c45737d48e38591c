"""What the refresh writes."""

import os

from pyspark.sql import functions as F

from layerstar.sources import io


def _files(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def test_extracts_are_compressed_files_of_few_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "CSV_LINES", 100)
    path = str(tmp_path / "extract")
    df = spark.range(0, 350, 1, 1).select(F.col("id").cast("string").alias("a"),
                                          F.when(F.col("id") % 3 > 0, F.lit(' "x" ')).alias("b"))
    io.write_csv(df, path)
    assert len(_files(path)) == 4 and all(f.endswith(".csv.lz4") for f in _files(path))
    back = io.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_tables_are_zstd_in_any_session(spark, tmp_path):
    was = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        io.write_full(spark.range(10), str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", was)
    assert all(f.endswith(".zstd.parquet") for f in _files(tmp_path / "t"))
