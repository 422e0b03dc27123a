"""Sinks whose files follow each other."""

import json

from pyspark.sql import functions as F

from voltaweave.sources import files


def parts(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_one_object_over_many_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(500).select(F.concat(F.lit('k"\\ é'), "id").alias("key"), F.col("id").alias("v"))
    files.write_object(files.list_entries(df.repartition(7), "key", files.as_list([F.col("v")])), str(tmp_path / "o"))
    assert json.loads(parts(tmp_path / "o")) == {f'k"\\ é{i}': [i] for i in range(500)}
    assert len(list((tmp_path / "o").glob("part-*"))) > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for n in (0, 1):
        files.write_object(files.list_entries(df.limit(n), "key", files.as_list([F.col("v")])), str(tmp_path / f"o{n}"))
        assert len(json.loads(parts(tmp_path / f"o{n}"))) == n
