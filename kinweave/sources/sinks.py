"""Sinks: grouped result files, split files, event log."""

from __future__ import annotations

import json
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import decode_target


def grouped(anchors: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """One row for each anchor: its targets by code, joined by commas, '' if it has none. pairs: s1_id, target_code."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("target_code")).alias("codes"))
    out = anchors.select(F.col("entity_id").alias("source1_entity_id"), "num").join(lists, F.col("source1_entity_id") == F.col("s1_id"), "left")
    return out.select("num", "source1_entity_id", F.coalesce(F.array_join(F.transform("codes", decode_target), ","), F.lit("")).alias(name))


def write_results(anchors: DataFrame, scored: DataFrame, threshold: float, out: str) -> None:
    """matching_results and candidate_pairs, a folder with one TSV file each, with one header, in the order of the anchors' numbers."""
    for folder, name, pairs in (("matching_results", "matched_entity_ids", scored.where(F.col("score") >= threshold)), ("candidate_pairs", "candidate_entity_ids", scored)):
        rows = grouped(anchors, pairs, name)
        parts = f"{out}/_{folder}-parts"
        rows.repartitionByRange("num").sortWithinPartitions("num").drop("num").write.mode("overwrite").option("sep", "\t").option("emptyValue", "").csv(parts)
        _join_parts(anchors.sparkSession, parts, f"{out}/{folder}/{folder}.tsv", f"source1_entity_id\t{name}\n")


def _join_parts(spark: SparkSession, parts: str, out: str, header: str) -> None:
    """One file of the header and the part files in order, whose bytes stream through the driver; the parts are deleted."""
    jvm = spark.sparkContext._jvm
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path
    source, target = path(parts), path(out)
    fs = target.getFileSystem(conf)
    fs.delete(target.getParent(), True)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(header.encode()))
        for part in sorted(str(x.getPath()) for x in fs.listStatus(source) if x.getPath().getName().startswith("part-")):
            reader = fs.open(path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(reader, stream, conf, False)
            finally:
                reader.close()
    finally:
        stream.close()
    fs.delete(source, True)


def write_splits(df: DataFrame, out: str) -> None:
    df.write.mode("overwrite").partitionBy("split", "source").parquet(out)


def event(**fields) -> None:
    """One JSON line with the UTC time."""
    logging.getLogger("kinweave").info(json.dumps({"at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())} | fields, sort_keys=True))
