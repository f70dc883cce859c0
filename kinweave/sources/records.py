"""Source records and ground truth: schemas, scans, lookups."""

from __future__ import annotations

import hashlib
import json
import shutil
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

COLUMNS = ("entity_id", "business_name", "business_address", "country")
RECORD = ", ".join(f"{c} string" for c in COLUMNS)
TRUTH = "source1_entity_id string, matched_entity_ids string"


def read_tsv(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """A tab-separated file with exactly this header; malformed rows raise, nulls become ''."""
    wanted = "\t".join(x.split()[0] for x in schema.split(", "))
    head = spark.read.text(path).first()
    if head is None or head[0].lstrip("﻿") != wanted:
        raise ValueError(f"{path}: the header is not {wanted!r}")
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"').option("mode", "FAILFAST").csv(path).na.fill("")


def read_truth(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """source1_entity_id and matched (array) for the wanted entities, all of which must be there."""
    truth = read_tsv(spark, path, TRUTH).select("source1_entity_id", F.filter(F.split("matched_entity_ids", ","), lambda x: x != "").alias("matched"))
    if wanted is None:
        return truth
    ids = wanted.select(F.col("entity_id").alias("source1_entity_id"))
    missing = ids.join(truth, "source1_entity_id", "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"no truth for {missing[0][0]}")
    return truth.join(ids, "source1_entity_id", "left_semi")


def links_of(truth: DataFrame) -> DataFrame:
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode("matched").alias("target_id"))


def check_owners(truth: DataFrame) -> None:
    """Raises where an anchor is listed twice or a target has two owners."""
    for what, df in (("anchor", truth.groupBy("source1_entity_id").count()), ("target", links_of(truth).groupBy("target_id").count())):
        bad = df.where("count > 1").limit(1).collect()
        if bad:
            raise ValueError(f"{what} {bad[0][0]} occurs {bad[0][1]} times")


def extract_members(archive: str, out: str, names: tuple[str, ...]) -> dict[str, str]:
    """Unpacks the one member for each name, each in one step, and writes a manifest of checksums. Members under __MACOSX/ don't count."""
    Path(out).mkdir(parents=True, exist_ok=True)
    sums = {}
    with zipfile.ZipFile(archive) as z:
        for name in names:
            found = [m for m in z.namelist() if Path(m).name == name and not m.startswith("__MACOSX/")]
            if len(found) != 1:
                raise ValueError(f"{archive}: {len(found)} members are named {name}")
            part = Path(out, f".{name}.part")
            with z.open(found[0]) as a, part.open("wb") as b:
                shutil.copyfileobj(a, b)
            sums[name] = hashlib.sha256(part.read_bytes()).hexdigest()
            part.rename(Path(out, name))
    write_json(Path(out, "manifest.json"), sums)
    return sums


def write_json(path: str | Path, value) -> None:
    """In one step: readers see the old file or the new."""
    path = Path(path)
    part = path.with_name(f".{path.name}.part")
    part.write_text(json.dumps(value, indent=1, sort_keys=True))
    part.rename(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def prepare(records: DataFrame) -> DataFrame:
    """Records with num, source, code, and the prepared fields name.* and address.*, computed once for each entity."""
    source = F.substring("entity_id", 2, 1).cast("int")
    return records.select(
        *COLUMNS, source.alias("source"), text.numeric_id(F.col("entity_id")).alias("num"),
        F.struct(*text.prepared(F.col("business_name"), True)).alias("name"),
        F.struct(*text.prepared(F.col("business_address"), False)).alias("address"),
        text.normalize_text(F.col("country")).alias("country_key"),
    ).withColumn("code", F.col("source").cast("long") * text.CODE + F.col("num"))


def lookup(prepared: DataFrame, codes: DataFrame, name_keys: DataFrame, address_keys: DataFrame) -> DataFrame:
    """Records hit by code, name key or address key, each once."""
    hit = prepared.join(codes.select("code"), "code", "left_semi")
    for keys, col in ((name_keys, "name"), (address_keys, "address")):
        key: Column = F.col(f"{col}.normalized")
        hit = hit.unionByName(prepared.withColumn("_k", key).where("_k <> ''").join(keys.select(F.col("key").alias("_k")), "_k", "left_semi").drop("_k"))
    return hit.dropDuplicates(["code"])


def lookup_targets(targets: DataFrame, candidates: DataFrame) -> DataFrame:
    """The targets that candidates refer to; raises on missing or repeated ones."""
    wanted = candidates.select(F.col("target_code").alias("code")).distinct()
    found = targets.join(wanted, "code", "left_semi")
    twice, none = found.groupBy("code").count().where("count > 1").limit(1).collect(), wanted.join(found, "code", "left_anti").limit(1).collect()
    if twice or none:
        raise ValueError(f"target {(twice or none)[0][0]} is {'repeated' if twice else 'missing'}")
    return found


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as records of three sources."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(
        F.concat(F.lit("S"), F.expr("1 + cast(replace(source, 'src', '') as int) % 3").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.expr("left(split_part(text, '.', 1), 60)").alias("business_name"),
        F.expr("concat(left(split_part(text, '.', 2), 80), ' ', cast(n_chars % 97 as string))").alias("business_address"),
        F.col("lang").alias("country"), F.expr("1 + cast(replace(source, 'src', '') as int) % 3").alias("source"), F.col("doc_id").alias("num"),
    )


def links_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth for from_documents(): targets that begin like an anchor; the smallest such anchor owns them."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.expr("1 + cast(replace(source, 'src', '') as int) % 3").alias("s"), F.expr("md5(left(text, 100))").alias("k"))
    owners = d.where("s = 1").groupBy("k").agg(F.min("doc_id").alias("owner"))
    return d.where("s > 1").join(owners, "k").select(F.concat(F.lit("S1-"), F.col("owner").cast("string")).alias("s1_id"), F.concat(F.lit("S"), F.col("s").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("target_id"))
