"""Validation of result files: every problem is a row of (file, severity, kind, detail)."""

from __future__ import annotations

import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUE = "file string, severity string, kind string, detail string"
HEADERS = {"matching_results": ("source1_entity_id", "matched_entity_ids"), "candidate_pairs": ("source1_entity_id", "candidate_entity_ids")}


def parse(lines: DataFrame, file: str, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, issues) of a file's lines (value, line). rows: id, targets. The strict header is exact; a lenient one may differ in case and spaces."""
    want = "\t".join(HEADERS[file])
    head = F.lower(F.regexp_replace("value", " ", "")) if lenient else F.col("value")
    rows = lines.where("line > 0").withColumn("cells", F.split("value", "\t"))
    return rows.where(F.size("cells") == 2).select(F.col("cells")[0].alias("id"), F.filter(F.split(F.col("cells")[1], ","), lambda x: x != "").alias("targets"), "line"), _union(lines.sparkSession, [
        _issue(lines.where("line = 0").where(head != want), file, "header", F.col("value")),
        _issue(rows.where(F.size("cells") != 2), file, "columns", F.concat(F.lit("line "), F.col("line").cast("string"))),
    ])


def _issue(df: DataFrame, file: str, kind: str, detail, severity: str = "error") -> DataFrame:
    return df.select(F.lit(file).alias("file"), F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), detail.alias("detail"))


def _union(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], ISSUE))


def check_rows(rows: DataFrame, file: str, anchors: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Ids, unknown, repeated and missing anchors (by country), repeated and unknown targets. anchors: entity_id, country; targets: entity_id, or None to leave them unchecked."""
    each = rows.select("id", F.explode("targets").alias("target"))
    missing = anchors.join(rows.select(F.col("id").alias("entity_id")), "entity_id", "left_anti")
    parts = [
        _issue(rows.where(~F.col("id").rlike(r"\AS1-[0-9]+\z")), file, "anchor_syntax", F.col("id")),
        _issue(each.where(~F.col("target").rlike(r"\AS[23]-[0-9]+\z")), file, "target_syntax", F.concat_ws(" ", "id", "target")),
        _issue(rows.join(anchors, rows.id == anchors.entity_id, "left_anti"), file, "unknown_anchor", F.col("id")),
        _issue(rows.groupBy("id").count().where("count > 1"), file, "repeated_anchor", F.col("id")),
        _issue(missing, file, "missing_anchor", F.col("entity_id")),
        _issue(missing.groupBy("country").count(), file, "missing_by_country", F.concat_ws(" ", "country", F.col("count").cast("string"))),
        _issue(rows.where(F.size("targets") != F.size(F.array_distinct("targets"))), file, "repeated_target", F.col("id")),
    ]
    if targets is not None:
        parts.append(_issue(each.join(targets, each.target == targets.entity_id, "left_anti"), file, "unknown_target", F.concat_ws(" ", "id", "target")))
    return _union(rows.sparkSession, parts)


def check_subset(matches: DataFrame, candidates: DataFrame, severity: str = "error") -> DataFrame:
    """Matches must be candidates of the same anchor."""
    m, c = (df.select("id", F.explode("targets").alias("target")) for df in (matches, candidates))
    return _issue(m.join(c, ["id", "target"], "left_anti"), "matching_results", "not_a_candidate", F.concat_ws(" ", "id", "target"), severity)


def strict(matches: DataFrame, candidates: DataFrame, anchors: DataFrame, targets: DataFrame) -> DataFrame:
    return check_rows(candidates, "candidate_pairs", anchors, targets).unionByName(check_rows(matches, "matching_results", anchors, targets)).unionByName(check_subset(matches, candidates))


def official(matches: DataFrame, candidates: DataFrame, anchors: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """kind, severity, n by file: targets are checked only if given, and matches outside the candidates only warn."""
    every = check_rows(candidates, "candidate_pairs", anchors, targets).unionByName(check_rows(matches, "matching_results", anchors, targets)).unionByName(check_subset(matches, candidates, "warning"))
    return every.groupBy("file", "severity", "kind").agg(F.count("*").alias("n"))


def main(argv: list[str]) -> int:
    """validate RESULTS CANDIDATES SOURCE1 SOURCE2 SOURCE3: 0 if there are no errors, else 1 with a capped list and the full count."""
    from ..sources.records import read_tsv

    spark = SparkSession.builder.getOrCreate()
    tables = [read_tsv(spark, p) for p in argv[2:5]]
    targets = tables[1].unionByName(tables[2]).select("entity_id")
    rows, found = [], []
    for path, file in zip(argv[:2], HEADERS, strict=True):
        lines = spark.read.option("wholetext", False).text(path).select("value", F.monotonically_increasing_id().alias("line"))
        r, i = parse(lines, file)
        rows.append(r)
        found.append(i)
    issues = _union(spark, [*found, strict(rows[0], rows[1], tables[0], targets)]).cache()
    n = issues.where("severity = 'error'").count()
    for r in issues.limit(50).collect():
        print(*r, sep="\t")
    print(f"{n} errors" if n else "valid")
    return int(n > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
