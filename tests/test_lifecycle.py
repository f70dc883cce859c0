import zipfile

import pytest

from kinweave.operators import candidates, models, validate
from kinweave.plans import lifecycle
from kinweave.sources import records, sinks

HEAD = "\t".join(records.COLUMNS)


def write(path, n):
    words = ["alpha", "bravo", "carol", "delta", "echo", "fox", "golf", "hotel", "india", "juliet"]
    name = lambda i: f"{words[i % 10]} {words[i // 10 % 10]} {words[i * 7 % 10]} works"
    rows = {s: [f"S{s}-{i}\t{name(i)}{' ltd' if s > 1 else ''}\t{i} {words[i % 10]} road {words[i // 10 % 10]}\tUS" for i in range(n)] for s in (1, 2, 3)}
    truth = ["source1_entity_id\tmatched_entity_ids"] + [f"S1-{i}\t" + ("" if i % 5 == 0 else f"S2-{i},S3-{i}") for i in range(n)]
    with zipfile.ZipFile(path, "w") as z:
        for s in rows:
            z.writestr(f"data/source{s}.tsv", "\n".join([HEAD, *rows[s]]) + "\n")
        z.writestr("data/ground_truth.tsv", "\n".join(truth) + "\n")
        z.writestr("__MACOSX/source1.tsv", "junk")


def test_end_to_end(spark, tmp_path):
    write(tmp_path / "a.zip", 120)
    split = lifecycle.prepare(spark, str(tmp_path / "a.zip"), str(tmp_path / "p"))
    links = spark.read.parquet(str(tmp_path / "p/links"))
    assert split.count() == 360 and links.count() == 192
    result = lifecycle.experiment(split, links, str(tmp_path / "e"), k=3, sample=0, max_df=1.0)
    assert result["validation"]["macro_f0_5"] > 0.5
    with pytest.raises(ValueError, match="another configuration"):
        lifecycle.guard(str(tmp_path / "e"), k=4)
    model, names = models.load(str(tmp_path / "e/models/linear"))
    p = records.prepare(split.select(*records.COLUMNS))
    vocab = lifecycle.vocabularies(lifecycle.keyed(p), 0, max_df=1.0)
    a = p.where("source = 1 and num < 6")
    scored = lifecycle.inference(a, p.where("source > 1 and num < 40"), vocab, model, names, 0.5, str(tmp_path / "i"), k=3)
    assert scored.count() and scored.where("not score between 0 and 1").count() == 0
    out = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "i/matching_results"))
    assert sorted(r[0] for r in out.collect()) == [f"S1-{i}" for i in range(6)]


def test_reader_rejects(spark, tmp_path):
    p = tmp_path / "x.tsv"
    p.write_text("a\tb\n1\t2\n")
    with pytest.raises(ValueError, match="header"):
        records.read_tsv(spark, str(p))
    p.write_text(HEAD + '\nS1-1\tnan\t"a\tb"\t\n')
    assert tuple(records.read_tsv(spark, str(p)).first()) == ("S1-1", "nan", "a\tb", "")


def test_owners(spark):
    truth = spark.createDataFrame([("S1-1", ["S2-1"]), ("S1-2", ["S2-1"])], "source1_entity_id string, matched array<string>")
    with pytest.raises(ValueError, match="S2-1"):
        records.check_owners(truth)


def test_grouped_lists_are_in_code_order(spark):
    a = spark.createDataFrame([("S1-1", 1), ("S1-2", 2)], "entity_id string, num long")
    p = spark.createDataFrame([("S1-1", 3 * 10**12), ("S1-1", 2 * 10**12 + 10), ("S1-1", 2 * 10**12 + 9)], "s1_id string, target_code long")
    assert {r.source1_entity_id: r.m for r in sinks.grouped(a, p, "m").collect()} == {"S1-1": "S2-9,S2-10,S3-0", "S1-2": ""}


def test_results_are_one_file_that_validates(spark, tmp_path):
    anchors = spark.createDataFrame([(f"S1-{i}", i, "US") for i in range(50)], "entity_id string, num long, country string")
    scored = spark.createDataFrame([(f"S1-{i}", 2 * 10**12 + i, 0.9 if i % 2 else 0.1) for i in range(50)], "s1_id string, target_code long, score double")
    sinks.write_results(anchors.repartition(7), scored, 0.5, str(tmp_path / "r"))
    for name, pairs in (("matching_results", 25), ("candidate_pairs", 50)):
        files = [p for p in (tmp_path / "r" / name).iterdir() if not p.name.startswith(".")]
        lines = files[0].read_text().splitlines()
        assert len(files) == 1 and lines[0].startswith("source1_entity_id\t") and [x.split("\t")[0] for x in lines[1:]] == [f"S1-{i}" for i in range(50)]
        assert sum("S2-" in x for x in lines) == pairs
    for s in (1, 2, 3):
        (tmp_path / f"{s}.tsv").write_text("\n".join([HEAD, *(f"S{s}-{i}\tname\taddress\tUS" for i in range(50))]) + "\n")
    files = [str(tmp_path / "r" / n / f"{n}.tsv") for n in ("matching_results", "candidate_pairs")]
    assert validate.main([*files, *(str(tmp_path / f"{s}.tsv") for s in (1, 2, 3))]) == 0


def test_candidates_are_checked(spark):
    anchors = spark.createDataFrame([("S1-1",)], "entity_id string")
    targets = spark.createDataFrame([(1,), (2,)], "target_code long")
    pairs = lambda *rows: spark.createDataFrame(rows, "query_id string, target_code long")
    candidates.check(pairs(("S1-1", 1), ("S1-1", 2)), anchors, targets)
    for bad, what in (((("S1-1", 1), ("S1-1", 1)), "twice"), ((("S1-2", 1),), "anchor"), ((("S1-1", 3),), "target"), (((None, 1),), "null")):
        with pytest.raises(ValueError, match=what):
            candidates.check(pairs(*bad), anchors, targets)
