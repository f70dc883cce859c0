"""The lifecycle: prepare, candidates and features of a fold, experiment, inference, graph refinement, fast-retrieval calibration."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import candidates as cnd
from ..operators import context, features, graph, metrics, models, sampling, tfidf
from ..sources import records, sinks

PROFILES = {"base": len(features.BASE), "advanced": len(features.BASE) + len(features.ADVANCED), "reference": len(features.BASE) + len(features.ADVANCED) + len(context.NAMES)}
SCALE = float(tfidf.SCALE**2)


def keyed(prepared: DataFrame) -> DataFrame:
    return prepared.select("entity_id", "source", "num", "code", "country", F.col("name.normalized").alias("name_key"), F.col("address.normalized").alias("address_key"))


def vocabularies(train: DataFrame, sample: int = 200_000, seed: str = "42", min_df: int = 2, max_df: float = 0.2) -> dict[str, DataFrame]:
    """Fitted on a bottom-hash sample of the training fold."""
    docs = sampling.bottom_hash(train, sample, seed)
    return {b: tfidf.fit(docs, b, min_df, max_df) for b in tfidf.BRANCHES}


def weights(docs: DataFrame, vocab: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {b: tfidf.weigh(docs, v, b) for b, v in vocab.items()}


def candidates(anchors: DataFrame, targets: DataFrame, vocab: dict[str, DataFrame], k: int = 20, cap: int = 200, query_terms: int | None = None, pool: int | None = None) -> DataFrame:
    """The union of three sparse branches and the exact joins, with the cosine of every pair. Labels play no part."""
    q, t = weights(anchors, vocab), weights(targets, vocab)
    code = lambda df: df.withColumn("target_code", F.col("source").cast("long") * 10**12 + F.col("num"))
    sparse = {b: code(tfidf.retrieve(q[b], t[b], k, None if b == "name_word" else query_terms, None if b == "name_word" else pool)) for b in vocab}
    out = cnd.union(sparse, cnd.capped(cnd.exact(anchors, targets, cap), cap)).join(targets.select(F.col("code").alias("target_code"), F.col("entity_id").alias("target_id")), "target_code")
    for b in vocab:
        out = tfidf.cosine(out, q[b], t[b], f"actual_{b}_cosine")
    return out


def feature_table(pairs: DataFrame, anchors: DataFrame, targets: DataFrame, profile: str = "base", roman: dict[str, DataFrame] | None = None) -> tuple[DataFrame, list[str]]:
    """(features, names) of candidates. anchors and targets: prepared records; roman: vocabularies of romanised texts, for the advanced columns' cosines."""
    out, names = features.base(features.paired(pairs, anchors, targets), SCALE), list(features.BASE)
    keys = ["query_id", "target_code"]
    if profile != "base":
        a, b = features.views(anchors), features.views(targets)
        out = out.join(features.advanced(pairs, a, b), keys)
        if roman is None:
            raise ValueError("the advanced profile needs romanised vocabularies")
        text = lambda v, p: v.select("entity_id", F.col("name_roman").alias("name_key"), F.col("address_roman").alias("address_key")).join(p.select("entity_id", "source", "num"), "entity_id")
        q, t, ids = weights(text(a, anchors), roman), weights(text(b, targets), roman), pairs.select("query_id", "target_code", "target_id")
        for branch in roman:
            ids = tfidf.cosine(ids, q[branch], t[branch], f"roman_{branch}_cosine")
        out = out.join(ids.drop("target_id"), keys)
        names += features.ADVANCED
    if profile == "reference":
        out = out.join(context.features(pairs, context.keys(anchors), context.keys(targets)), keys)
        names += context.NAMES
    return out, names


def fingerprint(**config) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def guard(out: str, **config) -> None:
    """Writes the configuration on the first run; a later run with another raises."""
    path = Path(out, "config.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    state = {"config": json.loads(json.dumps(config, default=str)), "fingerprint": fingerprint(**config)}
    if path.exists():
        if json.loads(path.read_text())["fingerprint"] != state["fingerprint"]:
            raise ValueError(f"{path} is of another configuration")
    else:
        records.write_json(path, state)


def prepare(spark: SparkSession, archive: str, out: str, seed: str = "42") -> DataFrame:
    """Archive -> Parquet by fold and source: unpack, check owners, split by identity."""
    names = ("source1.tsv", "source2.tsv", "source3.tsv", "ground_truth.tsv")
    records.extract_members(archive, f"{out}/raw", names)
    rows = [records.read_tsv(spark, f"{out}/raw/{n}").withColumn("source", F.lit(i)) for i, n in enumerate(names[:3], 1)]
    truth = records.read_truth(spark, f"{out}/raw/{names[3]}")
    records.check_owners(truth)
    links = records.links_of(truth)
    every = sampling.split(rows[0].unionByName(rows[1]).unionByName(rows[2]), links, seed)
    sampling.check_split(every, links)
    sinks.write_splits(every, f"{out}/splits")
    links.write.mode("overwrite").parquet(f"{out}/links")
    return spark.read.parquet(f"{out}/splits")


def experiment(split_records: DataFrame, links: DataFrame, out: str, kind: str = "linear", k: int = 20, sample: int = 200_000, max_df: float = 0.2, trees: int | None = None) -> dict:
    """Train on one fold, choose the threshold on calibration, and only then open validation. Each fold's features are written once."""
    guard(out, kind=kind, k=k, sample=sample, max_df=max_df, trees=trees)
    spark = split_records.sparkSession
    prepared = records.prepare(split_records.select(*records.COLUMNS))
    prepared = prepared.join(split_records.select("entity_id", "split"), "entity_id")
    fold = lambda s: prepared.where(F.col("split") == s).drop("split")
    vocab = vocabularies(keyed(fold("train")), sample, max_df=max_df)
    truth = links.select("s1_id", (F.substring("target_id", 2, 1).cast("long") * 10**12 + F.regexp_extract("target_id", r"-(\d+)$", 1).cast("long")).alias("target_code"))

    def build(s: str) -> DataFrame:
        own = fold(s)
        a, t = own.where("source = 1"), own.where("source > 1")
        pairs = cnd.label(candidates(keyed(a), keyed(t), vocab, k), truth)
        feature_table(pairs, a, t)[0].write.mode("overwrite").parquet(f"{out}/{s}/features")
        return spark.read.parquet(f"{out}/{s}/features")

    def scored(s: str, model) -> tuple[DataFrame, DataFrame]:
        data = build(s)
        pairs = models.predict(model, data, list(features.BASE)).select("query_id", "target_code", "score").join(data.select("query_id", "target_code", "label"), ["query_id", "target_code"])
        n = truth.groupBy("s1_id").agg(F.count("*").alias("n_true"))
        anchors = fold(s).where("source = 1").select(F.col("entity_id").alias("s1_id")).join(n, "s1_id", "left").na.fill(0)
        return pairs.withColumnRenamed("query_id", "s1_id"), anchors

    model = models.fit(build("train"), list(features.BASE), f"{out}/models", kind, trees)
    decision = metrics.decide(*scored("calibration", model))
    records.write_json(f"{out}/frozen_decisions.json", decision)
    entities = metrics.per_entity(*scored("validation", model), decision["threshold"])
    result = {"decision": decision, "validation": metrics.summary(entities).first().asDict()}
    records.write_json(f"{out}/result.json", result)
    return result


def inference(anchors: DataFrame, targets: DataFrame, vocab: dict[str, DataFrame], model, names: list[str], threshold: float, out: str, k: int = 20) -> DataFrame:
    """Candidates, features, scores and both result files of prepared records. No truth is read."""
    if len(names) not in PROFILES.values():
        raise ValueError(f"a model of {len(names)} features fits no profile")
    guard(out, names=names, threshold=threshold, k=k)
    profile = next(p for p, n in PROFILES.items() if n == len(names))
    pairs = candidates(keyed(anchors), keyed(targets), vocab, k)
    data, _ = feature_table(pairs, anchors, targets, profile, None if profile == "base" else vocab)
    models.predict(model, data, names).select(F.col("query_id").alias("s1_id"), "target_code", "score").write.mode("overwrite").parquet(f"{out}/scores")
    scored = anchors.sparkSession.read.parquet(f"{out}/scores")
    sinks.write_results(anchors.select("entity_id", "num"), scored, threshold, out)
    return scored


def out_of_fold_scores(data: DataFrame, names: list[str], out: str, kind: str = "linear", trees: int | None = None, folds: int = 3) -> DataFrame:
    """query_id, target_code, score: each anchor's pairs scored by a model that was trained without them."""
    by_fold = data.withColumn("fold", sampling.out_of_fold(F.col("query_id"), folds))
    parts = []
    for i in range(folds):
        model = models.fit(by_fold.where(F.col("fold") != i), names, f"{out}/oof{i}", kind, trees)
        parts.append(models.predict(model, by_fold.where(F.col("fold") == i), names).select("query_id", "target_code", "score"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def graph_refinement(train: DataFrame, calibration: DataFrame, train_targets: DataFrame, calibration_targets: DataFrame, names: list[str], out: str, kind: str = "linear", trees: int | None = None):
    """(model, names): a second model over the features and the graph columns of out-of-fold scores on train, frozen scores on calibration."""
    keys = ["query_id", "target_code"]
    first = models.fit(train, names, f"{out}/seed", kind, trees)
    a = graph.build(out_of_fold_scores(train, names, out, kind, trees), train_targets, "out_of_fold_train")
    b = graph.build(models.predict(first, calibration, names).select(*keys, "score"), calibration_targets, "frozen_calibration")
    wide = [*names, *graph.NAMES]
    model = models.fit(train.join(a, keys), wide, f"{out}/refined", kind, trees)
    return model, wide, models.predict(model, calibration.join(b, keys), wide).select(*keys, "score")


def fast_retrieval(anchors: DataFrame, targets: DataFrame, vocab: dict[str, DataFrame], truth: DataFrame, k: int = 20, query_terms: int = 32, pool: int = 100) -> DataFrame:
    """Links that pruned retrieval with reranking loses or gains against the whole. truth: query_id, target_code."""
    from ..operators.diagnostics import retrieval_diff

    return retrieval_diff(truth, candidates(anchors, targets, vocab, k), candidates(anchors, targets, vocab, k, query_terms=query_terms, pool=pool))
