"""The query catalogue: each operator over the whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text
from ..operators import candidates as cnd
from ..operators import context, diagnostics, features, graph, metrics, sampling, tfidf, translate, validate
from ..sources import records, sinks
from ..sources.steps import discard, finish, materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
K, CHAR_MAX_DF, CAP = 5, 0.02, 3
Q = float(tfidf.SCALE**2)


def query(sql: str | None = None, base: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH {(base or BASE).strip()}\n{sql.strip()}"
        return f

    return add


def _n(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(replace(lower(nfc_normalize({x})), 'ß', 'ss'), '&', ' and '), '[^\p{{L}}\p{{N}}\p{{M}}]', ' ', 'g'), '\s+', ' ', 'g'))"


_ALIAS = "CASE t " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in text.LEGAL_ALIASES.items()) + " ELSE t END"
_SUFFIX = "|".join(text.LEGAL_SUFFIXES)
#: A legal form behind each name, so that those functions have work.
FORMS = ("", " Private Limited", " Incorporated", " & Company LLC", " Corporation")

BASE = rf"""
src AS (SELECT *, 1 + CAST(replace(source, 'src', '') AS INT) % 3 AS s FROM documents),
records AS (SELECT concat('S', s, '-', doc_id) AS entity_id, left(split_part(text, '.', 1), 60) AS business_name, concat(left(split_part(text, '.', 2), 80), ' ', n_chars % 97) AS business_address, lang AS country, s AS source, doc_id AS num FROM src),
begins AS (SELECT doc_id, s, md5(left(text, 100)) AS k FROM src),
owners AS (SELECT k, min(doc_id) AS owner FROM begins WHERE s = 1 GROUP BY k),
links AS (SELECT concat('S1-', owner) AS s1_id, concat('S', s, '-', doc_id) AS target_id, s * 1000000000000 + doc_id AS target_code FROM owners JOIN begins USING (k) WHERE s > 1),
norm AS (SELECT *, source * 1000000000000 + num AS code, {_n('business_name')} AS name_key, {_n('business_address')} AS address_key FROM records),
toks AS (SELECT *, list_sort(list_distinct(list_filter(string_split(name_key, ' '), lambda t: t <> ''))) AS nt, list_sort(list_distinct(list_filter(string_split(address_key, ' '), lambda t: t <> ''))) AS at,
  list_sort(list_distinct(list_transform(regexp_extract_all(name_key, '[0-9]+'), lambda x: regexp_replace(x, '^0+([0-9])', '\1')))) AS nn,
  list_sort(list_distinct(list_transform(regexp_extract_all(address_key, '[0-9]+'), lambda x: regexp_replace(x, '^0+([0-9])', '\1')))) AS an FROM norm),
forms AS (SELECT entity_id, {_n("business_name || list_extract([" + ", ".join(f"'{f}'" for f in FORMS) + "], CAST(num % 5 AS INT) + 1)")} AS n FROM records),
legal AS (SELECT entity_id, n, array_to_string(list_transform(list_filter(string_split(n, ' '), lambda t: t <> ''), lambda t: {_ALIAS}), ' ') AS legal FROM forms),
exact0 AS (SELECT q.entity_id AS query_id, t.code AS target_code, 8 AS mask FROM norm q JOIN norm t ON q.name_key = t.name_key WHERE q.source = 1 AND t.source > 1 AND q.name_key <> ''
  UNION ALL SELECT q.entity_id, t.code, 16 FROM norm q JOIN norm t ON q.address_key = t.address_key WHERE q.source = 1 AND t.source > 1 AND regexp_matches(q.address_key, '[0-9]')),
exact1 AS (SELECT query_id, target_code, bit_or(mask) AS mask FROM exact0 GROUP BY ALL),
capped AS (SELECT * FROM exact1 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY target_code) <= {CAP}),
size AS (SELECT count(*) AS n FROM norm),
wt AS (SELECT entity_id, source, num, term, count(*) AS tf FROM (SELECT entity_id, source, num, unnest(regexp_extract_all(name_key, '[\p{{L}}\p{{N}}_]+')) AS term FROM norm) GROUP BY ALL),
wv AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM wt GROUP BY term), size WHERE df >= 2 AND df <= 0.2 * n),
ww AS (SELECT entity_id, source, num, term, idf, CAST(round(x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) * 1e6) AS BIGINT) AS w FROM (SELECT *, (1 + ln(tf)) * idf AS x FROM wt JOIN wv USING (term))),
wscore AS (SELECT q.entity_id AS query_id, t.entity_id AS target_id, t.source, t.num, CAST(sum(q.w * t.w) AS BIGINT) AS score FROM ww q JOIN ww t USING (term) WHERE q.source = 1 AND t.source > 1 GROUP BY ALL HAVING sum(q.w * t.w) > 0),
wtop AS (SELECT *, source * 1000000000000 + num AS target_code FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) AS rank FROM wscore) WHERE rank <= {K}),
cand AS (SELECT query_id, target_code, bit_or(mask) AS mask, max(score) AS score_name_word, max(rank) AS rank_name_word FROM (SELECT query_id, target_code, 2 AS mask, score, rank FROM wtop UNION ALL SELECT query_id, target_code, mask, 0, 0 FROM capped) GROUP BY ALL),
lab AS (SELECT c.*, CASE WHEN l.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM cand c LEFT JOIN links l ON c.query_id = l.s1_id AND c.target_code = l.target_code),
anchors AS (SELECT entity_id AS query_id, country, business_name, business_address FROM records WHERE source = 1),
truth AS (SELECT query_id AS s1_id, country, count(target_id) AS n_true FROM anchors LEFT JOIN links ON query_id = s1_id GROUP BY ALL),
perq AS (SELECT a.query_id, a.country, count(l.target_code) AS n_true, count(c.target_code) AS n_found FROM anchors a LEFT JOIN links l ON a.query_id = l.s1_id LEFT JOIN cand c ON c.query_id = l.s1_id AND c.target_code = l.target_code GROUP BY ALL),
scored AS (SELECT query_id AS s1_id, target_code, label, round(score_name_word / 1e12, 3) AS score FROM lab),
ent AS (SELECT t.s1_id, country, n_true, CAST(coalesce(sum(label), 0) AS BIGINT) AS tp, count(p.s1_id) AS predicted FROM truth t LEFT JOIN (SELECT * FROM scored WHERE score >= 0.5) p ON t.s1_id = p.s1_id GROUP BY ALL),
entf AS (SELECT *, CASE WHEN predicted = 0 AND n_true = 0 THEN 1.0 ELSE 1.25 * tp / (predicted + 0.25 * n_true) END AS f05 FROM ent),
gold AS (SELECT s1_id, target_id, l.name_key AS ln, r.name_key AS rn, l.address_key AS la, r.address_key AS ra, l.nt AS lnt, r.nt AS rnt, l.at AS lat, r.at AS rat, l.nn AS lnn, r.nn AS rnn, l.an AS lan, r.an AS ran, l.country AS lc, r.country AS rc, l.business_name AS lbn, r.business_name AS rbn
  FROM links JOIN toks l ON s1_id = l.entity_id JOIN toks r ON target_id = r.entity_id)"""

#: The same with all pairs of the exact joins as candidates.
WHOLE = BASE.replace(f" QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY target_code) <= {CAP}", "").replace("capped", "uncapped")


def _records(spark, d):
    return records.from_documents(spark, d)


def _norm(spark, d):
    return _records(spark, d).withColumn("code", F.col("source").cast("long") * 10**12 + F.col("num")).withColumn("name_key", text.normalize_text(F.col("business_name"))).withColumn("address_key", text.normalize_text(F.col("business_address")))


def _links(spark, d):
    return records.links_from_documents(spark, d)


def _truth_codes(spark, d):
    return _links(spark, d).select("s1_id", text.encode_target(F.col("target_id")).alias("target_code"))


def _code(df):
    return df.withColumn("target_code", F.col("source").cast("long") * 10**12 + F.col("num"))


def _sides(df):
    return df.where("source = 1"), df.where("source > 1")


def _weights(spark, d, branch="name_word", max_df=0.2):
    n = _norm(spark, d)
    return tfidf.weigh(n, tfidf.fit(n, branch, 2, max_df), branch)


def _weighed_sides(spark, d, branch="name_word", max_df=0.2):
    """Weights of the anchors and of the others. An entity has one source, so that each side is weighed alone."""
    n = _norm(spark, d)
    vocabulary = materialize(tfidf.fit(n, branch, 2, max_df), "vocabulary")
    return tuple(tfidf.weigh(side, vocabulary, branch) for side in _sides(n))


def _candidates(spark, d, links=None):
    """Written, as most queries read them more than once: the search and its shuffles run once and are gone before the rest begins. With links (s1_id, target_code), of the exact joins all pairs that are links instead of each anchor's first CAP: enough for what reads no other candidates than links."""
    def build():
        q, t = _sides(_norm(spark, d))
        wq, wt = _weighed_sides(spark, d)
        pairs = cnd.capped(cnd.exact(q, t, CAP), CAP) if links is None else cnd.exact_among(links.withColumnRenamed("s1_id", "query_id"), q, t)
        return cnd.union({"name_word": _code(tfidf.retrieve(wq, wt, K))}, pairs)

    return finish(build, "candidates")


def _labelled(spark, d, candidates=None):
    return cnd.label(candidates or _candidates(spark, d), _truth_codes(spark, d))


def _scored(spark, d, candidates=None):
    return _labelled(spark, d, candidates).select(F.col("query_id").alias("s1_id"), "target_code", "label", F.round(F.col("score_name_word") / Q, 3).alias("score"))


def _truth(spark, d):
    n = _links(spark, d).groupBy("s1_id").agg(F.count("*").alias("n_true"))
    return _records(spark, d).where("source = 1").select(F.col("entity_id").alias("s1_id"), "country").join(n, "s1_id", "left").na.fill(0, ["n_true"])


def _prepared(spark, d):
    return records.prepare(_records(spark, d).select(*records.COLUMNS))


def _gold(spark, d):
    p = _prepared(spark, d)
    side = lambda c, s: p.select(F.col("entity_id").alias(c), F.struct("*").alias(s))
    return _links(spark, d).join(side("s1_id", "left"), "s1_id").join(side("target_id", "right"), "target_id")


def _long(df, *cols):
    return df.select(*[F.col(c).cast("long").alias(c) if c in cols else F.col(c) for c in df.columns])


# Sources and text.


@query("SELECT * FROM records")
def records_adapter(spark, d):
    return _records(spark, d)


@query("SELECT source, country, count(*) AS n, count(*) FILTER (business_name = '') AS n_empty_name, count(*) FILTER (business_address = '') AS n_empty_address FROM records GROUP BY ALL")
def record_counts_by_source_country(spark, d):
    return _records(spark, d).groupBy("source", "country").agg(F.count("*").alias("n"), F.count_if(F.col("business_name") == "").alias("n_empty_name"), F.count_if(F.col("business_address") == "").alias("n_empty_address"))


@query("SELECT entity_id, name_key, address_key FROM norm")
def normalize_text(spark, d):
    return _norm(spark, d).select("entity_id", "name_key", "address_key")


@query("SELECT entity_id, strip_accents(name_key) AS folded FROM norm")
def fold_diacritics(spark, d):
    return _norm(spark, d).select("entity_id", text.fold_diacritics(F.col("name_key")).alias("folded"))


def _forms(spark, d):
    form = F.element_at(F.array(*map(F.lit, FORMS)), (F.col("num") % 5).cast("int") + 1)
    return _records(spark, d).select("entity_id", text.legal_name(text.normalize_text(F.concat("business_name", form))).alias("legal"))


@query(rf"SELECT entity_id, legal, CASE WHEN core = '' THEN legal ELSE core END AS core FROM (SELECT *, trim(regexp_replace(legal, '((^| )({_SUFFIX}))+$', '')) AS core FROM legal)")
def legal_names(spark, d):
    return _forms(spark, d).withColumn("core", text.core_name(F.col("legal")))


@query(rf"SELECT entity_id, array_to_string(list_transform(list_filter(string_split(legal, ' '), lambda t: t <> '' AND NOT list_contains({[*text.LEGAL_SUFFIXES, *text.ACRONYM_SKIPPED]}, t) AND regexp_matches(t, '^\p{{L}}')), lambda t: left(t, 1)), '') AS acronym FROM legal")
def acronyms(spark, d):
    return _forms(spark, d).select("entity_id", text.acronym(F.col("legal")).alias("acronym"))


@query("SELECT entity_id, array_to_string(an, ',') AS numbers FROM toks")
def number_tokens(spark, d):
    return _norm(spark, d).select("entity_id", F.array_join(text.number_tokens(F.col("address_key")), ",").alias("numbers"))


@query("SELECT entity_id, array_to_string(nt, ' ') AS tokens, CAST(len(nt) AS BIGINT) AS n FROM toks")
def token_sets(spark, d):
    t = F.array_sort(F.array_distinct(text.tokens(F.col("name_key"))))
    return _norm(spark, d).select("entity_id", F.array_join(t, " ").alias("tokens"), F.size(t).cast("long").alias("n"))


@query(r"SELECT entity_id, NOT regexp_matches(business_name, '[^\x00-\x7F]') AS ascii, regexp_matches(business_name, '[\p{Latin}]') AS latin FROM records")
def script_flags(spark, d):
    return _records(spark, d).select("entity_id", text.is_ascii(F.col("business_name")).alias("ascii"), F.array_contains(text.scripts(F.col("business_name")), "LATIN").alias("latin"))


@query(r"SELECT entity_id, trim(regexp_replace(regexp_replace(regexp_replace(address_key, '([0-9])(\p{L})', '\1 \2', 'g'), '(\p{L})([0-9])', '\1 \2', 'g'), '\s+', ' ', 'g')) AS split FROM norm")
def split_digits(spark, d):
    return _norm(spark, d).select("entity_id", text.split_digits(F.col("address_key")).alias("split"))


@query("SELECT target_id, target_code, target_id AS back FROM links")
def id_codec(spark, d):
    return _links(spark, d).select("target_id", text.encode_target(F.col("target_id")).alias("target_code")).withColumn("back", text.decode_target(F.col("target_code")))


@query("SELECT DISTINCT ON (entity_id) entity_id, code FROM norm WHERE code IN (SELECT code FROM norm WHERE source = 2 AND num % 50 = 0) OR name_key IN (SELECT name_key FROM norm WHERE source = 1 AND name_key <> '') OR address_key IN (SELECT address_key FROM norm WHERE source = 1 AND address_key <> '')")
def indexed_lookup(spark, d):
    p = _prepared(spark, d)
    anchors = p.where("source = 1")
    codes = p.where("source = 2 and num % 50 = 0").select("code")
    return records.lookup(p, codes, anchors.select(F.col("name.normalized").alias("key")), anchors.select(F.col("address.normalized").alias("key"))).select("entity_id", "code")


# Sampling and splits.

_H = "CAST(concat('0x', substr(sha256(concat('{}:', {})), 1, 15)) AS BIGINT)"
_FOLD = f"CASE WHEN h < {int(0.8 * sampling.RANGE)} THEN 'train' WHEN h < {int(sum((0.8, 0.1)) * sampling.RANGE)} THEN 'calibration' ELSE 'validation' END"
_SPLIT = f"sp AS (SELECT entity_id, source, {_FOLD} AS split FROM (SELECT entity_id, source, {_H.format('42', 'coalesce(s1_id, entity_id)')} AS h FROM records LEFT JOIN links ON target_id = entity_id))"


def _split(spark, d):
    return sampling.split(_records(spark, d), _links(spark, d))


@query(f", {_SPLIT} SELECT entity_id, split FROM sp")
def hash_split(spark, d):
    return _split(spark, d).select("entity_id", "split")


@query(f", {_SPLIT}, nl AS (SELECT s1_id, count(*) AS n FROM links GROUP BY ALL) SELECT split, count(*) FILTER (source = 1) AS n_anchors, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_links, count(*) FILTER (source = 1 AND n IS NULL) AS n_singletons, count(*) FILTER (source = 2) AS n_source2, count(*) FILTER (source = 3) AS n_source3, count(*) FILTER (source > 1 AND target_id IS NULL) AS n_unlinked FROM sp LEFT JOIN nl ON entity_id = s1_id LEFT JOIN (SELECT target_id FROM links) l ON entity_id = target_id GROUP BY split")
def split_stats(spark, d):
    return sampling.split_stats(_split(spark, d), _links(spark, d))


@query("SELECT entity_id FROM records WHERE source = 1 ORDER BY sha256(concat('42:', entity_id)), entity_id LIMIT 100")
def bottom_hash_sample(spark, d):
    return sampling.bottom_hash(_records(spark, d).where("source = 1"), 100).select("entity_id")


@query(f"SELECT entity_id, CAST({_H.format('graph-oof-42', 'entity_id')} % 3 AS INT) AS fold FROM records WHERE source = 1")
def oof_folds(spark, d):
    return _records(spark, d).where("source = 1").select("entity_id", sampling.out_of_fold(F.col("entity_id")).alias("fold"))


@query("SELECT s1_id, target_id FROM links")
def ground_truth_links(spark, d):
    return _links(spark, d)


@query("SELECT n_true AS n_links, count(*) AS anchors FROM truth GROUP BY ALL")
def match_count_histogram(spark, d):
    return _truth(spark, d).groupBy(F.col("n_true").alias("n_links")).agg(F.count("*").alias("anchors"))


@query("SELECT source, count(*) AS n, count(*) FILTER (target_id IS NULL) AS unlinked FROM records LEFT JOIN links ON entity_id = target_id WHERE source > 1 GROUP BY source")
def audit_unlinked(spark, d):
    r = _records(spark, d).where("source > 1").join(_links(spark, d).select(F.col("target_id").alias("entity_id"), F.lit(1).alias("l")), "entity_id", "left")
    return r.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("l").isNull()).alias("unlinked"))


# Retrieval.


@query("SELECT term, df, round(idf, 6) AS idf FROM wv")
def tfidf_word_vocab(spark, d):
    return tfidf.fit(_norm(spark, d), "name_word").withColumn("idf", F.round("idf", 6))


@query("SELECT entity_id, term, w FROM ww")
def tfidf_weights(spark, d):
    return _weights(spark, d).select("entity_id", "term", "w")


@query("SELECT query_id, source, rank, num, score FROM wtop")
def retrieve_name_word_topk(spark, d):
    q, t = _weighed_sides(spark, d)
    return _long(tfidf.retrieve(q, t, K).select("query_id", "source", "rank", "num", "score"), "rank")


def _char_sql(key: str) -> str:
    return rf""",
ct AS (SELECT entity_id, source, num, term, count(*) AS tf FROM (SELECT entity_id, source, num, unnest(flatten(list_transform(list_filter(string_split({key}, ' '), lambda w: w <> ''), lambda w: flatten(list_transform(range(3, least(5, length(w) + 2) + 1), lambda n: list_transform(range(1, length(w) + 4 - n), lambda i: substr(' ' || w || ' ', i, n))))))) AS term FROM norm) GROUP BY ALL),
cv AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM ct GROUP BY term), size WHERE df >= 2 AND df <= {CHAR_MAX_DF} * n),
cw AS (SELECT entity_id, source, num, term, idf, CAST(round(x / sqrt(sum(x * x) OVER (PARTITION BY entity_id)) * 1e6) AS BIGINT) AS w FROM (SELECT *, (1 + ln(tf)) * idf AS x FROM ct JOIN cv USING (term))),
cs AS (SELECT q.entity_id AS query_id, t.source, t.num, CAST(sum(q.w * t.w) AS BIGINT) AS score FROM cw q JOIN cw t USING (term) WHERE q.source = 1 AND t.source > 1 GROUP BY ALL)
SELECT query_id, source, rank, num, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) AS rank FROM cs WHERE score > 0) WHERE rank <= {K}"""


def _chars(spark, d, branch):
    q, t = _weighed_sides(spark, d, branch, CHAR_MAX_DF)
    return _long(tfidf.retrieve(q, t, K).select("query_id", "source", "rank", "num", "score"), "rank")


@query(_char_sql("name_key"))
def retrieve_name_char_topk(spark, d):
    return _chars(spark, d, "name_char")


@query(_char_sql("address_key"))
def retrieve_address_char_topk(spark, d):
    return _chars(spark, d, "address_char")


@query(_char_sql("name_key").split(",\ncw AS")[0] + " SELECT term, df, round(idf, 6) AS idf FROM cv")
def tfidf_char_vocab(spark, d):
    return tfidf.fit(_norm(spark, d), "name_char", 2, CHAR_MAX_DF).withColumn("idf", F.round("idf", 6))


_PRUNED = """,
pq AS (SELECT entity_id, term, w FROM ww WHERE source = 1 QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY idf DESC, w DESC, term) <= 3),
pw AS (SELECT entity_id, term, CAST(round(w / 1e6 / sqrt(sum((w / 1e6) * (w / 1e6)) OVER (PARTITION BY entity_id)) * 1e6) AS BIGINT) AS w FROM pq),
ps AS (SELECT q.entity_id AS query_id, t.entity_id AS target_id, t.source, t.num, CAST(sum(q.w * t.w) AS BIGINT) AS score FROM pw q JOIN ww t USING (term) WHERE t.source > 1 GROUP BY ALL)"""


@query(_PRUNED + f" SELECT query_id, source, rank, num, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) AS rank FROM ps) WHERE rank <= {K}")
def retrieve_pruned_topk(spark, d):
    q, t = _weighed_sides(spark, d)
    return _long(tfidf.retrieve(q, t, K, query_terms=3).select("query_id", "source", "rank", "num", "score"), "rank")


@query(_PRUNED + f""", pool AS (SELECT query_id, target_id FROM ps QUALIFY row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) <= 20)
SELECT query_id, source, rank, num, score FROM (SELECT w.*, row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) AS rank FROM wscore w JOIN pool USING (query_id, target_id)) WHERE rank <= {K}""")
def retrieve_rerank(spark, d):
    q, t = _weighed_sides(spark, d)
    return _long(tfidf.retrieve(q, t, K, query_terms=3, pool=20).select("query_id", "source", "rank", "num", "score"), "rank")


# Blocking and candidates.


@query("SELECT query_id, target_code FROM exact0 WHERE mask = 8")
def block_name_exact(spark, d):
    return cnd.name_exact(*_sides(_norm(spark, d)))


@query("SELECT query_id, target_code FROM exact0 WHERE mask = 16")
def block_number(spark, d):
    return cnd.number_block(*_sides(_norm(spark, d)))


@query("SELECT query_id, target_code, CAST(mask AS INT) AS mask FROM capped")
def exact_cap(spark, d):
    return cnd.capped(cnd.exact(*_sides(_norm(spark, d)), CAP), CAP)


@query(f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS eligible, CAST(coalesce(sum(least(n, {CAP})), 0) AS BIGINT) AS retained, CAST(coalesce(sum(greatest(n - {CAP}, 0)), 0) AS BIGINT) AS discarded, count(*) FILTER (n > {CAP}) AS overflow_queries FROM (SELECT count(*) AS n FROM exact1 GROUP BY query_id)")
def exact_overflow(spark, d):
    return cnd.overflow(cnd.exact(*_sides(_norm(spark, d))), CAP)


@query("SELECT query_id, target_code, CAST(mask AS BIGINT) AS mask, score_name_word, rank_name_word FROM cand")
def candidate_union(spark, d):
    return _long(_candidates(spark, d).select("query_id", "target_code", "mask", "score_name_word", "rank_name_word"), "mask", "rank_name_word")


@query("SELECT query_id, target_code, CAST(label AS BIGINT) AS label FROM lab")
def candidate_labels(spark, d):
    return _long(_labelled(spark, d).select("query_id", "target_code", "label"), "label")


@query("SELECT round(avg(n), 6) AS mean, max(n) AS max, " + ", ".join(f"round(quantile_cont(n, {p / 100}), 6) AS p{p}" for p in (50, 90, 95, 99)) + " FROM (SELECT a.query_id, count(c.target_code) AS n FROM anchors a LEFT JOIN cand c USING (query_id) GROUP BY ALL)")
def candidate_count_stats(spark, d):
    c = cnd.counts(_records(spark, d).where("source = 1"), _candidates(spark, d))
    return c.select(*[F.round(x, 6).alias(x) if x != "max" else F.col(x) for x in c.columns])


@query("SELECT unnest(['name_char', 'name_word', 'address_char', 'name_exact', 'number_block']) AS branch, unnest([0, count(*) FILTER (mask & 2 <> 0), 0, count(*) FILTER (mask & 8 <> 0), count(*) FILTER (mask & 16 <> 0)]) AS pairs FROM cand")
def pairs_by_branch(spark, d):
    return cnd.by_branch(_candidates(spark, d))


def _recall_sql(by: str = "") -> str:
    return f"SELECT {by + ', ' if by else ''}count(*) AS anchors, CAST(sum(n_true) AS BIGINT) AS links, CAST(sum(n_found) AS BIGINT) AS found, round(sum(n_found) / nullif(sum(n_true), 0), 6) AS link_recall, round(avg(CASE WHEN n_true > 0 THEN n_found / n_true END), 6) AS macro_recall, round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 1.25 * n_found / (n_found + 0.25 * n_true) END), 6) AS f05_ceiling FROM (SELECT *, CASE WHEN n_true = 0 THEN '0' WHEN n_true = 1 THEN '1' WHEN n_true <= 3 THEN '2-3' WHEN n_true <= 6 THEN '4-6' ELSE '7+' END AS bucket FROM perq){' GROUP BY ' + by if by else ''}"


def _recall(spark, d, *by):
    found = cnd.found(_records(spark, d).where("source = 1"), _truth_codes(spark, d), _candidates(spark, d)).withColumn("bucket", cnd.bucket(F.col("n_true")))
    out = cnd.recall(found, *by)
    return out.select(*[F.round(c, 6).alias(c) if c in ("link_recall", "macro_recall", "f05_ceiling") else F.col(c) for c in out.columns])


@query(_recall_sql())
def recall_overall(spark, d):
    return _recall(spark, d)


@query(_recall_sql("country"))
def recall_by_country(spark, d):
    return _recall(spark, d, "country")


@query(_recall_sql("bucket"))
def recall_by_bucket(spark, d):
    return _recall(spark, d, "bucket")


@query("SELECT CAST(l.target_code // 1000000000000 AS INT) AS source, count(*) AS links, count(c.target_code) AS found FROM links l LEFT JOIN cand c ON c.query_id = l.s1_id AND c.target_code = l.target_code GROUP BY 1", WHOLE)
def recall_by_source(spark, d):
    truth = _truth_codes(spark, d)
    return cnd.recall_by_source(truth, _candidates(spark, d, truth))


@query(""", h AS (SELECT coalesce(mask, 0) AS mask FROM links l LEFT JOIN cand c ON c.query_id = l.s1_id AND c.target_code = l.target_code), b AS (SELECT unnest([0, 1, 2, 3, 4]) AS i, unnest(['name_char', 'name_word', 'address_char', 'name_exact', 'number_block']) AS branch),
n AS (SELECT i, branch, count(*) AS links, count(*) FILTER (mask & (1 << i) <> 0) AS standalone, count(*) FILTER (mask & ((2 << i) - 1) = (1 << i)) AS incremental FROM h, b GROUP BY ALL)
SELECT branch, links, standalone, incremental, CAST(sum(incremental) OVER (ORDER BY i) AS BIGINT) AS cumulative FROM n""")
def recall_incremental(spark, d):
    return cnd.branch_recall(_truth_codes(spark, d), _candidates(spark, d)).drop("branch_no")


# Pair features, on true links.

_EQ = "CAST({a} <> '' AND {a} = {b} AS INT)"
_RATIO = "round(CASE WHEN {a} = 0 OR {b} = 0 THEN 0 ELSE least({a}, {b}) / greatest({a}, {b}) END, 6)"
_INTER = "len(list_intersect({a}, {b}))"
_UNION = "len(list_distinct(list_concat({a}, {b})))"


def _text_sql(f: str) -> str:
    k, t = {"name": ("n", "nt"), "address": ("a", "at")}[f]
    a, b, x, y = f"l{k}", f"r{k}", f"l{t}", f"r{t}"
    return ", ".join([
        f"{_EQ.format(a=a, b=b)} AS {f}_exact", f"round(CASE WHEN {_UNION.format(a=x, b=y)} = 0 THEN 0 ELSE {_INTER.format(a=x, b=y)} / {_UNION.format(a=x, b=y)} END, 6) AS {f}_token_jaccard",
        f"round(CASE WHEN least(len({x}), len({y})) = 0 THEN 0 ELSE {_INTER.format(a=x, b=y)} / least(len({x}), len({y})) END, 6) AS {f}_token_containment", f"CAST({_INTER.format(a=x, b=y)} AS BIGINT) AS {f}_token_overlap",
        f"{_RATIO.format(a=f'length({a})', b=f'length({b})')} AS {f}_length_ratio", f"{_RATIO.format(a=f'len({x})', b=f'len({y})')} AS {f}_token_count_ratio",
        f"CAST({a} = '' AS INT) AS {f}_left_missing", f"CAST({b} = '' AS INT) AS {f}_right_missing",
    ])


@query(f"SELECT s1_id, target_id, {_text_sql('name')}, {_text_sql('address')} FROM gold")
def pair_text_features(spark, d):
    g = _gold(spark, d)
    names = ("exact", "token_jaccard", "token_containment", "token_overlap", "length_ratio", "token_count_ratio", "left_missing", "right_missing")
    out = []
    for f in ("name", "address"):
        t = features.text_features(F.col("left")[f], F.col("right")[f])
        out += [(F.round(t[n], 6) if "ratio" in n or n.startswith("token_") and n != "token_overlap" else t[n].cast("long" if n == "token_overlap" else "int")).alias(f"{f}_{n}") for n in names]
    return g.select("s1_id", "target_id", *out)


@query(r"SELECT s1_id, target_id, round(1 - levenshtein(ln, rn) / greatest(length(ln), length(rn)), 6) AS name_edit FROM gold WHERE ln <> '' AND rn <> '' AND NOT regexp_matches(ln || rn, '[^\x00-\x7F]')")
def pair_edit_similarity(spark, d):
    a, b = F.col("left")["name"]["normalized"], F.col("right")["name"]["normalized"]
    return _gold(spark, d).where((a != "") & (b != "") & text.is_ascii(F.concat(a, b))).select("s1_id", "target_id", F.round(sim.edit_similarity(a, b), 6).alias("name_edit"))


@query(r"SELECT s1_id, target_id, round(jaro_winkler_similarity(ln, rn), 6) AS name_jaro FROM gold WHERE ln <> '' AND rn <> '' AND NOT regexp_matches(ln || rn, '[^\x00-\x7F]')")
def pair_jaro_winkler(spark, d):
    a, b = F.col("left")["name"]["normalized"], F.col("right")["name"]["normalized"]
    return _gold(spark, d).where((a != "") & (b != "") & text.is_ascii(F.concat(a, b))).select("s1_id", "target_id", F.round(sim.jaro(a, b), 6).alias("name_jaro"))


@query()
def pair_fuzz_ratios(spark, d):
    a, b = F.col("left")["name"]["normalized"], F.col("right")["name"]["normalized"]
    return _gold(spark, d).select("s1_id", "target_id", sim.indel(a, b).alias("ratio"), sim.partial(a, b).alias("partial"), sim.token_sort(a, b).alias("token_sort"), sim.token_set(a, b).alias("token_set"))


_BOTH = "len(lan) > 0 AND len(ran) > 0"


@query(f"SELECT s1_id, target_id, CAST({_BOTH} AS INT) AS both_present, CAST({_BOTH} AND lan = ran AS INT) AS equal, CAST({_INTER.format(a='lan', b='ran')} AS BIGINT) AS overlap, CAST({_BOTH} AND {_INTER.format(a='lan', b='ran')} = 0 AS INT) AS conflict, CAST({_BOTH} AND lan <> ran AS INT) AS disagree, round(CASE WHEN {_UNION.format(a='lan', b='ran')} = 0 THEN 0 ELSE {_INTER.format(a='lan', b='ran')} / {_UNION.format(a='lan', b='ran')} END, 6) AS jaccard FROM gold")
def pair_number_features(spark, d):
    n = sim.numbers(F.col("left")["address"]["numbers"], F.col("right")["address"]["numbers"])
    n |= {"jaccard": F.round(n["jaccard"], 6), "overlap": n["overlap"].cast("long")}
    return _gold(spark, d).select("s1_id", "target_id", *[v.alias(k) for k, v in n.items()])


@query("SELECT s1_id, target_id, CAST(ln <> '' AND ln = rn AS INT) AS name_legal_exact, CAST(lc <> '' AND lc = rc AS INT) AS country_equal, CAST(lc <> '' AND rc <> '' AND lc <> rc AS INT) AS country_conflict FROM gold")
def pair_legal_country_features(spark, d):
    every = features.record_features(F.col("left"), F.col("right"))
    return _gold(spark, d).select("s1_id", "target_id", *[every[n].alias(n) for n in ("name_legal_exact", "country_equal", "country_conflict")])


@query("SELECT query_id, target_code, CAST(mask & 8 <> 0 AS INT) AS name_exact, CAST(mask & 2 <> 0 AS INT) AS name_token, round(CASE WHEN rank_name_word < 1 THEN 0 ELSE 1 / rank_name_word END, 6) AS rank_reciprocal, round(score_name_word / 1e12, 6) AS score, round(ln(1 + count(*) OVER (PARTITION BY query_id)), 6) AS count_log FROM cand")
def pair_retrieval_features(spark, d):
    every = features.retrieval_features(Q)
    c = _candidates(spark, d).withColumn("candidate_count", F.count("*").over(Window.partitionBy("query_id")))
    return c.select("query_id", "target_code", every["retrieval_name_exact"].alias("name_exact"), every["retrieval_name_token"].alias("name_token"), F.round(every["retrieval_rank_reciprocal"], 6).alias("rank_reciprocal"), F.round(every["retrieval_score"], 6).alias("score"), F.round(every["retrieval_candidate_count_log1p"], 6).alias("count_log"))


@query("SELECT s1_id AS query_id, l.target_id, round(least(1.0, coalesce(score, 0) / 1e12), 6) AS cosine FROM links l LEFT JOIN wscore w ON l.s1_id = w.query_id AND l.target_id = w.target_id")
def pair_actual_cosine(spark, d):
    q, t = _weighed_sides(spark, d)
    return tfidf.cosine(_links(spark, d).withColumnRenamed("s1_id", "query_id"), q, t, "cosine").withColumn("cosine", F.round("cosine", 6))


@query()
def pair_base_features(spark, d):
    p = _prepared(spark, d)
    # each step is written, so that the shuffles of one are gone before the next
    pairs = materialize(_labelled(spark, d).withColumn("target_id", text.decode_target(F.col("target_code"))), "pairs")
    for c in features.COSINES:
        branch = next(b for b in cnd.SPARSE if b in c)
        before, pairs = pairs, materialize(tfidf.cosine(pairs, *_weighed_sides(spark, d, branch, CHAR_MAX_DF if "char" in branch else 0.2), c), "pairs")
        discard(before)
    pairs = pairs.drop("target_id")
    return features.base(features.paired(pairs, p.where("source = 1"), p.where("source > 1")), Q)


@query()
def pair_advanced_features(spark, d):
    v = features.views(_prepared(spark, d))
    return features.advanced(_labelled(spark, d).where("label = 1"), v, v)


@query(r""", v AS (SELECT entity_id, list_transform(regexp_extract_all(regexp_replace(regexp_replace(address_key, '([0-9])(\p{L})', '\1 \2', 'g'), '(\p{L})([0-9])', '\1 \2', 'g'), '\b[0-9]+\b'), lambda x: regexp_replace(x, '^0+([0-9])', '\1')) AS ns FROM norm)
SELECT s1_id, target_id, CAST(len(l.ns) > 0 AND len(r.ns) > 0 AND l.ns[1] = r.ns[1] AS DOUBLE) AS first_number_equal, CAST(len(l.ns) > 0 AND len(r.ns) > 0 AND l.ns[-1] = r.ns[-1] AS DOUBLE) AS last_number_equal, round(CASE WHEN len(l.ns) = 0 OR len(r.ns) = 0 THEN 0 ELSE least(len(l.ns), len(r.ns)) / greatest(len(l.ns), len(r.ns)) END, 6) AS number_count_ratio FROM links JOIN v l ON s1_id = l.entity_id JOIN v r ON target_id = r.entity_id""")
def advanced_number_features(spark, d):
    v = _norm(spark, d).select("entity_id", text.alternate_view(F.col("address_key"))["numbers"].alias("ns"))
    p = _links(spark, d).join(v.toDF("s1_id", "x"), "s1_id").join(v.toDF("target_id", "y"), "target_id")
    n = features.number_features(F.col("x"), F.col("y"))
    return p.select("s1_id", "target_id", n["first_number_equal"].alias("first_number_equal"), n["last_number_equal"].alias("last_number_equal"), F.round(n["number_count_ratio"], 6).alias("number_count_ratio"))


# Context, graph, translation.


@query(f""", kn AS (SELECT entity_id, code, source, replace(replace(strip_accents(name_key), 'æ', 'ae'), 'œ', 'oe') AS k FROM norm), oc AS (SELECT k, count(*) AS n, list(entity_id) AS ids FROM kn WHERE source = 1 AND k <> '' GROUP BY k)
SELECT query_id, target_code, CAST(CASE WHEN n IS NULL OR n > {context.MOST} THEN 0 ELSE n - CAST(list_contains(ids, query_id) AS INT) END AS BIGINT) AS others, CAST(coalesce(n, 0) > {context.MOST} AS INT) AS overflow FROM cand JOIN kn ON target_code = code LEFT JOIN oc USING (k)""")
def reference_context_counts(spark, d):
    k = context.keys(_prepared(spark, d)).withColumn("source", F.substring("entity_id", 2, 1).cast("int"))
    out = context.counts(_candidates(spark, d), *_sides(k))
    return out.select("query_id", "target_code", F.col("legal_others").cast("long").alias("others"), F.col("legal_overflow").alias("overflow"))


@query()
def reference_context_similarity(spark, d):
    k = context.keys(_prepared(spark, d)).withColumn("source", F.substring("entity_id", 2, 1).cast("int"))
    candidates = _candidates(spark, d, _truth_codes(spark, d))
    return context.features(_labelled(spark, d, candidates).where("label = 1"), *_sides(k))


_TRUSTED = f""", tr AS (SELECT query_id, target_code AS sup, score_name_word / 1e12 AS ss, row_number() OVER (PARTITION BY query_id ORDER BY score_name_word DESC, target_code) AS k FROM cand WHERE round(score_name_word / 1e12, 6) >= {graph.TRUSTED} QUALIFY k <= {graph.KEPT}),
us AS (SELECT c.query_id, c.target_code, round(c.score_name_word / 1e12, 6) AS score, sup, round(ss, 6) AS ss FROM cand c JOIN tr ON c.query_id = tr.query_id AND sup <> c.target_code QUALIFY row_number() OVER (PARTITION BY c.query_id, c.target_code ORDER BY k) <= {graph.USED})"""


def _graph_scored(spark, d):
    return _candidates(spark, d).select("query_id", "target_code", F.round(F.least(F.lit(1.0), F.col("score_name_word") / Q), 6).alias("score"))


@query(_TRUSTED.replace("score_name_word / 1e12", "least(1.0, score_name_word / 1e12)").replace("c.least(1.0, score_name_word / 1e12)", "least(1.0, c.score_name_word / 1e12)").replace("ORDER BY score_name_word DESC", "ORDER BY round(least(1.0, score_name_word / 1e12), 6) DESC") + " SELECT c.query_id, c.target_code, count(sup) AS support_count, count(*) FILTER (sup // 1000000000000 = 2) AS source2_support_count, round(coalesce(max(ss), 0), 6) AS max_support_score, round(coalesce(avg(ss), 0), 6) AS mean_support_score FROM cand c LEFT JOIN us ON c.query_id = us.query_id AND c.target_code = us.target_code GROUP BY c.query_id, c.target_code")
def graph_context(spark, d):
    c = graph.context(_graph_scored(spark, d))
    return c.select("query_id", "target_code", "support_count", "source2_support_count", F.round("max_support_score", 6).alias("max_support_score"), F.round("mean_support_score", 6).alias("mean_support_score"))


@query()
def graph_support_max(spark, d):
    return graph.comparisons(_graph_scored(spark, d), _prepared(spark, d).where("source > 1"))


@query()
def translation_em(spark, d):
    """Names spelt in another alphabet by rule stand in for the foreign names, which the documents don't have."""
    greek = F.translate("business_name", "abgdezhiklmnxoprstyfw", "αβγδεζηικλμνξοπρστυφω")
    pairs = _records(spark, d).select(F.col("business_name").alias("left_name"), greek.alias("right_name"), F.col("entity_id").alias("group_id"))
    return translate.lexicon(translate.sentences(pairs), rounds=3)


# Metrics.


@query("SELECT s1_id, n_true, tp, predicted, round(f05, 6) AS f05 FROM entf")
def entity_f05(spark, d):
    e = metrics.per_entity(_scored(spark, d), _truth(spark, d), 0.5)
    return e.select("s1_id", "n_true", F.col("tp").cast("long").alias("tp"), F.col("predicted").cast("long").alias("predicted"), F.round("f05", 6).alias("f05"))


@query("SELECT round(avg(f05), 6) AS macro_f0_5, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(predicted - tp) AS BIGINT) AS fp, CAST(sum(n_true - tp) AS BIGINT) AS fn, count(*) FILTER (n_true = 0) AS singleton_count, count(*) FILTER (n_true = 0 AND predicted = 0) AS correct_singletons, round(CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(tp) / sum(predicted) END, 6) AS micro_precision, round(CASE WHEN sum(n_true) = 0 THEN 0 ELSE sum(tp) / sum(n_true) END, 6) AS micro_recall FROM entf")
def metric_summary(spark, d):
    s = metrics.summary(metrics.per_entity(_scored(spark, d), _truth(spark, d), 0.5))
    r = lambda c: F.round(c, 6).alias(c)
    return s.select(r("macro_f0_5"), F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"), F.col("fn").cast("long").alias("fn"), "singleton_count", "correct_singletons", r("micro_precision"), r("micro_recall"))


_GRID = [round(0.05 * i, 2) for i in range(21)]
_SWEEP = f""", g AS (SELECT unnest({_GRID}) AS threshold), c AS (SELECT threshold, t.s1_id, n_true, coalesce(sum(label) FILTER (score >= threshold), 0) AS tp, count(*) FILTER (score >= threshold) AS predicted FROM g CROSS JOIN truth t LEFT JOIN scored p ON t.s1_id = p.s1_id GROUP BY ALL),
sw AS (SELECT CAST(threshold AS DOUBLE) AS threshold, avg(CASE WHEN predicted = 0 AND n_true = 0 THEN 1.0 ELSE 1.25 * tp / (predicted + 0.25 * n_true) END) AS f, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(predicted) AS BIGINT) AS predicted FROM c GROUP BY threshold)"""


@query(_SWEEP + " SELECT threshold, round(f, 6) AS macro_f0_5, tp, predicted FROM sw")
def threshold_sweep(spark, d):
    return metrics.sweep(_scored(spark, d), _truth(spark, d), _GRID).withColumn("macro_f0_5", F.round("macro_f0_5", 6))


@query(_SWEEP + " SELECT threshold, round(f, 6) AS macro_f0_5, tp, predicted FROM sw ORDER BY round(f, 12) DESC, threshold DESC LIMIT 1")
def select_threshold(spark, d):
    return metrics.select(metrics.sweep(_scored(spark, d), _truth(spark, d), _GRID)).withColumn("macro_f0_5", F.round("macro_f0_5", 6))


# Results and validation.


def _result_sql(where: str, name: str) -> str:
    return f"SELECT a.query_id AS source1_entity_id, coalesce(string_agg('S' || p.target_code // 1000000000000 || '-' || p.target_code % 1000000000000, ',' ORDER BY p.target_code), '') AS {name} FROM anchors a LEFT JOIN (SELECT * FROM scored WHERE {where}) p ON a.query_id = p.s1_id GROUP BY a.query_id"


@query(_result_sql("score >= 0.5", "matched_entity_ids"))
def matching_results(spark, d):
    return sinks.grouped(_records(spark, d).where("source = 1"), _scored(spark, d).where("score >= 0.5"), "matched_entity_ids").drop("num")


@query(_result_sql("true", "candidate_entity_ids"))
def candidate_pairs_out(spark, d):
    return sinks.grouped(_records(spark, d).where("source = 1"), _scored(spark, d), "candidate_entity_ids").drop("num")


#: Results with planted faults: anchors whose number ends in 3 are missing, those in 5 list an unknown target, those in 7 match what is no candidate.
@query("""SELECT file, kind, count(*) AS n FROM (
SELECT 'matching_results' AS file, 'missing_anchor' AS kind FROM records WHERE source = 1 AND num % 10 = 3 UNION ALL
SELECT 'candidate_pairs', 'unknown_target' FROM records WHERE source = 1 AND num % 10 = 5 UNION ALL
SELECT 'matching_results', 'not_a_candidate' FROM records r WHERE source = 1 AND num % 10 = 7 UNION ALL
SELECT DISTINCT 'matching_results', 'missing_by_country ' || country FROM records WHERE source = 1 AND num % 10 = 3) GROUP BY ALL""")
def validation_issues(spark, d):
    r = _records(spark, d)
    a, digit = r.where("source = 1"), F.col("num") % 10
    known = r.where("source = 2").agg(F.min(F.struct("num", "entity_id")).alias("x")).select(F.col("x.entity_id").alias("some"))
    candidates = a.select(F.col("entity_id").alias("id"), F.when(digit == 5, F.array(F.lit("S3-999999999"))).otherwise(F.array().cast("array<string>")).alias("targets"))
    matches = a.where(digit != 3).join(F.broadcast(known)).select(F.col("entity_id").alias("id"), F.when(digit == 7, F.array("some")).otherwise(F.array().cast("array<string>")).alias("targets"))
    issues = validate.strict(matches, candidates, a.select("entity_id", "country"), r.where("source > 1").select("entity_id"))
    kind = F.when(F.col("kind") == "missing_by_country", F.concat("kind", F.lit(" "), F.split("detail", " ")[0])).otherwise(F.col("kind"))
    return issues.select("file", kind.alias("kind")).groupBy("file", "kind").agg(F.count("*").alias("n"))


# Diagnostics.


@query(r"""SELECT unnest(['all', 'name_normalized_exact', 'name_raw_exact', 'name_no_shared_tokens', 'address_numbers_conflict', 'country_conflict', 'name_non_ascii']) AS category, unnest([count(*), count(*) FILTER (ln <> '' AND ln = rn), count(*) FILTER (lbn <> '' AND lbn = rbn), count(*) FILTER (ln <> '' AND rn <> '' AND len(list_intersect(lnt, rnt)) = 0), count(*) FILTER (len(lan) > 0 AND len(ran) > 0 AND len(list_intersect(lan, ran)) = 0), count(*) FILTER (lc <> '' AND rc <> '' AND lc <> rc), count(*) FILTER (regexp_matches(lbn, '[^\x00-\x7F]') OR regexp_matches(rbn, '[^\x00-\x7F]'))]) AS n FROM gold""")
def oracle_categories(spark, d):
    kept = ("all", "name_normalized_exact", "name_raw_exact", "name_no_shared_tokens", "address_numbers_conflict", "country_conflict", "name_non_ascii")
    return diagnostics.categories(_gold(spark, d)).where(F.col("category").isin(*kept))


@query("SELECT round(avg(v), 6) AS mean, " + ", ".join(f"round(quantile_cont(v, {q / 100}), 6) AS p{q}" for q in diagnostics.QUANTILES) + f" FROM (SELECT CASE WHEN {_UNION.format(a='lat', b='rat')} = 0 THEN 0.0 ELSE {_INTER.format(a='lat', b='rat')} / {_UNION.format(a='lat', b='rat')} END AS v FROM gold)")
def similarity_quantiles(spark, d):
    j = sim.jaccard(F.col("left")["address"]["tokens"], F.col("right")["address"]["tokens"])
    q = diagnostics.quantiles(_gold(spark, d).select(j.alias("v")), "v")
    return q.select(*[F.round(c, 6).alias(c) for c in q.columns])


_J = "round(CASE WHEN " + _UNION.format(a="{x}", b="{y}") + " = 0 THEN 0.0 ELSE " + _INTER.format(a="{x}", b="{y}") + " / " + _UNION.format(a="{x}", b="{y}") + " END, 6)"


@query(f"SELECT s1_id, target_id, round(1 - (0.6 * nj + 0.4 * aj), 6) AS hardness FROM (SELECT s1_id, target_id, {_J.format(x='lnt', y='rnt')} AS nj, {_J.format(x='lat', y='rat')} AS aj FROM gold) ORDER BY round(1 - (0.6 * nj + 0.4 * aj), 6) DESC, s1_id, target_id LIMIT 50")
def hard_examples(spark, d):
    j = lambda f: F.round(sim.jaccard(F.col("left")[f]["tokens"], F.col("right")[f]["tokens"]), 6)
    p = _gold(spark, d).select("s1_id", "target_id", j("name").alias("nj"), j("address").alias("aj"))
    h = p.withColumn("hardness", F.round(1 - (0.6 * F.col("nj") + 0.4 * F.col("aj")), 6))
    return h.orderBy(F.desc("hardness"), "s1_id", "target_id").limit(50).select("s1_id", "target_id", "hardness")


def _entities(spark, d):
    c = _candidates(spark, d)
    e = metrics.per_entity(_scored(spark, d, c), _truth(spark, d), 0.5)
    r = cnd.found(_records(spark, d).where("source = 1"), _truth_codes(spark, d), c).select(F.col("query_id").alias("s1_id"), F.col("n_found").alias("retrieved"))
    a = _records(spark, d).select(F.col("entity_id").alias("s1_id"), (~text.is_ascii(F.concat("business_name", "business_address"))).alias("non_ascii"))
    return e.join(r, "s1_id").join(a, "s1_id")


@query(r""", e AS (SELECT entf.*, n_found, regexp_matches(business_name || business_address, '[^\x00-\x7F]') AS na FROM entf JOIN perq ON s1_id = query_id JOIN anchors USING (query_id)),
g AS (SELECT *, unnest(list_filter(['overall', 'country:' || country, CASE WHEN n_true = 0 THEN 'singleton' END, CASE WHEN n_true > 1 THEN 'multiple' END, CASE WHEN na THEN 'non_ascii' END], lambda x: x IS NOT NULL)) AS grp FROM (SELECT s1_id, entf_country AS country, n_true, tp, predicted, f05, n_found, na FROM (SELECT s1_id, country AS entf_country, n_true, tp, predicted, f05, n_found, na FROM e)))
SELECT grp AS "group", count(*) AS entities, round(avg(f05), 6) AS macro_f0_5, CAST(sum(predicted - tp) AS BIGINT) AS fp, CAST(sum(n_true - tp) AS BIGINT) AS fn, CAST(sum(n_true - n_found) AS BIGINT) AS unretrieved FROM g GROUP BY grp""".replace("SELECT entf.*, n_found", "SELECT entf.s1_id, entf.country, entf.n_true, entf.tp, entf.predicted, entf.f05, n_found"))
def error_groups(spark, d):
    return diagnostics.error_groups(_entities(spark, d)).withColumn("macro_f0_5", F.round("macro_f0_5", 6))


@query("SELECT s1_id, round(f05, 6) AS f05 FROM entf ORDER BY round(f05, 9), s1_id LIMIT 50")
def worst_entities(spark, d):
    e = metrics.per_entity(_scored(spark, d), _truth(spark, d), 0.5)
    return diagnostics.worst(e.withColumn("f05", F.round("f05", 9))).select("s1_id", F.round("f05", 6).alias("f05"))


@query()
def bootstrap_interval(spark, d):
    return diagnostics.bootstrap(metrics.per_entity(_scored(spark, d), _truth(spark, d), 0.5), 100)


@query("SELECT s AS stratum, count(*) AS candidate_pairs, count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS retrieved_fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM (SELECT *, unnest(list_filter(['all', CASE WHEN target_code // 1000000000000 = 2 THEN 'source2' END, CASE WHEN target_code // 1000000000000 = 3 THEN 'source3' END], lambda x: x IS NOT NULL)) AS s FROM scored) GROUP BY s")
def confusion_strata(spark, d):
    source = F.floor(F.col("target_code") / 10**12)
    return diagnostics.strata(_scored(spark, d).withColumn("src", source).withColumn("score", F.col("score")), {"all": F.lit(True), "source2": F.floor(F.col("target_code") / 10**12) == 2, "source3": F.floor(F.col("target_code") / 10**12) == 3}, 0.5).drop("precision", "recall")


@query("SELECT CAST(bin AS INT) AS bin, count(*) AS pairs, CAST(sum(label) AS BIGINT) AS positives FROM (SELECT label, " + "CASE " + " ".join(f"WHEN score >= {a} AND score < {b} THEN {i}" for i, (a, b) in enumerate(zip(diagnostics.SCORE_EDGES, diagnostics.SCORE_EDGES[1:], strict=False))) + " END AS bin FROM scored) WHERE bin IS NOT NULL GROUP BY bin")
def score_bins(spark, d):
    return _long(diagnostics.bins(_scored(spark, d), "score"), "positives")


@query("(SELECT s1_id, target_code, score, 'fp' AS kind FROM scored WHERE score >= 0.5 AND label = 0 ORDER BY score DESC, s1_id, target_code LIMIT 30) UNION ALL (SELECT s1_id, target_code, score, 'fn' FROM scored WHERE score < 0.5 AND label = 1 ORDER BY score, s1_id, target_code LIMIT 30)")
def error_examples(spark, d):
    return diagnostics.examples(_scored(spark, d), 0.5).drop("label")


@query(_PRUNED + f""", pt AS (SELECT query_id, source * 1000000000000 + num AS target_code FROM ps QUALIFY row_number() OVER (PARTITION BY query_id, source ORDER BY score DESC, num) <= {K})
SELECT s1_id AS query_id, l.target_code, CASE WHEN w.query_id IS NOT NULL THEN 'lost' ELSE 'gained' END AS change FROM links l LEFT JOIN wtop w ON w.query_id = s1_id AND w.target_code = l.target_code LEFT JOIN pt ON pt.query_id = s1_id AND pt.target_code = l.target_code WHERE (w.query_id IS NULL) <> (pt.query_id IS NULL)""")
def retrieval_diff(spark, d):
    q, t = _weighed_sides(spark, d)
    truth = _truth_codes(spark, d).withColumnRenamed("s1_id", "query_id")
    return diagnostics.retrieval_diff(truth, _code(tfidf.retrieve(q, t, K)), _code(tfidf.retrieve(q, t, K, query_terms=3)))
