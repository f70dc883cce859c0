"""Each operator over small tables: nulls, empty and long texts, repeated rows, empty tables, extra columns."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from kinweave.llm import bpe, decontam, htmltext, licenses, ngram_join, pii, quality, suffix_dedup, urlfilter, warc
from kinweave.llm.common import fresh_path
from kinweave.llm.queries import vocabulary

DOCS = "doc_id long, text string, source string, key string, host string, n long, lang string, n_chars long"
PAGES = "page_id long, url string, html string, digest string, text string"


def docs(spark, *rows):
    """Rows of (doc_id, text) or (doc_id, text, source), with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "s", "k", "h", 1, "en", len(r[1] or "")) for r in rows], DOCS)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))


def test_bpe(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 60)
    monkeypatch.setattr(bpe, "OVERLAP", 20)
    v, rng = vocabulary(spark), random.Random(1)
    table = [(1, None), (2, ""), (3, "  \n\n x"), (4, prose(rng, 300) + "\n\n" + "z" * 200), (4, prose(rng, 40)), (None, "é" * 150), (6, "don't  stop 123"), (6, "don't  stop 123")]
    e, _, _ = v.codec()
    want = []
    for i, t in table:
        ids = e.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    d = docs(spark, *table)
    assert rows(bpe.digests(d, v), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    enc = bpe.encode(d.where("doc_id = 6 or doc_id = 3"), v)
    assert sorted(bytes(r.bytes).decode() for r in bpe.decode(enc, v).collect()) == sorted(["  \n\n x", "don't  stop 123", "don't  stop 123"])
    assert bpe.digests(d.limit(0), v).collect() == []
    assert isinstance(e, tiktoken.Encoding) and v.pattern == public_tokenizers.PATTERN


def test_warc(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    table = [(1, None), (2, ""), (3, "a"), (4, f"x{inner}{inner}y"), (5, "a"), (6, "WARC/1.0\r\n"), (7, "é" * 3000 + "\r\n\r\n"), (8, f"x{inner}{inner}y"), (9, "WARC/1.0\r\n" * 50)]
    d = spark.createDataFrame([(i, f"http://e/{i}\r\nX: y", h, "d", "t") for i, h in table], PAGES).repartition(2)
    want, last = [], {}
    for i, h in table:
        last[h or ""] = i
    for i, h in table:
        b = (h or "").encode()
        first = last[h or ""]
        want.append((i, len(b), warc.digest_of(b), "response" if i == first else "revisit", None if i == first else first))
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(warc.round_trip(d), *cols) == sorted(want, key=repr)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:  # splits anywhere, also inside payloads and magics
        assert rows(warc.round_trip(d.coalesce(1)), *cols) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r for r in rows(warc.round_trip(d, 5), *cols) if r[0] == 3] == [(3, 1, warc.digest_of(b"a"), "response", None)]
    assert warc.round_trip(d.limit(0)).collect() == []
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_warc_with_hostile_payloads_and_null_ids(spark):
    big = "".join(f"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\nabc\r\n\r\n" for n in ("9" * 23, "9223372036854775807", "9223372036854775000", "3"))
    table = [(1, big), (2, big), (None, big), (None, "x"), (None, "x"), (3, "y" * 300_000 + big), (4, "plain")]
    d = spark.createDataFrame([(i, None, h, "d", "t") for i, h in table], PAGES)
    got = rows(warc.round_trip(d), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = [(i, len(h.encode()), warc.digest_of(h.encode()), "revisit" if i == 1 else "response", 2 if i == 1 else None) for i, h in table]
    assert got == sorted(want, key=repr)


def test_decontamination(spark):
    rng = random.Random(2)
    q, a = prose(rng, 30), prose(rng, 8)
    items = spark.createDataFrame([(1, f"{q}. {a}."), (2, None), (3, "")], "item_id long, text string")
    d = docs(spark, (1, f"{prose(rng, 90)} {q}. {a}. {prose(rng, 70)}"), (2, prose(rng, 200)), (3, None), (4, ""), (5, q), (6, f"{q} {a}"), (6, f"{q} {a}"))
    assert rows(decontam.scan(d, items), "doc_id", "item_id") == [(1, 1), (6, 1)]
    assert rows(decontam.clean(d, items), "doc_id") == [(2,), (3,), (4,), (5,)] and decontam.clean(d, items).columns == d.columns
    split = spark.createDataFrame([(1, q, a)], "item_id long, question string, answer string")
    assert rows(decontam.scan(d, split), "doc_id") == [(1,), (6,)]
    assert decontam.scan(d, items.limit(0)).collect() == [] and decontam.scan(d.limit(0), items).collect() == []


def test_decontamination_of_shards_is_brute_force(spark, monkeypatch):
    rng = random.Random(16)
    vocabulary = prose(rng, 300).split()
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    texts = [f"{say(rng.randint(8, 120))}. {say(rng.randint(1, 9))}." for _ in range(60)]
    table = [(k % 50, t) for k, t in enumerate(texts)] + [(None, texts[3]), (7, None), (8, "")]
    found = []
    for k in range(120):
        words = f"{say(rng.randint(0, 300))} {texts[rng.randrange(60)]} {say(rng.randint(0, 200))}".split()
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = "edited"
        found.append((k, " ".join(words)))
    found.append((200, f"{say(100_000)} {texts[5]} {say(1000)}"))
    want = set()
    for d, t in found:
        words = decontam.words_of(t)
        for i, x in table:
            q, a = decontam.question_answer(x)
            for at in [*range(0, max(1, len(words) - decontam.HALF), decontam.HALF)] if d < 200 else [100_000 // 64 * 64 - 64, 100_000 // 64 * 64]:
                wide = len(q + a) if len(q + a) > decontam.HALF else 0
                m = decontam.marked(q + a, words[max(0, at - wide) : at + 2 * decontam.HALF + wide])
                if q and 100 * m[: len(q)].sum() // len(q) >= decontam.QUESTION_PERCENT and (not a or 100 * m[len(q) :].sum() // len(a) >= decontam.ANSWER_PERCENT):
                    want.add((d, i))
    items, d = spark.createDataFrame(table, "item_id long, text string"), docs(spark, *found)
    assert len(want) > 100 and set(rows(decontam.scan(d, items), "doc_id", "item_id")) == want
    monkeypatch.setattr(decontam, "SHARD_WORDS", 1000)
    monkeypatch.setattr(decontam, "ENTRIES", 50)
    assert len(list(decontam.indexes(items))) == 5
    assert set(rows(decontam.scan(d, items), "doc_id", "item_id")) == want
    assert set(rows(decontam.clean(d, items), "doc_id")) == {(i,) for i, _ in found} - {(i,) for i, _ in want}


def test_licenses(spark):
    rng = random.Random(3)
    mit = licenses.TEMPLATES[9][1]
    d = docs(spark, (1, f"{prose(rng, 80)}\n{mit}\n{prose(rng, 80)}"), (2, prose(rng, 300)), (3, None), (4, ""), (5, "All rights reserved"), (6, mit.replace("software", "program", 1)), (6, mit.replace("software", "program", 1)), (7, " ".join(mit.split()[:8])), (None, mit))
    got = rows(licenses.scan(d, licenses.templates(spark)), "doc_id", "license_id")
    assert got == [(1, "mit-grant"), (5, "all-rights-reserved"), (6, "mit-grant"), (None, "mit-grant")]
    assert licenses.scan(d.limit(0), licenses.templates(spark)).collect() == []
    assert licenses.scan(d, licenses.templates(spark).limit(0)).collect() == []


def test_licenses_full_texts_and_long_documents(spark, monkeypatch):
    rng = random.Random(17)
    bsd, isc = (next(x for i, x in licenses.TEMPLATES if i == k) for k in ("bsd-3-clause", "isc"))
    d = docs(spark, (1, f"{prose(rng, 60_000)}\n{bsd}\n{prose(rng, 500)}"), (2, isc.replace("fee", "charge")), (3, prose(rng, 400)))
    want = [(1, "bsd-2-clause"), (1, "bsd-3-clause"), (1, "bsd-redistribution"), (2, "0bsd"), (2, "isc")]
    assert rows(licenses.scan(d, licenses.templates(spark)), "doc_id", "license_id") == want
    monkeypatch.setattr(licenses, "LITERALS", 10)
    assert rows(licenses.scan(d.where("doc_id > 1"), licenses.templates(spark)), "doc_id", "license_id") == want[3:]


def test_html(spark):
    d = spark.createDataFrame([(1, "u", "<article><p>a  b</p></article>", "d", "t"), (1, "u", "<article><p>a  b</p></article>", "d", "t"), (None, None, None, "d", "t"), (3, "v", "", None, None)], PAGES)
    assert rows(htmltext.extract(d), "page_id", "url", "text", "n_chars") == [(1, "u", "a b", 3), (1, "u", "a b", 3), (3, "v", "", 0), (None, None, "", 0)]
    assert htmltext.extract(d.limit(0)).collect() == []


def brute_components(table, percent=90):
    h = ngram_join._Hashes()
    sets = [ngram_join.shingle_set(t, h) for _, t in table]
    root = list(range(len(table)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(table)):
        for j in range(i):
            if len(sets[i]) and len(sets[j]) and ngram_join.similar(sets[i], sets[j], percent):
                root[find(i)] = find(j)
    return [(i, len(s), min(table[j][0] for j in range(len(table)) if find(j) == find(k))) for k, ((i, _), s) in enumerate(zip(table, sets, strict=True))]


def test_ngram_join(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(4)
    table = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "x y z"), (907, "X\ty  z"), (907, "X\ty  z")]
    for g, size in enumerate((60, 150, 25)):
        base = prose(rng, size).split()
        for k in range(40):  # copies with edits: chains in which not all pairs link
            words = list(base)
            for _ in range(k % 5):
                words[rng.randrange(size)] = f"edit{rng.randrange(99)}"
            table.append((100 * g + k, " ".join(words)))
    rng.shuffle(table)
    d = docs(spark, *table)
    assert rows(ngram_join.components(d), "doc_id", "n_shingles", "component_id") == sorted(brute_components(table), key=repr)
    one = ngram_join.one_of_each(d)
    assert one.columns == d.columns and rows(one, "doc_id") == sorted({(c,) for _, _, c in brute_components(table)}, key=repr)
    assert ngram_join.components(d.limit(0)).collect() == []


def test_ngram_join_spreads_the_blocks_of_a_pivot(spark):
    by_pivot = spark.range(9).selectExpr("id % 2 AS pivot", "id AS rep").repartition("pivot")
    pairs = by_pivot.selectExpr("pivot", "rep", "rep AS block", "rep AS ask")
    plan = ngram_join._by_block(pairs, lambda key, t: t, "pivot long, rep long, block long, ask long")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(pivot#\d+L, block#\d+L, ask#\d+L, \d+\)", plan)


def test_ngram_join_of_null_and_repeated_ids(spark):
    rng = random.Random(11)
    a, b, c, e, f = (prose(rng, 100) for _ in range(5))
    near = lambda t: f"{t} end"
    table = [(None, a), (None, near(a)), (None, b), (7, b), (None, c), (5, e), (5, f), (6, near(f)), (8, near(e)), (None, None), (None, "")]
    d = docs(spark, *table)
    got = rows(ngram_join.components(d), "doc_id", "component_id")
    assert got == sorted([(None, None)] * 5 + [(None, 7), (7, 7), (5, 5), (5, 5), (6, 5), (8, 5)], key=repr)
    one = ngram_join.one_of_each(d)
    kept = rows(one, "doc_id", "text")
    least = min(a, near(a), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert one.columns == d.columns and kept == sorted([(None, least), (7, b), (None, c), (5, e), (5, f), (None, None), (None, "")], key=repr)


def test_connected_is_linear_in_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(7, 3)], "x long, y long")
    assert {r.node: r.label for r in ngram_join.connected(e).collect()} == {**dict.fromkeys(range(100, 141), 100), 7: 3, 3: 3}


def test_pii(spark):
    d = docs(spark, (1, "mail me: ann@example.org"), (1, "mail me: ann@example.org"), (2, None), (3, ""), (None, "call +1 (389) 555-5010 now"))
    got = {r.doc_id: r for r in pii.scrub(d).collect()}
    assert "ann@" not in got[1].text and got[1].kinds == ["email"] and got[2].text is None and got[3].text == "" and "555-5010" not in got[None].text
    assert pii.scrub(d).count() == 5 and pii.clean(d).columns == d.columns and pii.clean(d).where("doc_id = 2").count() == 1
    assert pii.scrub(d.limit(0)).collect() == []


def test_pii_has_no_collisions(spark):
    rng = random.Random(15)
    texts = [f"Mr. {rng.choice('ABCDE')}{prose(rng, 1)} {rng.choice('KLM')}{prose(rng, 1)}, {rng.randrange(10**3):03}-{rng.randrange(10**2):02}-{rng.randrange(10**4):04}, {prose(rng, 1)}@{prose(rng, 1)}.org, +49 30 {rng.randrange(10**6):06}" for _ in range(400)]
    d = docs(spark, *enumerate(texts + texts[:50]))
    assert pii.collisions(d).count() == 0 and pii.entities(d).count() > 1200
    long = " ".join(texts) + " x" * 100_000
    r = pii.scrub(docs(spark, (1, long))).first()
    assert r.n_entities == 1600 and len(r.text) > 200_000


def test_urls(spark):
    urls = ["http://com/en/1", "http://A.Example.COM/en/7?x", "https://x.net/de/1", "https://example.net/de/81#f", "http://my.org/es/", "http://notcom/en/1", None, "nothing", "ftp://casino-bets.example.io", "http://a.org?es/"]
    d = spark.createDataFrame([(i, u, "h", "d", "t") for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: r for r in urlfilter.judge(d).collect()}
    assert [got[i].rule for i in range(10)] == ["com/en/", "example.com/en/7", "net/de/", "example.net/de/8", "org/es/", None, None, None, None, None]
    assert [got[i].verdict for i in (0, 1, 2, 3, 4, 6, 7, 8)] == ["block", "allow", "allow", "block", "block", "allow", "allow", "block"]
    assert (got[1].host, got[1].path) == ("a.example.com", "/en/7") and (got[7].host, got[7].path) == ("", "") and (got[9].host, got[9].path) == ("a.org", "")
    assert urlfilter.judge(d.limit(0)).collect() == []


def brute_dedup(table):
    seen, out = set(), []
    for i, t in sorted({x for x in table if x[0] is not None}):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return {x[0]: x for x in out}


@pytest.mark.parametrize("group", [1000, 2])
def test_suffix_dedup(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(6)
    shared, other = prose(rng, 60), prose(rng, 30)
    table = [(1, None), (2, ""), (3, "short"), (4, "short"), (5, shared), (6, shared), (7, "ab" * 300), (8, f"{prose(rng, 20)} {shared} {other}"), (8, f"{prose(rng, 20)} {shared} {other}"), (9, "é" * 200)]
    table[8] = table[7]
    for k in range(10, 40):
        words = shared.split()
        words[rng.randrange(60)] = f"edit{k}"
        table.append((k, f"{prose(rng, rng.randint(0, 30))} {' '.join(words)}\n{other} {prose(rng, 5)}"))
    want = brute_dedup(table)
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(suffix_dedup.dedup(docs(spark, *table)), *cols) == sorted((want[i] for i, _ in table), key=repr)
    if group == 2:
        none = suffix_dedup.dedup(docs(spark, (None, shared), (1, shared))).collect()
        assert {(r.doc_id, r.n_removed) for r in none} == {(None, 0), (1, 0)}
        assert suffix_dedup.dedup(docs(spark).limit(0) if False else docs(spark, (1, "x")).limit(0)).collect() == []


def test_suffix_dedup_of_several_texts_under_one_id_and_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BITS", 10)
    rng = random.Random(14)
    shared, long = prose(rng, 40), prose(rng, 1500)
    table = [(1, long), (2, f"{prose(rng, 9)} {long[2000:7000]}"), (3, f"a {shared}"), (3, f"b {shared}"), (3, f"b {shared}"), (4, shared)]
    got = rows(suffix_dedup.dedup(docs(spark, *table)), "doc_id", "n_bytes", "n_removed")
    n = len(shared) + 1
    assert [x for x in got if x[0] < 3] == [(1, len(long), 0), (2, len(table[1][1]), 5001 if table[1][1][-5001] == long[1999] else 5000)]
    assert got[-1] == (4, n - 1, n - 1)
    three = [x for x in got if x[0] == 3]
    assert all(x[1] == n + 1 for x in three) and sorted(x[2] for x in three) in ([0, 0, n], [0, n, n])


def test_quality(spark):
    rng = random.Random(7)
    head = "This site uses cookies 7."
    table = [(i, f"{head}\n{prose(rng, 80)}\n{prose(rng, 20)}", "a") for i in range(40)]
    copied = [prose(rng, 30) for _ in range(4)]
    table += [(100 + i, "\n".join(copied[:3] + [copied[3] + f" {i}"]), "a") for i in range(40)]
    menu = [f"menu entry {chr(97 + k) * 3}" for k in range(30)]
    table += [(200 + i, "\n".join(rng.sample(menu, 26)), "b") for i in range(60)]
    table += [(300, None, None), (301, "", "a"), (302, "a b c " * 40, "a"), (303, prose(rng, 60), None), (303, prose(rng, 60), None)]
    table[-1] = table[-2]
    got = {}
    for r in quality.judge(docs(spark, *table)).collect():
        got.setdefault(r.doc_id, r)
    assert all(got[i].n_words - got[i].n_words_left == 5 and got[i].kept for i in range(40))
    assert all(got[100 + i].kept and got[100 + i].n_words_left == got[100 + i].n_words for i in range(40))
    assert not any(got[200 + i].kept or got[200 + i].base_failed for i in range(60))
    assert (got[300].n_words, got[300].base_failed, got[301].kept) == (0, True, False)
    assert (got[302].n_words, got[302].n_repeat_words, got[302].base_failed) == (120, 120, True) and got[303].kept
    d = docs(spark, *table)
    clean = quality.clean(d)
    assert clean.columns == d.columns and rows(clean, "doc_id") == sorted([(i,) for i, r in got.items() if r.kept] + [(303,)], key=repr)
    assert not clean.where(F.col("text").contains("cookies")).count() and not clean.where(F.length("text") != F.col("n_chars")).count()
    assert quality.judge(d.limit(0)).collect() == []


def test_quality_counts_documents_and_not_copies(spark):
    """Whole footers and fixed menus go, also beside a group of near copies of a third of the host, whose lines stay."""
    rng = random.Random(12)
    footer = "Imprint of the site\nContact us 7\nTerms and conditions"
    menu = "\n".join(f"menu entry {chr(97 + k) * 3}" for k in range(20))
    table = [(i, f"{prose(rng, 90)}\n{prose(rng, 30)}\n{footer}", "a") for i in range(200)]
    table += [(300 + i, f"{menu}\n{prose(rng, 100)}", "a") for i in range(60)]
    table += [(400 + i, f"{menu}\n{prose(rng, 12)}", "a") for i in range(5)]
    lines = [prose(rng, 20) for _ in range(8)]
    for k in range(130):
        words = "\n".join(lines).split(" ")
        for _ in range(4):
            at = rng.randrange(len(words))
            words[at] = "\n".join(["edit" + str(rng.randrange(10**6)), *words[at].split("\n")[1:]])
        table.append((500 + k, " ".join(words), "a"))
    got = {r.doc_id: r for r in quality.judge(docs(spark, *table)).collect()}
    assert all(got[i].n_words - got[i].n_words_left == 10 and got[i].kept for i in range(200))
    assert all(got[300 + i].n_words - got[300 + i].n_words_left == 60 and got[300 + i].kept for i in range(60))
    assert not any(got[400 + i].kept or got[400 + i].base_failed for i in range(5))
    assert all(got[500 + i].n_words == got[500 + i].n_words_left and got[500 + i].kept for i in range(130))
    clean = quality.clean(docs(spark, *table))
    assert not clean.where(F.col("text").contains("Imprint") | F.col("text").contains("Contact us") | F.col("text").contains("Terms and") | F.col("text").contains("menu")).count()


def test_quality_keeps_columns_of_any_name_and_long_texts(spark):
    rng = random.Random(13)
    text = prose(rng, 120)
    names = "doc_id long, text string, source string, _host string, _key long, _gone string, gone string, kept string, host string, `all` string, row long, lines string"
    d = spark.createDataFrame([(1, text, "s", "x", 5, "y", "z", "k", "h", "a", 3, "l"), (None, text, None, None, None, None, None, None, None, None, None, None)], names)
    assert quality.clean(d).columns == d.columns and sorted(map(tuple, quality.clean(d).collect()), key=repr) == sorted(map(tuple, d.collect()), key=repr)
    long = "\n".join(prose(rng, 10) for _ in range(20_000))
    r = quality.judge(docs(spark, (1, long))).first()
    assert r.n_words == 200_000 and r.kept and quality.clean(docs(spark, (1, long))).first().text == long


def test_repeat_words_brute_force(spark):
    rng = random.Random(8)
    table = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 12)))) for i in range(60)]
    for r in quality.judge(docs(spark, *table)).collect():
        w = dict(table)[r.doc_id].split()
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        hit = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        assert r.n_repeat_words == len(hit), w


def test_cells_of_the_ngram_join_are_dealt_once(spark, monkeypatch):
    plans = {}

    def watched(df, name, write=ngram_join.materialize):
        if name == "ngram-pairs":
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(ngram_join, "materialize", watched)
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(6)]
    ngram_join.links(docs(spark, *[(i, f"{texts[i % 6]} x{i}", "a") for i in range(24)]))
    assert "ReusedExchange" in plans["ngram-pairs"].split("Initial Plan")[0]
