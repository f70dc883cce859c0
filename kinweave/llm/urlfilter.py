"""URL filters: rules on host and path, and a logistic regression on hashed character n-grams.

Rules name a host and a path prefix; a rule fits its host and all subdomains,
and the longest fitting rule wins. URLs that no rule fits are scored by a
logistic regression over hashed character n-grams of host and path, trained
from the small labelled table below. Scoring is DataFrame code with integer
(fixed-point) weights, so that sums don't depend on their order.

Defined edge cases: a null URL, or one without `://`, has an empty host and
path, fits no rule and has no n-grams: its score is 0 (allow);
repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (3, 4)
#: Fixed-point scale of the weights.
SCALE = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: The labelled table: hosts and paths of unwanted sites, and of ordinary ones.
UNWANTED = """casino-royal.example.com/play online-casino.example.net/en/12 wincasino.example.org/slots casino24.example.com/de/7 best-bets.example.com/odds
sports-bets.example.net/live betting-tips.example.org/es/9 bets365.example.com/en free-spins.example.net/bonus poker-win.example.org/table
pills-shop.example.com/order cheap-meds.example.net/rx buy-pills.example.org/en/44 pillstore.example.com/cheap viagra-cheap.example.net/buy
adult-cams.example.com/live adult-video.example.net/x/1 xxx-tube.example.org/watch sexy-x.example.com/en/3 adultchat.example.net/room
spam-links.example.org/farm link-farm.example.com/seo spamhost.example.net/mail bulk-spam.example.com/list farm-links.example.org/en/1
ads-server.example.com/track click-track.example.net/pixel adtrack.example.org/id ads-click.example.com/banner track-ads.example.net/c
free-download-crack.example.com/keygen warez-free.example.net/crack phish-login.example.org/bank malware-drop.example.com/exe free-prize-win.example.net/claim
win-money.example.org/now lottery-win.example.com/free cheap-loans.example.net/apply casino-free.example.org/es/8 cheap-watches.example.com/replica
www.spam-mail.example.org/en/512 blog.cheap-viagra.example.com/fr/77 m.casino-spins.example.net/de/4021 www.adult-zone.example.com/es/15.html blog.farm-seo.example.org/fr/903/
m.free-poker.example.com/en/2210 www.ads-pixel.example.net/de/31 blog.win-bets.example.org/es/8 www.discount-pills.example.com/fr/640 m.xxx-cams.example.net/en/71/"""
ORDINARY = """news.example.com/politics/2 blog.river.example.org/post/7 www.library.example.net/en/55 m.garden.example.com/fr/12 docs.example.org/manual/index.html
university.example.net/courses wiki.example.com/history shop.baker.example.org/bread blog.thonth.example.net/es/12 m.inther.example.com/fr/8
www.erthat.example.org/en/1002 oningth.example.net/en/33 thereas.example.com/fr/7 www.andthe.example.net/de/2 blog.heron.example.com/en/95
museum.example.org/art/4 weather.example.net/today m.tionand.example.org/en/71 ationer.example.com/de/4 www.ouring.example.net/fr/601
school.example.com/class/9 townhall.example.org/council recipes.example.net/soup travel.example.com/island m.whethin.example.org/es/31
hospital.example.net/ward theatre.example.org/stage blog.ntheas.example.com/en/8 www.atered.example.org/de/62 edition.example.net/en/448
gardening.example.org/roses m.shipyard.example.com/fr/3 science.example.net/physics www.bridge.example.com/en/12 music.example.org/concert
astonth.example.com/fr/90 thenand.example.net/en/5 blog.thinat.example.org/fr/77 www.readers.example.com/books m.station.example.net/de/54
reatheon.example.org/en/31 wheretion.example.com/es/6 thatesh.example.net/en/17/ www.thened.example.org/en/4.html blog.tishon.example.com/fr/281
m.harbour.example.org/en/3327/ m.ththorn.example.org/es/368 ththern.example.com/en/904 m.cottage.example.net/fr/55 www.haththe.example.com/es/20 m.meadow.example.com/de/9"""


def grams_of(text: str) -> list[str]:
    return [text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)]


def bucket_of(gram: str) -> int:
    return int(hashlib.md5(gram.encode()).hexdigest()[:3], 16)


def features_of(host: str, path: str) -> list[str]:
    """The n-grams: those of the host between ^ and $, and those of the path behind a mark of its own. An empty text has none."""
    return [*(grams_of(f"^{host}$") if host else []), *(grams_of(f"@{path}") if path else [])]


def labelled() -> list[tuple[str, str, int]]:
    split = lambda x: (x.partition("/")[0], "/" + x.partition("/")[2])
    return [(*split(x), 1) for x in UNWANTED.split()] + [(*split(x), 0) for x in ORDINARY.split()]


@lru_cache
def model() -> tuple[tuple[int, ...], int]:
    """Weights by bucket and intercept, as integers of 1 / SCALE: L2-regularised logistic regression by gradient descent from 0."""
    rows = labelled()
    x, y = np.zeros((len(rows), BUCKETS)), np.array([r[2] for r in rows], float)
    for i, (host, path, _) in enumerate(rows):
        for g in features_of(host, path):
            x[i, bucket_of(g)] += 1
    w, b = np.zeros(BUCKETS), 0.0
    for _ in range(400):
        off = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= 0.5 * (x.T @ off / len(y) + 0.002 * w)
        b -= 0.5 * off.mean()
    return tuple(int(v) for v in np.rint(w * SCALE)), round(b * SCALE)


def host_of(url: Column) -> Column:
    after = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(after, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_text(host: str, path: str) -> str:
    return host + path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The text of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for _, h, p in sorted(rules, key=lambda r: len(rule_text(r[1], r[2]))):
        out = F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.lit(rule_text(h, p))).otherwise(out)
    return out


def score(host: Column, path: Column) -> Column:
    """The log-odds of `unwanted`, in 1 / SCALE."""
    weights, intercept = model()
    table = F.split(F.lit(" ".join(map(str, weights))), " ").cast("array<long>")  # folded to one literal
    grams = lambda s, n: F.transform(F.when(F.length(s) >= n, F.sequence(F.lit(1), F.length(s) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(s, i, F.lit(n)))
    marked = [F.when(host == "", "").otherwise(F.concat(F.lit("^"), host, F.lit("$"))), F.when(path == "", "").otherwise(F.concat(F.lit("@"), path))]
    every = F.concat(*[grams(s, n) for s in marked for n in GRAMS])
    known = F.aggregate(every, F.lit(intercept).cast("long"), lambda a, g: a + F.get(table, F.conv(F.substring(F.md5(g), 1, 3), 16, 10).cast("int")))
    return F.when((host == "") & (path == ""), F.lit(0).cast("long")).otherwise(known)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score for each row of pages."""
    d = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    d = d.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("score", score(F.col("host"), F.col("path")))
    by_rule = F.create_map(*[F.lit(x) for v, h, p in rules for x in (rule_text(h, p), v)])
    return d.withColumn("verdict", F.when(F.col("rule").isNotNull(), by_rule[F.col("rule")]).otherwise(F.when(F.col("score") > 0, "block").otherwise("allow")))


def oracle() -> str:
    weights, intercept = model()
    rule = "NULL"
    for _, h, p in sorted(RULES, key=lambda r: len(rule_text(r[1], r[2]))):
        rule = f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{rule_text(h, p)}' ELSE {rule} END"
    verdict = " ".join(f"WHEN '{rule_text(h, p)}' THEN '{v}'" for v, h, p in RULES)
    gram = lambda s: ", ".join(f"list_transform(range(1, length({s}) - {n - 1} + 1), lambda i: substr({s}, i, {n}))" for n in GRAMS)
    return f"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT *, {rule} AS rule, CASE WHEN host = '' THEN '' ELSE '^' || host || '$' END AS a, CASE WHEN path = '' THEN '' ELSE '@' || path END AS b FROM u),
g AS (SELECT *, flatten([{gram('a')}, {gram('b')}]) AS grams FROM m),
t AS (SELECT {list(weights)} AS weights),
s AS (SELECT page_id, host, path, rule, CASE WHEN host = '' AND path = '' THEN 0 ELSE {intercept} + coalesce(list_sum(list_transform(grams, lambda x: weights[CAST('0x' || substr(md5(x), 1, 3) AS INTEGER) + 1])), 0) END AS score FROM g, t)
SELECT page_id, host, path, rule, CAST(score AS BIGINT) AS score, CASE WHEN rule IS NOT NULL THEN CASE rule {verdict} END WHEN score > 0 THEN 'block' ELSE 'allow' END AS verdict FROM s
"""
