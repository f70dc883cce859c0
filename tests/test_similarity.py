import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from kinweave.functions import similarity as sim


def test_edit(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", "a"), ("café", "cafe")], "a string, b string")
    got = [r[0] for r in df.select(sim.edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert [round(x, 9) for x in got] == [round(4 / 7, 9), 0, 0.75]


def test_numbers(spark):
    df = spark.createDataFrame([(["12", "75001"], ["75001", "99"])], "a array<string>, b array<string>")
    n = sim.numbers(F.col("a"), F.col("b"))
    r = df.select(*[v.alias(k) for k, v in n.items()]).first()
    assert (r.overlap, r.equal, r.disagree, r.conflict, round(r.jaccard, 6)) == (1, 0, 1, 0, 0.333333)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcd ", k=rng.randint(0, 40))) for _ in range(2))
        assert sim.common_subsequence(a, b) == slow_lcs(a, b), (a, b)


def test_ratios():
    assert sim.fuzz_ratio("this is a test", "this is a test!") == 28 / 29
    assert sim.partial_ratio("this is a test", "this is a test!") == 1
    assert sim.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 1
    assert sim.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 1
    assert sim.fuzz_ratio("", "a") == sim.partial_ratio("", "") == sim.token_set_ratio("", "x") == 0
    assert round(sim.jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert sim.jaro_winkler("abc", "") == 0
    assert SequenceMatcher(None, "abcd", "bcde").ratio() == sim.fuzz_ratio("abcd", "bcde")


def test_udf_batches(spark):
    df = spark.createDataFrame([("martha", "marhta"), (None, "a")], "a string, b string")
    assert [round(r[0], 4) for r in df.select(sim.jaro(F.col("a"), F.col("b"))).collect()] == [0.9611, 0.0]


def test_partial_ratio_of_equal_texts_needs_no_windows(monkeypatch):
    monkeypatch.setattr(sim, "common_subsequence", lambda *_: 1 / 0)
    assert sim.partial_ratio("red fox club", "red fox club") == 1.0 and sim.partial_ratio("", "") == 0.0


def test_ratios_of_many_pairs_are_those_of_each():
    """Texts of several words of bits, empty ones, other alphabets, common and repeated tokens."""
    rng = random.Random(5)
    texts = ["", "a", "a a", "fox hen", "hen fox", "b" * 64, "b" * 65, "ab" * 100, *[" ".join(rng.choice("the fox hen é и 路 und of 12 7 main".split()) for _ in range(rng.randrange(1, 60))) for _ in range(40)], *["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 200))).strip() for _ in range(30)]]
    a, b = zip(*[(x, y) for x in texts for y in texts], strict=True)
    got = sim.fuzzy_ratios([*a], [*b])
    for f, values in zip((sim.fuzz_ratio, sim.token_set_ratio, sim.token_sort_ratio), got, strict=True):
        assert [*values] == [f(x, y) for x, y in zip(a, b, strict=True)]
    far = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(90)) for _ in range(90)]
    assert [*sim.common_subsequences(far, far[::-1])] == [*map(sim.common_subsequence, far, far[::-1])]
    assert len(sim.common_subsequences([], [])) == 0
