"""PII: detection, and replacement by keyed surrogates of the same kind.

Detected: e-mail addresses, telephone numbers, payment cards, US social security
numbers, IBANs, IPv4 and IPv6 addresses, secrets (API keys, long hexadecimal
tokens), and personal names behind a title or beginning with a listed given name.

A surrogate keeps what says what the entity is (length, punctuation, case, the
country code, the script of the letters, whether check digits are right) and
replaces the rest. What may vary is read as a number x below M, the product of
the alphabets' sizes. With a keyed permutation P of the numbers below M (a Feistel
network with cycle walking) the surrogate is P^-1((P(x) + 1) mod M): a permutation
without a fixed point. Two entities of one kind and shape thus never get the same
surrogate, and no entity keeps its text; the same entity gets the same surrogate
in every document and spelling (case and separators don't enter x). Entities of
different shapes can't collide as shapes are kept. No table of entities is needed
for it, so nothing is shuffled.

A listed given name gets another of its list, which is of one script and gender.
Other names are permuted letter by letter, vowels and consonants of a script among
themselves, and keep the last letter, which in many languages shows the gender; a
result that is a listed name is permuted again, so that the two ways can't collide.

A surrogate may equal another real entity of its shape; as that one is replaced
too, the texts that come out still have one surrogate for each entity.
collisions() checks this over a corpus.

Defined edge cases: a null text stays null, an empty one empty; overlapping
finds go to the kind listed first; repeated rows each get a row; other columns
are ignored by scrub() and kept by clean().
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The key of the surrogates; a real one belongs to whoever runs this.
KEY = b"change-me"
#: Given names that stand in for each other: of one script and gender each.
GIVEN = tuple(tuple(x.split()) for x in (
    "Alice Amelia Anna Barbara Carla Caroline Charlotte Christine Clara Claudia Elena Elizabeth Emily Emma Eva Helen Helena Isabel Jane Julia Karin Katharina Laura Linda Lucia Margaret Maria Marie Martha Mary Nancy Patricia Petra Rosa Ruth Sarah Sofia Susan Teresa Victoria",
    "Adam Albert Alexander Andreas Antonio Arthur Carlos Charles Christian Daniel David Diego Edward Francisco Frank George Hans Henry James Jean John Joseph Juan Klaus Lucas Manuel Martin Michael Miguel Nicolas Oliver Paul Pedro Peter Philip Pierre Robert Stefan Thomas William",
    "Анна Вера Галина Дарья Екатерина Елена Ирина Ксения Людмила Мария Наталья Ольга Светлана Татьяна Юлия",
    "Александр Андрей Борис Виктор Владимир Дмитрий Иван Игорь Михаил Николай Олег Павел Пётр Сергей Фёдор",
    "Άννα Βασιλική Γεωργία Ελένη Ειρήνη Κατερίνα Μαρία Σοφία",
    "Αλέξανδρος Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος",
))
LISTED = {name.lower(): (names, k) for names in GIVEN for k, name in enumerate(names)}
#: Characters of an IBAN by country; fixed values.
IBAN_LENGTHS = dict(x.split(":") for x in "AD:24 AE:23 AT:20 BE:16 BG:22 CH:21 CY:28 CZ:24 DE:22 DK:18 EE:20 ES:24 FI:18 FR:27 GB:22 GI:23 GR:27 HR:21 HU:28 IE:22 IL:23 IS:26 IT:27 LI:21 LT:20 LU:20 LV:21 MC:27 MT:31 NL:18 NO:15 PL:28 PT:25 QA:29 RO:24 RS:22 SA:24 SE:24 SI:19 SK:24 SM:27 TR:26 UA:29".split())
#: Letters that stand in for each other, by script and sound. Others have the letters of their kind among the 128 code points around them.
ALPHABETS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùäëïöüâêîôû", "çñß", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιοω", "βγδζθκλμνξπρστφχψ", "0123456789")
PLACE = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}


@lru_cache(maxsize=10_000)
def place_of(c: str) -> tuple[str, int] | None:
    """The alphabet of a lower-case letter or digit and where it stands there; None for other characters."""
    if c in PLACE or not c.isalpha():
        return PLACE.get(c)
    kind, first = unicodedata.category(c), ord(c) & ~127
    near = "".join(x for x in map(chr, range(first, first + 128)) if unicodedata.category(x) == kind and x not in PLACE and x.lower() == x and len(x.upper()) == 1)
    return (near, near.index(c)) if c in near else None


HEX = {c: ("0123456789abcdef", i) for i, c in enumerate("0123456789abcdef")}
#: Titles before personal names.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Mme Mlle Monsieur Madame Sr Sra Srta Señor Señora Don Doña Signor Signora г-н г-жа Κος Κα".split()

#: A part of a name: a letter that isn't lower-case (or of a script without case) and more letters, hyphens or apostrophes.
WORD = r"[^\W\d_a-zß-öø-ÿа-яёα-ω](?:[^\W\d_]+|(?=['’]))(?:['’-][^\W\d_]+)*"
KINDS = {
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\b(?:ghp|gho|sk|pk|xox[abp])[_-][A-Za-z0-9_-]{16,}\b|\b[0-9a-fA-F]{32,}\b",
    "email": r"[^\W_](?:[\w.+%-]*[\w+%-])?@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)|(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
    # national forms: 1-800-555-0199; 555 123 4567; 020 7946 0958 and 0171 2345678; 01 23 45 67 89
    r"|(?<![\w.,+-])(?<!\d )(?:1[ .-](?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\d{3} \d{3}[ -]\d{4}|0\d{1,4} \d{3,4} \d{3,4}|0\d{2,4}[ /]\d{5,8}|0\d(?:[ .]\d{2}){4})(?![\w-])(?! \d)",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "name": rf"(?<![\w-])(?:(?:{'|'.join(map(re.escape, TITLES))})\.? (?P<person>{WORD}(?: {WORD})?)|(?P<given>(?:{'|'.join(map(re.escape, (n for names in GIVEN for n in names)))}) {WORD}))(?![\w])",
}
FIND = re.compile("|".join(f"(?P<{k}>{v})" for k, v in KINDS.items()))
#: A text without these holds none of the kinds but names. Of secrets and IPv6 addresses, some have no digit.
HINT = re.compile(r"[@\d]|AKIA|(?:gh[po]|[sp]k|xox[abp])[_-]|[a-fA-F]{32}|(?:[a-fA-F]{1,4}:){7}")
TITLE = re.compile(rf"(?<![\w-])(?:(?:{'|'.join(map(re.escape, TITLES))})\.?|{'|'.join(map(re.escape, (n for names in GIVEN for n in names)))}) ")


class Surrogates:
    """Replacements under one key."""

    def __init__(self, key: bytes):
        self.key = key
        self.one = lru_cache(maxsize=100_000)(self._one)

    def _round(self, tweak: bytes, r: int, x: int, bits: int) -> int:
        data = tweak + bytes([r]) + x.to_bytes(-(-bits // 8) + 1, "big")
        out = b""
        while len(out) * 8 < bits:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key[:64], digest_size=64).digest()
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def _permute(self, x: int, m: int, tweak: bytes, back: bool) -> int:
        half = max(1, -(-(m - 1).bit_length() // 2))
        low = (1 << half) - 1
        while True:
            a, b = x >> half, x & low
            for r in reversed(range(8)) if back else range(8):
                a, b = (b ^ self._round(tweak, r, a, half), a) if back else (b, a ^ self._round(tweak, r, b, half))
            x = a << half | b
            if x < m:
                return x

    def shift(self, x: int, m: int, tweak: bytes) -> int:
        """The surrogate of x among the numbers below m."""
        return self._permute((self._permute(x, m, tweak, False) + 1) % m, m, tweak, True) if m > 1 else x

    def letters(self, text: str, tweak: str, place: Callable[[str], tuple[str, int] | None] = place_of, keep: Callable[[int], bool] = lambda i: False) -> str:
        """text with each character of a known alphabet, but for those kept, replaced inside its alphabet. Case and other characters don't count."""
        chars = [(i, c, place(c.lower())) for i, c in enumerate(text)]
        free = [(i, c, p) for i, c, p in chars if p and not keep(i)]
        shape = "".join(str(ALPHABETS.index(p[0])) if p[0] in ALPHABETS else "h" if p[0] is HEX["0"][0] else p[0][0] for _, _, p in free)
        fixed = "".join(c.lower() for i, c, p in chars if p and keep(i))
        x, m = 0, 1
        for _, _, (alphabet, k) in free:
            x, m = x * len(alphabet) + k, m * len(alphabet)
        x = self.shift(x, m, f"{tweak}|{shape}|{fixed}".encode())
        out = list(text)
        for i, c, (alphabet, _) in reversed(free):
            x, k = divmod(x, len(alphabet))
            out[i] = alphabet[k].upper() if c != c.lower() and len(alphabet[k].upper()) == 1 else alphabet[k]
        return "".join(out)

    def digits(self, text: str, tweak: str, kept: int = 0, last: Callable[[str], str] | None = None) -> str:
        """text with its digits replaced but for the first `kept`; last(digits before) gives the last one where it is a check digit."""
        at = [i for i, c in enumerate(text) if c.isdigit()]
        old = "".join(str(int(text[i])) for i in at)
        end = len(old) - (last is not None)
        free = old[kept:end]
        x = self.shift(int(free), 10 ** len(free), f"{tweak}|{len(old)}|{old[:kept]}".encode()) if free else 0
        new = old[:kept] + (str(x).zfill(len(free)) if free else "")
        if last:
            new += last(new)
        out = list(text)
        for i, c in zip(at, new, strict=True):
            out[i] = c
        return "".join(out)

    def _one(self, kind: str, text: str) -> str:
        return getattr(self, f"_{kind}")(text)

    def _secret(self, text: str) -> str:
        if re.fullmatch(r"[0-9a-fA-F]+", text):
            return self.letters(text, "hex", HEX.get)
        prefix = len(re.match(r"AKIA|[a-z]+[_-]", text)[0])
        return self.letters(text, "secret", keep=lambda i: i < prefix)

    def _email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{self.letters(local, 'local')}@{self.letters(host, 'domain')}.{top}"

    def _iban(self, text: str) -> str:
        at = [i for i, c in enumerate(text) if c != " "]
        old = "".join(text[i] for i in at)
        body = self.letters(old[4:], f"iban{old[:2]}")
        check = lambda rest: 98 - _mod97(rest + old[:2] + "00")
        off = 0 if _valid_iban(old) else int(old[2:4]) - check(old[4:])  # a wrong number stays as wrong
        new = old[:2] + f"{(check(body) + off) % 100:02d}" + body
        out = list(text)
        for i, c in zip(at, new, strict=True):
            out[i] = c
        return "".join(out)

    def _ssn(self, text: str) -> str:
        return self.digits(text, "ssn")

    def _ip(self, text: str) -> str:
        if ":" in text:
            return self.letters(text, "ip6", HEX.get)
        octets = [int(o) for o in text.split(".")]
        kept = 2 if octets[:2] == [192, 168] else 1 if octets[0] in (10, 127) else 0  # private networks stay private
        x = 0
        for o in octets[kept:]:
            x = x << 8 | o
        x = self.shift(x, 1 << 8 * (4 - kept), f"ip|{octets[:kept]}".encode())
        return ".".join(map(str, octets[:kept] + [x >> 8 * k & 255 for k in range(3 - kept, -1, -1)]))

    def _phone(self, text: str) -> str:
        code = re.match(r"\+(\d{1,3})(?!\d)", text)
        trunk = re.match(r"1[ .-]|0\d*[ /]", text)
        return self.digits(text, "phone", len(code[1]) if code else 1 if trunk else min(1, text.count("+")))

    def _card(self, text: str) -> str:
        old = [int(c) for c in text if c.isdigit()]
        off = (old[-1] - _luhn(old[:-1])) % 10  # 0 if the number is valid, and then the surrogate is too
        return self.digits(text, f"card{off}", 1, lambda new: str((_luhn(list(map(int, new))) + off) % 10))

    def _word(self, text: str) -> str:
        """A part of a name: listed given names stay in their list, others keep their letters' kinds and, in scripts with case, the last letter."""
        if text.lower() in LISTED:
            names, k = LISTED[text.lower()]
            new = names[self.shift(k, len(names), f"given{names[0]}".encode())]
            return new.upper() if text.isupper() else new
        kept = len(text) - 1 if text.lower() != text.upper() else len(text)
        while True:
            text = self.letters(text, "name", keep=lambda i: i == kept)
            if text.lower() not in LISTED:
                return text

    def replace(self, text: str, found_all: list | None = None) -> tuple[str, list[str]]:
        """The text with surrogates, and the kinds of the entities found. found_all, if given, gets (kind, entity, surrogate) of each."""
        if not HINT.search(text) and not TITLE.search(text):
            return text, []
        kinds: list[str] = []
        people: set[str] = set()

        pieces: list[tuple[str, bool]] = []
        done = at = 0
        while m := FIND.search(text, at):
            kind = next(k for k in KINDS if m[k] is not None)
            found = m[0]
            if kind == "iban":
                found = _iban_in(found)
                if found is None:
                    at = m.start() + 4  # other kinds may start behind the first token
                    continue
            kinds.append(kind)
            if kind == "name":
                person = m["person"] or m["given"]
                parts = person.split(" ")
                people.update(parts)
                new = found[: -len(person)] + " ".join(self.one("word", w) for w in parts)
            else:
                new = self.one(kind, found)
            pieces += [(text[done : m.start()], False), (new, True)]
            if found_all is not None:
                found_all.append((kind, found, new))
            done = at = m.start() + len(found)
        pieces.append((text[done:], False))
        if people:  # the same person without the title
            bare = re.compile(rf"(?<![\w@.-])(?:{'|'.join(map(re.escape, sorted(people)))})(?![\w@-])")
            # what is a surrogate already isn't replaced again
            pieces = [(x if new else bare.sub(lambda m: self.one("word", m[0]), x), True) for x, new in pieces]
        return "".join(x for x, _ in pieces), kinds


def _luhn(digits: list[int]) -> int:
    """The check digit behind these."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _valid_iban(text: str) -> bool:
    t = text.replace(" ", "")
    return 15 <= len(t) <= 34 and _mod97(t[4:] + t[:4]) == 1


def _iban_in(text: str) -> str | None:
    """The IBAN that a run of tokens begins with. Tokens behind the number may be no part of it: the longest start at a border of tokens with right check digits, or else with the length of its country."""
    starts = [text, *(text[:k] for k in range(len(text) - 1, 0, -1) if text[k] == " ")]
    return next((x for x in starts if _valid_iban(x)), None) or next((x for x in starts if str(len(x.replace(" ", ""))) == IBAN_LENGTHS.get(x[:2])), None)


def _scrub(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key)
        for batch in batches:
            rows = [(None, []) if t is None else s.replace(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([sorted(set(r[1])) for r in rows], pa.list_(pa.string()))], ["doc_id", "text", "n_entities", "kinds"])

    return run


def scrub(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text (with surrogates), n_entities, kinds for each row of docs; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scrub(key), "doc_id long, text string, n_entities long, kinds array<string>")


def entities(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, entity, surrogate: each entity found in docs once, in lower case and without separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key)
        plain = lambda x: re.sub(r"[\s().-]", "", x).lower()
        for batch in batches:
            found: list = []
            for t in batch.column(0).to_pylist():
                s.replace(t or "", found)
            rows = sorted({(k, x, y) if k == "email" else (k, plain(x), plain(y)) for k, x, y in found})
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["kind", "entity", "surrogate"])

    return docs.select("text").mapInArrow(run, "kind string, entity string, surrogate string").distinct()


def collisions(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, surrogate, entities: surrogates that several entities share, or (coreference) entities with several; empty if all is right."""
    e = entities(docs, key).where("kind <> 'name'").withColumn("entity", F.lower("entity")).withColumn("surrogate", F.lower("surrogate")).distinct()
    shared = e.groupBy("kind", "surrogate").agg(F.count("*").alias("entities")).where("entities > 1")
    split = e.groupBy("kind", F.col("entity").alias("surrogate")).agg(F.count("*").alias("entities")).where("entities > 1")
    return shared.unionByName(split)


def clean(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """docs with surrogates in text and, if there, n_chars of the new text; all columns and rows."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Surrogates(key)
        for batch in batches:
            texts = [None if t is None else s.replace(t)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
