"""PII surrogates: detected entities get keyed, type-consistent replacements.

Entities are e-mail and IP addresses, phone, card, bank and social security
numbers, and names after a title or an introduction. A surrogate is drawn from a
keyed hash of type, value and attempt, so one entity has one surrogate in all
documents. It keeps the format: length, punctuation, letter case, script, a card's
issuer digit and check digit, a bank number's country and check digits, a phone's
country code or leading zero, an address's first group, a name's gender.

Names are replaced word by word, and a name once found is replaced wherever its
words stand in that document. A word is one name in all documents, whatever its
title and letter case there. Its gender is that of most of its gendered titles in the
corpus, else that of its last letter, else none; a word that only ever stands last
or alone is a surname and has none.

Collisions are checked over the corpus: a surrogate must differ from those of all
other entities and from every real value of its type (names are one type). Of entities that draw the
same one the smallest keeps it; the others draw again until none collide.

Defined results: a NULL or empty text stays as it is; repeated rows are replaced
alike; rows with equal id and text have one result; other columns pass through,
and an input column named ``replaced`` is replaced. If a format has no free
values left after ``ATTEMPTS`` draws, the job fails rather than reuse one.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored, text_key, unused

ATTEMPTS = 200
WIDER = 20                  # draws after which a name grows by a syllable

# Titles before names, by the gender they tell.
TITLES = {"m": ("Mr", "Herr", "Señor", "Sr", "Monsieur"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Fräulein", "Señora", "Señorita", "Sra", "Mme", "Mlle", "Madame"),
          "n": ("Dr", "Prof", "Doctor", "Professor", "my name is", "My name is", "mein Name ist", "Mein Name ist",
                "ich heiße", "Ich heiße", "je m'appelle", "Je m'appelle", "me llamo", "Me llamo")}
# Last letters of given names that are mostly feminine or masculine.
LAST = {"f": "aаяαη", "m": "ςйо"}
# Letter ranges of scripts, lower case where there is case.
SCRIPTS = (("a", "z"), ("а", "я"), ("α", "ω"), ("א", "ת"), ("ا", "ي"), ("क", "ह"), ("ぁ", "ゖ"), ("ァ", "ヺ"),
           ("가", "힣"), ("一", "鿿"))
SYLLABLES = {"a": ("b d f g l m n r s t v br dr tr st".split(), "a e i o u".split()),
             "а": ("б в г д к л м н р с т".split(), "а е и о у".split()),
             "α": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο".split())}
ENDINGS = {("a", "m"): ("n", "r", "s", "l"), ("a", "f"): ("a", "ia", "ela"), ("а", "m"): ("н", "р", "й"),
           ("а", "f"): ("а", "ия"), ("α", "m"): ("ος", "ας"), ("α", "f"): ("α", "η"),
           ("a", "n"): ("e", "i", "y"), ("а", "n"): ("е", "и"), ("α", "n"): ("ι", "ου")}

_TITLE = "|".join(sorted({t for ts in TITLES.values() for t in ts}, key=len, reverse=True))
GENDER = {t: g for g, ts in TITLES.items() for t in ts}
NAMES = ("name_m", "name_f", "name_n", "surname")
HOT = 1_000                 # of more mentions than this, and than this part of all, a value's surrogate is broadcast
NAME_WORD = r"[^\W\d_a-zà-ÿ][^\W\d_]+"
ENTITY = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?(?!\w))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))"
    r"|(?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|[0-9A-Fa-f]{2,4}(?::[0-9A-Fa-f]{1,4}){0,6}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})(?![\w:]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<phone>(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,14}(?:[ .-]\d{2,5}){0,4}"
    r"|\(\d{2,4}\)[ .-]?\d{2,4}(?:[ .-]\d{2,5}){1,3}|0\d{2,4}[ /-]\d{3,4}[ -]?\d{2,4}(?:[ -]?\d{2,4})?|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w))"
    rf"|(?P<name>(?<!\w)(?P<title>{_TITLE})\.?[ \xa0]+(?P<words>{NAME_WORD}(?:[ -]{NAME_WORD}){{0,2}}))")
#: Java regex that every text with an entity matches.
COARSE = rf"@|\p{{Nd}}(?:[ .()/-]{{0,2}}\p{{Nd}}){{3,}}|:(?<=[0-9A-Fa-f]:)(?::|(?:[0-9A-Fa-f]{{1,4}}:){{6}})[0-9A-Fa-f]|[A-Z]{{2}}\p{{Nd}}{{2}} ?[A-Z\p{{Nd}}]{{4}}|(?<!\p{{L}})(?:{_TITLE})\.?[  ]"


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if int(d) > 4 else int(d) * 2)
                for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def valid(kind: str, value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    if kind == "ip":
        return all(int(x) < 256 for x in value.split("."))
    if kind == "ipv6":
        try:
            return any(c.isdecimal() for c in value) and ipaddress.IPv6Address(value) is not None
        except ValueError:
            return False
    if kind == "card":
        return luhn(digits) or (len(digits) == 16 and digits[0] in "3456")
    if kind == "iban":
        return mod97(value.replace(" ", "")) == 1
    return kind != "phone" or (9 if value[0] == "0" else 7) <= len(digits) <= 15


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, value) of each entity; of a name, each word."""
    out, words = [], {}
    for m in ENTITY.finditer(text):
        kind = m.lastgroup if m.lastgroup in ("email", "iban", "ip", "ipv6", "ssn", "card", "phone") else "name"
        if kind != "name":
            if valid(kind, m.group()):
                out.append((m.start(), m.end(), kind, m.group()))
            continue
        parts = list(re.finditer(r"[^ -]+", m.group("words")))
        for i, p in enumerate(parts):
            first = i == 0 and len(parts) > 1
            kind = f"name_{GENDER[m.group('title')]}" if first else "surname"
            old = words.get(p.group(), "surname")
            words[p.group()] = old if old in ("name_m", "name_f") or kind == "surname" else kind
    if words:
        taken = [(a, b) for a, b, _, _ in out]
        find = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + r")(?!\w)")
        for m in find.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                out.append((m.start(), m.end(), words[m.group()], m.group()))
    return sorted(out)


class Stream:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.state = hmac.new(key, "\0".join(parts).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.left = int.from_bytes(self.state, "big")

    def below(self, n: int) -> int:
        if self.left < n << 64:
            self.state = hashlib.sha256(self.state).digest()
            self.left = int.from_bytes(self.state, "big")
        self.left, got = divmod(self.left, n)
        return got

    def pick(self, options):
        return options[self.below(len(options))]


def script_of(char: str) -> tuple[str, str]:
    low = char.lower()
    return next((s for s in SCRIPTS if s[0] <= low <= s[1]), SCRIPTS[0])


def digits_like(text: str, sample: str) -> str:
    """The text with its digits in the script of the sample's first one."""
    zero = next((ord(c) - unicodedata.decimal(c) for c in sample if c.isdecimal()), 48)
    return text if zero == 48 else "".join(chr(zero + int(c)) if "0" <= c <= "9" else c for c in text)


def like(char: str, s: Stream) -> str:
    """A character of the same kind: a digit, or a letter of the script and case; punctuation stays."""
    if char.isdecimal():
        return digits_like(str(s.below(10)), char)
    if not char.isalpha():
        return char
    a, b = map(ord, script_of(char))
    got = chr(a + s.below(b - a + 1))
    return got.upper() if char.isupper() and len(got.upper()) == 1 else got


def name_like(value: str, gender: str, s: Stream, attempt: int) -> str:
    """A pronounceable name of the script, case and about the length, with the gender's ending."""
    base = script_of(value[0])[0]
    if base not in SYLLABLES:
        return "".join(like(c, s) for c in value) + "".join(like(value[-1], s) for _ in range(attempt // WIDER))
    onset, vowel = SYLLABLES[base]
    out = "".join(s.pick(onset) + s.pick(vowel) for _ in range(max(2, len(value) // 3) + attempt // WIDER))
    out = out[:-1] if gender == "f" else out
    out += s.pick(ENDINGS.get((base, gender), ENDINGS[base, "m"]))
    return out.upper() if value.isupper() else out[0].upper() + out[1:]


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The replacement of one entity; another one for each attempt."""
    s = Stream(key, kind, value, str(attempt))
    if kind == "surname" or kind.startswith("name_"):
        return name_like(value, kind.removeprefix("name_") if kind != "surname" else "n", s, attempt)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        return "".join(like(c, s) for c in local) + "@" + ".".join(
            ["".join(like(c, s) for c in x) for x in labels[:-1]] + labels[-1:])
    if kind == "ip":
        private = {"10": 1, "127": 1, "192": 2, "172": 2}.get(value.split(".")[0], 0)
        parts = value.split(".")
        return ".".join(parts[:private] + [digits_like(str(1 + s.below(223 if i == 0 else 254)), value)
                                           for i in range(private, 4)])
    if kind == "ipv6":
        first, rest = value.split(":", 1)
        low = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF"
        new = (s.pick(low[1:] if i == 0 or rest[i - 1] == ":" else low) if c != ":" else c for i, c in enumerate(rest))
        return f"{first}:" + "".join(new)
    if kind == "iban":
        flat = value.replace(" ", "")
        body = "".join(like(c, s) if c.isdecimal() else chr(65 + s.below(26)) for c in flat[4:])
        flat = flat[:2] + digits_like(f"{98 - mod97(flat[:2] + '00' + body):02d}", flat[2:4]) + body
        out = iter(flat)
        return "".join(" " if c == " " else next(out) for c in value)
    keep = len(re.match(r"\+?", value).group()) and len(re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", value).group())
    keep = 1 if kind == "card" or kind == "phone" and len(value) > 9 and unicodedata.decimal(value[0], 1) == 0 else keep
    out = value[:keep] + "".join(like(c, s) for c in value[keep:])
    if kind == "card" and luhn(re.sub(r"\D", "", value)):
        out = next(out[:-1] + d for d in digits_like("0123456789", out) if luhn(re.sub(r"\D", "", out[:-1] + d)))
    return out


def one_case(word: str) -> str:
    """A name's word with a capital first letter only: the form by which it is one name."""
    return word[:1].upper() + word[1:].lower()


def detect(rows: DataFrame) -> DataFrame:
    """(id0, t, start, end, type, value) of the entities of (id0, t, text); names in one letter case."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id0", "t", "start", "end", "type", "value"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            found = [(i, t, a, b, kind, one_case(value) if kind in NAMES else value)
                     for i, t, text in zip(*(batch.column(c).to_pylist() for c in range(3)))
                     for a, b, kind, value in mentions(text)]
            cols = list(zip(*found)) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return rows.mapInArrow(run, "id0 long, t long, start int, end int, type string, value string")


def group_of(kind: str = "type") -> Column:
    """The type within which surrogates must differ: all names are one."""
    return F.when(F.col(kind).isin(*NAMES), F.lit("name")).otherwise(F.col(kind))


def entities_of(found: DataFrame) -> DataFrame:
    """(type, value, n): the distinct entities with their mentions; of a name, its gender over all documents."""
    counts = found.groupBy("type", "value").agg(F.count("*").alias("n"))
    m, f, given = (F.sum(F.when(F.col("type").isin(*kinds), F.col("n")).otherwise(0))
                   for kinds in (["name_m"], ["name_f"], NAMES[:3]))
    names = counts.where(F.col("type").isin(*NAMES)).groupBy("value").agg(
        m.alias("m"), f.alias("f"), given.alias("given"), F.sum("n").alias("n"))
    ends = {g: F.right("value", F.lit(1)).isin(*letters) for g, letters in LAST.items()}
    gender = (F.when(F.col("given") == 0, F.lit("surname")).when(F.col("m") > F.col("f"), F.lit("name_m"))
              .when(F.col("f") > F.col("m"), F.lit("name_f")).when(ends["f"], F.lit("name_f"))
              .when(ends["m"], F.lit("name_m")).otherwise(F.lit("name_n")))
    return counts.where(~F.col("type").isin(*NAMES)).unionByName(names.select(gender.alias("type"), "value", "n"))


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(type, value, surrogate): distinct surrogates, none of them a real value of its type."""
    entities = stored(entities.distinct(), "pii-entities")
    real = entities.select(group_of().alias("of"), F.col("value").alias("surrogate"))
    waiting, kept = entities, []

    def draw(attempt: int) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                b["surrogate"] = [surrogate(k, v, key, attempt) for k, v in zip(b["type"], b["value"])]
                yield b
        return run

    for attempt in range(ATTEMPTS):
        drawn = stored(waiting.mapInPandas(draw(attempt), "type string, value string, surrogate string")
                       .withColumn("of", group_of()), "pii-drawn")
        free = drawn.join(real, ["of", "surrogate"], "left_anti")
        if kept:
            free = free.join(reduce(DataFrame.unionByName, kept), ["of", "surrogate"], "left_anti")
        first = free.groupBy("of", "surrogate").agg(F.min(F.struct("value", "type")).alias("e"))
        kept.append(stored(first.select("of", "e.type", "e.value", "surrogate"), "pii-kept"))
        waiting = stored(waiting.join(kept[-1], ["type", "value"], "left_anti"), "pii-waiting")
        if not waiting.limit(1).count():
            return reduce(DataFrame.unionByName, kept).drop("of")
    raise RuntimeError("a format of the entities has no free surrogates left")


def with_surrogates(found: DataFrame, key: bytes) -> DataFrame:
    """The mentions with their surrogates. At most HOT values have over a part in HOT of all; theirs are broadcast."""
    entities = stored(entities_of(found), "pii-counts")
    least = max(HOT, found.count() // HOT)
    assigned = stored(assign(entities.select("type", "value"), key)
                      .withColumn("of", group_of()).join(entities, ["type", "value"])
                      .select("of", "value", "surrogate", "n"), "pii-assigned")
    keyed = found.withColumn("of", group_of())
    often = F.broadcast(assigned.where(F.col("n") > least).drop("n"))
    seldom = assigned.where(F.col("n") <= least).drop("n")
    return (keyed.join(often, ["of", "value"])
            .unionByName(keyed.join(often, ["of", "value"], "left_anti").join(seldom, ["of", "value"])))


def row_key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col), F.lit(-2 ** 63)), text_key(text_col)]


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text; ``replaced`` has the number of replacements."""
    docs = docs.drop("replaced")
    may = F.coalesce(F.col(text_col).rlike(COARSE), F.lit(False))
    id0, t, places = unused(docs, "_id0", "_t", "_spans")
    some = docs.where(may).select("*", *[k.alias(c) for k, c in zip(row_key(id_col, text_col), (id0, t))])
    found = stored(detect(some.select(F.col(id0).alias("id0"), F.col(t).alias("t"), F.col(text_col).alias("text"))
                          .dropDuplicates(["id0", "t"])), "pii-mentions")
    named = with_surrogates(found, key)
    spans = named.groupBy(F.col("id0").alias(id0), F.col("t").alias(t)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "surrogate", (F.col("of") == "name").alias("name")))).alias(places))     # one document's
    joined = some.join(spans, [id0, t], "left").drop(id0, t)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", replaced int"
    names = [*docs.columns, "replaced"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts, counts = [], []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                out, last = [], 0
                for x in spans or []:
                    loud = x["name"] and text[x["start"]:x["end"]].isupper()
                    out += [text[last:x["start"]], x["surrogate"].upper() if loud else x["surrogate"]]
                    last = x["end"]
                texts.append("".join(out) + text[last:])
                counts.append(len(spans or []))
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int32())], names=names)

    return (joined.select(*docs.columns, places).mapInArrow(run, schema)
            .unionByName(docs.where(~may).withColumn("replaced", F.lit(0))))
