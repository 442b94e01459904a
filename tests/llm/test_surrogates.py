import re

from pyspark.sql import functions as F

from headway.llm import surrogates as X
from headway.llm.common import table
from headway.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
KEY = b"test"

TEXT = ("Write to Mr. John Smith (john.smith@mail.example.com, +1 (657) 555-5101). Smith said JOHN. Card 4111 1111 1111 1111, "
        "IBAN DE89 3704 0044 0532 0130 00, ip 61.131.143.218, ssn 123-45-6789. Frau Анна Петрова, Mme Dupont-Lévy. é")


def kinds(text):
    return [(k, v) for _, _, k, v in X.mentions(text)]


def test_detection():
    got = kinds(TEXT)
    assert [k for k, _ in got] == ["name_m", "surname", "email", "phone", "surname", "card", "iban", "ip", "ssn",
                                   "name_f", "surname", "name_f", "surname"]
    assert kinds("build 0641917ea4e9 v1.2.3 on 2024-01-24, 999.1.1.1 and 1234567") == []


def test_surrogates_keep_the_format():
    for kind, value in kinds(TEXT):
        s = {X.surrogate(kind, value, KEY, a) for a in range(5)}
        assert len(s) == 5 and value not in s
        for x in s:
            if kind in ("email", "phone", "ssn", "card", "iban"):
                assert re.sub(r"\w", "w", x) == re.sub(r"\w", "w", value)
            if kind == "card":
                assert x[0] == "4" and X.luhn(re.sub(r"\D", "", x))
            if kind == "iban":
                assert X.valid("iban", x) and x[:2] == "DE"
            if kind == "ip":
                assert X.valid("ip", x)
            if kind == "phone":
                assert x.startswith("+1 (")
            if kind.startswith(("name", "sur")):
                assert X.script_of(x[0]) == X.script_of(value[0]) and x[0].isupper()
            if kind == "name_f" and X.script_of(value[0])[0] == "a":
                assert x.endswith("a")


def test_coreference_distinctness_nulls_and_repeats(spark, docs_of):
    rows = [(1, TEXT), (2, "again john.smith@mail.example.com"), (3, None), (4, ""), (5, "clean text"), (1, TEXT),
            (None, "ip 61.131.143.218"), (6, "x" * 100_000 + " 61.131.143.218")]
    docs = docs_of(rows).withColumnRenamed("source", "replaced")
    got = X.replace_entities(docs, KEY).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[3].text is None and by[4].text == "" and by[5].text == "clean text" and by[5].replaced == 0
    assert not any(v in (r.text or "") for r in got for _, v in kinds(TEXT))
    mail = re.search(r"\S+@\S+", by[2].text).group()
    assert mail in by[1].text
    name = re.match(r"Write to Mr\. (\w+) (\w+) ", by[1].text)
    assert f"). {name.group(2)} said JOHN." in by[1].text
    assert by[None].text[3:] == by[6].text[-len(by[None].text) + 3:]
    assert X.replace_entities(docs.limit(0), KEY).collect() == []


def test_collisions_are_drawn_again(spark):
    values = [f"{i:03d}-{i % 90 + 10:02d}-{i % 9000 + 1000:04d}" for i in range(300)]
    # two-digit numbers: a narrow format, so draws collide
    rows = [("ssn", v) for v in values] + [("phone", f"{i:02d}") for i in range(25)]
    got = X.assign(spark.createDataFrame(rows, "type string, value string"), KEY).collect()
    assert len(got) == len(rows) == len({(r.type, r.surrogate) for r in got})
    assert not {(r.type, r.surrogate) for r in got} & set(rows)


def test_registered_query_equals_entity_by_entity_replacement(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in QUERIES["op1_pii_surrogates"](spark, SF).collect()}
    assert set(got) == set(docs)
    pairs: dict[tuple[str, str], set[str]] = {}
    for i, text in docs.items():
        found = X.mentions(text)
        assert got[i].replaced == len(found)
        if not found:
            assert got[i].text == text
        pattern, last = "", 0
        for a, b, _, _ in found:
            pattern += re.escape(text[last:a]) + "(.+?)"
            last = b
        m = re.fullmatch(pattern + re.escape(text[last:]), got[i].text, re.S)
        assert m
        for (_, _, kind, value), new in zip(found, m.groups()):
            pairs.setdefault((kind, value), set()).add(new)
    assert all(len(s) == 1 for s in pairs.values())
    new = [(k, *s) for (k, _), s in pairs.items()]
    assert len(new) == len(set(new)) and not set(new) & set(pairs)
    assert len(pairs) > 10
    assert spark.read.parquet(f"{SF}/documents.parquet").where(F.col("text").rlike(X.COARSE)).count() < len(docs)


def test_digits_of_any_script_are_found_and_stay_in_it(spark):
    wide = "４１１１ １１１１ １１１１ １１１１"
    rows = [(1, "ring +٤٩ ١٢٣٤٥٦٧٨ now"), (2, f"card {wide}"), (3, "ip ١٠.٢٣.٤٥.٦٧ up"), (4, "IBAN DE٨٩ ٣٧٠٤ ٠٠٤٤ ٠٥٣٢ ٠١٣٠ ٠٠")]
    got = {r.doc_id: r for r in X.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    for i, text in rows:
        found = X.mentions(text)
        assert len(found) == 1 and got[i].replaced == 1 and found[0][3] not in got[i].text
        assert sorted(c for c in got[i].text if c.isdecimal() and c.isascii()) == []
    assert X.luhn("".join(str(int(c)) for c in got[2].text if c.isdecimal()))
    assert X.mod97(got[4].text.removeprefix("IBAN ").replace(" ", "")) == 1


def test_internal_names_clash_with_no_column(spark):
    df = spark.createDataFrame([(1, "a@b.example", "t", 7, "s", "x", "y", "z")],
                               "doc_id long, text string, _t string, _id0 int, _spans string, type string, value string, surrogate string")
    r = X.replace_entities(df, KEY).first()
    assert r.replaced == 1 and "a@b.example" not in r.text
    assert (r._t, r._id0, r._spans, r.type, r.value, r.surrogate) == ("t", 7, "s", "x", "y", "z")


def test_one_surrogate_and_gender_for_a_name_in_all_documents(spark):
    texts = ["Dr. Anna Schmidt met Frau Anna Schmidt.", "Ms Anna was there, Mr ANNA SCHMIDT too.", "Mrs Kim Lee called.",
             "Prof. Kim Lee and Dr Robin Lee", "Dr Sasha Ford", "My name is Kim Ford, said Dr. Elena Ford."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in X.replace_entities(df, KEY).collect()}
    anna, schmidt = re.fullmatch(r"Dr\. (\w+) (\w+) met Frau \1 \2\.", got[0]).groups()
    assert re.fullmatch(rf"Ms {anna} was there, Mr {anna.upper()} {schmidt.upper()} too\.", got[1])
    kim, lee = re.fullmatch(r"Mrs (\w+) (\w+) called\.", got[2]).groups()
    robin = re.fullmatch(rf"Prof\. {kim} {lee} and Dr (\w+) {lee}", got[3]).group(1)
    sasha, ford = re.fullmatch(r"Dr (\w+) (\w+)", got[4]).groups()
    elena = re.fullmatch(rf"My name is {kim} {ford}, said Dr\. (\w+) {ford}\.", got[5]).group(1)
    names = [anna, schmidt, kim, lee, robin, sasha, ford, elena]
    assert len(set(names)) == len(names) and not set(names) & set(re.findall(r"\w+", " ".join(texts)))
    assert all(x.endswith("a") for x in (anna, kim, sasha, elena)) and robin[-1] in "eiy"


def test_more_formats(spark):
    rows = [(1, "host 2001:db8:85a3:0:0:8a2e:370:7334 up"), (2, "via FE80::1FF:FE23:4567 and std::abs, a::b, abc::def"),
            (3, "ring 030 1234567 or 0171/1234567, 020 7946 0958"), (4, "at 12:30:45 on 01-02-2024, 00:1a:2b:3c:4d:5e, 0001 2345")]
    got = {r.doc_id: r for r in X.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    assert [got[i].replaced for i in (1, 2, 3, 4)] == [1, 1, 3, 0] and got[4].text == rows[3][1]
    assert re.fullmatch(r"host 2001(:[0-9a-f]{1,4}){7} up", got[1].text) and "85a3" not in got[1].text
    assert re.fullmatch(r"via FE80::[0-9A-F]{3}:[0-9A-F]{4}:[0-9A-F]{4} and std::abs, a::b, abc::def", got[2].text)
    assert re.fullmatch(r"ring 0\d\d \d{7} or 0\d{3}/\d{7}, 0\d\d \d{4} \d{4}", got[3].text) and "1234567" not in got[3].text


def test_frequent_values_are_split_from_the_rest(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT", 3)
    rows = [(i, f"mail a@b.example, b{i % 4}@b.example and {i}@c.example, Mr Tom Jones") for i in range(20)] + [(99, "Tom Jones")]
    got = {r.doc_id: r for r in X.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), KEY).collect()}
    assert got[99].replaced == 0 and all(got[i].replaced == 5 for i in range(20))
    first = [re.findall(r"[\w.]+@\S+\w", got[i].text) for i in range(20)]
    assert len({f[0] for f in first}) == 1 and len({f[1] for f in first}) == 4 and len({f[2] for f in first}) == 20
    assert len({got[i].text.rsplit(" ", 2)[1] for i in range(20)}) == 1
