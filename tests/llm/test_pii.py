"""No value is left, formats and kinds stay, equal stays equal and different stays different."""

import re

from pyspark.sql import functions as F

from ledgerline.llm import pii, text_queries  # noqa: F401
from ledgerline.llm.registry import QUERIES

KEY = "k"
EMAIL, PHONE = re.compile(r"[\w.+-]+@[a-zA-Z0-9.-]+"), re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}")
CARD, IP = re.compile(r"(?<!\d)\d{16}(?!\d)"), re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d)")


def shape(value):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", value)))


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("KINDS", F.lit(1))
    return {r.doc_id: r for r in pii.replace(docs, KEY).collect()}


def test_formats_and_coreference(spark):
    got = run(
        spark,
        [
            "Mail Ann.B7@Host9.example.com. or ann.b7@host9.EXAMPLE.com!", "+1 (017) 555-7713, +1 017 555 7713; (212) 555-0199",
            "4111 1111 1111 1111 and 4111111111111111 and 4111111111111112", "at 10.0.255.1.", "Dear Mrs. Maria Иванова and Mr John Smith; Mr Smith",
            None, "", "plain 12 text. 3.14 x@y", "é.55@mail2.example.com 10.0.255.1",
        ],
    )
    one, two = EMAIL.findall(got[0].text.replace("com.", "com").replace("com!", "com"))
    assert one.lower() == two.lower() and one.lower() != "ann.b7@host9.example.com" and re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z]\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.com", one)
    a, b = got[1].text.split(";")[0].split(", ")
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) != "10175557713" and shape(a) == "+0 (000) 000-0000" and a.startswith("+1 ")
    spaced, solid, other = got[2].text.split(" and ")
    luhn = lambda d: sum(sum(divmod(int(x) * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10
    assert spaced.replace(" ", "") == solid != other and luhn(solid) == 0 and luhn(other) != 0
    assert re.fullmatch(r"at \d+\.\d+\.\d+\.\d+\.", got[3].text) and "10.0.255.1" not in got[3].text
    women, men = [n.title() for n in pii.WOMEN], [n.title() for n in pii.MEN]
    found = re.fullmatch(r"Dear Mrs\. (\w+) ([А-Я][а-я]+) and Mr (\w+) (\w+); Mr (\w+)", got[4].text)
    assert found[1] in women and found[1] != "Maria" and found[3] in men and found[3] != "John" and found[4] == found[5] != "Smith"
    assert [got[i].text for i in (5, 6, 7)] == [None, "", "plain 12 text. 3.14 x@y"] and got[7].kinds == {}
    assert got[8].text.endswith(IP.findall(got[3].text)[0]) and got[8].text.startswith(("à", "á", "â", "ã", "ä", "å", "æ", "ç", "è", "é", "ê", "ë", "ì", "í", "î", "ï", "ð", "ñ", "ò", "ó", "ô", "õ", "ö", "ø", "ù", "ú", "û", "ü", "ý", "þ"))
    assert got[0].kinds == {"email": 2} and got[4].kinds == {"name": 3}


def test_different_values_stay_different(spark):
    texts = [f"a{i}@b.example.com {i // 250}.1.1.{i % 250}" for i in range(1500)]
    got = run(spark, texts)
    assert len({EMAIL.findall(r.text)[0] for r in got.values()}) == 1500
    assert len({IP.findall(r.text)[0] for r in got.values()}) == 1500


def test_clashes_are_resolved(spark):
    """So small a format that first surrogates surely are values themselves."""
    texts = [f"{a}@q.x.com" for a in "abcdefghijklm"] + ["{}@q.x.com and {}@q.x.com".format(*p) for p in ("ab", "ma")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    values = docs.select(F.explode(F.split("text", " and ")).alias("value")).distinct()
    hosts = values.select(F.lit("z@q.x.com").alias("value")).limit(1)
    first = pii.surrogate(F.lit("z@q.x.com"), KEY, F.lit(0))
    planted = values.unionByName(hosts).unionByName(hosts.select(first.alias("value")))
    bad = {r.entity: r.attempt for r in pii.clashes(planted, KEY).collect()}
    assert bad.get("email:z@q.x.com", 0) >= 1
    got = {r.doc_id: EMAIL.findall(r.text) for r in pii.replace(docs, KEY).collect()}
    assert got[13] == [got[0][0], got[1][0]] and got[14] == [got[12][0], got[0][0]]


def test_query(spark, small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_surrogates"](spark, small).collect()}
    assert got.keys() == docs.keys()
    everything = "\n".join(r.text or "" for r in got.values())
    pairs = set()
    for i, text in docs.items():
        for pattern in (EMAIL, PHONE, CARD, IP):
            old, new = pattern.findall(text), pattern.findall(got[i].text or "")
            assert len(old) == len(new)
            pairs |= set(zip(old, new, strict=True))
        if not any(p.search(text) for p in (EMAIL, PHONE, CARD, IP)):
            assert got[i].text == text or got[i].n_entities
    assert pairs and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    assert not any(a in everything for a, _ in pairs)


def test_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(1, "a@b.example.com"), (1, "a@b.example.com"), (None, "a@b.example.com")], "doc_id long, text string")
    assert len({r.text for r in pii.replace(docs, KEY).collect()}) == 1 and pii.replace(docs, KEY).count() == 3
    assert pii.replace(docs.limit(0), KEY).count() == 0


def test_single_digits_are_searched(spark):
    """No two digits side by side: addresses of one-digit octets, a card written digit by digit."""
    card = "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"
    got = run(spark, ["ask 8.8.8.8 or 1.1.1.1", "ask 8.8.8.8 of 2024", f"card {card}", f"card {card.replace(' ', '-')} end"])
    assert IP.findall(got[0].text)[0] == IP.findall(got[1].text)[0] != "8.8.8.8" and "1.1.1.1" not in got[0].text
    digits = [re.sub(r"\D", "", got[i].text) for i in (2, 3)]
    assert digits[0] == digits[1] != card.replace(" ", "") and len(digits[0]) == 16
    assert [got[i].kinds for i in range(4)] == [{"ip": 2}, {"ip": 1}, {"card": 1}, {"card": 1}]


def test_full_formats(spark, monkeypatch):
    """All names of a list, all names of one vowel, and a name of letters that no alphabet holds."""
    monkeypatch.setattr(pii, "MOST_ROUNDS", 3)
    men = [n.title() for n in pii.MEN]
    got = run(spark, [f"Mr {n}" for n in men] + [f"Mrs {n}" for n in "AEIOU"] + ["Herr Մ", "Herr Ն"])
    new = [got[i].text.split(" ")[1] for i in range(len(got))]
    assert len({n.lower() for n in new}) == len(new) == 30
    assert not any(old in got[i].text for i, old in enumerate(men)) and set(new[:23]) == set(men)
    assert all(a != b for a, b in zip("AEIOU", new[23:28], strict=True)) and not {"Մ", "Ն"} & set(new)


def test_first_surrogates_that_meet(spark):
    """A name moved onto a listed one's surrogate, and an address with a leading zero."""
    shaped = spark.range(17 * 17 * 5 * 5 * 4).select(
        F.concat(*[F.substring(F.lit(letters), (F.col("id") / n).cast("int") % len(letters) + 1, F.lit(1)) for letters, n in
                   (("BCDFGHJKLMNPRSTVZ", 1), ("aeiou", 17), ("bcdfghjklmnprstvz", 85), ("bcdfghjklmnprstvyz", 85 * 17))]).alias("name")
    ).distinct()
    onto = {n: n.title() for n in pii.WOMEN + pii.MEN}
    moved = shaped.select("name", F.lower(F.substring(pii.surrogate(F.concat(F.lit("Mr "), "name"), KEY, F.lit(0)), 4, 9)).alias("new"))
    moved = moved.where(~F.lower("name").isin(list(onto)) & F.col("new").isin(list(onto))).orderBy("name").limit(1).collect()
    listed = spark.createDataFrame([(n,) for n in onto.values()], "name string")
    other = listed.where(F.lower(F.substring(pii.surrogate(F.concat(F.lit("Mr "), "name"), KEY, F.lit(0)), 4, 9)) == moved[0].new).collect()[0].name
    texts = [f"Mr {moved[0].name}", f"Mr {other}", "10.0.0.1", "010.0.0.1"]
    got = run(spark, [*texts, " and ".join(texts[:2])])
    assert len({got[i].text.lower() for i in range(4)}) == 4 and not {got[i].text for i in range(4)} & set(texts)
    assert got[4].text == f"{got[0].text} and {got[1].text}"


def test_names_of_many_words(spark):
    texts = [
        "Señor Carlos García López came", "Mrs Anna Maria Smith, Herr Karl von Braun; Frau von der Leyen.", "Señora García López",
        "Señora Ana García López", "Mr Smith Mrs. Jones", "Mr " + "Xy " * 20_000 + "end", "Mr von nobody",
    ]
    got = {i: r.text for i, r in run(spark, texts).items()}
    assert not any(re.search(r"Carlos|García|López|Anna|Maria|Smith|Karl|Braun|Leyen|Ana|Jones|Xy", t) for t in got.values())
    one, two = got[2].split(" ")[1:], got[3].split(" ")[1:]
    assert one == two[1:] == got[0].split(" ")[2:4] and got[0].endswith(" came")
    assert re.fullmatch(r"Mrs \w+ \w+ \w+, Herr \w+ von \w+; Frau von der \w+\.", got[1])
    assert re.fullmatch(r"Mr \w+ Mrs\. \w+", got[4]) and got[5].endswith(" end") and got[6] == texts[6]
