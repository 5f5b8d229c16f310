"""Personal data replaced by surrogates of the same kind, gender, script and format.

Found are email addresses, phone and card numbers, IP addresses, and names after a title. A surrogate
is a keyed bijection of the value within its format: each symbol moves inside its own
alphabet (digits, letters of one script and case, vowels and consonants of names) by a keyed hash of the symbols before
it, once forwards and once backwards. So different values of one format never share a surrogate, and equal
values always do, in whatever case or punctuation they are written.
Names run on over all capitalised words behind a title and the particles before and between them. Titles and
particles stay, and given names are replaced by others of their gender.

Collision check: a surrogate may not be a value that occurs itself, nor that of another value (formats may meet:
a listed name and one of its shape). All distinct values of the table are compared with all surrogates, and the
surrogates with each other; those that clash get another key, until none does. Where a format is too full for
that (all names of a list occur), its values keep the first key: a permutation, in which a surrogate may be another's
value but is never its own and nobody else's. What even that leaves as it is gets a longer surrogate, so no format
runs out. Documents are rewritten where they are read; only clashing values are joined to them.

Null texts stay null. Every row gives one row; rows are told apart by id and text. Columns that carry
an output's name are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, let, quoted, staged, without

# Alphabets within which symbols move; given names and titles by gender.
DIGITS = "0123456789"
ALPHABETS = [
    DIGITS,
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
]
NAME_ALPHABETS = [
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâãäåæèéêëìíîïòóôõöøùúûüý",
    "çðñþ",
    "аеиоуыэюя",
    "бвгджзклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
]
WOMEN = ["mary", "anna", "emma", "laura", "julia", "sarah", "maria", "clara", "elena", "sofia", "lucia", "marie", "camille", "ingrid", "helga", "greta", "susan", "linda", "nina", "olga", "irene", "alice", "carmen"]
MEN = ["john", "peter", "james", "thomas", "paul", "david", "martin", "carlos", "diego", "pablo", "jean", "pierre", "louis", "hans", "karl", "jürgen", "robert", "henry", "ivan", "oleg", "george", "frank", "miguel"]
TITLES = "Mrs|Mr|Ms|Miss|Herr|Frau|Señora|Señor|Sra|Sr|Monsieur|Madame|Mme"
PARTICLES = "von|vom|zu|zum|zur|van|ter|ten|den|der|dem|des|de|del|della|di|da|do|dos|das|du|la|las|le|les|los|el|al|bin|ibn"

# The patterns, in order of preference where two begin at one place.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
IP = r"(?<![\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"
PHONE = r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}|(?<![0-9])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
BETWEEN = rf"(?: (?:{PARTICLES})(?= ))*+ "
#: Possessive, so that no long run of capitalised words is walked by recursion.
NAME = rf"\b(?:{TITLES})\.?{BETWEEN}\p{{Lu}}[\p{{L}}'-]*+(?:{BETWEEN}(?!(?:{TITLES})\b)\p{{Lu}}[\p{{L}}'-]*+)*+"
#: Words of a name that stay: its title, and particles in small letters.
STAYS = rf"\A(?:(?iu:{TITLES})\.?|{PARTICLES})\z"
ENTITY = f"{EMAIL}|{IP}|{PHONE}|{CARD}|{NAME}"
#: Cheap test that a text may hold an entity at all: true of every text that ENTITY matches in.
HINT = rf"@|[0-9][ .-]?[0-9]|\b(?:{TITLES})\b"
#: Rounds of new keys for clashing values, each clashing by chance with few of the rest; then as many of longer surrogates.
MOST_ROUNDS = 30
#: Documents with clashing values that are sent to every executor; more are shuffled.
BROADCAST_CLASHES = 100_000


def _moved(char: Column, shift: Column, alphabets: list[str]) -> Column:
    """The symbol ``shift`` places on in its alphabet; one of no alphabet stays."""
    every = [own for letters in alphabets for own in dict.fromkeys((letters, letters.upper()))]
    starts = [sum(map(len, every[:i])) for i, own in enumerate(every) for _ in own]
    sizes = [len(own) for own in every for _ in own]
    table = lambda numbers: F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")

    def of(at):
        start, size = F.get(table(starts), at - 1), F.get(table(sizes), at - 1)
        return F.when(at > 0, F.substring(F.lit("".join(every)), (start + F.pmod(at - 1 - start + shift, size) + 1).cast("int"), F.lit(1))).otherwise(char)

    return let(F.instr(F.lit("".join(every)), char), of)


def _turned(value: Column, key: Column, alphabets: list[str]) -> Column:
    """One pass from left to right; case makes no difference to the moves."""

    def of(v: Column) -> Column:
        def step(out, i):
            char = F.substring(v, i, F.lit(1))
            shift = F.xxhash64(key, F.lower(F.substring(v, F.lit(1), i - 1)), i)
            return F.concat(out, _moved(char, F.pmod(shift, F.lit(1 << 20)), alphabets))

        return F.when(F.length(v) > 0, F.aggregate(F.sequence(F.lit(1), F.length(v)), F.lit(""), step)).otherwise(v)

    return let(value, of)


def _bijection(value: Column, key: Column, alphabets: list[str]) -> Column:
    forth = _turned(value, F.concat(key, F.lit(">")), alphabets)
    return F.reverse(_turned(F.reverse(forth), F.concat(key, F.lit("<")), alphabets))


def _luhn(digits: Column) -> Column:
    """Check digit that would follow ``digits``."""

    def weight(d, i):
        n = d.cast("int") * F.when((F.length(digits) - i) % 2 == 1, F.lit(2)).otherwise(F.lit(1))
        return n - F.when(n > 9, F.lit(9)).otherwise(F.lit(0))

    parts = F.transform(F.split(digits, ""), weight)
    return F.pmod(10 - F.aggregate(parts, F.lit(0), lambda s, n: s + n) % 10, F.lit(10))


def _digits_in(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced in turn."""
    gaps = F.split(value, "[0-9]", -1)
    both = F.zip_with(gaps, F.split(digits, ""), lambda gap, d: F.concat(gap, F.coalesce(d, F.lit(""))))
    return F.array_join(both, "")


def kind_of(value: Column) -> Column:
    whole = lambda pattern: value.rlike(rf"\A(?:{pattern})\z")
    return (
        F.when(F.instr(value, "@") > 0, F.lit("email"))
        .when(whole(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"), F.lit("ip"))
        .when(value.rlike(r"\A\p{L}"), F.lit("name"))
        .when(F.substring(value, 1, 1) == "+", F.lit("phone"))
        .when(F.length(F.regexp_replace(value, "[^0-9]", "")) >= 13, F.lit("card"))
        .otherwise(F.lit("phone"))
    )


def canonical(value: Column) -> Column:
    """What all spellings of one entity share, its kind in front."""

    def of(v):
        digits = F.regexp_replace(v, "[^+0-9]", "")
        # particles stay and capitalised words don't, so "von" is told from "Von"
        bare = F.regexp_replace(F.lower(F.regexp_replace(v, f" ({PARTICLES})(?= )", " =$1")), rf"\A(?:{TITLES.lower()})\.? ", "")
        plain = lambda k: F.when(k.isin("phone", "card"), digits).when(k == "name", bare).otherwise(F.lower(v))
        return let(kind_of(v), lambda k: F.concat(k, F.lit(":"), plain(k)))

    return let(value, of)


def surrogate(value: Column, key: str, attempt: Column) -> Column:
    """Replacement of one detected value; attempts after ``MOST_ROUNDS`` make it longer by one symbol or more each."""
    keyed = F.concat(F.lit(key + "#"), attempt.cast("string"))
    longer = lambda v, kind: F.when(attempt > MOST_ROUNDS, _longer(v, kind, (attempt - MOST_ROUNDS).cast("int"))).otherwise(v)
    return let(keyed, lambda k: let(value, lambda v: let(kind_of(v), lambda kind: let(longer(v, kind), lambda x: _surrogate(x, kind, k)))))


def _longer(value: Column, kind: Column, extra: Column) -> Column:
    """``value`` with ``extra`` symbols more, or words that many times longer; words without a letter that moves are drawn
    anew. Addresses of machines stay: their format is never full."""

    def word(w):
        drawn = F.initcap(F.substring(F.translate(F.md5(F.lower(w).cast("binary")), DIGITS + "abcdef", "ghijklmnopabcdef"), F.lit(1), extra + 5))
        moves = F.lower(w).rlike(f"[{''.join(NAME_ALPHABETS)}]")
        longer = F.when(moves, F.concat(w, F.repeat(F.lower(w), extra))).otherwise(drawn)
        return F.when(w.rlike(STAYS), w).otherwise(longer)

    return (
        F.when(kind == "name", F.array_join(F.transform(F.split(value, " "), word), " "))
        .when(kind == "email", F.concat(F.substring_index(value, "@", 1), F.repeat(F.lit("a"), extra), F.lit("@"), F.substring_index(value, "@", -1)))
        .when(kind == "ip", value)
        .otherwise(F.concat(value, F.repeat(F.lit("0"), extra)))
    )


def _surrogate(value: Column, kind: Column, keyed: Column) -> Column:
    def email(v):
        local, last = F.substring_index(v, "@", 1), F.substring_index(v, ".", -1)
        host = F.regexp_extract(v, "@(.*[.])", 1)
        return F.concat(_bijection(local, F.concat(keyed, F.lit("local"), F.lower(host)), ALPHABETS), F.lit("@"), _bijection(host, F.concat(keyed, F.lit("host")), ALPHABETS), last)

    def ip(v):
        octets = F.split(v, r"\.").cast("array<int>")
        sound = F.forall(octets, lambda n: n <= 255)

        def once(numbers, tag):
            def step(out, i):
                seen = F.array_join(F.slice(numbers, F.lit(1), i - 1).cast("array<string>"), ".")
                return F.concat(out, F.array(F.pmod(F.get(numbers, i - 1) + F.pmod(F.xxhash64(keyed, F.lit(tag), seen, i), F.lit(256)), F.lit(256)).cast("int")))

            return F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.array().cast("array<int>"), step)

        moved = F.reverse(let(F.reverse(let(octets, lambda n: once(n, "ip>"))), lambda n: once(n, "ip<")))
        return F.when(sound, F.array_join(moved.cast("array<string>"), ".")).otherwise(_digits_in(v, _bijection(F.regexp_replace(v, "[^0-9]", ""), keyed, [DIGITS])))

    def phone(v):
        code = F.regexp_extract(v, r"\A\+([0-9]{1,3})(?![0-9])", 1)
        rest = F.regexp_replace(v, "[^0-9]", "").substr(F.length(code) + 1, F.length(v))
        return _digits_in(v, F.concat(code, _bijection(rest, F.concat(keyed, F.lit("phone"), code), [DIGITS])))

    def card(v):
        digits = F.regexp_replace(v, "[^0-9]", "")

        def of(d):
            front, last = F.substring(d, F.lit(1), F.length(d) - 1), F.substring(d, -1, 1).cast("int")
            new = let(_bijection(front, F.concat(keyed, F.lit("card"), F.length(d).cast("string")), [DIGITS]), lambda x: F.concat(x, F.pmod(_luhn(x) + last - _luhn(front), F.lit(10)).cast("string")))
            return new

        return _digits_in(v, let(digits, of))

    def name(v):
        def token(t):
            low = F.lower(t)
            out = F.when(t.rlike(STAYS), t)
            for names in (WOMEN, MEN):
                listed = F.array(*map(F.lit, names))
                turn = F.pmod(F.xxhash64(keyed, F.lit("given")), F.lit(len(names) - 1)) + 1
                other = F.get(listed, F.pmod(F.array_position(listed, low) - 1 + turn, F.lit(len(names))).cast("int"))
                out = out.when(F.array_contains(listed, low), F.when(t == F.upper(t), F.upper(other)).otherwise(F.initcap(other)))
            return out.otherwise(_bijection(t, F.concat(keyed, F.lit("name")), NAME_ALPHABETS))

        return F.array_join(F.transform(F.split(v, " "), token), " ")

    return (
        F.when(kind == "email", email(value))
        .when(kind == "ip", ip(value))
        .when(kind == "phone", phone(value))
        .when(kind == "card", card(value))
        .otherwise(name(value))
    )


def _matches(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def clashes(values: DataFrame, key: str) -> DataFrame:
    """``(entity, attempt)`` of the values whose first surrogate is itself a value of ``values(value)`` or that of another.

    Of values with one first surrogate that with most listed names, then the least, keeps it.

    A new key's surrogate may be neither a value nor a surrogate of the first key, nor one that another clashing
    value got. Spellings of one entity count as one. Values for which no round finds one keep the first key (see above),
    which differs from all the others'; they are not listed.
    """
    known = values.groupBy(canonical(F.col("value")).alias("entity")).agg(F.min("value").alias("value"))
    known = staged(known.select("entity", "value", canonical(surrogate(F.col("value"), key, F.lit(0))).alias("new")), "entities")
    taken = known.select("entity").unionByName(known.select(F.col("new").alias("entity")))
    words = F.split(F.regexp_replace("entity", r"\A[a-z]+:", ""), " ")
    unlisted = -F.size(F.filter(words, lambda w: w.isin(WOMEN + MEN)))
    shared = known.groupBy("new").agg(F.count("*").alias("n"), F.min(F.struct(unlisted.alias("unlisted"), "entity")).alias("keeps"))
    shared = broadcast_if_small(staged(shared.where("n > 1").select("new", "keeps.entity"), "shared"), BROADCAST_CLASHES)
    later = known.join(shared.withColumnRenamed("entity", "keeper"), "new").where("entity != keeper").select("entity", "value", F.lit(True).alias("later"))
    open_ = known.join(known.select(F.col("entity").alias("new")), "new", "left_semi").select("entity", "value", F.lit(False).alias("later"))
    open_ = open_.unionByName(later).groupBy("entity", "value").agg(F.max("later").alias("later"))
    done = None
    for attempt in range(1, 2 * MOST_ROUNDS + 1):
        if attempt == MOST_ROUNDS + 1:
            open_ = open_.where(F.col("later") | (canonical(surrogate(F.col("value"), key, F.lit(0))) == F.col("entity")))
        tried = staged(open_.withColumn("new", canonical(surrogate(F.col("value"), key, F.lit(attempt)))), "clashes")
        if tried.isEmpty():
            break
        free = tried.join(taken.select(F.col("entity").alias("new")), "new", "left_anti")
        first = free.groupBy("new").agg(F.min("entity").alias("entity"))
        good = staged(first.select("entity", F.lit(attempt).alias("attempt"), "new"), "resolved")
        done = good if done is None else done.unionByName(good)
        taken = taken.unionByName(good.select(F.col("new").alias("entity")))
        open_ = tried.join(good, "entity", "left_anti").select("entity", "value", "later")
    else:
        raise ValueError("too few surrogates of some format are left")
    return known.select("entity", F.lit(0).alias("attempt")).limit(0) if done is None else done.select("entity", "attempt")


def replace(docs: DataFrame, key: str, id: str = "doc_id", text: str = "text", kinds: str = "kinds") -> DataFrame:
    """``docs`` with surrogates in the text, and ``kinds``: how many entities of each kind it held."""
    kept = without(docs, kinds)
    values = docs.select(F.explode_outer(_matches(F.col(text))).alias("value")).where("value is not null").distinct()
    bad = staged(clashes(staged(values, "values"), key), "clashing")
    place = F.struct(quoted(id).alias("id"), F.xxhash64(quoted(text)).alias("h"))
    odd = docs.select(place.alias("__place"), F.explode_outer(F.array_distinct(_matches(F.col(text)))).alias("value"))
    odd = odd.where("value is not null").withColumn("entity", canonical(F.col("value"))).join(broadcast_if_small(bad, BROADCAST_CLASHES), "entity")
    odd = odd.select("__place", "entity", "attempt").distinct()
    odd = odd.groupBy("__place").agg(F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("__attempts"))
    odd = broadcast_if_small(staged(odd, "documents"), BROADCAST_CLASHES)

    rows = kept.select("*", _matches(F.col(text)).alias("__found"), place.alias("__own"))
    rows = rows.join(odd, rows["__own"].eqNullSafe(odd["__place"]), "left")
    attempt = lambda v: F.coalesce(F.element_at("__attempts", canonical(v)), F.lit(0))
    pieces = F.zip_with(
        F.split(text, ENTITY, -1), "__found", lambda gap, v: F.concat(gap, F.when(v.isNull(), F.lit("")).otherwise(surrogate(v, key, attempt(v))))
    )
    new = F.when(F.size("__found") > 0, F.array_join(pieces, "")).otherwise(quoted(text))
    names = F.transform("__found", kind_of)
    counts = F.map_from_entries(
        F.transform(F.array_distinct(names), lambda k: F.struct(k.alias("kind"), F.size(F.filter(names, lambda n: n == k)).alias("n")))
    )
    counted = F.when(F.size("__found") > 0, counts).otherwise(F.map_from_entries(F.array().cast("array<struct<kind:string,n:int>>")))
    return rows.select(*[new.alias(c) if c == text else quoted(c) for c in kept.columns], counted.alias(kinds))
