"""Personal data replaced by surrogates; DataFrame functions only.

Detected entities (e-mail, phone, IP address, payment card, social security number, person after a title or with a known given name) get keyed
replacements of their own type. A replacement depends only on key, kind and normal form, so the same entity has the same one in
every document, whatever its format. It keeps the format: case, punctuation and digit groups, country code, first card digit and whether
the check digit fits, letters for letters and digits for digits in an address, script (Latin, Cyrillic, Greek) of a name, and the
gender of a given name by its ending, as told by the title of the mention (Mr Alex Berg, Mrs Alex Berg) or else by a list of given names.

Digits go through a keyed Feistel permutation, which cannot collide; the others are keyed hashes, which can. So all distinct entities of the
corpus are checked, persons by the words of their names: of those with one replacement all but the first, and all e-mail addresses and name words whose
replacement occurs in the corpus, try again with the next attempt number until none is left. Numbers (phone, IP, card, social security) are permuted among all
numbers of their form, so theirs can be a number in use somewhere, in the corpus too; e-mail surrogates end in a reserved domain. Every attempt makes e-mail addresses and name words longer, so there are
enough for any corpus. A word has one attempt number wherever it stands, so a surname alone or with any given name has one surrogate.
Only the entities and words that needed it are matched with the documents, by a join.

Defined results: null text stays null without entities; rows are replaced one by one, so repeated rows and identifiers need no
rule; other columns pass through; on an empty table nothing happens. The key is a secret of the caller; without it nobody can
reproduce the surrogates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.session import materialize

# Titles and given names by which persons and their gender are known; T neutral.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Sra", "Г-жа"), "n": ("Dr", "Prof")}
GIVEN = {"m": ("John", "James", "Robert", "Michael", "David", "Thomas", "Hans", "Peter", "Klaus", "Pierre", "Jean", "Luis", "Carlos", "Juan", "Иван", "Алексей", "Γιώργος"),
         "f": ("Mary", "Anna", "Linda", "Susan", "Sarah", "Karen", "Julia", "Petra", "Claire", "Marie", "Carmen", "Lucia", "Elena", "Ольга", "Анна", "Мария", "Ελένη")}
# The patterns of entities, in the order in which they are tried at a place.
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NAME_WORD = r"\p{Lu}\p{L}+(?:['’-]\p{L}+)?"
# Groups without a bound are possessive: Java's regex would match others by recursion, which a few kB of text would drive out of the stack.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.(?=[A-Za-z]{2}|[A-Za-z0-9-]++\.))++[A-Za-z]{2,}"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<!\d)(?:(?:\d{4}[ -]){3}\d{4}|\d{13,19})(?!\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4})(?!\d)"
TITLE = "|".join(t for titles in TITLES.values() for t in titles)
PERSON = (rf"(?<!\p{{L}})(?:(?:{TITLE})\.? {NAME_WORD}(?: {NAME_WORD})?|(?:{'|'.join(g for names in GIVEN.values() for g in names)}) {NAME_WORD})")
ENTITY = "|".join((EMAIL, IP, SSN, CARD, PHONE, PERSON))
TRIGGER = rf"[0-9@]|(?<!\p{{L}})(?:{'|'.join([TITLE, *(g for names in GIVEN.values() for g in names)])})[. ]"
KINDS = ("email", "phone", "ip", "card", "ssn", "person")

# Syllables of surrogate names by script, and endings of male and female given names and of surnames.
SYLLABLES = {"latin": "ba be bi bo da de di do fa fe ga go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ta to".split(),
             "cyrillic": "ба бе би бо да де ди до ва ве га го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре та то".split(),
             "greek": "βα βε βι βο δα δε δι δο φα φε γα γο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε τα το".split()}
ENDINGS = {"latin": {"m": "n", "f": "na", "n": "s"}, "cyrillic": {"m": "н", "f": "на", "n": "в"}, "greek": {"m": "ς", "f": "να", "n": "ς"}}

ENTITIES = "array<struct<raw:string,kind:string,norm:string>>"


def literal(values) -> Column:
    return F.array(*map(F.lit, values))


def kind_of(raw: Column) -> Column:
    return (F.when(F.contains(raw, F.lit("@")), "email").when(raw.rlike(rf"^\p{{L}}"), "person").when(raw.rlike(rf"^(?:{IP})$"), "ip")
            .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(raw.rlike(rf"^(?:{CARD})$"), "card").otherwise("phone"))


def names_of(raw: Column) -> Column:
    """A mention without its title."""
    return F.regexp_replace(raw, rf"^(?:{TITLE})\.? ", "")


def normal(raw: Column, kind: Column) -> Column:
    """The same for every spelling of an entity."""
    digits = F.regexp_replace(raw, r"\D", "")
    return (F.when(kind == "email", F.lower(raw)).when(kind == "person", F.lower(names_of(raw))).when(kind == "ip", raw)
            .when((kind == "phone") & F.startswith(raw, F.lit("+")), F.concat(F.lit("+"), digits)).otherwise(digits))


def find(text: Column) -> Column:
    """The entities of a text in order."""
    def entity(raw):
        return F.struct(raw.alias("raw"), kind_of(raw).alias("kind"), normal(raw, kind_of(raw)).alias("norm"))
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), entity).cast(ENTITIES)
    return F.when(text.rlike(TRIGGER), found).otherwise(F.array().cast(ENTITIES))


def keyed(key: str, *parts: Column) -> Column:
    """A keyed hash in hex."""
    return F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)), 256)


def number(hexes: Column, at: Column | int, size: int) -> Column:
    return F.conv(F.substring(hexes, at, size), 16, 10).cast("long")


def feistel(high: Column, low: Column, above: Column, below: Column, key: str, *tweak: Column) -> Column:
    """A keyed permutation of pairs with ``high`` < ``above`` and ``low`` < ``below``; six rounds, as a struct (x, y)."""
    def turn(pair, k):
        size = F.when(k % 2 == 0, above).otherwise(below)
        moved = F.pmod(pair["x"] + number(keyed(key, *tweak, k.cast("string"), pair["y"].cast("string")), 1, 14), size)
        return F.struct(pair["y"].alias("x"), moved.cast("long").alias("y"))
    return F.aggregate(literal(range(6)), F.struct(high.cast("long").alias("x"), low.cast("long").alias("y")), turn)


def permuted(digits: Column, key: str, *tweak: Column) -> Column:
    """A keyed permutation of digit strings of equal length (two or more)."""
    size = F.length(digits)
    first = F.expr("1") * F.floor(size / 2)

    def power(n):
        return F.pow(F.lit(10.0), n).cast("long")
    pair = feistel(F.substr(digits, F.lit(1), first.cast("int")).cast("long"), F.substr(digits, (first + 1).cast("int"), F.lit(20)).cast("long"),
                   power(first), power(size - first), key, *tweak, size.cast("string"))
    return F.transform(F.array(pair), lambda p: F.concat(F.lpad(p["x"].cast("string"), first.cast("int"), F.lit("0")),
                                                       F.lpad(p["y"].cast("string"), (size - first).cast("int"), F.lit("0"))))[0]


def check_digit(payload: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: F.call_function("luhn_check", F.concat(payload, d.cast("string"))))[0]


def new_card(norm: Column, key: str, attempt: Column) -> Column:
    payload, last = F.substr(norm, F.lit(1), F.length(norm) - 1), F.right(norm, F.lit(1)).cast("int")
    fresh = F.concat(F.left(norm, F.lit(1)), permuted(F.substr(payload, F.lit(2), F.length(payload) - 1), key, F.lit("card"), F.left(norm, F.lit(1)), attempt))
    off = last - check_digit(payload)
    return F.transform(F.array(fresh), lambda p: F.concat(p, F.pmod(check_digit(p) + off, F.lit(10)).cast("string")))[0]


def new_phone(norm: Column, key: str, attempt: Column) -> Column:
    kept = F.when(F.startswith(norm, F.lit("+")), 2).otherwise(0)
    head = F.left(norm, kept)
    return F.concat(head, permuted(F.substr(norm, kept + 1, F.lit(40)), key, F.lit("phone"), head, attempt))


def new_ip(norm: Column, key: str, attempt: Column) -> Column:
    o = F.transform(F.split(norm, r"\."), lambda x: x.cast("long"))
    wide = F.lit(65536).cast("long")
    pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], wide, wide, key, F.lit("ip"), attempt)
    return F.transform(F.array(pair), lambda p: F.concat_ws(".", *(F.floor(v / 256).cast("string") if top else (v % 256).cast("string")
                                                              for v in (p["x"], p["y"]) for top in (True, False))))[0]


def new_email(norm: Column, key: str, attempt: Column) -> Column:
    """Letters for letters and digits for digits before the @; a reserved domain that follows the real one. Later attempts are longer."""
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    hexes = keyed(key, F.lit("email"), norm, attempt)

    def letter(c, i):
        pick = number(hexes, 1 + (i * 3) % 59, 4)
        return (F.when(c.rlike("[a-z]"), F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), (pick % 26 + 1).cast("int"), F.lit(1)))
                .when(c.rlike("[0-9]"), (pick % 10).cast("string")).otherwise(c))
    chars = F.filter(F.split(F.concat(local, F.repeat(F.lit("x"), attempt.cast("int"))), ""), lambda c: c != "")
    return F.concat(F.array_join(F.transform(chars, letter), ""), F.lit("@m"), F.substring(keyed(key, F.lit("domain"), domain), 1, 8), F.lit(".example.org"))


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def stem(word: Column, key: str, attempt: Column) -> Column:
    """A name word's surrogate without its ending: four syllables, and one more with each attempt."""
    def spell(script, hexes):
        return F.array_join(F.transform(F.sequence(F.lit(0), attempt + 3), lambda k: F.element_at(
            literal(SYLLABLES[script]), (number(hexes, 1 + 4 * (k % 16), 4) % 32 + 1).cast("int"))), "")
    return F.transform(F.array(keyed(key, F.lit("person"), word, attempt.cast("string"))),
                       lambda h: reduce(lambda c, s: c.when(script_of(word) == s, spell(s, h)), SYLLABLES, F))[0]


def gender_of(raw: Column) -> Column:
    """What the title of a mention says: m, f, or n for a neutral title or none."""
    def titled(gender):
        return raw.rlike(rf"^(?:{'|'.join(TITLES[gender])})\.? ")
    return F.when(titled("f"), "f").when(titled("m"), "m").otherwise("n")


def new_person(norm: Column, key: str, attempt: Callable[[Column], Column], told: Column) -> Column:
    """Each word of a name by itself, so that a surname alone or with different given names keeps its surrogate. ``told`` is the title's gender."""
    females, males = (literal([g.lower() for g in GIVEN[g_]]) for g_ in "fm")
    words = F.split(norm, " ")

    def word(w, i):
        given = (i == 0) & (F.size(words) > 1)
        listed = F.when(F.array_contains(females, w), "f").when(F.array_contains(males, w), "m").otherwise("n")
        gender = F.when(given, F.when(told != "n", told).otherwise(listed)).otherwise("n")

        def end(script):
            return reduce(lambda c, g: c.when(gender == g, ENDINGS[script][g]), "mfn", F)
        return F.concat(stem(w, key, attempt(w)), reduce(lambda c, s: c.when(script_of(w) == s, end(s)), SYLLABLES, F))
    return F.array_join(F.transform(words, word), " ")


def surrogate(kind: Column, norm: Column, key: str, attempt: Callable[[Column], Column], told: Column | None = None) -> Column:
    """The normal form of an entity's replacement; ``attempt`` gives the attempt number of a normal form or name word, ``told`` a person's gender."""
    tries = attempt(norm).cast("string")
    return (F.when(kind == "email", new_email(norm, key, tries)).when(kind == "person", new_person(norm, key, attempt, F.lit("n") if told is None else told)).when(kind == "ip", new_ip(norm, key, tries))
            .when(kind == "ssn", permuted(norm, key, F.lit("ssn"), tries)).when(kind == "card", new_card(norm, key, tries)).otherwise(new_phone(norm, key, tries)))


def checked(found: Column) -> Column:
    """What must not share a replacement: entities, and the words of persons' names."""
    def names(e):
        return F.transform(F.when(e["kind"] == "person", F.split(e["norm"], " ")).otherwise(F.array(e["norm"])),
                           lambda n: F.struct(e["kind"].alias("kind"), n.alias("norm")))
    return F.flatten(F.transform(found, names))


def render(raw: Column, kind: Column, fresh: Column) -> Column:
    """The replacement in the format of the mention."""
    digits = F.regexp_replace(fresh, r"\D", "")
    step = F.aggregate(F.filter(F.split(raw, ""), lambda c: c != ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), lambda acc, c: F.struct(
        (acc["i"] + F.when(c.rlike(r"\d"), 1).otherwise(0)).alias("i"),
        F.concat(acc["out"], F.when(c.rlike(r"\d"), F.substr(digits, acc["i"], F.lit(1))).otherwise(c)).alias("out")))["out"]
    upper = raw == F.upper(raw)
    title = F.regexp_extract(raw, rf"^(?:(?:{TITLE})\.? )?", 0)
    person = F.concat(title, F.when(F.upper(names_of(raw)) == names_of(raw), F.upper(fresh)).otherwise(F.initcap(fresh)))
    return (F.when(kind == "email", F.when(upper, F.upper(fresh)).otherwise(fresh)).when(kind == "person", person).when(kind == "ip", fresh).otherwise(step))


def second_tries(entities: DataFrame, key: str, rounds: int = 50) -> DataFrame | None:
    """``kind, norm, attempt`` of those whose first replacement collided, or None. ``entities`` are distinct (kind, norm) as ``checked``."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    fresh = F.when(kind == "person", stem(norm, key, attempt)).otherwise(surrogate(kind, norm, key, lambda _: attempt))
    ending = f"(?:{'|'.join(sorted({e for ends in ENDINGS.values() for e in ends.values()}, key=len, reverse=True))})$"
    real = (entities.where((kind == "email") | (kind == "person") & norm.rlike(ending))
            .select("kind", F.when(kind == "person", F.regexp_replace(norm, ending, "")).otherwise(norm).alias("fresh"), F.lit(True).alias("real")).distinct())
    assigned = materialize(entities.withColumn("attempt", F.lit(0)).withColumn("fresh", fresh), "surrogates")
    moved = False
    for _ in range(rounds):
        owner = assigned.groupBy("kind", "fresh").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count(F.lit(1)).alias("n"))
        late = (assigned.join(owner.where("n > 1"), ["kind", "fresh"], "left").join(real, ["kind", "fresh"], "left")
                .withColumn("again", F.coalesce(F.struct("attempt", "norm") != F.col("first"), F.lit(False))
                            | F.col("real").isNotNull()))
        late = materialize(late.select("kind", "norm", "attempt", "fresh", "again"), "surrogates")
        if late.where("again").isEmpty():
            break
        moved = True
        assigned = materialize(late.withColumn("attempt", attempt + F.col("again").cast("int"))
                               .withColumn("fresh", F.when(F.col("again"), fresh).otherwise(F.col("fresh"))).drop("again"), "surrogates")
    else:
        raise RuntimeError(f"replacements still collide after {rounds} rounds")
    return assigned.where("attempt > 0").select("kind", "norm", "attempt") if moved else None


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text_col`` and ``entities``: kind and replacement of each in order.

    Checks all entities of the corpus for collisions when called. The column ``entities`` replaces one of that name.
    """
    rest = [c for c in docs.columns if c not in (text_col, "entities")]
    found = docs.select(F.struct(*rest).alias("rest"), F.col(text_col).alias("text"), F.coalesce(find(F.col(text_col)), F.array().cast(ENTITIES)).alias("found"))
    every = found.select(F.explode(checked(F.col("found"))).alias("e")).select("e.kind", "e.norm").distinct()
    tries = second_tries(materialize(every, "entities"), key)
    if tries is None:
        held = found.withColumn("tries", F.lit(None).cast("map<string,int>"))
    else:
        named = found.withColumn("place", F.xxhash64("text"))
        again = (named.where(F.size("found") > 0).select("place", F.explode(checked(F.col("found"))).alias("e")).select("place", "e.kind", "e.norm").distinct()
                 .join(tries, ["kind", "norm"]).groupBy("place")
                 .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(" ", "kind", "norm").alias("name"), "attempt"))).alias("tries")))
        held = named.join(again, "place", "left")

    def replaced(e):
        def attempt(name):
            return F.coalesce(F.try_element_at(F.col("tries"), F.concat_ws(" ", e["kind"], name)), F.lit(0))
        return F.struct(e["kind"].alias("kind"), render(e["raw"], e["kind"], surrogate(e["kind"], e["norm"], key, attempt, gender_of(e["raw"]))).alias("replacement"))

    swapped = held.withColumn("entities", F.transform("found", replaced))
    between = F.split("text", ENTITY, -1)
    whole = F.array_join(F.zip_with(between, F.transform("entities", lambda e: e["replacement"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = swapped.withColumn("text", F.when(F.size("found") > 0, whole).otherwise(F.col("text")))
    order = [F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c != "entities"]
    return out.select(*order, "entities")
