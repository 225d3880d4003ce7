"""Operator 8: PII surrogates, in DataFrame functions only.

One pattern detects e-mail addresses, payment cards, bank accounts, social
security and telephone numbers, network addresses, access keys and passwords, and
names behind a title. A *canonical entity* (an address in lower case, a number
without its separators, one given or family name) gets a surrogate from a keyed
hash: letters become letters of the same script and case, digits digits, other
characters, the top-level domain and an account's country stay; card and account
numbers whose check digits are right get surrogates whose check digits are right;
network addresses stay valid; given names get the ending of the title's gender. Every
mention is written in its own format, so mentions of one entity agree in every format
and document. A name that stands behind a title is replaced wherever its words
stand again, in the same case, in the same text.

Distinctness: surrogates of the distinct entities of a kind are grouped; where two
entities share one, or a surrogate is itself a real entity, all but the smallest
entity are derived again with the next attempt number, until there is none. After
``SAME_LENGTH`` attempts each further one lengthens the surrogate, so formats whose
space the real entities fill (a phone number of five digits) come to an end too; network
addresses then become addresses of the private IPv6 range. Entities without a letter
or digit to redraw (``password=********``) get letters.

Texts are searched once; the distinct mentions are shuffled for the surrogates, the
texts once for the join with their replacements, by a hash of the text and a salt,
so copies and frequent entities are spread.

Time is linear in a text, whatever its tokens: no pattern matches by recursion or
backtracks over more than a bounded length.

Edge cases: null text stays null, empty text empty, both with no entities. Null ids
and repeated rows are each rewritten. Texts without any mention are returned as
they are. An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut, id_and_text

KEY = "daybook"            # the key of tests; a deployment sets its own, see queries.PII_KEY
SAME_LENGTH = 8            # attempts in the entity's own length
SALTS = 16

#: Fixed: titles by gender, of Latin, Cyrillic and Greek script.
MALE_TITLES = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "г-жа", "Κυρία"]
#: Fixed: alphabets by script, lower case, and the gendered endings of given names.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αεηιο"}
ENDINGS = {"latin": ("o", "a"), "cyrillic": ("ий", "ия"), "greek": ("ος", "α")}
RANGES = {"cyrillic": r"[\x{400}-\x{4FF}]", "greek": r"[\x{370}-\x{3FF}]"}

_titles = "|".join(sorted(MALE_TITLES + FEMALE_TITLES, key=len, reverse=True))
_NAME = rf"(?<!\p{{L}})(?:{_titles})\.? \p{{Lu}}\p{{L}}++(?: \p{{Lu}}\p{{L}}++)?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What is detected, in order of precedence at one place.
PATTERNS = {
    # possessive throughout: Java matches such a group in a loop, any other one by recursion, a frame per label
    "email": (r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
              r"(?<=\.[A-Za-z][A-Za-z0-9\-]{1,62})"),
    "secret": (r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
               r"|(?<=(?i:password|passwd|secret|api_key|apikey|token)[=:]{1,2})[^\s\x22'=:]{6,}+"
               r"|(?<=(?i:password|passwd|secret|api_key|apikey|token) ?[=:] ?[\x22'])[^\s\x22']{6,}+"),
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ \-]?[0-9]{4}){3}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": (r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .\-]?\(?[0-9]{2,4}\)?){2,4}(?![0-9])"
              r"|(?<![0-9A-Za-z])(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9])"),
    "ip": (rf"(?<!(?i:version|ver|ver\.|release|build) )(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z])(?!\.[0-9])"),
    "name": _NAME,
}
DETECT = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A cheap test that every text with a mention passes.
GATE = rf"[0-9@]|(?<!\p{{L}})(?:{_titles})\.? \p{{Lu}}|(?i:password|passwd|secret|api_key|apikey|token) ?[=:]"
NUMBERS = ("card", "iban", "ssn", "phone")


def _kind(raw: Column) -> Column:
    """The kind of a detected string, by the first pattern that fits it whole."""
    return (F.when(raw.rlike("^[^@\\s]+@[^@\\s]+$"), "email").when(raw.rlike(rf"^(?:{_NAME})$"), "name")
            .when(raw.rlike("^[0-9]{4}(?:[ \\-]?[0-9]{4}){3}$"), "card")
            .when(raw.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(raw.rlike("^(?:[0-9]{1,3}\\.){3}[0-9]{1,3}$"), "ip")
            .when(raw.rlike("^\\+?[0-9(][0-9() .\\-]+$") & (F.length(raw) >= 8), "phone")
            .when(raw.rlike("^[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?$"), "iban")
            .otherwise("secret"))


def _script(word: Column) -> Column:
    return (F.when(word.rlike(RANGES["cyrillic"]), "cyrillic").when(word.rlike(RANGES["greek"]), "greek")
            .otherwise("latin"))


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _stream(key: str, kind: Column, canon: Column, attempt: Column, first: int = 0) -> Column:
    part = lambda n: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), F.lit(n)), 256)
    return F.concat(part(f"{first}"), part(f"{first + 1}"))


def _draw(stream: Column, i: Column | int) -> Column:
    """The i-th number of 0 to 65535 of a stream (it repeats after 31)."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substring(stream, F.pmod(i, F.lit(31)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))


def _redrawn(c: Column, n: Column) -> Column:
    """Another character of the same class, script and case; punctuation stays."""
    return (F.when(c.rlike("[0-9]"), F.pmod(n, F.lit(10)).cast("string"))
            .when(c.rlike("[a-z]"), _letter(ALPHABETS["latin"], n))
            .when(c.rlike("[A-Z]"), F.upper(_letter(ALPHABETS["latin"], n)))
            .when(c.rlike(RANGES["cyrillic"]), F.when(c == F.lower(c), _letter(ALPHABETS["cyrillic"], n))
                  .otherwise(F.upper(_letter(ALPHABETS["cyrillic"], n))))
            .when(c.rlike(RANGES["greek"]), F.when(c == F.lower(c), _letter(ALPHABETS["greek"], n))
                  .otherwise(F.upper(_letter(ALPHABETS["greek"], n))))
            .when(c.rlike(r"\p{L}"), _letter(ALPHABETS["latin"], n)).otherwise(c))


def _longer(more: Column, attempt: Column, unit: Callable[[Column], Column]) -> Column:
    """Two drawn units for every attempt after ``SAME_LENGTH``, none before."""
    n = (attempt - (SAME_LENGTH - 1)) * 2
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), lambda j: unit(_draw(more, j))), "")).otherwise("")


def _pronounceable(stream: Column, script: str, more: Column, attempt: Column, ending: str) -> Column:
    """A capitalised name of four drawn syllables, and of further ones after ``SAME_LENGTH`` attempts."""
    letters = []
    consonants = "".join(c for c in ALPHABETS[script] if c not in VOWELS[script])
    for k in range(4):
        letters += [_letter(consonants, _draw(stream, 2 * k)), _letter(VOWELS[script], _draw(stream, 2 * k + 1))]
    syllable = lambda n: F.concat(_letter(consonants, n), _letter(VOWELS[script], F.floor(n / 64).cast("int")))
    return F.concat(F.upper(letters[0]), *letters[1:], _longer(more, attempt, syllable), F.lit(ending))


def _digits(text: Column) -> Column:
    return F.transform(_chars(text), lambda c: c.cast("int"))


def luhn(digits: Column) -> Column:
    """The check sum of a card number, modulo 10: 0 where its last digit is right."""
    n = F.length(digits)
    return F.aggregate(F.transform(_digits(digits), lambda d, i: F.when(F.pmod(n - i, F.lit(2)) == 1, d).otherwise(
        F.when(d > 4, 2 * d - 9).otherwise(2 * d))), F.lit(0), lambda acc, d: acc + d) % 10


def iban_rest(account: Column) -> Column:
    """The remainder modulo 97 of an account number in its check order: 1 where its check digits are right."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.transform(_chars(turned), value), F.lit(0),
                       lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _checked(kind: Column, canon: Column, made: Column) -> Column:
    """``made`` with the check digits of its kind where those of the real number are right."""
    body = F.substring(made, F.lit(1), F.length(made) - 1)
    card = F.concat(body, F.pmod(10 - luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    unchecked = F.concat(F.substring(made, 1, 2), F.lit("00"), F.substring(made, F.lit(5), F.length(made)))
    account = F.concat(F.substring(made, 1, 2), F.lpad((98 - iban_rest(unchecked)).cast("string"), 2, "0"),
                       F.substring(made, F.lit(5), F.length(made)))
    return (F.when((kind == "card") & canon.rlike("^[0-9]+$") & (luhn(canon) == 0), card)
            .when((kind == "iban") & canon.rlike("^[A-Z]{2}[0-9]{2}") & (iban_rest(canon) == 1), account).otherwise(made))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate of a canonical entity at an attempt; linear in its length."""
    domain = F.length(canon) - F.length(F.substring_index(canon, ".", -1))
    drawable = F.when(kind == "email", F.substring(canon, F.lit(1), domain)).otherwise(canon).rlike(r"[0-9\p{L}]")
    # what every character needs is bound once, as the one element of an array: a lambda would work it out each time
    bound = F.array(F.struct(
        _stream(key, kind, canon, attempt).alias("stream"), _stream(key, kind, canon, attempt, 2).alias("more"),
        domain.alias("domain"), drawable.alias("drawable"), kind.alias("kind"), attempt.alias("attempt"), canon.alias("canon")))
    return F.transform(bound, _made)[0]


def _made(s: Column) -> Column:
    kind, attempt, stream, more = s["kind"], s["attempt"], s["stream"], s["more"]
    drawn = lambda c, n: F.when(s["drawable"] | ((kind == "email") & c.isin("@", ".")), _redrawn(c, n)).otherwise(
        _letter(ALPHABETS["latin"], n))
    each = lambda fixed: F.array_join(F.transform(_chars(s["canon"]), lambda c, i: F.when(
        fixed(i), c).otherwise(drawn(c, _draw(stream, i) + F.floor(i / 31).cast("int") * 7))), "")
    letters = _longer(more, attempt, lambda n: _letter(ALPHABETS["latin"], n))
    digits = _longer(more, attempt, lambda n: F.pmod(n, F.lit(10)).cast("string"))
    six = F.concat_ws(":", F.concat(F.lit("fd"), F.substring(more, 1, 2)), *(F.substring(more, 4 * k + 1, 4) for k in range(1, 8)))
    octet = lambda k, low, n: (F.pmod(_draw(stream, k), F.lit(n)) + low).cast("string")
    number = F.concat(each(lambda i: i < F.when(kind == "iban", 2).otherwise(1)), digits)
    checked = lambda t: _checked(t["kind"], t["canon"], t["made"])
    out = (F.when(kind == "email", F.concat(letters, each(lambda i: i >= s["domain"])))
           .when(kind.isin("card", "iban"), F.transform(F.array(F.struct(
               kind.alias("kind"), s["canon"].alias("canon"), number.alias("made"))), checked)[0])
           .when(kind.isin(*NUMBERS), number)
           .when((kind == "ip") & (attempt >= SAME_LENGTH), six)
           .when(kind == "ip", F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))))
    for script, (male, female) in ENDINGS.items():
        for gender, ending in (("m", male), ("f", female)):
            out = out.when(kind == f"given-{gender}-{script}", _pronounceable(stream, script, more, attempt, ending))
        out = out.when(kind == f"family-{script}", _pronounceable(stream, script, more, attempt, ""))
    return out.otherwise(F.concat(each(lambda i: F.lit(False)), letters))


def entity_parts(mentions: DataFrame) -> DataFrame:
    """(raw, kind, part, part_kind, canon): the canonical entities of each distinct mention."""
    m = mentions.select("raw", _kind(F.col("raw")).alias("kind"))
    words = F.split("raw", " ")
    male = F.regexp_replace(words[0], r"\.$", "").isin(*MALE_TITLES)
    family, given = F.element_at(words, -1), F.when(F.size(words) > 2, words[1])
    part = lambda kind, canon: F.struct(kind.alias("part_kind"), canon.alias("canon"))
    named = F.array(
        part(F.concat(F.lit("family-"), _script(family)), F.lower(family)),
        part(F.concat(F.when(male, "given-m-").otherwise("given-f-"), _script(given)), F.lower(given)))
    single = (F.when(F.col("kind") == "email", F.lower("raw"))
              .when(F.col("kind").isin(*NUMBERS), F.regexp_replace("raw", "[^0-9A-Za-z]", "")).otherwise(F.col("raw")))
    parts = F.when(F.col("kind") == "name", F.filter(named, lambda p: p["canon"].isNotNull())).otherwise(
        F.array(part(F.col("kind"), single)))
    return m.select("raw", "kind", F.posexplode(parts).alias("part", "p")).select(
        "raw", "kind", "part", "p.part_kind", "p.canon")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(part_kind, canon, surrogate) of distinct (part_kind, canon), without collisions."""
    current = entities.withColumn("attempt", F.lit(0))
    while True:                  # ends: the space of longer surrogates grows with every attempt
        current = cut(current.withColumn("surrogate", surrogate(key, F.col("part_kind"), F.col("canon"), F.col("attempt"))))
        shared = (current.groupBy("part_kind", "surrogate").agg(F.count("*").alias("n"), F.min("canon").alias("owner"))
                  .where("n > 1").select("part_kind", "surrogate", "owner"))
        losers = current.join(shared, ["part_kind", "surrogate"]).where("canon <> owner").select("part_kind", "canon")
        real = entities.select("part_kind", F.col("canon").alias("surrogate"))
        lower = current.withColumn("surrogate", F.when(F.col("part_kind").rlike("^(given|family)-"), F.lower("surrogate"))
                                   .otherwise(F.col("surrogate")))
        posing = lower.join(real, ["part_kind", "surrogate"], "left_semi").select("part_kind", "canon")
        again = cut(losers.union(posing).distinct())
        if again.isEmpty():
            return current.select("part_kind", "canon", "surrogate")
        bump = again.withColumn("more", F.lit(1))
        current = current.join(bump, ["part_kind", "canon"], "left").select(
            "part_kind", "canon", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt"))


def replacements(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """(raw, surrogate, words) of distinct mentions, each in its own format; ``words``: (word, new) of a name."""
    parts = cut(entity_parts(mentions))
    known = surrogates(cut(parts.select("part_kind", "canon").distinct()), key)
    joined = (parts.join(known, ["part_kind", "canon"]).groupBy("raw", "kind")
              .agg(F.max(F.when(F.col("part") == 0, F.col("surrogate"))).alias("first"),
                   F.max(F.when(F.col("part") == 1, F.col("surrogate"))).alias("second")))
    own = _chars(F.col("first"))
    at = lambda i: F.length(F.regexp_replace(F.substring(F.col("raw"), F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
    number = F.array_join(F.transform(_chars(F.col("raw")), lambda c, i: F.when(
        c.rlike("[0-9A-Za-z]"), F.get(own, at(i) - 1)).otherwise(c)), "")
    # a lengthened number goes on behind its last digit, a lengthened address begins earlier
    number = F.concat(number, F.substring("first", F.length(F.regexp_replace("raw", "[^0-9A-Za-z]", "")) + 1, F.length("first")))
    head = F.length("first") - F.length("raw")
    rest = _chars(F.substring("first", head + 1, F.length("first")))
    mail = F.concat(F.substring("first", F.lit(1), head), F.array_join(F.zip_with(
        _chars(F.col("raw")), rest, lambda c, d: F.when(c.rlike("[A-Z]"), F.upper(d)).otherwise(d)), ""))
    words, is_name = F.split("raw", " "), F.col("kind") == "name"
    named = F.concat_ws(" ", words[0], F.col("second"), F.col("first"))
    pair = lambda word, new: F.struct(word.alias("word"), new.alias("new"))
    of_name = F.filter(F.array(pair(F.element_at(words, -1), F.col("first")), pair(words[1], F.col("second"))),
                       lambda p: p["new"].isNotNull())
    return joined.select("raw", F.when(F.col("kind").isin(*NUMBERS), number).when(F.col("kind") == "email", mail)
                         .when(is_name, named).otherwise(F.col("first")).alias("surrogate"),
                         F.when(is_name, of_name).alias("words"))


def _renamed(gap: Column, names: Column) -> Column:
    """Text between mentions with the bare names of its text replaced: its words, and what lies between them."""
    return F.transform(F.regexp_extract_all(gap, F.lit(r"\p{L}++|[^\p{L}]++"), F.lit(0)),
                       lambda w: F.coalesce(F.element_at(names, w), w))


def pseudonymised(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_entities) of every row, each mention replaced by its surrogate."""
    texts = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64("text").alias("k"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    # detected once over all texts; the outer form keeps Spark from testing the array in a filter of its own first
    hits = F.when(F.col("text").rlike(GATE), F.array_distinct(F.regexp_extract_all("text", F.lit(DETECT), F.lit(0))))
    mentions = cut(texts.select("k", "salt", F.explode_outer(hits).alias("raw")).where("raw is not null").distinct())
    known = cut(replacements(mentions.select("raw").distinct(), key))
    spread = known.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = mentions.withColumn("turn", F.pmod(F.col("k"), F.lit(SALTS)).cast("int")).join(spread, ["raw", "turn"])
    table = found.groupBy("k", "salt").agg(F.map_from_entries(F.collect_list(F.struct("raw", "surrogate"))).alias("known"))
    # a word that is the name of two entities in one text (a given and a family name) gets one of their surrogates
    names = (found.where("words is not null").select("k", "salt", F.explode("words").alias("p"))
             .groupBy("k", "salt", "p.word").agg(F.min("p.new").alias("new"))
             .groupBy("k", "salt").agg(F.map_from_entries(F.collect_list(F.struct("word", "new"))).alias("names")))
    table = table.join(names, ["k", "salt"], "left")
    joined = texts.join(table, ["k", "salt"], "left").select("doc_id", "text", "known", "names", F.when(
        F.col("known").isNotNull(), F.regexp_extract_all("text", F.lit(DETECT), F.lit(0))).alias("hits"))
    # a text without mentions is not split at all
    gaps = F.when(F.col("hits").isNotNull(), F.split("text", DETECT, -1))
    joined = joined.select("doc_id", "text", "known", "names", "hits", gaps.alias("gaps"))
    gap = lambda g: F.when(F.col("names").isNull(), g).otherwise(F.array_join(_renamed(g, F.col("names")), ""))
    changed = F.concat(F.array_join(F.transform(F.arrays_zip(
        F.slice("gaps", F.lit(1), F.size("hits")).alias("gap"), F.col("hits").alias("hit")),
        lambda p: F.concat(gap(p["gap"]), F.element_at(F.col("known"), p["hit"]))), ""), gap(F.element_at("gaps", -1)))
    bare = F.when(F.col("names").isNull(), 0).otherwise(F.aggregate("gaps", F.lit(0), lambda acc, g: acc + F.size(F.filter(
        F.regexp_extract_all(g, F.lit(r"\p{L}++"), F.lit(0)), lambda w: F.array_contains(F.map_keys("names"), w)))))
    return joined.select(
        "doc_id", F.when(F.col("hits").isNull(), F.col("text")).otherwise(changed).alias("text"),
        F.when(F.col("hits").isNull(), 0).otherwise(F.size("hits") + bare).cast("long").alias("n_entities"))
