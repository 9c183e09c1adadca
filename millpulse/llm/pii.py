"""Operator 10: personal data and secrets replaced by keyed surrogates.

Only DataFrame functions.  Entities: e-mail addresses, phone numbers, payment
cards (with a right check digit), national numbers, IBANs, IPv4 addresses, access
keys, passwords and tokens after their word, and names after a title.  A text is
cut at its entities; an e-mail gives a mailbox and a domain, a name its given
names and its surname, so that parts shared by several entities stay shared.

A secret follows one of the words password, passwd, pwd, secret, token and API key
or an identifier with it as a part (``DB_PASSWORD``, ``secret_key``, ``accessToken``,
also in quotes) and ``=``, ``:``, ``=>`` or ``:=``.  It has six characters or more, of
any number, and ends at white space or a quote, so of a quoted phrase of several
words only the first is taken.

A surrogate is drawn from a keyed hash of the entity's type and canonical form:
the same entity has the same surrogate in all documents, however it is written
there.  It keeps type and format: lengths, separators, country code, first two card
digits (its network), right check digits of cards and IBANs, top-level domain, letter case, hexadecimal alphabet; names
keep their title and get a name of the title's gender (by ending) in the script
of the original.

Collision checks: surrogates of one type must differ from each other and from
every real value of that type in the corpus.  Entities that break this, all but
the first of them, draw again until none does.  After ``GROW_AFTER`` draws types of
free length (mailboxes, domains, names, secrets) grow by one symbol a draw, after
``FIXED_AFTER`` draws those of fixed length too (an IPv4 address by a part, a card
before its check digit), so that this ends however densely a type's values are used.

In secrets every letter, digit and symbol is replaced by one of its class (script
and case; symbols by symbols); ``-``, ``_`` and ``.`` stay between others.

Defined cases: null text stays null.  Texts without an entity stay as they are.
Rows with the same id and text are one document and get equal texts.  All other
columns stay; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, shuffled

# What entities look like.
TITLES_F = "Mrs|Ms|Miss|Frau|Mme|Madame|Señora|Sra|Doña|Госпожа|Κυρία"
TITLES_M = "Mr|Herrn|Herr|Monsieur|Señor|Sr|Господин|Κύριος"
TITLES_X = "Dr|Prof"
SECRET_WORD = (
    # the word, the rest of its identifier, the quote that closes a key, the separator, the quote that opens the value
    r"(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:[_-][A-Za-z0-9_-]*+)?+(?:\\{0,2}[\"'])?+"
    r"\s{0,3}(?:=>|:=|[=:])\s{0,3}(?:\\{0,2}[\"'])?"
)
#: Before the word: a part of the identifier that ends in - or _ or, in camel case, before a capital.
SECRET_START = r"(?=[PSTApsta])(?:(?<![\p{L}\d])|(?<=[a-z\d])(?=[PSTA][a-z]))"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NAME_WORD = r"\p{Lu}\p{L}+(?:-\p{Lu}\p{L}+)?"
PATTERNS = [
    # to the end of the secret, however long, without the punctuation after it
    SECRET_START + SECRET_WORD + r"[^\s\"']{5,}[^\s\"'\\.,;:!?)\]}]",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # a phone number, but not the address that may follow it
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:(?!\s(?:\d{1,3}\.){3}\d)[ .-]?\d{2,4}){1,4}(?!\d|\.\d)",
    r"(?<![\d.])\d{13,19}(?!\d|\.\d)",
    r"(?<![\d-])\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}(?![\d-])",
    r"(?<![\d-])\d{4}[ -]\d{6}[ -]\d{4,5}(?![\d-])",
    r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    r"(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    r"(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    r"(?<![\d.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?!\d|\.\d)",
    r"(?<!\p{L})(?:" + "|".join((TITLES_F, TITLES_M, TITLES_X)) + r")\.? " + NAME_WORD + "(?: " + NAME_WORD + "){0,3}",
]
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS)
#: Any text with an entity has one of these; a cheap first look.
HINT = r"[0-9@=:]|(?:" + "|".join((TITLES_F, TITLES_M, TITLES_X)) + r")\.? "
# Syllables of surrogate names, by script, and endings by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se ta te to".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се та те то ва".split(),
    "greek": "βα βε βο δα δε δο γα γο κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε τα τε το φα".split(),
}
ENDINGS = {
    "latin": {"given_f": "lia", "given_m": "ron", "given_x": "ni", "surname": "rel"},
    "cyrillic": {"given_f": "лия", "given_m": "рон", "given_x": "ни", "surname": "рел"},
    "greek": {"given_f": "λια", "given_m": "ρον", "given_x": "νι", "surname": "ρελ"},
}
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Classes of characters and what replaces them in secrets; any other character is replaced by a symbol.
CLASSES = [
    ("[0-9]", DIGITS),
    ("[a-z]", LOWER),
    ("[A-Z]", UPPER),
    (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"\p{IsArabic}", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (r"\p{IsHebrew}", "אבגדהוזחטיכלמנסעפצקרשת"),
    (r"[\p{IsHiragana}\p{IsKatakana}]", "かきくけこさしすせそたちつてとなにぬねのまみむめもらりるれろ"),
    (r"\p{IsHangul}", "가나다라마바사아자차카타파하고노도로모보소오조초코토포호"),
    (r"\p{IsHan}", "日月火水木金土山川田石竹米花草虫魚鳥馬牛羊犬車門雨雪風雲"),
    (r"\p{Lu}", UPPER),
    (r"[\p{L}\p{M}]", LOWER),
    (r"\p{N}", DIGITS),
]
SYMBOLS = "#$%&*+/<=>@^|~"
#: Draws after which types of free length grow by one symbol a draw, and those of fixed length.
GROW_AFTER = 3
FIXED_AFTER = 8


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn_sum(digits: Column, shift: int) -> Column:
    """Luhn sum of digits; ``shift`` 1 if a check digit is still to follow."""
    n = F.length(digits)
    worth = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when((i + shift) % 2 == 0, 2).otherwise(1))
    return F.aggregate(worth, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v))


def _iban(country: Column, account: Column) -> Column:
    """With the check digits that leave 1 modulo 97: letters count as 10 to 35, country and check come last."""
    worth = F.transform(_chars(F.upper(F.concat(account, country, F.lit("00")))), lambda c: F.ascii(c) - F.when(c.rlike("[0-9]"), 48).otherwise(55))
    rest = F.aggregate(worth, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.concat(country, F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), account)


def _kind(m: Column) -> Column:
    digits = _digits(m)
    number = m.rlike(r"^\d[\d -]+$")
    return (
        F.when(m.rlike("^" + SECRET_WORD), "secret")
        .when(m.contains("@"), "email")
        .when(m.rlike("^AKIA"), "key")
        .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "national")
        .when(m.rlike(r"^[+(]|^\d{3}-\d{3}-\d{4}$"), "phone")
        .when(number & (F.length(digits).between(13, 19)) & (_luhn_sum(digits, 0) % 10 == 0), "card")
        .when(number, "")
        .otherwise("name")
    )


def _unit(kind: Column | str, text: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), text.alias("text"))


def _units(m: Column) -> Column:
    """The parts of an entity: kind (empty: kept) and text."""
    kind = _kind(m)
    word = F.regexp_extract(m, "^" + SECRET_WORD, 0)
    rest = F.substring(m, F.length(word) + 1, F.length(m))
    mailbox, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    title = F.regexp_extract(m, r"^\S+ ", 0)
    names = F.split(F.substring(m, F.length(title) + 1, F.length(m)), " ")
    given = F.when(title.rlike(f"^(?:{TITLES_F})\\b"), "given_f").when(title.rlike(f"^(?:{TITLES_M})\\b"), "given_m").otherwise("given_x")
    named = F.transform(names, lambda w, i: F.array(_unit("", F.when(i == 0, title).otherwise(" ")), _unit(F.when(i == F.size(names) - 1, "surname").otherwise(given), w)))
    return (
        F.when(kind == "secret", F.array(_unit("", word), _unit("secret", rest)))
        .when(kind == "email", F.array(_unit("mailbox", F.concat(mailbox, F.lit("@"), domain)), _unit("", F.lit("@")), _unit("domain", domain)))
        .when(kind == "name", F.flatten(named))
        .otherwise(F.array(_unit(kind, m)))
    )


def _parts(text: Column) -> Column:
    """The text cut into parts (kind, text), in order."""
    between = F.transform(F.split(text, ENTITY, -1), lambda x: F.array(_unit("", x)))
    found = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), _units)
    return F.flatten(F.flatten(F.zip_with(between, found, lambda a, b: F.array(a, F.coalesce(b, F.filter(a, lambda _: F.lit(False)))))))


def _canonical(kind: Column, text: Column) -> Column:
    """One form for all ways of writing an entity."""
    code = F.regexp_extract(text, r"^\+\d{1,3}(?=[ .(-])", 0)
    return (
        F.when(kind == "phone", F.concat(code, F.lit("/"), _digits(F.substring(text, F.length(code) + 1, F.length(text)))))
        .when(kind.isin("card", "national", "iban"), F.regexp_replace(text, "[^0-9A-Za-z]", ""))
        .when(kind.isin("mailbox", "domain", "surname", "given_f", "given_m", "given_x"), F.lower(text))
        .otherwise(text)
    )


def _byte(seed: Column, i: Column) -> Column:
    """The i-th byte (from 0) of a hash of 128 bytes in hexadecimal, around."""
    return F.conv(F.substring(seed, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _redrawn(text: Column, seed: Column) -> Column:
    """Each letter and digit replaced by another of its class."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(seed, i)
        pick = lambda letters: F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), pick(DIGITS)).when(c.rlike("[a-z]"), pick(LOWER)).when(c.rlike("[A-Z]"), pick(UPPER)).otherwise(c)

    return F.array_join(F.transform(_chars(text), one), "")


def _secret(text: Column, seed: Column) -> Column:
    """Each character replaced by another of its class; separators stay between letters and digits."""
    some = text.rlike(r"[\p{L}\p{N}]")

    def one(c: Column, i: Column) -> Column:
        b = _byte(seed, i)
        pick = lambda letters: F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1))
        out = F.when(some & c.rlike("[-_.]"), c)
        for pattern, letters in CLASSES:
            out = out.when(c.rlike(pattern), pick(letters))
        return out.otherwise(pick(SYMBOLS))

    return F.array_join(F.transform(_chars(text), one), "")


def _name(canon: Column, kind: Column, seed: Column, attempt: Column) -> Column:
    """Syllables and an ending by script and gender."""
    count = F.lit(3) + F.greatest(F.lit(0), attempt - GROW_AFTER)

    def build(script: str) -> Column:
        table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        stem = F.array_join(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.get(table, _byte(seed, i) % len(SYLLABLES[script]))), "")
        ending = F.coalesce(*[F.when(kind == k, F.lit(e)) for k, e in ENDINGS[script].items()])
        return F.concat(stem, ending)

    return F.when(canon.rlike(r"\p{IsCyrillic}"), build("cyrillic")).when(canon.rlike(r"\p{IsGreek}"), build("greek")).otherwise(build("latin"))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of an entity at a draw."""
    text = F.concat_ws("\u0001", F.lit(key), kind, canon, attempt.cast("string"))
    seed = F.concat(F.sha2(F.concat(text, F.lit("\u0001a")), 512), F.sha2(F.concat(text, F.lit("\u0001b")), 512))
    # as a variable of a lambda the seed is hashed once, not once a character
    return F.get(F.transform(F.array(seed), lambda x: _drawn(kind, canon, attempt, x)), 0)


def _drawn(kind: Column, canon: Column, attempt: Column, seed: Column) -> Column:
    more, fixed = (F.greatest(F.lit(0), attempt - n) for n in (GROW_AFTER, FIXED_AFTER))
    grown = F.substring(F.translate(seed, DIGITS, "ghijklmnop"), F.lit(1), more)
    digits = F.substring(F.translate(seed, "abcdef", "012345"), F.lit(129), fixed)
    code = F.substring_index(canon, "/", 1)
    number = F.substring_index(canon, "/", -1)
    body = F.concat(F.substring(canon, 1, 2), _redrawn(F.substring(canon, F.lit(3), F.length(canon) - 3), seed), digits)
    check = (F.lit(10) - _luhn_sum(body, 1) % 10) % 10
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3) + fixed), lambda i: (_byte(seed, i * 2) * 256 + _byte(seed, i * 2 + 1)) % 254 + 1), ".")
    top = F.substring_index(canon, ".", -1)
    hexed = F.substring(F.repeat(seed, F.ceil((F.length(canon) + more) / 256).cast("int")), F.lit(1), F.length(canon) + more)
    return (
        F.when(kind == "phone", F.concat(code, F.lit("/"), _redrawn(number, seed), digits))
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "ip", octets)
        .when(kind == "mailbox", F.concat(_redrawn(F.substring_index(canon, "@", 1), seed), grown))
        .when(kind == "domain", F.concat(_redrawn(F.substring(canon, F.lit(1), F.length(canon) - F.length(top) - 1), seed), grown, F.lit("."), top))
        .when(kind == "key", F.concat(F.substring(canon, 1, 4), _redrawn(F.substring(canon, F.lit(5), F.length(canon)), seed), digits))
        .when(kind == "iban", _iban(F.substring(canon, 1, 2), F.concat(_redrawn(F.substring(canon, F.lit(5), F.length(canon)), seed), digits)))
        .when((kind == "secret") & canon.rlike("^[0-9a-f]+$"), hexed)
        .when(kind == "secret", F.concat(_secret(canon, seed), grown))
        .when(kind == "national", F.concat(_redrawn(canon, seed), digits))
        .otherwise(_name(canon, kind, seed, attempt))
    )


def _real(kind: Column, canon: Column) -> Column:
    """The canonical form in the shape of surrogates (a mailbox without its domain)."""
    return F.when(kind == "mailbox", F.substring_index(canon, "@", 1)).otherwise(canon)


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, canon, surrogate) of the distinct entities (kind, canon), without collisions."""
    entities = scratch.table(entities.select("kind", "canon").distinct(), "entities")
    real = entities.select("kind", _real(F.col("kind"), F.col("canon")).alias("surrogate")).distinct()
    drawn = entities.withColumn("attempt", F.lit(0))
    draw = 0
    while True:
        drawn = scratch.table(drawn.select("kind", "canon", "attempt", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key).alias("surrogate")), f"draw-{draw}")
        order = F.struct("attempt", "canon")
        shared = drawn.groupBy("kind", "surrogate").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
        late = drawn.join(shared, ["kind", "surrogate"]).where(order != F.col("first")).select("kind", "canon")
        taken = drawn.join(real, ["kind", "surrogate"], "left_semi").select("kind", "canon")
        again = scratch.table(late.union(taken).distinct(), f"again-{draw}")
        if again.isEmpty():
            return drawn.select("kind", "canon", "surrogate")
        drawn = drawn.join(again.withColumn("redo", F.lit(1)), ["kind", "canon"], "left").select("kind", "canon", (F.col("attempt") + F.coalesce("redo", F.lit(0))).alias("attempt"))
        draw += 1


def _written(kind: Column, text: Column, drawn: Column) -> Column:
    """A canonical surrogate in the format of the original; what it has grown by comes last."""
    symbols = F.regexp_replace(drawn, "[^0-9A-Za-z]", "")
    filled = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: F.when(F.substring(text, i, F.lit(1)).rlike("[0-9A-Za-z]"), F.substring(symbols, F.length(F.regexp_replace(F.substring(text, F.lit(1), i), "[^0-9A-Za-z]", "")), F.lit(1))).otherwise(F.substring(text, i, F.lit(1))),
        ),
        "",
    )
    filled = F.concat(filled, F.substring(symbols, F.length(F.regexp_replace(text, "[^0-9A-Za-z]", "")) + 1, F.length(symbols)))
    shouted = text == F.upper(text)
    return (
        F.when(kind.isin("phone", "card", "national", "iban"), filled)
        .when(kind.isin("mailbox", "domain"), F.when(shouted, F.upper(drawn)).otherwise(drawn))
        .when(kind.isin("surname", "given_f", "given_m", "given_x"), F.when(shouted, F.upper(drawn)).otherwise(F.initcap(drawn)))
        .otherwise(drawn)
    )


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with ``text`` replaced, and a last column ``_entities`` (number of replaced parts; ``_entities_`` where docs have an ``_entities``)."""
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.col(text_col)
    seen = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text")).where(text.rlike(HINT))
    seen = seen.where(F.col("text").rlike(ENTITY)).withColumn("parts", _parts(F.col("text")))
    found = scratch.table(seen.select("id", "h", "parts").where(F.exists("parts", lambda x: x["kind"] != "")), "parts")
    units = found.select("id", "h", F.posexplode("parts").alias("u", "x")).where("x.kind <> ''").select("id", "h", "u", "x.kind", "x.text").withColumn("canon", _canonical(F.col("kind"), F.col("text")))
    named = assign(units, key, scratch)
    drawn = units.join(named, ["kind", "canon"])
    drawn = drawn.groupBy("id", "h").agg(F.collect_set(F.struct("u", _written(F.col("kind"), F.col("text"), F.col("surrogate")).alias("text"))).alias("drawn"))
    both = found.dropDuplicates(["id", "h"]).join(drawn.withColumnsRenamed({"id": "did", "h": "dh"}), F.col("id").eqNullSafe(F.col("did")) & (F.col("h") == F.col("dh")))
    kept = F.filter(F.transform("parts", lambda x, i: F.struct(i.alias("u"), F.when(x["kind"] == "", x["text"]).alias("text"))), lambda x: x["text"].isNotNull())
    whole = F.array_join(F.transform(F.array_sort(F.concat(kept, "drawn")), lambda x: x["text"]), "")
    new = scratch.table(both.select(F.col("id").alias("nid"), F.col("h").alias("nh"), whole.alias("new"), F.size("drawn").cast("long").alias("many")), "texts")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    out = keyed.join(shuffled(new), keyed["id"].eqNullSafe(new["nid"]) & (keyed["h"] == new["nh"]), "left")
    cols = [F.coalesce("new", F.col("row").getField(c)).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return out.select(*cols, F.coalesce("many", F.lit(0)).cast("long").alias(free_name(docs, "_entities")))
