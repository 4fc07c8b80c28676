"""Personal data replaced by keyed surrogates, with SQL functions only.

Detected entities get a replacement of their own type: digits for digits in the same
places, an address for an address, a card number with a right check digit, a name of
the same gender and script. Replacements are derived from a key and the entity, so
the same entity is replaced alike everywhere, however it is written. They are checked
over the whole corpus: no two entities share one, and none is an entity that occurs.

Names are replaced word by word, the last as surname, the others as given names, so that
"Mr John Smith", "Dr John Smith" and "Mr Smith" keep what they have in common. In a text
with such names their words are replaced where they stand without a title too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import numbered
from tallywatch.session import pinned

KEY = "surrogate-key"
ROUNDS = 40  # tries for a replacement that nobody else has, before it counts as an error
GROW = 4  # tries after which replacements get longer, and again after as many

_TITLES = {  # fixed values: forms of address by gender
    "m": "Mr Herr Monsieur Señor Sr Don Sir г-н господин Κύριος κ",
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Doña Lady г-жа госпожа Κυρία",
    "n": "Dr Prof Professor",
}
_TITLE = r"(?<![\p{L}\p{N}])(?:" + "|".join(" ".join(_TITLES.values()).split()) + r")\.?"
_TAIL = "['’-]+s?$"
_WORD = r"\p{Lu}(?:[\p{Ll}\p{M}]+|(?=['’]\p{Lu}))(?:['’-]\p{L}[\p{Ll}\p{M}]*)*"
NAME = _TITLE + f"(?: {_WORD}){{1,3}}"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}"
SECRET = r"(?i:(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?[^\s\"',;]{6,})"
CLOUD_KEY = r"(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])"
IBAN = r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d+.-])\d(?:[ -]?\d){12,18}(?![\d-])"
PHONE = (
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){4,11}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])"
)
KINDS = {
    "secret": SECRET,
    "email": EMAIL,
    "cloud_key": CLOUD_KEY,
    "iban": IBAN,
    "ip": IP,
    "ssn": SSN,
    "card": CARD,
    "phone": PHONE,
    "name": NAME,
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: What every match of a kind has: lets most texts pass with one quick search.
HINTS = {
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)",
    "email": "@",
    "cloud_key": "A[KS]IA[A-Z0-9]",
    "iban": "[0-9]",
    "ip": "[0-9]",
    "ssn": "[0-9]",
    "card": "[0-9]",
    "phone": "[0-9]",
    "name": rf"{_TITLE} \p{{Lu}}",
}
HINT = "|".join(f"(?:{hint})" for hint in dict.fromkeys(HINTS[kind] for kind in KINDS))

# Given names by gender and script, syllables of surnames by script.
GIVEN = {
    ("m", "latin"): "James Robert Michael David Thomas Daniel Martin Peter Paul Lucas Felix Oscar",
    ("f", "latin"): "Mary Linda Susan Sarah Karen Laura Emma Julia Clara Alice Marta Nina",
    ("m", "cyrillic"): "Иван Пётр Сергей Андрей Дмитрий Николай Павел Олег Борис Виктор",
    ("f", "cyrillic"): "Анна Мария Ольга Елена Ирина Наталья Татьяна Вера Нина Софья",
    ("m", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Πέτρος Παύλος Αλέξης",
    ("f", "greek"): "Μαρία Ελένη Άννα Κατερίνα Σοφία Ιωάννα Δήμητρα Ειρήνη",
}
SYLLABLES = {
    "latin": "bar den fol gar hes kel lan mor nes pol rin sal tor ven wil zan",
    "cyrillic": "бар вол гор ден кал лом мир нов пет рог сол тан фед шум яр зор",
    "greek": "βαρ γαλ δελ κορ λαμ μαν νικ παπ ραλ σερ τασ φωτ χαρ ψαλ ρον μιχ",
}
ENDINGS = {  # by gender and script
    ("m", "latin"): "son er man ton",
    ("f", "latin"): "son er man ton",
    ("m", "cyrillic"): "ов ин ский ев",
    ("f", "cyrillic"): "ова ина ская ева",
    ("m", "greek"): "όπουλος ίδης άκης άτος",
    ("f", "greek"): "οπούλου ίδου άκη άτου",
}


def _value(digest: Column, at: Column | int) -> Column:
    """A number from 0 to 65535 out of a hexadecimal digest."""
    place = F.pmod((F.lit(at) if isinstance(at, int) else at) * 4, F.lit(124)) + 1
    return F.conv(F.substr(digest, place, F.lit(4)), 16, 10).cast("int")


def _pick(words: str, value: Column) -> Column:
    options = words.split()
    return F.element_at(F.array(*map(F.lit, options)), F.pmod(value, F.lit(len(options))) + 1)


def _chars(text: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
        lambda i: F.struct(i.alias("i"), F.substr(text, i, F.lit(1)).alias("c")),
    )


def _shaped(text: Column, digest: Column, hexadecimal: Column | None = None) -> Column:
    """Digits for digits, letters for letters, all else kept."""

    def one(x: Column) -> Column:
        c, v = x["c"], _value(digest, x["i"])
        hexed = F.substr(F.lit("0123456789abcdef"), v % 16 + 1, F.lit(1))
        plain = (
            F.when(c.rlike("[0-9]"), (v % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.char(v % 26 + 65))
            .when(c.rlike(r"\p{L}"), F.char(v % 26 + 97))
            .otherwise(c)
        )
        return plain if hexadecimal is None else F.when(hexadecimal, hexed).otherwise(plain)

    return F.array_join(F.transform(_chars(text), one), "")


def _with_check_digit(digits: Column) -> Column:
    """``digits`` and the Luhn check digit that follows them."""
    doubled = F.transform(
        _chars(F.reverse(digits)),
        lambda x: F.when(x["i"] % 2 == 1, x["c"].cast("int") * 2).otherwise(x["c"].cast("int")),
    )
    total = F.aggregate(
        doubled, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d)
    )
    return F.concat(digits, ((10 - total % 10) % 10).cast("string"))


def _iban(country: Column, account: Column) -> Column:
    """Country, right check digits and account."""
    moved = F.concat(account, country, F.lit("00"))
    rest = F.aggregate(
        _chars(moved),
        F.lit(0),
        lambda acc, x: F.when(F.ascii(x["c"]) < 58, (acc * 10 + F.ascii(x["c"]) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(x["c"]) - 55) % 97
        ),
    )
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def kind_of(mention: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        hit = mention.rlike(f"^(?:{pattern})$")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def _script(text: Column) -> Column:
    return (
        F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(text.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _gender(mention: Column) -> Column:
    out = F.lit("n")
    for gender in ("m", "f"):
        titles = "|".join(_TITLES[gender].split())
        out = F.when(mention.rlike(rf"^(?:{titles})\.? "), gender).otherwise(out)
    return out


def _bare(word: Column) -> Column:
    """A name's word without a possessive s or a hyphen at its end."""
    return F.regexp_replace(word, _TAIL, "")


def _words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, f"^{_TITLE} ", ""), " ")


def entity_of(kind: Column, mention: Column) -> Column:
    """The entity that a mention stands for: what its ways of writing have in common.

    A phone number with the country code 1 is its ten digits, as without. Names have
    entities of their words, see ``name_parts``.
    """
    value = F.regexp_extract(mention, r"(?s)^.*?[=:]\s*[\"']?(.*)$", 1)
    digits = F.regexp_replace(mention, r"[^\d+]", "")
    return (
        F.when(kind == "secret", value)
        .when(kind == "email", F.lower(mention))
        .when(kind == "phone", F.regexp_replace(digits, r"^\+1(?=\d{10}$)", ""))
        .when(kind.isin("card", "ssn", "iban"), F.regexp_replace(mention, r"[ -]", ""))
        .otherwise(mention)
    )


def people(found: Column) -> dict[str, Column]:
    """What the names with a title among the mentions of a text say of their words.

    ``__surnames``, ``__words`` (all, long ones first) and ``__gendered``, pairs of a
    word and the gender that a title gives it.
    """
    named = F.filter(found, lambda m: m.rlike(f"^{_TITLE} "))
    surnames = F.transform(named, lambda m: _bare(F.element_at(_words(m), -1)))
    words = F.flatten(F.transform(named, lambda m: F.transform(_words(m), _bare)))
    gendered = F.flatten(
        F.transform(
            F.filter(named, lambda m: _gender(m) != "n"),
            lambda m: F.transform(
                _words(m), lambda w: F.struct(_bare(w).alias("word"), _gender(m).alias("gender"))
            ),
        )
    )
    return {
        "__surnames": F.array_distinct(surnames),
        "__words": F.reverse(F.array_sort(F.array_distinct(words))),
        "__gendered": F.array_distinct(gendered),
    }


def with_repeats(words: Column) -> Column:
    """The pattern of all kinds and of the given words of names (letters, ' and - only)."""
    either = F.concat(F.lit("(?:"), F.array_join(words, "|"), F.lit(")"))
    edge = r"[\p{L}\p{M}\p{N}_]"
    return F.concat(
        F.lit(rf"{ANY}|(?<!{edge})(?=\p{{Lu}})"), either, F.lit("(?: "), either, F.lit(rf")*(?!{edge})")
    )


def name_parts(mention: Column, surnames: Column, gendered: Column) -> Column:
    """An array of ``w, kind, entity, before, after`` for the words of a name.

    The last is a surname if the name has a title or the text has a titled one with it.
    The gender is the title's, else one that another title in the text gives the word.
    A surname in Latin script has none. In Cyrillic and Greek the word's ending decides
    where no title does.
    """
    title = F.regexp_extract(mention, f"^({_TITLE} )", 1)
    own = _gender(mention)

    def part(word: Column, w: Column) -> Column:
        base, last = _bare(word), w == F.size(_words(mention)) - 1
        surname = last & ((title != "") | F.array_contains(surnames, base))
        told = F.array_min(
            F.transform(F.filter(gendered, lambda g: g["word"] == base), lambda g: g["gender"])
        )
        latin = _script(base) == "latin"
        ending = F.when(latin, "n").when(base.rlike("[аяαηυ]$|[ήάύ]$"), "f").otherwise("m")
        gender = F.when(surname & latin, "n").otherwise(
            F.when(own != "n", own).otherwise(F.coalesce(told, ending))
        )
        return F.struct(
            w.cast("int").alias("w"),
            F.when(surname, "name").otherwise("given").alias("kind"),
            F.concat_ws("|", gender, base).alias("entity"),
            F.when(w == 0, title).otherwise(" ").alias("before"),
            F.regexp_extract(word, f"({_TAIL})", 1).alias("after"),
        )

    return F.transform(_words(mention), part)


def surrogate_of(kind: Column, entity: Column, attempt: Column, key: str) -> Column:
    """The entity's replacement, in the form of an entity.

    From attempt ``GROW`` on names, addresses, secrets and phone numbers get longer by
    the attempt, so that there are enough of them for any number of entities.
    """
    longer = F.floor(attempt / GROW).cast("int")

    def more(one) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(longer, F.lit(1))), one)
        return F.when(longer > 0, F.array_join(each, "")).otherwise("")
    salted = [F.concat_ws("|", F.lit(f"{key}{n}"), kind, entity, attempt.cast("string")) for n in "ab"]
    digest = F.concat(*(F.sha2(s.cast("binary"), 256) for s in salted))
    digits = more(lambda i: F.lpad((_value(digest, i + 8) % 100).cast("string"), 2, "0"))
    shaped = _shaped(entity, digest)

    hexadecimal = entity.rlike("^[0-9a-f]+$")
    secret = F.concat(_shaped(entity, digest, hexadecimal), digits)

    local = F.substring_index(entity, "@", 1)
    labels = F.size(F.split(F.substring_index(entity, "@", -1), r"\."))
    host = F.when(labels > 2, F.concat(F.lit("mail"), (_value(digest, 29) % 1000).cast("string"), F.lit("."))).otherwise("")
    email = F.concat(_shaped(local, digest), digits, F.lit("@"), host, F.lit("example."), _pick("com org net", _value(digest, 30)))

    octets = [(_value(digest, i) % 254 + 1).cast("string") for i in range(4)]
    card = _with_check_digit(
        F.concat(F.substr(entity, F.lit(1), F.lit(1)), F.substr(shaped, F.lit(2), F.length(entity) - 2))
    )
    # a country code stays; area codes don't start with 0 or 1
    code = F.regexp_extract(entity, r"^(\+(?:1|7|\d\d)?)", 1)
    at = F.length(code) + 1
    phone = F.concat(code, (_value(digest, 30) % 8 + 2).cast("string"), F.substr(shaped, at + 1, F.length(entity)), digits)
    ssn = F.concat_ws("", (_value(digest, 30) % 100 + 900).cast("string"), F.substr(shaped, F.lit(4), F.lit(6)))
    iban = _iban(F.substr(entity, F.lit(1), F.lit(2)), F.substr(shaped, F.lit(5), F.length(entity)))
    cloud = F.concat(F.substr(entity, F.lit(1), F.lit(4)), F.substr(shaped, F.lit(5), F.lit(16)))

    gender = F.substring_index(entity, "|", 1)
    script = _script(F.substring_index(entity, "|", -1))
    drawn = F.when(gender == "n", F.when(_value(digest, 28) % 2 == 0, "m").otherwise("f")).otherwise(gender)
    word = F.lit(None).cast("string")
    for (g, s), names in GIVEN.items():
        stems = [_pick(SYLLABLES[s], _value(digest, i)) for i in range(3)]
        tail = more(lambda i: _pick(SYLLABLES[s], _value(digest, i + 8)))
        surname = F.concat(F.initcap(F.concat(*stems, tail)), _pick(ENDINGS[g, s], _value(digest, 3)))
        given = F.concat(_pick(names, _value(digest, 4)), tail)
        own = F.when(kind == "given", given).otherwise(surname)
        word = F.when((drawn == g) & (script == s), own).otherwise(word)
    word = F.concat_ws("|", gender, word)
    return (
        F.when(kind == "secret", secret)
        .when(kind == "email", email)
        .when(kind == "cloud_key", cloud)
        .when(kind == "iban", iban)
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "ssn", ssn)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .otherwise(word)
    )


def written_as(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's way of writing: its separators, code and capitals."""
    coded = F.regexp_replace(mention, r"[^\d+]", "").rlike(r"^\+1\d{10}$")
    surrogate = F.when((kind == "phone") & coded, F.concat(F.lit("+1"), surrogate)).otherwise(surrogate)
    sign = F.when(kind == "phone", F.lit(r"[\d+]")).otherwise(F.lit(r"[^ -]"))
    spread = F.aggregate(
        _chars(mention),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, x: F.when(
            F.regexp_like(x["c"], sign),
            F.struct(
                F.concat(acc["out"], F.substr(surrogate, acc["at"], F.lit(1))).alias("out"),
                (acc["at"] + 1).alias("at"),
            ),
        ).otherwise(F.struct(F.concat(acc["out"], x["c"]).alias("out"), acc["at"].alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(surrogate, acc["at"], F.length(surrogate))),
    )
    before = F.regexp_extract(mention, r"(?s)^(.*?[=:]\s*[\"']?).*$", 1)
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), spread)
        .when(kind == "secret", F.concat(before, surrogate))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, entity, surrogate`` for distinct ``entities`` (kind, entity).

    Where two entities would share a surrogate, or it is an entity itself, all but one
    try again, until each has its own. Names are compared as they are read, without the
    gender.
    """

    def read(value: str) -> Column:
        bare = F.substring_index(value, "|", -1)
        return F.when(F.col("kind").isin("given", "name"), bare).otherwise(F.col(value))

    entities = pinned(entities.distinct(), "entities")
    kind, entity = F.col("kind"), F.col("entity")
    named = entities.withColumn("attempt", F.lit(0))
    for attempt in range(ROUNDS):
        named = named.withColumn("surrogate", surrogate_of(kind, entity, F.col("attempt"), key))
        named = pinned(named, "surrogates")
        first = F.min(F.struct("attempt", "entity")).over(Window.partitionBy("kind", read("surrogate")))
        real = entities.select(F.col("kind").alias("k"), read("entity").alias("e")).distinct()
        taken = named.withColumn("first", first["entity"]).join(
            real, (F.col("k") == kind) & (F.col("e") == read("surrogate")), "left"
        )
        clash = taken.filter(F.col("e").isNotNull() | (F.col("first") != entity))
        clash = clash.select("kind", "entity")
        if clash.isEmpty():
            return named.select("kind", "entity", "surrogate")
        again = clash.withColumn("again", F.lit(True))
        named = named.join(again, ["kind", "entity"], "left").select(
            "kind",
            "entity",
            F.when(F.col("again"), F.lit(attempt + 1)).otherwise(F.col("attempt")).alias("attempt"),
        )
    raise ValueError(f"entities without a surrogate of their own after {ROUNDS} rounds")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_entities``, the mentions replaced.

    Null texts stay null, with no entities, as do texts without any. All other columns
    pass through; one named ``n_entities`` is replaced. Repeated rows are treated alike.
    Very long texts are read whole; an empty table gives no rows. A name's words, found
    after a title, are replaced in all of their text, also where one means something else.
    """
    docs = docs.drop("n_entities")
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    plain = docs.filter(~hinted).withColumn("n_entities", F.lit(0))
    mentions = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    found = docs.filter(hinted).withColumn("__found", mentions)
    found = found.withColumns(people(F.col("__found")))
    some = F.size("__words") > 0
    found = found.withColumn("__pattern", F.when(some, with_repeats(F.col("__words"))))
    repeats = F.regexp_extract_all("text", F.col("__pattern"), F.lit(0))
    found = found.withColumn("__found", F.when(some, repeats).otherwise(F.col("__found")))
    found = numbered(found.drop("__words"), "__row", "with-entities")

    each = found.select("__row", F.posexplode("__found").alias("at", "mention"))
    each = each.withColumn("kind", F.coalesce(kind_of(F.col("mention")), F.lit("name")))
    others = each.filter("kind != 'name'").withColumn("entity", entity_of(F.col("kind"), F.col("mention")))
    others = others.withColumns({"w": F.lit(0), "before": F.lit(""), "after": F.lit("")})
    # a text's mentions of names, with their places, before they are told apart by words
    is_name = lambda m: F.coalesce(kind_of(m), F.lit("name")) == "name"
    parts = F.transform(
        "__found",
        lambda m, at: F.when(
            is_name(m),
            F.struct(
                at.alias("at"),
                m.alias("mention"),
                name_parts(m, F.col("__surnames"), F.col("__gendered")).alias("parts"),
            ),
        ),
    )
    named = found.filter(F.col("__pattern").isNotNull()).select("__row", F.explode(parts).alias("m"))
    named = named.filter("m is not null").select("__row", "m.at", "m.mention", F.explode("m.parts").alias("p"))
    named = named.select("__row", "at", "mention", "p.*")
    each = pinned(others.unionByName(named), "mentions")

    known = surrogates(each.select("kind", "entity"), key)
    word = F.concat("before", F.substring_index("surrogate", "|", -1), "after")
    plain_form = written_as(F.col("kind"), F.col("mention"), F.col("surrogate"))
    written = F.when(F.col("kind").isin("given", "name"), word).otherwise(plain_form)
    by_row = (
        each.join(known, ["kind", "entity"])
        .select("__row", "at", F.struct("w", written.alias("new")).alias("s"))
        .groupBy("__row", "at")
        .agg(F.array_sort(F.collect_list("s")).alias("s"))
        .select("__row", F.struct("at", F.array_join(F.transform("s", lambda x: x["new"]), "").alias("new")).alias("s"))
        .groupBy("__row")
        .agg(F.array_sort(F.collect_list("s")).alias("__new"))
    )
    between = F.when(F.col("__pattern").isNull(), F.split("text", ANY, -1)).otherwise(
        F.split("text", F.col("__pattern"), -1)
    )
    new = F.transform(
        between,
        lambda piece, i: F.concat(piece, F.coalesce(F.get("__new", i)["new"], F.lit(""))),
    )
    replaced = (
        found.join(by_row, "__row", "left")
        .withColumn("n_entities", F.size("__found"))
        .withColumn("text", F.when(F.col("n_entities") > 0, F.array_join(new, "")).otherwise(F.col("text")))
    )
    return plain.unionByName(replaced.select(*plain.columns))
