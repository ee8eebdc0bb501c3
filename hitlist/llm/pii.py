"""Keyed surrogates for personal data, in SQL expressions.

``find`` lists what a text holds of: e-mail addresses, IPv4 and IPv6 addresses, secrets (long hex
runs, assigned keys and passwords of any length, access key ids, bearer tokens, IBANs), card
numbers, telephone numbers, social security numbers and names of persons (after a title, or a
known first name with a surname, initials between them). What is assigned to a token or secret by
a colon must be quoted, have a digit, or 8 characters, as prose has colons too.

``surrogates`` gives every distinct entity of the corpus one replacement, a keyed digest cut
to the entity's type: digits for digits, valid octets, the same count of hex digits, a check
digit where the number had a right one, a name of the same gender and script. The tables of
entities and replacements are compared: a replacement that another entity got too, or that
is an entity itself, is drawn again until none is left, so different entities stay different.
After ``WIDEN`` draws a replacement grows by a character a draw, and what is left after ``DRAWS``
is numbered. A run of signs without a letter or digit is no secret.
The same entity gets the same replacement everywhere, in whatever way it is written (case of
an address, separators of a number, a person's surname alone).

``replace`` puts them into the texts, and those of a text's persons also where the surname or
first name stands alone in it, as a capitalised whole word (but not ``SENTENCE_WORDS``). Only texts with a find are shuffled.

Null text stays null. Rows that repeat an id are replaced row by row. Empty tables give empty
results. Other columns are kept by ``replace``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import broadcast_if_small, fresh, stage, text_key
from hitlist.operators.keys import with_dense_id

# Titles and first names by gender, syllables by script.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа"],
}
FIRST_NAMES = {
    "m": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Hans", "Peter", "Jürgen", "Wolfgang",
          "Jean", "Pierre", "Jacques", "Juan", "José", "Carlos", "Miguel", "Иван", "Дмитрий", "Сергей"],
    "f": ["Mary", "Patricia", "Jennifer", "Elizabeth", "Barbara", "Susan", "Margaret", "Ursula", "Sabine", "Monika",
          "Helga", "Françoise", "Nathalie", "Sylvie", "Isabel", "Carmen", "Lucía", "Анна", "Мария", "Ольга"],
}
# Capitalised words after a first name that begin a sentence rather than name a person.
SENTENCE_WORDS = {
    "the", "this", "that", "these", "those", "he", "she", "it", "we", "you", "they", "his", "her", "and", "but", "or", "if", "in", "on",
    "at", "as", "for", "from", "to", "of", "is", "was", "said", "when", "then", "there", "der", "die", "das", "er", "sie", "es", "wir",
    "ihr", "und", "aber", "oder", "ein", "eine", "ist", "im", "am", "le", "la", "les", "un", "une", "des", "du", "de", "et", "mais", "ou",
    "il", "elle", "ils", "elles", "nous", "vous", "el", "los", "las", "una", "y", "pero", "en", "он", "она", "они", "мы", "вы", "это",
    "и", "но", "а", "в", "на",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga go ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa so ta".split(),
    "cyrillic": "ба бе бо да де до фа фе фо га го ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са со та".split(),
    "greek": "βα βε βο δα δε δο φα φε φο γα γο κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σο τα".split(),
}
ENDINGS = {
    "latin": {"m": "n", "f": "a", "": "ler"},
    "cyrillic": {"m": "к", "f": "а", "": "енко"},
    "greek": {"m": "ς", "f": "η", "": "ου"},
}

# What counts as part of a word: digits, and letters by their blocks (faster than properties).
_W = r"0-9A-Za-zÀ-ÖØ-öø-ʯͰ-῿Ⰰ-퟿"
_LOCAL = _W + r"._%+\-"
EMAIL = rf"(?<![{_LOCAL}])[{_LOCAL}]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{{2,}}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![{_W}.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
HEX = r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,}+(?![A-Za-z0-9])"
IPV6 = (
    rf"(?<![{_W}:.])(?:(?:[A-Fa-f0-9]{{1,4}}:){{7}}[A-Fa-f0-9]{{1,4}}|(?=[A-Fa-f:]*\d)(?:[A-Fa-f0-9]{{1,4}}:){{2,6}}(?::[A-Fa-f0-9]{{1,4}}){{1,6}})"
    rf"(?![{_W}:])"
)
ACCESS = r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])"
IBAN = rf"(?<![{_W}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_W}])"
_SET = r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_STRONG = r"(?:[Pp]assword|[Pp]asswd|[Aa][Pp][Ii][_\-]?[Kk]ey)"
_WEAK = r"(?:[Tt]oken|[Ss]ecret)"
_BEARER = r"[Bb]earer\s{1,3}"
_KEY = rf"(?:(?:{_STRONG}|{_WEAK}){_SET}|{_BEARER})"
# what is assigned: to the closing quote on its line, else to white space or a quote, less signs at the end
_QUOTED = "|".join(rf"(?<={q})(?=[^{q}\r\n]*?[{_W}])[^{q}\r\n]++(?={q})" for q in "\"'")
_PLAIN = rf"[^\s\p{{Z}}\"']*[{_W}]"
_LONG = rf"[^\s\p{{Z}}\"']{{7,}}[{_W}]"
ASSIGNED = (
    rf"(?<![A-Za-z])(?:{_STRONG}{_SET}(?:{_QUOTED}|{_PLAIN})"
    rf"|{_WEAK}{_SET}(?:{_QUOTED}|{_LONG}|(?<==)\s{{0,3}}{_PLAIN}|(?=[^\s\p{{Z}}\"']*\d){_PLAIN})"
    rf"|{_BEARER}(?=[^\s\p{{Z}}\"']*[\d.]){_LONG})"
)
CARD = rf"(?<![{_W}])(?:\d{{13,19}}+|\d{{4}}(?:[ \-]\d{{4}}){{2}}[ \-]\d{{1,7}})(?![{_W}])"
PHONE = (
    rf"(?<![{_W}+])(?:\+\d{{1,3}}[ .\-]?)?\(\d{{2,4}}\)[ .\-]?\d{{3,4}}[ .\-]?\d{{3,4}}(?!\d)"
    rf"|(?<![{_W}.])\+\d{{1,3}}(?:[ .\-]?\d{{2,4}}){{2,4}}(?!\d)"
    rf"|(?<![{_W}.\-])\d{{3}}[.\- ]\d{{3}}[.\- ]\d{{4}}(?![ \-]?\d)"
    rf"|(?<![{_W}.\-])0\d{{2,4}}[ /\-]\d{{5,8}}(?![ \-]?\d)"
)
_LOCAL_PHONE = r"^(\d{3}[.\- ]\d{3}[.\- ]\d{4}|0\d{2,4}[ /\-]\d{5,8})$"
SSN = rf"(?<![{_W}\-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d\-])"
# with inner capitals, and apostrophes and hyphens before a capital
_NAME = r"\p{Lu}(?:\p{L}|['’\-](?=\p{Lu}))++"
_TITLE = "(?:" + "|".join(TITLES["m"] + TITLES["f"]) + r")\.?"
_FIRST = "(?:" + "|".join(FIRST_NAMES["m"] + FIRST_NAMES["f"]) + ")"
_FIRST = rf"{_FIRST}(?:-{_FIRST})?"
_CAPITALS = "[" + "".join(sorted({n[0] for names in (*TITLES.values(), *FIRST_NAMES.values()) for n in names})) + "]"
# the names' first letters come first, so that most places fail at one character
# a name that is no word that begins a sentence, and initials before it
_SENTENCE = "|".join(sorted((w.capitalize() for w in SENTENCE_WORDS), key=lambda w: (-len(w), w)))
_SURNAME = rf"(?!(?:{_SENTENCE})(?!\p{{L}})){_NAME}"
_INITIALS = r"(?: \p{Lu}\.)*"
PERSON = (
    rf"(?={_CAPITALS})(?<![{_W}])(?:{_TITLE} {_SURNAME}(?:{_INITIALS} {_SURNAME})?|{_TITLE}(?: \p{{Lu}}\.)+ {_SURNAME}"
    rf"|{_FIRST}{_INITIALS} {_SURNAME})(?!\p{{L}})"
)
_NUMBERS = "|".join(f"(?:{p})" for p in (IP, CARD, PHONE, SSN))
_HEXES = "|".join(f"(?:{p})" for p in (IPV6, HEX))
_CODES = "|".join(f"(?:{p})" for p in (ACCESS, IBAN))
PATTERN = (
    rf"(?:{EMAIL})|(?=[0-9(+])(?:{_NUMBERS})|(?=[0-9A-Fa-f])(?:{_HEXES})|(?=[TtSsPpAaBb])(?:{ASSIGNED})|(?=[A-Z][A-Z])(?:{_CODES})|(?:{PERSON})"
)


def has_find(text: Column) -> Column:
    """Whether the pattern matches; texts without a digit, an at sign, a key or a name fail
    by cheaper searches."""
    hint = text.rlike("[0-9@]") | text.rlike(rf"(?=[TtSsPpAaBb]){ASSIGNED}") | text.rlike(PERSON)
    return F.coalesce(hint & text.rlike(PATTERN), F.lit(False))


#: Draws of a replacement before the rest is numbered; draws after which it grows.
DRAWS, WIDEN = 64, 16


def _script(name: Column) -> Column:
    return (
        F.when(name.rlike(r"^[\p{IsCyrillic}'’\-]+$"), "cyrillic").when(name.rlike(r"^[\p{IsGreek}'’\-]+$"), "greek").otherwise("latin")
    )


def _canon_name(word: Column) -> Column:
    return F.translate(F.lower(word), "’", "'")


def _parts(match: Column) -> Column:
    """The entities of a match as (surface, type, canon); a title has a null type."""
    digits = F.regexp_replace(match, r"\D", "")

    def single(kind: str, canon: Column) -> Column:
        return F.array(F.struct(match.alias("surface"), F.lit(kind).alias("type"), canon.alias("canon")))

    words = F.split(match, " ")
    titled = match.rlike(rf"^{_TITLE} ")
    men = F.regexp_replace(words[0], r"\.$", "").isin(TITLES["m"])
    initial = r"^\p{Lu}\.$"
    several = F.size(F.filter(words, lambda w: ~w.rlike(initial))) == 3  # title, first name and surname

    def person(word: Column, at: Column) -> Column:
        first = F.when(titled, (at == 1) & several).otherwise(at == 0)
        gender = F.when(F.when(titled, men).otherwise(F.split(word, "-")[0].isin(FIRST_NAMES["m"])), "m").otherwise("f")
        unnamed = (titled & (at == 0)) | word.rlike(initial)
        kind = F.when(unnamed, F.lit(None)).when(first, F.concat(F.lit("first_"), gender)).otherwise(F.lit("last_"))
        # the space between words belongs to the word before it
        surface = F.concat(word, F.when(at < F.size(words) - 1, " ").otherwise(""))
        return F.struct(surface.alias("surface"), F.concat(kind, F.lit(" "), _script(word)).alias("type"), _canon_name(word).alias("canon"))

    value = F.regexp_replace(match, f"^{_KEY}", "")
    prefix = F.substring(match, F.lit(1), F.length(match) - F.length(value))
    assigned = F.array(
        F.struct(prefix.alias("surface"), F.lit(None).cast("string").alias("type"), prefix.alias("canon")),
        F.struct(value.alias("surface"), F.lit("secret").alias("type"), value.alias("canon")),
    )
    return (
        F.when(match.rlike(f"^{_KEY}"), assigned)
        .when(match.contains("@"), single("email", F.lower(match)))
        .when(match.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), single("ip", match))
        .when(match.rlike(r"^[A-Fa-f0-9]{1,4}:"), single("ipv6", F.lower(match)))
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), single("ssn", digits))
        .when(match.rlike(r"^[+(]") | match.rlike(_LOCAL_PHONE), single("phone", digits))
        .when(match.rlike(r"^\d[\d \-]*$") & F.length(digits).between(13, 19), single("card", digits))
        .when(match.rlike(rf"^(?:{PERSON})$"), F.transform(words, person))
        .otherwise(single("secret", match))
    )


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, key, found) of texts with a find: per match, in order, its parts."""
    return (
        docs.filter(has_find(F.col("text")))
        .select("doc_id", text_key().alias("key"), F.regexp_extract_all("text", F.lit(PATTERN), 0).alias("matches"))
        .select("doc_id", "key", F.transform("matches", _parts).alias("found"))
    )


def _byte(stream: Column, at: Column) -> Column:
    return F.conv(F.substring(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _luhn(digits: Column) -> Column:
    """The sum that a right check digit makes a multiple of 10."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x % 10 + F.floor(x / 10).cast("int"))


def _draw(entities: DataFrame, key: str) -> DataFrame:
    """Adds the replacement of each (type, canon) at its draw number."""
    kind, canon = F.col("type"), F.col("canon")
    seed = F.concat_ws("|", F.lit(key), kind, canon, F.col("draw").cast("string"))
    # 32 characters at a time with a digest of their own, so a long secret takes linear time
    pieces = F.transform(
        F.regexp_extract_all(canon, F.lit("(?s).{1,32}"), F.lit(0)),
        lambda text, i: F.struct(text.alias("text"), F.sha2(F.concat_ws("|", F.col("_seed"), i.cast("string")), 256).alias("bytes")),
    )
    drawn = entities.withColumn("_seed", seed).withColumn("_pieces", pieces)
    seed, s = F.col("_seed"), F.get("_pieces", F.lit(0))["bytes"]

    def pick(alphabet: str, i: Column, stream: Column) -> Column:
        return F.substring(F.lit(alphabet), _byte(stream, i) % len(alphabet) + 1, F.lit(1))

    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def shaped(hexes: bool) -> Column:
        def char(c: Column, i: Column, b: Column) -> Column:
            if hexes:
                return F.when(c.rlike("[A-F]"), F.upper(pick("0123456789abcdef", i, b))).otherwise(pick("0123456789abcdef", i, b))
            return (
                F.when(c.rlike(r"\d"), pick("0123456789", i, b))
                .when(c.rlike("[a-z]"), pick(low, i, b))
                .when(c.rlike("[A-Z]"), pick(up, i, b))
                .when(c.rlike(r"\p{L}"), pick(low, i, b))
                .otherwise(c)
            )

        def piece(p: Column) -> Column:
            return F.array_join(F.transform(F.split(p["text"], ""), lambda c, i: char(c, i, p["bytes"])), "")

        return F.array_join(F.transform("_pieces", piece), "")

    # own bytes of the draw: the mail domain's label, and what a replacement grows by
    own = F.sha2(F.concat(seed, F.lit("|own")), 256)
    grown = F.substring(own, F.lit(9), F.greatest(F.least(F.col("draw") - WIDEN, F.lit(40)), F.lit(0)))
    grown_digits = F.translate(grown, "abcdef", "012345")
    shape = shaped(False)
    at_sign = F.instr(canon, "@")
    email = F.concat(F.substring(shape, F.lit(1), at_sign), F.lit("mail"), F.substring(own, 1, 8), grown, F.lit(".example.net"))
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: _byte(s, i).cast("string")), ".")
    # of the range for documents, as mail domains are
    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substring(own, i * 4 + 9, F.lit(4))), ":")
    body = F.concat(F.substring(shape, F.lit(1), F.length(canon) - 1), grown_digits)
    check = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    card = F.when(_luhn(canon) % 10 == 0, F.concat(body, check)).otherwise(F.concat(shape, grown_digits))
    country = F.substring(canon, F.lit(1), F.length(canon) - 9)  # what stands before the last nine digits
    phone = F.concat(country, F.substring(shape, F.length(country) + 1, F.lit(9)), grown_digits)

    def name(script: str, gender: str) -> Column:
        count = 3 + F.least(F.col("draw"), F.lit(4))
        parts = F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.get(F.array(*map(F.lit, SYLLABLES[script])), _byte(s, i) % len(SYLLABLES[script]))
        )
        return F.concat(F.array_join(parts, ""), F.lit(ENDINGS[script][gender]))

    made = (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "ipv6", F.concat(F.lit("2001:db8:"), groups))
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "ssn", F.concat(shape, grown_digits))
        .when((kind == "secret") & canon.rlike("^[A-Fa-f0-9]+$"), F.concat(shaped(True), grown))
        .when(kind == "secret", F.concat(shape, grown))
    )
    for script in SYLLABLES:
        for gender, prefix in (("m", "first_m"), ("f", "first_f"), ("", "last_")):
            made = made.when(kind == f"{prefix} {script}", name(script, gender))
    return drawn.withColumn("made", made).drop("_seed", "_pieces")


def _numbered(waiting: DataFrame, settled: DataFrame, real: DataFrame, key: str) -> DataFrame:
    """(type, canon, draw, made) for what no draw has settled: the draw with its rank, in a form
    that neither draws nor entities have, or longer than all of them."""
    taken = real.select("_canon").union(settled.select("made"))
    longest = taken.select(F.max(F.length("_canon"))).first()[0]
    ranked = with_dense_id(_draw(waiting, key), ["type", "canon"], "number")
    number, made, kind = F.col("number").cast("string"), F.col("made"), F.col("type")
    return ranked.select(
        "type", "canon", "draw",
        F.when(kind == "email", F.regexp_replace(made, "@.*$", F.concat(F.lit("@mail_"), number, F.lit(".example.net"))))
        .when(kind == "ip", F.concat(made, F.lit("."), number))
        .when(kind.rlike("^(first|last)_"), F.concat(made, number))
        .otherwise(F.concat(made, F.lpad(number, F.greatest(F.lit(longest + 1), F.length(number)), "0"))).alias("made"),
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, canon, made) for a stored table of distinct (type, canon): ``made`` differs
    within a type from every other row's and from every canon."""
    settled, waiting = None, entities.select("type", "canon", F.lit(0).alias("draw"))
    real = entities.select(F.col("type").alias("_type"), F.col("canon").alias("_canon"))
    for _ in range(DRAWS):
        drawn = _draw(waiting, key)
        if settled is not None:
            drawn = drawn.unionByName(settled)
        # the one drawn first keeps it: settled rows, then by canon
        taken = drawn.groupBy("type", "made").agg(F.min(F.struct("draw", "canon")).alias("owner"))
        mine = drawn.join(taken, ["type", "made"])
        is_real = (F.col("type") == F.col("_type")) & (F.col("made") == F.col("_canon"))
        checked = mine.join(real, is_real, "left").select(
            "type", "canon", "draw", "made",
            (F.col("_canon").isNull() & (F.col("owner.canon") == F.col("canon"))).alias("fine"),
        )
        checked = stage(checked, "surrogates")
        settled = checked.filter("fine").drop("fine")
        waiting = checked.filter("NOT fine").select("type", "canon", (F.col("draw") + 1).alias("draw"))
        if waiting.isEmpty():
            return settled.select("type", "canon", "made")
    rest = stage(_numbered(waiting, settled, real, key), "numbered")
    return settled.select("type", "canon", "made").unionByName(rest.select("type", "canon", "made"))


def _render(surface: Column, kind: Column, made: Column) -> Column:
    """The replacement written the way the entity was."""
    chars = F.split(surface, "")
    filled = F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(
                c.rlike(r"\d"),
                F.substring(made, F.length(F.regexp_replace(F.substring(surface, F.lit(1), i + 1), r"\D", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    loud = (F.upper(surface) == surface) & (F.lower(surface) != surface)
    digits = F.length(F.regexp_replace(surface, r"\D", ""))
    filled = F.concat(filled, F.substring(made, digits + 1, F.length(made)))  # what it has grown by
    return (
        F.when(kind.isNull(), surface)
        .when(kind.isin("phone", "card", "ssn"), filled)
        .when(kind == "email", F.when(loud, F.upper(made)).otherwise(made))
        .when(kind.isin("ip", "ipv6", "secret"), made)
        .otherwise(F.concat(_name_like(surface, made), F.regexp_extract(surface, " $", 0)))
    )


def _name_like(surface: Column, made: Column) -> Column:
    return F.when(F.upper(surface) == surface, F.upper(made)).otherwise(F.initcap(made))


#: Words that may be a name, and what stands between them; together, the whole of a text.
_WORDS = rf"(?<![{_W}]){_NAME}|[^\p{{Lu}}]++|\p{{Lu}}"


def _looked_up(persons: Column, canon: Column) -> Column:
    """What the last of ``persons`` (canon, type, made), sorted, with this canon has made, else
    null: by halving, so a text of many persons and words takes hardly more a word."""
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(persons))).cast("int"))

    def halved(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["lo"] + acc["hi"], 1)
        above = F.get(persons, middle)["canon"] > canon
        done = acc["lo"] >= acc["hi"]
        return F.struct(
            F.when(done | above, acc["lo"]).otherwise(middle + 1).alias("lo"),
            F.when(done | ~above, acc["hi"]).otherwise(middle).alias("hi"),
        )

    bounds = F.struct(F.lit(0).alias("lo"), F.size(persons).alias("hi"))
    after = F.aggregate(steps, bounds, halved, lambda acc: acc["lo"])
    # lo is the place of the first greater one
    return F.element_at(
        F.transform(F.array(F.get(persons, after - 1)), lambda p: F.when(p["canon"] == canon, p["made"])), 1
    )


def _alone(gap: Column, persons: Column) -> Column:
    """The pieces of what stands between finds as (text, hit), with the ``persons`` (canon, type,
    made) of the document replaced; a word that is surname and first name is the surname."""

    def piece(word: Column) -> Column:
        named = F.transform(F.array(_canon_name(word)), lambda canon: _looked_up(persons, canon))
        made = F.when(word.rlike(r"^\p{Lu}[\p{L}'’\-]"), F.element_at(named, 1))
        return F.element_at(
            F.transform(
                F.array(made), lambda m: F.struct(F.coalesce(_name_like(word, m), word).alias("text"), m.isNotNull().alias("hit"))
            ),
            1,
        )

    return F.transform(F.regexp_extract_all(gap, F.lit(_WORDS), F.lit(0)), piece)


def replace(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """``docs`` with replaced texts; with ``counts`` also n_entities and types (found ones,
    sorted, comma-joined)."""
    found = stage(find(docs.select("doc_id", "text")), "pii-found").dropDuplicates(["doc_id", "key"])
    each = found.select("doc_id", "key", F.posexplode("found").alias("i", "parts")).select(
        "doc_id", "key", "i", F.posexplode("parts").alias("j", "p")
    ).select("doc_id", "key", "i", "j", "p.*")
    entities = stage(each.filter("type IS NOT NULL").select("type", "canon").distinct(), "pii-entities")
    chosen = surrogates(entities, key)
    rendered = _render(F.col("surface"), F.col("type"), F.col("made"))
    is_person = F.col("type").rlike("^(first|last)_") & ~F.col("canon").isin(*sorted(SENTENCE_WORDS))
    person = F.when(is_person, F.struct("canon", "type", "made"))
    # a match's parts first, then a document's matches: both from rows of the same partition
    matches = (
        each.join(chosen, ["type", "canon"], "left")
        .select("doc_id", "key", "i", "j", "type", rendered.alias("text"), person.alias("person"))
        .repartition("doc_id", "key")
        .groupBy("doc_id", "key", "i")
        .agg(
            F.array_sort(F.collect_list(F.struct("j", "text"))).alias("parts"),
            F.collect_set("person").alias("persons"),
            F.collect_set(F.split("type", "[_ ]")[0]).alias("types"),
        )
        .select("doc_id", "key", "persons", "types", F.struct("i", F.array_join(F.col("parts.text"), "").alias("text")).alias("match"))
    )
    by_doc = matches.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_list("match")).alias("matches"),
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("persons")))).alias("persons"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("types")))), ",").alias("types"),
    )
    other, own, key_, new, who, n, kinds = fresh(docs, "other", "own", "key", "new", "persons", "n_entities", "types")
    by_match = by_doc.select(
        F.col("doc_id").alias(other),
        F.col("key").alias(key_),
        F.col("matches.text").alias(new),
        F.col("persons").alias(who),
        F.col("n").alias(n),
        F.col("types").alias(kinds),
    )
    long = F.octet_length(F.array_join(new, "")) + 24 * F.size(new) + 80 * F.size(who) + 150
    by_match = broadcast_if_small(stage(by_match, "pii-replaced"), long)
    has = has_find(F.col("text"))
    dirty = docs.filter(has).withColumn(own, text_key()).join(
        by_match, F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(own) == F.col(key_))
    )
    gaps = F.split("text", PATTERN)
    # the gaps as (text, hits); only documents with persons have their words looked up
    named = F.transform(
        F.transform(gaps, lambda g: _alone(g, F.col(who))),
        lambda ps: F.struct(F.array_join(F.transform(ps, lambda p: p["text"]), "").alias("g"), F.size(F.filter(ps, lambda p: p["hit"])).alias("hits")),
    )
    plain = F.transform(gaps, lambda g: F.struct(g.alias("g"), F.lit(0).alias("hits")))
    made = F.element_at(
        F.transform(
            F.array(F.struct(F.when(F.size(who) > 0, named).otherwise(plain).alias("g"), F.col(new).alias("n"))),
            lambda x: F.struct(
                F.array_join(F.zip_with(x["g"], x["n"], lambda a, b: F.concat(a["g"], F.coalesce(b, F.lit("")))), "").alias("text"),
                F.aggregate(x["g"], F.lit(0), lambda total, a: total + a["hits"]).alias("hits"),
            ),
        ),
        1,
    )
    (done_,) = fresh(dirty, "done")
    dirty = dirty.withColumn(done_, made)
    text, total = F.col(done_)["text"], F.col(n) + F.col(done_)["hits"]
    done = dirty.select(
        *(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns), *([total.alias(n), kinds] if counts else [])
    )
    clean = docs.filter(~has)
    if counts:
        clean = clean.withColumns({n: F.lit(0).cast("long"), kinds: F.lit("")})
    return clean.unionByName(done)
