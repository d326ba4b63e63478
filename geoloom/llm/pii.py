"""Surrogates for personal data and secrets. DataFrame operations only.

One pattern marks all entities of a text in one replacement; texts without a digit, an @, a
title, a label or the beginning of an access key are passed by at once. Every distinct entity
of the corpus gets one surrogate from a keyed digest, so that equal entities stay equal and, by
collision checks, different ones different: a surrogate that two entities of kinds that look
alike draw, or that is itself such an entity of the corpus, is drawn again by all but one.
Surrogates are put into each occurrence's own form.

| kind | equal entities | surrogate |
|-|-|-|
| email | ignoring case | local part letter for letter, digit for digit; a reserved domain |
| phone | same digits after the country code and trunk zeros | other digits in the same punctuation; country code and zeros stay |
| card | same digits, valid by Luhn's check | same issuer digit and grouping, valid too |
| ip, ipv6 | ignoring case | an address of the blocks 240.0.0.0/4 and 2001:db8::/32 |
| ssn, iban | same characters | same shape; an IBAN keeps its country |
| access_key, secret | same text | same prefix, same alphabet and case |
| given, surname | ignoring case, by word | a name of the same gender and script, in the same case |

Names are all capitalised words after a form of address; the last is the surname. Given names
and the surname are entities of their own, so that "Frau Anna Maria Weber" and "Herr Weber"
share one. A given name has the gender of its title; after a title of neither gender it is the
same name as after the title that most often goes with it. Words of a name that occur again in
the same text, with or without a title, are the same entity. Particles (von, de la) and initials
stay. A name that no form of address introduces anywhere in its text is not found.

Secrets have no largest length; a labelled one may have dots inside (a dot at its end is the
sentence's), and needs a digit unless "=" or a quotation mark directly precedes it. Numbers of
15 or 16 digits that fail Luhn's check are left alone.

Texts without entities are never exchanged. Those with some are exchanged once, with the
list of their replacements. Entities are reduced to distinct ones by map-side combined
aggregation before any join, and occurrences meet them in merge joins whose hot keys
adaptive execution splits.

Defined results
* null text: stays null, no entities. Empty text: empty.
* very long text: searched whole; its entities are grouped by their places in it.
* ties: at a place that several kinds match the first of PATTERNS wins; of two entities that
  draw one surrogate the lesser keeps it.
* null id and repeated rows: one result row each, with the same surrogates.
* other columns: kept as they are, but for ``n_chars``, which follows the text if present.
* empty table: empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, quoted, spare, stash

#: Forms of address by gender.
MALE_TITLES = ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Госпожа", "Κυρία"]
OTHER_TITLES = ["Dr", "Prof"]
#: Syllables of surrogate names by script: starts, middles and the ends by gender.
SYLLABLES = {
    "latin": (["bel", "cor", "dar", "fal", "gor", "hel", "jol", "kar", "lor", "mar", "nor", "per", "ras", "sel", "tor", "var"], ["a", "e", "i", "o", "an", "en", "in", "on"], {"m": ["tus", "rik", "lo", "bert"], "f": ["lia", "na", "ra", "line"], "n": ["ly", "ren", "dell", "vis"], "s": ["son", "mann", "feld", "ter"]}),
    "cyrillic": (["бел", "вор", "гор", "дал", "зар", "кол", "лор", "мар", "нол", "пер", "рас", "сел", "тар", "фал", "хор", "яр"], ["а", "е", "и", "о", "ан", "ен", "ин", "он"], {"m": ["слав", "мир", "тий", "дан"], "f": ["слава", "мира", "на", "лия"], "n": ["ли", "ен", "ис", "ай"], "s": ["ский", "енко", "ман", "вич"]}),
    "greek": (["βελ", "γορ", "δαλ", "ζαρ", "θαλ", "καρ", "λορ", "μαρ", "νικ", "περ", "ραλ", "σελ", "ταρ", "φαλ", "χορ", "ωρ"], ["α", "ε", "ι", "ο", "αν", "εν", "ιν", "ον"], {"m": ["ος", "ης", "ας", "ων"], "f": ["ια", "νη", "ρα", "λη"], "n": ["ις", "ι", "ω", "υ"], "s": ["ιδης", "ακης", "ογλου", "ατος"]}),
}
SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}
#: Rounds of drawing after which surrogates grow by characters, so that every draw ends.
LONGER_AFTER, MAX_ROUNDS = 3, 40

#: Particles of names, and the beginnings of country calling codes.
PARTICLES = ["von", "van", "vom", "zu", "zur", "de", "der", "den", "del", "della", "di", "da", "dos", "du", "la", "le", "los", "las", "y"]
CALLING_CODES = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|(?:2[1-689]|3[578]|42|5[09]|6[7-9]|8[035789]|9[679])\d"

_TITLE = "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
_PARTICLE = "|".join(PARTICLES)
#: What ends a text before a name: a title, and initials or particles.
_BEFORE_NAME = rf"\b(?:{_TITLE})\.? " + rf"(?:(?:\p{{Lu}}\.|{_PARTICLE}) )?" * 3
_NAME = r"(?=\p{Lu}[\p{L}\p{M}'’-])\p{Lu}[\p{L}\p{M}]*+(?:['’-][\p{L}\p{M}]{2,}+)*+"
_LABEL = "(?i:password|passwd|secret|token|api_key|apikey)"
_SECRET = r"[A-Za-z0-9+/_=~-]++(?:\.++[A-Za-z0-9+/_=~-]++)*+"
#: The kinds in order; of kinds that match at a place the first wins. What looks far behind is
#: guarded by what looks at the next characters, so that most places fail at once.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][\w.+%-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}",
    "access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "secret": rf"(?<=[=:] {{0,2}}[\"']?)(?=[A-Za-z0-9+/_.=~-]{{7}}[A-Za-z0-9+/_=~-])(?:(?<=[=\"'])|(?=[A-Za-z+/_.=~-]*+[0-9]))(?<={_LABEL} {{0,2}}[=:] {{0,2}}[\"']?){_SECRET}|\b(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{{18,}}+\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv6": r"(?<![\w:.])(?=[A-Fa-f:]*+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,37}::)(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d-])(?:\d{16}|\d{15}|\d{4}(?:(?: \d{4}){3}|(?:-\d{4}){3}))(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])",
    "name": rf"(?<= )(?=\p{{Lu}})(?<={_BEFORE_NAME}){_NAME}(?: (?:(?:{_PARTICLE}) ){{0,3}}{_NAME})*+",
}
#: What may begin an entity: the beginning of a word, or a digit; most places fail at once.
ANY = r"(?:(?<!\w)|(?=\d))(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: Put before and after every entity; what a text has of it, and of the second, is escaped.
MARK, ESCAPE = "\x01", "\x03"


def may_hold(text: Column) -> Column:
    """Whether a text may have an entity: without a digit, an @, the beginning of an access key,
    a title or a label it has none. Tests of single characters and plain words, cheapest first."""
    titles = sorted(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
    titles = [t for t in titles if not any(t != u and t.startswith(u) for u in titles)]
    labels = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    return reduce(lambda x, y: x | y, [text.rlike("[0-9@]"), *[text.contains(t) for t in ["AKIA", "ASIA", *titles]], *[F.lower(text).contains(x) for x in labels]])


def free(text: Column) -> Column:
    """The text with marks of its own escaped."""
    return F.when(text.rlike(f"[{MARK}{ESCAPE}]"), F.replace(F.replace(text, F.lit(ESCAPE), F.lit(f"{ESCAPE}\x05")), F.lit(MARK), F.lit(f"{ESCAPE}\x04"))).otherwise(text)


def marked(text: Column) -> Column:
    """The text with a mark before and after each entity."""
    return F.regexp_replace(free(text), F.lit(ANY), F.lit(f"{MARK}$0{MARK}"))


def _plain(text: Column) -> Column:
    """Without the escapes."""
    return F.when(text.contains(ESCAPE), F.replace(F.replace(text, F.lit(f"{ESCAPE}\x04"), F.lit(MARK)), F.lit(f"{ESCAPE}\x05"), F.lit(ESCAPE))).otherwise(text)


def _is_name(value: Column, before: Column) -> Column:
    return before.rlike(rf"(?:^|[^\p{{L}}])(?:{_TITLE})\.? (?:(?:\p{{Lu}}\.|{_PARTICLE}) ){{0,3}}$") & value.rlike(r"^\p{Lu}[^0-9@]*$")


def kind_of(value: Column, before: Column) -> Column:
    """The kind of a match of ANY, null for a number that fails its check. Patterns that look
    around are told by their characters."""
    hexlike = value.rlike(r"^[0-9A-Fa-f]{18,}$")
    number = value.rlike(r"^(?:\d{15,16}|\d{4}(?:[ -]\d{4}){3})$")
    return (
        F.when(value.contains("@"), "email").when(_is_name(value, before), "name")
        .when(value.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$"), "access_key")
        .when(before.rlike(rf"{_LABEL} {{0,2}}[=:] {{0,2}}[\"']?$"), "secret")
        .when(hexlike & value.rlike("[A-Fa-f]"), "secret").when(value.rlike("^[0-9A-Fa-f:]+$") & value.contains(":"), "ipv6")
        .when(value.rlike("^[A-Z]{2}[0-9]{2}"), "iban").when(value.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip").when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(number & (_luhn(F.regexp_replace(value, "[^0-9]", "")) == 0), "card").when(~number, "phone")
    )


def _char(text: Column, i: Column) -> Column:
    return F.substring(text, i, F.lit(1))


def _digit(stream: Column, i: Column) -> Column:
    """The i-th pair of hex digits of a digest, as a number; it starts again at the end."""
    at = (F.pmod(i * 2, F.lit(62)) + 1).cast("int")
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


def _letters(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (F.pmod(n, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _same_shape(text: Column, stream: Column, lower: str = "abcdefghijklmnopqrstuvwxyz", upper: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ") -> Column:
    """Letters for letters of the same case, digits for digits, the rest as it is."""

    def one(c: Column, i: Column) -> Column:
        n = _digit(stream, i + 1)
        return F.when(c.rlike("[0-9]"), _letters("0123456789", n)).when(c.rlike("[a-z]"), _letters(lower, n)).when(c.rlike("[A-Z]"), _letters(upper, n)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum of a string of digits, modulo 10: 0 for a valid number."""

    def term(i: Column) -> Column:
        d = _char(digits, i).cast("int")
        doubled = F.pmod(F.length(digits) - i, F.lit(2)) == 1
        return F.when(doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.pmod(F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), term), F.lit(0), lambda a, b: a + b), F.lit(10))


def _name(kind: Column, text: Column, stream: Column, more: Column) -> Column:
    """A name of the script of ``text``; the letter that ends ``kind`` is its gender."""
    out = F.lit(None).cast("string")
    for script, (starts, middles, ends) in SYLLABLES.items():
        pick = lambda words, i: F.element_at(F.array(*map(F.lit, words)), F.pmod(_digit(stream, F.lit(i)), F.lit(len(words))) + 1)
        end = F.lit(None).cast("string")
        for gender, words in ends.items():
            end = F.when(F.substring(kind, -1, 1) == gender, pick(words, 5)).otherwise(end)
        # later draws have more syllables, so that there is always another name
        longer = F.array_join(F.transform(F.sequence(F.lit(0), more), lambda i: F.when(i > 0, F.element_at(F.array(*map(F.lit, [a + b for a in starts for b in middles][:128])), F.pmod(_digit(stream, i + 7), F.lit(128)) + 1)).otherwise("")), "")
        made = F.concat(pick(starts, 1), pick(middles, 2), longer, end)
        out = made if script == "latin" else F.when(text.rlike(SCRIPTS[script]), made).otherwise(out)
    return out


def draw(kind: Column, canonical: Column, key: str, round_no: int) -> Column:
    """The surrogate of a canonical entity in a round of drawing."""
    stream = F.sha2(F.concat_ws("\0", F.lit(key), kind, canonical, F.lit(str(round_no))), 256)
    more = max(0, round_no - LONGER_AFTER)
    extra = F.substring(F.regexp_replace(F.sha2(F.concat(stream, F.lit("more")), 256), "[0-9]", ""), 1, more) if more else F.lit("")
    local, shaped = F.substring_index(canonical, "@", 1), _same_shape(canonical, stream)
    domain = F.concat(F.lit("mail"), F.pmod(_digit(stream, F.lit(29)), F.lit(97)).cast("string"), F.lit(".example.net"))
    phone = F.concat(_letters("23456789", _digit(stream, F.lit(30))), F.substring(shaped, 2, 64))
    body = F.concat(F.substring(canonical, 1, 1), shaped.substr(F.lit(2), F.length(shaped) - 2))
    check = F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    group = lambda i: F.substring(F.sha2(F.concat(stream, F.lit("ipv6")), 256), 4 * i + 1, 4)
    octet = lambda i: _digit(stream, F.lit(i)).cast("string")
    return (
        F.when(kind == "email", F.concat(_same_shape(local, stream), extra, F.lit("@"), domain))
        .when(kind == "phone", phone)
        .when(kind == "card", F.concat(body, check.cast("string")))
        .when(kind == "ip", F.concat_ws(".", (F.pmod(_digit(stream, F.lit(1)), F.lit(15)) + 240).cast("string"), octet(2), octet(3), octet(4)))
        .when(kind == "ipv6", F.concat_ws(":", F.lit("2001:db8"), *[group(i) for i in range(6)]))
        .when(kind == "iban", F.concat(F.substring(canonical, 1, 2), shaped.substr(F.lit(3), F.length(shaped))))
        .when(kind == "access_key", F.concat(F.substring(canonical, 1, 4), F.array_join(F.transform(F.sequence(F.lit(5), F.lit(20)), lambda i: _letters("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", _digit(stream, i))), "")))
        .when((kind == "secret") & canonical.rlike("^[0-9A-Fa-f]+$"), _same_shape(canonical, stream, "abcdef", "ABCDEF"))
        .when(kind.startswith("given_") | kind.startswith("sur_"), _name(kind, canonical, stream, F.lit(more)))
        .otherwise(shaped)
    )


def look(kind: Column) -> Column:
    """Kinds that look alike, whose surrogates must differ from each other."""
    return F.when(kind.startswith("given_") | kind.startswith("sur_"), "name").when(kind.isin("phone", "card"), "number").when(kind.isin("access_key", "secret"), "token").otherwise(kind)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct rows of ``kind, canonical``: different
    surrogates for different entities of kinds that look alike, none of which is an entity
    itself. The result is stored."""
    spark = entities.sparkSession
    pending, path = stash(entities.select("kind", "canonical", look(F.col("kind")).alias("look")), "entities")
    everyone, paths, settled = pending, [path], None
    # entities are few bytes each but costly to draw for: deal them out by number, not by size
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for round_no in range(MAX_ROUNDS):
        drawn = pending.repartition(tasks, "kind", "canonical").withColumn("surrogate", draw(F.col("kind"), F.col("canonical"), key, round_no))
        drawn = drawn.join(everyone.select("look", F.col("canonical").alias("surrogate")), ["look", "surrogate"], "left_anti")
        first = drawn.groupBy("look", "surrogate").agg(F.min(F.struct("canonical", "kind")).alias("of"))
        if settled is not None:
            first = first.join(settled.select("look", "surrogate"), ["look", "surrogate"], "left_anti")
        won, won_path = stash(first.select("of.kind", "of.canonical", "look", "surrogate"), "surrogates")
        paths.append(won_path)
        settled = won if settled is None else settled.unionByName(won)
        pending, path = stash(pending.join(won.select("kind", "canonical"), ["kind", "canonical"], "left_anti"), "pending-entities")
        paths.append(path)
        if pending.isEmpty():
            break
    else:
        raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")
    out, _ = stash(settled.select("kind", "canonical", "surrogate"), "surrogates")
    discard(spark, *paths)
    return out


def _kept_digits(value: Column) -> Column:
    """How many digits of a phone number stay: a country code after "+", and trunk zeros."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    code = F.when(value.startswith("+"), F.length(F.regexp_extract(digits, f"^(?:{CALLING_CODES})", 0))).otherwise(0)
    return code + F.length(F.regexp_extract(digits.substr(code + 1, F.length(digits)), "^0*", 0))


def _canonical(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, r"[^0-9]", "")
    phone = digits.substr(_kept_digits(value) + 1, F.length(digits))
    lower = kind.isin("email", "ipv6") | kind.startswith("given_") | kind.startswith("sur_")
    return F.when(lower, F.lower(value)).when(kind == "phone", phone).when(kind == "card", digits).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).otherwise(value)


def _in_form(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the form of this occurrence."""

    def fill(pattern: str, kept: Column) -> Column:
        """Characters of the pattern after the first ``kept`` are those of the surrogate."""
        nth = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i), rf"[^{pattern}]", "")) - kept
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.when(_char(value, i).rlike(f"[{pattern}]") & (nth(i) > 0), _char(surrogate, nth(i))).otherwise(_char(value, i))), "")

    name = F.when(value == F.upper(value), F.upper(surrogate)).otherwise(F.concat(F.upper(F.substring(surrogate, 1, 1)), surrogate.substr(F.lit(2), F.length(surrogate))))
    upper = F.when(value == F.upper(value), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind == "phone", fill("0-9", _kept_digits(value))).when(kind == "card", fill("0-9", F.lit(0))).when(kind == "iban", fill("0-9A-Z", F.lit(0)))
        .when(kind.isin("email", "ipv6"), upper).when(kind.startswith("given_") | kind.startswith("sur_"), name).otherwise(surrogate)
    )


def _gender(before: Column) -> Column:
    title = F.regexp_extract(before, rf"({_TITLE})\.? (?:(?:\p{{Lu}}\.|{_PARTICLE}) ){{0,3}}$", 1)
    return F.when(title.isin(MALE_TITLES), "m").when(title.isin(FEMALE_TITLES), "f").otherwise("n")


def _name_words(value: Column, gender: Column) -> Column:
    """The words of a name, with their kinds; particles have none."""
    words = F.split(value, " ")
    kind = lambda w, i: F.when(~w.rlike(r"^\p{Lu}"), F.lit(None).cast("string")).when(i + 1 == F.size(words), "sur_s").otherwise(F.concat(F.lit("given_"), gender))
    return F.transform(words, lambda w, i: F.struct(w.alias("value"), kind(w, i).alias("kind")))


def _parts(texts: DataFrame) -> DataFrame:
    """``texts`` (with ``parts``: what is not and what is an entity, in turn) with further
    parts for words of the text's own names, and ``names``: those words and their kinds."""
    at = F.filter(F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2)), lambda i: _is_name(F.get("parts", i), F.get("parts", i - 1)))
    found = F.flatten(F.transform(at, lambda i: _name_words(F.get("parts", i), _gender(F.get("parts", i - 1)))))
    # a word that is a surname and a given name is a surname
    names = F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda w: F.struct((~w["kind"].startswith("sur_")).alias("later"), F.lower(w["value"]).alias("word"), w["kind"].alias("kind"), w["value"].alias("value"))), lambda w: w["kind"].isNotNull())))
    texts = texts.withColumn("names", names)
    forms = F.array_distinct(F.flatten(F.transform("names", lambda w: F.array(w["value"], F.upper(w["value"]), F.initcap(w["word"])))))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{M}])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{M}])"))
    more = F.flatten(F.transform("parts", lambda x, i: F.when(i % 2 == 0, F.split(F.regexp_replace(x, pattern, F.lit(f"{MARK}$0{MARK}")), MARK, -1)).otherwise(F.array(x))))
    return texts.withColumn("parts", F.when(F.size("names") > 0, more).otherwise(F.col("parts")))


def _occurrences(texts: DataFrame, key_col: str) -> DataFrame:
    """One row for each word of an entity: key, place, word, kind (null if it stays), value,
    canonical."""
    entity = F.transform(F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2)), lambda i: F.struct(F.get("parts", i - 1).alias("before"), F.get("parts", i).alias("value"), F.get(F.filter("names", lambda w: w["word"] == F.lower(F.get("parts", i))), F.lit(0))["kind"].alias("again")))
    spread = texts.select(key_col, F.posexplode(entity).alias("place", "x")).select(key_col, "place", "x.before", "x.value", "x.again")
    spread = spread.withColumn("kind", F.when(F.col("again").isNotNull() & ~_is_name(F.col("value"), F.col("before")), F.col("again")).otherwise(kind_of(F.col("value"), F.col("before"))))
    words = F.when(F.col("kind") == "name", _name_words(F.col("value"), _gender(F.col("before")))).otherwise(F.array(F.struct("value", "kind")))
    spread = spread.select(key_col, "place", F.posexplode(words).alias("word", "x")).select(key_col, "place", "word", "x.kind", "x.value")
    return spread.withColumn("canonical", F.when(F.col("kind").isNotNull(), _canonical(F.col("kind"), F.col("value"))))


def _same_person(entities: DataFrame) -> DataFrame:
    """From numbers of ``kind, canonical``: for given names after titles of neither gender, the
    kind after the title that most often goes with the name, where there is one."""
    told = entities.filter(F.col("kind").isin("given_m", "given_f")).groupBy("canonical").agg(F.max(F.struct("n", "kind"))["kind"].alias("same_kind"))
    return entities.filter("kind = 'given_n'").join(told, "canonical").select("kind", "canonical", "same_kind")


def replace(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``key`` is secret. ``count_col``: a column
    to add with the number of entities."""
    columns = docs.columns
    row, hit = spare(columns, "row_key"), may_hold(quoted(text_col))
    # only texts that have an entity, stored with their parts under a number of their own
    carried = F.struct(*[quoted(c) for c in columns]).alias("doc")
    parts = docs.filter(hit).select(carried, F.split(marked(quoted(text_col)), MARK, -1).alias("parts"))
    parts = _parts(parts.filter(F.size("parts") > 1).withColumn(row, F.monotonically_increasing_id()))
    stored, _ = stash(parts, "texts-with-entities")
    met, _ = stash(_occurrences(stored, row), "occurrences")
    entities, _ = stash(met.filter("kind is not null").groupBy("kind", "canonical").agg(F.count(F.lit(1)).alias("n")), "distinct-entities")
    same = _same_person(entities)
    chosen = surrogates(entities.join(same.select("kind", "canonical"), ["kind", "canonical"], "left_anti").select("kind", "canonical"), key)
    chosen = chosen.unionByName(same.join(chosen.withColumnRenamed("kind", "same_kind"), ["same_kind", "canonical"]).select("kind", "canonical", "surrogate"))
    put = met.filter("kind is not null").join(chosen, ["kind", "canonical"]).select(row, "place", "word", _in_form(F.col("kind"), F.col("value"), F.col("surrogate")).alias("new"), F.lit(1).alias("entity"))
    put = put.unionByName(met.filter("kind is null").select(row, "place", "word", F.col("value").alias("new"), F.lit(0).alias("entity")))
    # words of a name have one place; every place has words, so that places are those of the parts
    in_order = lambda by: F.transform(F.array_sort(F.collect_list(F.struct(by, "new"))), lambda x: x["new"])
    places = put.groupBy(row, "place").agg(F.array_join(in_order("word"), " ").alias("new"), F.max("entity").alias("entity"))
    lists = places.groupBy(row).agg(in_order("place").alias("new"), F.sum("entity").alias("n"))
    joined = stored.join(lists, row)
    whole = F.array_join(F.transform("parts", lambda x, i: F.when(i % 2 == 0, x).otherwise(F.get("new", F.floor(i / 2).cast("int")))), "")
    changed = joined.select(_plain(whole).alias("text"), F.col("n").cast("long").alias("n"), "doc")

    def shown(text: Column | None, field) -> list[Column]:
        out = []
        for c in columns:
            if c == text_col and text is not None:
                out.append(text.alias(c))
            elif c == "n_chars" and text is not None:
                out.append(F.length(text).cast(docs.schema[c].dataType).alias(c))
            else:
                out.append(field(c).alias(c))
        return out

    extra = lambda n: [n.alias(count_col)] if count_col else []
    rest = docs.filter(F.coalesce(~hit, F.lit(True)) | ~free(quoted(text_col)).rlike(ANY))
    return changed.select(*shown(F.col("text"), lambda c: F.col("doc")[c]), *extra(F.col("n"))).unionByName(rest.select(*shown(None, quoted), *extra(F.lit(0).cast("long"))))
