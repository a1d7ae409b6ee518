"""Personal data replaced by surrogates.

Entities are found by one expression. Each distinct entity of the corpus gets a surrogate that depends on a key, its kind
and its canonical form only, so all its mentions agree (coreference). Names are found after a title, with or without a
dot; a given name and a family name are entities of their own, so that "Mrs Anna Novak", "Mr. Novak" and, in the same
text, "Anna" or "Novak" without a title get matching surrogates.

Surrogates keep kind and format: digits stay digits and letters stay letters of their script at the same places, phone
numbers keep their country code, card numbers and IBANs have valid check digits, addresses come from reserved ranges, names
keep title, gender and script. Surrogates are checked against each other and against the corpus's own entities; what
clashes is drawn again. From the third drawing on, forms get longer by one place at each drawing, so there are always more
forms than entities: with N entities, about 2 log10(N) drawings are enough.

Null text stays null, empty text empty. Texts without entities come back unchanged, and aren't moved. Repeated rows and
null ids are treated like other rows. Extra columns stay. Texts of any length are treated whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import parted, saved, set_aside

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Titles by gender; the name's own script decides the script of the surrogate.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "n": ("Dr", "Prof"),
}
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_NAME = r"\p{Lu}\p{Ll}+(?:[-'’]\p{Lu}\p{Ll}+)*"
#: Kinds in the order in which an overlap is decided.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)",
    "phone_intl": r"(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.])\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?!\w|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "name": rf"(?<!\w)(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
ENTITY = "|".join(f"(?:{r})" for r in KINDS.values())
#: What every entity of a kind has in it: a cheap look before the whole expression. Several kinds need a run of digits.
_DIGITS = r"\d[\d .()-]{5,}\d"
NEEDS = {"email": "@", "ip": _DIGITS, "phone": _DIGITS, "phone_intl": r"\+\d", "ssn": _DIGITS, "card": _DIGITS, "iban": r"[A-Z]{2}\d{2}", "name": rf"(?:{_TITLE})\.? \p{{Lu}}"}
LIKELY = "|".join(dict.fromkeys(NEEDS[kind] for kind in KINDS))
#: Alphabets from which letters are drawn, by what they replace: each a range of one script.
ALPHABETS = (
    (r"[0-9]", "0123456789"),
    (r"[\p{Lu}&&\p{IsLatin}]", "".join(map(chr, range(ord("A"), ord("Z") + 1)))),
    (r"\p{IsLatin}", "".join(map(chr, range(ord("a"), ord("z") + 1)))),
    (r"[\p{Lu}&&\p{IsCyrillic}]", "".join(map(chr, range(ord("А"), ord("Я") + 1)))),
    (r"\p{IsCyrillic}", "".join(map(chr, range(ord("а"), ord("я") + 1)))),
    (r"[\p{Lu}&&\p{IsGreek}]", "".join(map(chr, range(ord("Α"), ord("Ρ") + 1)))),
    (r"\p{IsGreek}", "".join(map(chr, range(ord("α"), ord("ρ") + 1)))),
    (r"\p{IsArabic}", "".join(map(chr, range(0x0628, 0x063B)))),
    (r"\p{IsHebrew}", "".join(map(chr, range(0x05D0, 0x05EB)))),
    (r"\p{IsDevanagari}", "".join(map(chr, range(0x0915, 0x093A)))),
    (r"\p{IsHiragana}", "".join(map(chr, range(0x3042, 0x3082)))),
    (r"\p{IsKatakana}", "".join(map(chr, range(0x30A2, 0x30E2)))),
    (r"\p{IsHangul}", "".join(map(chr, range(0xAC00, 0xAD00)))),
    (r"\p{IsHan}", "".join(map(chr, range(0x4E00, 0x4F00)))),
    (r"\p{L}", "".join(map(chr, range(ord("a"), ord("z") + 1)))),
)
#: Syllables of surrogate names by script, given-name ends by gender.
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "pa", "po", "ra", "re", "ro", "sa", "so", "ta", "to", "va"),
    "cyrillic": ("ба", "бе", "бо", "да", "де", "до", "фа", "фе", "га", "го", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "па", "по", "ра", "ре", "ро", "са", "со", "та", "то", "ва"),
    "greek": ("βα", "βε", "βο", "δα", "δε", "δο", "φα", "φε", "γα", "γο", "κα", "κε", "κο", "λα", "λε", "λο", "μα", "με", "μο", "να", "νε", "νο", "πα", "πο", "ρα", "ρε", "ρο", "σα", "σο", "τα", "το", "θα"),
}
ENDS = {"latin": {"f": "lina", "m": "dor", "n": "ren"}, "cyrillic": {"f": "лина", "m": "дор", "n": "рен"}, "greek": {"f": "λινα", "m": "δορ", "n": "ρεν"}}
#: Country calling codes of one and two digits (ITU-T E.164); all others have three.
_SHORT_CODES = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: Drawings of a form with its own length, and after how many drawings in all something must be wrong.
SAME_LENGTH, MOST_DRAWINGS = 2, 60


def kind_of(surface: Column) -> Column:
    out = None
    for kind, regex in KINDS.items():
        matches = surface.rlike(f"^(?:{regex})$")
        name = "phone" if kind == "phone_intl" else kind
        out = F.when(matches, name) if out is None else out.when(matches, name)
    return out.otherwise("card")


def canonical(kind: Column, surface: Column) -> Column:
    """What two mentions of one entity share."""
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind == "ip", surface)
        .when(kind == "iban", F.regexp_replace(surface, r"[^A-Z0-9]", ""))
        .otherwise(F.regexp_replace(surface, r"[^0-9+]", ""))
    )


def name_parts(surface: Column) -> Column:
    """(kind, part) of a name's given name, if it has one, and of its family name: given_f, given_m, given_n or family."""
    words = F.split(surface, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    gender = F.when(title.isin(*TITLES["f"]), "given_f").when(title.isin(*TITLES["m"]), "given_m").otherwise("given_n")
    family = F.struct(F.lit("family").alias("kind"), F.element_at(words, -1).alias("part"))
    return F.when(F.size(words) > 2, F.array(F.struct(gender.alias("kind"), F.get(words, F.lit(1)).alias("part")), family)).otherwise(F.array(family))


def _number(stream: Column, at: int, below: int) -> Column:
    """A number from 24 bits of a hex stream."""
    return F.pmod(F.conv(F.substring(stream, 6 * at + 1, 6), 16, 10).cast("long"), F.lit(below))


def _drawn(stream: Column, text: Column) -> Column:
    """Letters and digits of a text, drawn anew place by place from their script; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        n = F.conv(F.substr(stream, F.pmod(i * 2, F.lit(254)) + 1, F.lit(2)), 16, 10).cast("int")
        out = None
        for regex, letters in ALPHABETS:
            letter = F.substr(F.lit(letters), F.pmod(n, F.lit(len(letters))) + 1, F.lit(1))
            out = F.when(c.rlike(regex), letter) if out is None else out.when(c.rlike(regex), letter)
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _with_check_digit(digits: Column) -> Column:
    """The last digit is set so that the Luhn sum is a multiple of ten."""
    body = F.substr(digits, F.lit(1), F.char_length(digits) - 1)

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(F.pmod(i, F.lit(2)) == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(F.split(F.reverse(body), ""), weigh), F.lit(0), lambda a, x: a + x)
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def _iban(country: Column, account: Column) -> Column:
    """Country, check digits by ISO 7064 (mod 97), account."""
    def value(c: Column) -> Column:  # letters count as 10 to 35
        return F.conv(c, 36, 10).cast("long")

    digits = F.split(F.concat(account, country, F.lit("00")), "")
    left = F.aggregate(digits, F.lit(0).cast("long"), lambda a, c: F.pmod(F.when(value(c) > 9, a * 100 + value(c)).otherwise(a * 10 + value(c)), F.lit(97)))
    return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), account)


def _name(stream: Column, kind: Column, canon: Column, longer: Column) -> Column:
    """A given name (by gender) or a family name of the part's script."""
    out = None
    for script, pattern in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"), ("latin", r".")):
        syllable = lambda k, s=script: F.element_at(F.array(*map(F.lit, SYLLABLES[s])), (_number(stream, k, 32) + 1).cast("int"))
        more = F.array_join(F.slice(F.array(*(syllable(k) for k in range(4, 40))), F.lit(1), longer), "")
        given = reduce(lambda c, g: c.when(kind == f"given_{g}", F.lit(ENDS[script][g])), "fm", F).otherwise(F.lit(ENDS[script]["n"]))
        name = F.concat(syllable(0), syllable(1), F.when(kind == "family", F.concat(syllable(2), syllable(3))).otherwise(F.lit("")), more, F.when(kind == "family", F.lit("")).otherwise(given))
        out = F.when(canon.rlike(pattern), name) if out is None else out.when(canon.rlike(pattern), name)
    return F.initcap(out)


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate's canonical form."""
    def stream(of: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), kind, of, attempt.cast("string"))
        return F.concat(F.sha2(seed, 512), F.sha2(F.concat(F.lit("more|"), seed), 512))

    own = stream(canon)
    longer = F.greatest(attempt - SAME_LENGTH, F.lit(0))
    wider = F.concat(canon, F.repeat(F.lit("0"), longer))
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    # an address is drawn inside its domain, which is an entity of its own, so that addresses of one domain stay together
    email = F.concat(_drawn(own, F.concat(local, F.repeat(F.right(F.regexp_replace(local, r"[^\p{L}\p{N}]", "x"), F.lit(1)), longer))), F.lit("@"), domain)
    reserved = F.regexp_replace(_drawn(own, F.concat(F.repeat(F.lit("x"), longer), canon)), r"\.[^.]+$", ".example")
    # the reserved range of short addresses, then the much larger one for documentation
    ip = F.concat_ws(".", (_number(own, 0, 15) + 240).cast("string"), *((_number(own, k, 256)).cast("string") for k in (1, 2, 3)))
    ip = F.when(longer == 0, ip).otherwise(F.concat_ws(":", F.lit("2001:db8"), *(F.substring(own, 4 * k + 1, 4) for k in range(6))))
    country = F.regexp_extract(canon, rf"^\+(?:{_SHORT_CODES}|\d{{1,3}})", 0)
    phone = F.concat(country, _drawn(own, F.substr(wider, F.char_length(country) + 1, F.lit(64))))
    return (
        F.when(kind == "email", email)
        .when(kind == "domain", reserved)
        .when(kind == "ip", ip)
        .when(kind == "phone", phone)
        .when(kind == "ssn", F.concat(F.lit("9"), F.substr(_drawn(own, wider), F.lit(2), F.lit(64))))
        .when(kind == "card", _with_check_digit(F.concat(F.substring(canon, 1, 1), F.substr(_drawn(own, wider), F.lit(2), F.lit(64)))))
        .when(kind == "iban", _iban(F.substring(canon, 1, 2), F.substr(_drawn(own, wider), F.lit(5), F.lit(64))))
        .otherwise(_name(own, kind, canon, longer))
    )


def rendered(kind: Column, surface: Column, form: Column) -> Column:
    """A surrogate in the format of one mention: its letters and digits one after another at the mention's places; what is
    left of a longer form follows."""
    part = F.when(kind == "iban", F.lit(r"[A-Z0-9]")).otherwise(F.lit(r"[0-9+]"))
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        fill = F.rlike(c, part)
        return F.struct((acc["n"] + fill.cast("int")).alias("n"), F.concat(acc["out"], F.when(fill, F.substr(form, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("out"))

    filled = F.aggregate(F.split(surface, ""), start, step, lambda acc: F.concat(acc["out"], F.substr(form, acc["n"] + 1, F.lit(99))))
    email = F.when(surface == F.lower(surface), form).when(surface == F.upper(surface), F.upper(form)).otherwise(F.initcap(form))
    return F.when(kind == "ip", form).when(kind == "email", email).otherwise(filled)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, form) with a form of its own for each entity, and none that is an entity of the corpus.

    The smallest of the entities that draw one form keeps it, unless an entity settled before has it; the others draw again.
    Only those are drawn and written in a round, so the rounds shrink fast.
    """
    waiting = saved(entities.select("kind", "canon").distinct().withColumn("attempt", F.lit(0)), "entities")
    known, settled = waiting.select("kind", F.col("canon").alias("form")), []
    for _ in range(MOST_DRAWINGS):
        drawn = saved(waiting.withColumn("form", surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt"))), "drawn")
        taken = reduce(DataFrame.union, [known, *(s.select("kind", "form") for s in settled)])
        first = drawn.groupBy("kind", "form", F.char_length("form").alias("_")).agg(F.min("canon").alias("canon")).drop("_")
        won = saved(first.join(taken, ["kind", "form"], "left_anti").select("kind", "canon", "form"), "surrogates")
        settled.append(won)
        waiting = saved(drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon", (F.col("attempt") + 1).alias("attempt")), "clashes")
        if waiting.isEmpty():
            return reduce(DataFrame.union, settled)
    raise RuntimeError(f"entities still clash after {MOST_DRAWINGS} drawings")


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with entities replaced in the text, and n_entities (mentions); n_chars follows the text where docs has it."""
    text, handle = F.col(text_col), F.xxhash64(F.col(id_col), F.col(text_col))  # of both, so that rows without an id don't share one
    found = docs.filter(text.rlike(LIKELY)).select(handle.alias("_handle"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))).alias("surface"))
    found = saved(found.withColumn("kind", kind_of(F.col("surface"))), "mentions")
    # a row for each entity of a mention: a name has a part or two, an address has a domain
    named = found.filter("kind = 'name'").select("_handle", "surface", F.posexplode(name_parts(F.col("surface"))).alias("at", "x")).select("_handle", "surface", "x.kind", F.col("x.part").alias("canon"), "at")
    plain = found.filter("kind <> 'name'").select("_handle", "surface", "kind", canonical(F.col("kind"), F.col("surface")).alias("canon"), F.lit(0).alias("at"))
    domains = plain.filter("kind = 'email'").select("_handle", "surface", F.lit("domain").alias("kind"), F.substring_index("canon", "@", -1).alias("canon"), F.lit(1).alias("at"))
    mentions = saved(plain.union(named).union(domains), "entity-mentions")
    forms = surrogates(mentions, key)

    met = mentions.join(forms, ["kind", "canon"])
    is_name = F.col("kind").isin("family", "given_f", "given_m", "given_n")
    parts = met.filter(is_name).groupBy("_handle", "surface").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "form"))), lambda x: x["form"]), " ").alias("name"))
    whole = parts.select("_handle", "surface", F.concat(F.substring_index("surface", " ", 1), F.lit(" "), "name").alias("new"))
    is_mail = F.col("kind").isin("email", "domain")
    mails = met.filter(is_mail).groupBy("_handle", "surface").agg(F.max(F.when(F.col("kind") == "email", F.substring_index("form", "@", 1))).alias("local"), F.max(F.when(F.col("kind") == "domain", F.col("form"))).alias("domain"))
    mails = mails.select("_handle", "surface", rendered(F.lit("email"), F.col("surface"), F.concat("local", F.lit("@"), "domain")).alias("new"))
    pairs = met.filter(~is_name & ~is_mail).select("_handle", "surface", rendered(F.col("kind"), F.col("surface"), F.col("form")).alias("new")).union(whole).union(mails)
    # a name's parts stand for themselves elsewhere in the text; of two kinds with one part the family name decides
    bare = met.filter(is_name).groupBy("_handle", F.col("canon").alias("surface")).agg(F.min_by("form", "kind").alias("new"))
    pairs = pairs.select("_handle", F.lit(False).alias("bare"), "surface", "new").union(bare.select("_handle", F.lit(True), "surface", "new"))
    as_map = lambda which: F.map_from_entries(F.collect_set(F.when(which, F.struct("surface", "new"))))
    new = pairs.groupBy("_handle").agg(as_map(~F.col("bare")).alias("_new"), as_map(F.col("bare")).alias("_bare"))

    others, likely = parted(docs, handle, found.select("_handle"))
    rows, own = set_aside(likely)
    text = own[text_col]
    rows = rows.withColumn("_handle", F.xxhash64(own[id_col], text)).join(new, "_handle", "left").withColumns({"_gaps": F.split(text, ENTITY, -1), "_found": F.when(F.col("_new").isNotNull(), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))})

    def gap(g: Column) -> Column:
        """A stretch between entities, with the names of the text's own people replaced word by word."""
        words = F.split(g, r"(?<![\p{L}\p{N}_'’-])(?=\p{Lu})|(?<=\p{Ll})(?![\p{L}\p{N}_-])")
        return F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at("_bare", w), w)), "")

    spelled = F.when(F.size("_bare") > 0, F.transform("_gaps", gap)).otherwise(F.col("_gaps"))
    parts = F.transform(F.arrays_zip(spelled.alias("gap"), F.col("_found").alias("found")), lambda x: F.concat(x["gap"], F.coalesce(F.element_at("_new", x["found"]), F.lit(""))))
    none = F.col("_found").isNull()  # a row that came along by chance
    rows = rows.withColumns({"_replaced": F.when(none, text).otherwise(F.array_join(parts, "")), "_n": F.when(none, 0).otherwise(F.size("_found")).cast("long")})
    rows = rows.select(*(c for name, c in own.items() if name not in (text_col, "n_entities")), F.col("_replaced").alias(text_col), F.col("_n").alias("n_entities"))
    out = others.withColumn("n_entities", F.lit(0).cast("long")).unionByName(rows)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.char_length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
