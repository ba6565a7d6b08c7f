"""Replacement of personal data by surrogates, in DataFrame operations only.

Every kind of entity gets a replacement of its own kind and form: digits for digits, letters
of the same script and case for letters, a name of the same gender and script for a name, a
card number that passes its check digit.  Replacements follow from a secret key and the
entity, so one person stays one person wherever and however written; names behind a title
are also replaced where the same text has them without one.  Over the whole corpus
two entities of a kind never share a replacement, and none is replaced by an entity of its
kind that occurs (all names are one kind here): of those that clash all but one draw again
until no clash is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import dropped, staged, unused

# The kinds of entities and how they are written, in order of precedence.
# Letters and digits as ranges: a lookup that is far cheaper at every character than Unicode properties.
_W = r"0-9A-Za-zªµºÀ-ÖØ-öø-ʯͰ-῿Ⰰ-ⷿ々-퟿豈-﷿ﹰ-ﻼ"
_WORD_EDGE = rf"(?<![{_W}])"
_WORD_END = rf"(?![{_W}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_TITLES_F = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Madame", "Mlle", "Señora", "Señorita", "Sra", "г-жа", "госпожа", "Κυρία", "κα")
_TITLES_M = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "Κύριος", "κος")
_TITLES_U = ("Dr", "Prof", "Doctor", "Professor", "Mx")
# Two letters at least; marks within a name belong to it, a possessive s does not.
_NAME = r"\p{Lu}(?:\p{L}++|(?=['’-]\p{L}))(?:['’-](?!s(?!\p{L}))\p{L}++)*+"
_TITLES = "|".join((*_TITLES_F, *_TITLES_M, *_TITLES_U))
_KEY = r"(?i:password|passwd|passphrase|secret|token|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key)"
_SURE_KEY = r"(?i:password|passwd|passphrase|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key)"
# How published kinds of tokens begin.
_TOKEN_HEADS = r"sk-(?:proj-|ant-)?|[rs]k_(?:live|test)_|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|AIza|hf_|npm_"
_H = "[0-9A-Fa-f]{1,4}"
# All but secrets begin at a word's edge, which ANY tests once for all of them.
PATTERNS: dict[str, str] = {
    "secret": rf"(?<=[=\"':]|[=:] )(?:(?<={_KEY}(?:=|[\"']? ?[=:] ?[\"']))|(?<={_SURE_KEY}: ?)|(?<={_KEY}(?:: ?| = ))(?=[^\s\"']*[0-9]))[^\s\"']{{6,}}",
    "bearer": r"(?<=[rRcCnN] )(?<=(?i:bearer|basic|token) )(?:(?<=(?i:authorization[\"']?: ?[\"']?(?:bearer|basic|token)) )|(?=[^\s\"']{16})(?=[^\s\"']*[0-9]))[^\s\"',;]{6,}",
    "email": rf"(?<![._%+-])[{_W}._%+-]{{1,256}}+@[{_W}-]{{1,63}}(?:\.[{_W}-]{{1,63}}){{0,8}}\.\p{{L}}{{2,24}}",
    "ip6": rf"(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,6}}(?::{_H}){{1,6}}|(?:{_H}:){{1,7}}:)(?![{_W}:])",
    "ip": r"(?<!\.)(?:" + _OCTET + r"\.){3}" + _OCTET + rf"(?![{_W}]|\.[0-9])",
    "phone": rf"(?<!\+)(?:\+1[ .-]?\([0-9]{{3}}\) ?[0-9]{{3}}[ .-]?[0-9]{{4}}|\+[0-9]{{1,3}}(?:[ .-]?\(?[0-9]{{1,4}}\)?){{1,2}}[ .-]?[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}|\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}|[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}|00[1-9][0-9]{{0,2}}[ .-](?:\(?[0-9]{{1,4}}\)?[ .-]?){{1,2}}[0-9]{{3,4}}[ .-]?[0-9]{{3,4}})(?![{_W}])",
    "ssn": rf"(?<!-)[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![{_W}-])",
    "card": r"(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{13,19})" + _WORD_END,
    "hex": r"(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}+" + _WORD_END,
    "token": rf"(?:{_TOKEN_HEADS})[0-9A-Za-z_-]{{16,}}+",
    "access_key": r"(?:AKIA|ASIA)[0-9A-Z]{16}" + _WORD_END,
    "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}(?: ?[0-9]{4}){2,6}(?: ?[0-9]{1,3})?" + _WORD_END,
    "person": rf"(?:{_TITLES})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
_AT_DIGITS, _AT_CAPITALS = ("ip", "phone", "ssn", "card"), ("access_key", "iban", "person")
ANY = (
    PATTERNS["secret"] + "|" + PATTERNS["bearer"] + "|" + _WORD_EDGE + "(?:" + PATTERNS["email"]
    + "|(?=[0-9+(])(?:" + "|".join(PATTERNS[k] for k in _AT_DIGITS) + ")|(?=[0-9a-f]{32})" + PATTERNS["hex"] + "|(?=[Aghnrsx])" + PATTERNS["token"] + "|(?=[0-9A-Fa-f]{1,4}:)" + PATTERNS["ip6"]
    + r"|(?=[A-Z]|[^\x00-\x7F]|κ)(?:" + "|".join(PATTERNS[k] for k in _AT_CAPITALS) + "))"
)

# Given names by gender and script, and family names by script.
_NAMES: dict[str, tuple[str, ...]] = {
    "f_latin": ("Anna", "Clara", "Elena", "Emma", "Eva", "Grace", "Hanna", "Helen", "Ida", "Irene", "Julia", "Laura", "Lena", "Lucia", "Maria", "Martha", "Nora", "Paula", "Rosa", "Sara", "Sofia", "Teresa", "Vera", "Zoe"),
    "m_latin": ("Adam", "Albert", "Bruno", "Daniel", "David", "Eric", "Felix", "Georg", "Henri", "Hugo", "Ivan", "Jakob", "Julian", "Karl", "Leo", "Lucas", "Marco", "Martin", "Oscar", "Paul", "Robert", "Simon", "Thomas", "Victor"),
    "u_latin": ("Alex", "Andrea", "Ariel", "Ash", "Blake", "Casey", "Charlie", "Dana", "Eden", "Florence", "Jamie", "Jordan", "Kim", "Lee", "Marion", "Morgan", "Noel", "Pat", "Quinn", "Robin", "Rowan", "Sasha", "Sky", "Taylor"),
    "s_latin": ("Adler", "Bauer", "Berger", "Blanc", "Brook", "Carter", "Costa", "Duran", "Field", "Fischer", "Garnier", "Hale", "Keller", "Lambert", "Marin", "Moreno", "Novak", "Parker", "Reyes", "Rossi", "Silva", "Stone", "Vidal", "Weber"),
    "f_cyrillic": ("Анна", "Вера", "Дарья", "Елена", "Зоя", "Ирина", "Лидия", "Мария", "Нина", "Ольга", "София", "Юлия"),
    "m_cyrillic": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев", "Максим", "Олег", "Павел", "Роман"),
    "u_cyrillic": ("Саша", "Женя", "Валя", "Слава", "Шура", "Тося", "Паша", "Вася", "Ася", "Миша", "Витя", "Тоня"),
    "s_cyrillic": ("Белых", "Гречко", "Живаго", "Коваленко", "Круглых", "Лысенко", "Мороз", "Петренко", "Романенко", "Седых", "Ткач", "Черных"),
    "f_greek": ("Άννα", "Ελένη", "Ειρήνη", "Ζωή", "Μαρία", "Νίκη", "Σοφία", "Χαρά"),
    "m_greek": ("Αλέξης", "Γιώργος", "Ηλίας", "Κώστας", "Νίκος", "Πέτρος", "Στέλιος", "Φώτης"),
    "u_greek": ("Αγαθή", "Δανάη", "Ευγενία", "Θάλεια", "Ιώ", "Λήδα", "Ρέα", "Χλόη"),
    "s_greek": ("Βαλέτα", "Δούκα", "Κομνηνού", "Λάμπρου", "Μαυρή", "Παύλου", "Ράλλη", "Φωκά"),
}
_LETTERS = {"latin": ("abcdefghijklmnopqrstuvwxyz", r"\p{IsLatin}"), "cyrillic": ("абвгдежзиклмнопрстуфхцчшщэюя", r"\p{IsCyrillic}"), "greek": ("αβγδεζηθικλμνξοπρστυφχψω", r"\p{IsGreek}")}
# Letters without case; a letter of none of these scripts becomes a Latin one.
_CASELESS = {
    r"\p{IsHan}": "".join(chr(0x4E00 + 37 * i) for i in range(128)), r"\p{IsHangul}": "".join(chr(0xAC00 + 83 * i) for i in range(128)),
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह", r"\p{IsThai}": "กขคงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหอฮ",
}
_SIGNS = "!#$%&*+-.:?@^_~"


#: What every secret of a key word, value behind a word and token has, in lower case or as it stands.
_HINTS_LOW = ("password", "passwd", "passphrase", "secret", "token", "key", "bearer", "basic")
_HINTS = ("sk-", "k_live_", "k_test_", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "xox", "AIza", "hf_", "npm_")


def may_hold(text: Column) -> Column:
    """A cheap necessary test: whatever is an entity has a digit, a sign, a key word, or a title."""
    out = text.rlike("[0-9@=]")
    for title in (*_TITLES_F, *_TITLES_M, *_TITLES_U, *_HINTS):
        out = out | text.contains(title)
    for hint in _HINTS_LOW:
        out = out | F.lower(text).contains(hint)
    return F.coalesce(out, F.lit(False))


def mentions(text: Column) -> Column:
    """All that may be an entity of a text, as written, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANY), F.lit(0))


def _mere_number(before: Column, mention: Column) -> Column:
    """Whether a run of digits fails the check digit of cards and stands behind no key word, so that it is no entity."""
    return F.when(mention.rlike(r"\A[0-9]{13,19}\z"), ~_luhn(mention) & ~before.rlike(_KEY + r"[\"']? ?[=:] ?[\"']?\z")).otherwise(F.lit(False))


def _luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of those before it."""
    number = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    each = F.transform(number, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def kind_of(mention: Column) -> Column:
    """The kind of an entity that ``mentions`` found; a value after ``password=`` is a secret unless it looks like another kind."""
    out = None
    for kind, pattern in PATTERNS.items():
        if kind not in ("secret", "bearer"):
            hit = mention.rlike(rf"\A(?:{pattern})\z")
            if kind == "card":
                hit = hit & F.when(mention.rlike(r"\A[0-9]+\z"), _luhn(mention)).otherwise(F.lit(True))
            out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out.otherwise(F.lit("secret"))


def _script(c: Column) -> Column:
    return F.when(c.rlike(_LETTERS["cyrillic"][1]), "cyrillic").when(c.rlike(_LETTERS["greek"][1]), "greek").otherwise("latin")


_DIGITS_ONLY = ("phone", "ssn", "card")


def identities(mention: Column, kind: Column) -> Column:
    """What a mention names: ``array<struct<cls, canon>>``.  Names are one entry for each part, others a single one."""
    gender = F.when(mention.rlike(rf"\A(?:{'|'.join(_TITLES_F)})\.? "), "f").when(mention.rlike(rf"\A(?:{'|'.join(_TITLES_M)})\.? "), "m").otherwise("u")
    names = F.split(F.regexp_replace(mention, rf"\A(?:{_TITLES})\.? ", ""), " ")
    parts = F.transform(
        names,
        lambda w, i: F.struct(F.concat(F.when(i == F.size(names) - 1, F.lit("s")).otherwise(gender), F.lit("_"), _script(w)).alias("cls"), F.lower(w).alias("canon")),
    )
    canon = (
        F.when(kind.isin(*_DIGITS_ONLY), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind.isin("email", "ip6"), F.lower(mention))
        .otherwise(mention)
    )
    return F.when(kind == "person", parts).otherwise(F.array(F.struct(kind.alias("cls"), canon.alias("canon"))))


def _draw(cls: Column, canon: Column, attempt: Column, key: str) -> Column:
    """A pseudo-random seed in hex that follows from the key, the identity and the attempt."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), cls, canon, attempt.cast("string")), 512)


def _block(seed: Column, k: Column) -> Column:
    """64 bytes in hex: as many blocks as a value needs."""
    return F.sha2(F.concat_ws("\u0001", seed, k.cast("string")), 512)


def _byte(seed: Column, i: Column) -> Column:
    return F.conv(F.substring(_block(seed, (i / 64).cast("int")), F.pmod(i, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _same_form(c: Column, b: Column) -> Column:
    """A character of the class of c chosen by the number b; signs and combining marks stay."""
    out = F.when(c.rlike(r"\p{Nd}"), F.pmod(b, F.lit(10)).cast("string"))
    for letters, script in _LETTERS.values():
        low = _from(letters, b)
        out = out.when(c.rlike(script), F.when(c.rlike(r"\p{Lu}"), F.upper(low)).otherwise(low))
    for script, letters in _CASELESS.items():
        out = out.when(c.rlike(script) & c.rlike(r"\p{L}"), _from(letters, b))
    return out.when(c.rlike(r"\p{L}"), _from(_LETTERS["latin"][0], b)).otherwise(c)


def _from(letters: str, b: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))


def surrogate(cls: Column, canon: Column, attempt: Column) -> Column:
    """The replacement of an identity at an attempt, in canonical form, by the column ``seed`` that ``_draw`` made.

    Secrets, emails and names, whose own form may allow few values, grow with the attempt
    from the ninth on, so there is always one that is free.  Numbers keep their length.
    """
    seed = F.col("seed")
    h = F.concat(_block(seed, F.lit(-1)), _block(seed, F.lit(-2)))
    chars = F.split(canon, "")
    form = lambda keep: F.array_join(F.transform(chars, lambda c, i: F.when(i < keep, c).otherwise(_same_form(c, _byte(seed, i)))), "")
    tld = F.length(F.substring_index(canon, ".", -1))
    email = F.array_join(F.transform(chars, lambda c, i: F.when(i >= F.size(chars) - tld, c).otherwise(_same_form(c, _byte(seed, i)))), "")
    hexes = F.array_join(F.transform(chars, lambda c, i: F.substring(F.lit("0123456789abcdef"), F.pmod(_byte(seed, i), F.lit(16)) + 1, F.lit(1))), "")
    # a short form that is used up becomes a whole address
    ip6 = F.array_join(F.transform(F.when(attempt < 8, chars).otherwise(F.split(F.lit(":".join(["0000"] * 8)), "")), lambda c, i: F.when(c == ":", c).otherwise(F.substring(F.lit("0123456789abcdef"), F.pmod(_byte(seed, i), F.lit(16)) + 1, F.lit(1)))), "")
    # a value of hardly anything but signs gets other signs
    signs = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(r"[\p{L}\p{Nd}]"), _same_form(c, _byte(seed, i))).otherwise(_from(_SIGNS, _byte(seed, i)))), "")
    secret = F.when(F.length(F.regexp_replace(canon, r"[^\p{L}\p{Nd}]", "")) < 6, signs).otherwise(form(0))
    more = F.when(attempt >= 8, F.substring(F.reverse(h), F.lit(1), 2 * (attempt - 7))).otherwise(F.lit(""))
    email = F.concat(F.substring_index(email, "@", 1), more, F.lit("@"), F.substring_index(email, "@", -1))
    octets = F.array_join(F.transform(F.split(canon, r"\."), lambda c, i: (F.pmod(F.conv(F.substring(h, i * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(254)) + 1).cast("string")), ".")
    body = F.transform(F.slice(chars, 1, F.size(chars) - 1), lambda c, i: F.when(i < 1, c).otherwise(F.pmod(_byte(seed, i), F.lit(10)).cast("string")))
    n = F.size(body)
    total = F.aggregate(
        F.transform(body, lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))), F.lit(0), lambda a, b: a + b
    )
    card = F.concat(F.array_join(body, ""), F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))
    phone = F.when(F.length(canon) == 11, form(1)).otherwise(form(F.greatest(F.length(canon) - 10, F.lit(0))))
    out = (
        F.when(cls == "email", email).when(cls == "ip6", ip6).when(cls == "hex", hexes).when((cls == "secret") & canon.rlike(r"\A(?=[0-9]*[a-f])[0-9a-f]+\z"), F.concat(hexes, more))
        .when(cls == "secret", F.concat(secret, more)).when(cls == "access_key", form(4))
        .when(cls == "token", F.concat(form(F.length(F.regexp_extract(canon, rf"\A(?:{_TOKEN_HEADS})", 0))), more))
        .when(cls == "iban", form(2)).when(cls == "ip", octets).when(cls == "phone", phone).when(cls == "card", card)
    )
    for name, pool in _NAMES.items():
        size = len(pool)
        number = F.conv(F.substring(h, 1, 12), 16, 10).cast("long")
        # one to four names joined by hyphens, and from the ninth attempt on one more each time
        pick = lambda k, p=pool, s=size, x=number: F.element_at(F.lit(list(p)), (F.pmod((x / s**k).cast("long"), F.lit(s)) + 1).cast("int"))
        rest = F.transform(F.sequence(F.lit(4), F.greatest(attempt, F.lit(9)) - 5), lambda k: F.element_at(F.lit(list(pool)), F.pmod(F.conv(F.substring(h, F.pmod(k, F.lit(64)) * 4 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(size)) + 1))  # noqa: B023
        made = F.concat_ws("-", pick(0), F.when(attempt >= 1, pick(1)), F.when(attempt >= 4, pick(2)), F.when(attempt >= 8, pick(3)), F.when(attempt >= 9, F.concat_ws("-", rest)))
        out = out.when(cls == name, made)
    return out.otherwise(form(0))


def _family(cls: Column) -> Column:
    """The class, one for all names: no name becomes a name that occurs, whatever its gender or place."""
    return F.when(cls.isin(*_NAMES), F.lit("name")).otherwise(cls)


def surrogates(entities: DataFrame, key: str, label: str = "pii-surrogates", most_rounds: int = 200) -> DataFrame:
    """Rows ``(cls, canon, sur)`` for distinct ``(cls, canon)``: within a class no two are equal, and none is itself an entity of its class, or a name that occurs.

    Each round the entity of least hash keeps a contested replacement and the others draw
    again, never what is taken; a lost race costs one more round over the losers alone.
    Only numbers, which keep their length, can run out of values: where entities take nearly
    all that a form has, ``most_rounds`` ends the search with an error instead of a result.
    """
    known = staged(entities.select("cls", "canon").distinct(), label)
    open_, done, attempt, spent = known, None, 0, []
    while True:
        # the seed is a column of a table, so that no character draws it anew
        seeded = staged(open_.withColumn("seed", _draw(F.col("cls"), F.col("canon"), F.lit(attempt), key)), label)
        drawn = seeded.withColumn("sur", surrogate(F.col("cls"), F.col("canon"), F.lit(attempt))).drop("seed")
        clash = known.select(_family(F.col("cls")).alias("family"), F.lower("canon").alias("low"))
        free = drawn.withColumn("low", F.lower("sur")).withColumn("family", _family(F.col("cls"))).join(clash, ["family", "low"], "left_anti").drop("family")
        if done is not None:
            free = free.join(done.select("cls", F.lower("sur").alias("low")), ["cls", "low"], "left_anti")
        free = staged(free, label)
        first = free.groupBy("cls", "low").agg(F.min_by("canon", F.xxhash64("canon")).alias("canon"))
        won = staged(free.join(first, ["cls", "low", "canon"]).select("cls", "canon", "sur"), label)
        done = won if done is None else staged(done.unionByName(won), label)
        lost = staged(open_.join(won.select("cls", "canon"), ["cls", "canon"], "left_anti"), label)
        spent += [seeded, free, won]
        if lost.isEmpty():
            dropped(*[x for x in spent if x is not done])
            return done
        if attempt + 1 >= most_rounds:
            raise RuntimeError(f"no replacement is free after {most_rounds} rounds for entities of the classes {sorted(r['cls'] for r in lost.select('cls').distinct().limit(20).collect())}")
        open_, attempt = lost, attempt + 1


def _rendered(mention: Column, kind: Column, subs: Column) -> Column:
    """The replacement written as the mention was: its separators, its case, its title."""
    sur = F.element_at(subs, 1)
    chars = F.split(mention, "")
    place = lambda i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda c: c.rlike("[0-9]")))
    digits = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(sur, place(i), F.lit(1))).otherwise(c)), "")
    solid = lambda i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda c: c != " "))
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.substring(sur, solid(i), F.lit(1)))), "")
    title = F.regexp_extract(mention, rf"\A(?:{_TITLES})\.? ", 0)
    words = F.split(F.substring(mention, F.length(title) + 1, F.length(mention)), " ")
    names = F.array_join(F.transform(subs, lambda s, i: F.when((F.length(F.get(words, i)) > 1) & (F.get(words, i) == F.upper(F.get(words, i))), F.upper(s)).otherwise(s)), " ")
    return (
        F.when(kind.isin(*_DIGITS_ONLY), digits).when(kind == "iban", spaced)
        .when(kind.isin("email", "ip6"), F.when(mention == F.upper(mention), F.upper(sur)).otherwise(sur))
        .when(kind == "person", F.concat(title, names)).otherwise(sur)
    )


def replacements(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """Rows ``(mention, kind, replacement)`` for every distinct mention of the corpus."""
    # explode_outer: for explode Catalyst would find the mentions twice, once to test for their presence
    text = F.col(text_col).cast("string")
    seen = docs.where(may_hold(text)).select(F.explode_outer(mentions(text)).alias("mention")).where("mention is not null").distinct()
    seen = seen.withColumn("kind", kind_of(F.col("mention"))).withColumn("subs", identities(F.col("mention"), F.col("kind")))
    seen = staged(seen, "pii-mentions")
    parts = _same_given_names(seen.select("mention", "kind", F.posexplode("subs").alias("at", "x")).select("mention", "kind", "at", "x.*"))
    chosen = surrogates(parts, key)
    whole = parts.join(chosen, ["cls", "canon"]).groupBy("mention", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "sur"))), lambda p: p["sur"]).alias("subs"))
    out = staged(whole.select("mention", "kind", _rendered(F.col("mention"), F.col("kind"), F.col("subs")).alias("replacement")), "pii-replacements")
    dropped(seen, chosen)
    return out


def _same_given_names(parts: DataFrame) -> DataFrame:
    """A name behind a title of no gender has the gender that most other mentions give it, so Dr and Mr John are one."""
    plain = F.substring("cls", 3, 32)
    of = parts.where(F.col("cls").rlike("^[fm]_")).groupBy(plain.alias("_script"), F.col("canon").alias("_canon")).agg(F.count_if(F.col("cls").startswith("f_")).alias("_f"), F.count("*").alias("_n"))
    joined = parts.join(of, F.col("cls").startswith("u_") & (plain == F.col("_script")) & (F.col("canon") == F.col("_canon")), "left")
    gender = F.when(F.col("_f") * 2 >= F.col("_n"), F.lit("f_")).otherwise(F.lit("m_"))
    return joined.withColumn("cls", F.when(F.col("_n").isNull(), F.col("cls")).otherwise(F.concat(gender, plain))).drop("_script", "_canon", "_f", "_n")


#: What a text consists of, for the search of names: words that may be names, and all between them.
_PIECES = rf"(?<!\p{{L}}){_NAME}|[^\p{{Lu}}]+|\p{{Lu}}"


def _names_of(found: Column) -> Column:
    """``array<struct<word, sur>>`` of the names behind the titles of a text: as written, in capitals, and with a capital only."""
    bare = lambda c: F.split(F.regexp_replace(c, rf"\A(?:{_TITLES})\.? ", ""), " ")
    pairs = F.flatten(F.transform(F.filter(found, lambda x: x["kind"] == "person"), lambda x: F.zip_with(bare(x["mention"]), bare(x["replacement"]), lambda w, s: F.struct(w.alias("word"), s.alias("sur")))))
    pairs = F.array_sort(pairs)
    capitals = F.transform(pairs, lambda p: F.struct(F.upper(p["word"]).alias("word"), F.upper(p["sur"]).alias("sur")))
    shouted = F.filter(pairs, lambda p: p["word"] == F.upper(p["word"]))
    return F.concat(pairs, capitals, F.transform(shouted, lambda p: F.struct(F.initcap(F.lower(p["word"])).alias("word"), F.initcap(F.lower(p["sur"])).alias("sur"))))


def replaced(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", entities_col: str | None = None) -> DataFrame:
    """``docs`` with the entities of each text replaced; ``entities_col``, if named, adds what was replaced.

    That column is ``array<struct<kind, replacement>>`` of the text's distinct entities.
    Null texts stay null; texts without entities pass unchanged, without a shuffle.  Rows are
    joined to their replacements by id and a hash of the text, so equal or null ids are no
    harm, and all other columns stay.  An empty input gives an empty result.
    """
    if entities_col and entities_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {entities_col}; name another")
    table = replacements(docs, text_col, key)
    id_, mark, found_, words, surs = unused(docs, "id_", "mark_", "found_", "words_", "surs_")
    text = F.col(text_col).cast("string")
    kind = "array<struct<kind:string,replacement:string>>"
    has = may_hold(text) & F.coalesce(text.rlike(ANY), F.lit(False))
    clean = docs.where(~has)
    touched = docs.where(has)
    hits, between = mentions(text), F.split(text, ANY, -1)
    listed = F.zip_with(between, hits, lambda a, m: F.when(~_mere_number(a, m), m))
    held = touched.select(F.col(id_col).alias(id_), F.xxhash64(text).alias(mark), F.explode_outer(F.array_distinct(listed)).alias("mention")).where("mention is not null")
    found = (
        held.join(table, "mention").groupBy(id_, mark)
        .agg(F.collect_set(F.struct("mention", "kind", "replacement")).alias(found_))
        .withColumn("names", _names_of(F.col(found_)))
        .select(id_, mark, found_, F.transform("names", lambda x: x["word"]).alias(words), F.transform("names", lambda x: x["sur"]).alias(surs))
    )
    joined = touched.join(found, touched[id_col].eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(mark)), "left").drop(id_, mark)
    lookup = F.map_from_entries(F.transform(found_, lambda x: F.struct(x["mention"], x["replacement"])))
    of_name = lambda t: F.coalesce(F.get(F.col(surs), (F.array_position(words, t) - 1).cast("int")), t)
    unnamed = lambda x: F.array_join(F.transform(F.regexp_extract_all(x, F.lit(_PIECES), F.lit(0)), of_name), "")
    rest = lambda x: F.when(F.size(words) > 0, unnamed(x)).otherwise(x)
    put = lambda a, m: F.when(m.isNull(), F.lit("")).when(_mere_number(a, m), m).otherwise(F.coalesce(F.element_at(lookup, m), m))
    new = F.array_join(F.zip_with(between, hits, lambda a, m: F.concat(rest(a), put(a, m))), "")
    out = joined.withColumn(text_col, new)
    if entities_col:
        made = F.array_sort(F.transform(F.coalesce(F.col(found_), F.array().cast("array<struct<mention:string,kind:string,replacement:string>>")), lambda x: F.struct(x["kind"].alias("kind"), x["replacement"].alias("replacement"))))
        out, clean = out.withColumn(entities_col, made.cast(kind)), clean.withColumn(entities_col, F.array().cast(kind))
    return clean.unionByName(out.drop(found_, words, surs))
