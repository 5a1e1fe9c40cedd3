"""Which charset captured bytes are in, and their text, in generated code.

Bytes that are valid UTF-8 are UTF-8, bytes that make sense in pairs are UTF-16. Whatever is left is judged by its high bytes and what
stands beside them: each charset is tried for each language that is written in it. A letter of that language counts for it, other
letters, symbols inside words, controls, a capital behind a small letter and neighbouring accents (in a language that has few) count
against it. The charset with the best mean over all high bytes wins; where two read the same text, the first of CHARSETS does.

High bytes are counted once, which gives each charset and language the score it has before anything stands against it. In the order of
these scores, neighbours are looked at only where the score is not below the best one found, so what wins is what would win if all were.

Defined cases: null bytes have no charset; empty and ASCII bytes are UTF-8; bodies of any length are read whole.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions.text import bound

# Letters beyond ASCII of the languages that a charset is used for.
FRENCH, GERMAN, SPANISH, ITALIAN = "éèàêçâîôûùëïœæÿ", "äöüß", "áéíóúñü", "àèéìòùî"
PORTUGUESE, NORDIC = "ãõáéíóúâêôçàü", "åäöøæéð"
CZECH, SLOVAK, POLISH, HUNGARIAN, ROMANIAN, CROATIAN = "áčďéěíňóřšťúůýž", "áäčďéíľňóôšťúýž", "ąćęłńóśźż", "áéíóöőúüű", "ăâîşţ", "čćđšž"
RUSSIAN, UKRAINIAN = "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя"
#: Signs that stand in texts of any language.
SIGNS = "\xa0«»“”„’‘‚–—…€°§©®·¿¡№№"
WESTERN, CENTRAL, CYRILLIC = [FRENCH, GERMAN, SPANISH, ITALIAN, PORTUGUESE, NORDIC], [CZECH, SLOVAK, POLISH, HUNGARIAN, ROMANIAN, CROATIAN], [RUSSIAN, UKRAINIAN]
#: Single-byte charsets and the languages each is tried for; the first wins a tie.
CHARSETS = {"windows-1252": WESTERN, "iso-8859-15": WESTERN, "windows-1250": CENTRAL, "iso-8859-2": CENTRAL, "windows-1251": CYRILLIC, "koi8-r": CYRILLIC[:1]}
#: Charsets of scripts whose words are all high bytes, and the script's most frequent letters.
FREQUENT = "оеаинтсрвл"
DENSE = ["windows-1251", "koi8-r"]
#: Other names of charsets, as pages state them; a page that states Latin-1 means the first.
NAMES = {
    "latin1": "windows-1252", "latin-1": "windows-1252", "iso-8859-1": "windows-1252", "cp1252": "windows-1252", "us-ascii": "windows-1252", "ascii": "windows-1252", "latin2": "iso-8859-2",
    "latin9": "iso-8859-15", "cp1250": "windows-1250", "cp1251": "windows-1251", "utf8": "utf-8", "utf-16": "utf-16le", "sjis": "shift_jis", "shift-jis": "shift_jis", "windows-31j": "shift_jis",
}
HIGH = "[\\x80-\\xFF]"
#: High bytes with the character on each side of them.
BESIDE = f"[^\\x80-\\xFF]?{HIGH}+[^\\x80-\\xFF]?"
#: UTF-16 units that texts are made of (Latin, Greek, Cyrillic, kana and their punctuation), low byte first and high byte first.
UNIT_LE, UNIT_BE = "[\\t\\n\\r\\x20-\\x7E\\xA0-\\xFF]\\x00|.[\\x01\\x03\\x04]|[\\x00-\\x1F\\x41-\\xFE]\\x30|[\\x10-\\x3F]\\x20", "\\x00[\\t\\n\\r\\x20-\\x7E\\xA0-\\xFF]|[\\x01\\x03\\x04].|\\x30[\\x00-\\x1F\\x41-\\xFE]|\\x20[\\x10-\\x3F]"
#: Two bytes that are no such unit by their high byte.
OTHER_LE, OTHER_BE = ".[^\\x00\\x01\\x03\\x04 0]", "[^\\x00\\x01\\x03\\x04 0]."
#: Shift-JIS characters: kana, signs and the kanji in use without those whose second byte is an ASCII letter; these kanji; all that have its form.
FIRM, LETTERED = "\\x82[\\x4F-\\xF1]|\\x83[\\x40-\\x96]|\\x81[\\x40-\\xAC]|[\\x88-\\x97][\\x40\\x5B-\\x60\\x7B-\\x7E\\x80-\\xFC]", "[\\x88-\\x97][A-Za-z]"
DOUBLE = "[\\x81-\\x9F\\xE0-\\xFC][\\x40-\\x7E\\x80-\\xFC]"


def high_letters(charset: str) -> str:
    """The 128 characters of a single-byte charset's high bytes, U+FFFD where it has none."""
    return bytes(range(128, 256)).decode(charset, errors="replace")


BYTES = "".join(map(chr, range(128, 256)))


def latin(body: Column) -> Column:
    """A string of a character for each byte."""
    return F.decode(body, "ISO-8859-1")


def _without(text: Column, pattern: str, instead: str = "") -> Column:
    return F.regexp_replace(text, f"(?s){pattern}", instead)


def _kept(text: Column, pattern: str, other: str) -> Column:
    """Number of characters in matches of ``pattern``, which is tried on the text two characters at a time; ``other`` are two that surely are none."""
    return F.length(_without(text, f"((?:{pattern})++)|(?:{other}|(?!{pattern})..)++|.", "$1"))


def _classes(charset: str, letters: str) -> str:
    """The class of each high byte: g letter of the language, G its capital, r and R the same where it is none of the frequent ones of a
    script of its own, p sign, w other letter, s symbol, c none or control."""
    upper = "".join(c.upper() for c in letters if len(c.upper()) == 1)
    rare = [c for c in letters + upper if charset in DENSE and c.lower() not in FREQUENT]
    kinds = []
    for c in high_letters(charset):
        kinds.append(("r" if c in letters else "R") if c in rare else "g" if c in letters else "G" if c in upper else "p" if c in SIGNS else "c" if c == "\ufffd" or ord(c) < 160 or "\u2500" <= c <= "\u25ff" else "w" if c.isalpha() else "s")
    return "".join(kinds)


ASCII_LETTERS, ASCII_CLASSES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "l" * 26 + "L" * 26
#: What a high byte of each class counts.
WORTH = {"g": 1.0, "G": 1.0, "r": 0.5, "R": 0.5, "p": 0.0, "w": -1.0, "s": -1.0, "c": -2.0}


def _against(classes: str, dense: bool) -> list[tuple[str, str, float]]:
    """What counts against a charset and language: a pattern of high bytes' neighbours, what stays of a match, and what each character that
    goes counts. The byte itself comes first in a pattern, what stands beside it is looked at only where it fits."""

    def of(kinds: str) -> str:
        return "[" + "".join(f"\\x{ord(c):02X}" for c, k in zip(BYTES + ASCII_LETTERS, classes + ASCII_CLASSES, strict=True) if k in kinds) + "]"

    found = [(f"(?s){of('GR')}(?<={of('lgr')}.)|{of('spc')}(?<={of('lLgr')}.)(?={of('lgr')})", "", 2.0)]
    if dense:  # high letters beside an ASCII one, each once
        return [*found, (f"(?s){of('lL')}(?<={of('gGwrR')}.)", "", 1.0), (f"{of('lL')}(?={of('gGwrR')}(?!{of('lL')}))", "", 1.0)]
    return [*found, (f"({of('gGw')}){of('gGw')}+", "$1", 0.25)]


def _japanese(s: Column, n_high: Column) -> Column:
    """The same for Shift-JIS: two for a character in use, less for rare ones and for bytes that are none. Kanji whose second byte is a letter
    count up to the number of other characters: a word in capitals with an accent before a letter looks like them."""

    def of(pairs: Column) -> Column:
        firm, lettered = (F.length(_without(pairs, f"((?:{p})++)|(?:(?!{p})..)++", "$1")) / 2 for p in (FIRM, LETTERED))
        in_use = firm + F.least(firm, lettered)
        stray = F.length(_without(s, f"(?:{DOUBLE}|[\\x00-\\x7F\\xA1-\\xDF])++"))
        return (3.0 * in_use - F.length(pairs) / 2 - 4.0 * stray) / n_high

    return bound(_without(s, f"((?:{DOUBLE})++)|[^\\x81-\\x9F\\xE0-\\xFC]++|.", "$1"), of)


def _sums(high: Column, worths: list[list[float]]) -> Column:
    """For a string of high bytes, the sum of each of the columns of ``worths``, which has a row for each byte: each byte in it is counted and taken out."""
    table = F.expr("array(" + ", ".join("array(" + ", ".join(f"{w}D" for w in row) + ")" for row in worths) + ")")

    def step(at: Column, _: Column) -> Column:
        rest, row = at["rest"], F.get(table, F.ascii(at["rest"]) - 128)

        def less(left: Column) -> Column:
            n = F.length(rest) - F.length(left)
            return F.struct(left.alias("rest"), F.zip_with(at["sums"], row, lambda total, worth: total + n * worth).alias("sums"))

        return F.when(rest == "", at).otherwise(bound(F.replace(rest, F.substring(rest, 1, 1), F.lit("")), less))

    start = F.struct(high.alias("rest"), F.array_repeat(F.lit(0.0), len(worths[0])).alias("sums"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(worths))), start, step)["sums"]


def _single_byte(s: Column) -> Column:
    """The best single-byte charset or Shift-JIS for a string of bytes that has a high one."""
    tried = [(name, -at, _classes(name, of), name in DENSE) for at, (name, languages) in enumerate(CHARSETS.items()) for of in languages]
    none = "cast(array() as array<struct<pattern:string,instead:string,each:double>>)"
    against = ["array(" + ", ".join(f"named_struct('pattern', r'{x}', 'instead', '{y}', 'each', {z}D)" for x, y, z in _against(classes, dense)) + ")" for _, _, classes, dense in tried]
    ends = [*((name, at, less) for (name, at, _, _), less in zip(tried, against, strict=True)), ("shift_jis", -len(CHARSETS), none)]
    profiles = F.expr("array(" + ", ".join(f"named_struct('name', '{name}', 'at', {at}, 'against', {less})" for name, at, less in ends) + ")")
    # Shift-JIS has at most four for each byte that characters in use begin with
    worths = [[*(WORTH[classes[k]] for _, _, classes, _ in tried), 4.0 if re.match("[\x81-\x83\x88-\x97]", c) else 0.0] for k, c in enumerate(BYTES)]

    def judged(b: Column) -> Column:
        beside, n_high = b["beside"], F.length(b["high"])

        def exact(p: Column, total: Column) -> Column:
            less = F.aggregate(p["against"], F.lit(0.0), lambda so_far, x: so_far + x["each"] * (F.length(beside) - F.length(F.regexp_replace(beside, x["pattern"], x["instead"]))))
            return F.when(p["name"] == "shift_jis", _japanese(b["s"], n_high)).otherwise((total - less) / n_high)

        def better(best: Column, c: Column) -> Column:
            p = F.get(profiles, c["k"])
            mine = bound(p, lambda p: F.struct(exact(p, c["total"]).alias("score"), p["at"].alias("at"), p["name"].alias("name")))
            return F.when(c["total"] / n_high < best["score"], best).otherwise(F.greatest(best, mine))

        ordered = F.sort_array(F.transform(_sums(b["high"], worths), lambda total, k: F.struct(total.alias("total"), (-k).alias("order"), k.alias("k"))), asc=False)
        return F.aggregate(ordered, F.struct(F.lit(float("-inf")).alias("score"), F.lit(-len(CHARSETS) - 1).alias("at"), F.lit("").alias("name")), better)["name"]

    beside = F.array_join(F.regexp_extract_all(s, F.lit(BESIDE), F.lit(0)), " ")
    return bound(bound(beside, lambda beside: F.struct(s.alias("s"), beside.alias("beside"), _without(beside, "[^\\x80-\\xFF]++").alias("high"))), judged)


def detected(body: Column) -> Column:
    """The charset of bytes, as nothing but the bytes tell."""
    return bound(F.struct(body.alias("body"), latin(body).alias("s")), lambda b: _detected(b["body"], b["s"]))


def _detected(body: Column, s: Column) -> Column:
    mark = F.hex(F.substring(body, 1, 3))
    utf8 = F.try_validate_utf8(body.cast("string")).isNotNull()
    paired = (F.length(body) >= 2) & (F.length(body) % 2 == 0) & (~utf8 | s.rlike("[\\x00-\\x08\\x0E-\\x1F]"))
    units = F.when(paired, F.array(_kept(s, UNIT_LE, OTHER_LE), _kept(s, UNIT_BE, OTHER_BE)))

    def of(kept: Column) -> Column:
        return (
            F.when(kept.isNotNull() & (F.array_max(kept) / F.length(body) > 0.55), F.when(kept[0] >= kept[1], "utf-16le").otherwise("utf-16be"))
            .when(utf8, "utf-8").otherwise(_single_byte(s))
        )

    return (
        F.when(body.isNull(), F.lit(None).cast("string")).when(mark.startswith("EFBBBF"), "utf-8").when(mark.startswith("FFFE"), "utf-16le").when(mark.startswith("FEFF"), "utf-16be")
        .otherwise(bound(units, of))
    )


def _from_escapes(escapes: Column) -> Column:
    """Text of JSON escapes, which know surrogate pairs."""
    return F.from_json(F.concat(F.lit('{"t":"'), escapes, F.lit('"}')), "t string")["t"]


def _utf16(body: Column, big: bool) -> Column:
    """UTF-16 without its mark; an odd last byte goes."""
    escapes = F.regexp_replace(F.regexp_replace(F.hex(body), "(..)(..)|..$", "\\\\u$1$2" if big else "\\\\u$2$1"), r"\\u$", "")
    return F.regexp_replace(_from_escapes(escapes), "^\\uFEFF", "")


def japanese_pairs() -> tuple[str, str]:
    """Both bytes of each Shift-JIS character as one code unit, its single high bytes, and the characters they stand for."""
    pairs = [bytes([a, b]) for a in (*range(0x81, 0xA0), *range(0xE0, 0xFD)) for b in (*range(0x40, 0x7F), *range(0x80, 0xFD))]
    units = [chr(p[0] << 8 | p[1]) for p in pairs] + [chr(b) for b in range(0x80, 0x100)]
    texts = [t if len(t := c.decode("cp932", errors="replace")) == 1 else "\ufffd" for c in [*pairs, *(bytes([b]) for b in range(0x80, 0x100))]]
    return "".join(units), "".join(texts)


def _shift_jis(body: Column) -> Column:
    """Shift-JIS: each character's bytes as one code unit, which never is a surrogate, and then by the table."""
    pair = "(?:[89E][0-9A-F]|F[0-9A-C])(?<!80|A.)(?:[4-7][0-9A-F]|[89A-E][0-9A-F]|F[0-9A-C])(?<!7F)"
    escapes = F.regexp_replace(F.regexp_replace(F.hex(body), f"({pair})|(..)", "\\\\u$1$2"), r"\\u(..)(?=\\|$)", "\\\\u00$1")
    return F.translate(_from_escapes(escapes), *japanese_pairs())


def text_of(body: Column, charset: Column) -> Column:
    """Bytes as text by a charset's name (any of NAMES, too); unknown names are read as windows-1252, bytes that a charset lacks as U+FFFD."""
    given = F.lower(F.trim(charset))
    name = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), given), given)
    return bound(F.struct(body.alias("body"), name.alias("name")), lambda b: _text(b["body"], b["name"]))


def _text(body: Column, name: Column) -> Column:
    out = F.when(name == "utf-8", F.regexp_replace(body.cast("string"), "^\\uFEFF", "")).when(name == "utf-16le", _utf16(body, False)).when(name == "utf-16be", _utf16(body, True)).when(name == "shift_jis", _shift_jis(body))
    s = latin(body)
    single = [n for n in CHARSETS if n != "windows-1252"]
    out = reduce(lambda at, n: at.when(name == n, F.translate(s, BYTES, high_letters(n))), single, out)
    return F.when(body.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.translate(s, BYTES, high_letters("windows-1252"))))
