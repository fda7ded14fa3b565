"""Text expressions: hygiene, names, categories, numbers, scripts and URLs. All are plain columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rewrites that fold a name, in order, as (pattern, replacement).
FOLDS = [
    ("[^a-z]", ""),
    ("aa+", "a"),
    ("ee+|ii+", "i"),
    ("oo+|uu+", "u"),
    ("w", "v"),
    ("z", "j"),
    ("ph", "f"),
    ("q", "k"),
    ("([bcdgjkpt])h", "$1"),
    ("sh", "s"),
    ("rh", "r"),
    ("y", "i"),
    ("(.)\\1", "$1"),
]
# Words that give a direction or tell twin places apart, by family.
DIRECTIONS = {
    "east": "purv|poorv|purab",
    "west": "pash?chim|pachim",
    "north": "uttar|utter",
    "south": "daksh[ai]n|dakhin|dachhin",
}
TWINS = {
    "kalan": r"\bkal[ae]?n\b|\bkalaan\b",
    "khurd": r"\bkhurd\b|\bkhurad\b",
    "buzurg": r"\bbuzurg\b|\bbujurg\b",
    "khas": r"\bkhas\b|\bkhaas\b",
}
ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4}
# Titles and last words of person names.
WOMAN_TITLES = ["smt", "shrimati", "srimati", "kumari", "km", "mrs", "ms"]
OTHER_TITLES = ["sh", "shri", "sri", "mr", "dr", "mohd", "md", "ch", "ch.", "late"]
WOMAN_NAMES = ["kaur", "devi", "rani", "kumari", "bai", "begum", "khatoon", "khatun", "bano", "banu", "bibi", "wati", "vati", "lata", "bala"]
MAN_NAMES = ["kumar", "singh", "lal", "ram", "chand", "dass", "das", "parsad", "prasad", "khan", "ali", "dutt", "nath", "parkash", "prakash", "bhan", "dev"]
# What a cell of a vacant seat begins with.
VACANT = ["rikt", "riet", "vacant", "fjDr", "[kkyh"]
# Printed category tokens to (caste, woman).
CATEGORIES = {
    "UNRESERVED": ("NONE", False),
    "UNREASERVED": ("NONE", False),
    "GENERAL": ("NONE", False),
    "WOMEN": ("NONE", True),
    "WOMAN": ("NONE", True),
    "SC": ("SC", False),
    "BC": ("BC", False),
    "SCWOMEN": ("SC", True),
    "SCWOMAN": ("SC", True),
    "BCWOMEN": ("BC", True),
    "BCWOMAN": ("BC", True),
}
DEVANAGARI_DIGITS = "०१२३४५६७८९"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", None).otherwise(c)


def squash(c: Column) -> Column:
    """White space of any kind to single spaces, apostrophes to one form, trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, "‘’`´", "''''"), r"(?U)\s+", " "))


def undouble(c: Column) -> Column:
    """Runs of one character to a single one."""
    return F.regexp_replace(c, r"(.)\1+", "$1")


def fold(c: Column) -> Column:
    """A spelling-tolerant form of a name in Latin letters; null folds to the empty text."""
    return reduce(lambda x, f: F.regexp_replace(x, f[0], f[1]), FOLDS, F.lower(F.coalesce(c, F.lit(""))))


def _stated(c: Column, words: dict[str, str]) -> Column:
    return F.filter(F.array(*[F.when(F.regexp_like(c, F.lit(p)), F.lit(w)) for w, p in words.items()]), lambda x: x.isNotNull())


def name_key(c: Column) -> Column:
    """struct(folded, numbers, directions): numbers and twin words leave the folded name, compass words stay in it."""
    low = F.lower(F.coalesce(c, F.lit("")))
    roman = F.transform(F.regexp_extract_all(low, F.lit(r"\b(i{1,3}|iv)\b"), 1), lambda r: reduce(lambda x, kv: F.when(r == kv[0], kv[1]).otherwise(x), ROMAN.items(), F.lit(None).cast("int")))
    digits = F.transform(F.regexp_extract_all(low, F.lit(r"(\d+)"), 1), lambda d: d.cast("int"))
    bare = reduce(lambda x, p: F.regexp_replace(x, p, " "), TWINS.values(), F.regexp_replace(low, r"\b(i{1,3}|iv)\b|\d+", " "))
    return F.struct(fold(bare).alias("folded"), F.array_sort(F.array_distinct(F.concat(digits, roman))).alias("numbers"), F.array_sort(_stated(low, DIRECTIONS | TWINS)).alias("directions"))


def qualifiers_conflict(a: Column, b: Column) -> Column:
    """Both state something of one family, and not the same."""
    out = F.lit(False)
    for family in (DIRECTIONS, TWINS):
        words = F.array(*[F.lit(w) for w in family])
        x, y = F.array_sort(F.array_intersect(a, words)), F.array_sort(F.array_intersect(b, words))
        out = out | ((F.size(x) > 0) & (F.size(y) > 0) & (x != y))
    return out


def vetoed(a: Column, b: Column) -> Column:
    """Keys whose numbers or qualifiers contradict each other."""
    return ((F.size(a["numbers"]) > 0) & (F.size(b["numbers"]) > 0) & (a["numbers"] != b["numbers"])) | qualifiers_conflict(a["directions"], b["directions"])


def letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "")


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")


def is_vacant(c: Column) -> Column:
    """Blank, or beginning with one of the words for a vacant seat."""
    s = F.trim(F.coalesce(c, F.lit("")))
    return reduce(lambda x, p: x | F.startswith(F.lower(s), F.lit(p.lower())), VACANT, s == "")


def strip_unopposed(c: Column) -> Column:
    """struct(name, unopposed): leading asterisks mark an unopposed winner."""
    s = F.trim(c)
    return F.struct(F.trim(F.regexp_replace(s, r"^\*+", "")).alias("name"), F.startswith(s, F.lit("*")).alias("unopposed"))


def ward_number(c: Column) -> Column:
    """The only number of one to three digits in `Ward No. 3`, `3`, or Devanagari digits; else null."""
    s = F.translate(F.trim(c), DEVANAGARI_DIGITS, "0123456789")
    return F.regexp_extract(s, r"(?i)^(?:ward\s*(?:no)?\.?\s*)?(\d{1,3})$", 1).try_cast("int")


def is_dash(c: Column) -> Column:
    return F.regexp_like(F.trim(c), F.lit("^[-–—&.·]+$"))


def exact_category(c: Column) -> Column:
    """struct(caste, woman) of a printed category after everything but capitals is dropped; nulls if unknown."""
    token = F.regexp_replace(F.upper(c), "[^A-Z]", "")
    caste = reduce(lambda x, kv: F.when(token == kv[0], kv[1][0]).otherwise(x), CATEGORIES.items(), F.lit(None).cast("string"))
    woman = reduce(lambda x, kv: F.when(token == kv[0], kv[1][1]).otherwise(x), CATEGORIES.items(), F.lit(None).cast("boolean"))
    return F.struct(caste.alias("caste"), woman.alias("woman"))


def category_ladder(c: Column) -> Column:
    """struct(caste, woman, script) of a loosely printed category, or null where nothing is recognised.

    Devanagari first, then the legacy font, then Latin letters. In each, tribe is looked for before caste, and head
    nouns before qualifiers, since these are misprinted in many ways.
    """
    s = squash(F.coalesce(c, F.lit("")))
    caste = lambda st, sc, bc: F.when(st, "ST").when(sc, "SC").when(bc, "BC_A").otherwise("NONE")
    out = lambda k, w, n: F.struct(k.alias("caste"), w.cast("int").alias("woman"), F.lit(n).alias("script"))
    has = lambda x, w: F.contains(x, F.lit(w))
    deva = out(caste(has(s, "जनजाति"), has(s, "अनुसूचित"), has(s, "पिछड़ा")), F.when(has(s, "सिवाय"), 0).otherwise(1), "devanagari")
    kd, tight = F.replace(undouble(s), F.lit("+"), F.lit("")), undouble(F.regexp_replace(s, r"[\s+]", ""))
    like = lambda p, q: F.regexp_like(kd, F.lit(p)) | F.regexp_like(tight, F.lit(q))
    other = has(kd, "flok;") | has(tight, "flok;") | F.endswith(F.rtrim(kd), F.lit(" ds")) | F.endswith(tight, F.lit("ds"))
    legacy = out(caste(like(r"vuq\S*\s+tutkfr", r"vuq\w*tutkfr"), like(r"vuq\S*\s+tkfr", r"vuq\w*tkfr"), has(kd, "fiNM") | has(tight, "fiNM")), F.when(other, 0).otherwise(1), "krutidev")
    low = F.lower(s)
    flat = F.regexp_replace(low, "[^a-z]", "")
    words = F.transform(F.split(low, r"\s+"), lambda w: F.regexp_replace(w, "[^a-z]", ""))
    word = lambda w: F.array_contains(words, w)
    k = caste(has(flat, "trib") | word("st"), has(flat, "cast") | has(flat, "sched") | word("sc"), has(flat, "clas") | has(flat, "back") | word("bc") | word("bca"))
    woman = F.when(has(flat, "wom"), F.when(has(flat, "otherthan"), 0).otherwise(1)).when(has(flat, "unres") | has(low, "general") | (k != "NONE"), 0)
    latin = F.when(woman.isNotNull(), out(k, woman, "latin"))
    return F.when(s == "", None).when(has(s, "महिला"), deva).when(has(kd, "efgyk") | has(tight, "efgyk"), legacy).otherwise(latin)


def category_label(caste: Column, woman: Column) -> Column:
    prefix = F.when(caste == "BC_A", "BC-A ").when(caste == "NONE", "").otherwise(F.concat(caste, F.lit(" ")))
    return F.concat(prefix, F.when(woman.cast("boolean"), "Woman").otherwise("Other than Woman"))


def office_kind(c: Column) -> Column:
    """sarpanch, panch or samiti from a printed office cell; null if none."""
    low = F.lower(c)
    return F.when(F.contains(low, F.lit("sarpanch")), "sarpanch").when(F.contains(low, F.lit("samiti")), "samiti").when(F.contains(low, F.lit("panch")), "panch")


def name_tokens(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z ]", " "), " +"), lambda w: w != "")


def name_parts(c: Column) -> Column:
    """struct(first_name, woman_marker, man_marker, woman_title) after leading titles are taken off."""
    titles, woman = F.array(*[F.lit(w) for w in WOMAN_TITLES + OTHER_TITLES]), F.array(*[F.lit(w) for w in WOMAN_TITLES])
    words = name_tokens(c)
    lead = F.aggregate(words, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, w: F.struct((a["n"] + F.when(a["on"] & F.array_contains(titles, w), 1).otherwise(0)).alias("n"), (a["on"] & F.array_contains(titles, w)).alias("on")), lambda a: a["n"])
    rest = F.slice(words, lead + 1, F.greatest(F.size(words) - lead, F.lit(0)))
    last = F.when(F.size(rest) > 1, F.element_at(rest, -1)).otherwise("")
    return F.struct(
        F.get(rest, 0).alias("first_name"),
        last.isin(WOMAN_NAMES).cast("int").alias("woman_marker"),
        last.isin(MAN_NAMES).cast("int").alias("man_marker"),
        F.arrays_overlap(F.slice(words, 1, lead), woman).cast("int").alias("woman_title"),
    )


def numeric_token(c: Column) -> Column:
    """struct(value, reason): a printed number; dashes, leading zeros and unexpected decimals become null with a reason."""
    s = F.trim(c)
    reason = F.when(s.isNull() | (s == ""), "blank").when(F.regexp_like(s, F.lit("^[-–—]+$")), "dash").when(F.regexp_like(s, F.lit(r"^0\d+$")), "leading_zero").when(F.regexp_like(s, F.lit(r"^\d+\.\d+$")), "decimal").when(~F.regexp_like(s, F.lit(r"^\d+$")), "not_a_number")
    return F.struct(F.when(reason.isNull(), s).cast("long").alias("value"), reason.alias("reason"))


def script_of(c: Column) -> Column:
    return F.when(F.regexp_like(c, F.lit(r"[ऀ-ॿ]")), "Devanagari").when(F.regexp_like(c, F.lit("[A-Za-z]")), "Latin").otherwise("Unreadable")


def control_characters(c: Column) -> Column:
    """Whether a text holds control characters other than tab, line feed and carriage return."""
    return F.regexp_like(c, F.lit(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"))


def url_method(c: Column) -> Column:
    return F.when(c.isNull() | (F.trim(c) == ""), "unknown").when(F.contains(c, F.lit("web.archive.org/")), "wayback").otherwise("live")


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def page_identity(sha: Column, page: Column) -> Column:
    return F.format_string("%s-p%04d", sha, page)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(100 * part, whole), F.lit(0.0))


def logit(p: Column, abstained: Column | None = None) -> Column:
    """Log odds, p clipped to [0.0001, 0.9999] and null taken as one half; an abstention contributes 0."""
    q = F.least(F.greatest(F.coalesce(p, F.lit(0.5)), F.lit(1e-4)), F.lit(1 - 1e-4))
    out = F.log(q / (1 - q))
    return out if abstained is None else F.when(abstained, 0.0).otherwise(out)


def flags_of(c: Column) -> Column:
    """A `;`-delimited flag cell as a sorted set."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")))


def flags_changed(c: Column, add: list[str] = [], remove: list[str] = []) -> Column:  # noqa: B006
    kept = F.array_except(c, F.array(*[F.lit(x) for x in remove]).cast("array<string>"))
    return F.array_sort(F.array_union(kept, F.array(*[F.lit(x) for x in add]).cast("array<string>")))


def flags_text(c: Column) -> Column:
    return F.array_join(F.array_sort(c), ";")


def collapse_repeats(c: Column) -> Column:
    """An array without elements equal to the one before."""
    return F.filter(c, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(c, i - 1)))


def trailing_run(c: Column, test) -> Column:
    """The last elements of an array, as far back as test holds."""
    n = F.aggregate(F.reverse(c), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.struct((a["n"] + F.when(a["on"] & test(x), 1).otherwise(0)).alias("n"), (a["on"] & test(x)).alias("on")), lambda a: a["n"])
    return F.slice(c, F.size(c) - n + 1, n)


def split_at_anchor(cells: Column, is_anchor) -> Column:
    """struct(before, anchor, after): cells around the first that is an anchor; null without one."""
    at = F.get(F.filter(F.transform(cells, lambda x, i: F.when(is_anchor(x), i)), lambda i: i.isNotNull()), 0)
    return F.when(at.isNotNull(), F.struct(F.slice(cells, 1, at).alias("before"), F.get(cells, at).alias("anchor"), F.slice(cells, at + 2, F.greatest(F.size(cells) - at - 1, F.lit(0))).alias("after")))


def place_case(c: Column) -> Column:
    """Words with a capital, Roman numerals in capitals."""
    return F.array_join(F.transform(F.split(F.trim(c), r"\s+"), lambda w: F.when(F.regexp_like(w, F.lit("(?i)^[ivx]+$")), F.upper(w)).otherwise(F.initcap(F.lower(w)))), " ")


def trailing_numbers(line: Column) -> Column:
    """struct(label, tokens): the run of numbers or dashes that ends a fixed-width line, and what stands before it."""
    run = F.regexp_extract(line, r"((?:(?:^|\s)(?:\d[\d.]*|[-–—]))+)\s*$", 1)
    return F.struct(F.trim(F.substring(F.rtrim(line), F.lit(1), F.char_length(F.rtrim(line)) - F.char_length(F.rtrim(run)))).alias("label"), F.filter(F.split(F.trim(run), r"\s+"), lambda x: x != "").alias("tokens"))


def font_text(c: Column, glyphs: Sequence[tuple[str, str]], early: dict[str, str], late: dict[str, str]) -> Column:
    """The Devanagari text of a font that keeps its letters at other places; glyphs are replaced in turn.

    late: marks printed after a syllable whose sign is spoken before it; early: marks printed before a consonant cluster whose
    sign is spoken after it. Both map the mark to the sign. A mark that is left without its cluster is an error.
    White space is squashed; `similarity.composed` gives the canonical form of what is left.
    """
    letter = "[\u0915-\u0939\u0958-\u095f]\u093c?"
    cluster, signs = f"{letter}(?:\u094d{letter})*", "[\u093e-\u094c\u0901-\u0903]*"
    out = reduce(lambda x, g: F.replace(x, F.lit(g[0]), F.lit(g[1])), glyphs, c)
    for mark, sign in late.items():
        out = F.regexp_replace(out, f"({cluster}{signs})\\Q{mark}\\E", f"{sign}$1")
    for mark, sign in early.items():
        out = F.regexp_replace(out, f"\\Q{mark}\\E({cluster})", f"$1{sign}")
    stray = reduce(lambda x, m: x | F.contains(out, F.lit(m)), [*early, *late], F.lit(False))
    return F.when(stray, F.raise_error(F.concat(F.lit("a mark without its consonants: "), out)).cast("string")).otherwise(F.trim(F.regexp_replace(out, r"(?U)\s+", " ")))


# Spellings of offices, categories in Devanagari, tiers of offices.
OFFICE_SPELLINGS = {"PARICH": "PANCH", "PONCH": "PANCH", "SARPANCN": "SARPANCH"}
OFFICE_TIERS = {"PANCH": "gp_ward", "SARPANCH": "gp_head", "पंच": "gp_ward", "सरपंच": "gp_head"}
HINDI_CATEGORIES = {"सामान्य": "NONE", "अनुसूचितजाति": "SC", "अनुजाति": "SC", "पिछड़ीजाति": "BC", "पिछडीजाति": "BC"}
HINDI_WOMAN = "महिला"
# How a notification names its number, its block and its district.
NOTICE_NUMBER = r"(?i){year}\s*[@/]\s*(\d{{3,5}})\s*[.,\-–—&]{{0,3}}\s*(?:Dated\s*:?\s*[\d.\-/]+\s*)?(?:In\s+pursuance|gfj;k\.kk\s+iapk;rh\s+jkt|,rn)"
PLACE_LATIN = r"""(?i)Block\s*[-–—]?\s*['‘"]?\s*([A-Za-z][A-Za-z0-9 .&\-]{1,30}?)\s*['’"]?\s*,?\s*(?:and\s+)?District\s*[-–—:]?\s*['‘"]?\s*([A-Za-z][A-Za-z .&\-]{1,25}?)\s*(?:during|for|in\b|,|$)"""
PLACE_FONT = r"\[k\.M&\s*([^\]]{1,30}?)\]\s*ftyk&\s*(\S{1,30}?)\s"


def _mapped(c: Column, values: dict) -> Column:
    return reduce(lambda x, kv: F.when(c == kv[0], kv[1]).otherwise(x), values.items(), F.lit(None).cast("string"))


def candidate_category(c: Column) -> Column:
    """struct(caste, woman): the exact categories, and those of a general seat for a woman; nulls if unknown."""
    token, known = F.regexp_replace(F.upper(c), "[^A-Z]", ""), exact_category(c)
    general = known["caste"].isNull() & token.isin("GENERALWOMAN", "GENERALWOMEN")
    return F.struct(F.when(general, "NONE").otherwise(known["caste"]).alias("caste"), F.when(general, True).otherwise(known["woman"]).alias("woman"))


def page_category(c: Column) -> Column:
    """struct(caste, woman) of a category in Latin letters or, in canonical form, Devanagari; the word for woman alone is a general seat."""
    latin, value = candidate_category(c), F.regexp_replace(c, r"[\s.,()\-]", "")
    woman, rest = F.contains(value, F.lit(HINDI_WOMAN)), F.replace(value, F.lit(HINDI_WOMAN), F.lit(""))
    hindi = F.when((rest == "") & woman, "NONE").otherwise(_mapped(rest, HINDI_CATEGORIES))
    caste = F.coalesce(latin["caste"], hindi)
    return F.struct(caste.alias("caste"), F.when(latin["caste"].isNotNull(), latin["woman"]).when(hindi.isNotNull(), woman).alias("woman"))


def normalized_office(c: Column) -> Column:
    """An office in capitals without marks around it, known misprints mended; null is the empty text."""
    bare = F.regexp_replace(F.upper(F.trim(F.coalesce(c, F.lit("")))), r"^[ .\-*•]+|[ .\-*•]+$", "")
    return F.coalesce(_mapped(bare, OFFICE_SPELLINGS), bare)


def office_tier(office: Column, family: Column) -> Column:
    """The tier that a printed office has; pages of block members need none; else null."""
    blank = F.coalesce(office, F.lit("")) == ""
    return F.coalesce(_mapped(normalized_office(office), OFFICE_TIERS), F.when(blank & (family == "block_member"), "block_member"))


def anchored_ward(c: Column) -> Column:
    """A ward number of one or two digits (also Devanagari) in a cell that may hold `Ward No.` and footnote marks; else null."""
    s = F.translate(F.regexp_replace(c, r"[*†‡§¹²³\s]+", " "), DEVANAGARI_DIGITS, "0123456789")
    return F.regexp_extract(F.trim(s), r"(?i)^(?:ward\s*(?:no)?\.?\s*)?(\d{1,2})$", 1).try_cast("int")


def notice_number(c: Column, year: int) -> Column:
    """A notification's own number of a year; null where only other notifications are cited."""
    return blank_to_null(F.regexp_extract(c, NOTICE_NUMBER.format(year=year), 1))


def notice_place(c: Column) -> Column:
    """struct(block, district, script) that a notification is about: latin first, then the legacy font; null if it names none."""
    out = F.lit(None).cast("struct<block:string,district:string,script:string>")
    for pattern, script in ((PLACE_FONT, "krutidev"), (PLACE_LATIN, "latin")):
        found = F.struct(squash(F.regexp_extract(c, pattern, 1)).alias("block"), squash(F.regexp_extract(c, pattern, 2)).alias("district"), F.lit(script).alias("script"))
        out = F.when(F.regexp_like(c, F.lit(pattern)), found).otherwise(out)
    return out


def flag_text(c: Column) -> Column:
    """"", 0 or 1 of a boolean."""
    return F.coalesce(c.cast("int").cast("string"), F.lit(""))


def cell_json(*cells: Column) -> Column:
    """Cells as one JSON object with nulls kept, in the order given."""
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def place_and_person(cells: Column) -> Column:
    """struct(place, person) of the cells before an office: a cell of dashes parts them; without one, all but the last are the place."""
    parted, words = split_at_anchor(cells, is_dash), lambda a: F.array_join(F.filter(a, lambda x: F.trim(x) != ""), " ")
    n = F.size(cells)
    place = F.when(parted.isNotNull(), words(parted["before"])).otherwise(words(F.slice(cells, 1, F.greatest(n - 1, F.lit(0)))))
    person = F.when(parted.isNotNull(), words(parted["after"])).otherwise(F.coalesce(F.get(cells, n - 1), F.lit("")))
    return F.struct(blank_to_null(place).alias("place"), blank_to_null(person).alias("person"))
