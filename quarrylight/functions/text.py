"""Text functions of the evidence engine as Column expressions (Unicode white space, code-point lengths)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the evidence contract.
# (both begin with white space: looking for that first spares the other characters both alternatives)
SPLIT_PROSE = r"(?=\s)(?:(?<=[.!?。！？;；])\s+|\n[ \t]*\n+)"
SPLIT_TABLE = r"(?=\s)(?:(?<=[.!?。！？;；])\s+|\n+)"
TABLE_PAGE = r"(?:^|\n)\s*Table\s+(?:S?\d+|[IVX]+)\b"
DOI = r"10\.\d{4,9}/[-._;()/:A-Z0-9]+"
TEMPERATURE = r"(?<!\d)(-?\d+(?:\.\d+)?)\s*(?:°\s*)?[CK](?![A-Za-z])"
TABLE_TEMPERATURE = r"(?<!\d)(-?\d+(?:\.\d+)?(?:\s*[−–-]\s*-?\d+(?:\.\d+)?)?)\s*(?:°\s*)?[CK](?![A-Za-z])"
TABLE_NUMBER = r"(?<![A-Za-z0-9.])(?:~|∼|≈)?\d+(?:\.\d+)?(?:\s*[−–-]\s*\d+(?:\.\d+)?)?(?![A-Za-z0-9.])"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
SHORTEST, LONGEST = 35, 1600
#: White space of the contract: Unicode's and the four separators from 1C to 1F.
SPACE = r"[\s\x1c-\x1f]"


def java(pattern: str, ignore_case: bool = False) -> str:
    """A profile's pattern in the dialect of the engine: Unicode classes, \\n as the only line end, named groups."""
    return ("(?diuU)" if ignore_case else "(?dU)") + pattern.replace("(?P<", "(?<")


def _re(pattern: str, ignore_case: bool = False) -> Column:
    return F.lit(java(pattern, ignore_case))


def matches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_like(text, _re(pattern, ignore_case))


def find_all(text: Column, pattern: str, ignore_case: bool = False, group: int = 0) -> Column:
    return F.regexp_extract_all(text, _re(pattern, ignore_case), F.lit(group))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def squeeze(text: Column) -> Column:
    """White space of any kind and length becomes one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"(?U){SPACE}+", " "))  # one blank at most is left at either end


def compact(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){SPACE}+", "")


def clean(text: Column) -> Column:
    """NUL to blank, soft hyphens out, runs of blanks and of blank lines shortened, ends stripped."""
    text = F.replace(F.replace(text, F.lit("\0"), F.lit(" ")), F.lit("­"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n[ \t]+", "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def one_line(text: Column) -> Column:
    """squeeze(clean(text)): where all white space becomes one blank, what clean() does to blanks and lines makes no difference."""
    return squeeze(F.replace(F.replace(text, F.lit("\0"), F.lit(" ")), F.lit("\u00ad"), F.lit("")))


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(20)))


def file_hash(content: Column) -> Column:
    return F.upper(F.sha2(content, 256))


def source_id(digest: Column) -> Column:
    return stable_id("src", digest)


def fact_id(source: Column, page: Column, sentence: Column) -> Column:
    return stable_id("fact", source, page.cast("string"), sentence)


def utf16_length(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("long")


def is_table_page(text: Column) -> Column:
    return matches(text, TABLE_PAGE, True)


def themes(text: Column, groups: dict[str, str]) -> Column:
    """Names of the keyword groups that occur, in the profile's order."""
    if not groups:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*(F.when(matches(text, p, True), F.lit(n)) for n, p in groups.items())))


def sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def dois(text: Column) -> Column:
    """DOIs without trailing marks, sorted, 50 at most."""
    found = F.transform(find_all(text, DOI, True), lambda x: F.regexp_replace(x, r"[.,;:)\]}]+$", ""))
    return F.slice(sorted_set(found), 1, 50)


def confidence(values: Column, theme: Column, formulas: Column) -> Column:
    return F.when((F.size(values) > 0) & ((F.size(theme) > 0) | (F.size(formulas) > 0)), "high").otherwise("medium")


def is_verified(status: Column) -> Column:
    return F.coalesce(F.regexp_like(status, F.lit("^(human|agent)_verified")), F.lit(False))


def pdf_coverage(text_chars: Column, pages: Column) -> Column:
    return F.when(text_chars >= F.greatest(F.lit(200), 20 * pages), "text_extracted").otherwise("ocr_or_manual_review_required")


def use_ocr(embedded: Column, ocr: Column) -> Column:
    """OCR text replaces a page's own if it has 20 characters and more than twice as many (and more than 20)."""
    n = F.length(F.coalesce(ocr, F.lit("")))
    return (n >= 20) & (n > F.greatest(F.lit(20), 2 * F.length(F.coalesce(embedded, F.lit("")))))


#: Elements that are added up one by one behind a sum that is known.
STRIDE = 64


def let(value: Column, body) -> Column:
    """body(value), with value computed once: what stands in a lambda is computed anew for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before_each(lengths: Column) -> Column:
    """For each element of an array of whole numbers, the sum of those before it. Sums of strides first, so that the cost stays near the
    array's length (growing an array inside a fold would copy it at each step)."""
    add = lambda t, x: t + x
    sums = lambda v: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / STRIDE).cast("int") - 1, F.lit(0))), lambda k: F.aggregate(F.slice(v, k * STRIDE + 1, F.lit(STRIDE)), F.lit(0), add))
    heads = lambda s: F.transform(s, lambda _, k: F.aggregate(F.slice(s, F.lit(1), k), F.lit(0), add))
    each = lambda v, h: F.transform(v, lambda _, i: F.get(h, F.floor(i / STRIDE).cast("int")) + F.aggregate(F.slice(v, i - i % STRIDE + 1, i % STRIDE), F.lit(0), add))
    return let(lengths, lambda v: let(sums(v), lambda s: let(heads(s), lambda h: each(v, h))))


def pieces(text: Column, pattern: Column) -> Column:
    """array<struct<piece, start>>: what stands between matches, with code-point offsets from 0."""
    gaps = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    found = F.struct(F.split(text, pattern, -1).alias("p"), gaps.alias("g"))

    def put(f: Column) -> Column:
        steps = F.transform(f["p"], lambda x, i: F.length(x) + F.coalesce(F.get(f["g"], i), F.lit(0)))
        return let(before_each(steps), lambda at: F.transform(f["p"], lambda x, i: F.struct(x.alias("piece"), F.get(at, i).alias("start"))))

    return let(found, put)


def match_offsets(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    """array<struct<text, start, end>> of nonempty matches, in code points."""
    got = find_all(text, pattern, ignore_case)
    found = F.struct(F.transform(F.split(text, _re(pattern, ignore_case), -1), F.length).alias("g"), got.alias("m"))

    def put(f: Column) -> Column:
        steps = F.transform(f["m"], lambda x, i: F.length(x) + F.get(f["g"], i))
        # a match begins behind the gap before it
        return let(before_each(steps), lambda at: F.transform(f["m"], lambda x, i: F.struct(x.alias("text"), (F.get(at, i) + F.get(f["g"], i)).alias("start"), (F.get(at, i) + F.get(f["g"], i) + F.length(x)).alias("end"))))

    return F.filter(let(found, put), lambda x: x["end"] > x["start"])


def filename_metadata(stem: Column, category: Column) -> Column:
    """struct<title, year, venue_or_institution, publication_number> from names such as "venue - year - title"."""
    parts = F.transform(F.split(stem, " - "), strip)
    year = F.try_element_at(parts, F.lit(2))
    year = F.when(F.regexp_like(year, F.lit(r"^\d+$")), year.cast("int"))
    paper = category.isin("paper", "thesis") & (F.size(parts) >= 3)
    patent = category == "patent"
    return F.struct(
        F.when(paper, F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts), F.lit(1))), " - ")).otherwise(stem).alias("title"),
        F.when(paper | patent, year).alias("year"),
        F.when(paper, F.element_at(parts, 1)).alias("venue_or_institution"),
        F.when(patent, F.element_at(parts, 1)).alias("publication_number"),
    )


def section(text: Column, headings: list[str], stops: list[str], longest: int = 12000, shortest: int = 80) -> Column:
    """Text behind the first heading that has `shortest` characters before the earliest stop heading."""
    whole = clean(text)
    found = []
    for h in headings:
        rx = "(?dimuU)" + h
        tail = F.try_element_at(F.split(whole, F.lit(rx), 2), F.lit(2))
        for s in stops:
            tail = F.element_at(F.split(tail, F.lit("(?dimuU)" + s), 2), 1)
        value = clean(F.left(tail, F.lit(longest)))
        found.append(F.when(F.length(value) >= shortest, value))
    return F.coalesce(*found)


def clean_doi(text: Column) -> Column:
    """First DOI in a text, lower case, without URL prefix and trailing marks."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_extract(text, java("(" + DOI + ")", True), 1), r"[.,;:)\]}]+$", "")), F.lit(""))


def plain_doi(text: Column) -> Column:
    """A catalogue's DOI field: lower case, without resolver, "doi:" and trailing marks; empty for null."""
    bare = F.lower(strip(F.coalesce(text, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"^https?://(?:dx\.)?doi\.org/", ""), r"(?U)^doi:\s*", ""), r"(?U)[\s.,;)]+$", "")


def document_doi(candidates: Column) -> Column:
    """The first candidate that looks whole (no cut-off year at its end), lower case."""
    whole = F.filter(candidates, lambda d: F.regexp_like(d, F.lit(r"(?U)^10\.\d{4,9}/\S{4,}$")) & ~F.regexp_like(d, F.lit(r"(?U)\.(?:19|20)\d{0,2}$")))
    return F.lower(F.get(whole, F.lit(0)))


def safe_name(text: Column, longest: int = 120) -> Column:
    """A part of a file name: no reserved characters, single blanks, an ellipsis where it is cut."""
    plain = F.regexp_replace(squeeze(F.regexp_replace(text, r'[<>:"/\\|?*\x00-\x1f]', " ")), r"[ .]+$", "")
    return F.when(F.length(plain) > longest, F.concat(F.regexp_replace(F.left(plain, F.lit(longest - 1)), r"\s+$", ""), F.lit("…"))).otherwise(plain)


def author_list(names: Column) -> Column:
    """a; a and b; a, b, and c."""
    n = F.size(names)
    return F.when(n <= 2, F.array_join(names, " and ")).otherwise(F.concat(F.array_join(F.slice(names, F.lit(1), F.greatest(n - 1, F.lit(1))), ", "), F.lit(", and "), F.element_at(names, -1)))


# Symbols of the chemical elements.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd "
    "Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac "
    "Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
)


def clean_formula(text: Column) -> Column:
    return F.translate(text, "−– ", "--")


def formula_key(text: Column) -> Column:
    """Key under which spellings of one oxide meet."""
    return F.lower(F.regexp_replace(F.translate(clean_formula(text), "δd", ""), r"(?i)O(?:3(?:\.0)?)?[+\-]?$", ""))


def valid_formula(text: Column) -> Column:
    """Has a digit, known elements alone, oxygen with a number up to 12, and two other elements."""
    whole = clean_formula(text)
    core = F.translate(whole, "+-δdx", "")
    tokens = F.regexp_extract_all(core, F.lit(r"([A-Z][a-z]?)(?:\d+(?:\.\d+)?)?"), F.lit(1))
    known = F.array(*(F.lit(e) for e in ELEMENTS.split()))
    oxygen = F.regexp_extract(core, r"O(\d+(?:\.\d+)?)", 1)
    others = F.array_remove(F.array_distinct(tokens), "O")
    placeholder = reduce(lambda a, b: a | b, (F.contains(whole, F.lit(t)) for t in ("ABO", "A2BO", "DVO")))
    return F.regexp_like(whole, F.lit(r"\d")) & ~placeholder & (F.size(tokens) > 0) & (F.size(F.array_except(tokens, known)) == 0) & (oxygen != "") & (oxygen.try_cast("double") <= 12) & (F.size(others) >= 2)


def parse_number(text: Column) -> Column:
    """Plain numbers and a×10^b."""
    t = F.replace(F.regexp_replace(text, r"\s+", ""), F.lit("−"), F.lit("-"))
    power = F.pow(F.lit(10.0), F.regexp_extract(t, r"[×x]10(-?\d+)$", 1).try_cast("double"))
    return F.when(F.regexp_like(t, F.lit(r"^[0-9.]+[×x]10-?\d+$")), F.regexp_extract(t, r"^([0-9.]+)", 1).try_cast("double") * power).otherwise(t.try_cast("double"))
