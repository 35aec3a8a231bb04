"""Column expressions over running text. Patterns use Unicode classes, and ``.`` stops at line feeds only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forms of headings, page markers, anchors and wiki links.
CHAPTER = r"(?iU)^(?:#{1,6}\s+.+|Chapter\s+\d+|Part\s+[IVX\d]+|Section\s+\d+|第[一二三四五六七八九十百千]+[章节篇部])"
PAGE_MARKER = r"<!--\s*PAGE:(\d+)\s*-->"
ANCHOR = r"\[raw/[^\n]+?\.(?:pdf|epub|md|txt)#(?:p\d+(?:-p?\d+)?|L\d+(?:-L?\d+)?)\]"
LOOSE_ANCHOR = r"\[raw/[^\n]+?\.(?:pdf|epub|md|txt)[^\]\n]*\]"
ANY_ANCHOR = r"\[raw/[^\n]+?\.(?:pdf|epub|md|txt)(?:#(?:p\d+(?:-p?\d+)?|L\d+(?:-L?\d+)?))?\]"
WIKILINK = r"\[\[([^\[\]]*?)\]\]"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lines(c: Column) -> Column:
    """Lines, whatever sign ends them."""
    return F.split(F.regexp_replace(c, "\r\n|[\r\u000b\f\u001c-\u001e\u0085  ]", "\n"), "\n")


def word_count(c: Column) -> Column:
    """Runs of Latin letters plus Chinese characters."""
    return (F.regexp_count(c, F.lit("[A-Za-z]+")) + F.regexp_count(c, F.lit("[一-鿿]"))).cast("bigint")


def is_chapter(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "").rlike(CHAPTER)


def usable_chars(c: Column) -> Column:
    """Length without page markers and outer white space."""
    return F.length(strip(F.regexp_replace(c, PAGE_MARKER, ""))).cast("bigint")


def page_of(c: Column, last: bool = False) -> Column:
    """The first or last page marker's number in a text, null without one."""
    found = F.regexp_extract_all(c, F.lit(PAGE_MARKER), F.lit(1))
    return F.try_element_at(found, F.lit(-1 if last else 1)).cast("int")


def language_zh_en(c: Column) -> Column:
    """``zh`` if there are more Chinese characters than Latin letters, ``en`` if not, ``unknown`` without either."""
    zh, en = F.regexp_count(c, F.lit("[一-鿿]")), F.regexp_count(c, F.lit("[A-Za-z]"))
    return F.when((zh == 0) & (en == 0), "unknown").when(zh > en, "zh").otherwise("en")


def one_line(c: Column, most: int = 200) -> Column:
    """First paragraph on one line; what is longer than ``most`` is cut and ends in three dots."""
    first = F.get(F.split(strip(c), r"\n[ \t]*\n"), F.lit(0))
    flat = strip(F.regexp_replace(first, r"(?U)\s+", " "))
    return F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - 3), F.lit("..."))).otherwise(flat)


def slugify(c: Column) -> Column:
    """Lower case, everything but letters a-z and figures to single hyphens, ``untitled`` if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "untitled").otherwise(s)


def slug_id(c: Column) -> Column:
    """A kebab-case id; what leaves nothing becomes ``page-`` and the start of the SHA-1 of the value."""
    low = F.lower(strip(c))
    s = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(low.rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$"), low).when(s != "", s).otherwise(F.concat(F.lit("page-"), F.substring(F.sha1(c), 1, 10)))


def book_stem(c: Column) -> Column:
    """The stem of a book's file name: a-z, 0-9 and Chinese characters, hyphens for the rest, 60 characters at most."""
    name = F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.[^.]+$", "")
    s = F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9一-鿿]+", "-"), "^-+|-+$", "")
    s = F.regexp_replace(F.substring(s, 1, 60), "-+$", "")
    return F.when(s == "", "untitled").otherwise(s)


def slug_key(c: Column) -> Column:
    """What near-duplicate slugs share: no brackets, single hyphens, and no article at either end."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), r"\(.*?\)", ""), "[-_]+", "-"), "^-+|-+$", "")
    for article in ("the", "a", "an"):
        s = F.regexp_replace(F.regexp_replace(s, f"^{article}-", ""), f"-{article}$", "")
    return s


#: Slips in anchors as they occur, and what is meant: a comma or a second sign in a range, and doubled
#: extensions and signs.
RANGE_SLIPS = {r"#(p|L)(\d+),\s*(p|L)?(\d+)\]": "#$1$2-$3$4]", r"#(p|L)(\d+)-#(p|L)(\d+)\]": "#$1$2-$3$4]"}
PATH_SLIPS = {r"(?i)(\.(?:pdf|epub|md|txt))(?:\1)+": "$1"}
PLACE_SLIPS = {r"\bL{2,}(\d)": "L$1", r"\bp{2,}(\d)": "p$1"}
#: Words after an author's name in file names.
AUTHOR_WORDS = "著 编 主编 译 译注 译著 编著 校理 撰"


def _mended(c: Column, slips: dict[str, str]) -> Column:
    for pattern, meant in slips.items():
        c = F.regexp_replace(c, pattern, meant)
    return c


def fix_anchor(c: Column) -> Column:
    """``#p108,115]`` to ``#p108-115]`` and ``#p1-#p2]`` to ``#p1-p2]``."""
    return _mended(c, RANGE_SLIPS)


def normal_provenance(anchor: Column, source_path: Column) -> Column:
    """An anchor with its slips undone: a lost bracket, doubled extensions and page signs, and a path near the source's.

    A path is taken for the source's if their base names are equal, or if both are longer than 30 characters and end
    in the same 30. What is no anchor comes back trimmed.
    """
    a = strip(anchor)
    a = F.when(~a.startswith("[") & a.endswith("]") & a.startswith("raw/"), F.concat(F.lit("["), a)).otherwise(a)
    inner = F.regexp_replace(a, r"^[\[\]]+|[\[\]]+$", "")
    path = _mended(F.regexp_extract(inner, "^([^#]*)", 1), PATH_SLIPS)
    place = _mended(F.regexp_extract(inner, "^[^#]*#(.*)$", 1), PLACE_SLIPS)
    base = lambda c: F.regexp_replace(c, "^.*/", "")
    b, s = base(path), base(source_path)
    same = (b == s) | ((F.length(b) > 30) & (F.length(s) > 30) & (F.right(b, F.lit(30)) == F.right(s, F.lit(30))))
    return F.when(a.startswith("[") & a.contains("#"), F.concat(F.lit("["), F.when(same, source_path).otherwise(path), F.lit("#"), place, F.lit("]"))).otherwise(a)


def loose_json(c: Column) -> Column:
    """From the first opening to the last closing brace, or null."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def repair_tags(c: Column) -> Column:
    """``"tags": "#a #b"`` to ``"tags": ["a", "b"]``."""
    found = F.regexp_extract(c, r'"tags":\s*"(#[^"]*)"', 1)
    words = F.filter(F.split(F.regexp_replace(found, "#", " "), r"[\s,]+"), lambda w: w != "")
    items = F.concat(F.lit('"tags": ['), F.array_join(F.transform(words, lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", "), F.lit("]"))
    return F.when(found != "", F.replace(c, F.regexp_extract(c, r'("tags":\s*"#[^"]*")', 1), items)).otherwise(c)


def clean_file_name(c: Column) -> Column:
    """A readable file name: without series labels, numbers in front, Chinese author suffixes and hostile characters.

    At most 100 characters before the extension, which becomes lower case; applying it again changes nothing.
    """
    ext = F.lower(F.regexp_extract(c, r"(?s)^.+(\.[^./]+)$", 1))
    s = F.regexp_replace(c, r"(?s)(?<=.)\.[^./]+$", "")
    s = F.regexp_replace(s, r"(?U)^(?:\s*\[[^\]]*\]\s*|\s*【[^】]*】\s*)+", "")
    s = F.regexp_replace(s, r"(?U)^\d+[._-]\s*", "")
    author = rf"(?U)\s*·?\[[^\]]+\][^.]*?\s+(?:{'|'.join(AUTHOR_WORDS.split())})\s*$"
    s = F.regexp_replace(s, author, "")
    s = strip(F.regexp_replace(s, r"(?U)\s+", " "))
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_+|_+$", "")
    s = F.regexp_replace(s, "[<>:\"|?*\u0000-\u001f]", "")
    s = F.regexp_replace(F.substring(s, 1, 100), r"(?U)\s+$", "")
    return F.when(c == "", c).otherwise(F.concat(F.when(s == "", "untitled").otherwise(s), ext))
