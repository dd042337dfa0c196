"""Text expressions, Column to Column. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# All characters with the Unicode property White_Space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Regex classes spelled out so that they mean the same as the Unicode-aware
# \d, \w and \s of the text being matched (Java's short forms are ASCII only).
DIGITS = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"
SPACE_AND_SEPARATORS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_match(value: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where nothing matches."""
    return F.nullif(F.regexp_extract(_col(value), pattern, group), F.lit(""))


def to_number(value: Column, type_name: str, strict: bool = True) -> Column:
    """Cast text to a number. Bad text fails the job, or gives null when not strict."""
    return value.cast(type_name) if strict else value.try_cast(type_name)


def first_int(value: Column | str, strict: bool = True) -> Column:
    """First run of digits as int."""
    return to_number(first_match(value, f"({DIGITS}+)"), "int", strict)


def leading_int(value: Column | str, strict: bool = True) -> Column:
    """Digits at the very start as int."""
    return to_number(first_match(value, f"^({DIGITS}+)"), "int", strict)


def signed_in_parens(value: Column | str) -> Column:
    """The signed number in parentheses, as text: "480(+4)" gives "+4"."""
    return first_match(value, rf"\(([-+{DIGITS}]+)\)")


def signed_int_in_parens(value: Column | str, strict: bool = True) -> Column:
    return to_number(signed_in_parens(value), "int", strict)


def trim_space(value: Column | str) -> Column:
    """Strip white space on both ends, the ideographic space included."""
    return F.btrim(_col(value), F.lit(SPACES))


def split_fields(value: Column | str, count: int, separator: str = "/") -> list[Column]:
    """Delete all white space, split, and return ``count`` fields, null where missing."""
    bare = F.regexp_replace(_col(value), f"{SPACE_AND_SEPARATORS}+", "")
    parts = F.split(bare, f"\\Q{separator}\\E")
    return [F.get(parts, F.lit(i)) for i in range(count)]


def split_blank(value: Column | str) -> Column:
    """Split on single blanks."""
    return F.split(_col(value), " ")


def digit_runs(value: Column | str, delete: tuple[str, ...] = (",", "円")) -> Column:
    """Delete the given literals, then list all runs of ASCII digits."""
    text = _col(value)
    for literal in delete:
        text = F.replace(text, F.lit(literal), F.lit(""))
    return F.regexp_extract_all(text, F.lit("[0-9]+"), 0)


def id_after(value: Column | str, key: str) -> Column:
    """The id in ``<key>/<id>`` of a link."""
    return first_match(value, f"{key}/({WORD}+)")


def query_value(value: Column | str, key: str, value_pattern: str | None = None) -> Column:
    """The value of a query parameter of a link, absolute or not."""
    return first_match(value, f"{key}=({value_pattern or WORD + '+'})")


def stem_of_path(value: Column | str, extension: str = "html") -> Column:
    """File name without folder and extension."""
    return first_match(value, rf"([^/]+)\.{extension}$")


def path_value(value: Column | str, key: str) -> Column:
    """The digits in ``<key>=<digits>`` of a path."""
    return first_match(value, f"{key}=({DIGITS}+)")


def year_month(year: Column, month: Column) -> Column:
    """Zero-padded year and month, "202401"."""
    return F.format_string("%04d%02d", year, month)


# Named entities that pages use.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "middot": "·", "copy": "©", "nbsp": "\xa0"}
_CHARACTER = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(ENTITIES) + ");"


def _character(entity: Column) -> Column:
    """The character of one entity; numbers that stand for none give the replacement character."""
    digits = F.regexp_extract(entity, "^&#([0-9]+);", 1)
    hexadecimal = F.regexp_extract(entity, "^&#[xX]([0-9a-fA-F]+);", 1)
    code = F.when(digits != "", digits.try_cast("int")).otherwise(F.conv(hexadecimal, 16, 10).try_cast("int"))
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    number = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    names = F.create_map(*[F.lit(x) for name, plain in ENTITIES.items() for x in (f"&{name};", plain)])
    return F.coalesce(F.try_element_at(names, entity), number)


def unescape_basic(value: Column | str) -> Column:
    """Decode named and numeric entities, each once: what an ampersand is decoded to starts no new one."""
    text = _col(value)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){_CHARACTER}|[^&]+|&"), 0)
    decoded = F.transform(pieces, lambda piece: F.when(F.regexp_like(piece, F.lit(f"^{_CHARACTER}$")), _character(piece)).otherwise(piece))
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def element_text(html: Column | str, tag: str) -> Column:
    """Text of the first element of a kind that holds no further tags."""
    raw = first_match(html, rf"(?is)<{tag}\b[^>]*>([^<]*)</{tag}\s*>")
    return trim_space(unescape_basic(raw))


def attribute(html: Column | str, tag: str, name: str) -> Column:
    """A quoted attribute of the first element of a kind."""
    return first_match(html, rf'(?is)<{tag}\b[^>]*?\b{name}="([^"]*)"')


def flat_links(html: Column | str) -> Column:
    """href and text of links that hold no further tags, in page order.

    The page is searched once; the parts of a link come from the link alone.
    """
    pattern = r'(?is)<a\s[^>]*?\bhref="([^"]*)"[^>]*>([^<]*)</a\s*>'

    def parts(link: Column) -> Column:
        href, name = (F.regexp_extract(link, pattern, group) for group in (1, 2))
        return F.struct(href.alias("href"), unescape_basic(name).alias("text"))

    return F.transform(F.regexp_extract_all(_col(html), F.lit(pattern), 0), parts)


# -- flat pages: links and list items by patterns, for pages whose wanted elements don't nest --

_COMMENTS = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def without_comments(html: Column | str) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(_col(html), _COMMENTS, "")


def tag_attribute(tag: Column, name: str) -> Column:
    """An attribute of an opening tag, however quoted, entities decoded; null where the tag has none."""
    pattern = rf"""(?is)^<[^>]*?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    groups = [F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)]
    return F.when(F.regexp_like(tag, F.lit(pattern)), unescape_basic(F.concat(*groups)))


def has_class(tag: Column, css_class: str) -> Column:
    """Whether an opening tag is of a class."""
    names = F.regexp_replace(F.coalesce(tag_attribute(tag, "class"), F.lit("")), r"\s+", " ")
    return F.contains(F.concat(F.lit(" "), names, F.lit(" ")), F.lit(f" {css_class} "))


def elements(html: Column | str, tag: str, ends: str) -> Column:
    """Elements of a kind from the opening tag up to the first of ``ends`` behind it, in page order."""
    return F.regexp_extract_all(_col(html), F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>.*?(?={ends}|\z)"), 0)


def link_elements(html: Column | str) -> Column:
    """All links, each up to its end or the next one."""
    return elements(html, "a", r"</a\s*>|<a[\s>]")


def inner_text(element: Column) -> Column:
    """Text of an element with the tags in it left out, entities decoded."""
    return unescape_basic(F.regexp_replace(element, r"(?s)<[^>]*>", ""))
