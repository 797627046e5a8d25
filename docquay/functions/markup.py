"""HTML cleaning and element selection as native column expressions.

Patterns are Java regular expressions. Every loop over characters, attributes
or tags is possessive, so matching needs neither backtracking nor a stack that
grows with the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquay.functions.binding import let, let_sql, pattern

# --- fixed values -----------------------------------------------------------
CONTENT_TAG = "div"
CONTENT_CLASS = "content"
RAW_TAGS = ("script", "style", "noscript")
CHROME_TAGS = ("nav", "header", "footer")
CHROME_IDS = ("globalCookieBar", "asideNav", "google_translate_element")
CHROME_CLASS_PART = "navbar"
CHROME_CLASSES = ("firstLetter", "secondLetter", "lastLetter")
RETURN_LINK_TEXT = "Return to Search"
# Elements without content in HTML.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
)
# What str.strip() takes off in Python.
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# -----------------------------------------------------------------------------

# Rest of a tag after its name: quotes count only behind "=", as in HTML.
_TAIL = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+(?:>|\z)"""
_NAME = r"[a-z][^\s/>]*+"
_NAME_END = r"(?=[\s/>]|\z)"
_MARK = "\u0001"
_ATTRIBUTE_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+"""


def _block(tag: str) -> str:
    """A raw block; to the end of the page when it is never closed."""
    return rf"{tag}{_NAME_END}{_TAIL}(?:(?<=/>)|.*?(?:</{tag}{_NAME_END}[^>]*+(?:>|\z)|\z))"


# Everything here stands behind a "<", which is matched once, before the choice.
_TAG_REST = rf"/?[a-z]{_TAIL}"
_DECLARATION = r"(?:[!?]|/(?![a-z]))[^>]*+(?:>|\z)"
_COMMENT = r"!--.*?(?:-->|\z)"
_NOISE_REST = "|".join([_COMMENT] + [_block(t) for t in RAW_TAGS])
# Text in these elements is no part of the visible text.
_HIDDEN_REST = rf"{_block('template')}|r[tp]{_NAME_END}{_TAIL}[^<]*+"
_TAG = f"<{_TAG_REST}"
_NOISE = f"<(?:{_NOISE_REST})"
_NODE_BOUNDARY = (
    rf"(?is)(?=<)(?:<(?:{_NOISE_REST}|{_HIDDEN_REST}|{_TAG_REST}|{_DECLARATION}))++"
)


def open_tag(tag: str, attribute: str, value: str, part: bool = False) -> str:
    """Pattern of an opening ``tag`` whose ``attribute`` holds ``value``.

    ``class`` is matched by whole token, other attributes by their whole value;
    with ``part`` the value may sit anywhere inside. The first attribute of that
    name decides, wherever it stands in the tag.
    """
    word = f"(?-i:{re.escape(value)})"
    if part:
        quoted, bare = r"[^{q}]*?" + word + r"[^{q}]*+", r"[^\s>\"']*?" + word
    elif attribute == "class":
        quoted = r"(?:[^{q}]*\s)?" + word + r"(?:\s[^{q}]*+)?"
        bare = word + r"(?=[\s>])"
    else:
        quoted, bare = word, word + r"(?=[\s>])"
    values = "|".join(
        [q + quoted.replace("{q}", q) + q for q in ('"', "'")] + [bare]
    )
    others = rf"(?:[\s/]*+(?!{attribute}\s*+=)[^\s=></]++(?:{_ATTRIBUTE_VALUE})?+)*+"
    return rf"<{tag}{_NAME_END}{others}[\s/]*+{attribute}\s*+=\s*+(?:{values})"


def _whole_open_tag(tag: str, attribute: str | None, value: str | None) -> str:
    if attribute is None:
        return rf"<{tag}{_NAME_END}{_TAIL}"
    return rf"(?={open_tag(tag, attribute, value)})<{tag}{_NAME_END}{_TAIL}"


# --- text ---------------------------------------------------------------------


def strip_space(text: Column) -> Column:
    """Trim every kind of white space, the no-break space included."""
    return F.btrim(text, F.lit(SPACE_CHARS))


_NAMED_ENTITIES = "str_to_map('{}', ' ', '=')".format(
    " ".join(f"{name}={chr(code)}" for name, code in name2codepoint.items())
)


def _code_point(number: str) -> str:
    """SQL text: the character of that number; none has a number out of range or null."""
    return f"""CASE
        WHEN {number} BETWEEN 1 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343
        THEN decode(unhex(lpad(hex({number}), 8, '0')), 'UTF-32') ELSE '\ufffd' END"""


def _decoded(text: str) -> str:
    """SQL text of ``text`` with its character references decoded."""
    reference = pattern(r"^(#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);")
    value = f"""CASE
        WHEN ref = 'amp' THEN '&' WHEN ref = '' THEN NULL WHEN ref = 'apos' THEN "'"
        WHEN lower(left(ref, 2)) = '#x' THEN {let_sql(
            "CASE WHEN length(ltrim('0', substring(ref, 3))) <= 7 THEN"
            " cast(conv(concat('0', ltrim('0', substring(ref, 3))), 16, 10) AS BIGINT) END", "n -> " + _code_point("n"))}
        WHEN left(ref, 1) = '#' THEN {let_sql(
            "try_cast(substring(ref, 2) AS BIGINT)", "n -> " + _code_point("n"))}
        ELSE try_element_at({_NAMED_ENTITIES}, ref) END"""
    piece = let_sql(
        f"regexp_extract(piece, {reference}, 1)",
        f"ref -> coalesce(concat({value}, substring(piece, length(ref) + 2)), concat('&', piece))",
    )
    return f"""CASE WHEN contains({text}, '&') THEN array_join(transform(
        split({text}, '&'), (piece, at) -> CASE WHEN at = 0 THEN piece ELSE {piece} END), '')
        ELSE {text} END"""


def decode_entities(text: Column) -> Column:
    """Character references to characters; one without ``;`` stays as written."""
    return let(text, f"t -> {_decoded('t')}")


def visible_text(html: Column) -> Column:
    """Text nodes trimmed and joined without separator; no script, no comment."""
    nodes = F.split(_without_mark(html), _NODE_BOUNDARY)
    trimmed = F.expr(f"node -> btrim({_decoded('node')}, '{SPACE_CHARS}')")
    return F.array_join(F.call_function("transform", nodes, trimmed), "")


# Well-formed UTF-16 behind its byte-order mark, as hex: decoding anything else fails.
_HEX = "[0-9A-F]{2}"
_UTF16 = (
    rf"^(?:FEFF(?:(?:[0-9A-CEF][0-9A-F]|D[0-7]){_HEX}|D[89AB]{_HEX}D[C-F]{_HEX})*+"
    rf"|FFFE(?:{_HEX}(?:[0-9A-CEF][0-9A-F]|D[0-7])|{_HEX}D[89AB]{_HEX}D[C-F])*+)$"
)
_C1 = "".join(chr(c) for c in range(0x80, 0xA0))
_C1_AS_CP1252 = "".join(bytes([ord(c)]).decode("cp1252", "ignore") or c for c in _C1)


# One-byte character sets that a page may declare, other than Windows-1252.
_CHARSETS = (
    "iso-8859-2", "iso-8859-5", "iso-8859-7", "iso-8859-9", "iso-8859-15", "koi8-r",
    "windows-1250", "windows-1251", "windows-1253", "windows-1254", "windows-1257",
)
_HIGH = "".join(chr(c) for c in range(0x80, 0x100))
_DECLARED = r"""(?i)<meta\s[^>]*?charset\s*+=\s*+["']?\s*+([a-z0-9_-]+)"""


def _declared(content: Column) -> Column:
    """Character set named by the first ``meta`` tag outside comments that names one, in lower case."""
    page = F.regexp_replace(F.decode(content, "ISO-8859-1"), rf"(?s)<{_COMMENT}", "")
    return F.lower(F.regexp_extract(page, _DECLARED, 1))


def html_from_bytes(content: Column) -> Column:
    """Page text: by byte-order mark, else UTF-8, else as declared, else Windows-1252. Never fails."""
    mark = F.hex(F.substring(content, 1, 3))
    wide = F.substring(mark, 1, 4).isin("FEFF", "FFFE")
    behind_mark = F.substring(content, 4, 2**31 - 1).cast("string")
    as_utf8 = content.cast("string")
    latin = F.decode(content, "ISO-8859-1")
    declared = _declared(content)
    one_byte = F.translate(latin, _C1, _C1_AS_CP1252)
    for name in _CHARSETS:
        high = bytes(range(0x80, 0x100)).decode(name, "replace")
        one_byte = F.when(declared == name, F.translate(latin, _HIGH, high)).otherwise(one_byte)
    return (
        F.when(mark == "EFBBBF", F.make_valid_utf8(behind_mark))
        .when(wide & F.hex(content).rlike(_UTF16), F.decode(content, "UTF-16"))
        .when(F.is_valid_utf8(as_utf8), as_utf8)
        .otherwise(one_byte)
    )


# --- elements -------------------------------------------------------------------


def _without_mark(html: Column) -> Column:
    """Without the control character that the scans use; HTML does not allow it."""
    return F.replace(html, F.lit(_MARK), F.lit(""))


def strip_raw_blocks(html: Column, replacement: str = "") -> Column:
    """Without comments, script, style and noscript, in one leftmost pass.

    With ``<x>`` as replacement the text before and behind a block stay two
    text nodes.
    """
    return F.regexp_replace(_without_mark(html), f"(?is){_NOISE}", replacement)


def _tokens(html: str, tags: Sequence[str] | None) -> str:
    """SQL text: array of text, tag, text, tag, ..., text; only the named tags count."""
    if tags is None:
        found, marked = _TAG, f"{_MARK}$0{_MARK}"
    else:
        named = rf"</?(?:{'|'.join(tags)}){_NAME_END}"
        skipped = rf"(?:[^<]++|(?!{named})<(?:/?[a-z]{_TAIL})?+)*+"
        # The end counts as a last, empty tag: a match that fails there would be
        # tried again from every position.
        found, marked = rf"({skipped})({named}{_TAIL}|\z)", f"$1{_MARK}$2{_MARK}"
    return (
        f"split(regexp_replace({html}, {pattern('(?is)' + found)}, '{marked}'), '{_MARK}')"
    )


# What a tag does to the element being followed.
_PASS, _OPEN, _ALONE, _DEEPER, _SHALLOWER, _CLOSE, _CLOSE_BEFORE, _NEXT_ITEM, _INNER = range(9)
_SLICE = 512
_VOID = ", ".join(f"'{t}'" for t in VOID_TAGS)

_EFFECT_INSIDE = f"""CASE
    WHEN name <> s.name OR endswith(tag, '/>') THEN {_PASS}
    WHEN NOT startswith(tag, '</') AND %(inner)s THEN {_INNER}
    WHEN NOT startswith(tag, '</') THEN {_DEEPER}
    WHEN s.depth > 1 THEN {_SHALLOWER}
    ELSE {_CLOSE} END"""

_EFFECT_INSIDE_ITEM = f"""CASE
    WHEN name IN ('ul', 'ol') AND NOT startswith(tag, '</') THEN {_DEEPER}
    WHEN name IN ('ul', 'ol') AND s.depth > 1 THEN {_SHALLOWER}
    WHEN name IN ('ul', 'ol') THEN {_CLOSE_BEFORE}
    WHEN name = 'li' AND s.depth > 1 AND NOT startswith(tag, '</') AND %(inner)s THEN {_INNER}
    WHEN name <> 'li' OR s.depth > 1 THEN {_PASS}
    WHEN startswith(tag, '</') THEN {_CLOSE}
    WHEN %(hit)s THEN {_NEXT_ITEM}
    ELSE {_CLOSE_BEFORE} END"""


def _ranges(opening: str, first_only: bool, list_item: bool, nested: bool = False) -> str:
    """SQL text: token ranges of the outermost elements that ``opening`` matches.

    One pass over ``tokens`` with a depth counter over tags of the same name. List
    items follow the list rule instead: they end at ``</li>``, at the next ``<li>``
    or at the end of their list, whichever comes first. Ranges are collected as text for
    a slice of ``_SLICE`` tokens at a time and the texts of the slices in an array, so what
    a hit copies does not grow with the hits before it. With ``nested`` elements inside those
    found are found too: the outer ones wait on a stack, ``below``, with their beginning and depth, and
    all ranges come in the order of their beginnings.
    """
    hit = f"tag RLIKE {pattern('(?is)^' + opening)}"
    room = "NOT s.any" if first_only else "true"
    inside = _EFFECT_INSIDE_ITEM if list_item else _EFFECT_INSIDE
    inside = inside % {"hit": hit, "inner": hit if nested else "false"}
    outside = f"""CASE
        WHEN startswith(tag, '</') OR NOT ({room} AND {hit}) THEN {_PASS}
        WHEN endswith(tag, '/>') OR name IN ({_VOID}) THEN {_ALONE}
        ELSE {_OPEN} END"""
    effect = let_sql(
        f"lower(regexp_extract(tag, {pattern('^</?([a-zA-Z][^\\s/>]*+)')}, 1))",
        f"name -> struct(name, CASE WHEN s.name = '' THEN {outside} ELSE {inside} END AS e)",
    )
    begun = f"t.e IN ({_OPEN}, {_NEXT_ITEM}, {_INNER})"
    ended = f"t.e IN ({_CLOSE}, {_CLOSE_BEFORE})"
    back = f"{ended} AND s.below <> ''"
    top = pattern("([0-9]+) ([0-9]+);$")
    # The end of a list also ends the item in it, and is one of the lists of the item around.
    outer_depth = f"cast(regexp_extract(s.below, {top}, 2) AS INT) - int(t.name IN ('ul', 'ol'))"
    moved = f"""t -> struct(
        s.k + 1 AS k,
        CASE WHEN {begun} THEN t.name WHEN {back} THEN s.name
             WHEN {ended} THEN '' ELSE s.name END AS name,
        CASE WHEN {begun} THEN 1 WHEN {back} THEN {outer_depth} WHEN t.e = {_DEEPER} THEN s.depth + 1
             WHEN t.e = {_SHALLOWER} THEN s.depth - 1 ELSE s.depth END AS depth,
        CASE WHEN {begun} THEN s.k WHEN {back} THEN cast(regexp_extract(s.below, {top}, 1) AS INT)
             ELSE s.a END AS a,
        CASE WHEN t.e = {_INNER} THEN concat(s.below, s.a, ' ', s.depth, ';')
             WHEN {back} THEN regexp_replace(s.below, {top}, '') ELSE s.below END AS below,
        CASE WHEN t.e = {_ALONE} THEN concat(s.cuts, s.k, ' ', s.k, ';')
             WHEN t.e = {_CLOSE} THEN concat(s.cuts, s.a, ' ', s.k, ';')
             WHEN t.e IN ({_CLOSE_BEFORE}, {_NEXT_ITEM}) THEN concat(s.cuts, s.a, ' ', s.k - 1, ';')
             ELSE s.cuts END AS cuts,
        s.any OR t.e IN ({_ALONE}, {_CLOSE}, {_CLOSE_BEFORE}, {_NEXT_ITEM}) AS any)"""
    step = let_sql(
        f"CASE WHEN s.k % 2 = 0 THEN struct('' AS name, {_PASS} AS e) ELSE {effect} END",
        moved,
    )
    start = "0 AS k, '' AS name, 0 AS depth, 0 AS a, '' AS below"
    inner = f"""aggregate(
        slice(tokens, at, {_SLICE}),
        struct(s.k AS k, s.name AS name, s.depth AS depth, s.a AS a, s.below AS below, '' AS cuts, s.any AS any),
        (s, tag) -> {step})"""
    grown = """r -> struct(r.k AS k, r.name AS name, r.depth AS depth, r.a AS a, r.below AS below,
        CASE WHEN r.cuts = '' THEN s.parts ELSE array_append(s.parts, r.cuts) END AS parts,
        r.any AS any)"""
    unclosed = """CASE WHEN s.name = '' THEN '' ELSE concat(
        regexp_replace(s.below, ' [0-9]+;', concat(' ', s.k - 1, ';')), s.a, ' ', s.k - 1, ';') END"""
    found = f"""transform(
        filter(split(concat(array_join(s.parts, ''), {unclosed}), ';'), c -> c <> ''),
        c -> struct(cast(substring_index(c, ' ', 1) AS INT) AS a,
                    cast(substring_index(c, ' ', -1) AS INT) AS b))"""
    if nested:
        found = f"array_sort({found})"
    return f"""aggregate(
        sequence(1, size(tokens), {_SLICE}),
        struct({start}, cast(array() AS array<string>) AS parts, false AS any),
        (s, at) -> {let_sql(inner, grown)},
        s -> {found})"""


_PICKED = """t -> transform(
    t.cuts, c -> array_join(slice(t.tokens, c.a + 1, c.b - c.a + 1), ''))"""

_KEPT = "t -> array_join(transform(sequence(0, size(t.cuts)), i -> {}), '%s')".format(
    let_sql(
        """struct(
            CASE WHEN i = 0 THEN 0 ELSE try_element_at(t.cuts, i).b + 1 END AS low,
            coalesce(try_element_at(t.cuts, i + 1).a - 1, size(t.tokens) - 1) AS high)""",
        """r -> array_join(
            slice(t.tokens, r.low + 1, greatest(r.high - r.low + 1, 0)), '')""",
    )
)


def _scan(
    html: str,
    tags: Sequence[str] | None,
    opening: str,
    body: str,
    first_only: bool = False,
    list_item: bool = False,
    nested: bool = False,
) -> str:
    """SQL text: ``body`` over the tokens of ``html`` and the ranges found in them."""
    found = f"struct(tokens, {_ranges(opening, first_only, list_item, nested)} AS cuts)"
    return let_sql(_tokens(html, tags), f"tokens -> {let_sql(found, body)}")


def select_elements(
    html: Column,
    tag: str,
    css_class: str | None = None,
    first_only: bool = False,
    nested: bool = False,
) -> Column:
    """Markup of the outermost ``tag`` elements, with ``css_class`` if given.

    With ``nested`` also of those inside others, each whole, in the order they begin.
    Expects noise-free markup (``strip_raw_blocks``).
    """
    opening = (
        rf"<{tag}{_NAME_END}"
        if css_class is None
        else open_tag(tag, "class", css_class)
    )
    list_item = tag == "li"
    tags = ("li", "ul", "ol") if list_item else (tag,)
    scan = _scan("h", tags, opening, _PICKED, first_only, list_item, nested)
    none = "cast(array() AS array<string>)"
    found = f"h RLIKE {pattern('(?is)' + opening)}"
    return let(html, f"h -> CASE WHEN {found} THEN {scan} WHEN h IS NOT NULL THEN {none} END")


def select_first(html: Column, tag: str, css_class: str) -> Column:
    """First such element with its subtree, or null."""
    return F.try_element_at(select_elements(html, tag, css_class, True), F.lit(1))


def _contains_any(html: str, words: Sequence[str]) -> str:
    return " OR ".join(f"contains({html}, '{_quoted(w)}')" for w in words)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def remove_elements(
    html: Column,
    opening: str,
    tags: Sequence[str] | None = None,
    words: Sequence[str] = (),
    first_only: bool = False,
    joint: str = "",
) -> Column:
    """Without the elements whose opening tag matches the pattern ``opening``, ``joint`` instead.

    Pages in which the pattern does not occur are passed on without a scan. Such a
    tag has one of ``words`` in it, if given: a plain search spares most pages the
    pattern as well.
    """
    scan = _scan("h", tags, opening, _KEPT % joint, first_only)
    found = f"h RLIKE {pattern('(?is)' + opening)}"
    if words:
        found = f"({_contains_any('h', words)}) AND {found}"
    return let(html, f"h -> CASE WHEN {found} THEN {scan} ELSE h END")


def strip_chrome_tags(html: Column, tags: Sequence[str] = CHROME_TAGS) -> Column:
    """Without the given elements, nested ones included, and their stray ends.

    One pattern takes the innermost elements, which are all there are on most
    pages; only what is left after that is scanned.
    """
    names = "|".join(tags)
    inner = rf"(?:[^<]++|<(?!/?(?:{names}){_NAME_END}))*+"
    innermost = rf"(?is)<({names}){_NAME_END}{_TAIL}(?<!/>){inner}</\1\s*+>"
    rest = remove_elements(
        F.regexp_replace(html, innermost, ""), rf"<(?:{names}){_NAME_END}", tags=tags
    )
    return F.regexp_replace(rest, rf"(?is)</(?:{names})\s*+>", "")


def strip_by_id(html: Column, element_id: str) -> Column:
    """Without the first element of that id."""
    opening = open_tag(_NAME, "id", element_id)
    return remove_elements(html, opening, words=[element_id], first_only=True)


def strip_class_like(html: Column, part: str) -> Column:
    """Without elements that have ``part`` anywhere in a class name."""
    return remove_elements(html, open_tag(_NAME, "class", part, part=True), words=[part])


def strip_class_exact(html: Column, *css_classes: str) -> Column:
    """Without elements of exactly one of the classes."""
    opening = "|".join(open_tag(_NAME, "class", c) for c in css_classes)
    return remove_elements(html, f"(?:{opening})", words=css_classes)


def strip_links_by_text(html: Column, text: str = RETURN_LINK_TEXT) -> Column:
    """Without links whose only text, bare or singly wrapped, has ``text`` in it."""
    wrapped = rf"(?:<(?!/|a{_NAME_END}){_NAME}{_TAIL})*+"
    unwrapped = rf"(?:</(?!a{_NAME_END}){_NAME}{_TAIL})*+"
    link = (
        rf"(?is)<a{_NAME_END}{_TAIL}{wrapped}[^<]*?(?-i:{re.escape(text)})"
        rf"[^<]*+{unwrapped}</a\s*+>"
    )
    found = _contains_any("h", [text])
    replaced = f"regexp_replace(h, {pattern(link)}, '')"
    return let(html, f"h -> CASE WHEN {found} THEN {replaced} ELSE h END")


def content_container(html: Column) -> Column:
    """First content container of noise-free markup, or null."""
    return select_first(html, CONTENT_TAG, CONTENT_CLASS)


def clean_html(
    df: DataFrame,
    html: str = "html",
    output: str = "cleaned_html",
    link_text: str = RETURN_LINK_TEXT,
) -> DataFrame:
    """Add the markup of the content container, or of the page without its chrome.

    One narrow step per removal. Each step names its input once, so steps that
    Catalyst merges are still evaluated once.
    """
    page, container = f"__{output}_page", f"__{output}_container"

    def fallback_step(table: DataFrame, step: Callable[[Column], Column]) -> DataFrame:
        return table.withColumn(
            page, F.when(F.col(container).isNull(), step(F.col(page)))
        )

    df = df.withColumn(page, strip_raw_blocks(F.col(html)))
    df = df.withColumn(container, content_container(F.col(page)))
    df = fallback_step(df, strip_chrome_tags)
    for element_id in CHROME_IDS:
        df = fallback_step(df, lambda h, i=element_id: strip_by_id(h, i))
    df = fallback_step(df, lambda h: strip_class_like(h, CHROME_CLASS_PART))
    df = df.withColumn(
        output, strip_links_by_text(F.coalesce(F.col(container), F.col(page)), link_text)
    )
    letters = strip_class_exact(F.col(output), *CHROME_CLASSES)
    df = df.withColumn(
        output, F.when(F.col(container).isNull(), letters).otherwise(F.col(output))
    )
    return df.drop(page, container)


def stable_text(html: Column) -> Column:
    """Visible text of the content container, else of the whole page."""
    has_container = html.rlike("(?is)" + open_tag(CONTENT_TAG, "class", CONTENT_CLASS))
    content = content_container(strip_raw_blocks(html, "<x>"))
    return visible_text(F.coalesce(F.when(has_container, content), html))


# --- fields of one element --------------------------------------------------------


def attribute_of(html: Column, tag: str, css_class: str | None, attribute: str) -> Column:
    """Attribute of the first such element, decoded; empty text when missing."""

    others = rf"(?:[\s/]*+(?!{attribute}\s*+=)[^\s=></]++(?:{_ATTRIBUTE_VALUE})?+)*+"
    before = rf"(?is)^<{_NAME}{others}[\s/]*+{attribute}\s*+=\s*+"
    values = ", ".join(
        f"regexp_extract(opening, {pattern(before + v)}, 1)"
        for v in ('"([^"]*+)"', "'([^']*+)'", r"""([^\s"'>][^\s>]*+)""")
    )
    selector = "class" if css_class else None
    opening = F.regexp_extract(
        html, f"(?is)({_whole_open_tag(tag, selector, css_class)})", 1
    )
    return decode_entities(let(opening, f"opening -> concat({values})"))


def own_text_of(html: Column, tag: str, css_class: str | None) -> Column:
    """First text directly inside the first such element; empty when missing.

    Children may be nested. One pattern does where they hold only text; else the element
    is scanned, its outermost children are cut out and what stands between them is its own.
    """
    selector = "class" if css_class else None
    whole = _whole_open_tag(tag, selector, css_class)
    leading = (
        rf"(?:<(?:x|br|hr|img|input|wbr){_NAME_END}{_TAIL}"
        rf"|<({_NAME}){_TAIL}[^<]*+</\1\s*+>)*+"
    )
    plain = rf"(?is){whole}{leading}([^<]*+)"
    nested = rf"(?is){whole}{leading}<(?!/)"
    element = select_elements(html, tag, css_class, first_only=True)
    inner = F.regexp_replace(
        F.coalesce(F.try_element_at(element, F.lit(1)), F.lit("")), rf"(?is)^<{_NAME}{_TAIL}|</{tag}\s*+>$", ""
    )
    pieces = remove_elements(inner, rf"<{_NAME}", joint="<x>")
    own = F.coalesce(
        F.try_element_at(F.filter(F.split(pieces, "<x>"), lambda t: t != ""), F.lit(1)), F.lit("")
    )
    return decode_entities(
        F.when(html.rlike(nested), F.regexp_extract(own, r"^([^<]*+)", 1))
        .otherwise(F.regexp_extract(html, plain, 2))
    )
