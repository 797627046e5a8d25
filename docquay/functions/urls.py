"""Search URLs and link resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquay.functions.binding import let, let_sql, pattern


def form_encode(text: Column) -> Column:
    """Form encoding of one value: blank as ``+``, ``~`` kept, ``*`` encoded."""
    encoded = F.url_encode(text)
    return F.replace(
        F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def search_url(
    base: str, from_date: Column, to_date: Column, source_id: Column, page: Column
) -> Column:
    """Search request for one window and source; the page only from 2 on."""

    def parameter(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}="), form_encode(value))

    return F.concat(
        F.lit(f"{base}?"),
        F.concat_ws(
            "&",
            F.lit("decisions=1"),
            parameter("from", from_date),
            parameter("to", to_date),
            parameter("body", source_id),
            F.when(page > 1, parameter("pageNumber", page.cast("string"))),
        ),
    )


# RFC 3986, appendix B: scheme, authority, path, query, fragment.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*+):)?+(//[^/?#]*+)?+([^?#]*+)(\?[^#]*+)?+(#.*+)?+$"
_HIERARCHICAL = ("http", "https", "ftp", "file")


def _split(url: str) -> str:
    names = ("scheme", "authority", "path", "query", "fragment")
    return "struct({})".format(", ".join(
        f"regexp_extract({url}, {pattern(_PARTS)}, {i}) AS {n}"
        for i, n in enumerate(names, 1)
    ))


_NONE = "cast(array() AS array<string>)"
# Base path without its last segment, then the link; no empty segment in between.
_MERGED = "CASE WHEN startswith(u.link.path, '/') THEN split(u.link.path, '/') ELSE {} END".format(
    let_sql(
        "split(concat(regexp_replace(u.base.path, '[^/]*+$', ''), u.link.path), '/')",
        f"""s -> concat(
            slice(s, 1, 1),
            filter(slice(s, 2, greatest(size(s) - 2, 0)), x -> x <> ''),
            CASE WHEN size(s) > 1 THEN slice(s, -1, 1) ELSE {_NONE} END)""",
    )
)

_RESOLVED = f"""segments -> aggregate(
    concat(segments,
           CASE WHEN element_at(segments, -1) IN ('.', '..') THEN array('')
                ELSE {_NONE} END),
    {_NONE},
    (done, x) -> CASE WHEN x = '.' THEN done
        WHEN x = '..' THEN slice(done, 1, greatest(size(done) - 1, 0))
        ELSE concat(done, array(x)) END,
    done -> array_join(done, '/'))"""


def resolve_url(base: Column, link: Column) -> Column:
    """``link`` as found on the page ``base``, made absolute."""
    hierarchical = ", ".join(f"'{s}'" for s in _HIERARCHICAL)
    same_base = """concat(u.base.scheme, ':', u.base.authority, u.base.path,
        CASE WHEN u.link.query = '' THEN u.base.query ELSE u.link.query END, u.link.fragment)"""
    rooted = "p -> CASE WHEN startswith(p, '/') THEN p ELSE concat('/', p) END"
    merged = let_sql(let_sql(_MERGED, _RESOLVED), rooted)
    return let(
        F.struct(base.alias("page"), link.alias("href")),
        f"""v -> CASE WHEN v.href = '' THEN v.page ELSE transform(
        array(struct({_split('v.page')} AS base, {_split('v.href')} AS link)),
        u -> CASE
            WHEN u.link.scheme <> '' AND (lower(u.link.scheme) <> lower(u.base.scheme)
                OR NOT lower(u.link.scheme) IN ({hierarchical})) THEN v.href
            WHEN u.link.authority NOT IN ('', '//') THEN concat(
                u.base.scheme, ':', u.link.authority, u.link.path, u.link.query, u.link.fragment)
            WHEN u.link.path = '' THEN {same_base}
            ELSE concat(u.base.scheme, ':', u.base.authority, {merged},
                        u.link.query, u.link.fragment)
        END)[0] END""",
    )
