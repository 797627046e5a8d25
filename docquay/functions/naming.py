"""File types, MIME types, object names and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquay.functions.markup import html_from_bytes, stable_text

# --- fixed values -----------------------------------------------------------
LANDING_ZONE = "landing-zone"
TRANSFORMED_ZONE = "transformed-zone"
MIME_TYPES = {"html": "text/html", "pdf": "application/pdf", "doc": "application/msword"}
OTHER_MIME_TYPE = "application/octet-stream"
UNCLEANED_TYPES = ("pdf", "doc")
# -----------------------------------------------------------------------------


def file_type(content_type: Column) -> Column:
    """``pdf``, ``doc`` or ``html`` from a Content-Type header, which may be missing."""
    header = F.lower(content_type)
    return (
        F.when(F.contains(header, F.lit("pdf")), "pdf")
        .when(
            F.contains(header, F.lit("msword"))
            | F.contains(header, F.lit("officedocument")),
            "doc",
        )
        .otherwise("html")
    )


def mime_type(extension: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension), F.lit(OTHER_MIME_TYPE))


def object_name(identifier: Column, extension: Column) -> Column:
    return F.concat(identifier, F.lit("."), extension)


def object_path(zone: str, name: Column) -> Column:
    return F.concat(F.lit(f"{zone}/"), name)


def object_key(path: Column) -> Column:
    """Text after the first ``/``; the whole path if there is none."""
    return F.regexp_replace(path, r"(?s)^[^/]*+/", "")


def content_hash(content: Column) -> Column:
    """SHA-256 of the bytes, as hex."""
    return F.sha2(content, 256)


def stable_html_hash(html: Column, content: Column | None = None) -> Column:
    """Hash of the visible text, so that markup, scripts and comments do not count."""
    raw = html.cast("binary") if content is None else content
    return F.coalesce(F.sha2(stable_text(html).cast("binary"), 256), content_hash(raw))


def landing_hash(content: Column, kind: Column) -> Column:
    """Hash by which landing decides whether a document has changed."""
    return F.when(
        kind == "html", stable_html_hash(html_from_bytes(content), content)
    ).otherwise(content_hash(content))


def hash_prefix(file_hash: Column) -> Column:
    """First 12 characters, for display."""
    return F.substring(file_hash, 1, 12)
