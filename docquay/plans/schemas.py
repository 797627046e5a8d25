"""Schemas of the tables that jobs hand to each other."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

# --- fixed values: field names of the tables and of the event log -------------
ITEM_FIELDS = (
    "identifier", "title", "description", "published_date", "ref_no", "doc_url",
    "body", "partition_date",
)
FILE_FIELDS = ("file_path", "file_hash", "file_type")
LANDING_FIELDS = ITEM_FIELDS + FILE_FIELDS
TRANSFORMED_FIELDS = LANDING_FIELDS + ("source_hash",)
# A landed record must have these to be stored in the transformed zone.
REQUIRED_FIELDS = (
    "identifier", "description", "published_date", "ref_no", "doc_url", "body",
    "partition_date", "file_type", "file_path",
)
# -----------------------------------------------------------------------------


def table(*names: str, **typed: DataType) -> StructType:
    """Text columns, then typed ones."""
    schema = StructType()
    for name in names:
        schema.add(name, StringType())
    for name, kind in typed.items():
        schema.add(name, kind)
    return schema


# When and where a fetch arrived; of several fetches the last one by these counts.
ARRIVAL_TYPES = {
    "fetched_at": TimestampNTZType(), "page": LongType(), "position": IntegerType(),
    "fetch_id": StringType(),
}
ARRIVAL = tuple(ARRIVAL_TYPES)
LANDING = table(*LANDING_FIELDS, **ARRIVAL_TYPES)
TRANSFORMED = table(*TRANSFORMED_FIELDS, **ARRIVAL_TYPES)
# ``content_batch`` is the batch that holds the bytes.
OBJECT_INDEX = table(
    "file_name", "content_type", "file_hash", content_batch=IntegerType(), **ARRIVAL_TYPES
)
TRANSFORMED_INDEX = table("file_name", "content_type", "file_hash")
QUARANTINE = table(
    "identifier", "doc_url", "partition", "body", "error", error_code=IntegerType()
)
OBJECT_CONTENT = table("file_name", content=BinaryType())
# One row per answered or failed document request, with the request's context.
FETCHES = table(
    *ITEM_FIELDS, "reason", "content_type", "fetch_id",
    page=LongType(), position=IntegerType(), status=IntegerType(),
    content=BinaryType(), fetched_at=TimestampNTZType(),
)
FAILURE = table("url", error_code=IntegerType(), reason=StringType(), times=LongType())
EVENTS = table(
    "timestamp", "level", "logger", "message", "event", "partition", "body", "url",
    "reason", "identifier", "file_type", "file_name", "object_name", "error",
    "start_partition", "end_partition", "outcome",
    error_code=IntegerType(),
    failures=ArrayType(FAILURE),
    **{name: LongType() for name in (
        "records_found", "records_scraped", "records_failed", "partitions_processed",
        "total_records_found", "total_records_scraped", "total_records_failed", "chunk",
        "total_records", "transformed", "skipped", "errors", "retries", "n_records",
    )},
)
