"""Columns that travel with every record. They start with an underscore and are never loaded into a table."""

SOURCE = "_source"  # file path, or the caller's document id
SOURCE_NAME = "_source_name"  # file name that patterns and filename groups are matched against
POSITION = "_position"  # struct<block bigint, index bigint>: order of records within one source
MALFORMED = "_malformed"  # true on the one marker row of a document that could not be read to its end
REASON = "_reject_reason"  # why a record or row is not loaded, NULL when it is

RESERVED = (SOURCE, SOURCE_NAME, POSITION, MALFORMED, REASON)
