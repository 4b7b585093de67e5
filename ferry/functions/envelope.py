"""Envelope columns: build, serialise, parse, stringify.

All of these are plain Column expressions, so they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the message contract: JSON key names and their order, as
# the queue producer writes them. ``IsEnd`` carries no JSON tag, so its key
# is the field name itself.
ENVELOPE_KEYS = ["data", "metadata", "created_at", "updated_at", "stringified_data", "IsEnd"]
METADATA_KEYS = ["source", "destination"]

# Leading columns we add: the run identity and order the message lacks.
ROUTING_KEYS = ["connection_id", "queue", "seq"]

# Microsecond text form for both timestamp flavours (to_json cuts to
# milliseconds unless both formats are given).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
JSON_WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": TS_FORMAT,
    "timestampNTZFormat": TS_FORMAT,
    "timeZone": "UTC",  # the literal Z is true in any session
}
CORRUPT_COL = "_corrupt"

METADATA_TYPE = T.StructType([T.StructField(k, T.StringType()) for k in METADATA_KEYS])

ENVELOPE_FIELDS = [
    T.StructField("data", T.BinaryType()),
    T.StructField("metadata", METADATA_TYPE),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("stringified_data", T.StringType()),
    T.StructField("IsEnd", T.BooleanType()),
]
ROUTING_FIELDS = [
    T.StructField("connection_id", T.StringType()),
    T.StructField("queue", T.StringType()),
    T.StructField("seq", T.LongType()),
]
MESSAGE_SCHEMA = T.StructType(ROUTING_FIELDS + ENVELOPE_FIELDS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_payload(c) -> Column:
    """Text or binary column -> UTF-8 bytes (binary passes through)."""
    return F.encode(_col(c), "UTF-8")


def envelope_columns(data, source, destination, created_at=None, updated_at=None) -> list[Column]:
    """The six envelope fields as named columns.

    ``created_at`` / ``updated_at`` are injected so a run is reproducible;
    they default to the query start time. ``stringified_data`` and ``IsEnd``
    start at their zero values ('' and false), as the producer leaves them.
    """
    created = _col(created_at) if created_at is not None else F.current_timestamp()
    updated = _col(updated_at) if updated_at is not None else created
    return [
        _col(data).cast("binary").alias("data"),
        F.struct(_lit_or_col(source).cast("string").alias("source"),
                 _lit_or_col(destination).cast("string").alias("destination")).alias("metadata"),
        created.cast("timestamp").alias("created_at"),
        updated.cast("timestamp").alias("updated_at"),
        F.lit("").alias("stringified_data"),
        F.lit(False).alias("IsEnd"),
    ]


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def build_messages(df, data, source, destination, connection_id, queue, seq,
                   created_at=None, updated_at=None, keep=()):
    """Rows of ``df`` -> message rows (routing columns + envelope).

    ``keep`` names extra columns of ``df`` carried through (e.g. a key).
    """
    return df.select(
        *[F.col(k) for k in keep],
        _lit_or_col(connection_id).cast("string").alias("connection_id"),
        _lit_or_col(queue).cast("string").alias("queue"),
        _lit_or_col(seq).cast("long").alias("seq"),
        *envelope_columns(data, source, destination, created_at, updated_at),
    )


def end_marker(connection_id, queue, seq) -> list[Column]:
    """An end-of-queue message: only ``IsEnd`` set, everything else zero."""
    return [
        _lit_or_col(connection_id).cast("string").alias("connection_id"),
        _lit_or_col(queue).cast("string").alias("queue"),
        _lit_or_col(seq).cast("long").alias("seq"),
        F.lit(None).cast("binary").alias("data"),
        F.struct(F.lit("").alias("source"), F.lit("").alias("destination")).alias("metadata"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.lit("").alias("stringified_data"),
        F.lit(True).alias("IsEnd"),
    ]


def serialize(cols: list[str] | None = None) -> Column:
    """Message row -> one JSON line; binary goes out as base64."""
    names = cols or [f.name for f in MESSAGE_SCHEMA.fields]
    return F.to_json(F.struct(*[F.col(n) for n in names]), JSON_WRITE_OPTIONS)


def base64_payload(c) -> Column:
    """C4 stand-alone: base64 without the 76-column line breaks."""
    return F.regexp_replace(F.base64(_col(c)), r"[\r\n]", "")


def parse(value) -> Column:
    """JSON line -> message struct with a corrupt-record field.

    Malformed text, JSON ``null``, arrays and scalars all set ``_corrupt``;
    an empty line yields a null struct. Use ``is_malformed`` to test.
    """
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
    # no time pattern: RFC 3339 times of any precision and offset are read
    return F.from_json(_col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL,
                                             "timeZone": "UTC"})


def is_malformed(parsed) -> Column:
    p = _col(parsed)
    return p.isNull() | p.getField(CORRUPT_COL).isNotNull()


def stringify(data) -> Column:
    """Bytes -> text; invalid UTF-8 becomes U+FFFD instead of failing."""
    return F.make_valid_utf8(_col(data).cast("string"))


# Hex of a text's last bytes when they begin a UTF-8 character
# of two to four bytes that isn't whole yet, by how many of its bytes are there.
OPEN_ENDS = {1: "(C[2-9A-F]|D[0-9A-F]|E[0-9A-F]|F[0-4])$",
             2: "(E[0-9A-F]|F[0-4])[89AB][0-9A-F]$",
             3: "F[0-4]([89AB][0-9A-F]){2}$"}
#: Bytes before a chunk that can belong to its first character.
EDGE_BYTES = 3


def last_bytes(data, n=EDGE_BYTES) -> Column:
    """The last ``n`` bytes (a number or column), or all of a shorter value."""
    d = _col(data)
    n = F.least(n if isinstance(n, Column) else F.lit(n), F.octet_length(d))
    return F.substring(d, F.octet_length(d) - n + 1, n)


def open_bytes(data) -> Column:
    """How many bytes at the end (0 to 3) begin a character that is not whole."""
    h = F.hex(last_bytes(data))
    out = F.lit(0)
    for n, pattern in OPEN_ENDS.items():
        out = F.when(h.rlike(pattern), F.lit(n)).otherwise(out)
    return F.coalesce(out, F.lit(0))


def stringify_between(data, before, last) -> Column:
    """C5 for a chunk of a longer payload: the text of the characters that end
    in this chunk. ``before``: up to EDGE_BYTES bytes of the payload in front
    of it (null: none), ``last``: nothing follows it. The texts of all chunks
    one after the other are the text of the payload, wherever it was cut."""
    front = F.coalesce(_col(before), F.lit(b""))
    whole = F.concat(last_bytes(front, open_bytes(front)), _col(data))
    ends = F.when(_col(last), F.lit(0)).otherwise(open_bytes(whole))
    return stringify(F.substring(whole, F.lit(1), F.octet_length(whole) - ends))


def drop_payload() -> Column:
    """The payload column after stringifying (null bytes)."""
    return F.lit(None).cast("binary").alias("data")
