"""Nested payloads: base64 decode, JSON parse, flatten, explode, encode.

The transport delivers one transaction per record as base64 text. Decoding
and parsing are column expressions (``unbase64``, ``from_json``); flattening
is a schema-driven projection: struct paths become ``A_B_C`` columns and
array paths are exploded with ``explode_outer`` (an empty or missing array
keeps the row, with NULL leaves). Everything runs per row inside generated
code, no Python per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from kassa.session import CHUNKED_BASE64

CORRUPT = "_corrupt_record"


def base64_text(text) -> "Column":
    """Standard base64 of UTF-8 text on one line. Spark 4 wraps ``base64()``
    output every 76 characters by default; the transport format does not.
    Where the session turns that off, as ``RECOMMENDED_CONF`` does, there are
    no line breaks to look for."""
    encoded, session = F.base64(text.cast("binary")), SparkSession.getActiveSession()
    if session is not None and session.conf.get(CHUNKED_BASE64, "true") == "false":
        return encoded
    return F.replace(encoded, F.lit("\r\n"), F.lit(""))


def decode_payload(df: DataFrame, column: str = "data", alias: str = "payload") -> DataFrame:
    """base64 text -> UTF-8 text (invalid base64 -> NULL)."""
    return df.withColumn(alias, F.try_to_binary(F.col(column), F.lit("base64")).cast("string"))


def parse_json(df: DataFrame, schema: T.StructType, column: str = "payload",
               alias: str = "doc", mode: str = "PERMISSIVE",
               required: list[str] | None = None) -> DataFrame:
    """Parse JSON text into ``alias`` with a declared schema.

    PERMISSIVE (default) keeps malformed records: ``doc`` is NULL and
    ``_corrupt_record`` holds the text, ready for a quarantine sink. A record
    without one of the ``required`` fields (dotted paths) is malformed too.
    FAILFAST raises on the first malformed record (the reference behaviour).

    The parse goes through a one-row generator, which later filters and
    projections don't cross: each text is parsed once.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    if mode == "FAILFAST":
        return df.withColumn(alias, F.from_json(F.col(column), schema, opts))
    parsed = F.from_json(F.col(column), with_corrupt, opts)
    out = df.select("*", F.explode(F.array(parsed)).alias("_parsed"))
    bad = F.col(f"_parsed.{CORRUPT}").isNotNull() | F.col("_parsed").isNull()
    for path in required or []:
        bad = bad | F.col(f"_parsed.{path}").isNull()
    fields = [F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields]
    return (out.withColumn(alias, F.when(~bad, F.struct(*fields)))
            # NULL text (missing or undecodable payload) is malformed too.
            .withColumn(CORRUPT, F.when(bad, F.coalesce(F.col(column), F.lit(""))))
            .drop("_parsed"))


def split_valid(df: DataFrame, alias: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of a ``parse_json`` result."""
    return (df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
            df.filter(F.col(CORRUPT).isNotNull()).select(*[c for c in df.columns if c != alias]))


def _struct_paths(dt: T.DataType, prefix: list[str]):
    """Leaf paths of a struct type, in field order."""
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            yield from _struct_paths(f.dataType, prefix + [f.name])
    else:
        yield prefix, dt


def flatten(df: DataFrame, sep: str = "_", explode: bool = True,
            arrays: list[str] | None = None) -> DataFrame:
    """Flatten nested structs into ``A_B_C`` columns; explode arrays.

    Arrays of structs or scalars are exploded with ``explode_outer`` (one row
    per element; several arrays multiply rows, so ``arrays`` may name the
    only ones to explode, others stay as array columns). Repeats until no
    struct (and no selected array) remains.
    """
    cur = df
    while True:
        progressed = False
        cols: list[Column] = []
        to_explode = None
        for f in cur.schema.fields:
            name, dt = f.name, f.dataType
            if isinstance(dt, T.StructType):
                progressed = True
                for sub in dt.fields:
                    cols.append(F.col(f"`{name}`.`{sub.name}`").alias(f"{name}{sep}{sub.name}"))
            elif (explode and isinstance(dt, T.ArrayType) and to_explode is None
                  and (arrays is None or name in arrays)):
                to_explode = name
                cols.append(F.col(f"`{name}`"))
            else:
                cols.append(F.col(f"`{name}`"))
        if progressed:
            cur = cur.select(*cols)
            continue
        if to_explode is None:
            return cur
        cur = cur.select(*[F.explode_outer(F.col(f"`{c}`")).alias(c) if c == to_explode
                           else F.col(f"`{c}`") for c in cur.columns])
        if arrays is not None:
            arrays = [a for a in arrays if a != to_explode]


def nest_staging(df: DataFrame, sep: str = "_", root: str | None = None) -> DataFrame:
    """Inverse of ``flatten`` for struct paths: rebuild nested structs from
    ``A_B_C`` column names (first segment groups, recursively)."""
    def build(names: list[str], prefix: str):
        groups: dict[str, list[str]] = {}
        order: list[str] = []
        for n in names:
            rest = n[len(prefix):]
            head = rest.split(sep, 1)[0]
            if head not in groups:
                groups[head] = []
                order.append(head)
            groups[head].append(n)
        out = []
        for head in order:
            members = groups[head]
            if len(members) == 1 and members[0] == prefix + head:
                out.append(F.col(f"`{members[0]}`").alias(head))
            else:
                out.append(F.struct(*build(members, prefix + head + sep)).alias(head))
        return out
    return df.select(*build(df.columns, ""))


def to_json_records(df: DataFrame, columns: list[str] | None = None,
                    record_id: str | None = "recordId", encode: bool = True) -> DataFrame:
    """One JSON object per flattened row (NULL fields written), optionally
    base64-wrapped, with ``result = 'Ok'`` and the record id carried along.

    One row per record, not objects concatenated without a delimiter: a line
    reader keeps only the first object of such a line.
    """
    cols = list(columns or [c for c in df.columns if c != record_id])
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), {"ignoreNullFields": "false"})
    data = base64_text(text) if encode else text
    keep = [F.col(record_id)] if record_id and record_id in df.columns else []
    return df.select(*keep, F.lit("Ok").alias("result"), data.alias("data"))
