"""Payloads at rest as VARIANT: parsed and cast once at landing, read field by field.

``TypedLanding`` keeps a stream in the folders of ``Landing``, with a column ``payload`` in place of the JSON text. It is
an object of the same nesting as the document, holding the stream's known fields (``STREAM_FIELDS``) already cast to
string, bigint, boolean or timestamp by the rules of ``parse_payload``. Spark writes it shredded, one parquet column per
field, so a scan reads the fields that a query names and parses nothing. Another set of fields needs no new table: rows
landed before a field was known have NULL there.

Defined cases: a NULL or malformed document gives a payload whose fields are all NULL; a value that its safe cast refuses
is NULL at rest, as in every staging model; properties outside the known fields are left out (the JSON landing has them).
A field that is mostly NULL in the rows from which Spark infers a file's columns stays in the file's residual binary and
reads the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.sources.envelope import Landing, parse_payload
from commitlake.sources.schemas import ENVELOPE, SDC_COLUMNS, STREAM_FIELDS

PAYLOAD = "payload"
TYPED = T.StructType([T.StructField(PAYLOAD, T.VariantType()), *[f for f in ENVELOPE.fields if f.name != "data"]])
SQL_TYPE = {"s": "string", "i": "bigint", "b": "boolean", "t": "timestamp"}      # by cast kind


def _object(fields, depth: int = 0) -> Column:
    """A struct of the typed columns, nested as their paths are."""
    heads: dict[str, list] = {}
    for field in fields:
        heads.setdefault(field[1].split(".")[depth], []).append(field)
    parts = []
    for head, inner in heads.items():
        leaf = len(inner[0][1].split(".")) == depth + 1
        parts.append((F.col(inner[0][0]) if leaf else _object(inner, depth + 1)).alias(head))
    return F.struct(*parts)


def type_payload(raw: DataFrame, stream: str, strict: bool = True) -> DataFrame:
    """Envelope rows with the JSON text parsed into a VARIANT ``payload``; each document is tokenised once."""
    fields = STREAM_FIELDS[stream]
    typed = parse_payload(raw, fields, keep=SDC_COLUMNS, strict=strict)
    return typed.select(F.to_variant_object(_object(fields)).alias(PAYLOAD), *SDC_COLUMNS)


def is_typed(raw: DataFrame) -> bool:
    """Whether the rows carry a VARIANT payload instead of JSON text."""
    return PAYLOAD in raw.columns and isinstance(raw.schema[PAYLOAD].dataType, T.VariantType)


def typed_columns(rows: DataFrame, fields, keep: list[str] | None = None) -> DataFrame:
    """The typed columns ``fields`` of a VARIANT payload; a scan below reads these fields only."""
    keep = [c for c in rows.columns if c != PAYLOAD] if keep is None else keep
    return rows.select(*keep, *[F.try_variant_get(PAYLOAD, f"$.{path}", SQL_TYPE[kind]).alias(name)
                                for name, path, kind in fields])


def flatten(raw: DataFrame, fields, keep: list[str] | None = None, strict: bool = True) -> DataFrame:
    """Typed columns of either layout: VARIANT payloads are projected, JSON text is parsed."""
    return typed_columns(raw, fields, keep) if is_typed(raw) else parse_payload(raw, fields, keep=keep, strict=strict)


class TypedLanding(Landing):
    """A stream landed in folders by date with VARIANT payloads; staging models and ``incremental_run`` take it."""

    schema = TYPED

    def __init__(self, spark: SparkSession, path: str, stream: str):
        super().__init__(spark, path)
        self.stream = stream

    def append(self, raw: DataFrame) -> None:
        """Land raw envelope rows (JSON text) or rows that are typed already."""
        super().append(raw if is_typed(raw) else type_payload(raw, self.stream))
