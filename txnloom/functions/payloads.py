"""JSON messages: decode, wrap, and the alert payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import FraudParams
from ..schemas import CHURN_ALERT, TXN, TXN_COLUMNS
from .clock import utc_iso_now

# Column types in the envelope's schema part.
_ENVELOPE_TYPES = {"int": "int32", "double": "double", "string": "string"}


def decode_txn(value: Column) -> Column:
    """Transaction struct from a message in an envelope or bare; NULL fields if neither."""
    # One schema that fits both shapes, so that the text is parsed once.
    opened = F.from_json(value, T.StructType([T.StructField("payload", TXN), *TXN.fields]))
    bare = F.struct(*[opened[c].alias(c) for c in TXN_COLUMNS])
    return F.coalesce(opened["payload"], bare)


def encode_txn(envelope: bool = True) -> Column:
    """Message text of the transaction columns of a row."""
    payload = F.struct(*[F.col(c) for c in TXN_COLUMNS])
    if not envelope:
        return F.to_json(payload)
    fields = F.array(*[
        F.struct(F.lit(f.name).alias("field"),
                 F.lit(_ENVELOPE_TYPES[f.dataType.simpleString()]).alias("type"),
                 F.lit(False).alias("optional"))
        for f in TXN.fields])
    schema = F.struct(F.lit("struct").alias("type"), F.lit("transaction").alias("name"),
                      F.lit(1).alias("version"), F.lit(False).alias("optional"),
                      fields.alias("fields"))
    return F.to_json(F.struct(schema.alias("schema"), payload.alias("payload")))


def fraud_alert(p: FraudParams = FraudParams()) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in TXN_COLUMNS],
                              F.lit(p.rule_id).alias("fraud_rule"),
                              utc_iso_now().alias("detected_at")))


def churn_alert() -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in CHURN_ALERT.fieldNames()]))
