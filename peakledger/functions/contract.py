"""The event contract: twelve required fields, no others, strict JSON types.

``check`` answers, per message, which rules are broken; an empty array means the message is good.
Types are read from the variant, because a cast cannot tell the text "16087.9" from the number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from peakledger.functions import clock
from peakledger.functions.events import MEASURE, REASONS, TOPIC, ZONE

# Fixed values of contract version 1: each field's JSON type and value as one pattern over "TYPE:text".
_NUMBER = r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
_INSTANT = r"STRING:\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z"
_MEASURES = sorted(set(MEASURE.values()))
FIELDS = {
    "schema_version": _NUMBER + r":1(\.0+)?",
    "version": _NUMBER + r":[1-9]\d*(\.0+)?",          # 12 and 12.0 are both whole numbers in JSON Schema
    "value_mw": _NUMBER + r":.*",
    "report": f"STRING:({'|'.join(TOPIC)})",
    "measure": f"STRING:({'|'.join(_MEASURES)})",
    "zone": f"STRING:{ZONE}",
    "reason": f"STRING:({'|'.join(REASONS)})",
    "interval_start": _INSTANT,
    "published_at": _INSTANT,
    "ingested_at": _INSTANT,
    "content_sha256": r"STRING:[0-9a-f]{64}",
    "source_uri": r"STRING:(?s).+",
}
INSTANTS = ("interval_start", "published_at", "ingested_at")
TYPES = {"version": "bigint", "value_mw": "double"}


def check(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Adds ``violations``, the names of the broken rules, and ``fields``, the top-level fields as variants (null unless the
    message is a JSON object)."""
    parsed = messages.withColumn("fields", F.try_variant_get(F.try_parse_json(F.col(payload)), "$", "map<string,variant>"))
    # One short lambda over the fields; the rules below then compile to plain code. (Anything inside a lambda does not.)
    signed = parsed.withColumn("_signed", F.transform_values("fields", lambda _, v: F.concat(
        F.schema_of_variant(v), F.lit(":"), F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")))))
    names = F.col("fields")
    held = F.size(F.array_intersect(F.map_keys(names), F.array(*[F.lit(n) for n in FIELDS])))
    rules = [("not_an_object", names.isNull()), ("missing_field", held < len(FIELDS)), ("extra_field", F.size(names) > held)]
    for name, pattern in FIELDS.items():
        signed_value = F.try_element_at("_signed", F.lit(name))
        broken_rule = ~signed_value.rlike(f"^{pattern}$")
        if name in INSTANTS:  # a text of the right shape may still name no instant, such as a thirteenth month
            broken_rule |= signed_value.isNotNull() & clock.parse_iso(F.substring(signed_value, len("STRING:") + 1, 20)).isNull()
        rules.append((name, broken_rule))
    broken = F.array(*[F.when(rule, F.lit(name)) for name, rule in rules])
    return signed.withColumn("violations", F.array_except(broken, F.array(F.lit(None).cast("string")))).drop("_signed")


def field(name: str) -> Column:
    """A typed field of a checked message."""
    value = F.try_variant_get(F.try_element_at("fields", F.lit(name)), "$", TYPES.get(name, "string"))
    return clock.parse_iso(value) if name in INSTANTS else value


def decode(checked: DataFrame) -> DataFrame:
    """Typed event columns of the good messages."""
    return checked.where(F.size("violations") == 0).select(*[field(name).alias(name) for name in list(FIELDS)[1:]])
