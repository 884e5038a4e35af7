"""Text expressions: rich-text flattening, white space, lengths, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse(text: Column) -> Column:
    """Runs of Unicode white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def dropped_entity(kind: Column, strip_links: bool, redact_pii: bool) -> Column:
    """Bare links, and under redaction phone numbers and addresses; anchors (``text_link``) stay."""
    kinds = ["link"] * strip_links + ["phone", "email"] * redact_pii
    return F.coalesce(kind, F.lit("")).isin(kinds) if kinds else F.lit(False)


def entity_text(entities: Column, strip_links: bool, redact_pii: bool) -> Column:
    kept = F.filter(entities, lambda e: ~dropped_entity(e["type"], strip_links, redact_pii))
    return F.array_join(F.transform(kept, lambda e: F.coalesce(e["text"], F.lit(""))), "")


def raw_text(text: Column, strip_links: bool, redact_pii: bool) -> Column:
    """The polymorphic ``text`` field: a string is itself, an array its strings and entity texts, anything else empty.

    Array elements that are null or objects without a text add nothing; numbers,
    nested arrays, and objects whose text or type is no string, are skipped.
    """
    kind = F.schema_of_variant(text)
    parts = F.try_variant_get(text, "$", "array<variant>")

    def string_at(part: Column, path: str) -> Column:
        at = F.try_variant_get(part, path, "variant")
        return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(part, path, "string"))

    def fits(part: Column, path: str) -> Column:
        """Absent, null or a string."""
        at = F.schema_of_variant(F.try_variant_get(part, path, "variant"))
        return F.coalesce(at.isin("STRING", "VOID"), F.lit(True))

    def one(part: Column) -> Column:
        own = F.schema_of_variant(part)
        entity = own.startswith("OBJECT") & fits(part, "$.type") & fits(part, "$.text") & fits(part, "$.href")
        entity &= ~dropped_entity(string_at(part, "$.type"), strip_links, redact_pii)
        return F.when(own == "STRING", F.try_variant_get(part, "$", "string")).when(entity, string_at(part, "$.text"))

    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(one(p), F.lit(""))), "")
    return F.when(kind == "STRING", F.try_variant_get(text, "$", "string")).when(kind.startswith("ARRAY"), joined).otherwise("")


def flatten(text: Column, entities: Column, strip_links: bool, redact_pii: bool) -> Column:
    """Entities decide if there are any, even if all are dropped; else the raw field."""
    some = F.coalesce(F.size(entities), F.lit(0)) > 0
    return collapse(F.when(some, entity_text(entities, strip_links, redact_pii)).otherwise(F.coalesce(raw_text(text, strip_links, redact_pii), F.lit(""))))


def runes(text: Column) -> Column:
    return F.char_length(text)


def truncate(text: Column, most: int = 240) -> Column:
    """For display: the first ``most`` characters and an ellipsis."""
    return F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def epoch(text: Column) -> Column:
    """Decimal seconds; anything else 0, values beyond 64 bits the nearest bound."""
    whole = F.coalesce(text, F.lit("")).rlike(r"^[+-]?[0-9]+\z")
    bound = F.when(text.startswith("-"), F.lit(-(2**63))).otherwise(F.lit(2**63 - 1))
    return F.when(whole, F.coalesce(text.try_cast("bigint"), bound)).otherwise(F.lit(0)).cast("bigint")


def month(date: Column) -> Column:
    """YYYY-MM in the session's zone; ``?`` for 0."""
    return F.when(date == 0, F.lit("?")).otherwise(F.date_format(F.timestamp_seconds(date), "yyyy-MM"))
