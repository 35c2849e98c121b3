"""Column expressions over nested payloads whose shape varies by client version.

A payload is JSON text parsed once per row into a VARIANT; each field lists candidate paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Path = Sequence[str]
NUMBER = r"(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"


def path_text(path: Path) -> str:
    return "$" + "".join(f"['{k}']" for k in path)


def parsed(payload: Column) -> Column:
    return F.try_parse_json(payload)


def first_text(v: Column, paths: Sequence[Path]) -> Column:
    """The first non-null value across the paths, as text (nested values as JSON)."""
    return F.coalesce(*(F.try_variant_get(v, path_text(p), "string") for p in paths))


def text_value(v: Column, paths: Sequence[Path]) -> Column:
    """Trimmed text; blank becomes null only after the first non-null path was chosen."""
    return F.nullif(F.trim(first_text(v, paths)), F.lit(""))


def number(text: Column) -> Column:
    return F.nullif(F.trim(text).try_cast("double"), F.lit(float("nan")))


def number_value(v: Column, paths: Sequence[Path]) -> Column:
    return number(first_text(v, paths))


def int_value(v: Column, paths: Sequence[Path]) -> Column:
    return first_text(v, paths).try_cast("bigint")


def duration_minutes(v: Column, minute_paths: Sequence[Path], second_paths: Sequence[Path]) -> Column:
    """Minutes as given, else seconds divided by 60."""
    return F.coalesce(number_value(v, minute_paths), number_value(v, second_paths) / 60.0)


def numbers_under(payload: Column, keys: Sequence[str]) -> Column:
    """All numbers held directly under any of the keys, at any depth, in document order.

    A key inside a JSON string is escaped there, so a match on the raw text is a real key.
    """
    pattern = '"(?:' + "|".join(keys) + r')"\s*:\s*' + NUMBER + r"(?=\s*[,}\]])"
    found = F.regexp_extract_all(payload, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda t: t.try_cast("double"))


def list_at(v: Column, paths: Sequence[Path], bare: bool = True) -> Column:
    """A list payload itself, or the list at the first path that holds a value."""
    chosen = None
    for p in paths:
        here = F.try_variant_get(v, path_text(p), "string").isNotNull()
        items = F.try_variant_get(v, path_text(p), "array<variant>")
        chosen = F.when(here, items) if chosen is None else chosen.when(here, items)
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), chosen) if bare else chosen


def is_object(v: Column) -> Column:
    """Whether a variant is an object; the struct without fields copies none of its values."""
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def objects_only(items: Column) -> Column:
    return F.filter(items, is_object)


def has_key(v: Column, key: str) -> Column:
    """Key present, even with a null value."""
    return F.try_variant_get(v, path_text([key]), "variant").isNotNull()


def merged_text(detail: Column, summary: Column, paths: Sequence[Path]) -> Column:
    """:func:`first_text` over a summary whose top-level keys are overridden by the detail's."""
    return F.coalesce(
        *(
            F.when(has_key(detail, p[0]), F.try_variant_get(detail, path_text(p), "string")).otherwise(
                F.try_variant_get(summary, path_text(p), "string")
            )
            for p in paths
        )
    )


def typed_entry(items: Column, type_field: str, wanted: str) -> Column:
    """First entry of a list of structs whose type field has the wanted value, else null."""
    return F.try_element_at(F.filter(items, lambda i: i[type_field] == wanted), F.lit(1))


def total_or_first(items: Column, type_field: str, value_field: str, wanted: str = "TOTAL") -> Column:
    """Value of the wanted entry if that entry exists, else of the first entry."""
    exists = F.exists(items, lambda i: F.coalesce(i[type_field] == wanted, F.lit(False)))
    entry = typed_entry(items, type_field, wanted)
    return F.when(exists, entry[value_field]).otherwise(F.try_element_at(items, F.lit(1))[value_field])


def stage_total(total: Column, *stages: Column) -> Column:
    """Total if known, else the sum of the stages with missing ones as 0, if any is known."""
    some = F.coalesce(*stages).isNotNull()
    return F.coalesce(total, F.when(some, sum((F.coalesce(s, F.lit(0.0)) for s in stages), F.lit(0.0))))
