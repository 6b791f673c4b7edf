"""Consumer offsets as map columns: source name to last consumed instant.

The table layer keeps offsets as maps. The text form ``name+instant,name+instant`` is for
exchanging them with other jobs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import BEGINNING

# Fixed values of the text form.
ENTRY_SEPARATOR = ","
VALUE_SEPARATOR = "+"


def _empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def merge_offsets(previous: Column, submitted: Column) -> Column:
    """Both maps together; submitted entries replace previous ones. NULL counts as empty."""
    return F.map_zip_with(
        F.coalesce(previous, _empty_map()),
        F.coalesce(submitted, _empty_map()),
        lambda name, old, new: F.coalesce(new, old),
    )


def encode_offsets(offsets: Column) -> Column:
    """Text form with names in order, ``''`` for no entries; a separator in a name is an error."""
    def entry(e: Column) -> Column:
        bad = F.contains(e["key"], F.lit(ENTRY_SEPARATOR)) | F.contains(
            e["key"], F.lit(VALUE_SEPARATOR)
        )
        return F.when(
            bad, F.raise_error(F.concat(F.lit("separator in table name: "), e["key"]))
        ).otherwise(F.concat(e["key"], F.lit(VALUE_SEPARATOR), e["value"]))

    entries = F.array_sort(F.map_entries(F.coalesce(offsets, _empty_map())))
    return F.array_join(F.transform(entries, entry), ENTRY_SEPARATOR)


def decode_offsets(text: Column) -> Column:
    """Map of a text form; NULL and ``''`` give the empty map."""
    parsed = F.str_to_map(text, F.lit(ENTRY_SEPARATOR), F.lit("[+]"))
    return F.when(text.isNull() | (text == ""), _empty_map()).otherwise(parsed)


def offset_of(offsets: Column, name: Column | str) -> Column:
    """Last consumed instant of one source, ``'000'`` if it was never consumed."""
    key = F.lit(name) if isinstance(name, str) else name
    return F.coalesce(F.try_element_at(offsets, key), F.lit(BEGINNING))
